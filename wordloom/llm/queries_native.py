"""The queries on personal data and exact copies, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wordloom.llm import exact_dedup, pii
from wordloom.llm.registry import query
from wordloom.sources.tables import table

REACH, CONTEXTS, GENERALISE, REMOVE = 48, 3, 0.85, 0.95

# RE2 has neither possessive runs nor look-behind; it needs none, being linear.
_SQL_PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
_DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"
_SQL_VALID = (
    "true",
    "len(list_filter(string_split(value, '.'), lambda p: len(ltrim(p, '0')) > 3 OR coalesce(try_cast(nullif(ltrim(p, '0'), '') AS INT), 0) > 255)) = 0",
    f"""len({_DIGITS}) BETWEEN 14 AND 19 AND list_sum(list_transform(range(len({_DIGITS})), lambda i:
        CASE WHEN i % 2 = 0 THEN {_DIGITS}[len({_DIGITS}) - i]::INT
             WHEN {_DIGITS}[len({_DIGITS}) - i]::INT > 4 THEN {_DIGITS}[len({_DIGITS}) - i]::INT * 2 - 9
             ELSE {_DIGITS}[len({_DIGITS}) - i]::INT * 2 END)) % 10 = 0""",
    f"len({_DIGITS}) BETWEEN 10 AND 15",
)
_TERM_RE = r"\p{L}{3,}"


def _placed(source: str, keys: str, text: str, pattern: str) -> str:
    """start_at, value and the texts before and after each match of ``text`` in ``source``."""
    return f"""SELECT {keys}, i, value, gaps[i] AS before, gaps[i + 1] AS after,
            sum(len(gaps[i]) + len(value)) OVER (PARTITION BY {keys} ORDER BY i) - len(value) AS s
        FROM (SELECT {keys}, gaps, unnest(found) AS value, generate_subscripts(found, 1) AS i
              FROM (SELECT {keys}, regexp_extract_all({text}, '{pattern}') AS found,
                           regexp_split_to_array({text}, '{pattern}') AS gaps FROM {source}))"""


def _pii_sql() -> str:
    kinds = []
    for k, (pattern, valid) in enumerate(zip(_SQL_PATTERNS, _SQL_VALID)):
        name = {0: "lower(value)", 1: "value"}.get(k, _DIGITS)
        kinds.append(f"""SELECT doc_id, {k} AS kind, s::BIGINT AS s, (s + len(value))::BIGINT AS e, before, after,
            '{pii.KINDS[k]}:' || {name} AS entity FROM ({_placed("d", "doc_id", "text", pattern)}) WHERE {valid}""")
    names = ", ".join(f"'{k}'" for k in (*pii.KINDS, "term"))
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    base AS MATERIALIZED ({" UNION ALL ".join(kinds)}),
    mentions AS MATERIALIZED (SELECT doc_id, entity, min(md5(right(before, {REACH}) || '|' || left(after, {REACH}))) AS context
        FROM base GROUP BY doc_id, entity),
    occurrences AS MATERIALIZED (SELECT doc_id, lower(value) AS term, s::BIGINT AS s, (s + len(value))::BIGINT AS e
        FROM ({_placed("(SELECT * FROM d WHERE doc_id IN (SELECT doc_id FROM base))", "doc_id", "text", _TERM_RE)})),
    counts AS MATERIALIZED (SELECT term, count(DISTINCT doc_id) AS n_t FROM (
        SELECT doc_id, lower(unnest(regexp_extract_all(text, '{_TERM_RE}'))) AS term FROM d) GROUP BY term),
    about AS MATERIALIZED (SELECT entity, count(*) AS n_c FROM mentions GROUP BY entity HAVING count(DISTINCT context) >= {CONTEXTS}),
    held AS MATERIALIZED (SELECT DISTINCT doc_id, term FROM occurrences),
    joint AS (SELECT entity, term, count(*) AS n_ct FROM mentions JOIN held USING (doc_id)
        WHERE entity IN (SELECT entity FROM about) GROUP BY ALL HAVING count(DISTINCT context) >= {CONTEXTS}),
    told AS MATERIALIZED (SELECT entity, term, 1 + log2(n_ct / n_t) / log2(n_all / n_c) AS disclosure
        FROM joint JOIN about USING (entity) JOIN counts USING (term), (SELECT count(*) AS n_all FROM d) WHERE n_all > n_c),
    terms AS (SELECT doc_id, s, e, max(disclosure) AS disclosure
        FROM occurrences JOIN mentions USING (doc_id) JOIN told USING (entity, term)
        WHERE disclosure >= {GENERALISE} GROUP BY doc_id, s, e),
    free AS (SELECT * FROM terms t WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = t.doc_id AND b.s < t.e AND t.s < b.e)),
    spans AS (SELECT doc_id, kind, s, e, false AS removed FROM base
        UNION ALL SELECT doc_id, {pii.TERM}, s, e, disclosure >= {REMOVE} FROM free),
    joined AS (SELECT doc_id,
        coalesce(string_agg([{names}][kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < {pii.TERM}), '') AS base,
        string_agg([{names}][kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans,
        {", ".join(f"count(*) FILTER (kind = {k}) AS n_{name}" for k, name in enumerate((*pii.KINDS, "term")))},
        count(*) FILTER (removed) AS n_removed
        FROM spans GROUP BY doc_id)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in (*pii.KINDS, "term"))}, coalesce(n_removed, 0) AS n_removed,
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN joined USING (doc_id)"""


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*pii.KINDS, "term")])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


@query("op1_pii", _pii_sql())
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Entities and disclosing terms in every whole text."""
    found = pii.find_spans(table(spark, folder, "documents"), reach=REACH, contexts=CONTEXTS,
                           generalise=GENERALISE, remove=REMOVE)
    plain = F.transform("terms", lambda t: F.struct(t["start"], t["kind"], t["end"]))
    many = lambda kind: F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("bigint")
    return found.select(
        F.col("id").alias("doc_id"), *[many(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)],
        F.size("terms").cast("bigint").alias("n_term"),
        F.size(F.filter("terms", lambda t: t["removed"])).cast("bigint").alias("n_removed"),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("base", plain))).alias("spans"))


@query("op4_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal whole texts; the largest id stays."""
    return exact_dedup.exact_groups(table(spark, folder, "documents"), keep="max")
