"""Information-theoretic sanitisation, built-in functions only.

1. *Protected entities*: e-mail and IP addresses, card and phone numbers, found by linear
   patterns (possessive, started only where a run of their characters starts).
2. *Co-occurrence*: every term of a document is counted with every entity that the document
   holds. With n(c, t) documents that hold both, n(c) with the entity, n(t) with the term and
   N in all, PMI(c; t) = log2(n(c, t) N / (n(c) n(t))) tells how much t gives away of c, whose
   information content is IC(c) = log2(N / n(c)). Their ratio, the *disclosure*, is 1 for a
   term that occurs in documents with c only.
3. A term seen with c in at least ``contexts`` documents that surround c differently (so that copies
   are no evidence) whose disclosure reaches ``generalise`` is replaced by a class name wherever it
   occurs in a document with c; from ``remove`` on it goes.

Pairs are not formed where they can't count: an entity with fewer contexts has none, and the disclosure
of c and t stays below the threshold where n(t) > n(c) (N / n(c)) ^ (1 - generalise), whatever n(c, t)
is, so an entity meets only the terms of its documents that are about as rare as itself. Equal texts are
one row with their number. Entities, terms and pairs that hold a large part of all rows meet their
statistics by a broadcast (fewer than ``_HOT`` keys of bounded length can), the others by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.functions.text import bind, let
from wordloom.llm.common import free_name, whole
from wordloom.session import materialize

KINDS = ("email", "ip", "card", "phone")
TERM = len(KINDS)

_LOCAL = r"[A-Za-z0-9._%+-]"
#: A match can only start where a run of its characters starts, or right after the last match.
PATTERNS = (
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: Cheap necessary conditions.
_HINTS = ("@", ".", None, "+")
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IP = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
TERM_PATTERN = r"\p{L}{3,}+"
_CHUNK = 256
#: A key with more than this part of all rows is hot; its length in characters; parts of copies' rows.
_HOT = 5000
_LONGEST = 1000
_SALTS = 8


def _running(lengths: Column) -> Column:
    """Sums before each element; in two levels, so long arrays don't cost a square."""
    def scan(values: Column, start: Column) -> Column:
        step = lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        zero = F.struct(start.cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(values, zero, step, lambda acc: acc["out"])

    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _CHUNK).cast("int")),
        lambda i: F.slice(lengths, i * _CHUNK + 1, F.lit(_CHUNK)))
    several = let(chunks, lambda cs: F.flatten(F.zip_with(
        cs, scan(F.transform(cs, total), F.lit(0)), scan)))
    return F.when(F.size(lengths) <= _CHUNK, scan(lengths, F.lit(0))).otherwise(several)


def matches(text: Column, pattern: str) -> Column:
    """All matches as (start, end, value, before, after), code points, the end exclusive;
    before and after are the texts up to the neighbouring matches."""
    def place(found: Column, gaps: Column) -> Column:
        step = F.zip_with(gaps, found, lambda g, m: F.when(
            m.isNotNull(), (F.length(g) + F.length(m)).cast("bigint")))
        return let(_running(F.filter(step, lambda x: x.isNotNull())), lambda before: number(found, gaps, before))

    def number(found: Column, gaps: Column, before: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(found) - 1), lambda i: let(
            F.get(before, i) + F.length(F.get(gaps, i)), lambda start: F.struct(
                start.alias("start"), (start + F.length(F.get(found, i))).alias("end"),
                F.get(found, i).alias("value"), F.get(gaps, i).alias("before"),
                F.get(gaps, i + 1).alias("after"))))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = let(F.struct(found.alias("m"), F.split(text, pattern, -1).alias("g")),
               lambda x: place(x["m"], x["g"]))
    return F.when(F.rlike(text, F.lit(pattern)), both)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def digit(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, twice).otherwise(d)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), lambda acc, i: acc + digit(i)) % 10 == 0


def _valid(kind: int, value: Column) -> Column:
    if kind == 1:
        return F.rlike(value, F.lit(_IP))
    if kind == 2:
        return let(_digits(value), lambda d: F.length(d).between(14, 19) & _luhn(d))
    if kind == 3:
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _entity(kind: int, value: Column) -> Column:
    name = F.lower(value) if kind == 0 else value if kind == 1 else _digits(value)
    return F.concat(F.lit(f"{KINDS[kind]}:"), name)


def _near(kind: int, x: Column, reach: int) -> Column:
    """The entity of a match and a digest of the ``reach`` characters on both sides."""
    around = F.concat(F.right(x["before"], F.lit(reach)), F.lit("|"), F.left(x["after"], F.lit(reach)))
    return F.struct(_entity(kind, x["value"]).alias("entity"), F.md5(around).alias("context"))


def _terms(text: Column) -> Column:
    """The different terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM_PATTERN), F.lit(0)), F.lower))


def find_entities(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", reach: int = 48,
) -> DataFrame:
    """For each row: its id, ``key`` (hash of id and text), ``body`` (hash of the text), ``base`` spans
    (start, kind, end) in order, ``near`` (entity and surroundings of each match), and the ``text``
    where it holds an entity. Null texts count as empty."""
    out = docs.select(F.col(id_column).alias("id"), whole(text_column).alias("text"))
    for kind, (pattern, hint) in enumerate(zip(PATTERNS, _HINTS)):
        found = F.filter(matches(F.col("text"), pattern), lambda m: _valid(kind, m["value"]))
        if hint:
            found = F.when(F.contains(F.col("text"), F.lit(hint)), found)
        slim = F.transform(found, lambda m: F.struct(
            m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"),
            _near(kind, m, reach).alias("near")))
        none = "array<struct<start:bigint,kind:int,end:bigint,near:struct<entity:string,context:string>>>"
        out = bind(out, f"k{kind}", F.coalesce(slim, F.array().cast(none)))
    spans = F.concat(*[F.col(f"k{k}") for k in range(TERM)])
    base = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return out.select("id", row_key("id", "text").alias("key"), F.md5("text").alias("body"), base.alias("base"),
                      F.transform(spans, lambda s: s["near"]).alias("near"),
                      F.when(F.size(spans) > 0, F.col("text")).alias("text"))


def row_key(id_column: str, text_column: str) -> Column:
    """Rows with one id and one text have one key, and so one result."""
    return F.md5(F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("null")), F.lit(":"), whole(text_column)))


def term_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """term, n_t: how many rows hold each term."""
    return (docs.select(F.explode(_terms(whole(text_column))).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("n_t")))


def _attach(rows: DataFrame, stats: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Inner join with ``stats``, one row for each key. A key with more than 1/_HOT of the sum of
    ``weight`` is broadcast, and there are fewer than _HOT of them; both inputs are stored tables."""
    total = stats.agg(F.sum(weight)).first()[0] or 0
    short = F.length(F.concat(*keys)) <= _LONGEST
    hot = stats.filter(short & (F.col(weight) * _HOT > total))
    cold = stats.filter(~short | (F.col(weight) * _HOT <= total))
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(rest.join(cold, keys))


def disclosing_terms(
    found: DataFrame, counts: DataFrame, contexts: int, least: float,
) -> tuple[DataFrame, DataFrame]:
    """The distinct texts that hold an entity (body, text), and body, term, disclosure of their terms
    at or above ``least`` (the highest, where a text holds several entities)."""
    rows = found.count()
    texts = materialize(found.filter(F.size("near") > 0).groupBy("body").agg(
        F.count(F.lit(1)).alias("m"), F.first("near").alias("near"), F.first("text").alias("text")), "texts")
    mentions = materialize(
        texts.select("body", "m", F.explode("near").alias("n")).groupBy("body", F.col("n.entity").alias("entity"))
        .agg(F.min("n.context").alias("context"), F.max("m").alias("m")), "mentions")
    n_c, share = F.col("n_c"), F.lit(rows) / F.col("n_c")
    about = materialize(
        mentions.groupBy("entity", "context").agg(F.sum("m").alias("n"), F.count(F.lit(1)).alias("texts"))
        .groupBy("entity").agg(F.sum("n").alias("n_c"), F.sum("texts").alias("texts"), F.count(F.lit(1)).alias("seen"))
        .filter((F.col("seen") >= contexts) & (n_c < rows))
        .select("entity", "n_c", "texts", (n_c * F.pow(share, F.lit(1 - least)) * (1 + 1e-9)).alias("limit")), "about")
    kept = materialize(_attach(mentions, about, ["entity"], "texts").drop("texts"), "kept")

    most = about.agg(F.max("limit")).first()[0] or 0.0
    bags = materialize(texts.join(kept.select("body").distinct(), "body", "left_semi")
                       .select("body", _terms(F.col("text")).alias("terms")), "bags")
    rare = counts.filter((F.col("n_t") >= contexts) & (F.col("n_t") <= most))
    words = _attach(bags.select("body", F.explode("terms").alias("term")), rare, ["term"], "n_t")
    pairs = materialize(words.join(kept, "body").filter(F.col("n_t") <= F.col("limit")).drop("limit"), "pairs")
    ratio = 1 + F.log2(F.col("n_ct") / F.col("n_t")) / F.log2(share)
    told = materialize(
        pairs.groupBy("entity", "term", "context").agg(
            F.sum("m").alias("n"), F.count(F.lit(1)).alias("texts"), F.max("n_t").alias("n_t"), F.max("n_c").alias("n_c"))
        .groupBy("entity", "term").agg(
            F.sum("n").alias("n_ct"), F.sum("texts").alias("texts"), F.max("n_t").alias("n_t"), F.max("n_c").alias("n_c"),
            F.count(F.lit(1)).alias("seen"))
        .filter(F.col("seen") >= contexts).select("entity", "term", "texts", ratio.alias("disclosure"))
        .filter(F.col("disclosure") >= least), "told")
    gone = (_attach(pairs.select("body", "entity", "term"), told, ["entity", "term"], "texts")
            .groupBy("body", "term").agg(F.max("disclosure").alias("disclosure")))
    return texts.select("body", "text"), materialize(gone, "gone")


def find_spans(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", reach: int = 48,
    contexts: int = 3, generalise: float = 0.85, remove: float = 0.95,
) -> DataFrame:
    """id, key, ``base`` spans and ``terms``: (start, kind, end, removed) of disclosing terms.

    One row for each row of ``docs``; repeated rows get the same result and count as documents, but
    not as contexts. Terms inside a base span are left to it. Null and empty texts and texts without an
    entity have no spans, an empty table gives no rows, other columns are not read. ``reach``
    only tells surroundings apart; terms count in whole documents.
    """
    if not 0 < generalise <= remove:
        raise ValueError("thresholds: 0 < generalise <= remove")
    found = materialize(find_entities(docs, id_column, text_column, reach), "entities")
    counts = materialize(term_counts(docs, text_column), "terms")
    texts, gone = disclosing_terms(found, counts, contexts, generalise)
    places = (texts.join(gone.select("body").distinct(), "body", "left_semi")
              .select("body", F.explode(matches(F.col("text"), TERM_PATTERN)).alias("m"))
              .select("body", "m.start", "m.end", F.lower("m.value").alias("term")))
    spans = (places.join(gone, ["body", "term"]).groupBy("body").agg(F.array_sort(F.collect_list(F.struct(
        "start", F.lit(TERM).alias("kind"), "end", (F.col("disclosure") >= remove).alias("removed")))).alias("terms")))
    # A text may have many copies: their rows are dealt over several tasks.
    spans = spans.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    rows = found.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(_SALTS)).cast("int"))
    clear = F.filter("terms", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,removed:boolean>>")
    return (rows.join(spans, ["body", "salt"], "left")
            .select("id", "key", "base", F.coalesce(clear, none).alias("terms")))


def sanitise(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents with entities replaced by their kind, disclosing terms generalised to
    ``<TERM>`` or removed; other columns stay, whatever their names. Of overlapping spans the first
    wins. A null text stays null, an empty one empty; repeated rows stay as many."""
    key, span = free_name(docs, "key"), free_name(docs, "span")
    spans = find_spans(docs, id_column, text_column, **options)
    merged = F.array_sort(F.concat(
        F.transform("base", lambda b: F.struct(b["start"], b["end"], b["kind"], F.lit(False).alias("gone"))),
        F.transform("terms", lambda t: F.struct(t["start"], t["end"], t["kind"], t["removed"].alias("gone")))))
    spans = spans.select(F.col("key").alias(key), merged.alias(span)).dropDuplicates([key])
    text = whole(text_column)
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in (*KINDS, "term")])
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    step = lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(F.struct(
        s["end"].alias("at"), F.concat(
            acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]),
            F.when(s["gone"], "").otherwise(F.get(names, s["kind"]))).alias("out")))
    clean = F.aggregate(span, zero, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
    return (docs.withColumn(key, row_key(id_column, text_column)).join(spans, key, "left")
            .select(*[F.when(F.col(c).isNotNull(), clean).alias(c) if c == text_column else F.col(c) for c in docs.columns]))
