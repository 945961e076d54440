"""The queries on repeated passages, near copies and language-model scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom.llm import align, decontaminate, fim, lm, near_dedup, substring_dedup
from wordloom.llm.registry import query
from wordloom.sources.tables import table

WINDOW = 20


@query("op2_substring_dedup", f"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS i FROM d),
    g AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS win FROM s),
    r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM g),
    gone AS (SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS j FROM r WHERE n > 1) GROUP BY doc_id),
    flat AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
    cut AS (SELECT doc_id, unnest(js) AS i FROM gone),
    kept AS (SELECT flat.doc_id, string_agg(word, ' ' ORDER BY flat.i) AS kept, count(*) AS n
        FROM flat ANTI JOIN cut ON flat.doc_id = cut.doc_id AND flat.i = cut.i GROUP BY flat.doc_id)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)""")
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without windows that start earlier too."""
    out = substring_dedup.remove_repeats(table(spark, folder, "documents"), WINDOW, with_text=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op7_lm_score")
def op7_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents by a model of all bigrams of those not held out."""
    apart = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    out = lm.score_texts(table(spark, folder, "documents"), ~apart, least=1)
    return out.select("doc_id", (~F.col("is_training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op5_near_dedup")
def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near copies of every document."""
    out = near_dedup.near_groups(table(spark, folder, "documents"))
    return out.select("doc_id", "class_id", "class_size", "kept")


_FOLDED = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""
LEAK_WINDOW = 10


@query("op11_decontamination", f"""
    WITH d AS MATERIALIZED (SELECT doc_id, {_FOLDED} AS w FROM documents),
    i AS (SELECT item_id, w, least({LEAK_WINDOW}, len(w)) AS n FROM (SELECT item_id, {_FOLDED} AS w FROM benchmark) WHERE len(w) > 0),
    tests AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS win
        FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM i)),
    runs AS (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS win
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM tests) WHERE len(w) >= n)),
    found AS MATERIALIZED (SELECT doc_id, k, n, item_id FROM runs JOIN tests USING (n, win)),
    words AS (SELECT doc_id, count(DISTINCT word) AS n_hit
        FROM (SELECT doc_id, unnest(range(k, k + n)) AS word FROM (SELECT DISTINCT doc_id, k, n FROM found)) GROUP BY doc_id),
    items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM found GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """What every document shares with the benchmark."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out, names = decontaminate.find_leaks(docs, table(spark, folder, "benchmark"), LEAK_WINDOW)
    items = F.col(names["items"])
    return out.select(
        "doc_id", F.col(names["words"]).alias("n_words"), F.col(names["hit"]).alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col(names["hit"]) > 0).alias("contaminated"))


_H = lambda k: f"('0x' || substr(h, {8 * k + 1}, 8))::BIGINT"


@query("op12_fill_in_middle", f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
        sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
    e AS (SELECT *, len(u) AS n, {_H(0)} % (len(u) + 1) AS x, {_H(1)} % (len(u) + 1) AS y,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {_H(2)} % 100 >= 90 THEN 'plain'
             WHEN {_H(3)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
    p AS (SELECT doc_id, text, n, form, array_to_string(u[1:least(x, y)], '') AS prefix,
        array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS middle, array_to_string(u[greatest(x, y) + 1:n], '') AS suffix FROM e)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN len(prefix) END::BIGINT AS prefix_chars,
        CASE WHEN form <> 'plain' THEN len(middle) END::BIGINT AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
               ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
    FROM p""")
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document arranged, and its text rebuilt from the arranged output."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out, made = fim.transform(docs, seed="1", rate=90, spm=20)
    out = out.drop("text", made["pieces"])
    out, back = fim.restore(out, made["output"], made["form"], with_text=False)
    return out.select(
        "doc_id", F.col(made["units"]).alias("n"), F.col(made["form"]).alias("form"), F.col(made["prefix_chars"]).alias("prefix_chars"),
        F.col(made["middle_chars"]).alias("middle_chars"), F.col(made["output_sha256"]).alias("output_sha256"),
        F.col(back["restored_sha256"]).alias("restored_sha256"))


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's groups and links between byte-level and piece tokens."""
    import public_tokenizers

    out, _ = align.align(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                         public_tokenizers.path("piece_bpe_32k.model"))
    return out
