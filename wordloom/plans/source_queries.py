"""JSON Lines sources, sinks and streams, fed by files that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wordloom import rules
from wordloom.functions import text as tx, tokenizers as tk
from wordloom.operators import vocabulary as vb
from wordloom.plans import sql
from wordloom.plans.page_queries import ARTICLES, article_rows
from wordloom.plans.registry import query
from wordloom.plans.token_queries import SQL_TOKENIZERS, full_grid, grid_lemmas, grid_oracle, grid_seconds, tokenizer_grid
from wordloom.session import new_path
from wordloom.sources import jsonl, sinks
from wordloom.sources.tables import table, table_stream
from wordloom.streaming import jobs

# Kinds of line by doc_id % 10, to meet every branch of the readers.


def _record(text, *more):
    return F.to_json(F.struct(F.col("doc_id").alias("id"), text.alias("text"), *more),
                     {"ignoreNullFields": "false"})


def _lines(spark, d) -> DataFrame:
    kind, none = F.col("doc_id") % 10, F.lit(None).cast("string")
    extra = F.struct(F.col("lang"), F.array("source").alias("tags")).alias("extra")
    line = (
        F.when(kind <= 2, _record(F.col("text"), extra))
        .when(kind == 3, _record(F.concat(F.lit(" \n"), F.col("text"), F.lit(" "))))
        .when(kind == 4, _record(F.col("n_chars")))
        .when(kind == 5, _record(none, F.col("lang")))
        .when(kind == 6, F.to_json(F.struct(F.col("doc_id").alias("id"), "lang")))
        .when(kind == 7, F.concat(_record(F.col("text")), F.lit(" trailing")))
        .when(kind == 8, F.lit("  "))
        .otherwise(_record(F.lit(" ")))
    )
    return table(spark, d, "documents").select("doc_id", line.alias("line"))


def _lines_path(spark, d) -> str:
    """The derived lines as files whose order is the order of doc_id."""
    path = new_path(spark, "lines")
    _lines(spark, d).orderBy("doc_id").select("line").write.text(path)
    return path


_NUMBERED = "(SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos, doc_id % 10 AS kind FROM documents)"


@query("scan_jsonl_lenient", f"""SELECT pos, CASE kind WHEN 3 THEN ' ' || chr(10) || text || ' '
    WHEN 9 THEN ' ' ELSE text END AS text FROM {_NUMBERED} WHERE kind IN (0, 1, 2, 3, 9)""")
def scan_lenient(spark, d):
    return jsonl.read_texts(spark, _lines_path(spark, d), "lenient")


@query("scan_jsonl_limited", f"""SELECT pos, CASE kind WHEN 3 THEN ' ' || chr(10) || text || ' '
    WHEN 9 THEN ' ' ELSE text END AS text FROM {_NUMBERED} WHERE kind IN (0, 1, 2, 3, 9) AND pos < 95""")
def scan_limited(spark, d):
    """The limit counts physical lines, bad ones included."""
    return jsonl.read_texts(spark, _lines_path(spark, d), "lenient", max_records=95)


_TRIM = sql.sub("text", r"^\s+|\s+$", "")


@query("scan_jsonl_strict", f"SELECT pos, {_TRIM} AS text FROM {_NUMBERED} WHERE kind <= 3")
def scan_strict(spark, d):
    return jsonl.read_texts(spark, _lines_path(spark, d), "strict")


_COERCED = f"SELECT pos, CASE kind WHEN 4 THEN n_chars::VARCHAR ELSE {_TRIM} END AS text FROM {_NUMBERED} WHERE kind <= 4"


@query("scan_jsonl_coerce", _COERCED)
def scan_coerce(spark, d):
    return jsonl.read_texts(spark, _lines_path(spark, d), "coerce")


@query("scan_jsonl_coerce_limited", f"SELECT pos, text FROM ({_COERCED}) ORDER BY pos LIMIT 83")
def scan_coerce_limited(spark, d):
    """The limit counts accepted texts."""
    return jsonl.read_texts(spark, _lines_path(spark, d), "coerce", max_records=83)


def _processed(spark, d):
    return jsonl.transform_records(_lines(spark, d), lambda t: tx.preprocess(t))


@query("records_passthrough", f"""SELECT doc_id, CASE WHEN kind <= 3 THEN {sql.preprocess('text')}
        WHEN kind = 9 THEN '' END AS text, CASE WHEN kind <= 2 OR kind IN (5, 6) THEN lang END AS lang
    FROM {_NUMBERED} WHERE kind NOT IN (4, 7, 8)""")
def records_passthrough(spark, d):
    """Records read back after rewriting their text; the other fields are as they were."""
    kept, _ = jsonl.quarantine(_processed(spark, d))
    path = new_path(spark, "processed")
    sinks.overwrite_records(kept, path)
    return spark.read.text(path).withColumn("v", F.try_parse_json("value")).select(
        F.try_variant_get("v", "$.id", "bigint").alias("doc_id"),
        F.try_variant_get("v", "$.text", "string").alias("text"),
        F.coalesce(F.try_variant_get("v", "$.extra.lang", "string"),
                   F.try_variant_get("v", "$.lang", "string")).alias("lang"),
    )


@query("quarantine", f"""SELECT CASE kind WHEN 4 THEN 'text is BIGINT' WHEN 7 THEN 'malformed json'
    ELSE 'blank line' END AS reason, count(*)::BIGINT AS n FROM {_NUMBERED} WHERE kind IN (4, 7, 8) GROUP BY 1""")
def quarantine(spark, d):
    _, rejected = jsonl.quarantine(_processed(spark, d))
    return rejected.groupBy("reason").agg(F.count("*").alias("n"))


@query("json_fields", "SELECT event_type, count(*)::BIGINT AS n, sum(json_extract(props, '$.k')::BIGINT)::BIGINT "
       "AS k FROM events GROUP BY event_type")
def json_fields(spark, d):
    parsed = jsonl.parse(table(spark, d, "events"), "props")
    return parsed.withColumn("k", F.try_variant_get("record", "$.k", "bigint")).groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum("k").alias("k"))


# --- sinks ---------------------------------------------------------------------------------

@query("sink_articles", f"SELECT title, text, date, url, category FROM {ARTICLES} "
       "WHERE regexp_matches(text, '\\S')")
def sink_articles(spark, d):
    """Articles appended in two runs, then read back."""
    path, rows = new_path(spark, "articles"), article_rows(spark, d)
    for half in (0, 1):
        sinks.append_articles(rows.filter(F.col("page_id") % 2 == half), path)
    return spark.read.schema("title string, text string, date string, url string, category string").json(path)


@query("sink_processed", f"SELECT doc_id, {sql.preprocess('text')} AS text FROM documents")
def sink_processed(spark, d):
    path = new_path(spark, "processed")
    docs = table(spark, d, "documents").select("doc_id", tx.preprocess(F.col("text")).alias("text"))
    sinks.overwrite_records(docs.select(F.to_json(F.struct("doc_id", "text")).alias("record_json")), path)
    return spark.read.schema("doc_id bigint, text string").json(path)


@query("sink_plain_corpus", "SELECT replace(text, chr(10), ' ') AS value FROM documents")
def sink_plain_corpus(spark, d):
    path = new_path(spark, "corpus")
    sinks.write_plain_corpus(table(spark, d, "documents"), path)
    return spark.read.text(path)


_TOKENS = f"(SELECT unnest({sql.regex_words('lower(text)')}) AS token FROM documents)"


@query("top_tokens_csv", f"SELECT token, count(*)::BIGINT AS cnt FROM {_TOKENS} GROUP BY token "
       "ORDER BY cnt DESC, token LIMIT 50")
def top_tokens_csv(spark, d):
    words = tk.regex_words(F.lower(F.col("text")), rules.LATIN_EXTRA)
    path = new_path(spark, "top-tokens")
    sinks.write_csv(vb.top_tokens(vb.token_counts(table(spark, d, "documents"), words), 50), path)
    return sinks.read_csv(spark, path, "token string, cnt bigint")


@query("metrics_csv")
def metrics_csv(spark, d):
    """The grid's twenty rows with four decimals, and their seconds, through CSV."""
    lemmas = grid_lemmas(spark, d)
    out = full_grid(spark, d, lemmas).join(F.broadcast(grid_seconds(spark, d, lemmas).drop("rows")), ["tokenizer", "normalizer"])
    path = new_path(spark, "metrics")
    sinks.write_csv(sinks.format_metrics(out, ["oov_pct", "semantic_similarity", "seconds"]), path)
    return sinks.read_csv(spark, path, "tokenizer string, normalizer string, vocab_size bigint, "
                          "oov_pct string, semantic_similarity string, seconds string")


@query("metrics_csv_plain", "SELECT tokenizer, normalizer, vocab_size, printf('%.4f', oov_pct) AS oov_pct, "
       f"NULL::VARCHAR AS semantic_similarity FROM ({grid_oracle(*SQL_TOKENIZERS)})")
def metrics_csv_plain(spark, d):
    """The rows that SQL can say; a missing similarity is an empty cell."""
    out = tokenizer_grid(spark, d).withColumn("semantic_similarity", F.lit(None).cast("double"))
    path = new_path(spark, "metrics")
    sinks.write_csv(sinks.format_metrics(out, ["oov_pct", "semantic_similarity"]), path)
    return sinks.read_csv(spark, path, "tokenizer string, normalizer string, vocab_size bigint, "
                          "oov_pct string, semantic_similarity string")


# --- streams -----------------------------------------------------------------------------------

def _run(stream, spark, label, fmt="parquet"):
    path = new_path(spark, label)
    jobs.append_files(stream, f"{path}/out", f"{path}/checkpoint", fmt).awaitTermination()
    return f"{path}/out"


@query("stream_preprocess", f"SELECT doc_id, {sql.preprocess('text')} AS text FROM documents")
def stream_preprocess(spark, d):
    # The stream is one small file: it is dealt out to the cores. A stream of many
    # files needs no such shuffle.
    docs = table_stream(spark, d, "documents").select("doc_id", "text")
    docs = docs.repartition(spark.sparkContext.defaultParallelism)
    out = _run(jobs.preprocess_stream(docs), spark, "stream-preprocess", "json")
    return spark.read.schema("doc_id bigint, text string").json(out)


@query("stream_dedup", "SELECT DISTINCT text FROM documents")
def stream_dedup(spark, d):
    docs = table_stream(spark, d, "documents").select("text")
    return spark.read.parquet(_run(jobs.distinct_urls(docs, "text"), spark, "stream-dedup"))


@query("stream_dedup_watermark", "SELECT DISTINCT user_id FROM events")
def stream_dedup_watermark(spark, d):
    """First event of every user with bounded state."""
    events = table_stream(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    first = jobs.distinct_urls(events, "user_id", event_time="ts", delay="7 days").select("user_id")
    return spark.read.parquet(_run(first, spark, "stream-dedup-time"))


@query("stream_counters", f"""SELECT source, count(*)::BIGINT AS total_articles,
    sum(len({sql.words('text')}))::BIGINT AS total_words FROM documents GROUP BY source""")
def stream_counters(spark, d):
    path = new_path(spark, "stream-counters")
    totals = jobs.running_counters(table_stream(spark, d, "documents"), by=("source",))
    jobs.publish_totals(totals, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return jobs.read_totals(spark, f"{path}/out")
