"""Structured Streaming jobs: the record-at-a-time steps on unbounded input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wordloom.functions import text as tx


def preprocess_stream(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """Stateless: one record in, one record out, other fields unchanged."""
    return docs.withColumn(text, tx.preprocess(F.col(text), **options))


def distinct_urls(
    records: DataFrame, url: str = "url", event_time: str | None = None, delay: str = "1 day"
) -> DataFrame:
    """First record of every URL, or of every text. The state holds a 256-bit hash of it,
    however long it is. With an event time the state is bounded: a URL is
    forgotten once the watermark has passed it by ``delay``."""
    keyed = records.withColumn("_key", F.sha2(F.col(url).cast("string"), 256))
    if event_time:
        keyed = keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["_key"])
    else:
        keyed = keyed.dropDuplicates(["_key"])
    return keyed.drop("_key")


def running_counters(records: DataFrame, text: str = "text", by: tuple[str, ...] = ()) -> DataFrame:
    """Documents and words seen so far."""
    return records.groupBy(*by).agg(
        F.count("*").alias("total_articles"),
        F.sum(tx.word_count(F.col(text))).alias("total_words"),
    )


def append_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Process what is available and stop; restarts go on from the checkpoint."""
    writer = stream.writeStream.outputMode("append").trigger(availableNow=True)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    return writer.format(fmt).option("checkpointLocation", checkpoint).start(path)


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _matching(spark: SparkSession, path: str, pattern: str) -> list:
    """Paths under a folder that match; none if there is no such folder."""
    found = _files(spark, path).globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}"))
    return [s.getPath() for s in found or ()]


def publish_totals(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Complete-mode results, one folder for each batch; :func:`read_totals` takes the newest
    that is complete, so a crash while one is written loses nothing."""
    def publish(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch-{number:012d}")
        # The one before stays for readers that are at it; earlier ones are superseded.
        for done in _matching(batch.sparkSession, path, "batch-*"):
            if done.getName() < f"batch-{number - 1:012d}":
                _files(batch.sparkSession, path).delete(done, True)

    return (
        stream.writeStream.outputMode("complete").trigger(availableNow=True)
        .option("checkpointLocation", checkpoint).foreachBatch(publish).start()
    )


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """The totals of the newest batch that was written to its end."""
    done = _matching(spark, path, "batch-*/_SUCCESS")
    if not done:
        raise FileNotFoundError(f"no batch is complete yet in {path}")
    return spark.read.parquet(max(p.getParent().toString() for p in done))
