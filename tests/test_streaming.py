"""Streams give what the batch gives."""

import pytest

from pyspark.sql import functions as F

from wordloom.functions import text as tx
from wordloom.streaming import jobs

SCHEMA = "url string, text string, ts timestamp"


def source(spark, folder, rows, files=3):
    df = spark.createDataFrame(rows, "url string, text string, ts string").withColumn("ts", F.to_timestamp("ts"))
    df.repartition(files).write.parquet(folder)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


ROWS = [("a", "Один 1", "2024-01-01 00:00:00"), ("b", "Два , 2", "2024-01-01 00:01:00"),
        ("a", "три", "2024-01-01 00:02:00"), ("c", "a b c", "2024-01-01 00:03:00")]


def test_preprocess(spark, tmp_path):
    stream = source(spark, str(tmp_path / "in"), ROWS)
    jobs.append_files(jobs.preprocess_stream(stream), str(tmp_path / "out"), str(tmp_path / "c"), "json").awaitTermination()
    got = {(r.url, r.text) for r in spark.read.schema(SCHEMA).json(str(tmp_path / "out")).collect()}
    batch = spark.read.parquet(str(tmp_path / "in")).select("url", tx.preprocess(F.col("text")).alias("text"))
    assert got == {(r.url, r.text) for r in batch.collect()}


def test_dedup(spark, tmp_path):
    for i, kwargs in enumerate([{}, {"event_time": "ts"}]):
        stream = source(spark, str(tmp_path / f"in{i}"), ROWS)
        out = str(tmp_path / f"out{i}")
        jobs.append_files(jobs.distinct_urls(stream, **kwargs), out, str(tmp_path / f"c{i}")).awaitTermination()
        assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_counters(spark, tmp_path):
    totals = jobs.running_counters(source(spark, str(tmp_path / "in"), ROWS))
    jobs.publish_totals(totals, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    row = jobs.read_totals(spark, str(tmp_path / "out")).first()
    assert (row.total_articles, row.total_words) == (4, 9)


def test_totals_of_no_batch(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        jobs.read_totals(spark, str(tmp_path / "none"))
