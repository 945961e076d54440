"""Reading the corpus tables, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def version(spark: SparkSession, folder: str, name: str) -> tuple:
    """Files of a table with their sizes and times: another value when the data change."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return tuple(sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path)))


def table_stream(
    spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The same table as a stream of files; works for a folder and for a single file."""
    schema = table(spark, folder, name).schema
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if fs.getFileStatus(path).isDirectory():
        return reader.parquet(f"{folder}/{name}.parquet")
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
