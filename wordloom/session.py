"""Session helpers: builder defaults and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "wordloom", **conf) -> SparkSession:
    """A session with the settings the library expects; ``conf`` uses ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_roots: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's checkpoint folder.

    A session that names none gets a fresh temporary folder, but only where driver and
    executors are one process; on a cluster that is an error, as nobody else would
    see the files.
    """
    context = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        app = context.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="wordloom-")
        root = _local_roots[app]
    return root.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the work folder that no other run uses."""
    return f"{work_root(spark)}/wordloom/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the work folder and read it back: short lineage that survives
    the loss of any executor. Also returns the path, for :func:`discard`."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, label: str) -> DataFrame:
    return store(df, label)[0]


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table this library wrote and has replaced."""
    if not path.startswith(work_root(spark) + "/wordloom/"):
        raise ValueError(f"not an intermediate table: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` on as many partitions as there are cores, if it has fewer: for heavy work on rows of a few files."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


# Python work per row is heavy next to the size of a row, so tasks of the iterative
# trainers are sized by rows, not by bytes.
_ROWS_PER_TASK = 8_000


def store_spread(df: DataFrame, label: str, rows: int = _ROWS_PER_TASK) -> tuple[DataFrame, str]:
    """:func:`store`, laid out in one file per task-sized number of rows, or more files where cores are free."""
    spark = df.sparkSession
    written, first = store(df, label)
    cores, count = spark.sparkContext.defaultParallelism, written.count()
    most = max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = max(1, min(most, -(-count // rows)), min(cores, -(-count // _ROWS_PER_TASK)))
    out = store(written.repartition(tasks), label)
    discard(spark, first)
    return out
