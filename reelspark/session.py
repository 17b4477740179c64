"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelspark.constants import BROADCAST_BYTES


def build_session(app: str, master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and local benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A private folder is made only for a local master that names none.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named
    if current is not None:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="reelspark-")
    context.setCheckpointDir(folder)
    return folder


_scope: ContextVar[str | None] = ContextVar("scope", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for the tables ``materialise`` writes inside the block; it goes when the block ends.

    For jobs whose results are stored elsewhere. A query that returns a frame over such tables
    cannot end its block before the frame is read, so its tables stay for the owner of the folder.
    """
    path = f"{shared_folder(spark).rstrip('/')}/scratch/{uuid.uuid4().hex}"
    token = _scope.set(path)
    try:
        yield path
    finally:
        _scope.reset(token)
        remove(spark, path)


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside the block the shuffle files of a query go when it ends, not when the driver next
    collects garbage. A frame run twice shuffles again, so it is for jobs that write what they reuse."""
    with _setting(spark, _SHUFFLE_CLEANUP, "true"):
        yield


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """What is run inside the block goes to Python in batches of about ``size`` bytes, however long its rows are."""
    with _setting(spark, _BATCH_BYTES, str(size)):
        yield


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table this library wrote and no frame reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def table_path(spark: SparkSession) -> str:
    folder = _scope.get() or f"{shared_folder(spark).rstrip('/')}/tables"
    return f"{folder}/{uuid.uuid4().hex}"


def materialise(df: DataFrame, *parts: str, path: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives executor loss,
    keeps column pruning and gives the optimizer the real size. A filter on the columns ``parts``
    (few values) reads their rows only. A ``path`` taken before a ``scratch`` block outlives it."""
    path = path or table_path(df.sparkSession)
    (df.write.partitionBy(*parts) if parts else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def bucketed(df: DataFrame, buckets: int, *keys: str) -> tuple[DataFrame, str]:
    """Like ``materialise``, stored by hash of ``keys`` so that joins and groups on them need no
    shuffle. Also returns the catalogue name, to be dropped when the table is no longer read."""
    name, _ = into_buckets(df.repartition(buckets, *keys), buckets, *keys)
    return df.sparkSession.table(name), name


def into_buckets(
    df: DataFrame, buckets: int, *keys: str, onto: tuple[str, str] | None = None
) -> tuple[str, str]:
    """Store rows that lie by ``keys`` already as a bucketed table, or add them to the table ``onto``.
    Returns its catalogue name and its path, for ``drop_buckets``."""
    name, path = onto or (f"bucketed_{uuid.uuid4().hex}", table_path(df.sparkSession))
    writer = df.write.mode("append").bucketBy(buckets, *keys).option("path", path)
    writer.saveAsTable(name, format="parquet")
    return name, path


def drop_buckets(spark: SparkSession, *tables: tuple[str, str]) -> None:
    for name, path in tables:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(spark, path)


def fixed_partitions(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: like ``materialise``, with partitions and their order kept."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the counted size fits; otherwise Spark shuffles."""
    return F.broadcast(df) if rows * row_bytes <= limit else df
