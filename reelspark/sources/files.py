"""CSV reading by name, CSV writing, and file moves on the cluster's file system."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelspark.constants import MOVIE_COLUMNS, REQUIRED_COLUMNS
from reelspark.operators.ingest import valid_rows
from reelspark.sources.schema import require_columns


def read_text_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All columns as text, named by the header; files read at once must share one."""
    return spark.read.option("header", True).csv(paths)


def files_by_header(spark: SparkSession, paths: str | list[str]) -> dict[str, list[str]]:
    """First line -> the files that begin with it. The driver gets names only, as in any listing."""
    lines = with_file_order(spark.read.text(paths)).where("_block = 0")
    firsts = lines.groupBy("_file").agg(F.min_by("value", "_line").alias("header"))
    # File paths are percent-encoded, but a plus sign stands for itself.
    path = F.url_decode(F.replace("_file", F.lit("+"), F.lit("%2B")))
    plain = F.regexp_replace(path, r"([\\*?\[\]{}])", r"\\$1")
    return dict(firsts.groupBy("header").agg(F.sort_array(F.collect_list(plain))).collect())


def read_ratings_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Valid ratings of CSV files, each bound by its own header, so column order is free in every file."""
    groups = files_by_header(spark, paths)
    parts = []
    for group in groups.values() if len(groups) > 1 else [paths]:
        raw = read_text_csv(spark, group)
        require_columns(raw.columns)
        parts.append(valid_rows(raw))
    return reduce(DataFrame.unionByName, parts)


def read_movies_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(paths)
    require_columns(raw.columns, MOVIE_COLUMNS)
    return raw.select(F.col("movieId").try_cast("int").alias("movieId"), "title", "genres").dropna(subset=["movieId"])


def with_file_order(raw: DataFrame) -> DataFrame:
    """Adds the position of each row within its files, comparable inside one read."""
    return raw.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_batches_csv(rows: DataFrame, path: str, label: Column, order: Sequence[str]) -> None:
    """One folder ``batch_id=<label>`` of CSV files with headers per batch, rows in ``order``."""
    named = rows.withColumn("batch_id", label)
    # Range partitions on the full order: a large batch becomes several files, in order.
    laid_out = named.repartitionByRange("batch_id", *order).sortWithinPartitions("batch_id", *order)
    laid_out.select(*REQUIRED_COLUMNS, "batch_id").write.mode("overwrite").option("header", True).partitionBy(
        "batch_id"
    ).csv(path)


def write_batch_files(rows: DataFrame, folder: str, label: Column, order: Sequence[str]) -> None:
    """One file ``<label>.csv`` with header per batch, rows in ``order``; a batch too large for one
    task goes on in ``<label>-0002.csv`` and so on. Spark writes the files, the driver only names them."""
    spark = rows.sparkSession
    parts = f"{folder.rstrip('/')}/_parts"
    write_batches_csv(rows, parts, label, order)
    fs = _fs(spark, parts)
    for name in list_names(spark, parts):
        if "=" not in name:
            continue
        written = [n for n in list_names(spark, f"{parts}/{name}") if n.endswith(".csv")]
        stem = name.split("=", 1)[1]
        for number, part in enumerate(written, start=1):
            target = f"{folder.rstrip('/')}/{stem}{'' if number == 1 else f'-{number:04d}'}.csv"
            if not fs.rename(_path(spark, f"{parts}/{name}/{part}"), _path(spark, target)):
                raise OSError(f"could not name {target}")
    fs.delete(_path(spark, parts), True)


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _fs(spark: SparkSession, text: str):
    return _path(spark, text).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted entry names of a folder; empty when it does not exist."""
    if not exists(spark, path):
        return []
    return sorted(status.getPath().getName() for status in _fs(spark, path).listStatus(_path(spark, path)))


def holds_csv(spark: SparkSession, path: str) -> bool:
    """Whether a folder has a CSV file somewhere below it."""
    fs, found = _fs(spark, path), None
    if not fs.getFileStatus(_path(spark, path)).isDirectory():
        return False
    found = fs.listFiles(_path(spark, path), True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(".csv"):
            return True
    return False


def move(spark: SparkSession, source: str, folder: str, spare: str | None = None) -> str:
    """Move a file or folder into ``folder``, under the name ``spare`` if its own is taken there."""
    fs = _fs(spark, source)
    fs.mkdirs(_path(spark, folder))
    target = f"{folder.rstrip('/')}/{_path(spark, source).getName()}"
    if spare is not None and fs.exists(_path(spark, target)):
        target = f"{folder.rstrip('/')}/{spare}"
    if not fs.rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"could not move {source} to {target}")
    return target


def published(spark: SparkSession, path: str) -> bool:
    """Whether a written folder is complete."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def claim(spark: SparkSession, path: str, owner: str) -> bool:
    """Put a file where none is: true for the one caller that makes it, whoever else tries.

    The file holds ``owner``. It needs a file system whose create without overwrite is atomic, as
    HDFS has; local files are made by the system's own exclusive create.
    """
    fs, target, jvm = _fs(spark, path), _path(spark, path), spark._jvm
    fs.mkdirs(target.getParent())
    if fs.getScheme() == "file":
        local = jvm.java.io.File(target.toUri().getPath())
        if not local.createNewFile():
            return False
        out = jvm.java.io.FileOutputStream(local)
    else:
        try:
            out = fs.create(target, False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                return False
            raise
    try:
        out.write(bytearray(owner.encode()))
    finally:
        out.close()
    return True


def claimed_by(spark: SparkSession, path: str) -> str | None:
    """Who holds a claim; empty while it is being written, None without one."""
    if not exists(spark, path):
        return None
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def claim_number(spark: SparkSession, folder: str, after: int, owner: str) -> int:
    """The first free number above ``after``, or the one ``owner`` already holds there."""
    number = after + 1
    while True:
        path = f"{folder.rstrip('/')}/{number:012d}"
        if claim(spark, path, owner) or claimed_by(spark, path) == owner:
            return number
        number += 1


def last_claim(spark: SparkSession, folder: str) -> int | None:
    numbers = [int(name) for name in list_names(spark, folder) if name.isdigit()]
    return max(numbers, default=None)
