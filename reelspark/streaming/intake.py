"""Batch files in a landing folder, taken in name order into the ratings store.

A stream finds what has landed; what it will not report again (a file sent anew under an old
name) is found by listing the folder. Either way the numbers of the batches are written down
before anything is published, so a replay after any failure publishes the same batches again.
"""

from __future__ import annotations

import csv
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from reelspark.constants import BATCH_PREFIX, REQUIRED_COLUMNS
from reelspark.operators.ingest import KEY, rejected_rows, valid_rows
from reelspark.operators.ordering import with_offsets
from reelspark.session import broadcast_if_small, materialise
from reelspark.sources import files
from reelspark.sources.schema import missing_columns
from reelspark.sources.store import RatingsStore

_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)

_PROGRESS = "entry STRING, batch_seq BIGINT"
_SPLIT_BYTES = 1024
_LINE_BITS = 33  # of a monotonic id: the row within its partition


def feed_landing(spark: SparkSession, incoming: str, landing: str) -> str | None:
    """Move the first incoming batch by name into an empty landing folder."""
    if any(name.endswith(".csv") for name in files.list_names(spark, landing)):
        return None
    waiting = [n for n in files.list_names(spark, incoming) if n.startswith(BATCH_PREFIX) and n.endswith(".csv")]
    return files.move(spark, f"{incoming}/{waiting[0]}", landing) if waiting else None


def batch_id_of(entry: str) -> str:
    """A batch is named by its file stem, or by the value of its partition folder."""
    name = entry.split("=", 1)[-1]
    return name.rsplit(".", 1)[0] if "." in name else name


def _entry_of(path: Column, landing: str) -> Column:
    """The file or folder of the landing folder that a path belongs to."""
    marker = landing.rstrip("/").split(":", 1)[-1] + "/"
    return F.substring_index(F.substring_index(path, marker, -1), "/", 1)


def _numbered(store: RatingsStore, progress: str, key: str, entries: list[str]) -> dict[str, int]:
    """The batch numbers of a trigger: those written down before, else the next ones in name order.

    The store gives each number to one owner, so streams with progress of their own can feed it together.
    """
    spark = store.spark
    path = f"{progress}/numbers/trigger={key}"
    if not files.published(spark, path):
        last = -1
        if files.list_names(spark, f"{progress}/numbers"):
            known = spark.read.schema(_PROGRESS).json(f"{progress}/numbers").agg(F.max("batch_seq")).first()[0]
            last = -1 if known is None else known
        rows = []
        for entry in sorted(entries):
            last = store.claim_batch(f"{progress} {key} {entry}", last)
            rows.append((entry, last))
        spark.createDataFrame(rows, _PROGRESS).coalesce(1).write.mode("overwrite").json(path)
    return {row["entry"]: row["batch_seq"] for row in spark.read.schema(_PROGRESS).json(path).collect()}


def _lines(spark: SparkSession, landing: str, entries: list[str]) -> DataFrame:
    """(_file, _block, _line, value) of all lines of the entries' CSV files."""
    paths = [f"{landing.rstrip('/')}/{entry}" for entry in entries]
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(paths)
    return files.with_file_order(raw)


def _splits(lines: DataFrame, landing: str, table: DataFrame) -> DataFrame:
    """One row per piece of a file that is read at once: its first line's ``_line``, its batch, the header of
    its file, and ``pos``, its place in the order of batches, file names and pieces.

    Only numbers are aggregated over the lines; a second look picks the headers.
    """
    # File paths are percent-encoded, but a plus sign stands for itself.
    decoded = F.url_decode(F.replace(F.col("_file"), F.lit("+"), F.lit("%2B")))
    found = lines.groupBy("_file", "_block").agg(F.min("_line").alias("_first"))
    found = materialise(found.withColumn("_entry", _entry_of(decoded, landing)).join(table, "_entry"))
    starts = found.where("_block = 0").select(F.col("_first").alias("_line"), F.col("_file").alias("_of"))
    starts = broadcast_if_small(starts, starts.count(), _SPLIT_BYTES)
    headers = lines.select("_line", "value").join(starts, "_line")
    headed = found.join(headers.select(F.col("_of").alias("_file"), F.col("value").alias("_header")), "_file")
    return materialise(with_offsets(headed, ["batch_seq", "_file", "_block"]))


def ingest_batches(spark: SparkSession, store: RatingsStore, landing: str, numbers: dict[str, int]) -> list[str]:
    """Publish the given entries under their numbers; returns those of which no file could be taken.

    Every file is bound by its own header, whatever the others of its folder look like; a file that
    lacks required columns is refused by itself. A line's place is one number, so rows of a key meet
    in hash tables. Lines are parsed once; again only if some are to be set aside. Drivers only see
    distinct headers and entries.
    """
    lines = _lines(spark, landing, list(numbers))
    table = spark.createDataFrame([(e, batch_id_of(e), n) for e, n in numbers.items()], "_entry STRING, batch_id STRING, batch_seq BIGINT")
    splits = _splits(lines, landing, broadcast_if_small(table, len(numbers), 512))
    known = broadcast_if_small(splits, splits.count(), _SPLIT_BYTES)
    headers = [row["_header"] for row in splits.select("_header").distinct().collect()]
    names = {header: next(csv.reader([header]), []) for header in headers}
    missing = {header: missing_columns(columns) for header, columns in names.items()}
    body = lines.join(known, ["_file", "_block"]).where((F.col("_block") > 0) | (F.col("_line") > F.col("_first")))
    place = F.shiftleft("pos", _LINE_BITS) + F.col("_line").bitwiseAND(F.lit((1 << _LINE_BITS) - 1))
    body = body.where(F.trim("value") != "").withColumn("_place", place)

    accepted, set_aside, rejected = [], [], []
    for header, columns in names.items():
        if missing[header]:
            continue
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))])
        parsed = body.where(F.col("_header") == header).withColumn("_row", F.from_csv("value", schema.simpleString()[7:-1].replace(":", " ")))
        place_of = {name: i for i, name in reversed(list(enumerate(columns)))}
        typed = parsed.select(
            "batch_id", "batch_seq", "_place", *[F.col(f"_row.c{place_of[name]}").alias(name) for name in REQUIRED_COLUMNS]
        )
        unfit = Observation()
        accepted.append(valid_rows(typed, "_place", unfit=unfit))
        set_aside.append((unfit, rejected_rows(typed, "batch_id", "batch_seq")))
    refused = [(header, f"missing columns: {', '.join(gone)}") for header, gone in missing.items() if gone]
    if refused:
        reasons = spark.createDataFrame(refused, "_header STRING, reason STRING")
        files_of = splits.where("_block = 0").join(reasons, "_header")
        rejected.append(files_of.select("batch_id", "batch_seq", "reason"))
    taken = splits.where(F.col("_header").isin([h for h, gone in missing.items() if not gone])) if names else splits
    taken = {row["_entry"] for row in taken.select("_entry").distinct().collect()}
    unread = sorted(set(numbers) - {row["_entry"] for row in splits.select("_entry").distinct().collect()})
    if unread:
        empty = [(batch_id_of(e), numbers[e], "missing columns: " + ", ".join(sorted(REQUIRED_COLUMNS))) for e in unread]
        rejected.append(spark.createDataFrame(empty, "batch_id STRING, batch_seq BIGINT, reason STRING"))
    if accepted:
        rows = accepted[0]
        for more in accepted[1:]:
            rows = rows.unionByName(more)
        # Numbers only, so a hash table holds them: a struct or a name would be sorted instead.
        latest = rows.groupBy(*KEY).agg(F.max_by("rating", "_place").alias("rating"), F.max("_place").alias("_place"))
        latest = latest.withColumn("pos", F.shiftright("_place", _LINE_BITS)).join(known.select("pos", "batch_id", "batch_seq"), "pos")
        store.publish(latest.withColumn("imported_at", F.current_timestamp()))
    rejected += [rows for unfit, rows in set_aside if unfit.get["n"]]
    if rejected:
        rows = rejected[0]
        for more in rejected[1:]:
            rows = rows.unionByName(more, allowMissingColumns=True)
        for name in REQUIRED_COLUMNS:
            if name not in rows.columns:
                rows = rows.withColumn(name, F.lit(None).cast("string"))
        # Few rows of many: kept, so that laying them out does not parse the lines twice.
        store.reject(materialise(rows))
    return [entry for entry in numbers if entry not in taken]


def run_intake(
    spark: SparkSession,
    store: RatingsStore,
    landing: str,
    processed: str,
    failed: str,
    checkpoint: str,
    after_publish: Callable[[int], None] | None = None,
) -> None:
    """Take everything that lies in ``landing``, then stop.

    Files are moved after their batch is published and ``after_publish`` has succeeded. A replayed
    trigger publishes what has not been moved yet under the numbers written down at first. A file
    sent again under an old name is a new batch with a higher number; its rows replace older ones.
    """
    # A publish replaces the partitions it names, so replays are harmless.
    store.init_schema()

    def take(key: str, entries: list[str], trigger: int) -> None:
        numbers = _numbered(store, checkpoint, key, entries)
        present = {e: n for e, n in numbers.items() if files.exists(spark, f"{landing}/{e}")}
        if not present:
            return
        refused = ingest_batches(spark, store, landing, present)
        if after_publish is not None and len(refused) < len(present):
            after_publish(trigger)
        for entry in sorted(present):
            target = failed if entry in refused else processed
            files.move(spark, f"{landing}/{entry}", target, f"{entry}.{present[entry]}")

    def handle(paths: DataFrame, trigger: int) -> None:
        found = paths.select(_entry_of(F.col("path"), landing).alias("entry")).distinct().collect()
        if found:
            take(f"stream-{trigger}", [row["entry"] for row in found], trigger)

    landed = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        # Age says nothing: a backlog moved in keeps its old times.
        .option("maxFileAge", "36500d")
        .load(landing)
        .select("path")
    )
    query = (
        landed.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # What the stream has seen before under the same name, and listings a failure interrupted.
    names = [n for n in files.list_names(spark, f"{checkpoint}/numbers") if n.startswith("trigger=listing-")]
    last = max((int(n.rsplit("-", 1)[1]) for n in names), default=-1)
    if last >= 0:
        take(f"listing-{last}", [], last)
    waiting = [n for n in files.list_names(spark, landing) if n.endswith(".csv") or files.holds_csv(spark, f"{landing}/{n}")]
    if waiting:
        take(f"listing-{last + 1}", waiting, last + 1)
