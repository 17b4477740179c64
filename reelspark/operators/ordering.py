"""Global positions and exact rank cuts without a single-task sort."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from reelspark.session import fixed_partitions

_ROW_BITS = 33
_DIGITS = 4
_SMALL_BUCKET = 100_000


def with_offsets(df: DataFrame, order: Sequence[str], weights: Mapping[str, str] | None = None) -> DataFrame:
    """Add exclusive running totals over the global order of ``order``.

    ``weights`` maps a new column to the column it accumulates; without it the
    new column ``pos`` is the zero-based position. Rows are range-partitioned and
    checkpointed, so the partition boundaries are the same in both passes; only
    one total per partition is brought together. Weights are whole numbers.
    """
    row, part = _free("_row", df), _free("_part", df)
    ordered = fixed_partitions(df.repartitionByRange(*order).sortWithinPartitions(*order))
    row_id = F.monotonically_increasing_id()
    tagged = ordered.withColumn(row, row_id).withColumn(part, F.shiftright(row, _ROW_BITS))
    if weights is None:
        local = tagged.withColumn("pos", F.col(row) - F.shiftleft(part, _ROW_BITS))
        names = {"pos": F.count(F.lit(1))}
    else:
        local = _running_totals(tagged.drop(row), weights)
        names = {name: F.sum(source) for name, source in weights.items()}
    start = {name: _free(f"_s_{name}", df) for name in names}
    totals = tagged.groupBy(part).agg(*[value.alias(f"_t_{name}") for name, value in names.items()])
    # One row per partition of the range sort: bounded by the partition count.
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        part, *[F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0)).alias(start[name]) for name in names]
    )
    joined = local.join(F.broadcast(starts), part)
    return joined.select(*df.columns, *[(F.col(name) + F.col(start[name])).alias(name) for name in names])


def _free(name: str, df: DataFrame) -> str:
    """A name that no column of ``df`` has."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _running_totals(df: DataFrame, weights: Mapping[str, str]) -> DataFrame:
    """Exclusive running totals inside each partition, in its row order; no further shuffle."""
    sources = dict(weights)
    names = [*df.columns, *sources]

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = dict.fromkeys(sources, 0)
        for batch in batches:
            columns = list(batch.columns)
            for name, source in sources.items():
                values = batch.column(source).to_numpy(zero_copy_only=False).astype(np.int64)
                upto = np.cumsum(values) + before[name]
                columns.append(pa.array(upto - values))
                before[name] = int(upto[-1]) if upto.size else before[name]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType([*df.schema.fields, *[T.StructField(name, T.LongType()) for name in sources]])
    return df.mapInArrow(accumulate, schema)


def count_copies(df: DataFrame) -> DataFrame:
    """Collapse identical rows into one with ``copies``, combined before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))


def _find_cut(hashed: DataFrame, n: int | None, share: float | None) -> tuple[str, int, int] | None:
    """The digest of the n-th row, how many rows with it are inside the cut, and how many exist.

    Histograms over four more digits at a time, at most 65,536 buckets each whatever the
    size of the data, narrow the search until one bucket is small or holds one digest.
    """
    prefix = ""
    rows = hashed
    while True:
        digits = F.substring("_digest", 1, len(prefix) + _DIGITS).alias("bucket")
        found = rows.groupBy(digits).agg(F.count(F.lit(1)).alias("rows")).toArrow().sort_by("bucket")
        counts = found["rows"].to_numpy()
        upto = np.cumsum(counts)
        if n is None:
            n = math.ceil(share * (int(upto[-1]) if len(upto) else 0))
        if n <= 0 or not len(upto) or upto[-1] < n:
            return None
        hit = int(np.searchsorted(upto, n))
        n -= int(upto[hit] - counts[hit])
        prefix = found["bucket"][hit].as_py()
        rows = hashed.where(F.col("_digest").startswith(prefix))
        if counts[hit] <= _SMALL_BUCKET:
            few = rows.groupBy("_digest").agg(F.count(F.lit(1)).alias("rows")).toArrow().sort_by("_digest")
            upto = np.cumsum(few["rows"].to_numpy())
            hit = int(np.searchsorted(upto, n))
            copies = few["rows"][hit].as_py()
            return few["_digest"][hit].as_py(), n - int(upto[hit]) + copies, copies
        ends = rows.agg(F.min("_digest").alias("low"), F.max("_digest").alias("high")).first()
        if ends["low"] == ends["high"]:
            return ends["low"], n, int(counts[hit])


def rank_split(
    df: DataFrame, digest: Column, n: int | None = None, flag: str = "selected", share: float | None = None
) -> DataFrame:
    """Mark exactly the first ``n`` rows in the order of a hex digest, then of all columns;
    ``share`` asks for ceil(share * rows) instead.

    Once the digest of the last row is known, every row is decided by its own digest:
    nothing is sorted or shuffled, save the copies of that one row if the cut divides them.
    """
    columns = df.columns
    hashed = df.withColumn("_digest", digest)
    found = _find_cut(hashed, n, share)
    if found is None:
        return df.withColumn(flag, F.lit(n is not None and n > 0))
    last, inside, copies = found
    if inside == copies:
        return hashed.select(*columns, (F.col("_digest") <= last).alias(flag))

    decided = hashed.where(F.col("_digest") != last).select(*columns, (F.col("_digest") < last).alias(flag))
    # One distinct row unless digests collide; its copies count once, with a weight.
    tied = count_copies(hashed.where(F.col("_digest") == last).select(*columns))
    before = F.sum("copies").over(Window.orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1))
    taken = F.greatest(F.lit(0), F.least(F.col("copies"), F.lit(inside) - F.coalesce(before, F.lit(0))))
    parts = tied.withColumn("_take", taken)
    pieces = F.array(
        F.struct(F.lit(True).alias("flag"), F.col("_take").alias("n")),
        F.struct(F.lit(False).alias("flag"), (F.col("copies") - F.col("_take")).alias("n")),
    )
    repeated = (
        parts.select(*columns, F.explode(pieces).alias("_piece"))
        .where(F.col("_piece.n") > 0)
        .select(*columns, F.col("_piece.flag").alias(flag), F.col("_piece.n").alias("_n"))
    )
    return decided.unionByName(expand_copies(repeated, "_n"))


def expand_copies(df: DataFrame, copies: str) -> DataFrame:
    """One row per copy; the copies of a hot row are cut into pieces over many tasks."""
    piece = 1_000_000
    last = F.ceil(F.col(copies) / piece) - 1
    pieces = df.withColumn("_piece_no", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    size = F.least(F.lit(piece).cast("bigint"), F.col(copies) - F.col("_piece_no") * piece)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = pieces.repartition(tasks, *pieces.columns)
    repeated = F.explode(F.sequence(F.lit(1).cast("bigint"), size))
    return spread.withColumn("_copy_no", repeated).drop("_copy_no", "_piece_no", copies)


def ordered_prefix(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in the order of ``order``, ties broken by the other columns.

    Counts per leading key find the last key needed, so only rows up to it are sorted.
    """
    lead = order[0]
    per_key = df.groupBy(lead).agg(F.count(F.lit(1)).alias("_rows"))
    reach = with_offsets(per_key, [lead], {"_start": "_rows"}).where(F.col("_start") < n)
    last = reach.agg(F.max(lead).alias("last")).first()["last"]
    if last is None:
        return df.limit(0)
    rest = [name for name in df.columns if name not in order]
    distinct = with_offsets(count_copies(df.where(F.col(lead) <= last)), [*order, *rest], {"_start": "copies"})
    kept = F.least(F.col("copies"), F.lit(n) - F.col("_start"))
    return expand_copies(distinct.where(F.col("_start") < n).withColumn("_n", kept).drop("_start", "copies"), "_n")
