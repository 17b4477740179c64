"""Best-fit packing of documents into sequences by linear grouping.

Lengths are whole numbers up to the capacity, so counts per length (at most ``capacity`` of them,
whatever the corpus) hold all that the plan needs. Large lengths are rounded up within groups of
equal cardinality, the few sizes left are combined into configurations by a linear program with
generated columns, and the small lengths then go best-fit into the room that the actual lengths
leave. The plan speaks of ranks; Spark numbers the pieces by length and gives each its sequence.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reelspark.llm.text import only
from reelspark.operators.ordering import with_offsets
from reelspark.session import materialise

CAPACITY = 1024
END_ID = 2
SMALL_SHARE = 4  # lengths up to capacity / 4 are small
GROUPS = 256
SLICE_CHARS = 1 << 18
ROWS_OUT = 20_000
GAP = 1e-4

PIECE_FIELDS = {
    "doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
}
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Runs(NamedTuple):
    """Consecutive ranks dealt to consecutive bins, ``per`` to each: rank ``start + i`` goes to ``bin + i // per``."""

    start: np.ndarray
    bin: np.ndarray
    per: np.ndarray

    def bins(self, ranks: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.start, ranks, side="right") - 1
        return self.bin[run] + (ranks - self.start[run]) // self.per[run]


@lru_cache(maxsize=2)
def _encoder(path: str):
    """The byte-level vocabulary in the library that encodes it fastest; tests hold its ids against ``tokenizers``."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def text_slices(text: str, chars: int = SLICE_CHARS) -> Iterator[str]:
    """Cuts a text before single blanks between visible signs, about ``chars`` apart.

    The vocabulary's split pattern starts a new unit at each such blank, so the ids of the slices
    are those of the text, and memory follows the slice. A stretch without one stays whole.
    """
    start, size = 0, len(text)
    while size - start > chars:
        at = start + chars
        while True:
            at = text.find(" ", at)
            if at < 0 or at + 1 >= size:
                at = size
                break
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                break
            at += 1
        yield text[start:at]
        start = at
    if start < size:
        yield text[start:]


def token_ids(encoder, text: str | None, end_id: int = END_ID) -> np.ndarray:
    """Ids of a whole text and the closing id, as unsigned 32-bit numbers; strings of special tokens are plain text."""
    parts = [np.asarray(encoder.encode_ordinary(part), dtype="<u4") for part in text_slices(text or "")]
    return np.concatenate([*parts, np.array([end_id], dtype="<u4")])


def cut_lengths(size: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: only the first may be shorter than the capacity."""
    first = size % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, size, capacity))]


def encode_pieces(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None, with_ids: bool = False,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, on request, the ids themselves.

    A null text is empty; an empty text has the closing id alone. Rows that repeat one another are
    documents of their own. Texts of any length are encoded whole, slice by slice.
    """
    vocabulary = path or vocabulary_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        rows: list[tuple] = []
        waiting = 0
        for batch in batches:
            for name, value in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = token_ids(encoder, value.as_py(), end_id)
                for number, (start, length) in enumerate(cut_lengths(len(ids), capacity)):
                    piece = ids[start : start + length]
                    row = (name.as_py(), number, start, length, zlib.crc32(piece.tobytes()))
                    rows.append((*row, piece.astype(np.int32)) if with_ids else row)
                    waiting += length if with_ids else 64
                if waiting >= ROWS_OUT * 64:
                    yield _batch(rows, with_ids)
                    rows, waiting = [], 0
        if rows:
            yield _batch(rows, with_ids)

    schema = PIECE_SCHEMA + (", ids array<int>" if with_ids else "")
    return only(docs, doc_id=doc_id, text=text).mapInArrow(encode, schema)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    fields = PIECE_FIELDS | ({"ids": pa.list_(pa.int32())} if with_ids else {})
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.values(), strict=True)], list(fields))


# The plan: from counts per length, on numbers whose size is bounded by the capacity and the groups.


def round_up(counts: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, demand) of the lengths in decreasing order, in groups of equal cardinality rounded up to
    their largest length; groups with one largest length are one."""
    total = int(counts.sum())
    upto = np.cumsum(counts[::-1])  # items at least as long as length (capacity - i)
    share = -(-total // groups)
    firsts = np.arange(0, total, share)
    largest = len(counts) - 1 - np.searchsorted(upto, firsts, side="right")
    cardinality = np.diff(np.append(firsts, total))
    sizes, where = np.unique(-largest, return_inverse=True)
    return -sizes, np.bincount(where, weights=cardinality).astype(np.int64)


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valued multiset of sizes within the capacity: by number of items, then by room."""
    room_left = np.arange(capacity + 1)[:, None] - sizes[None, :]
    fits, behind = room_left >= 0, np.maximum(room_left, 0)
    best, picks = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):
        reached = np.where(fits, best[behind] + values, -1.0)
        pick = np.argmax(reached, axis=1)
        top = reached[np.arange(capacity + 1), pick]
        pick[top <= best + 1e-12] = -1
        best = np.maximum(best, top)
        picks.append(pick)
    chosen, room = np.zeros(len(sizes), dtype=np.int64), capacity
    for pick in reversed(picks):
        if pick[room] >= 0:
            chosen[pick[room]] += 1
            room -= int(sizes[pick[room]])
    return float(best[capacity]), chosen


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(columns, times): configurations and how often the linear program uses each, to within ``GAP``.

    Simplex over generated columns: the basis has one column per size, the next column is the best
    configuration at the present prices, and the bound from its value tells when to stop. The inverse
    is kept by updates and corrected by Newton steps. ``einsum`` takes no library threads, which
    can hang in a driver that has started a JVM.
    """
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(basis))
    wanted = demand.astype(float)
    for turn in range(50 * len(sizes)):
        if turn % 32 == 31:
            inverse = _corrected(inverse, basis)
        times, prices = np.einsum("ij,j->i", inverse, wanted), inverse.sum(axis=0)
        value, column = best_configuration(sizes, np.maximum(prices, 0), capacity)
        if value <= 1 + 1e-9 or times.sum() <= (prices * wanted).sum() / value * (1 + GAP):
            break
        step = np.einsum("ij,j->i", inverse, column.astype(float))
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, np.maximum(times, 0) / step, np.inf)
        leaves = int(np.argmin(ratio))
        basis[:, leaves] = column
        row = inverse[leaves] / step[leaves]
        inverse = inverse - np.outer(step, row)
        inverse[leaves] = row
    times = np.einsum("ij,j->i", _corrected(inverse, basis), wanted)
    return np.rint(basis).astype(np.int64), np.maximum(times, 0)


def _corrected(inverse: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """One Newton step towards the inverse of the basis."""
    wrong = np.eye(len(basis)) - np.einsum("ij,jk->ik", basis, inverse)
    return inverse + np.einsum("ij,jk->ik", inverse, wrong)


def plan_large(counts: np.ndarray, capacity: int, groups: int) -> tuple[Runs, int]:
    """Bins of the large pieces by rank in decreasing length, and how many bins there are.

    The linear program's times are rounded down; the ranks of a group that no whole configuration
    takes are run by run left over, with bin -1.
    """
    if not counts.any():
        return _runs([]), 0
    sizes, demand = round_up(counts, groups)
    ends = np.cumsum(demand)
    used, found, bins = ends - demand, [], 0
    columns, times = configurations(sizes, demand, capacity)
    for column, often in zip(columns.T, np.floor(times + 1e-9).astype(np.int64).tolist(), strict=True):
        uses = column > 0
        often = min(often, int(((ends - used)[uses] // column[uses]).min()))
        if often:
            for g in np.flatnonzero(uses):
                found.append((int(used[g]), bins, int(column[g])))
                used[g] += often * column[g]
            bins += often
    return _runs(found + [(int(used[g]), -1, int(ends[g] - used[g])) for g in np.flatnonzero(used < ends)]), bins


def plan_small(rooms: np.ndarray, counts: np.ndarray, capacity: int) -> Runs:
    """Bins of the small pieces by rank in decreasing length.

    Bins are numbered by increasing room. Bins of one room are alike, and so are pieces of one
    length, so best-fit is told in runs: the tightest room takes what it holds, bin after bin, and
    these bins join those of the room left. New bins follow the last.
    """
    starts = np.concatenate([[0], np.cumsum(rooms)])
    of_room: list[list[tuple[int, int]]] = [[(int(starts[r]), int(n))] if n else [] for r, n in enumerate(rooms)]
    opened, rank, found = int(rooms.sum()), 0, []

    def fill(first: int, bins: int, room: int, length: int, items: int) -> tuple[int, int]:
        """Deals items to alike bins; returns the items dealt and the bins touched."""
        per = room // length
        full = min(bins, items // per)
        if full:
            found.append((rank, first, per))
            of_room[room - per * length].append((first, full))
        rest = items - full * per
        if full == bins or not rest:
            return full * per, full
        found.append((rank + full * per, first + full, rest))
        of_room[room - rest * length].append((first + full, 1))
        return items, full + 1

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        for room in range(length, capacity + 1):
            while left and of_room[room]:
                first, bins = of_room[room].pop()
                dealt, touched = fill(first, bins, room, length, left)
                if touched < bins:
                    of_room[room].append((first + touched, bins - touched))
                left, rank = left - dealt, rank + dealt
            if not left:
                break
        if left:
            bins = -(-left // (capacity // length))
            dealt, _ = fill(opened, bins, capacity, length, left)
            opened, rank = opened + bins, rank + dealt
    return _runs(found)


def _runs(found: list[tuple[int, int, int]]) -> Runs:
    table = np.array(sorted(found), dtype=np.int64).reshape(-1, 3)
    return Runs(table[:, 0], table[:, 1], table[:, 2])


def bin_of(runs: Runs, rank: Column) -> Column:
    """The bin of a rank: its run is found by bisection in a table of bounded size."""

    @F.pandas_udf("long")
    def look_up(ranks: pd.Series) -> pd.Series:
        return pd.Series(runs.bins(ranks.to_numpy()))

    return look_up(rank)


def _tally(rows: DataFrame, column: str, capacity: int) -> np.ndarray:
    """Rows per value of a column of lengths: at most one row per length comes to the driver."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for value, n in rows.groupBy(column).agg(F.count(F.lit(1))).collect():
        counts[value] = n
    return counts


def _ranked(pieces: DataFrame) -> DataFrame:
    """Ranks in decreasing length; the row number keeps equal rows apart and spreads them."""
    placed = with_offsets(pieces.withColumn("_order", -F.col("length")), ["_order", "doc_id", "piece", "_tie"])
    return placed.drop("_order")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """(doc_id, piece, length, ...) with ``sequence_id`` and ``offset``; pieces follow one another in a
    sequence by doc_id and piece. Lengths lie between 1 and the capacity; full pieces stand alone."""
    columns = pieces.columns
    numbered = materialise(pieces.withColumn("_tie", F.monotonically_increasing_id()))
    counts = _tally(numbered, "length", capacity)
    small = capacity // SMALL_SHARE
    is_small, is_full = F.col("length") <= small, F.col("length") == capacity
    large_counts = counts.copy()
    large_counts[: small + 1] = large_counts[capacity] = 0

    runs, n_bins = plan_large(large_counts, capacity, groups)
    large = _ranked(numbered.where(~is_small & ~is_full)).withColumn("_bin", bin_of(runs, F.col("pos"))).drop("pos")
    large = materialise(large) if large_counts.any() else large
    filled, rest = large.where("_bin >= 0"), numbered.where(is_small).unionByName(large.where("_bin < 0").drop("_bin"))

    bins = filled.groupBy("_bin").agg((F.lit(capacity) - F.sum("length")).alias("_room"))
    ordered = with_offsets(bins, ["_room", "_bin"])
    rooms = _tally(ordered, "_room", capacity)
    placing = plan_small(rooms, _tally(rest, "length", capacity), capacity)
    placed = _ranked(rest).withColumn("_place", bin_of(placing, F.col("pos"))).drop("pos")
    # Places beyond the bins there are name new bins.
    named = ordered.select(F.col("pos").alias("_place"), "_bin")
    placed = placed.join(named, "_place", "left").withColumn("_bin", F.coalesce("_bin", "_place")).drop("_place")

    # Bins hold a capacity of pieces at most, so a window over one is bounded.
    before = Window.partitionBy("_bin").orderBy("doc_id", "piece", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
    # Full pieces are named below zero, so the names never meet.
    alone = numbered.where(is_full).select(*columns, (-1 - F.col("_tie")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return filled.unionByName(placed).select(*columns, F.col("_bin").alias("sequence_id"), offset).unionByName(alone)


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None, groups: int = GROUPS,
    with_ids: bool = False, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Documents as token sequences of at most ``capacity`` ids, in few sequences.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ``ids``).
    A null or empty text is the closing id alone; repeated rows and rows without doc_id are packed
    one by one; a table without rows gives none. Other columns are left out, whatever their names.
    """
    return pack_pieces(encode_pieces(docs, capacity, end_id, path, with_ids, doc_id, text), capacity, groups)
