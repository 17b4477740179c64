"""Sharding: best-fit-decreasing packing of indivisible groups."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from reelspark.llm.text import only, split_count
from reelspark.operators.ordering import with_offsets
from reelspark.session import broadcast_if_small, materialise

LOT_ITEMS = 4_000
FINAL_ITEMS = 20_000
CELLS_PER_SHARD = 512


class BinTree:
    """Bins by remaining capacity in a treap: tightest fitting bin in logarithmic time.

    Priorities are a fixed scramble of the bin number, so the same items give the same bins.
    """

    def __init__(self) -> None:
        self._root: list | None = None  # [key, priority, left, right], key = (room, bin)

    def add(self, room: int, bin_no: int) -> None:
        priority = (bin_no * 0x9E3779B97F4A7C15 + 0x7F4A7C15) % (1 << 64)
        low, high = self._split(self._root, (room, bin_no))
        self._root = self._join(self._join(low, [(room, bin_no), priority, None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least room that holds ``size``."""
        low, high = self._split(self._root, (size, -1))
        if high is None:
            self._root = low
            return None
        found, parent = high, None
        while found[2] is not None:
            found, parent = found[2], found
        if parent is None:
            high = found[3]
        else:
            parent[2] = found[3]
        self._root = self._join(low, high)
        return found[0]

    def _split(self, node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            node[3] = low
            return node, high
        low, high = self._split(node[2], key)
        node[2] = high
        return low, node

    def _join(self, low: list | None, high: list | None) -> list | None:
        if low is None or high is None:
            return high if low is None else low
        if low[1] > high[1]:
            low[3] = self._join(low[3], high)
            return low
        high[2] = self._join(low, high[2])
        return high


def best_fit_decreasing(sizes: np.ndarray, capacity: int, most_bins: int | None = None) -> list[int] | None:
    """Bin of each size, given in decreasing order; an item above the capacity has a bin of its own.
    None if more than ``most_bins`` would be needed."""
    tree, bins, opened = BinTree(), [], 0
    for size in sizes.tolist():
        found = tree.take_tightest(size)
        if found is None:
            if opened == most_bins:
                return None
            found, opened = (max(capacity, size), opened), opened + 1
        tree.add(found[0] - size, found[1])
        bins.append(found[1])
    return bins


def _evenest(sizes: np.ndarray, shards: int) -> list[int]:
    """Packing into ``shards`` bins at the least capacity a binary search finds to suffice."""
    low = max(-(-int(sizes.sum()) // shards), int(sizes[0]))
    high = low + int(sizes[0])
    while (best := best_fit_decreasing(sizes, high, shards)) is None:
        high *= 2
    while low < high:
        middle = (low + high) // 2
        bins = best_fit_decreasing(sizes, middle, shards)
        if bins is None:
            low = middle + 1
        else:
            best, high = bins, middle
    return best


def _decreasing(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.sort_values(["bytes", "item"], ascending=[False, True], kind="stable")


def pack_lots(items: DataFrame, capacity: int, rows: int) -> DataFrame:
    """(item, bytes) -> (item, bytes, cell): best-fit-decreasing in lots of bounded size."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        ordered = _decreasing(frame)
        bins = best_fit_decreasing(ordered["bytes"].to_numpy(), capacity)
        cells = [f"{lot}:{b}" for lot, b in zip(ordered["lot"], bins, strict=True)]
        return pd.DataFrame({"item": ordered["item"], "bytes": ordered["bytes"], "cell": cells})

    lots = split_count(rows, LOT_ITEMS)
    lot = F.pmod(F.xxhash64("item"), F.lit(lots)).alias("lot")
    return items.select("item", "bytes", lot).groupBy("lot").applyInPandas(pack, "item string, bytes long, cell string")


def pack_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(item, bytes) -> (item, shard), bytes per shard as even as whole groups allow.

    A tree: lots of a bounded number of groups are packed best-fit-decreasing into cells of
    1/512 of a shard, cells are the groups of the next level, and the last level (at most
    20,000 cells) goes into the shards at the least capacity that holds all. A level only moves
    (name, bytes) rows. ``shards`` is at most 5,000, as the last level needs cells smaller
    than a shard.
    """
    if not 1 <= shards <= FINAL_ITEMS // 4:
        raise ValueError(f"shards must be between 1 and {FINAL_ITEMS // 4}")
    sums = groups.agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    cells_wanted = min(CELLS_PER_SHARD * shards, FINAL_ITEMS // 4)
    capacity = max(1, -(-(sums["bytes"] or 0) // cells_wanted))
    items, rows, levels = groups, sums["rows"], []
    while rows > FINAL_ITEMS:
        packed = materialise(pack_lots(items, capacity, rows))
        levels.append(packed.select("item", "cell"))
        items = packed.groupBy(F.col("cell").alias("item")).agg(F.sum("bytes").alias("bytes"))
        before, rows = rows, items.count()
        if rows > FINAL_ITEMS and rows > 0.9 * before:
            capacity *= 2  # lots hold too few small items to fill cells

    def last(frame: pd.DataFrame) -> pd.DataFrame:
        ordered = _decreasing(frame)
        bins = _evenest(ordered["bytes"].to_numpy(), shards)
        return pd.DataFrame({"item": ordered["item"], "shard": bins})

    # At most FINAL_ITEMS rows, counted above.
    together = items.withColumn("_all", F.lit(0)).groupBy("_all")
    placed = materialise(together.applyInPandas(last, "item string, shard int"))
    while levels:
        below = levels.pop()
        cells = broadcast_if_small(placed.withColumnRenamed("item", "cell"), rows, 64)
        placed = below.join(cells, "cell").select("item", "shard")
        rows = sums["rows"]
    return placed


def shard_documents(df: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row, equal texts together.

    Size is the UTF-8 bytes of the text plus one. Null texts count as one group of size 1 per row,
    apart from empty texts. Repeated rows belong to the group of their text and get slots of their
    own; slots follow doc_id (null first), then text digest. An empty table gives no rows. Extra
    columns are ignored. Texts are grouped by SHA-256, so no text is shuffled.
    """
    plain = F.coalesce(F.col("text"), F.lit(""))
    sized = materialise(
        only(df, doc_id=doc_id, text=text).select(
            "doc_id",
            (F.octet_length(plain) + 1).cast("bigint").alias("size"),
            F.crc32(plain.cast("binary")).alias("text_crc32"),
            F.coalesce(F.sha2(F.col("text"), 256), F.lit("null")).alias("item"),
        )
    )
    groups = materialise(sized.groupBy("item").agg(F.sum("size").alias("bytes")))
    placed = pack_groups(groups, shards)
    located = with_offsets(sized.join(placed, "item"), ["shard", "doc_id", "item"])
    kept = materialise(located.select("doc_id", "size", "text_crc32", "shard", "pos"))
    # One row per shard: at most 5,000.
    firsts = kept.groupBy("shard").agg(F.min("pos").alias("first"))
    return kept.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("pos") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
