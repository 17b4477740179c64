"""Line deduplication: suffix ranks of line-ID sequences by distributed prefix doubling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reelspark.llm.text import SPACES, count_words, quoted
from reelspark.operators.ordering import with_offsets
from reelspark.session import broadcast_if_small, materialise

MIN_WORDS = 50


def _lines(docs: DataFrame) -> DataFrame:
    """(at, id, digest, seq, line_no, line, words) of all lines with a word; ``at`` numbers the
    rows of ``docs``, ``seq`` counts the lines of one."""
    numbered = F.transform(F.split("_text", "\n"), lambda line, k: F.struct(F.btrim(line, F.lit(SPACES)).alias("line"), k.alias("no")))
    worded = F.filter(numbered, lambda x: x["line"] != "")
    tagged = docs.withColumn("_at", F.monotonically_increasing_id())
    rows = tagged.select("_at", "_id", "_digest", F.posexplode(worded).alias("seq", "x"))
    line = F.unhex(F.md5("x.line")).alias("line")
    return rows.select("_at", "_id", "_digest", "seq", F.col("x.no").alias("line_no"), line, count_words(F.col("x.line")).alias("words"))


def _double(ranked: DataFrame, level: int) -> DataFrame:
    """Ranks of runs of 2^(level+1) lines from those of 2^level: order of the pair (rank here,
    rank 2^level lines on), for runs that occur twice or more; others end here."""
    gap = 1 << level
    along = Window.partitionBy("doc").orderBy("seq")
    ahead = ranked.withColumns({"_next": F.lead("rank", gap).over(along), "_seq": F.lead("seq", gap).over(along)})
    # A missing line between two ranked ones is unique, and so is any run over it.
    pairs = ahead.where(F.col("_seq") == F.col("seq") + gap).select("doc", "seq", "rank", "_next")
    classes = pairs.groupBy("rank", "_next").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    numbered = with_offsets(classes, ["rank", "_next"]).withColumnRenamed("pos", "_new")
    return materialise(pairs.join(numbered, ["rank", "_next"]).select("doc", "seq", F.col("_new").alias("rank")))


def _windows(min_words: int):
    """Shortest runs of ``min_words`` words from each line on and up to each line, named by two
    overlapping ranked runs that cover them."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("doc", "start", "size", "left", "right", "line_nos")}
            for row in batch.to_pylist():
                cells = sorted(row["cells"], key=lambda c: c["seq"])
                at = {c["seq"]: k for k, c in enumerate(cells)}
                upto = np.concatenate([[0], np.cumsum([c["words"] for c in cells])])
                breaks = [0, *[k for k in range(1, len(cells)) if cells[k]["seq"] != cells[k - 1]["seq"] + 1], len(cells)]
                found = set()
                for low, high in zip(breaks, breaks[1:]):
                    for k in range(low, high):
                        stop = int(np.searchsorted(upto[: high + 1], upto[k] + min_words))
                        if stop <= high:
                            found.add((k, stop))
                        start = int(np.searchsorted(upto[: k + 2], upto[k + 1] - min_words, side="right")) - 1
                        if start >= low:
                            found.add((start, k + 1))
                for start, stop in sorted(found):
                    size = stop - start
                    level = size.bit_length() - 1
                    other = at[cells[stop - 1]["seq"]] + 1 - (1 << level)
                    left, right = cells[start]["ranks"], cells[other]["ranks"]
                    if len(left) <= level or len(right) <= level:
                        continue
                    for name, value in zip(out, (
                        row["doc"], cells[start]["seq"], size, left[level], right[level],
                        [c["line_no"] for c in cells[start:stop]],
                    ), strict=True):
                        out[name].append(value)
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))

    return emit


def repeated_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """(_id, _digest, deleted): line numbers of each text that a repeated run deletes."""
    lines = materialise(_lines(docs))
    # Rows that repeat id and text are one document: the lines of one of them stand for all.
    keys = lines.groupBy("_id", "_digest").agg(F.min("_at").alias("_at")).withColumn("_last", F.col("_id").isNull())
    ordered = with_offsets(keys, ["_last", "_id", "_digest"])
    numbered = materialise(ordered.select("_at", "_id", "_digest", F.col("pos").alias("doc")))
    placed = lines.drop("_id", "_digest").join(numbered.select("_at", "doc"), "_at").drop("_at")
    twice = placed.groupBy("line").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("line")
    first = with_offsets(twice, ["line"]).withColumnRenamed("pos", "rank")
    base = materialise(placed.join(first, "line").select("doc", "seq", "line_no", "words", "rank"))
    levels = [base.select("doc", "seq", "rank")]
    while 2 << (len(levels) - 1) <= min_words and not levels[-1].isEmpty():
        levels.append(_double(levels[-1], len(levels) - 1))
    ranks = [level.select("doc", "seq", F.struct(F.lit(k).alias("k"), "rank").alias("r")) for k, level in enumerate(levels)]
    together = ranks[0]
    for level in ranks[1:]:
        together = together.unionByName(level)
    together = together.groupBy("doc", "seq").agg(F.transform(F.sort_array(F.collect_list("r")), lambda r: r["rank"]).alias("ranks"))
    cells = base.select("doc", "seq", "line_no", "words").join(together, ["doc", "seq"])
    cells = cells.groupBy("doc").agg(F.collect_list(F.struct("seq", "line_no", "words", "ranks")).alias("cells"))
    kind = "doc long, start int, size int, left long, right long, line_nos array<int>"
    windows = materialise(cells.mapInArrow(_windows(min_words), kind))
    # The runs with one name are an interval of the suffix order that shares ``size`` lines.
    interval = ["size", "left", "right"]
    firsts = windows.groupBy(*interval).agg(F.min(F.struct("doc", "start")).alias("_first"), F.count(F.lit(1)).alias("_n"))
    firsts = firsts.where("_n > 1").drop("_n")
    later = windows.join(firsts, interval).where(F.struct("doc", "start") > F.col("_first"))
    deleted = later.select("doc", F.explode("line_nos").alias("line_no")).distinct()
    per_doc = deleted.groupBy("doc").agg(F.sort_array(F.collect_list("line_no")).alias("deleted"))
    return materialise(numbered.join(per_doc, "doc").select("_id", "_digest", "deleted"))


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``df``, ``text`` without later copies of repeated runs of lines, and
    ``n_lines``, ``n_deleted``, ``deleted_lines`` (columns of these names are replaced).

    A run is consecutive lines with words; lines are compared without the blanks around them and
    lines without words do not count. Of each run of ``min_words`` words or more that occurs more
    than once in all texts, the first copy (by doc_id, null last, then by text digest and place)
    stays and the lines of later copies go, so a line stays unless it lies inside such a copy.
    Null and blank texts are left as they are. Rows that repeat both doc_id and text count as
    one document and get the same result. An empty table gives no rows; texts are read whole.

    Lines seen once break the sequences; the others get suffix ranks that double their depth per
    round, kept only while they are shared. Any run of length r is named by two ranked runs of a
    power of two that overlap, so its interval in the suffix order is found by one grouping. A
    repeated run of enough words is the union of the shortest such runs from and up to its lines,
    and these have ``min_words`` lines at most: that depth of the suffix order decides everything.
    """
    added = ("n_lines", "n_deleted", "deleted_lines")
    kept = [name for name in df.columns if name not in added]
    # The other columns travel in one struct, so that their names cannot clash with the operator's.
    others = F.struct(*[quoted(name) for name in kept if name != text]).alias("_kept")
    digest = F.unhex(F.md5(quoted(text))).alias("_digest")
    docs = df.select(others, quoted(doc_id).alias("_id"), quoted(text).alias("_text"), digest)
    hits = repeated_lines(docs.select("_id", "_text", "_digest").where("_text IS NOT NULL"), min_words)
    size = hits.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("deleted")), F.lit(0)).alias("lines")).first()
    # Broadcast by its counted bytes; beyond that the texts are shuffled to the hits.
    hits = hits.withColumnsRenamed({"_id": "_hit_id", "_digest": "_hit_digest"})
    hits = broadcast_if_small(hits, 1, 64 * size["n"] + 4 * size["lines"])
    same = docs["_id"].eqNullSafe(hits["_hit_id"]) & (docs["_digest"] == hits["_hit_digest"])
    joined = docs.join(hits, same, "left").withColumn("deleted", F.coalesce("deleted", F.array().cast("array<int>")))
    lines = F.split("_text", "\n")
    left: Column = F.array_join(F.filter(lines, lambda line, k: ~F.array_contains("deleted", k)), "\n")
    shown = F.when(F.size("deleted") > 0, left).otherwise(F.col("_text")).alias(text)
    columns = [shown if name == text else F.col("_kept").getField(name).alias(name) for name in kept]
    return joined.select(
        *columns,
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.size("deleted").alias("n_deleted"),
        F.col("deleted").alias("deleted_lines"),
    )
