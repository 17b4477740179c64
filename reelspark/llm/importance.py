"""Importance resampling: documents drawn as if from a target distribution of hashed n-grams.

Gains per bucket are one array of fixed length, so a document is scored without a join. The cutoff of the draw is
bracketed by a quantile sketch, exact counts outside validate the bracket, and only the bracket is sorted.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from reelspark.llm.spelling import lower_ascii
from reelspark.llm.text import only
from reelspark.operators.ordering import with_offsets
from reelspark.session import materialise

# The signs of a word, and the scale of gains and scores.
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
SCALE = 1000

BUCKETS = 10_000
SKETCH_ACCURACY = 10_000
MARGIN = 0.002


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(1))


def with_features(docs: DataFrame, buckets: int, *keep: str) -> DataFrame:
    """The kept columns, n_words, and the buckets of all single words and pairs of neighbours."""
    words = docs.select(*keep, words_of(F.col("text")).alias("words"))
    bucket = lambda feature: F.pmod(F.crc32(feature.cast("binary")), F.lit(buckets)).cast("int")
    pairs = F.zip_with(
        F.slice("words", F.lit(1), F.greatest(F.size("words") - 1, F.lit(0))),
        F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0))),
        lambda left, right: bucket(F.concat(left, F.lit(" "), right)),
    )
    found = F.concat(F.transform("words", bucket), pairs)
    return words.select(*keep, F.size("words").cast("long").alias("n_words"), found.alias("buckets"))


def _counts(featured: DataFrame, buckets: int) -> list[int]:
    """Occurrences per bucket; the driver gets one number per bucket."""
    counts = [0] * buckets
    rows = featured.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)))
    for bucket, n in rows.collect():
        counts[bucket] = n
    return counts


def gains(raw: list[int], target: list[int]) -> list[int]:
    """Scaled log ratio of smoothed target and raw shares, per bucket."""
    raw_all, target_all = float(sum(raw) + len(raw)), float(sum(target) + len(raw))
    return [math.floor(SCALE * math.log((t + 1) * raw_all / ((s + 1) * target_all))) for s, t in zip(raw, target, strict=True)]


def with_scores(featured: DataFrame, gain: list[int], seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight and score; ``_tie`` tells equal rows apart."""
    table = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<bigint>")  # folded once into a literal
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda sum_, b: sum_ + F.get(table, b.cast("int")))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))
    n = F.size("buckets")
    scored = featured.select(
        "doc_id", "n_words", n.cast("long").alias("n_features"),
        F.when(n > 0, F.floor(total / n)).otherwise(F.lit(0)).cast("long").alias("weight"), noise.alias("noise"),
    )
    return scored.withColumn("score", F.col("weight") + F.col("noise")).drop("noise").withColumn("_tie", F.monotonically_increasing_id())


def _bracket(scores: DataFrame, rows: int, wanted: int, margin: float, accuracy: int) -> tuple[int, int, int]:
    """(low, high, above): the row of rank ``wanted`` has a score from low to high, and ``above`` rows lie higher.

    The sketch proposes; exact counts outside accept the bracket or have it widened until it holds.
    """
    share = 1 - wanted / rows
    while True:
        ends = [max(0.0, share - margin), min(1.0, share + margin)]
        low, high = scores.agg(F.percentile_approx("score", ends, accuracy)).first()[0]
        if ends[0] == 0.0 or ends[1] == 1.0:  # beyond the sketch's ends nothing may lie
            least, most = scores.agg(F.min("score"), F.max("score")).first()
            low, high = (least if ends[0] == 0.0 else low), (most if ends[1] == 1.0 else high)
        outside = scores.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score") >= low)).first()
        if outside[0] < wanted <= outside[1]:
            return low, high, outside[0]
        margin *= 4


ORDER = ["_below", "_missing", "doc_id", "n_features", "weight", "_tie"]


def _ordered(scored: DataFrame) -> DataFrame:
    """Columns that sort the highest score first, ties by doc_id with null last."""
    return scored.withColumn("_below", -F.col("score")).withColumn("_missing", F.col("doc_id").isNull())


def cutoff(ordered: DataFrame, wanted: int, rows: int, margin: float = MARGIN, accuracy: int = SKETCH_ACCURACY) -> Column:
    """Whether a row is among the first ``wanted`` of ``rows``: only the bracket around the last of them is sorted."""
    if wanted <= 0:
        return F.lit(False)
    low, high, above = _bracket(ordered.select("score"), rows, wanted, margin, accuracy)
    inside = with_offsets(ordered.where(F.col("score").between(low, high)).select(*ORDER), ORDER)
    last = inside.where(F.col("pos") == wanted - above - 1).first()
    return reduce(
        lambda rest, name: F.coalesce(F.col(name) < F.lit(last[name]), F.lit(False))
        | (F.col(name).eqNullSafe(F.lit(last[name])) & rest),
        reversed(ORDER), F.lit(True),
    )


def resample(
    docs: DataFrame, target: DataFrame, pct: int = 25, least_words: int = 20, buckets: int = BUCKETS, seed: int = 7,
    doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score, and rank (null unless drawn).

    Drawn are ``pct`` per cent, rounded down, of the documents with at least ``least_words`` words: those of the highest
    scores, ties to the smaller doc_id. Null and empty texts have no features and weight 0; rows without doc_id
    come last among equal scores; repeated rows are drawn one by one. An empty target leaves smoothed shares; an
    empty table gives no rows. Texts are read whole. Other columns are left out, whatever their names.
    """
    featured = materialise(with_features(only(docs, doc_id=doc_id, text=text), buckets, "doc_id"))
    wished = with_features(only(target, text=target_text), buckets)
    gain = gains(_counts(featured, buckets), _counts(wished, buckets))
    scored = materialise(with_scores(featured, gain, seed))
    ordered, enough = _ordered(scored), F.col("n_words") >= least_words
    rows = scored.where(enough).count()
    drawn = enough & cutoff(ordered.where(enough), pct * rows // 100, rows)
    ranked = with_offsets(ordered.where(drawn), ORDER).withColumn("rank", F.col("pos") + 1)
    others = ordered.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    names = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(*names).unionByName(others.select(*names))
