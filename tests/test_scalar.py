import numpy as np
from pyspark.sql import functions as F

from reelspark.functions.scalar import clip, dot, file_stem, in_user_sample, is_holdout, round_binary, round_exact
from reelspark.operators.sampling import holdout_rows, train_rows


def test_crc_of_known_texts(spark):
    row = spark.range(1).select(
        F.crc32(F.lit("1:2:timestamp")).alias("a"), F.crc32(F.lit("123:4567:timestamp")).alias("b")
    ).first()
    assert (row["a"], row["b"]) == (1737342705, 192754587)


def test_holdout_uses_the_constant_word(ratings_of):
    df = ratings_of([(1, 2, 3.0, 10), (123, 4567, 3.0, 20)])
    flags = {r["userId"]: r["h"] for r in df.select("userId", is_holdout(10).alias("h")).collect()}
    assert flags == {1: 1737342705 % 100 < 10, 123: 192754587 % 100 < 10}


def test_repeated_pair_stays_on_one_side_and_split_is_a_partition(ratings_of):
    rows = [(u, m, 3.0, t) for u in range(0, 60) for m in range(4) for t in (100, 200)]
    df = ratings_of(rows)
    held = {(r["userId"], r["movieId"], r["timestamp"]) for r in holdout_rows(df).collect()}
    kept = {(r["userId"], r["movieId"], r["timestamp"]) for r in train_rows(df).collect()}
    assert not held & kept
    assert held | kept == {(u, m, t) for u, m, _, t in rows if u % 6 == 0}
    assert {(u, m) for u, m, _ in held}.isdisjoint({(u, m) for u, m, _ in kept})
    assert held


def test_clip_dot_stem_and_sample(spark):
    df = spark.createDataFrame(
        [(6.2, [1.0, 2.0], [3.0, 4.0], "/a/b/ratings_batch_003.csv", 12), (-1.0, [0.5, 0.0], [2.0, 9.0], "x.tar.gz", 13)],
        "s DOUBLE, a ARRAY<DOUBLE>, b ARRAY<DOUBLE>, p STRING, userId INT",
    )
    rows = df.select(
        clip(F.col("s")).alias("c"), dot(F.col("a"), F.col("b")).alias("d"), file_stem(F.col("p")).alias("f"),
        in_user_sample().alias("i"),
    ).collect()
    assert [tuple(r) for r in rows] == [(5.0, 11.0, "ratings_batch_003", True), (0.5, 1.0, "x.tar", False)]


def test_rounding_like_numpy_and_python(spark):
    values = [2.175, 2.125, 2.675, 2.325, 1.005, 4.0, 0.5, *(s / 2 / n for n in range(1, 41) for s in range(1, 10 * n, 7))]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i INT, v DOUBLE")
    rows = df.select("i", round_binary(F.col("v"), 2).alias("b"), round_exact(F.col("v"), 2).alias("e")).orderBy("i").collect()
    assert [r["b"] for r in rows] == list(np.round(values, 2))
    assert [r["e"] for r in rows] == [round(v, 2) for v in values]
