"""Positions, exact cuts and samples against plain sorting, with hot keys and hot copies."""

import hashlib

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from reelspark.functions.scalar import row_hash
from reelspark.operators.ordering import count_copies, expand_copies, ordered_prefix, rank_split, with_offsets
from reelspark.operators.sampling import capped_train_rows, effective_cap, random_split, sample_rows


def skewed(n=600):
    """A third of all rows are copies of one row, another third belong to one user."""
    copies = [(7, 7, 3.0, 7)] * (n // 3)
    hot = [(1, i, 0.5 + (i % 10) / 2, i) for i in range(n // 3)]
    rest = [(i % 50 + 10, i, 4.0, i * 3) for i in range(n // 3)]
    return copies + hot + rest


def test_positions_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("x"))
    rows = with_offsets(df, ["x"]).orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(1000))
    assert [r["x"] for r in rows] == sorted(r["x"] for r in rows)


def test_running_totals_exclude_the_row(spark):
    df = spark.createDataFrame([(i, i % 4 + 1, 2) for i in range(200)], "x INT, w INT, v INT")
    rows = with_offsets(df, ["x"], {"ws": "w", "vs": "v"}).orderBy("x").collect()
    total = 0
    for r in rows:
        assert (r["ws"], r["vs"]) == (total, 2 * r["x"])
        total += r["w"]


def test_copies_round_trip(spark, ratings_of):
    rows = skewed()
    back = expand_copies(count_copies(ratings_of(rows)), "copies").collect()
    assert sorted(map(tuple, back)) == sorted(rows)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(min_value=0, max_value=700))
def test_cut_takes_exactly_n_rows(ratings_of, n):
    rows = skewed()
    df = ratings_of(rows)
    split = rank_split(df, row_hash(*df.columns), n, "picked").collect()
    assert sorted(tuple(r)[:4] for r in split) == sorted(rows)
    digest = lambda r: hashlib.md5(f"42:{r[0]}:{r[1]}:{r[2]}:{r[3]}".encode()).hexdigest()
    expected = sorted(rows, key=lambda r: (digest(r), r))[:n]
    assert sorted(tuple(r)[:4] for r in split if r["picked"]) == sorted(expected)


def test_random_split_share_and_partition(ratings_of):
    rows = skewed(300)
    split = random_split(ratings_of(rows)).collect()
    assert len(split) == 300 and sum(r["is_test"] for r in split) == 60


def test_sample_is_reproducible_and_capped(ratings_of):
    df = ratings_of(skewed(300))
    first, second = sample_rows(df, 50), sample_rows(df.repartition(7), 50)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))
    assert sample_rows(df, 10_000).count() == 300


def test_prefix_matches_sorted_rows(ratings_of):
    rows = skewed()
    for n in (1, 150, 250, 599, 5000):
        taken = ordered_prefix(ratings_of(rows), ["userId", "movieId"], n).collect()
        expected = sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3]))[:n]
        assert sorted(map(tuple, taken)) == sorted(expected)


def test_cap_rounds_up_to_whole_pages(ratings_of):
    assert effective_cap(4_000_000, 200_000) == 4_000_000
    assert effective_cap(250, 100) == 300
    assert capped_train_rows(ratings_of(skewed()), 250, 100).count() == 300


def test_offsets_keep_columns_of_any_name(spark):
    rows = [(i % 7, 100 - i, f"p{i}", i * i) for i in range(60)]
    df = spark.createDataFrame(rows, "k INT, _row INT, _part STRING, _s_pos INT")
    got = with_offsets(df, ["k", "_row"]).collect()
    ordered = sorted(rows, key=lambda r: (r[0], r[1]))
    assert sorted((r["pos"], *r[:4]) for r in got) == [(i, *r) for i, r in enumerate(ordered)]
    weighted = with_offsets(df, ["k", "_row"], {"start": "_s_pos"}).collect()
    before = 0
    for row, found in zip(ordered, sorted(weighted, key=lambda r: (r["k"], r["_row"])), strict=True):
        assert tuple(found[:4]) == row and found["start"] == before
        before += row[3]
