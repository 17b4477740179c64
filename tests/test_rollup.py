"""The profile kept up by batch against a scan of the whole current table."""

import random

import pytest
from pyspark.sql import functions as F

from reelspark.operators import profile, rollup
from reelspark.sources.store import RatingsStore

SCHEMA = "userId INT, movieId INT, rating FLOAT, timestamp BIGINT, batch_id STRING, batch_seq BIGINT, imported_at TIMESTAMP"


def batch(spark, number, seed, n=300):
    """Ratings of a few users and movies, so that most batches replace some; one user holds a third."""
    rng = random.Random(seed)
    rows = [
        (7 if rng.random() < 1 / 3 else rng.randrange(0, 20_000, 700), rng.choice([1, 2, 3, 32_768, 32_769, 70_000]),
         rng.randrange(1, 11) / 2, rng.randrange(2), f"b{number}", number, None)
        for _ in range(n)
    ]
    unique = {(r[0], r[1], r[3]): r for r in rows}
    return spark.createDataFrame(list(unique.values()), SCHEMA)


@pytest.fixture
def store(spark, tmp_path):
    made = RatingsStore(spark, str(tmp_path / "store"), slices=2)
    made.init_schema()
    return made


def plain(frame, digits=6):
    return sorted(tuple(round(v, digits) if isinstance(v, float) else v for v in row) for row in frame.collect())


def same_as_scan(store, movies):
    state, now = store.profile(), store.current()
    names = ["total_ratings", "users", "movies_rated", "avg_rating", "rating_std", "catalog_size"]
    assert plain(rollup.overview(state, movies).select(*names)) == plain(profile.dataset_overview(now, movies).select(*names))
    assert plain(rollup.sparsity(state)) == plain(profile.matrix_sparsity(now))
    assert plain(rollup.distribution(state)) == plain(profile.rating_distribution(now.withColumn("rating", F.col("rating").cast("double"))))
    assert plain(rollup.cold_start(state)) == plain(profile.cold_start_summary(now))
    for kind, key in (("user", "userId"), ("movie", "movieId")):
        assert plain(rollup.entities(state, kind).select(key, "mean_rating", "n")) == plain(profile.entity_means(now, key))
    nothing = now.limit(0)
    once = rollup.merge(rollup.part(rollup.changes(nothing, now)))
    assert plain(rollup.version(state)) == plain(rollup.version(once))
    assert plain(rollup.ranges(state)) == plain(rollup.ranges(once)) and rollup.differing_ranges(state, once).isEmpty()


def test_every_batch_leaves_the_profile_of_a_scan(spark, store, movies_of):
    for number in range(1, 4):
        store.publish(batch(spark, number, number))
        if number == 3:
            store.compact()  # merged before the profile has seen it
        assert store.update_profile() == [number] and store.update_profile() == []
        if number == 2:
            store.compact()
    same_as_scan(store, movies_of([1, 2, 3]))


def test_batches_in_any_order_give_one_version(spark, tmp_path, movies_of):
    versions = set()
    for order in ([1, 2, 3], [3, 1, 2]):
        store = RatingsStore(spark, str(tmp_path / f"s{order[0]}"), slices=2)
        store.init_schema()
        for number in order:
            store.publish(batch(spark, number, number, 60))
            store.update_profile()
        versions.add(tuple(rollup.version(store.profile()).first()))
    assert len(versions) == 1
    same_as_scan(store, movies_of([1]))


def test_versions_name_the_ranges_that_differ(spark, store):
    store.publish(batch(spark, 1, 1))
    store.update_profile()
    before = store.profile()
    users = {r["userId"] for r in store.current().select("userId").distinct().collect()}
    changed = next(u for u in sorted(users) if u > rollup.RANGE_USERS)
    one = store.current(user=changed).limit(1).withColumn("rating", F.lit(9.5).cast("float"))
    store.publish(one.withColumn("batch_seq", F.lit(2).cast("bigint")))
    store.publish(spark.createDataFrame([(100_000, 1, 3.0, 1, "b3", 3, None)], SCHEMA))
    store.update_profile()
    found = {r["range_no"]: (r["n_one"], r["n_other"]) for r in rollup.differing_ranges(before, store.profile()).collect()}
    assert set(found) == {changed // rollup.RANGE_USERS, 100_000 // rollup.RANGE_USERS}
    assert found[100_000 // rollup.RANGE_USERS] == (0, 1) and len(set(found[changed // rollup.RANGE_USERS])) == 1


def test_same_ratings_again_change_nothing(spark, store):
    first = batch(spark, 1, 1, 50)
    store.publish(first)
    store.update_profile()
    before = plain(rollup.version(store.profile()))
    store.publish(first.withColumn("batch_seq", F.lit(2).cast("bigint")))
    assert store.update_profile() == [2] and plain(rollup.version(store.profile())) == before


def test_empty_profile(spark, store, movies_of):
    row = rollup.overview(store.profile(), movies_of([1])).first()
    assert (row["total_ratings"], row["users"], row["avg_rating"], row["catalog_size"]) == (0, 0, None, 1)
    assert rollup.version(store.profile()).first()["n"] == 0 and rollup.ranges(store.profile()).isEmpty()


def test_states_hold_no_row_per_rating(spark, store):
    """A part's size follows users and movies of the batch, and bitmaps come per bucket of ids."""
    store.publish(batch(spark, 1, 1, 3000))
    store.update_profile()
    state = store.profile()
    bitmaps = state.where("bits IS NOT NULL").groupBy("kind").count().collect()
    # Ids from 1 on fill buckets of 32,768; user 0 lies in the one before them.
    assert {r["kind"]: r["count"] for r in bitmaps} == {"user_ids": 2, "movie_ids": 3}


def test_changes_in_one_pass(spark):
    """Known and fresh batches in any order; rows of an update are read once, and the part's input once."""
    rows = spark.createDataFrame(
        [(1, 1, 0, 2.0, 1), (1, 1, 0, 3.0, 3), (2, 1, 0, 4.0, 1), (3, 1, 0, 5.0, 3), (4, 1, 0, 1.0, 5), (4, 1, 0, 2.0, 3), (5, 1, 0, 1.0, 1), (5, 1, 0, 1.0, 3)],
        "userId INT, movieId INT, timestamp BIGINT, rating DOUBLE, batch_seq BIGINT",
    )
    found = rollup.changes_within(rows, "batch_seq", ~F.col("batch_seq").isin([3]))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    # User 4's known row is newer than the fresh one, user 5's rating stays, user 2 has no fresh row.
    assert sorted((r["userId"], r["rating"], r["old_rating"]) for r in found.collect()) == [(1, 3.0, 2.0), (3, 5.0, None)]


def test_an_update_reads_its_rows_once(spark, store, monkeypatch):
    """Above the broadcast budget as well."""
    from reelspark.sources import store as module

    for first, budget in ((1, 0), (3, 1 << 20)):
        monkeypatch.setattr(module, "BROADCAST_BYTES", budget)
        seen = []
        monkeypatch.setattr(module.rollup, "part", lambda changed, part=rollup.part: seen.append(changed) or part(changed))
        for number in (first, first + 1):
            store.publish(batch(spark, number, number))
            store.update_profile()
        monkeypatch.undo()
        assert all(len(changed.inputFiles()) and "HashAggregate" not in changed._jdf.queryExecution().toString() for changed in seen)
    same = rollup.merge(rollup.part(rollup.changes(store.current().limit(0), store.current())))
    assert plain(rollup.version(store.profile())) == plain(rollup.version(same))
