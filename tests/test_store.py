"""The merged table, its access paths, and writers that work at once."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from reelspark.operators import registry as ops
from reelspark.operators.ingest import latest_by_key
from reelspark.sources import files
from reelspark.sources.models import Registry
from reelspark.sources.store import RatingsStore
from reelspark.streaming.intake import run_intake

HEADER = "userId,movieId,rating,timestamp\n"


def batch(spark, number, users, movies, seed):
    """Every (user, movie) of the ranges once, with a rating that tells the batch."""
    rows = spark.range(len(users) * len(movies)).select(
        (F.lit(users.start) + F.floor(F.col("id") / len(movies))).cast("int").alias("userId"),
        (F.lit(movies.start) + F.col("id") % len(movies)).cast("int").alias("movieId"),
        (F.lit(0.5) + F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(9)) / 2).cast("float").alias("rating"),
        F.lit(100).cast("bigint").alias("timestamp"),
    )
    return rows.select(
        "*", F.lit(f"b{number}").alias("batch_id"), F.lit(number).cast("bigint").alias("batch_seq"), F.lit(None).cast("timestamp").alias("imported_at")
    )


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("userId", "movieId", "timestamp", "rating", "batch_id", "batch_seq").collect())


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def bucket_files(root, version):
    return {p.name for p in (root / "base" / f"version={version}").iterdir() if p.name.startswith("bucket=")}


@pytest.fixture
def store(spark, tmp_path):
    made = RatingsStore(spark, str(tmp_path / "store"), slices=4)
    made.init_schema()
    return made


def test_only_touched_buckets_are_rewritten(spark, tmp_path, store):
    parts = [batch(spark, 1, range(0, 40), range(0, 30), 1), batch(spark, 2, range(3, 4), range(5, 7), 2), batch(spark, 3, range(3, 4), range(5, 6), 3)]
    whole = lambda n: rows_of(latest_by_key(parts[0].unionByName(parts[1]).unionByName(parts[2]).where(F.col("batch_seq") <= n), "batch_seq"))
    for number, rows in enumerate(parts, start=1):
        store.publish(rows)
        assert rows_of(store.current()) == whole(number)
        assert store.compact() == number
        assert rows_of(store.current()) == whole(number)
    assert len(bucket_files(tmp_path / "store", 0)) == 16
    assert 1 <= len(bucket_files(tmp_path / "store", 1)) <= 2 and len(bucket_files(tmp_path / "store", 2)) == 1
    store.compact()
    assert not (tmp_path / "store" / "base" / "version=3").exists()


def test_base_is_not_shuffled(spark, store):
    store.publish(batch(spark, 1, range(0, 40), range(0, 30), 1))
    store.compact()
    assert "Exchange" not in plan_of(store.current())
    store.publish(batch(spark, 2, range(0, 2), range(0, 2), 2))
    # The side that keeps the base's rows: joined where they lie.
    kept = plan_of(store.current()).split("LeftAnti")[1].split("BroadcastExchange")[0]
    assert "hashpartitioning" not in kept
    assert store.current().count() == 1200


def test_batches_merge_in_any_order_and_again(spark, store):
    late, early = batch(spark, 5, range(0, 3), range(0, 3), 5), batch(spark, 2, range(0, 5), range(0, 5), 2)
    store.publish(late)
    store.compact()
    store.publish(early)
    expected = rows_of(latest_by_key(late.unionByName(early), "batch_seq"))
    assert rows_of(store.current()) == expected
    store.compact()
    assert rows_of(store.current()) == expected
    store.publish(late)
    store.publish(early)
    store.compact()
    assert rows_of(store.current()) == expected


@pytest.mark.parametrize("merged", [False, True])
def test_one_user_or_movie(spark, tmp_path, merged):
    store = RatingsStore(spark, str(tmp_path / "grid"))
    store.init_schema()
    first, second = batch(spark, 1, range(0, 60), range(0, 50), 1), batch(spark, 2, range(5, 9), range(0, 4), 2)
    store.publish(first)
    if merged:
        store.compact()
    store.publish(second)
    whole = latest_by_key(first.unionByName(second), "batch_seq")
    for column, wanted in (("userId", {"user": 7}), ("movieId", {"movie": 3})):
        value = next(iter(wanted.values()))
        found = store.current(**wanted)
        assert rows_of(found) == rows_of(whole.where(F.col(column) == value))
        if merged:
            opened = [f for f in found.inputFiles() if "/base/" in f]
            assert 0 < len(opened) < len([f for f in store.current().inputFiles() if "/base/" in f]) / 10
    assert store.current(user=999).count() == 0


def together(work, n=8):
    with ThreadPoolExecutor(n) as pool:
        return list(pool.map(work, range(n)))


def test_a_claim_has_one_owner(spark, tmp_path):
    folder = f"file:{tmp_path}/claims"
    won = together(lambda i: files.claim(spark, f"{folder}/a", f"owner {i}"))
    assert sum(won) == 1 and files.claimed_by(spark, f"{folder}/a") == f"owner {won.index(True)}"
    numbers = together(lambda i: files.claim_number(spark, f"{folder}/n", 3, f"owner {i}"))
    assert sorted(numbers) == list(range(4, 12)) and files.last_claim(spark, f"{folder}/n") == 11
    assert files.claim_number(spark, f"{folder}/n", 3, "owner 5") == numbers[5]


def test_trainers_at_once_get_versions_of_their_own(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    runs = [registry.log_run({}, {"rmse": 0.9 - i / 100}, f"run{i}") for i in range(4)]

    def train(i):
        version = registry.register(runs[i])
        registry.set_alias(f"stage{i}", version)
        registry.promote(runs[i])
        return version

    versions = together(train, 4)
    assert sorted(versions) == [1, 2, 3, 4] and registry.versions().count() == 4
    events = registry.alias_events().collect()
    assert len({e["seq"] for e in events}) == len(events)
    aliases = {r["alias"]: r["version"] for r in ops.current_aliases(registry.alias_events()).collect()}
    assert {f"stage{i}": versions[i] for i in range(4)}.items() <= aliases.items()
    assert aliases["production"] == versions[3]


def test_a_lost_writer_holds_nobody_up(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    run = registry.log_run({}, {"rmse": 0.9})
    registry.register(run)
    files.claim(spark, f"{registry._claims('alias_events')}/{1:012d}", "lost")
    assert registry.promote(run, patience=0.5)
    assert registry.alias_events().first()["seq"] == 2


def test_batch_numbers_are_given_once(spark, tmp_path, store):
    numbers = together(lambda i: store.claim_batch(f"stream {i}"))
    assert sorted(numbers) == list(range(8))
    assert together(lambda i: store.claim_batch(f"stream {i}")) == numbers
    store.publish(batch(spark, 20, range(1), range(1), 1))
    assert store.claim_batch("later") == 21


def test_two_streams_feed_one_store(spark, tmp_path):
    store = RatingsStore(spark, str(tmp_path / "store"))
    store.init_schema()
    for name in "ab":
        os.makedirs(tmp_path / name / "landing")
        (tmp_path / name / "landing" / f"{name}.csv").write_text(HEADER + f"{ord(name)},1,3.0,100\n")

    def take(i):
        root = tmp_path / "ab"[i]
        run_intake(spark, store, *(str(root / part) for part in ("landing", "processed", "failed", "progress")))

    together(take, 2)
    assert {r["userId"] for r in store.current().collect()} == {97, 98} and len(store.batches()) == 2


def test_large_batches_merge_without_joins(spark, tmp_path, monkeypatch):
    """Above the broadcast budget one aggregate settles every key, a repeated one as well."""
    from pyspark.sql import functions as F

    from reelspark.sources import store as module

    monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(module.DataFrame, "join", None)
    kept = module.RatingsStore(spark, str(tmp_path / "store"), slices=2)
    kept.init_schema()
    for number in (1, 2, 3):
        rows = spark.range(40).select(
            (F.col("id") % (10 * number)).cast("int").alias("userId"), F.lit(1).alias("movieId"), F.lit(float(number)).alias("rating"),
            F.lit(0).cast("bigint").alias("timestamp"), F.lit(f"b{number}").alias("batch_id"),
            F.lit(number).cast("bigint").alias("batch_seq"), F.current_timestamp().alias("imported_at"),
        )
        kept.publish(rows)
        if number < 3:
            kept.compact()
        found = {r["userId"]: r["rating"] for r in kept.current().collect()}
        assert found == {user: float(number) for user in range(10 * number)}
        assert kept.current().count() == 10 * number
