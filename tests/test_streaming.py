import os
import pathlib
import time

import pytest

from reelspark.session import shared_folder
from reelspark.sources import files
from reelspark.sources.models import Registry
from reelspark.sources.store import RatingsStore
from reelspark.streaming.intake import feed_landing, run_intake
from reelspark.streaming.retrain import retrain, run_pipeline, serving_model, train_and_evaluate

HEADER = "userId,movieId,rating,timestamp\n"


@pytest.fixture
def folders(tmp_path):
    for name in ("incoming", "landing", "processed", "failed"):
        (tmp_path / name).mkdir()
    return tmp_path


def run(spark, folders, store, **kwargs):
    run_intake(
        spark, store, str(folders / "landing"), str(folders / "processed"), str(folders / "failed"),
        str(folders / "progress"), **kwargs,
    )


def state(store):
    return {(r["userId"], r["movieId"], r["timestamp"]): (r["rating"], r["batch_id"]) for r in store.current().collect()}


def names(folder):
    return sorted(p.name for p in folder.iterdir() if not p.name.startswith("."))


def test_files_apply_in_name_order_and_are_archived(spark, folders):
    for number in (3, 1, 2):
        path = folders / "landing" / f"ratings_batch_{number:03d}.csv"
        path.write_text(HEADER + f"1,10,{number}.0,100\n{number},20,{number}.5,100\n")
    store = RatingsStore(spark, str(folders / "store"))
    run(spark, folders, store)
    assert state(store) == {
        (1, 10, 100): (3.0, "ratings_batch_003"),
        (1, 20, 100): (1.5, "ratings_batch_001"),
        (2, 20, 100): (2.5, "ratings_batch_002"),
        (3, 20, 100): (3.5, "ratings_batch_003"),
    }
    assert names(folders / "landing") == [] and len(names(folders / "processed")) == 3
    run(spark, folders, store)
    assert len(state(store)) == 4


def test_last_row_of_a_key_wins_inside_a_file(spark, folders):
    (folders / "landing" / "b.csv").write_text(HEADER + "".join(f"1,10,{r},100\n" for r in (5.0, 0.5, 2.5)))
    store = RatingsStore(spark, str(folders / "store"))
    run(spark, folders, store)
    assert state(store) == {(1, 10, 100): (2.5, "b")}


def test_folders_and_odd_names_are_batches_too(spark, folders):
    part = folders / "landing" / "batch_id=spring a+b%41"
    part.mkdir()
    for i in range(3):
        (part / f"part-{i}.csv").write_text(HEADER + f"1,{i},3.0,100\n")
    (folders / "landing" / "x y+z.csv").write_text(HEADER + "2,7,4.0,100\n")
    store = RatingsStore(spark, str(folders / "store"))
    run(spark, folders, store)
    assert state(store) == {
        **{(1, i, 100): (3.0, "spring a+b%41") for i in range(3)}, (2, 7, 100): (4.0, "x y+z"),
    }
    assert names(folders / "processed") == ["batch_id=spring a+b%41", "x y+z.csv"]


def test_bad_files_and_rows_are_set_aside(spark, folders):
    (folders / "landing" / "a.csv").write_text("userId,movieId,rating\n1,2,3.0\n")
    (folders / "landing" / "b.csv").write_text("timestamp,rating,movieId,userId,x\n100,4.0,20,1,z\n100,bad,21,1,z\n")
    store = RatingsStore(spark, str(folders / "store"))
    run(spark, folders, store)
    assert state(store) == {(1, 20, 100): (4.0, "b")}
    rejects = {(r["batch_id"], r["reason"], r["movieId"]) for r in store.rejects().collect()}
    assert rejects == {("a", "missing columns: timestamp", None), ("b", "malformed rating", "21")}
    assert names(folders / "failed") == ["a.csv"] and names(folders / "processed") == ["b.csv"]


def test_failure_before_archive_replays_to_the_same_state(spark, folders):
    (folders / "landing" / "ratings_batch_001.csv").write_text(HEADER + "1,10,3.0,100\n")
    store = RatingsStore(spark, str(folders / "store"))

    def fail(_):
        raise RuntimeError("trainer down")

    with pytest.raises(Exception):
        run(spark, folders, store, after_publish=fail)
    assert names(folders / "landing") == ["ratings_batch_001.csv"]
    run(spark, folders, store)
    assert state(store) == {(1, 10, 100): (3.0, "ratings_batch_001")}
    assert store.log().count() == 1
    assert names(folders / "processed") == ["ratings_batch_001.csv"]


def test_landing_is_fed_one_batch_at_a_time(spark, folders):
    for number in (2, 1):
        (folders / "incoming" / f"ratings_batch_{number:03d}.csv").write_text(HEADER)
    (folders / "incoming" / "other.csv").write_text(HEADER)
    incoming, landing = str(folders / "incoming"), str(folders / "landing")
    assert feed_landing(spark, incoming, landing).endswith("ratings_batch_001.csv")
    assert feed_landing(spark, incoming, landing) is None
    assert names(folders / "landing") == ["ratings_batch_001.csv"]


def test_rows_meet_by_numbers_and_sound_lines_are_parsed_once(spark, folders, monkeypatch):
    (folders / "landing" / "a.csv").write_text(HEADER + "1,10,3.0,100\n1,10,4.0,100\n")
    plans, set_aside = [], []
    publish, reject = RatingsStore.publish, RatingsStore.reject

    def published(store, rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        publish(store, rows)

    def rejected(store, rows):
        set_aside.append(rows.count())
        reject(store, rows)

    monkeypatch.setattr(RatingsStore, "publish", published)
    monkeypatch.setattr(RatingsStore, "reject", rejected)
    store = RatingsStore(spark, str(folders / "store"))
    run(spark, folders, store)
    assert len(plans) == 1 and "HashAggregate" in plans[0] and "SortAggregate" not in plans[0]
    assert set_aside == []
    (folders / "landing" / "b.csv").write_text(HEADER + "1,10,x,100\n2,20,1.0,100\n")
    run(spark, folders, store)
    assert set_aside == [1]
    assert state(store) == {(1, 10, 100): (4.0, "a"), (2, 20, 100): (1.0, "b")}


def test_last_row_wins_over_pieces_files_and_batches(spark, folders):
    """Files are read in small pieces, several to a task, and none in name order."""
    expected = {}
    for name, files_of in (("batch_id=x", 3), ("batch_id=y", 2)):
        (folders / "landing" / name).mkdir()
        for number in range(files_of):
            lines = []
            for i in range(40 + 150 * ((number + 1) % 2)):
                key, rating = (i % 7, 1 + i % 3, 100), 0.5 + (i * 5 + number) % 10 / 2
                lines.append(f"{key[0]},{key[1]},{rating},{key[2]}\n" + ("\n" if i % 9 == 0 else ""))
                expected[key] = (rating, name.split("=")[1])
            (folders / "landing" / name / f"part-{number}.csv").write_text(HEADER + "".join(lines))
    settings = {"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "1"}
    before = {key: spark.conf.get(key) for key in settings}
    store = RatingsStore(spark, str(folders / "store"))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        run(spark, folders, store)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert state(store) == expected


def batch_text(first_user, users=24, movies=30):
    lines = [
        f"{u},{m},{0.5 + ((u * 7 + m * 3) % 10) / 2},{100 + m}"
        for u in range(first_user, first_user + users) for m in range(movies) if (u + m) % 4
    ]
    return HEADER + "\n".join(lines) + "\n"


def test_batch_to_promoted_model(spark, folders):
    store = RatingsStore(spark, str(folders / "store"))
    registry = Registry(spark, str(folders / "registry"))
    training = {"k": 5, "base": 2, "remainder": 0}
    args = [str(folders / name) for name in ("landing", "processed", "failed", "progress")]
    (folders / "landing" / "ratings_batch_001.csv").write_text(batch_text(0))
    run_pipeline(spark, store, registry, *args, **training)
    (folders / "landing" / "ratings_batch_002.csv").write_text(batch_text(24))
    run_pipeline(spark, store, registry, *args, scope="batch", **training)
    runs = {r["run_id"]: r for r in registry.runs().collect()}
    assert len(runs) == 2 and all(r["metrics"]["rmse"] > 0 for r in runs.values())
    assert {r["params"]["train_scope"] for r in runs.values()} == {"cumulative", "batch"}
    best = min(runs.values(), key=lambda r: r["metrics"]["rmse"])["run_id"]
    status = {r["alias"]: r for r in registry.status().collect()}
    assert status["production"]["run_id"] == best and status["production"]["models_loaded"]
    assert status["staging"]["version"] == 2
    logged = next(r["params"] for r in runs.values() if r["params"]["train_scope"] == "batch")
    assert {"base", "percent", "max_rows", "cap", "chunk", "n_train", "data_version", "batch_id", "random_state"} <= set(logged)
    assert next(r["metrics"] for r in runs.values() if r["params"]["train_scope"] == "batch")["rating_drift"] in (0.0, 1.0)
    scratch = pathlib.Path(shared_folder(spark).removeprefix("file://")) / "scratch"
    assert not scratch.exists() or not list(scratch.iterdir())
    served = serving_model(registry)
    assert served.k == 5 and served.n_items == 30
    assert '"version": 1' in registry.summary_json(registry.versions().where("version = 1").first()["run_id"])


def test_no_production_model(spark, tmp_path):
    with pytest.raises(LookupError):
        serving_model(Registry(spark, str(tmp_path)))
    with pytest.raises(FileNotFoundError):
        serving_model(Registry(spark, str(tmp_path)), override=str(tmp_path / "nowhere"))


def test_training_without_rows_fails(ratings_of):
    with pytest.raises(ValueError, match="no training rows"):
        train_and_evaluate(ratings_of([(1, 1, 3.0, 1)]), base=2, remainder=0)


@pytest.mark.parametrize("failing", [1, 2, 3])
def test_crash_between_moves_replays_to_the_undisturbed_state(spark, folders, monkeypatch, failing):
    for number in (1, 2, 3):
        (folders / "landing" / f"ratings_batch_{number:03d}.csv").write_text(HEADER + f"{number},10,{number}.0,100\n9,9,{number}.0,5\n")
    store = RatingsStore(spark, str(folders / "store"))
    moves, move = [], files.move

    def flaky(*args):
        moves.append(args)
        if len(moves) == failing:
            raise OSError("no space")
        return move(*args)

    monkeypatch.setattr(files, "move", flaky)
    with pytest.raises(Exception):
        run(spark, folders, store)
    run(spark, folders, store)
    assert state(store) == {
        **{(n, 10, 100): (float(n), f"ratings_batch_{n:03d}") for n in (1, 2, 3)}, (9, 9, 5): (3.0, "ratings_batch_003"),
    }
    assert names(folders / "landing") == [] and len(names(folders / "processed")) == 3


def test_files_of_a_folder_are_bound_by_their_own_header(spark, folders):
    part = folders / "landing" / "batch_id=b1"
    part.mkdir()
    (part / "p0.csv").write_text(HEADER + "1,10,3.0,100\n")
    (part / "p1.csv").write_text('movieId,"userId",rating,timestamp\n20,2,4.0,100\n')
    (part / "p2.csv").write_text("userId,movieId,rating\n5,5,5.0\n")
    store = RatingsStore(spark, str(folders / "store"))
    run(spark, folders, store)
    assert state(store) == {(1, 10, 100): (3.0, "b1"), (2, 20, 100): (4.0, "b1")}
    assert [r["reason"] for r in store.rejects().collect()] == ["missing columns: timestamp"]


def test_every_row_is_accepted_or_rejected(spark, folders):
    values = ["3.0", "NaN", "Infinity", "-Infinity", "inf", "x", ""]
    (folders / "landing" / "b.csv").write_text(HEADER + "".join(f"{i},1,{v},100\n" for i, v in enumerate(values)))
    (folders / "landing" / "empty.csv").write_text("")
    store = RatingsStore(spark, str(folders / "store"))
    run(spark, folders, store)
    rejects = [r for r in store.rejects().collect() if r["batch_id"] == "b"]
    assert set(state(store)) == {(0, 1, 100)} and len(rejects) == len(values) - 1
    assert names(folders / "failed") == ["empty.csv"]


def test_old_files_and_files_sent_again_are_taken(spark, folders):
    store = RatingsStore(spark, str(folders / "store"))
    first = folders / "landing" / "b.csv"
    first.write_text(HEADER + "1,10,3.0,100\n")
    run(spark, folders, store)
    old = folders / "landing" / "a.csv"
    old.write_text(HEADER + "2,10,3.0,100\n")
    os.utime(old, (time.time() - 864_000,) * 2)
    first.write_text(HEADER + "1,10,4.5,100\n")
    run(spark, folders, store)
    assert state(store) == {(1, 10, 100): (4.5, "b"), (2, 10, 100): (3.0, "a")}
    assert names(folders / "landing") == [] and len(names(folders / "processed")) == 3


def test_a_batch_is_few_files(spark, folders):
    for number in range(5):
        (folders / "landing" / f"b{number}.csv").write_text(HEADER + "".join(f"{u},1,3.0,{number}\n" for u in range(200)))
    store = RatingsStore(spark, str(folders / "store"))
    run(spark, folders, store)
    parts = list((folders / "store" / "log").rglob("part-*.parquet"))
    assert len(parts) <= 5 + int(spark.conf.get("spark.sql.shuffle.partitions")) + 1
