import pytest
from pyspark.sql import functions as F

from reelspark.operators import ingest
from reelspark.sources import files
from reelspark.sources.schema import missing_columns
from reelspark.sources.store import RatingsStore, append_ratings, create_tables, replace_table

ORDER = ["userId", "movieId", "timestamp", "rating"]


def tagged(spark, rows):
    return spark.createDataFrame(
        rows, "userId INT, movieId INT, timestamp BIGINT, rating DOUBLE, batch_id STRING, batch_seq BIGINT"
    ).withColumn("imported_at", F.current_timestamp())


def test_later_batch_wins_and_replay_changes_nothing(spark):
    one = tagged(spark, [(1, 10, 100, 3.0, "b1", 1), (2, 10, 100, 2.0, "b1", 1)])
    two = tagged(spark, [(1, 10, 100, 4.0, "b2", 2), (1, 10, 200, 5.0, "b2", 2)])
    merged = ingest.upsert(one, two, "batch_seq")
    rows = {(r["userId"], r["timestamp"]): (r["rating"], r["batch_id"]) for r in merged.collect()}
    assert rows == {(1, 100): (4.0, "b2"), (2, 100): (2.0, "b1"), (1, 200): (5.0, "b2")}
    again = ingest.upsert(merged, two, "batch_seq")
    assert {(r["userId"], r["timestamp"]): (r["rating"], r["batch_id"]) for r in again.collect()} == rows


@pytest.mark.parametrize(
    "rows, batches, sizes", [(10, 4, [3, 3, 3, 1]), (6, 4, [2, 2, 2]), (3, 1, [3]), (2, 5, [1, 1])]
)
def test_split_by_count(ratings_of, rows, batches, sizes):
    df = ratings_of([(i, 1, 3.0, i) for i in range(rows)])
    report = ingest.batch_report(ingest.split_by_count(df, ORDER, batches), ["userId"]).orderBy("batch_no").collect()
    assert [r["n"] for r in report] == sizes
    starts = [int(r["first_key"]) for r in report]
    assert starts == [sum(sizes[:i]) for i in range(len(sizes))]


def test_split_by_size_cuts_inside_hot_copies(ratings_of):
    df = ratings_of([(1, 1, 3.0, 1)] * 7 + [(2, 2, 3.0, 1)] * 3)
    report = ingest.batch_report(ingest.split_by_size(df, ORDER, 4), ["userId"]).orderBy("batch_no").collect()
    assert [(r["n"], r["first_key"], r["last_key"]) for r in report] == [(4, "1", "1"), (4, "1", "2"), (2, "2", "2")]


def test_shuffled_split_keeps_all_rows(ratings_of):
    df = ratings_of([(i, i % 3, 3.0, i) for i in range(50)])
    pieces = ingest.split_by_size(df, ORDER, 8, shuffle_seed=42)
    assert sorted(r["userId"] for r in pieces.collect()) == list(range(50))
    assert pieces.where("batch_no = 1").count() == 8
    assert [r["userId"] for r in pieces.where("batch_no = 1").collect()] != list(range(8))


def test_names_of_batches(spark):
    assert (ingest.pad_width(250), ingest.pad_width(10_000)) == (3, 5)
    assert spark.range(1).select(ingest.batch_label(F.lit(7), 250)).first()[0] == "ratings_batch_007"
    with pytest.raises(ValueError):
        ingest.split_by_count(spark.range(1), ["id"], 0)


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_binds_by_name_and_drops_extra(spark, tmp_path):
    path = write(tmp_path / "a.csv", "movieId,note,userId,timestamp,rating\n10,x,1,100,3.5\n")
    row = files.read_ratings_csv(spark, path).first()
    assert (row["userId"], row["movieId"], row["rating"], row["timestamp"]) == (1, 10, 3.5, 100)


def test_each_file_is_bound_by_its_own_header(spark, tmp_path):
    write(tmp_path / "a.csv", "userId,movieId,rating,timestamp\n1,10,3.5,100\n")
    write(tmp_path / "b +%20{x}.csv", "movieId,userId,rating,timestamp,note\n20,2,4.0,200,n\n21,2,4.5,201,n\n")
    write(tmp_path / "c.csv", "userId,movieId,rating,timestamp\n3,30,1.5,300\n")
    rows = files.read_ratings_csv(spark, str(tmp_path)).collect()
    assert sorted((r["userId"], r["movieId"], r["timestamp"]) for r in rows) == [(1, 10, 100), (2, 20, 200), (2, 21, 201), (3, 30, 300)]
    write(tmp_path / "d.csv", "userId,rating,timestamp\n1,3.5,100\n")
    with pytest.raises(ValueError, match="movieId"):
        files.read_ratings_csv(spark, [str(tmp_path / name) for name in ("a.csv", "d.csv")])


def test_missing_column_is_named(spark, tmp_path):
    path = write(tmp_path / "a.csv", "userId,movieId,rating\n1,10,3.5\n")
    with pytest.raises(ValueError, match="timestamp"):
        files.read_ratings_csv(spark, path)
    assert missing_columns(["rating"]) == ["movieId", "timestamp", "userId"]


def test_malformed_rows_are_rejected_and_out_of_range_kept(spark, tmp_path):
    path = write(tmp_path / "a.csv", "userId,movieId,rating,timestamp\n1,10,abc,100\n1,11,7.0,100\n1,12,,100\n")
    raw = files.read_text_csv(spark, path)
    assert [r["movieId"] for r in ingest.valid_rows(raw).collect()] == [11]
    reasons = {r["movieId"]: r["reason"] for r in ingest.rejected_rows(raw).collect()}
    assert reasons == {"10": "malformed rating", "12": "missing rating"}


def test_movies_csv_with_quoted_titles(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'movieId,title,genres\n1,"Comma, The ""Film"" (1999)",A|B\nx,bad,C\n')
    rows = [tuple(r) for r in files.read_movies_csv(spark, path).collect()]
    assert rows == [(1, 'Comma, The "Film" (1999)', "A|B")]
    files.write_csv(files.read_movies_csv(spark, path), str(tmp_path / "out"))
    assert [tuple(r) for r in files.read_movies_csv(spark, str(tmp_path / "out")).collect()] == rows


def test_append_and_replace(spark, tmp_path, ratings_of):
    path = str(tmp_path / "t")
    df = ratings_of([(1, 1, 3.0, 1), (1, 1, 3.0, 1)])
    assert append_ratings(df, path) == 2 and append_ratings(df, path) == 2
    assert spark.read.parquet(path).count() == 4
    replace_table(df.limit(1), path)
    assert spark.read.parquet(path).count() == 1


def test_store_lifecycle(spark, tmp_path, movies_of):
    store = RatingsStore(spark, str(tmp_path / "store"))
    store.init_schema()
    store.init_schema()
    assert store.current().count() == 0 and store.movies().count() == 0
    store.publish(tagged(spark, [(1, 10, 100, 3.0, "b1", 1), (2, 10, 100, 2.0, "b1", 1)]))
    store.publish(tagged(spark, [(1, 10, 100, 4.0, "b2", 2)]))
    state = lambda: {(r["userId"], r["rating"], r["batch_id"]) for r in store.current().collect()}
    assert state() == {(1, 4.0, "b2"), (2, 2.0, "b1")}
    assert store.compact() == 2
    assert state() == {(1, 4.0, "b2"), (2, 2.0, "b1")}
    store.publish(tagged(spark, [(2, 10, 100, 1.0, "b3", 3)]))
    assert state() == {(1, 4.0, "b2"), (2, 1.0, "b3")}
    store.load_movies(movies_of([1, 2]))
    assert store.movies().count() == 2
    with pytest.raises(ValueError):
        store.refresh_catalogue(movies_of([1]), discard_ratings=False)
    fresh = store.refresh_catalogue(movies_of([1]), discard_ratings=True)
    assert fresh.movies().count() == 1 and fresh.current().count() == 0 and store.current().count() == 2


def test_catalogue_tables_are_created_once(spark):
    create_tables(spark, "shop")
    spark.sql("INSERT INTO shop.movies VALUES (1, 'a', 'b')")
    create_tables(spark, "shop")
    assert spark.table("shop.movies").count() == 1
    assert spark.table("shop.ratings").columns == ["userId", "movieId", "rating", "timestamp", "batch_id", "imported_at"]
