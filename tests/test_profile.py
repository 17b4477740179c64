import numpy as np
import pytest

from reelspark.operators import popular, profile


def test_modal_tie_takes_the_lower_rating(ratings_of):
    df = ratings_of([(1, 1, 4.0, 1), (1, 2, 4.0, 1), (2, 1, 3.0, 1), (2, 2, 3.0, 1)])
    assert tuple(profile.modal_rating(df).first()) == (3.0, 2)


def test_single_rating_has_no_deviation(ratings_of, movies_of):
    row = profile.movie_stats(ratings_of([(1, 1, 4.0, 1)]), movies_of([1])).first()
    assert row["rating_std"] is None and row["num_ratings"] == 1


def test_popularity_threshold_is_inclusive(ratings_of, movies_of):
    rows = [(u, 1, 4.0, 1) for u in range(19)] + [(u, 2, 3.0, 1) for u in range(20)]
    listed = popular.popular_movies(ratings_of(rows), movies_of([1, 2])).collect()
    assert [r["movie_id"] for r in listed] == [2]


def test_movies_without_catalogue_entry_drop_out(ratings_of, movies_of):
    rows = [(u, m, 4.0, 1) for u in range(20) for m in (1, 2)]
    assert [r["movie_id"] for r in popular.popular_movies(ratings_of(rows), movies_of([1])).collect()] == [1]


@pytest.mark.parametrize("values", [[3.0] * 5, [1.0, 2.0, 2.5, 9.0, 9.0], list(np.linspace(0, 1, 40))])
def test_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x DOUBLE")
    found = {r["bin"]: r["n"] for r in profile.histogram(df, "x", 10).collect()}
    expected = np.histogram(values, bins=10)[0]
    assert found == {i + 1: int(n) for i, n in enumerate(expected) if n}


def test_quality_counts(spark, movies_of):
    df = spark.createDataFrame(
        [(1, 1, 7.0, 1), (1, 1, 0.0, 2), (1, None, 3.0, None), (None, None, None, None)],
        "userId INT, movieId INT, rating DOUBLE, timestamp BIGINT",
    )
    row = profile.data_quality(df, movies_of([1])).first().asDict()
    assert row == {"null_ratings": 6, "duplicate_pairs": 1, "invalid_ratings": 2, "null_movies": 0}


def test_cold_start_and_defaults(ratings_of, movies_of):
    rows = [(1, m, 3.0, 1) for m in range(5)] + [(2, m, 3.0, 1) for m in range(4)]
    found = {r["entity"]: (r["cold"], r["total"]) for r in profile.cold_start_summary(ratings_of(rows)).collect()}
    assert found == {"user": (1, 2), "movie": (5, 5)}
    info = profile.movie_info(movies_of([-1]).select("movieId"), movies_of([1])).first()
    assert (info["title"], info["genres"]) == ("Movie -1", "Unknown")


def test_release_year(spark, ratings_of):
    movies = spark.createDataFrame([(1, "Heat (1995) ", "x"), (2, "No year", "x")], "movieId INT, title STRING, genres STRING")
    joined = profile.ratings_with_movies(ratings_of([(1, 1, 3.0, 1), (1, 2, 3.0, 1), (1, 3, 3.0, 1)]), movies)
    assert {r["movieId"]: r["year"] for r in joined.collect()} == {1: 1995, 2: None}


def test_unrated_by_one_user_and_by_count(spark, ratings_of, movies_of):
    df = ratings_of([(1, 1, 3.0, 1), (1, 1, 4.0, 2), (1, 9, 3.0, 1)])
    movies = movies_of([1, 2, 3])
    assert {r["movieId"] for r in profile.unrated_movies(df, movies, 1).collect()} == {2, 3}
    users = spark.createDataFrame([(1,), (5,)], "userId INT")
    assert {tuple(r) for r in profile.unrated_counts(users, df, movies).collect()} == {(1, 2), (5, 3)}


def test_fingerprint_sees_changes_not_order(ratings_of):
    rows = [(1, 1, 3.0, 1), (1, 2, 3.0, 1), (1, 2, 3.0, 1)]
    one, two = profile.fingerprint(ratings_of(rows)).first(), profile.fingerprint(ratings_of(rows[::-1])).first()
    assert one == two
    assert one != profile.fingerprint(ratings_of(rows[:1])).first()
    assert one != profile.fingerprint(ratings_of([(1, 1, 3.0, 1), (1, 5, 3.0, 1), (1, 5, 3.0, 1)])).first()


def test_titles_are_broadcast_by_their_rows(spark, movies_of, monkeypatch):
    """Whatever the size of their files."""
    ids, movies = spark.createDataFrame([(1,), (9,)], "movieId INT"), movies_of([1, 2])
    for budget, join in ((1 << 20, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        monkeypatch.setattr(profile, "BROADCAST_BYTES", budget)
        found = profile.movie_info(ids, movies.limit(2))
        assert join in found._jdf.queryExecution().executedPlan().toString()
        assert {r["movie_id"]: r["title"] for r in found.collect()} == {1: "Film 1 (1991)", 9: "Movie 9"}
