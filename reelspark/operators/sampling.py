"""Deterministic samples, holdout splits and known-id filters."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from reelspark.constants import (
    HOLDOUT_PCT,
    MIN_QUALITY_SAMPLE,
    QUALITY_SAMPLE_SIZE,
    RANDOM_TEST_SHARE,
    SAMPLE_RATINGS,
    SEED,
    TRAIN_CHUNK_SIZE,
    TRAIN_MAX_ROWS,
    USER_MOD_BASE,
    USER_MOD_REMAINDER,
)
from reelspark.functions.scalar import in_user_sample, is_holdout, row_hash
from reelspark.operators.ordering import ordered_prefix, rank_split
from reelspark.session import broadcast_if_small, materialise


def user_sample(ratings: DataFrame, base: int = USER_MOD_BASE, remainder: int = USER_MOD_REMAINDER) -> DataFrame:
    return ratings.where(in_user_sample(base, remainder))


def holdout_rows(
    ratings: DataFrame, base: int = USER_MOD_BASE, remainder: int = USER_MOD_REMAINDER, percent: int = HOLDOUT_PCT
) -> DataFrame:
    return ratings.where(in_user_sample(base, remainder) & is_holdout(percent))


def train_rows(
    ratings: DataFrame,
    base: int = USER_MOD_BASE,
    remainder: int = USER_MOD_REMAINDER,
    percent: int = HOLDOUT_PCT,
    batch_id: str | None = None,
) -> DataFrame:
    """Sampled rows outside the holdout, optionally of one batch only."""
    kept = ratings.where(in_user_sample(base, remainder) & ~is_holdout(percent))
    return kept if batch_id is None else kept.where(F.col("batch_id") == batch_id)


def effective_cap(max_rows: int = TRAIN_MAX_ROWS, chunk: int = TRAIN_CHUNK_SIZE) -> int:
    """The cap is tested after whole pages, so it rounds up to a multiple of the page."""
    return math.ceil(max_rows / chunk) * chunk


def capped_train_rows(train: DataFrame, max_rows: int = TRAIN_MAX_ROWS, chunk: int = TRAIN_CHUNK_SIZE) -> DataFrame:
    """The first rows by user and movie, up to the effective cap."""
    return ordered_prefix(train, ["userId", "movieId", "timestamp", "rating"], effective_cap(max_rows, chunk))


def random_split(ratings: DataFrame, share: float = RANDOM_TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Every row with ``is_test``: exactly ceil(share * rows) rows are set."""
    return rank_split(ratings, row_hash(*ratings.columns, seed=seed), flag="is_test", share=share)


def sample_rows(df: DataFrame, n: int = SAMPLE_RATINGS, seed: int = SEED) -> DataFrame:
    """Exactly min(n, rows) rows, the same on every run and in every engine."""
    picked = rank_split(df, row_hash(*df.columns, seed=seed), n, "_picked")
    return picked.where("_picked").drop("_picked")


def movies_in(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """Catalogue rows that occur in ``ratings``."""
    return movies.join(ratings.select("movieId").distinct(), "movieId", "left_semi")


def quality_sample(
    stats: DataFrame, min_ratings: int = MIN_QUALITY_SAMPLE, n: int = QUALITY_SAMPLE_SIZE, seed: int = SEED
) -> DataFrame:
    """Up to ``n`` movies with enough ratings, drawn by hash of the id."""
    rated = stats.where(F.col("num_ratings") >= min_ratings)
    picked = rank_split(rated, row_hash("movie_id", seed=seed), n, "_picked")
    return picked.where("_picked").drop("_picked")


def known_ids(rows: DataFrame, users: DataFrame, movies: DataFrame) -> DataFrame:
    """Rows whose user and movie both occur in the given id frames."""
    return rows.join(users.select("userId").distinct(), "userId", "left_semi").join(
        movies.select("movieId").distinct(), "movieId", "left_semi"
    )


def latest_known_holdout(
    holdout: DataFrame, users: DataFrame, movies: DataFrame, cap: int | None = None
) -> DataFrame:
    """Holdout rows with known ids; with ``cap``, the newest 3*cap rows are filtered and cut to ``cap``."""
    rows = holdout.select("userId", "movieId", "rating", "timestamp")
    if cap is None:
        return known_ids(rows, users, movies)
    newest_first = [F.col("timestamp").desc(), F.col("userId"), F.col("movieId"), F.col("rating")]
    newest = materialise(rows.orderBy(*newest_first).limit(3 * cap))
    # The few rows bound both sides: ids are looked up among theirs, not brought together whole.
    users, movies = (
        ids.join(broadcast_if_small(newest.select(key), 3 * cap, 16), key, "left_semi")
        for ids, key in ((users, "userId"), (movies, "movieId"))
    )
    return known_ids(newest, users, movies).orderBy(*newest_first).limit(cap)


def distinct_users(ratings: DataFrame, base: int = USER_MOD_BASE, remainder: int = USER_MOD_REMAINDER) -> DataFrame:
    return user_sample(ratings, base, remainder).select("userId").distinct()


def distinct_movies(ratings: DataFrame) -> DataFrame:
    return ratings.select("movieId").distinct()
