"""Dataset profile: quality, sparsity, distributions, bias, popularity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from reelspark.constants import (
    BROADCAST_BYTES,
    COLD_START_RATINGS,
    MAX_RATING,
    MIN_RATING,
    MIN_TOP_RATED,
    UNKNOWN_GENRES,
    UNKNOWN_TITLE,
)
from reelspark.functions.scalar import hash_number, round_binary, row_digest

_MOVIE_BYTES = 256


def user_counts(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("n"))


def movie_counts(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("movieId").agg(F.count(F.lit(1)).alias("n"))


def entity_means(ratings: DataFrame, key: str) -> DataFrame:
    return ratings.groupBy(key).agg(F.avg("rating").alias("mean_rating"), F.count(F.lit(1)).alias("n"))


def _cells(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("userId", "movieId").agg(F.count(F.lit(1)).alias("n"))


def load_check(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Row counts of both tables and the overall mean."""
    return ratings.agg(F.count(F.lit(1)).alias("ratings"), F.avg("rating").alias("avg_rating")).withColumn(
        "movies", movies.agg(F.count(F.lit(1))).scalar()
    )


def dataset_overview(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    return ratings.agg(
        F.count(F.lit(1)).alias("total_ratings"),
        F.countDistinct("userId").alias("users"),
        F.countDistinct("movieId").alias("movies_rated"),
        F.avg("rating").alias("avg_rating"),
        F.stddev_samp("rating").alias("rating_std"),
    ).withColumn("catalog_size", movies.agg(F.count(F.lit(1))).scalar())


def matrix_sparsity(ratings: DataFrame) -> DataFrame:
    """Share of empty user x movie cells; the numerator counts rows, not pairs."""
    sizes = ratings.agg(
        F.count(F.lit(1)).alias("actual"),
        (F.countDistinct("userId") * F.countDistinct("movieId")).alias("possible"),
    )
    sparsity = (F.lit(1.0) - F.col("actual") / F.col("possible")) * 100
    return sizes.select("possible", "actual", sparsity.alias("sparsity_pct"), (100 - sparsity).alias("density_pct"))


def _null_cells(df: DataFrame) -> F.Column:
    total = F.lit(0)
    for name in df.columns:
        total = total + F.col(name).isNull().cast("int")
    return total


def data_quality(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Null cells, repeated (user, movie) rows and out-of-range ratings in one shuffle."""
    invalid = ((F.col("rating") < MIN_RATING) | (F.col("rating") > MAX_RATING)).cast("int")
    per_pair = ratings.groupBy("userId", "movieId").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_null_cells(ratings)).alias("nulls"),
        F.coalesce(F.sum(invalid), F.lit(0)).alias("invalid"),
    )
    null_movies = movies.agg(F.coalesce(F.sum(_null_cells(movies)), F.lit(0)).alias("nulls")).scalar()
    return per_pair.agg(
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_ratings"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_pairs"),
        F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_ratings"),
    ).withColumn("null_movies", null_movies)


def rating_distribution(ratings: DataFrame) -> DataFrame:
    counts = ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("pct", F.col("n") * 100.0 / total).orderBy("rating")


def modal_rating(ratings: DataFrame) -> DataFrame:
    """The most frequent rating; the lowest one on a tie."""
    counts = ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), "rating").limit(1)


def cold_start_summary(ratings: DataFrame, threshold: int = COLD_START_RATINGS) -> DataFrame:
    """Users and movies with fewer than ``threshold`` ratings."""

    def summary(entity: str, counts: DataFrame) -> DataFrame:
        return counts.agg(
            F.count_if(F.col("n") < threshold).alias("cold"), F.count(F.lit(1)).alias("total")
        ).select(F.lit(entity).alias("entity"), "cold", "total", (F.col("cold") * 100.0 / F.col("total")).alias("pct"))

    return summary("user", user_counts(ratings)).unionByName(summary("movie", movie_counts(ratings)))


def mean_of_means(ratings: DataFrame) -> DataFrame:
    users = entity_means(ratings, "userId").agg(F.avg("mean_rating").alias("mean_user_mean"))
    movies = entity_means(ratings, "movieId").agg(F.avg("mean_rating").alias("m")).scalar()
    return users.withColumn("mean_movie_mean", movies)


def entity_bias(ratings: DataFrame, key: str) -> DataFrame:
    """Mean rating of each entity minus the overall mean."""
    overall = ratings.agg(F.avg("rating").alias("m")).scalar()
    return entity_means(ratings, key).select(key, (F.col("mean_rating") - overall).alias("bias"))


def histogram(values: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over the value range; the top edge belongs to the last bin."""
    column_range = values.agg(
        F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).alias("range")
    ).scalar()
    ranged = values.select(F.col(column).cast("double").alias("x"), column_range.alias("r"))
    spread = F.col("r.hi") - F.col("r.lo")
    slot = F.when(spread == 0, F.lit(bins // 2)).otherwise(
        F.floor((F.col("x") - F.col("r.lo")) * bins / F.when(spread != 0, spread))
    )
    binned = ranged.select(F.least(F.lit(bins), slot + 1).cast("int").alias("bin"))
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def movie_stats(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Count, mean and deviation per movie, rounded to two digits, with catalogue data."""
    stats = ratings.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("num_ratings"),
        round_binary(F.avg("rating"), 2).alias("avg_rating"),
        round_binary(F.stddev_samp("rating"), 2).alias("rating_std"),
    )
    return stats.join(movies, "movieId").select(
        F.col("movieId").alias("movie_id"), "title", "genres", "num_ratings", "avg_rating", "rating_std"
    )


def most_rated(stats: DataFrame, n: int) -> DataFrame:
    return stats.orderBy(F.col("num_ratings").desc(), "movie_id").limit(n)


def highest_rated(stats: DataFrame, min_ratings: int = MIN_TOP_RATED, n: int = 10) -> DataFrame:
    """Ranked on the rounded mean, ties in id order."""
    return stats.where(F.col("num_ratings") >= min_ratings).orderBy(F.col("avg_rating").desc(), "movie_id").limit(n)


def user_top_rated(ratings: DataFrame, movies: DataFrame, n: int = 3) -> DataFrame:
    """The best-rated movies of each user; the rank limit is applied before the shuffle."""
    order = Window.partitionBy("userId").orderBy(F.col("rating").desc(), "movieId", "timestamp")
    ranked = (
        ratings.join(movies.select("movieId"), "movieId", "left_semi")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
    )
    return ranked.join(movies, "movieId").select(
        F.col("userId").alias("user_id"),
        "rank",
        F.col("movieId").alias("movie_id"),
        "title",
        "genres",
        "rating",
    )


def rating_cells(ratings: DataFrame) -> DataFrame:
    """Long form of the user x movie pivot: mean of repeated ratings, zeros left out."""
    return ratings.groupBy("userId", "movieId").agg(F.avg("rating").alias("v"))


def ratings_with_movies(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Inner join with the release year read from the end of the title."""
    year = F.regexp_extract("title", r"\((\d{4})\)\s*$", 1)
    return ratings.join(movies, "movieId").withColumn("year", F.when(year != "", year).cast("int"))


def movie_popularity(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Rating count of every catalogue movie, zero for the unrated."""
    counted = movie_counts(ratings)
    return movies.select("movieId").join(counted, "movieId", "left").select(
        "movieId", F.coalesce("n", F.lit(0)).cast("bigint").alias("popularity")
    )


def movie_info(ids: DataFrame, movies: DataFrame) -> DataFrame:
    """Title and genres of requested ids, with defaults for unknown ones.

    Compressed files tell little of how large titles are in memory, so the rows decide how they are joined.
    """
    fits = movies.count() * _MOVIE_BYTES <= BROADCAST_BYTES
    movies = F.broadcast(movies) if fits else movies.hint("merge")
    return ids.join(movies, "movieId", "left").select(
        F.col("movieId").alias("movie_id"),
        F.coalesce("title", F.concat(F.lit(UNKNOWN_TITLE), F.col("movieId").cast("string"))).alias("title"),
        F.coalesce("genres", F.lit(UNKNOWN_GENRES)).alias("genres"),
    )


def rated_movie_ids(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct movies rated by the requested users."""
    return ratings.select("userId", "movieId").distinct().join(users, "userId", "left_semi")


def unrated_counts(users: DataFrame, ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Catalogue movies each user has not rated, counted without listing them."""
    rated = _cells(ratings).join(movies.select("movieId"), "movieId", "left_semi")
    per_user = rated.groupBy("userId").agg(F.count(F.lit(1)).alias("n_rated"))
    catalogue = movies.agg(F.count(F.lit(1)).alias("n")).scalar()
    return users.join(per_user, "userId", "left").select(
        F.col("userId").alias("user_id"), (catalogue - F.coalesce("n_rated", F.lit(0))).alias("n_unrated")
    )


def unrated_movies(ratings: DataFrame, movies: DataFrame, user_id: int) -> DataFrame:
    """Catalogue movies one user has not rated."""
    rated = ratings.where(F.col("userId") == user_id).select("movieId").distinct()
    return movies.join(rated, "movieId", "left_anti")


def batch_lineage(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("sum_rating"))


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count plus two order-free digests of the content, which tell nulls and value borders apart."""
    hashed = df.select(hash_number(row_digest(*df.columns)).alias("h"))
    return hashed.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor("h").alias("xor_hash"),
        (F.sum(F.col("h").cast("decimal(38,0)")) % F.lit(1_000_000_007).cast("decimal(38,0)"))
        .cast("bigint")
        .alias("sum_hash"),
    )
