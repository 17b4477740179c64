"""Truncated SVD over the sparse user x movie matrix, and scoring with its factors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelspark.constants import N_COMPONENTS, SERVED_PAIR, SERVED_PAIR_LOCAL, UNKNOWN_GENRES, UNKNOWN_TITLE
from reelspark.functions.scalar import clip, dot
from reelspark.operators.factorise import truncated_svd
from reelspark.operators.profile import movie_info
from reelspark.session import broadcast_if_small


@dataclass(frozen=True)
class FactorModel:
    """Factors of the entities that have training cells; all others count as zero vectors."""

    global_mean: float
    singular_values: list[float]
    user_factors: DataFrame  # userId INT, f ARRAY<DOUBLE>
    item_factors: DataFrame  # movieId INT, f ARRAY<DOUBLE>
    n_items: int
    n_train: int

    @property
    def k(self) -> int:
        return len(self.singular_values)

    @property
    def item_row_bytes(self) -> int:
        return 8 * self.k + 64


def train_mean(train: DataFrame) -> tuple[float, int]:
    """Mean rating and row count of the training rows; no rows is an error."""
    row = train.agg(F.avg("rating").alias("mean"), F.count("rating").alias("n")).first()
    if not row["n"]:
        raise ValueError("no training rows: the sample or split selects nothing")
    return row["mean"], row["n"]


def centered_cells(train: DataFrame, mean: float | Column) -> DataFrame:
    """Sum of (rating - mean) over the rows of each (user, movie) pair."""
    centre = mean if isinstance(mean, Column) else F.lit(mean)
    sums = train.groupBy("userId", "movieId").agg(F.sum("rating").alias("s"), F.count("rating").alias("n"))
    return sums.select("userId", "movieId", (F.col("s") - F.col("n") * centre).alias("v"))


def train_svd(train: DataFrame, k: int = N_COMPONENTS, **solver) -> FactorModel:
    """Factorise the mean-centred matrix of the training rows; ``solver`` goes to ``truncated_svd``."""
    mean, n = train_mean(train)
    found = truncated_svd(centered_cells(train, mean), k, **solver)
    return FactorModel(mean, found.singular_values, found.users, found.items, found.n_items, n)


def train_svd_uncentered(cells: DataFrame, k: int = N_COMPONENTS, **solver) -> FactorModel:
    """Factorise the plain pivot (mean of repeats, zero where unrated)."""
    found = truncated_svd(cells, k, **solver)
    return FactorModel(0.0, found.singular_values, found.users, found.items, found.n_items, 0)


def spectrum(model: FactorModel, spark: SparkSession) -> DataFrame:
    rows = [(i + 1, value) for i, value in enumerate(model.singular_values)]
    return spark.createDataFrame(rows, "component INT, singular_value DOUBLE")


def _with_factors(pairs: DataFrame, model: FactorModel, how: str) -> DataFrame:
    users = model.user_factors.select("userId", F.col("f").alias("uf"))
    items = model.item_factors.select("movieId", F.col("f").alias("vf"))
    items = broadcast_if_small(items, model.n_items, model.item_row_bytes)
    return pairs.join(users, "userId", how).join(items, "movieId", how)


def svd_component(pairs: DataFrame, model: FactorModel) -> DataFrame:
    """Pairs with ``svd``, zero where either side has no factors."""
    joined = _with_factors(pairs, model, "left")
    return joined.withColumn("svd", F.coalesce(dot(F.col("uf"), F.col("vf")), F.lit(0.0))).drop("uf", "vf")


def predict(pairs: DataFrame, model: FactorModel) -> DataFrame:
    """Clipped prediction per pair; the global mean for unknown users or movies."""
    scored = svd_component(pairs, model)
    return scored.withColumn("predicted_rating", clip(F.lit(model.global_mean) + F.col("svd"))).drop("svd")


def predict_unclipped_known(pairs: DataFrame, model: FactorModel) -> DataFrame:
    """Raw products for pairs known on both sides; the others drop out."""
    joined = _with_factors(pairs, model, "inner")
    return joined.withColumn("predicted_rating", dot(F.col("uf"), F.col("vf"))).drop("uf", "vf")


def predict_record(pairs: DataFrame, movies: DataFrame, model: FactorModel) -> DataFrame:
    """One served record per pair."""
    scored = predict(pairs.select("userId", "movieId").distinct(), model)
    info = movie_info(scored.select("movieId").distinct(), movies).withColumnRenamed("movie_id", "movieId")
    return scored.join(info, "movieId").select(
        F.col("userId").alias("user_id"),
        F.col("movieId").alias("movie_id"),
        "predicted_rating",
        "title",
        "genres",
        F.lit(SERVED_PAIR).alias("served_by"),
    )


def bias_terms(ratings: DataFrame, key: str, name: str, mean: Column) -> DataFrame:
    return ratings.groupBy(key).agg((F.avg("rating") - mean).alias(name))


def bias_baseline(pairs: DataFrame, ratings: DataFrame) -> DataFrame:
    """clip(mean + user bias + movie bias) for pairs; missing biases count as zero."""
    mean = ratings.agg(F.avg("rating").alias("m")).scalar()
    users = bias_terms(ratings, "userId", "user_bias", mean)
    items = bias_terms(ratings, "movieId", "movie_bias", mean)
    joined = pairs.join(users, "userId", "left").join(items, "movieId", "left")
    zero = F.lit(0.0)
    return joined.select(
        F.col("userId").alias("user_id"),
        F.col("movieId").alias("movie_id"),
        F.coalesce("user_bias", zero).alias("user_bias"),
        F.coalesce("movie_bias", zero).alias("movie_bias"),
    ).withColumn("predicted_rating", clip(mean + F.col("user_bias") + F.col("movie_bias")))


def predict_with_bias(pairs: DataFrame, ratings: DataFrame, movies: DataFrame, model: FactorModel) -> DataFrame:
    """Bias plus SVD with its components; unknown users or movies give an error row."""
    mean = F.lit(model.global_mean)
    users = bias_terms(ratings, "userId", "user_bias", mean)
    items = bias_terms(ratings, "movieId", "movie_bias", mean)
    joined = (
        _with_factors(pairs.select("userId", "movieId").distinct(), model, "left")
        .join(users, "userId", "left")
        .join(items, "movieId", "left")
        .join(movies, "movieId", "left")
    )
    user_id, movie_id = F.col("userId").cast("string"), F.col("movieId").cast("string")
    error = F.when(
        F.col("uf").isNull(), F.concat(F.lit("User "), user_id, F.lit(" not found"))
    ).when(F.col("vf").isNull(), F.concat(F.lit("Movie "), movie_id, F.lit(" not found")))
    svd = dot(F.col("uf"), F.col("vf"))
    user_bias, movie_bias = F.coalesce("user_bias", F.lit(0.0)), F.coalesce("movie_bias", F.lit(0.0))
    known = error.isNull()
    components = F.struct(
        mean.alias("global_mean"),
        user_bias.alias("user_bias"),
        movie_bias.alias("movie_bias"),
        svd.alias("svd_component"),
    )
    return joined.select(
        F.col("userId").alias("user_id"),
        F.col("movieId").alias("movie_id"),
        F.when(known, clip(mean + user_bias + movie_bias + svd)).alias("predicted_rating"),
        F.coalesce("title", F.concat(F.lit(UNKNOWN_TITLE), movie_id)).alias("title"),
        F.coalesce("genres", F.lit(UNKNOWN_GENRES)).alias("genres"),
        F.when(known, components).alias("components"),
        error.alias("error"),
        F.when(known, F.lit(SERVED_PAIR_LOCAL)).alias("served_by"),
    )


def reconstruction(model: FactorModel, cells: DataFrame) -> DataFrame:
    """Observed cell value next to its rank-k approximation."""
    return svd_component(cells, model).select(
        F.col("userId").alias("user_id"), F.col("movieId").alias("movie_id"), "v", F.col("svd").alias("approx")
    )
