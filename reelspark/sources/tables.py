"""Ratings and movies as views over the supplied star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelspark.constants import BATCH_PREFIX


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _epoch_seconds(column: str) -> F.Column:
    # Interval arithmetic on zone-less timestamps does not depend on the session zone.
    return F.expr(f"CAST(CAST({column} AS TIMESTAMP_NTZ) - TIMESTAMP_NTZ'1970-01-01 00:00:00' AS INTERVAL SECOND)").cast(
        "bigint"
    )


def ratings_with_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId, movieId, rating, timestamp plus the delivery number of the row."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("movieId"),
        (F.lit(0.5) + F.lit(0.5) * ((F.col("l_quantity").cast("int") - 1) % 10)).alias("rating"),
        _epoch_seconds("o_orderdate").alias("timestamp"),
        F.col("l_linenumber").cast("int").alias("batch_no"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings_with_batch(spark, sf_dir).drop("batch_no")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("movieId"),
        F.concat(F.col("p_name"), F.lit(" ("), (F.lit(1950) + F.col("p_size")).cast("string"), F.lit(")")).alias("title"),
        F.concat_ws("|", "p_type", "p_brand").alias("genres"),
    )


def batch_name(number: F.Column) -> F.Column:
    return F.concat(F.lit(BATCH_PREFIX), F.lpad(number.cast("string"), 3, "0"))


def tagged_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings with their delivery as ``batch_seq`` and ``batch_id``."""
    return ratings_with_batch(spark, sf_dir).select(
        "userId",
        "movieId",
        "rating",
        "timestamp",
        F.col("batch_no").alias("batch_seq"),
        batch_name(F.col("batch_no")).alias("batch_id"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every account that may ask for recommendations, rated or not."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("userId"))
