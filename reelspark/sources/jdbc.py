"""Relational tables over JDBC; needs the database's driver on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 32,
    **options: str,
) -> DataFrame:
    """A table scan, split into ``partitions`` ranges of ``key`` when bounds are given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key and bounds:
        reader = reader.options(
            partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def append_table(df: DataFrame, url: str, table: str, batch_rows: int = 10_000, **options: str) -> None:
    df.write.format("jdbc").mode("append").options(url=url, dbtable=table, batchsize=batch_rows, **options).save()
