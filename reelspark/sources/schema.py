"""Table schemas and the required-column check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

from reelspark.constants import MOVIE_COLUMNS, REQUIRED_COLUMNS

RATINGS = T.StructType(
    [
        T.StructField("userId", T.IntegerType(), False),
        T.StructField("movieId", T.IntegerType(), False),
        T.StructField("rating", T.FloatType(), False),
        T.StructField("timestamp", T.LongType(), False),
    ]
)

RATINGS_TAGGED = T.StructType(
    [
        *RATINGS.fields,
        T.StructField("batch_id", T.StringType(), True),
        T.StructField("imported_at", T.TimestampType(), False),
    ]
)

MOVIES = T.StructType(
    [
        T.StructField("movieId", T.IntegerType(), False),
        T.StructField("title", T.StringType(), True),
        T.StructField("genres", T.StringType(), True),
    ]
)


def missing_columns(columns: Iterable[str], required: Iterable[str] = REQUIRED_COLUMNS) -> list[str]:
    """Names in ``required`` that ``columns`` lacks, sorted."""
    return sorted(set(required) - set(columns))


def require_columns(columns: Iterable[str], required: Iterable[str] = REQUIRED_COLUMNS) -> None:
    """Raise a ``ValueError`` naming every missing column."""
    missing = missing_columns(columns, required)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


__all__ = [
    "MOVIES",
    "MOVIE_COLUMNS",
    "RATINGS",
    "RATINGS_TAGGED",
    "REQUIRED_COLUMNS",
    "missing_columns",
    "require_columns",
]
