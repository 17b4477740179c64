"""Scalar expressions: split predicates, clipping, dot product, hashing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from reelspark.constants import (
    HOLDOUT_PCT,
    MAX_RATING,
    MIN_RATING,
    SEED,
    USER_MOD_BASE,
    USER_MOD_REMAINDER,
)


def in_user_sample(base: int = USER_MOD_BASE, remainder: int = USER_MOD_REMAINDER) -> Column:
    """Deterministic user sample: user id modulo ``base`` equals ``remainder``."""
    return F.lit(True) if base == 1 else F.col("userId") % base == remainder


def is_holdout(percent: int = HOLDOUT_PCT) -> Column:
    """CRC-32 split per (user, movie); the third key part is a constant word."""
    key = F.concat(F.col("userId").cast("string"), F.lit(":"), F.col("movieId").cast("string"), F.lit(":timestamp"))
    return F.crc32(key) % 100 < percent


def clip(score: Column) -> Column:
    return F.greatest(F.lit(MIN_RATING), F.least(F.lit(MAX_RATING), score))


def round_binary(value: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: the rounding of array libraries."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def round_exact(value: Column, digits: int) -> Column:
    """Correct decimal rounding of the stored binary value, half to even."""
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit("")).cast("double")


def dot(left: Column, right: Column) -> Column:
    """Inner product of two equal-length double arrays."""
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)


def row_hash(*columns: str, seed: int = SEED) -> Column:
    """Seeded md5 of the named columns, the same text in any SQL engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(name).cast("string") for name in columns]))


def row_digest(*columns: str, seed: int = SEED) -> Column:
    """Seeded md5 over the columns with their lengths, so that nulls and separators cannot be mistaken."""
    texts = [F.col(name).cast("string") for name in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def file_stem(path: Column) -> Column:
    """Last path segment without its extension."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"\.[^.]*$", "")


def hash_number(hex_digest: Column) -> Column:
    """The first 15 hex digits of a digest as a bigint."""
    return F.conv(F.substring(hex_digest, 1, 15), 16, 10).cast("bigint")
