"""Dataset profile from mergeable parts: counts that add up and bitmaps that are united.

A part tells how one set of changes moves the profile. Counts are signed whole numbers per rating
value, user, movie and range of users, so a replaced rating takes its old value out and parts merge
exactly in any order. An upsert never removes a key, so the ids seen only grow: they are bitmaps
per bucket of 32,768 ids, from which distinct counts are read without a pass over the ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelspark.constants import COLD_START_RATINGS
from reelspark.functions.scalar import hash_number, row_digest
from reelspark.operators.ingest import KEY

STATE = "kind STRING, id BIGINT, rating DOUBLE, n BIGINT, hash DECIMAL(38,0), bits BINARY"

RANGE_USERS = 4096
_MODULUS = 1 << 60
_ENTITIES = {"user": "userId", "movie": "movieId"}


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """The keys of ``after`` whose rating is new or another one: key, rating, old_rating (null if new).

    ``before`` needs the rows of these keys only; both hold a key once.
    """
    old = before.select(*KEY, F.col("rating").cast("double").alias("old_rating"))
    joined = after.select(*KEY, F.col("rating").cast("double").alias("rating")).join(old, list(KEY), "left")
    return joined.where(F.col("old_rating").isNull() | (F.col("old_rating") != F.col("rating")))


def changes_within(rows: DataFrame, order: str, known: Column) -> DataFrame:
    """The same from all rows of some keys, in one pass: the newest of the ``known`` rows against the newest
    of all. Keys without a row that is not known are left out."""
    value = F.struct(F.col(order), F.col("rating").cast("double").alias("rating"))
    newest = rows.withColumn("_known", known).groupBy(*KEY).agg(
        F.max(value).alias("_now"), F.max(F.when(F.col("_known"), value)).alias("_then"), F.min("_known").alias("_known")
    )
    found = newest.where(~F.col("_known")).select(
        *KEY, F.col("_now.rating").alias("rating"), F.col("_then.rating").alias("old_rating")
    )
    return found.where(F.col("old_rating").isNull() | (F.col("old_rating") != F.col("rating")))


def _signed(changed: DataFrame) -> DataFrame:
    """Each change as the row that comes (n = 1) and the one that goes (n = -1)."""
    comes = F.struct(F.col("rating").alias("rating"), F.lit(1).cast("bigint").alias("n"))
    goes = F.struct(F.col("old_rating").alias("rating"), F.lit(-1).cast("bigint").alias("n"))
    sides = F.when(F.col("old_rating").isNull(), F.array(comes)).otherwise(F.array(comes, goes))
    return changed.select(*KEY, F.explode(sides).alias("s")).select(*KEY, "s.rating", "s.n")


def _added(column: str) -> Column:
    """Sum modulo 2^60, between zero and it."""
    modulus = F.lit(_MODULUS).cast("decimal(38,0)")
    return F.pmod(F.sum(column), modulus).cast("decimal(38,0)").alias(column)


def part(changed: DataFrame) -> DataFrame:
    """How a set of changes moves the profile, in the columns of ``STATE``."""
    rows = _signed(changed)
    digest = hash_number(row_digest("userId", "movieId", "timestamp", "rating")).cast("decimal(38,0)")
    rows = rows.withColumn("hash", digest * F.col("n"))
    number = F.lit(None).cast("bigint")
    kinds = [
        ("rating", number, F.col("rating")),
        *[(kind, F.col(column).cast("bigint"), F.col("rating")) for kind, column in _ENTITIES.items()],
        ("range", F.floor(F.col("userId") / RANGE_USERS).cast("bigint"), F.lit(None).cast("double")),
    ]
    targets = F.array(*[F.struct(F.lit(k).alias("kind"), i.alias("id"), r.alias("rating")) for k, i, r in kinds])
    spread = rows.select(F.explode(targets).alias("t"), "n", "hash")
    hashed = F.when(F.col("t.kind") == "range", F.col("hash"))
    counted = spread.select("t.*", "n", hashed.alias("hash"), F.lit(None).cast("binary").alias("bits"))
    return _sums(counted).unionByName(_ids(changed))


def _sums(rows: DataFrame) -> DataFrame:
    summed = rows.groupBy("kind", "id", "rating").agg(F.sum("n").alias("n"), _added("hash"))
    kept = (F.col("n") != 0) | (F.col("hash") != 0)
    return summed.where(kept).select("kind", "id", "rating", "n", "hash", F.lit(None).cast("binary").alias("bits"))


def _ids(changed: DataFrame) -> DataFrame:
    """Bitmaps of the users and movies; a bucket's bitmap is built in the tasks and united after."""
    found = None
    for kind, column in _ENTITIES.items():
        bits = changed.groupBy(F.bitmap_bucket_number(column).alias("id")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("bits")
        )
        rows = bits.select(
            F.lit(f"{kind}_ids").alias("kind"), "id", F.lit(None).cast("double").alias("rating"),
            F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("decimal(38,0)").alias("hash"), "bits",
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def merge(parts: DataFrame) -> DataFrame:
    """One state from any number of parts or states, in any order."""
    united = parts.where(F.col("bits").isNotNull()).groupBy("kind", "id").agg(F.bitmap_or_agg("bits").alias("bits"))
    ids = united.select(
        "kind", "id", F.lit(None).cast("double").alias("rating"), F.lit(0).cast("bigint").alias("n"),
        F.lit(None).cast("decimal(38,0)").alias("hash"), "bits",
    )
    return _sums(parts.where(F.col("bits").isNull())).unionByName(ids)


# --- readings ---------------------------------------------------------------------------


def _of(state: DataFrame, kind: str) -> DataFrame:
    return state.where(F.col("kind") == kind)


def _distinct(state: DataFrame, kind: str) -> Column:
    counted = _of(state, f"{kind}_ids").agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))
    return counted.scalar()


def _total() -> Column:
    return F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")


def overview(state: DataFrame, movies: DataFrame) -> DataFrame:
    """The figures of ``profile.dataset_overview``."""
    n, total, squares = F.sum("n"), F.sum(F.col("n") * F.col("rating")), F.sum(F.col("n") * F.col("rating") ** 2)
    variance = (squares - total * total / n) / (n - 1)
    sums = _of(state, "rating").agg(
        _total().alias("total_ratings"),
        (total / F.when(n != 0, n)).alias("avg_rating"),
        F.when(n > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("rating_std"),
    )
    return sums.select(
        "total_ratings", _distinct(state, "user").alias("users"), _distinct(state, "movie").alias("movies_rated"),
        "avg_rating", "rating_std", movies.agg(F.count(F.lit(1))).scalar().alias("catalog_size"),
    )


def sparsity(state: DataFrame) -> DataFrame:
    """The figures of ``profile.matrix_sparsity``."""
    possible = _distinct(state, "user") * _distinct(state, "movie")
    sizes = _of(state, "rating").agg(_total().alias("actual")).withColumn("possible", possible)
    share = (F.lit(1.0) - F.col("actual") / F.when(F.col("possible") != 0, F.col("possible"))) * 100
    return sizes.select("possible", "actual", share.alias("sparsity_pct"), (100 - share).alias("density_pct"))


def distribution(state: DataFrame) -> DataFrame:
    counts = _of(state, "rating").select("rating", "n")
    return counts.withColumn("pct", F.col("n") * 100.0 / counts.agg(F.sum("n")).scalar())


def entities(state: DataFrame, kind: str) -> DataFrame:
    """Count and mean of each user or movie."""
    return _of(state, kind).groupBy(F.col("id").cast("int").alias(_ENTITIES[kind])).agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("rating")) / F.sum("n")).alias("mean_rating")
    )


def cold_start(state: DataFrame, threshold: int = COLD_START_RATINGS) -> DataFrame:
    """Users and movies with fewer than ``threshold`` ratings."""
    found = None
    for kind in _ENTITIES:
        counted = entities(state, kind).agg(F.count_if(F.col("n") < threshold).alias("cold"), F.count(F.lit(1)).alias("total"))
        share = F.col("cold") * 100.0 / F.when(F.col("total") != 0, F.col("total"))
        row = counted.select(F.lit(kind).alias("entity"), "cold", "total", share.alias("pct"))
        found = row if found is None else found.unionByName(row)
    return found


def ranges(state: DataFrame) -> DataFrame:
    """Rows and additive digest of each range of ``RANGE_USERS`` user ids."""
    return _of(state, "range").select(F.col("id").alias("range_no"), "n", F.col("hash").cast("bigint").alias("digest"))


def version(state: DataFrame) -> DataFrame:
    """Rows and additive digest of the whole table: equal for equal tables, however they came about."""
    return _of(state, "range").agg(_total().alias("n"), F.coalesce(_added("hash"), F.lit(0)).cast("bigint").alias("digest"))


def differing_ranges(one: DataFrame, other: DataFrame) -> DataFrame:
    """The ranges in which two states differ, with both counts; zero where one has no rows."""
    left = ranges(one).select("range_no", F.col("n").alias("n_one"), F.col("digest").alias("_a"))
    right = ranges(other).select("range_no", F.col("n").alias("n_other"), F.col("digest").alias("_b"))
    both = left.join(right, "range_no", "full")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b")) | ~F.col("n_one").eqNullSafe(F.col("n_other"))).select(
        "range_no", F.coalesce("n_one", F.lit(0)).alias("n_one"), F.coalesce("n_other", F.lit(0)).alias("n_other")
    )
