"""Ratings and movies at rest: an append-only batch log merged into a grid of buckets.

A batch is published as one partition of the log, so publishing the same batch again
replaces it with itself. ``compact`` merges batches into the base, a grid of user slices by
movie slices, and rewrites only the buckets they touch; a manifest names the newest copy of each
bucket and the batches in it. The current table is the base with the rows of newer batches in
place of their own keys, so the base is never shuffled. Nothing is overwritten while it is being read.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from reelspark.constants import BROADCAST_BYTES
from reelspark.operators import rollup
from reelspark.operators.ingest import KEY, latest_by_key
from reelspark.session import broadcast_if_small, materialise, scratch
from reelspark.sources import files
from reelspark.sources.schema import MOVIES, RATINGS, RATINGS_TAGGED

_LOG = T.StructType([*RATINGS_TAGGED.fields, T.StructField("batch_seq", T.LongType(), True)])
_REJECTS = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("userId", "movieId", "rating", "timestamp")]
    + [
        T.StructField("batch_id", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("batch_seq", T.LongType()),
    ]
)


_MANIFEST = "bucket INT, version INT, batch_seq BIGINT, slices INT"
_SLICES = 16
_KEY_BYTES = 48


def _slice(column: str, slices: int) -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(slices)).cast("int")


def _bucket(slices: int) -> Column:
    return _slice("userId", slices) * slices + _slice("movieId", slices)


def _slice_of(value: int, slices: int) -> int:
    return zlib.crc32(str(value).encode()) % slices


@dataclass(frozen=True)
class Base:
    """One state of the merged table: the version that holds each bucket, and the batches merged."""

    buckets: dict[int, int]
    batches: frozenset[int]
    slices: int


def _typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select(*[F.col(field.name).cast(field.dataType) for field in schema])


@dataclass(frozen=True)
class RatingsStore:
    spark: SparkSession
    root: str
    slices: int = _SLICES

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def init_schema(self) -> None:
        """Create the tables that do not exist yet; safe to repeat."""
        for name, schema, partition in (
            ("log", _LOG, "batch_seq"),
            ("rejects", _REJECTS, "batch_seq"),
            ("movies/version=0", MOVIES, None),
        ):
            if not files.published(self.spark, self._at(name)):
                writer = self.spark.createDataFrame([], schema).write.mode("append")
                (writer.partitionBy(partition) if partition else writer).parquet(self._at(name))

    def publish(self, rows: DataFrame) -> None:
        """Write rows carrying batch_seq; an earlier copy of the same batches is replaced."""
        self._replace_partitions(_typed(rows, _LOG), "log")

    def reject(self, rows: DataFrame) -> None:
        self._replace_partitions(_typed(rows, _REJECTS), "rejects")

    def _replace_partitions(self, rows: DataFrame, name: str) -> None:
        # A batch comes from few tasks, clustered by user: few files, and readers skip by min/max.
        keys = [key for key in ("batch_seq", *KEY) if key in rows.columns]
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_seq").parquet(self._at(name))

    def log(self) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(self._at("log"))

    def rejects(self) -> DataFrame:
        return self.spark.read.schema(_REJECTS).parquet(self._at("rejects"))

    def _versions(self, folder: str) -> list[int]:
        names = files.list_names(self.spark, self._at(folder))
        numbers = [int(name.split("=", 1)[1]) for name in names if "=" in name]
        return sorted(n for n in numbers if files.published(self.spark, self._at(f"{folder}/version={n}")))

    def claim_batch(self, owner: str, after: int = -1) -> int:
        """A batch number above ``after`` and all published ones that no other owner has or gets.

        An owner that asks again gets the number it holds.
        """
        folder = self._at("claims/batches")
        held = f"{folder}/of/{uuid.uuid5(uuid.NAMESPACE_URL, owner).hex}"
        before = files.claimed_by(self.spark, held)
        if not before:
            last = files.last_claim(self.spark, folder)
            start = max([after, -1 if last is None else last, *self.batches()])
            before = str(files.claim_number(self.spark, folder, start, owner))
            # Noted after the claim: an owner lost in between leaves a number unused.
            files.claim(self.spark, held, before)
        return int(before)

    def batches(self) -> list[int]:
        """Published batch numbers."""
        names = files.list_names(self.spark, self._at("log"))
        return sorted(int(name.split("=", 1)[1]) for name in names if name.startswith("batch_seq=") and name[10:].isdigit())

    def base(self) -> Base:
        versions = self._versions("manifest")
        if not versions:
            return Base({}, frozenset(), self.slices)
        rows = self.spark.read.schema(_MANIFEST).json(self._at(f"manifest/version={versions[-1]}")).collect()
        buckets = {row["bucket"]: row["version"] for row in rows if row["bucket"] is not None}
        merged = frozenset(row["batch_seq"] for row in rows if row["batch_seq"] is not None)
        return Base(buckets, merged, rows[0]["slices"])

    def _merged_rows(self, base: Base, wanted: list[int]) -> DataFrame:
        """The rows of some buckets; no other file is opened."""
        paths = [self._at(f"base/version={base.buckets[b]}/bucket={b}") for b in sorted(wanted) if b in base.buckets]
        if not paths:
            return self.spark.createDataFrame([], _LOG)
        return self.spark.read.schema(_LOG).parquet(*paths)

    def _newer(self, base: Base) -> DataFrame:
        """Rows of the log that the base does not hold yet; a batch may be older than merged ones."""
        return self.log().where(F.col("batch_seq").isin([b for b in self.batches() if b not in base.batches]))

    def _overlaid(self, merged: DataFrame, newer: DataFrame) -> DataFrame:
        """``merged`` with the newest row of each key of ``newer``.

        While its keys fit a broadcast, only merged rows with such a key are grouped and the others pass
        as they are. Beyond that one aggregate over all settles every key.
        """
        rows = newer.count()
        if rows * _KEY_BYTES > BROADCAST_BYTES:
            return latest_by_key(merged.unionByName(newer), "batch_seq").select(*merged.columns)
        keys = broadcast_if_small(newer.select(*KEY).distinct(), rows, _KEY_BYTES)
        settled = latest_by_key(merged.join(keys, list(KEY), "left_semi").unionByName(newer), "batch_seq")
        return merged.join(keys, list(KEY), "left_anti").unionByName(settled.select(*merged.columns))

    def current(self, user: int | None = None, movie: int | None = None) -> DataFrame:
        """The newest row of every key, or of one user's or movie's keys; those read one row or
        column of the grid."""
        base = self.base()
        buckets = [
            b for b in base.buckets
            if (user is None or b // base.slices == _slice_of(user, base.slices))
            and (movie is None or b % base.slices == _slice_of(movie, base.slices))
        ]
        merged, newer = self._merged_rows(base, buckets), self._newer(base)
        for column, value in (("userId", user), ("movieId", movie)):
            if value is not None:
                merged, newer = (rows.where(F.col(column) == value) for rows in (merged, newer))
        if not base.buckets:
            return latest_by_key(newer, "batch_seq").select(*_LOG.names)
        return merged if newer.isEmpty() else self._overlaid(merged, newer)

    def compact(self) -> int:
        """Merge the batches the base does not hold; returns the newest batch of all.

        Only buckets with a row of such a batch are rewritten, and the manifest is written last.
        Compactions that run at once each write a whole state of their own; the later one counts, and
        what it lacks is still in the log.
        """
        published = self.batches()
        if not published:
            raise ValueError("nothing to compact: the log is empty")
        base = self.base()
        fresh = [b for b in published if b not in base.batches]
        if fresh:
            newer = self.log().where(F.col("batch_seq").isin(fresh))
            bucket = _bucket(base.slices)
            touched = [row["b"] for row in newer.select(bucket.alias("b")).distinct().collect()]
            last = files.last_claim(self.spark, self._at("claims/versions"))
            version = files.claim_number(self.spark, self._at("claims/versions"), -1 if last is None else last, uuid.uuid4().hex)
            # Copies of a hot key are combined first; then the base is shuffled once, into range partitions in
            # which each key's rows lie together: readers skip files by min/max on userId.
            settled = latest_by_key(newer, "batch_seq").select(*_LOG.names)
            rows = self._merged_rows(base, touched).unionByName(settled).withColumn("bucket", bucket)
            rows = rows.repartitionByRange("bucket", *KEY)
            carried = [name for name in _LOG.names if name not in KEY and name != "batch_seq"]
            newest = F.max(F.struct("batch_seq", *carried)).alias("w")
            rows = rows.groupBy("bucket", *KEY).agg(newest).select("bucket", *KEY, "w.*").select(*_LOG.names, "bucket")
            rows = rows.sortWithinPartitions("bucket", *KEY)
            rows.write.mode("overwrite").partitionBy("bucket").parquet(self._at(f"base/version={version}"))
            buckets = {**base.buckets, **dict.fromkeys(touched, version)}
            entries = [(b, v, None, base.slices) for b, v in sorted(buckets.items())]
            entries += [(None, None, b, base.slices) for b in sorted({*base.batches, *fresh})]
            manifest = self.spark.createDataFrame(entries, _MANIFEST).coalesce(1)
            manifest.write.mode("overwrite").json(self._at(f"manifest/version={version}"))
        return published[-1]

    def _changes(self, done: frozenset[int], fresh: list[int]) -> DataFrame:
        """The keys whose rating the fresh batches make another one, next to the done ones."""
        base = self.base()
        new = self.log().where(F.col("batch_seq").isin(fresh))
        old = self.log().where(F.col("batch_seq").isin(sorted(done)))
        if base.batches and base.batches <= done:
            touched = [row["b"] for row in new.select(_bucket(base.slices).alias("b")).distinct().collect()]
            late = self.log().where(F.col("batch_seq").isin(sorted(done - base.batches)))
            old = self._merged_rows(base, touched).unionByName(late)
        columns = [*KEY, "rating", "batch_seq"]
        new, old = new.select(*columns), old.select(*columns)
        rows = new.count()
        if rows * _KEY_BYTES <= BROADCAST_BYTES:
            # Only old rows with such a key meet the shuffle.
            old = old.join(broadcast_if_small(new.select(*KEY).distinct(), rows, _KEY_BYTES), list(KEY), "left_semi")
        return rollup.changes_within(old.unionByName(new), "batch_seq", ~F.col("batch_seq").isin(fresh))

    def _profiled(self) -> tuple[int, frozenset[int], list[str]]:
        """The last commit of the profile, the batches in it and the folders of its parts."""
        last, batches, parts = -1, set(), []
        for name in files.list_names(self.spark, self._at("profile/commits")):
            if name.isdigit():
                last = int(name)
                text = files.claimed_by(self.spark, self._at(f"profile/commits/{name}"))
                if text:
                    entry = json.loads(text)
                    batches.update(entry["batches"])
                    parts.append(self._at(f"profile/parts/{entry['part']}"))
        return last, frozenset(batches), parts

    def update_profile(self, patience: float = 10.0) -> list[int]:
        """Take the published batches the profile lacks into it; returns their numbers.

        Reads these batches and the rows before them, of which only those with their keys are shuffled while
        the keys fit a broadcast. The part is
        written first and counts once its commit is claimed; when another caller commits first, it is
        worked out anew. A commit left empty by a lost writer is passed over after ``patience`` seconds.
        """
        while True:
            last, done, _ = self._profiled()
            fresh = [b for b in self.batches() if b not in done]
            if not fresh:
                return []
            name = uuid.uuid4().hex
            # The part counts the changes in three ways: they are found once.
            with scratch(self.spark):
                changed = materialise(self._changes(done, fresh))
                rollup.part(changed).write.parquet(self._at(f"profile/parts/{name}"))
            commit = self._at(f"profile/commits/{last + 1:012d}")
            if files.claim(self.spark, commit, json.dumps({"part": name, "batches": fresh})):
                return fresh
            until = time.monotonic() + patience
            while not files.claimed_by(self.spark, commit) and time.monotonic() < until:
                time.sleep(0.2)

    def profile(self) -> DataFrame:
        """The state of the profile as of the batches taken into it."""
        _, _, parts = self._profiled()
        if not parts:
            return self.spark.createDataFrame([], rollup.STATE)
        return rollup.merge(self.spark.read.schema(rollup.STATE).parquet(*parts))

    def movies(self) -> DataFrame:
        return self.spark.read.schema(MOVIES).parquet(self._at(f"movies/version={self._versions('movies')[-1]}"))

    def refresh_catalogue(self, movies: DataFrame, discard_ratings: bool) -> "RatingsStore":
        """Load a new catalogue. A full refresh starts with no ratings, which the caller
        must allow: the ratings go on in a fresh store under a new root."""
        if not discard_ratings:
            raise ValueError("a catalogue refresh discards the ratings; pass discard_ratings=True")
        generation = len([n for n in files.list_names(self.spark, self.root) if n.startswith("generation=")]) + 1
        fresh = RatingsStore(self.spark, self._at(f"generation={generation}"))
        fresh.init_schema()
        fresh.load_movies(movies)
        return fresh

    def load_movies(self, movies: DataFrame) -> None:
        versions = self._versions("movies")
        number = versions[-1] + 1 if versions else 0
        _typed(movies, MOVIES).write.mode("overwrite").parquet(self._at(f"movies/version={number}"))


def append_ratings(rows: DataFrame, path: str) -> int:
    """Plain insert of the required columns; returns the number of rows written."""
    seen = Observation()
    _typed(rows, RATINGS).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def replace_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def create_tables(spark: SparkSession, database: str) -> None:
    """Namespace and empty catalogue tables, created only where missing."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{database}`")
    for name, schema in (("ratings", RATINGS_TAGGED), ("movies", MOVIES)):
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet")
