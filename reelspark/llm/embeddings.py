"""Embedding near-duplicates: robust-pruned graphs on overlapping cluster shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from reelspark.llm import vector_graph as graphs
from reelspark.llm.components import connected_components
from reelspark.llm.text import only
from reelspark.operators.ordering import with_offsets
from reelspark.session import broadcast_if_small, drop_buckets, into_buckets, materialise, scratch, short_lived_shuffles, table_path

SHARD_HOME = 250
SHARD_MOST = 6_000
MARGIN = 0.1
SAMPLE = 32_768
CENTRES = 4_096
LEVELS = 4
CHUNK = 16_384
DEGREE = 12
POOL = 32
ALPHA = 1.2
BEAM = 16
RECALL = 0.98
AUDIT_EVERY = 50
_ASSIGN_ROWS = 2_048
_EDGE_ROWS = 20_000
_BUCKET_BYTES = 64 * 1024 * 1024


def _stored_type(df: DataFrame) -> np.dtype:
    """Vectors are kept in the width they come in; all that is computed is in double precision."""
    return np.dtype(np.float32 if isinstance(df.schema["embedding"].dataType.elementType, T.FloatType) else np.float64)


def _normed(values: np.ndarray) -> np.ndarray:
    scaled = values / np.abs(values).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _classes(df: DataFrame) -> DataFrame:
    """(vec_id, class, dim, stored): digest of the unit vector, length and vector; nulls for those that link with nothing."""
    kind = _stored_type(df)

    def rows_of(column: pa.ListArray) -> tuple[list, list, list]:
        offsets, flat = column.offsets.to_numpy(), column.values
        empty = np.concatenate([[0], np.cumsum(flat.is_null().to_numpy(zero_copy_only=False))])
        values = pc.fill_null(pc.cast(flat, pa.float64()), 0.0).to_numpy(zero_copy_only=False)
        starts, sizes = offsets[:-1], np.diff(offsets)
        usable = column.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0) & (empty[offsets[1:]] == empty[starts])
        classes, dims, stored = ([None] * len(column) for _ in range(3))
        for size in np.unique(sizes[usable]).tolist():
            at = np.flatnonzero(usable & (sizes == size))
            block = values[starts[at][:, None] + np.arange(size)]
            scale = np.abs(block).max(axis=1)
            good = np.isfinite(scale) & (scale > 0)
            at, block = at[good], block[good]
            for i, unit, own in zip(at.tolist(), _normed(block), block.astype(kind)):
                classes[i], dims[i], stored[i] = hashlib.blake2b(unit.tobytes(), digest_size=16).digest(), size, own.tobytes()
        return classes, dims, stored

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, dims, stored = rows_of(batch.column("embedding"))
            arrays = [batch.column("vec_id"), pa.array(classes, pa.binary()), pa.array(dims, pa.int64()), pa.array(stored, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "class", "dim", "stored"])

    id_type = df.schema["vec_id"].dataType.simpleString()
    return df.mapInArrow(emit, f"vec_id {id_type}, class binary, dim long, stored binary")


def _units(column: Iterable[bytes], kind: np.dtype) -> np.ndarray:
    parts = list(column)
    return _normed(np.frombuffer(b"".join(parts), kind).reshape(len(parts), -1).astype(np.float64))


def _fitter(kind: np.dtype):
    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        ordered = frame.sort_values("cid")
        k = max(2, min(CENTRES, -(-int(ordered["rows"].iloc[0]) // SHARD_HOME)))
        centres = graphs.kmeans(_units(ordered["stored"], kind), min(k, len(ordered)))
        chunks = int(ordered["chunks"].iloc[0])
        return pd.DataFrame({"shard": ordered["shard"].iloc[0], "chunk": range(chunks), "centres": [centres.tobytes()] * chunks})

    return fit


def _assigner(kind: np.dtype):
    def assign(members: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        units = _units(members["stored"], kind)
        table = np.frombuffer(centres["centres"].iloc[0], np.float64).reshape(-1, units.shape[1])
        rows, subs = [], []
        for lo in range(0, len(units), _ASSIGN_ROWS):
            sims = units[lo : lo + _ASSIGN_ROWS] @ table.T
            row, sub = np.nonzero(sims >= sims.max(axis=1, keepdims=True) - MARGIN)
            rows.append(row + lo), subs.append(sub)
        row, sub = np.concatenate(rows), np.concatenate(subs)
        names = [f"{shard}/{s}" for shard, s in zip(members["shard"].to_numpy()[row], sub, strict=True)]
        return pd.DataFrame({"cid": members["cid"].to_numpy()[row], "shard": names})

    return assign


def _parent() -> Column:
    return F.regexp_replace("shard", "/[^/]*$", "")


def _undivided(sized: DataFrame, members: DataFrame) -> DataFrame:
    """Shards whose parts would together be as much work as they are: a clump within the margin of all its centroids."""
    parts = members.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    work = parts.groupBy(_parent().alias("shard")).agg(F.sum(F.col("n") * F.col("n")).alias("work"))
    return materialise(sized.join(work, "shard").where(2 * F.col("work") > F.col("rows") * F.col("rows")).select("shard"))


def cluster_shards(vectors: DataFrame, kind: np.dtype) -> DataFrame:
    """(cid, dim, stored) -> (cid, shard, rows): overlapping shards, every vector in at least one.

    Centroids come from at most about 32,768 vectors of a shard; each vector goes to every
    centroid within a margin of its best. Only shards too large for a task are divided again, up to
    four levels, as each level multiplies the copies of a vector; what cannot be divided with less
    work in its parts (one dense clump) is later compared in blocks.
    """
    members = vectors.select("cid", F.concat(F.lit("d"), F.col("dim").cast("string")).alias("shard"))
    parts = None
    for level in range(LEVELS):
        sized = materialise(members.groupBy("shard").agg(F.count(F.lit(1)).alias("rows")))
        counted = members.join(sized, "shard")
        final = counted.where(F.col("rows") <= SHARD_MOST)
        parts = final if parts is None else parts.unionByName(final)
        if sized.where(F.col("rows") > SHARD_MOST).isEmpty():
            return materialise(parts.select("cid", "shard", "rows"))
        chunks = F.ceil(F.col("rows") / CHUNK).cast("int")
        large = counted.where(F.col("rows") > SHARD_MOST).join(vectors.select("cid", "stored"), "cid").withColumn("chunks", chunks)
        large = materialise(large.withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int")))
        drawn = large.where(F.pmod(F.xxhash64("cid", F.lit(level)), F.col("rows")) < SAMPLE)
        centres = drawn.groupBy("shard").applyInPandas(_fitter(kind), "shard string, chunk int, centres binary")
        members = materialise(
            large.groupBy("shard", "chunk")
            .cogroup(materialise(centres).groupBy("shard", "chunk"))
            .applyInPandas(_assigner(kind), "cid long, shard string")
        )
        whole = _undivided(sized, members)
        parts = parts.unionByName(counted.join(whole, "shard", "left_semi"))
        members = members.withColumn("parent", _parent()).join(whole.withColumnRenamed("shard", "parent"), "parent", "left_anti").drop("parent")
    sized = members.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
    return materialise(parts.unionByName(members.join(sized, "shard").select(*parts.columns)).select("cid", "shard", "rows"))


def _most_rows() -> int:
    """Rows of a block of a shard that could not be divided: a task holds two."""
    return max(1, SHARD_MOST // 2)


def _tasks(vectors: DataFrame, shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(home, low, high, cid, stored, weight, homes), one task for a shard or for each pair of its blocks, and
    the (home, blocks) of the shards that have several."""
    sized = shards.groupBy("shard").agg(F.first("rows").alias("rows"))
    blocks = F.when(F.col("rows") > SHARD_MOST, F.ceil(F.col("rows") / _most_rows())).otherwise(1).cast("int")
    names = materialise(with_offsets(sized, ["shard"]).select("shard", F.col("pos").cast("int").alias("home"), blocks.alias("blocks")))
    several = names.where(F.col("blocks") > 1).select("home", "blocks")
    placed = shards.select("cid", "shard").join(broadcast_if_small(names, names.count(), 64), "shard")
    homes = placed.groupBy("cid").agg(F.sort_array(F.collect_list("home")).alias("homes"))
    several = materialise(several)
    each = vectors.select("cid", "stored", "weight").join(homes, "cid").withColumn("home", F.explode("homes"))
    each = each.join(broadcast_if_small(several, several.count(), 16), "home", "left")
    block = F.pmod(F.col("cid"), F.coalesce("blocks", F.lit(1))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    dealt = each.withColumn("block", block).withColumn("other", other)
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    return dealt.select("home", low, high, "cid", "stored", "weight", "homes"), several


def _home_table(column: pa.ChunkedArray) -> np.ndarray:
    """The homes of each vector in rising order, padded with -1."""
    lists = column.combine_chunks()
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    table = np.full((len(size), size.max(initial=1)), -1, np.int32)
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    table[np.repeat(np.arange(len(size)), size), place] = lists.flatten().to_numpy()
    return table


def _shared(homes: np.ndarray, q: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Of the homes of ``q``, those that ``node`` has too; -1 for the others."""
    a, b = homes[q], homes[node]
    common = (a[:, :, None] == b[:, None, :]).any(axis=2)
    return np.where(common, a, -1)


def _ordered(group: pa.Table) -> pa.Table:
    return group.combine_chunks().sort_by("cid")


def _builder(kind: np.dtype, several: dict[int, int]):
    def build(group: pa.Table) -> pa.Table:
        """The edges of a task's graph, sent to every task that has both ends: one row per task."""
        ordered = _ordered(group)
        cids, homes = ordered["cid"].to_numpy(), _home_table(ordered["homes"])
        source, target = graphs.robust_prune(_units(ordered["stored"].to_pylist(), kind), DEGREE, POOL, ALPHA)
        source, target = source[source < target], target[source < target]
        found = [np.empty((0, 5), np.int64)]
        for lo in range(0, len(source), _EDGE_ROWS):
            u, v = source[lo : lo + _EDGE_ROWS], target[lo : lo + _EDGE_ROWS]
            edge, slot = np.nonzero((shared := _shared(homes, u, v)) >= 0)
            u, v, home = cids[u[edge]], cids[v[edge]], shared[edge, slot].astype(np.int64)
            divided = np.isin(home, list(several)) if several else np.zeros(len(home), bool)
            whole = home[~divided]
            found.append(np.column_stack([whole, 0 * whole, 0 * whole, u[~divided], v[~divided]]))
            for at in np.unique(home[divided]).tolist():
                here, count = home == at, several[at]
                one, two = u[here] % count, v[here] % count
                for other in range(count):
                    # Two ends in one block meet in every task with that block.
                    meet = (one == two) | (two == other)
                    pair = np.sort(np.column_stack([one[meet], np.where(one == two, other, two)[meet]]), axis=1)
                    found.append(np.column_stack([np.full(len(pair), at), pair, u[here][meet], v[here][meet]]))
        edges = np.concatenate(found)
        edges = edges[np.lexsort(edges.T[::-1])]
        first = np.flatnonzero(np.append(True, (np.diff(edges[:, :3], axis=0) != 0).any(axis=1))) if len(edges) else np.empty(0, np.int64)
        ends = pa.array(np.append(first, len(edges)), pa.int32())
        keys = [pa.array(edges[first, i], pa.int32()) for i in range(3)]
        lists = [pa.ListArray.from_arrays(ends, pa.array(edges[:, i])) for i in (3, 4)]
        return pa.table([*keys, *lists], ["home", "low", "high", "u", "v"])

    return build


def _searcher(least: float, kind: np.dtype, several: dict[int, int]):
    def search(group: pa.Table, edges: pa.Table) -> pa.Table:
        if not len(group):
            return pa.table([pa.array([], pa.int64())] * 3, ["cid", "links", "root"])
        ordered = _ordered(group)
        cids, units, n = ordered["cid"].to_numpy(), _units(ordered["stored"].to_pylist(), kind), len(group)
        u, v = (np.searchsorted(cids, edges[name].combine_chunks().flatten().to_numpy()) for name in ("u", "v"))
        united = np.unique(np.concatenate([u * n + v, v * n + u]))
        graph = graphs.Graph(n, united // n, united % n)
        hit = graphs.audited_matches(units, graph, least, BEAM, RECALL, AUDIT_EVERY)
        # Both directions of a pair count, whichever search met it.
        hit |= hit.T
        np.fill_diagonal(hit, False)
        own, low, high = (ordered[name][0].as_py() for name in ("home", "low", "high"))
        if low != high:
            block = cids % several[own]
            hit &= block[:, None] != block[None, :]
        weight, homes, links = ordered["weight"].to_numpy(), _home_table(ordered["homes"]), np.zeros(n, np.int64)
        for lo in range(0, n, _ASSIGN_ROWS):
            q, node = np.nonzero(hit[lo : lo + _ASSIGN_ROWS])
            for at in range(0, len(q), _EDGE_ROWS):
                a, b = q[at : at + _EDGE_ROWS] + lo, node[at : at + _EDGE_ROWS]
                shared = _shared(homes, a, b)
                first = np.where(shared >= 0, shared, np.iinfo(np.int32).max).min(axis=1) == own
                np.add.at(links, a[first], weight[b[first]])
        return pa.table([pa.array(cids), pa.array(links), pa.array(cids[graphs.local_roots(hit)])], ["cid", "links", "root"])

    return search


def near_duplicates(
    df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.9
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector; links are pairs of cosine ``least`` or more.

    Null, empty or zero vectors and those with null or non-finite components link with nothing and
    are their own component. Vectors of different length do not link. Equal vectors (and repeated
    rows) are one node with a weight and all link with each other. A null vec_id counts as larger
    than any other and is kept only alone. An empty table gives no rows; extra columns are ignored.

    Each task holds one shard of a bounded number of vectors. Graphs are built in the shards, the
    edges of a vector are united over its shards, and the search runs over the united edges
    from the medoid and the query's node, audited against brute force in every shard. A pair
    in several shards counts in the first of them. Similarities are computed in double precision,
    so no pair below the limit is a link.

    Vectors are laid out by task once; after that only edges move, each to the tasks that have both its
    ends. What is written on the way goes when the links are known.
    """
    spark = df.sparkSession
    named = only(df, vec_id=vec_id, embedding=embedding)
    kind = _stored_type(named)
    found = _classes(named)
    rows, kept = materialise(found.select("vec_id", "class")), table_path(spark)
    with scratch(spark), short_lived_shuffles(spark):
        valid = found.where("class IS NOT NULL").groupBy("class", "dim")
        classes = materialise(valid.agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("weight"), F.first("stored").alias("stored")))
        numbers = materialise(with_offsets(classes.select("class"), ["class"]).withColumnRenamed("pos", "cid"))
        vectors = materialise(classes.join(numbers, "class"))
        shards = cluster_shards(vectors, kind)
        dealt, several = _tasks(vectors, shards)
        several = {r["home"]: r["blocks"] for r in several.collect()}  # one entry per shard that one task cannot hold
        buckets = _buckets(vectors, shards)
        keys = ["home", "low", "high"]
        table = into_buckets(dealt.repartition(buckets, *keys), buckets, *keys)
        try:
            tasks = spark.table(table[0])
            edges = tasks.groupBy(*keys).applyInArrow(
                _builder(kind, several), "home int, low int, high int, u array<long>, v array<long>"
            )
            both = tasks.groupBy(*keys).cogroup(edges.groupBy(*keys))
            searched = materialise(both.applyInArrow(_searcher(least, kind, several), "cid long, links long, root long"))
        finally:
            drop_buckets(spark, table)
        info = materialise(_linked(vectors.drop("stored"), searched), path=kept)
    joined = rows.join(info, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")
    result = joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component)
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _buckets(vectors: DataFrame, shards: DataFrame) -> int:
    """Several tasks' worth for every core, and none of more than about ``_BUCKET_BYTES``."""
    size = vectors.agg(F.avg(F.length("stored"))).first()[0] or 0
    facts = shards.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("shard").alias("shards")).first()
    least = min(facts["shards"], 4 * vectors.sparkSession.sparkContext.defaultParallelism)
    return max(1, least, int(facts["rows"] * (size + 100)) // _BUCKET_BYTES)


def _linked(placed: DataFrame, searched: DataFrame) -> DataFrame:
    """(class, n_links, component_id) of every class."""
    links = searched.groupBy("cid").agg(F.sum("links").alias("links"))
    edges = searched.where("cid <> root").select(F.col("root").alias("u"), F.col("cid").alias("v"))
    parts = connected_components(edges).withColumnRenamed("node", "cid")
    joined = placed.join(links, "cid", "left").join(parts, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    lowest = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    n_links = (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    return joined.join(lowest, "component").select("class", n_links, "component_id")
