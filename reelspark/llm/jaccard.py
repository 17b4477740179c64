"""N-gram Jaccard join: prefixes with grouped documents, exact filters, then verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from reelspark.llm.components import connected_components
from reelspark.llm.shingles import WordHasher, shingle_set, text_words
from reelspark.llm.text import only
from reelspark.session import broadcast_if_small, materialise

HEAVY_ROWS = 32
HEAVY_TOKENS = 1 << 20
SMALL_LIST = 64
CENTRES = 32
BLOCK = 512
_CELL_SHARE = 64


def _prefix_length(n: int, pct: int) -> int:
    """Tokens of which a set of ``n`` shares one at least with each set it is similar to."""
    return n - -(-pct * n // 100) + 1


def _ordered(tokens: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """Sorted tokens in the global order: those known to be frequent last."""
    if not len(heavy):
        return tokens
    late = heavy[np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)] == tokens
    return np.concatenate([tokens[~late], tokens[late]])


def _cell_counts(tokens: np.ndarray) -> np.ndarray:
    """Tokens per cell of the digest space; the number of cells, a power of two, grows with the set."""
    cells = max(64, 1 << int(len(tokens) // _CELL_SHARE).bit_length())
    place = (tokens.view(np.uint64) >> np.uint64(64 - (cells.bit_length() - 1))).astype(np.int64)
    return np.minimum(np.bincount(place, minlength=cells), 255).astype(np.uint8)


def _least_differences(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Tokens that at least differ between two sets of each row, from their cell counts."""
    width_a, width_b = (pc.binary_length(x).to_numpy(zero_copy_only=False) for x in (left, right))
    least = np.empty(len(left), np.int64)
    for wide in np.unique(np.stack([width_a, width_b]), axis=1).T:
        rows = np.flatnonzero((width_a == wide[0]) & (width_b == wide[1]))
        cells = int(wide.min())
        parts = []
        for column in (left, right):
            packed = b"".join(column.take(pa.array(rows)).to_pylist())
            parts.append(np.frombuffer(packed, np.uint8).reshape(len(rows), cells, -1).sum(axis=2, dtype=np.int64))
        least[rows] = np.abs(parts[0] - parts[1]).sum(axis=1)
    return least


def _similar(common, n_a, n_b, pct: int):
    """Numbers or arrays of them."""
    return 100 * common >= pct * (n_a + n_b - common)


def _heavy_tokens(docs: DataFrame, size: int, pct: int) -> np.ndarray:
    """The tokens found near the front of more than 32 documents, over all documents.

    Twice the length of a prefix is counted, as putting some tokens last brings others forward.
    Any set may stand last in the global order and results stay exact, so the bound on its size
    (the 2^20 most frequent) decides speed alone.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            found = [np.empty(0, np.int64)]
            for words in text_words(batch.column("text"), hasher):
                tokens = shingle_set(words, size)
                found.append(tokens[: 2 * _prefix_length(len(tokens), pct) if len(tokens) else 0])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["token"])

    counts = docs.select("text").mapInArrow(emit, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    top = counts.where(F.col("n") > HEAVY_ROWS).orderBy(F.desc("n"), "token").limit(HEAVY_TOKENS)
    return np.sort(top.select("token").toArrow()["token"].to_numpy())


_SKETCH = "doc_id {}, n long, class binary, bundle binary, prefix array<bigint>, cells binary"


def _sketches(docs: DataFrame, size: int, pct: int, heavy: np.ndarray) -> DataFrame:
    """Per row: set size, digest of the set (its class), digest of prefix and size (its bundle),
    prefix tokens and cell counts."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            n, classes, bundles, prefixes, cells = [], [], [], [], []
            for words in text_words(batch.column("text"), hasher):
                tokens = shingle_set(words, size)
                n.append(len(tokens))
                if not len(tokens):
                    classes.append(None), bundles.append(None), prefixes.append(None), cells.append(None)
                    continue
                prefix = _ordered(tokens, heavy)[: _prefix_length(len(tokens), pct)]
                classes.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                bundles.append(hashlib.blake2b(prefix.tobytes(), digest_size=16, key=str(len(tokens)).encode()).digest())
                prefixes.append(prefix)
                cells.append(_cell_counts(tokens).tobytes())
            arrays = [batch.column("doc_id"), pa.array(n, pa.int64())]
            arrays += [pa.array(x, pa.binary()) for x in (classes, bundles)]
            arrays += [pa.array(prefixes, pa.list_(pa.int64())), pa.array(cells, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "class", "bundle", "prefix", "cells"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(emit, _SKETCH.format(id_type))


def _sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(class, tokens) for the wanted classes, from one document of each; made again from the
    texts, which is cheaper than keeping the sets of all documents."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            classes, sets = [], []
            for words in text_words(batch.column("text"), hasher):
                tokens = shingle_set(words, size).tobytes()
                classes.append(hashlib.blake2b(tokens, digest_size=16).digest())
                sets.append(tokens)
            arrays = [batch.column("doc_id"), pa.array(classes, pa.binary()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["_id", "class", "tokens"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    few = broadcast_if_small(wanted, wanted.count(), 64)
    # Where the wanted ids can be broadcast, only their texts are hashed again.
    ids = few.select(F.col("first_id").alias("_first"))
    source = docs if few is wanted else docs.join(F.broadcast(ids), docs["doc_id"].eqNullSafe(ids["_first"]), "left_semi")
    made = source.mapInArrow(emit, f"_id {id_type}, class binary, tokens binary")
    one = made.join(few, "class").where(F.col("_id").eqNullSafe(F.col("first_id")))
    return materialise(one.select("class", "tokens").dropDuplicates(["class"]))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, pct: int) -> DataFrame:
    """Of class pairs (a, b), those similar by their full sets."""
    pairs = materialise(pairs)
    named = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    sets = _sets_of(docs, materialise(named.join(classes.select("class", "first_id"), "class")), size)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("tokens_a"), batch.column("tokens_b"), strict=True):
                a, b = np.frombuffer(left.as_buffer(), np.int64), np.frombuffer(right.as_buffer(), np.int64)
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                keep.append(_similar(int((b[at] == a).sum()), len(a), len(b), pct))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_a = pairs.join(sets.select(F.col("class").alias("a"), F.col("tokens").alias("tokens_a")), "a")
    with_b = with_a.join(sets.select(F.col("class").alias("b"), F.col("tokens").alias("tokens_b")), "b")
    return materialise(with_b.select("a", "b", "tokens_a", "tokens_b").mapInArrow(check, "a binary, b binary"))


def _filtered(pairs: DataFrame, pct: int) -> DataFrame:
    """Distinct pairs (a, b, n_a, n_b, cells_a, cells_b) that size and cell counts let be similar."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(name).to_numpy() for name in ("n_a", "n_b"))
            differ = _least_differences(batch.column("cells_a"), batch.column("cells_b"))
            # |a & b| = (|a| + |b| - |a ^ b|) / 2
            yield batch.select(["a", "b"]).filter(pa.array(_similar((n_a + n_b - differ) // 2, n_a, n_b, pct)))

    fits = (100 * F.least("n_a", "n_b") >= pct * F.greatest("n_a", "n_b")) & (F.col("a") != F.col("b"))
    kept = pairs.where(fits).select("a", "b", "n_a", "n_b", "cells_a", "cells_b").mapInArrow(check, "a binary, b binary")
    return kept.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _sides(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    named = lambda df, s: df.select(*on, *[F.col(c).alias(f"{c}_{s}") for c in df.columns if c not in on])
    joined = named(left, "a").join(named(right, "b"), on)
    return joined.withColumnsRenamed({"class_a": "a", "class_b": "b"})


def _reaches(pct: int) -> Column:
    """Whether a pair can be similar if this token is its first in common: what follows it in both
    sets must be enough. A similar pair passes at its first common token."""
    most = 1 + F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) - 1
    return (100 + pct) * most >= pct * (F.col("n_a") + F.col("n_b"))


def _fold(column: pd.Series, cells: int) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.uint8).reshape(cells, -1).sum(axis=1) for x in column]).astype(np.int32)


def _across_components(lists: DataFrame, pct: int) -> DataFrame:
    """Distinct pairs (a, b) of a list that are in different components and may be similar.

    Rows of a size step meet those of the step and the one above, in pairs of blocks of bounded
    size, so a list of any length is spread over tasks and only what passes all filters comes out.
    """

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        low, high = frame["low"].iloc[0], frame["high"].iloc[0]
        cells = _fold(frame["cells"], frame["cells"].str.len().min())
        n, pos, block = (frame[name].to_numpy() for name in ("n", "pos", "block"))
        names, component, home = frame["class"].to_numpy(), pd.factorize(frame["component"])[0], frame["home"].to_numpy()
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        found_a, found_b = [], []
        for i in left:
            j = right[(component[right] != component[i]) & (home[right] | home[i])]
            if low == high:
                j = j[j > i]
            after = np.minimum(n[i] - pos[i], n[j] - pos[j])
            j = j[((100 + pct) * after >= pct * (n[i] + n[j])) & (100 * np.minimum(n[i], n[j]) >= pct * np.maximum(n[i], n[j]))]
            differ = np.abs(cells[j] - cells[i]).sum(axis=1)
            j = j[_similar((n[i] + n[j] - differ) // 2, n[i], n[j], pct)]
            found_a.extend([names[i]] * len(j))
            found_b.extend(names[j])
        return pd.DataFrame({"a": found_a, "b": found_b})

    own = ["class", "n", "pos", "cells", "component"]
    group = F.explode(F.array("step", F.col("step") - 1)).alias("group")
    placed = lists.select("token", group, "step", *own).withColumn("home", F.expr("group = step")).drop("step")
    sized = placed.groupBy("token", "group").agg(F.count(F.lit(1)).alias("size"), F.max("home").alias("homes")).where("homes")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = placed.join(sized, ["token", "group"]).withColumn("blocks", blocks)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    tasks = paired.select("token", "group", "low", "high", "block", "home", *own).groupBy("token", "group", "low", "high")
    pairs = tasks.applyInPandas(compare, "a binary, b binary")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _candidates(lists: DataFrame, pct: int) -> DataFrame:
    """Pairs within the token lists (token, step, class, n, pos, cells, rows).

    All pairs of a small list; in a larger one each row with the centres of its size step and the
    one above, drawn by digest anew for each token. Either way a row meets a bounded number of others.
    """
    own = ["class", "n", "pos", "cells"]
    small, large = lists.where(F.col("rows") <= SMALL_LIST), lists.where(F.col("rows") > SMALL_LIST)
    every = _sides(small.select("token", *own), small.select("token", *own), ["token"])
    # The limit on the rank is applied before the shuffle, so no list comes together whole.
    place = F.row_number().over(Window.partitionBy("token", "step").orderBy(F.xxhash64("class", "token"), "class"))
    centre = large.withColumn("_place", place).where(F.col("_place") <= CENTRES).select("token", "step", *own)
    reach = large.select("token", F.explode(F.array("step", F.col("step") + 1)).alias("step"), *own)
    return every.where("a < b").where(_reaches(pct)).unionByName(_sides(reach, centre, ["token", "step"]).drop("step"))


def _components(classes: DataFrame, links: DataFrame) -> DataFrame:
    found = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    joined = classes.join(found.withColumnRenamed("node", "class"), "class", "left")
    return materialise(joined.withColumn("component", F.coalesce("component", "class")))


def similar_documents(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, pct: int = 80
) -> DataFrame:
    """doc_id, n_shingles, component_id of each row: documents link when the Jaccard similarity of
    their sets of ``size``-word shingles is ``pct`` percent at least.

    A null, empty or blank text has no shingles, links with nothing and is its own component; a
    text with fewer words has its whole sequence as one. Repeated rows are copies of each other.
    A null doc_id counts as larger than any other. An empty table gives no rows; extra columns are
    ignored; texts are read whole, however long.

    1. Equal sets are one class. Classes of equal prefix and size are one bundle. Prefixes follow
       an order in which shingles frequent in prefixes, counted over all documents, come last.
    2. Bundles that share a prefix token are compared: all pairs in a short list, through centres
       in a long one, and the members of a bundle through one of them.
    3. Verified links join classes to components. Lists that are not settled and still span
       several components are expanded to members and compared in blocks across components, which
       makes the result exact without the pairs inside a group of near copies.
    Cell counts (how many tokens fall in each part of the digest space) bound the difference of
    two sets from below and remove nearly all false pairs before any full set is moved.
    """
    docs = only(df, doc_id=doc_id, text=text)
    heavy = _heavy_tokens(docs, size, pct)
    rows = materialise(_sketches(docs, size, pct, heavy))
    first = lambda name: F.first(name).alias(name)
    classes = materialise(
        rows.where("class IS NOT NULL")
        .groupBy("class")
        .agg(F.min("doc_id").alias("first_id"), first("n"), first("bundle"), first("prefix"), first("cells"))
    )
    member = classes.select("bundle", "class", "n", "cells")
    # One member stands for its bundle.
    heads = classes.groupBy("bundle").agg(
        F.min_by(F.struct("class", "n", "cells", "prefix"), "class").alias("h"), F.count(F.lit(1)).alias("members")
    )
    heads = materialise(heads.select("bundle", "members", "h.*"))
    step = F.floor(F.log(F.col("n")) / np.log(100 / pct)).cast("int").alias("step")
    postings = heads.select(F.posexplode("prefix").alias("pos", "token"), "bundle")
    lengths = postings.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    shared = materialise(postings.join(lengths, "token"))
    columns = ["a", "b", "n_a", "n_b", "cells_a", "cells_b"]

    lists = shared.join(heads.select("bundle", "class", "n", "cells", "members"), "bundle").withColumn("step", step)
    lists = materialise(lists)
    inside = _sides(member, heads.select("bundle", "class", "n", "cells"), ["bundle"])
    pairs = _candidates(lists, pct).select(*columns).unionByName(inside.select(*columns))
    links = _verified(_filtered(pairs, pct), classes, docs, size, pct)
    # Settled: short lists of bundles with one member. A bundle with more is a list of its own.
    unsettled = lists.groupBy("token").agg(F.max("rows").alias("rows"), F.max("members").alias("members"))
    unsettled = unsettled.where((F.col("rows") > SMALL_LIST) | (F.col("members") > 1)).select("token")
    several = heads.where("members > 1").select(F.xxhash64("bundle").alias("token"), F.lit(0).alias("pos"), "bundle")
    left = materialise(shared.select("token", "pos", "bundle").join(unsettled, "token").unionByName(several))
    if not left.isEmpty():
        named = _components(member, links)
        expanded = left.join(named, "bundle").withColumn("step", step)
        mixed = expanded.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
        pairs = _across_components(expanded.join(mixed.select("token"), "token").drop("bundle"), pct)
        kept = named.where(F.col("component") != F.col("class")).select(F.col("component").alias("a"), F.col("class").alias("b"))
        links = kept.unionByName(_verified(pairs, classes, docs, size, pct))
    final = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))

    per_class = classes.select("class", "first_id").join(final.withColumnRenamed("node", "class"), "class", "left")
    per_class = per_class.withColumn("component", F.coalesce("component", "class"))
    smallest = per_class.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_class = per_class.join(smallest, "component").select("class", "component_id")
    joined = rows.select("doc_id", F.col("n").alias("n_shingles"), "class").join(of_class, "class", "left")
    return joined.select(
        "doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )

