"""Best fit against a linear scan, near equal shards, whole groups, gapless slots, edge cases."""

import random
import zlib

import numpy as np
import pytest
from corpora import edge_documents, frame, sentence

from reelspark.llm import sharding


def scan_best_fit(sizes, capacity):
    room, bins = [], []
    for size in sizes:
        fits = [(r, b) for b, r in enumerate(room) if r >= size]
        b = min(fits)[1] if fits else len(room)
        if not fits:
            room.append(max(capacity, size))
        room[b] -= size
        bins.append(b)
    return bins


@pytest.mark.parametrize("seed", range(5))
def test_tree_finds_the_tightest_bin(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randrange(1, 120) for _ in range(300)), reverse=True)
    assert sharding.best_fit_decreasing(np.array(sizes), 100) == scan_best_fit(sizes, 100)


def check(rows, docs, shards):
    sizes = [0] * shards
    slots = {}
    homes = {}
    texts = {}
    for d, t, *_ in docs:
        texts.setdefault(d, []).append(t)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        homes.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
        assert r["size"] in [len((t or "").encode()) + 1 for t in texts[r["doc_id"]]]
        assert r["text_crc32"] in [zlib.crc32((t or "").encode()) for t in texts[r["doc_id"]]]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes, homes


def test_even_whole_and_gapless(spark):
    rng = random.Random(2)
    docs = [(i, sentence(rng, rng.randrange(1, 200))) for i in range(600)]
    docs += [(1000 + i, "same text in many rows") for i in range(50)]
    rows = sharding.shard_documents(frame(spark, docs)).collect()
    assert len(rows) == len(docs)
    sizes, homes = check(rows, docs, 8)
    assert max(sizes) - min(sizes) <= 8
    assert all(len(h) == 1 for h in homes.values())


def test_levels_of_the_tree(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LOT_ITEMS", 100)
    monkeypatch.setattr(sharding, "FINAL_ITEMS", 200)
    rng = random.Random(3)
    docs = [(i, sentence(rng, rng.randrange(1, 60), 10_000)) for i in range(3000)]
    rows = sharding.shard_documents(frame(spark, docs), shards=4).collect()
    sizes, _ = check(rows, docs, 4)
    assert len(rows) == len(docs) and max(sizes) <= 1.03 * min(sizes)


def test_edges(spark):
    df = frame(spark, edge_documents())
    rows = sharding.shard_documents(df, shards=3).collect()
    check(rows, edge_documents(), 3)
    assert len(rows) == df.count()
    assert sharding.shard_documents(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_documents(df, shards=0)
