"""Components against all pairs; near-copy families; filters; edge cases."""

import random

import numpy as np
import pyarrow as pa
import pytest
from corpora import edge_documents, frame, sentence

from reelspark.llm import jaccard, shingles
from reelspark.llm.components import connected_components

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BLANKS = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})


def shingles_of(text, size):
    words = [w for w in (text or "").translate(LOWER).translate(BLANKS).split(" ") if w]
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(docs, size, pct):
    sets = [shingles_of(t, size) for _, t, *_ in docs]
    root = list(range(len(docs)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(docs)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= pct * (len(sets[a]) + len(sets[b]) - common):
                root[find(a)] = find(b)
    least = {}
    for a, (d, *_) in enumerate(docs):
        if d is not None:
            least[find(a)] = min(d, least.get(find(a), d))
    out = [(d, len(sets[a]), least.get(find(a)) if sets[a] else d) for a, (d, *_) in enumerate(docs)]
    return sorted(out, key=repr)


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10_000)}"
    return " ".join(words)


def run(spark, docs, size, pct):
    return sorted(map(tuple, jaccard.similar_documents(frame(spark, docs), size=size, pct=pct).collect()), key=repr)


@pytest.mark.parametrize(("size", "pct"), [(3, 90), (5, 80)])
def test_families_and_shared_passages(spark, monkeypatch, size, pct):
    monkeypatch.setattr(jaccard, "SMALL_LIST", 6)
    monkeypatch.setattr(jaccard, "CENTRES", 2)
    monkeypatch.setattr(jaccard, "HEAVY_ROWS", 8)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(size)
    passage = sentence(rng, 60)
    docs = [(i, sentence(rng, rng.randrange(1, 150), 2_000)) for i in range(60)]
    docs += [(i, passage + " " + sentence(rng, 100, 2_000)) for i in range(100, 130)]
    for start, edits in ((200, 1), (300, 3), (400, 5)):
        base = sentence(rng, 140, 2_000)
        docs += [(start + k, edited(rng, base, rng.randrange(edits + 1))) for k in range(30)]
    docs += edge_documents()
    rng.shuffle(docs)
    assert run(spark, docs, size, pct) == brute(docs, size, pct)


def test_no_documents(spark):
    assert run(spark, [], 3, 90) == []
    assert run(spark, [(1, None), (2, "")], 3, 90) == [(1, 0, 1), (2, 0, 2)]


def test_digests_do_not_depend_on_place_or_slices(monkeypatch):
    texts = ["The  cat\tsat", "the CAT sat on", None, "", "x " * 1000 + "THE cat sat", "ünï the cat"]
    whole = [list(w) for w in shingles.text_words(pa.array(texts), shingles.WordHasher())]
    monkeypatch.setattr(shingles, "_SLICE_BYTES", 16)
    assert [list(w) for w in shingles.text_words(pa.array(texts), shingles.WordHasher())] == whole
    assert whole[0] == whole[1][:3] == whole[4][-3:] and whole[2] == whole[3] == []
    assert len(set(whole[4])) == 4 and whole[5][1:] == whole[0][:2]
    sliced = [list(w) for w in shingles.text_words(pa.array(["pad", *texts])[1:], shingles.WordHasher())]
    assert sliced == whole


def test_cell_counts_bound_the_difference():
    rng = np.random.default_rng(0)
    for n in (5, 300, 9_000):
        a = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(-(2**63), 2**63 - 1, n)]))
        cells = [pa.array([jaccard._cell_counts(x).tobytes()], pa.binary()) for x in (a, b)]
        assert jaccard._least_differences(*cells)[0] <= len(np.setxor1d(a, b))


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 60)] + [(7, 7), (2000, 2001), (2001, 2000)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "u BIGINT, v BIGINT")).collect()))
    assert {found[i] for i in range(51)} == {0}
    assert {found[1000 + i] for i in range(60)} == {1000}
    assert found[2000] == found[2001] == 2000
    assert connected_components(spark.createDataFrame([], "u BIGINT, v BIGINT")).collect() == []
