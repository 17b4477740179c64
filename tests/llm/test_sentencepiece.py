"""Relational lattice against the direct one and against all paths; exact round trip; edge cases."""

import random

import pytest
from corpora import edge_documents, frame

from reelspark.llm import sentencepiece as sp

TEXTS = ["The  clown\nwäre  idiot.\t x", "", " lead", "trail ", "漢字 \U0001f600 é", "a\r\nb\x0bc", "\n\n", "x" * 500, "(){}[]  ==  !="]


@pytest.fixture(scope="module")
def vocabulary():
    return sp.Vocabulary.load()


def test_relational_and_direct_paths_agree(spark, vocabulary):
    units = sorted({u for t in TEXTS for u in vocabulary.units(t)})
    solved = sp.lattice_words(spark.createDataFrame([(u,) for u in units], "word STRING"), vocabulary)
    assert {r["word"]: r["ids"] for r in solved.collect()} == {u: vocabulary.encode_unit(u) for u in units}


def test_best_of_all_paths():
    pieces = {"a": -2.0, "b": -2.0, "ab": -3.0, "ba": -1.0, "aba": -6.0, "▁": -1.0, "▁a": -2.5}
    vocabulary = sp.Vocabulary({p: 300 + k for k, p in enumerate(pieces)}, pieces, 3)

    def best(text):
        if not text:
            return 0.0
        steps = [(pieces.get(text[:k]), text[k:]) for k in range(1, 4) if text[:k] in pieces]
        return max([s + best(rest) for s, rest in steps] or [vocabulary.unknown + best(text[1:])])

    rng = random.Random(0)
    names = {i: p for p, i in vocabulary.ids.items()}
    for _ in range(200):
        unit = "".join(rng.choice("ab▁c") for _ in range(rng.randrange(1, 10)))
        path = [names.get(i) for i in vocabulary.encode_unit(unit)]
        total = sum(pieces[p] if p else vocabulary.unknown for p in path)
        assert total == pytest.approx(best(unit)) and "".join(p or "c" for p in path) == unit


def test_no_piece_crosses_units(vocabulary):
    for text in TEXTS:
        assert "".join(vocabulary.units(text)) == (("▁" + text.replace(" ", "▁")) if text else "")


@pytest.mark.parametrize("frequent", [0, 3, 1000])
def test_round_trip(spark, frequent):
    docs = edge_documents() + [(100 + k, t) for k, t in enumerate(TEXTS)]
    encoded = sp.encode(frame(spark, docs), frequent=frequent)
    rows = sp.decode(encoded).select("text", "token_ids", "n_tokens", "decoded", "token").collect()
    assert len(rows) == len(docs)
    for row in rows:
        assert row["decoded"] == (None if row["text"] is None else row["text"].replace("▁", " "))
        assert row["n_tokens"] == len(row["token_ids"] or []) and row["token"] == "clash"


def test_stored_ids_are_decoded_and_held_against_the_text(spark):
    docs = edge_documents() + [(100 + k, t) for k, t in enumerate(TEXTS)] + [(200, "a ▁b")]
    rows = sp.encode_checked(frame(spark, docs), ["doc_id", "score"]).select("doc_id", "round_trip", "score").collect()
    assert len(rows) == len(docs) and all(r["score"] == "clash" for r in rows)
    assert {r["doc_id"] for r in rows if not r["round_trip"]} == {d[0] for d in docs if d[1] and "▁" in d[1]}


def test_a_wrong_id_offset_or_count_shows(spark):
    texts = ["one two", "three four", "five"]
    ids = [sp.Vocabulary.load().encode_units(sp.Vocabulary.load().units(t)) for t in texts]
    flat = [[i for unit in path for i in unit] for path in ids]
    moved = [flat[0] + flat[1][:1], flat[1][1:], flat[2][:-1]]
    for lists, expected in ((flat, [True] * 3), (moved, [False] * 3)):
        rows = spark.createDataFrame(list(zip(range(3), lists, texts)), "doc_id INT, token_ids ARRAY<INT>, text STRING")
        stored = rows.selectExpr("doc_id", "token_ids", "sha2(text, 256) AS digest")
        assert [r["round_trip"] for r in sp.round_trip(stored, "digest").orderBy("doc_id").collect()] == expected


def test_long_texts_in_runs_and_small_slices(spark, vocabulary, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("ab  é漢\n.\t") for _ in range(5_000)) + "z" * 300
    for size in (1, 7, 100, 10_000):
        assert [u for run in vocabulary.runs(text, size) for u in run] == vocabulary.units(text)
    assert list(vocabulary.runs("", 5)) == []
    assert list(sp.even_slices([3, 3, 9, 1, 0, 2], 6)) == [(0, 2), (2, 3), (3, 6)]
    import pyarrow as pa

    lists = pa.array([[i for u in vocabulary.encode_units(vocabulary.units(t)) for i in u] for t in (text, "", "x y")] + [None])
    monkeypatch.setattr(sp, "_TOKENS_AT_ONCE", 64)
    assert sp.decoded_texts(lists, vocabulary.decoder()) == [text, "", "x y", None]
    assert sp.decoded_texts(pa.array([[-5, 10**9], [], None], pa.list_(pa.int32())), vocabulary.decoder()) == ["", "", None]


def test_many_units_together(vocabulary):
    rng = random.Random(2)
    units = ["".join(rng.choice("abcdeé漢▁ .\n") for _ in range(rng.randrange(1, 140))) for _ in range(400)]
    assert vocabulary.encode_units(units) == [vocabulary.encode_unit(u) for u in units]


def test_nothing_to_encode(spark):
    assert sp.decode(sp.encode(frame(spark, []))).collect() == []


def test_paths_of_many_words_take_little_memory(vocabulary):
    import tracemalloc

    rng = random.Random(3)
    units = sorted({"▁" + "".join(rng.choice("abcdeé漢") for _ in range(8)) for _ in range(20_000)})
    tracemalloc.start()
    held = sp.Paths()
    for lo in range(0, len(units), 5_000):
        held.add(units[lo : lo + 5_000], *vocabulary.paths(units[lo : lo + 5_000]))
    now, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    # Lists of ids took over 250 bytes a word, and the paths of all words as lists about as much again.
    assert now < 180 * len(units) and peak < 600 * len(units)
    ends = held.sizes.cumsum()
    for word in units[::500]:
        k = held.places[word]
        assert held.ids[ends[k] - held.sizes[k] : ends[k]].tolist() == vocabulary.encode_unit(word)
    assert vocabulary.paths([])[0].size == 0 and vocabulary.encode_units(["漢", "a"]) == [vocabulary.encode_unit(u) for u in "漢a"]
