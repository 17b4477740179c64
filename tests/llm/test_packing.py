"""Ids against the tokenizer, pieces, gapless sequences, their number."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from corpora import edge_documents, frame, sentence

from reelspark.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def hard_texts():
    rng = random.Random(5)
    signs = "ab Z9 \n\t\x0b 　 .,'é漢😀<|endoftext|>  'll 12"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(400))) for _ in range(200)]
    return [*texts, "don't  stop\r\n\r\n now", "<|endoftext|>", "x" * 3000, " " * 500, None, ""]


def test_ids_are_those_of_tokenizers(tokenizer):
    encoder = packing._encoder(packing.vocabulary_path())
    for text in hard_texts():
        assert packing.token_ids(encoder, text).tolist() == ids_of(tokenizer, text)


def test_slices_do_not_change_the_ids(monkeypatch, tokenizer):
    encoder = packing._encoder(packing.vocabulary_path())
    for text in hard_texts():
        parts = list(packing.text_slices(text or "", 20))
        assert "".join(parts) == (text or "")
        assert [i for p in parts for i in encoder.encode_ordinary(p)] == ids_of(tokenizer, text)[:-1]


def hold(rows, capacity):
    """Every sequence is gapless and within the capacity; returns their number."""
    by_sequence = defaultdict(list)
    for row in rows:
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_documents_whole(spark, tokenizer):
    docs = [*edge_documents(), *[(100 + i, t) for i, t in enumerate(hard_texts())]]
    rows = packing.pack_documents(frame(spark, docs), capacity=256).collect()
    hold(rows, 256)
    want = []
    for doc_id, text, *_ in docs:
        ids = np.array(ids_of(tokenizer, text), dtype="<u4")
        first = len(ids) % 256 or 256
        cuts = [0, *range(first, len(ids) + 1, 256)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=rooms.__getitem__)] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("low, high", [(1, 100), (26, 60), (30, 51), (1, 20), (100, 101), (34, 35)])
def test_few_sequences(spark, low, high):
    rng = random.Random(low)
    lengths = [rng.randrange(low, high) for _ in range(1500)]
    pieces = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id LONG, piece INT, length LONG")
    rows = packing.pack_pieces(pieces, capacity=100, groups=64).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(1500))
    used = hold(rows, 100)
    assert used >= -(-sum(lengths) // 100)
    assert used <= best_fit_decreasing(lengths, 100) * 1.02 + 3


def test_the_linear_program_meets_its_bound():
    counts = np.zeros(101, dtype=np.int64)
    counts[[51, 27, 26, 23]] = [60, 60, 60, 120]  # 51+26+23 and 51+26+23, 27+27+23+23: all full
    sizes, demand = packing.round_up(counts, 1000)
    columns, times = packing.configurations(sizes, demand, 100)
    assert (columns.T @ sizes <= 100).all()
    assert np.allclose(columns @ times, demand)
    assert times.sum() <= 60 * 1.5 + 1


def test_without_rows(spark):
    assert packing.pack_documents(frame(spark, [])).isEmpty()
    alone = packing.pack_documents(frame(spark, [(1, None)])).collect()
    assert [(r["length"], r["offset"], r["piece"]) for r in alone] == [(1, 0, 0)]
