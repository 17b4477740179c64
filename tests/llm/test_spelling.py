"""Words, forms and roots against all pairs; signatures; edge cases."""

import random
import re
import zlib
from collections import Counter

import pytest
from corpora import edge_documents, frame
from pyspark.sql import functions as F

from reelspark.llm import spelling

LETTERS = "abcdeé"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long_ = sorted((a, b), key=len)
    at = next((i for i, c in enumerate(short) if c != long_[i]), len(short))
    return short[at + (len(a) == len(b)) :] == long_[at + 1 :]


def expected(docs):
    counts = Counter()
    for doc_id, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 5 * n else None
    rows = set()
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.add((w, n, len(near[w]), forms[w], words.get(forms[w]), root))
    return rows


def corpus(seed):
    """Few letters, so many words are near; chains of forms by counts that grow fivefold."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(5, 9))) for _ in range(25)]
    words = []
    for stem in stems:
        word, n = stem, 1500
        while n >= 3:
            words += [word] * n
            at, n = rng.randrange(len(word)), n // 6
            change = rng.choice([rng.choice(LETTERS), "", word[at] + rng.choice(LETTERS)])
            word = word[:at] + change + word[at + 1 :]
    rng.shuffle(words)
    return [(i, " ".join(words[i * 200 : i * 200 + 200])) for i in range(-(-len(words) // 200))]


@pytest.mark.parametrize("hot_words", [256, 1])
def test_against_all_pairs(spark, monkeypatch, hot_words):
    monkeypatch.setattr(spelling, "HOT_WORDS", hot_words)
    docs = [*corpus(hot_words), *edge_documents(), (None, "Éclair " * 7), (77, "aBCdef'aBCdef-" * 9)]
    found = spelling.spelling_variants(frame(spark, docs)).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len(found) == len({tuple(r) for r in found})
    want = expected(docs)
    assert {tuple(r) for r in found} == want
    assert any(r[3] and r[5] != r[3] for r in want)  # a chain of forms


def test_signatures_of_near_words_agree():
    rng = random.Random(3)
    for _ in range(3000):
        word = "".join(rng.choice("etaoinshzé") for _ in range(rng.randrange(6, 14)))
        at, kind = rng.randrange(len(word)), rng.randrange(3)
        new = rng.choice("etaoinshzé")
        other = word[:at] + (new, "", new + word[at])[kind] + word[at + 1 :]
        (keys, mask), (others, other_mask) = spelling.signatures(word), spelling.signatures(other)
        assert set(keys) & set(others)
        assert bin((mask ^ other_mask) % (1 << 64)).count("1") <= spelling.DISTANCE


def test_no_words(spark):
    for docs in ([], [(1, None), (2, ""), (None, "ab cd")]):
        assert spelling.spelling_variants(frame(spark, docs)).isEmpty()


def test_shorter_forms(spark):
    got = spark.range(1).select(spelling._shorter_forms(F.lit("aab")).alias("f")).first()["f"]
    assert sorted(got) == ["aa", "aab", "ab"]
