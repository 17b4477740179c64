"""Scores and draws against brute force; the bracket; edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from corpora import edge_documents, frame, sentence

from reelspark.llm import importance
from reelspark.llm.spelling import LOWER, UPPER

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    words = WORD.findall((text or "").translate(str.maketrans(UPPER, LOWER)))
    return words, [zlib.crc32(f.encode()) % 10_000 for f in [*words, *map(" ".join, zip(words, words[1:]))]]


def expected(docs, target, pct=25):
    raw, wish = Counter(), Counter()
    for _, text, *_ in docs:
        raw.update(features(text)[1])
    for text in target:
        wish.update(features(text)[1])
    s_all, t_all = raw.total() + 10_000, wish.total() + 10_000
    gain = [math.floor(1000 * math.log((wish[b] + 1) * s_all / ((raw[b] + 1) * t_all))) for b in range(10_000)]
    rows = []
    for doc_id, text, *_ in docs:
        words, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((doc_id, len(found), weight, score, len(words) >= 20))
    rows.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    wanted, place, out = pct * sum(r[4] for r in rows) // 100, 0, []
    for row in rows:
        place += row[4]
        out.append((*row[:4], place if row[4] and place <= wanted else None))
    return sorted(out, key=repr)


def corpus(seed, rows=300):
    rng = random.Random(seed)
    return [(i, sentence(rng, rng.randrange(10, 60), 300)) for i in range(rows)]


def found(spark, docs, target, **options):
    wished = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(target)], "item_id BIGINT, text STRING, score STRING")
    rows = importance.resample(frame(spark, docs), wished, **options).collect()
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in rows), key=repr)


@pytest.mark.parametrize("pct", [25, 0, 100])
def test_against_brute_force(spark, pct):
    docs = [*corpus(1), *edge_documents(), (500, "İSTANBUL Ünï 12ab, straße " * 9)]
    target = [sentence(random.Random(2), 200, 60), None, "", "Ünï straße"]
    assert found(spark, docs, target, pct=pct) == expected(docs, target, pct)


def test_repeated_rows_and_ties_are_drawn_one_by_one(spark):
    docs = [(7, "a b c d e f g h i j k l m n o p q r s t u")] * 300 + corpus(3, 40)
    assert found(spark, docs, ["a b c"]) == expected(docs, ["a b c"])


def test_empty_tables(spark):
    assert found(spark, [], ["a b"]) == []
    docs = corpus(4, 30)
    assert found(spark, docs, []) == expected(docs, [])


def test_a_narrow_sketch_is_widened(spark):
    scores = spark.range(100_000).selectExpr("hash(id) % 1000 AS score")
    for wanted in (1, 50_000, 99_999, 100_000):
        low, high, above = importance._bracket(scores, 100_000, wanted, 1e-9, 5)
        assert above == scores.where(f"score > {high}").count() < wanted <= scores.where(f"score >= {low}").count()
