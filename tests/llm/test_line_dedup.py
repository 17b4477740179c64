"""Deleted lines against a search over all repeated runs; edge cases."""

import random

from corpora import edge_documents, frame, sentence
from pyspark.sql import types as T

from reelspark.llm.line_dedup import dedup_lines

SPACES = " \t\n\x0b\x0c\r"


def brute(docs, min_words):
    """Line numbers inside a run of enough words whose first occurrence is elsewhere."""
    texts = sorted({(d is None, d or 0, t) for d, t, *_ in docs if t is not None})
    keyed = [((d if not missing else None, t), [(k, x.strip(SPACES)) for k, x in enumerate(t.split("\n")) if x.strip(SPACES)]) for missing, d, t in texts]
    seen, out = {}, {}
    for key, lines in keyed:
        gone = set()
        for i in range(len(lines)):
            words = 0
            for j in range(i, len(lines)):
                words += len(lines[j][1].split())
                run = tuple(x for _, x in lines[i : j + 1])
                if words >= min_words and seen.setdefault(run, (key, i)) != (key, i):
                    gone.update(k for k, _ in lines[i : j + 1])
        out[key] = sorted(gone)
    return out


def same(spark, docs, min_words):
    expected = brute(docs, min_words)
    rows = dedup_lines(frame(spark, docs), min_words=min_words).collect()
    assert len(rows) == len(docs)
    texts = {}
    for d, t, *_ in docs:
        texts.setdefault(d, []).append(t)
    for row in rows:
        fits = []
        for t in texts[row["doc_id"]]:
            gone = expected.get((row["doc_id"], t), []) if t is not None else []
            left = t if not gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
            fits.append((left, gone, 0 if t is None else len(t.split("\n"))))
        assert (row["text"], row["deleted_lines"], row["n_lines"]) in fits and row["n_deleted"] == len(row["deleted_lines"])
        assert row["rank"] == "clash"


def test_random_lines_with_many_repeats(spark):
    rng = random.Random(11)
    pool = [sentence(rng, rng.randrange(1, 9)) for _ in range(12)] + ["", "  "]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 14)))) for i in range(60)]
    docs += [(100 + i, "\n".join(sentence(rng, 6) for _ in range(4)) + "\n" + "\n".join(pool[:5])) for i in range(10)]
    docs += [(200, "a\n" * 40 + "b"), (201, "x\n" + "a\n" * 30)]
    same(spark, docs, 12)


def test_edges(spark):
    docs = [*edge_documents()[:4], *edge_documents()[5:8], (20, edge_documents()[0][1]), (21, " " + edge_documents()[0][1] + "\n\nnew line")]
    same(spark, docs, 50)
    assert dedup_lines(frame(spark, [])).collect() == []


def test_repeated_rows_with_a_passage_of_several_lines(spark):
    rng = random.Random(12)
    passage = "\n".join(sentence(rng, 9) for _ in range(8))
    other = "\n".join(sentence(rng, 9) for _ in range(8))
    docs = [(1, "head one\n" + passage + "\n" + other)] * 3 + [(2, passage + "\ntail two")] * 2 + [(3, other + "\ntail three")]
    docs += [(None, "start\n" + passage)] * 2
    same(spark, docs, 50)
    left = {r["doc_id"]: r["text"] for r in dedup_lines(frame(spark, docs)).collect()}
    assert left[2] == "tail two" and left[3] == "tail three" and left[None] == "start"


def test_columns_of_any_name_stay(spark):
    names = ["deleted", "_text", "_id", "_digest", "_hit_id", "_hit_digest", "_kept", "a.b", "c`d"]
    passage = "\n".join(" ".join(f"w{i}{k}" for k in range(20)) for i in range(4))
    rows = [(1, passage, *names), (2, "own line\n" + passage, *names)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(n, T.StringType()) for n in ["text", *names]]])
    found = dedup_lines(spark.createDataFrame(rows, schema))
    assert found.columns == ["doc_id", "text", *names, "n_lines", "n_deleted", "deleted_lines"]
    got = sorted(map(tuple, found.collect()))
    assert [r[:2] for r in got] == [(1, passage), (2, "own line")]
    assert all(list(r[2:11]) == names for r in got) and [r[12] for r in got] == [0, 4]
