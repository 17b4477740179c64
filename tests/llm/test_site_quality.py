"""Posteriors against the formulas, shrinkage of sparse sites, held-out accuracy, edge cases."""

import math
import random

import pytest
from corpora import edge_documents, frame, sentence

from reelspark.llm import site_quality


def labels_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")


def test_sites_shift_and_sparse_sites_shrink(spark):
    rng = random.Random(1)
    rows = []
    for host, paths, mean in (("good", 4, 0.95), ("bad", 4, 0.1), ("mid", 4, 0.5)):
        for path in range(paths):
            rows += [(len(rows) + i, host, f"p{path}", min(0.999, max(0.001, rng.gauss(mean, 0.1)))) for i in range(100)]
    rows.append((5000, "sparse", "p0", 0.5))
    rows.append((5001, None, None, 0.5))
    out = {r["_id"]: r for r in site_quality.combine(spark.createDataFrame(rows, "_id BIGINT, _host STRING, _path STRING, e DOUBLE")).collect()}
    assert len(out) == len(rows)
    mean = sum(r[3] for r in rows) / len(rows)
    groups = {}
    for _, host, path, e in rows:
        for key in ((host,), (host, path)):
            n, s = groups.get(key, (0, 0.0))
            groups[key] = n + 1, s + e
    assert out[5000]["path_posterior"] == pytest.approx(mean) and out[5001]["score"] == pytest.approx(0.5)
    for i, host, path, e in rows[:: 97]:
        n, s = groups[host,]
        alpha = (s - e - (n - 1) * out[i]["host_posterior"]) / (out[i]["host_posterior"] - mean) if n > 1 else None
        # One strength for all hosts.
        if host in ("good", "bad"):
            assert alpha == pytest.approx(_alpha(out, rows, groups, mean), rel=1e-3)
        site = min(max(out[i]["path_posterior"], 1e-4), 1 - 1e-4)
        margin = math.log(e / (1 - e)) + math.log(site / (1 - site)) - math.log(mean / (1 - mean))
        assert out[i]["score"] == pytest.approx(1 / (1 + math.exp(-margin)))


def _alpha(out, rows, groups, mean):
    i, host, _, e = rows[0]
    n, s = groups[host,]
    return (s - e - (n - 1) * out[i]["host_posterior"]) / (out[i]["host_posterior"] - mean)


def test_held_out_accuracy(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        text = "the of and " * 5 + sentence(rng, 60) if good else "%%% ".join(sentence(rng, 40).split(" "))
        docs.append((i, text, rng.choice(["a", "b"])))
        labels.append((i, int(good), 0))
    rows = site_quality.classify_quality(frame(spark, docs), labels_frame(spark, labels)).collect()
    truth = {d: bool(q) for d, q, _ in labels}
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 40 and sum(r["kept"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_edges(spark):
    df = frame(spark, edge_documents())
    for labels in ([], [(5, 1, 0), (6, 1, 0)]):
        rows = site_quality.classify_quality(df, labels_frame(spark, labels)).collect()
        assert len(rows) == df.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert site_quality.classify_quality(frame(spark, []), labels_frame(spark, [])).collect() == []
