"""Links and components against all pairs; recall near the limit; blocks; edge cases."""

from pathlib import Path

import numpy as np
import pytest

from reelspark.llm import embeddings, vector_graph


def brute(vectors, least=0.9):
    valid = [i for i, (_, v) in enumerate(vectors) if v and None not in v and np.isfinite(v).all() and np.abs(v).max() > 0]
    unit = {i: np.array(vectors[i][1], float) / np.linalg.norm(vectors[i][1]) for i in valid}
    links, root = [0] * len(vectors), list(range(len(vectors)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in valid:
        for j in valid:
            if j < i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    lowest = {}
    for i, (vec_id, _) in enumerate(vectors):
        if vec_id is not None:
            lowest[find(i)] = min(vec_id, lowest.get(find(i), vec_id))
    out = [(v, links[i], lowest.get(find(i)), v == lowest.get(find(i))) for i, (v, _) in enumerate(vectors)]
    return sorted(out, key=repr)


def run(spark, vectors):
    rows = [(vec_id, v, 1, "clash", "clash") for vec_id, v in vectors]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, unit STRING, class STRING")
    return sorted(map(tuple, embeddings.near_duplicates(df).collect()), key=repr)


def singles(values):
    return [float(x) for x in np.asarray(values, np.float32)]


def test_clumps_over_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SHARD_HOME", 30)
    monkeypatch.setattr(embeddings, "SHARD_MOST", 60)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 32))
    clump = base[0] + rng.normal(size=(150, 32)) * 0.1
    pairs = base[1:40] + rng.normal(size=(39, 32)) * 0.15
    vectors = [(int(i), singles(v)) for i, v in enumerate(np.concatenate([base, clump, pairs]))]
    vectors += [(1000 + i, vectors[5][1]) for i in range(20)]
    got, expected = run(spark, vectors), brute(vectors)
    assert [r[0] for r in got] == [r[0] for r in expected]
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in expected)
    assert all(a[1] <= b[1] for a, b in zip(got, expected, strict=True))


def test_edges(spark):
    one = singles([1.0, 2.0, 3.0])
    vectors = [
        (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]), (6, [float("inf"), 1.0, 1.0]),
        (7, one), (7, one), (8, singles([2.0, 4.0, 6.0])), (None, one), (None, None), (9, [1.0, 2.0]), (10, [-1.0, -2.0, -3.0]),
    ]
    got = run(spark, vectors)
    expected = brute(vectors)
    # A null vec_id without links is its own component and stays.
    expected = [(None, 0, None, True) if r[:2] == (None, 0) else r for r in expected]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert run(spark, []) == []


def test_recall_just_above_the_limit():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(400, 48))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    noise = rng.normal(size=a.shape)
    noise -= (noise * a).sum(axis=1, keepdims=True) * a
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    units = np.concatenate([a, 0.91 * a + np.sqrt(1 - 0.91**2) * noise])
    graph = vector_graph.Graph(len(units), *vector_graph.robust_prune(units, 12, 32, 1.2))
    q, node = vector_graph.range_search(units, graph, 0.9, 16)
    truth = (units @ units.T >= 0.9).sum()
    assert len(q) >= 0.95 * truth and (np.einsum("pd,pd->p", units[q], units[node]) >= 0.9).all()


@pytest.mark.parametrize("n", [1, 2, 5])
def test_small_graphs(n):
    units = np.eye(8)[:n]
    graph = vector_graph.Graph(n, *vector_graph.robust_prune(units, 4, 8, 1.2))
    q, node = vector_graph.audited_search(units, graph, 0.9, 4, 0.98, 2)
    assert sorted(zip(q.tolist(), node.tolist())) == [(i, i) for i in range(n)]


def test_only_edges_move_and_nothing_large_stays(spark, monkeypatch):
    """An edge goes to every task that holds both its ends and to no other; the tables of a run go with it."""
    monkeypatch.setattr(embeddings, "SHARD_HOME", 30)
    monkeypatch.setattr(embeddings, "SHARD_MOST", 50)
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=(200, 32)), np.ones(32) + rng.normal(size=(60, 32)) * 0.01]).astype(np.float32)
    rows = [(i, v.tobytes(), 1, 32) for i, v in enumerate(values)]
    vectors = spark.createDataFrame(rows, "cid BIGINT, stored BINARY, weight BIGINT, dim BIGINT").cache()
    kind = np.dtype(np.float32)
    dealt, several = embeddings._tasks(vectors, embeddings.cluster_shards(vectors, kind))
    several = {r["home"]: r["blocks"] for r in several.collect()}
    members, homes = {}, {}
    for r in dealt.collect():
        members.setdefault((r["home"], r["low"], r["high"]), set()).add(r["cid"])
        homes.setdefault(r["cid"], set()).update(r["homes"])
    assert several and len(members) > len(several)
    keys = ["home", "low", "high"]
    schema = "home int, low int, high int, u array<long>, v array<long>"
    sent = {}
    for r in dealt.groupBy(*keys).applyInArrow(embeddings._builder(kind, several), schema).collect():
        task = (r["home"], r["low"], r["high"])
        sent.setdefault(task, set()).update(zip(r["u"], r["v"], strict=True))
    for task, edges in sent.items():
        assert all(u in members[task] and v in members[task] for u, v in edges)
    every = set().union(*sent.values())
    for task, inside in members.items():
        assert {(u, v) for u, v in every if u in inside and v in inside} == sent.get(task, set())
    tables = Path(embeddings.table_path(spark)).parent
    before = set(tables.iterdir()) if tables.is_dir() else set()
    run(spark, [(i, v.tolist()) for i, v in enumerate(values)])
    assert len(set(tables.iterdir()) - before) == 2
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
