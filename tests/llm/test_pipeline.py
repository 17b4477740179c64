"""Stages on a small corpus with known cases; the removal guard; registered queries against SQL."""

import glob
import os
import random
import shutil
import subprocess
import sys

import duckdb
import pytest
from conftest import sorted_rows
from corpora import sentence

import __spark_entry__ as entry_point
import corpus_pipeline
from reelspark.llm import mixing
from reelspark.llm.oracle import ORACLE
from reelspark.llm.queries import QUERIES
from reelspark.session import materialise

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(8)
    passage = sentence(rng, 60, 5_000)
    docs, labels = [], []
    for i in range(300):
        text = "\n".join(sentence(rng, 30, 5_000) for _ in range(3))
        bad = i % 6 == 0
        if bad:
            text += rng.choice([" moron", " scumbag"])
        if i % 10 == 1:
            text += "\n" + passage
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, int(bad)))
    docs += [(1000 + i, docs[7 + i][1].replace(" w1", " w2", 1), "en", "s1", 1) for i in range(0, 4, 2)]
    docs += [(2000, docs[5][1], "en", "s2", 1), (2001, None, "en", "s2", None), (2002, "", None, None, 0)]
    folder = str(tmp_path_factory.mktemp("sf"))
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    spark.createDataFrame(docs, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, states = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, corpus))
        states.append(docs)
        assert docs.columns == columns or stage is corpus_pipeline.STAGES[-1][1]
    clean, lines, unique, mixed, pieces = [s.collect() for s in states]
    assert not any(r["doc_id"] < 300 and r["doc_id"] % 6 == 0 for r in clean)
    assert {r["doc_id"] for r in clean} >= {i for i in range(300) if i % 6}
    left = {r["doc_id"]: r for r in lines}
    assert 2000 not in left and 2001 in left and 2002 in left
    texts = {r["doc_id"]: r["text"] for r in clean}
    with_passage = [i for i in sorted(texts) if i < 300 and i % 10 == 1]
    assert left[with_passage[0]]["text"] == texts[with_passage[0]]
    for i in with_passage[1:]:
        assert left[i]["text"] == "\n".join(texts[i].split("\n")[:3]) and left[i]["n_chars"] == len(left[i]["text"])
    assert {r["doc_id"] for r in unique} <= set(left) and {2001, 2002} <= {r["doc_id"] for r in unique}
    assert {i for i in left if i < 300} <= {r["doc_id"] for r in unique}
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in unique}
    words = lambda rows: sum(len((r["text"] or "").split()) for r in rows)
    assert 1.4 * words(unique) <= words(mixed) <= 1.6 * words(unique)
    assert len(pieces) == len(mixed) and all(r["round_trip"] for r in pieces)


def test_mixing_takes_repeated_rows_one_by_one(spark):
    # Rates 2, 0.8 and 1.7 by source; a third of each is one row many times, with and without id.
    rows = []
    for source, count in (("a", 150), ("b", 300), ("c", 300)):
        rows += [(k, f"{source} {k} x", "en", source, 5) for k in range(count - count // 3)]
        rows += [(None if k % 2 else -1, "same words here", "en", source, 5) for k in range(count // 3)]
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    docs = spark.createDataFrame(rows, schema)
    target = {r["source"]: (r["source_size"], r["target"]) for r in mixing.mix(docs).collect()}
    taken = corpus_pipeline.mix_sources(spark, docs, "").collect()
    for source, (size, words) in target.items():
        assert abs(sum(len(r["text"].split()) for r in taken if r["source"] == source) - words) <= 3
        rate, same = words / size, [r["doc_id"] for r in taken if r["source"] == source and r["text"] == "same words here"]
        equal = size // 9
        assert int(rate) * equal <= len(same) <= -int(-rate // 1) * equal
        if rate != int(rate):
            assert int(rate) * equal < len(same) < -int(-rate // 1) * equal
    again = corpus_pipeline.mix_sources(spark, docs.repartition(7), "").collect()
    assert sorted(map(repr, again)) == sorted(map(repr, taken))


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(3)
    words = [sentence(rng, 60, 5_000) for _ in range(4)]
    near = words[1] + " tail"
    rows = [(7, words[0])] * 5 + [(None, words[0])] * 3 + [(8, words[0])]
    rows += [(None, words[2])] * 4 + [(9, words[1]), (9, near), (5, near), (5, words[3])]
    rows += [(1, None), (1, None), (None, " "), (None, " ")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    for table in (docs, docs.repartition(5)):
        left = corpus_pipeline.drop_near_duplicates(spark, table, "").collect()
        expected = [(7, words[0]), (None, words[2]), (5, near), (5, words[3]), (1, None), (1, None), (None, " "), (None, " ")]
        assert sorted(((r["doc_id"], r["text"]) for r in left), key=repr) == sorted(expected, key=repr)


def test_empty_corpus(spark, corpus, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{corpus}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES} and "pipeline" in entry_point.queries()
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    relation = con.execute(ORACLE[name])
    columns = [column[0] for column in relation.description]
    frame = QUERIES[name](spark, sf_dir)
    assert sorted_rows(frame.columns, [tuple(r) for r in frame.collect()]) == sorted_rows(columns, relation.fetchall())


def test_the_rest_stands_alone(tmp_path):
    for name in ("__spark_entry__.py", "reelspark"):
        copy = shutil.copytree if os.path.isdir(f"{ROOT}/{name}") else shutil.copy
        copy(f"{ROOT}/{name}", tmp_path / name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if copy is shutil.copytree else {}))
    code = "import __spark_entry__ as e; assert e.queries() and not [q for q in e.queries() if q.startswith('op')]; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True, timeout=120)
