"""Counts against a plain reading of the definitions; edge cases."""

import re
from collections import Counter

from corpora import edge_documents, frame

from reelspark.llm.quality_rules import Threshold, apply_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [line.strip(" \t\n\x0b\x0c\r") for line in (text or "").split("\n")]
    whole = [line for line in (text or "").split("\n") if WORD.search(line)]
    assert len(whole) == sum(bool(line) for line in lines)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(whole) - len(set(whole)), "n_repeat_words": len(covered),
        "base_failed": len(words) < 10 or 100 * len(covered) > 20 * len(words),
    }


def test_counts_follow_the_definitions(spark):
    docs = edge_documents() + [
        (20, "a b c d e f a b c d e f a b c d e"), (21, "x x x x x x x x x x x"), (22, "one\none\n \n\none #$ | <b>"),
        (23, "the of and the of and in on to be a\nb"),
    ]
    got = sorted((r["doc_id"] or 0, *[r[k] for k in counted("")]) for r in apply_rules(frame(spark, docs)).collect())
    assert got == sorted((d or 0, *counted(t).values()) for d, t, *_ in docs)


def test_thresholds_reject_and_name_the_rule(spark):
    docs = [(1, "the of and %%% %%% a b c d e f g"), (2, "the of and a b c d e f g h i")]
    rules = (Threshold("symbols", "n_symbols", "n_words", high=0.1),)
    got = {r["doc_id"]: (r["failed_rules"], r["kept"]) for r in apply_rules(frame(spark, docs), thresholds=rules).collect()}
    assert got == {1: (["symbols"], False), 2: ([], True)}


def test_native_and_empty(spark):
    df = frame(spark, edge_documents())
    plan = apply_rules(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    assert apply_rules(df.limit(0)).collect() == []
