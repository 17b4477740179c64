"""Small corpora for the tests: edge cases and columns whose names operators use themselves."""

import random

CLASHES = ("n", "rank", "token", "score", "kept", "words", "shard", "pos", "size", "component", "x", "_n", "line", "unit", "seq")
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, " + ", ".join(f"{c} STRING" for c in CLASHES)


def rows_of(docs):
    """(doc_id, text[, source]) -> rows with clashing columns."""
    out = []
    for doc in docs:
        doc_id, text, source = doc if len(doc) == 3 else (*doc, "s")
        out.append((doc_id, text, "en", source, None if text is None else len(text), *["clash"] * len(CLASHES)))
    return out


def frame(spark, docs):
    return spark.createDataFrame(rows_of(docs), SCHEMA)


def sentence(rng, words, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def edge_documents(seed=1):
    """Nulls, empty and blank texts, one very long text, repeated rows, ties and a null id."""
    rng = random.Random(seed)
    long_text = sentence(rng, 60_000, 5_000)
    plain = sentence(rng, 80)
    return [
        (1, plain), (1, plain), (2, None), (3, ""), (4, " \n\t "), (5, long_text), (6, plain + " tail"),
        (7, "two words"), (8, "two words"), (None, plain), (None, None), (9, "Ünï ▁ code x 漢字 \U0001f600"),
        (10, sentence(rng, 80), None), (11, sentence(rng, 80), None),
    ]
