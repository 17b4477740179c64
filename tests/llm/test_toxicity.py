"""Restoration of disguised words, what labels may do, held-out accuracy, edge cases."""

import random

import pytest
from corpora import edge_documents, frame, sentence

from reelspark.llm import toxicity

BAD = ["idiot", "moron", "pathetic", "worthless"]


@pytest.fixture(scope="module")
def model():
    words = BAD * 30 + ["the", "than", "indeed", "shell", "letter", "more", "noon", "path", "worth", "less", "book"] * 50
    grams = {}
    for word in words:
        padded = f"^^{word}$"
        for k in range(len(padded) - 2):
            grams[padded[k : k + 3]] = grams.get(padded[k : k + 3], 0) + 1
    return toxicity.CharModel(grams)


@pytest.mark.parametrize(
    ("seen", "word"),
    [("1d10t", "idiot"), ("m0r0n", "moron"), ("i.d.i.o.t", "idiot"), ("idiooooot", "idiot"), ("p@th3t1c", "pathetic"),
     ("w0rthle$$", "worthless"), ("m-0-r-0-n", "moron"), ("letter", "letter"), ("shell", "shell")],
)
def test_restore(model, seen, word):
    assert model.restore(seen) == word


def test_words_of_a_text(model):
    reader = toxicity.Restorer(model)
    assert "idiot" in reader.words("you are an i d i o t indeed")
    assert "moron" in reader.words("a M.O.R.O.N! and") and "moron" in reader.words("MORON!!")
    assert reader.words("") == set() and "the" in reader.words("the, (the)")


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    disguise = {"i": "1", "o": "0", "e": "3", "a": "@"}
    docs, labels = [], []
    for i in range(700):
        words = sentence(rng, 40, 3_000).replace("w", "word").split()
        bad = rng.random() < 0.3
        if bad:
            word = rng.choice(BAD)
            if rng.random() < 0.3:
                word = "".join(disguise.get(c, c) for c in word)
            words[rng.randrange(40)] = word
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return docs, labels


def labels_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    rows = toxicity.score_toxicity(frame(spark, docs), labels_frame(spark, labels)).collect()
    truth = {d: t for d, _, t in labels}
    held = [r for r in rows if r["held_out"]]
    assert 90 <= len(held) <= 190 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_held_out_labels_are_not_read(spark, corpus):
    docs, labels = corpus
    scored = lambda rows: {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(frame(spark, docs), labels_frame(spark, rows)).collect()}
    import zlib

    flipped = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in labels]
    assert scored(flipped) == pytest.approx(scored(labels))


def test_edges(spark):
    df = frame(spark, edge_documents())
    none = toxicity.score_toxicity(df, labels_frame(spark, [(1, 1, None), (None, 1, 1), (99, 0, 1)])).collect()
    assert len(none) == df.count() and {(r["score"], r["predicted"]) for r in none} == {(0.0, 0)}
    assert toxicity.score_toxicity(frame(spark, []), labels_frame(spark, [])).collect() == []


def test_long_runs_and_tokens_are_read_to_the_end(model):
    reader = toxicity.Restorer(model)
    for k in (60, 63, 64, 100, 1_000):
        assert "moron" in reader.words(" ".join("thanmore" * (k // 8) + "x" * (k % 8) + "m0ronthan"))
        assert "idiot" in reader.words("-".join(["letter"] * (k // 6) + ["idiot", "book"]))
        assert "idiot" in reader.words("thanmorebookpath" * (5 + k // 16) + "1d10tpath")
        assert "idiot" in reader.words("idi" + "o" * k + "t")


def test_score_past_the_first_letters(model):
    lexicon = toxicity.Lexicon({"=idiot": 0.95}, 0.1)
    text = " ".join("thepathmorebook" * 20 + "idiot" + "noon" * 20)
    assert lexicon.score(toxicity.Restorer(model, lexicon.longest).readings(text)) > 0.9


@pytest.mark.parametrize("text", ["iiddiioott", "an iddiott indeed", "MMOORROONN"])
def test_doubled_letters_are_decoded(model, text):
    assert {"idiot", "moron"} & toxicity.Restorer(model).words(text)


@pytest.mark.parametrize("gap", ["   ", "\t", ", ", "/ ", " - ", " ", "\n"])
def test_spelled_with_any_gap(model, gap):
    reader = toxicity.Restorer(model)
    assert "idiot" in reader.words("you " + gap.join("!d1ot") + " indeed")
    assert "idiot" in reader.words("you, " + gap.join("IDIOT") + "! (indeed)")
    assert "worthless" in reader.words(gap.join("worth£€$$"))


def test_words_without_features_are_passed_over(model, monkeypatch):
    lexicon = toxicity.Lexicon({"=idiot": 0.95, "path": 0.91, "=less": 0.9}, 0.1)
    rng = random.Random(5)
    words = ["the", "than", "1d10t", "p@th3t1c", "worth-less", "letter", "indeed", "i d i o t", "book!", "x" * 200, "漢字", "less"]
    texts = [" ".join(rng.choices(words[:2] + words[5:7] + rng.sample(words, 2), k=30)) for _ in range(60)] + ["", " \n"]
    reader = toxicity.Restorer(model, lexicon.longest)
    for limit in (1, 3, 1_000):
        monkeypatch.setattr(toxicity, "DULL_WORDS", limit)
        scorer = toxicity.Scorer(model, lexicon)
        assert [scorer.score(t) for t in texts] == pytest.approx([lexicon.score(reader.readings(t)) for t in texts])
        assert len(scorer._dull) <= limit
    read = []
    monkeypatch.setattr(toxicity.Restorer, "word_readings", lambda self, word: read.append(word) or (word,))
    scorer = toxicity.Scorer(model, lexicon)
    # Before, every word of every text was read.
    assert [scorer.score("the than the indeed") for _ in range(50)] == [0.1] * 50 and len(read) == 3


def test_trigrams_of_a_batch():
    words = {"The": 3, "the,": 2, "漢字": 1, "a": 4, "x1": 9, "\U0001f600": 2, "é" * 70: 1, "letter": 5}
    expected = {}
    for word, n in words.items():
        plain = toxicity._core(word)
        if plain.isalpha() and len(plain) <= toxicity.LONGEST_WORD:
            padded = f"^^{plain}$"
            for k in range(len(padded) - 2):
                expected[padded[k : k + 3]] = expected.get(padded[k : k + 3], 0) + n
    assert toxicity._trigrams(words) == expected and toxicity._trigrams({}) == {}
