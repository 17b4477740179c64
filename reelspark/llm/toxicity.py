"""Toxicity: noisy-channel restoration of disguised words, then scoring of the restored text."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reelspark.llm.shingles import WordHasher, mix, shingle_set, text_words
from reelspark.llm.text import only
from reelspark.session import materialise

FOLDS = 5
FIT_TOXIC = 10_000
FIT_CLEAN = 20_000
LM_TRIGRAMS = 1 << 17
MIN_DOCS = 5
MIN_PRECISION = 0.9
CHANCE = 0.01
FAMILY_MARKS = 4
MOST_FEATURES = 5_000
CACHED_WORDS = 1 << 17
DULL_WORDS = 1 << 18
COUNTED_AT_ONCE = 300_000
LONGEST_WORD = 64
LONGEST_ENTRY = 16

# Letters a sign may stand for.
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = ".-_*'~,:;/\\#%&=^"
# Single letters, digits or signs for letters with blanks or separators, however many, between.
_SIGN = f"(?:[^\\W_]|[{re.escape(''.join(LEET))}])"
_GAP = f"[\\s{re.escape(SEPARATORS)}]+"
_SPACED = re.compile(rf"(?<![^\W_]){_SIGN}(?:{_GAP}{_SIGN}){{2,}}(?![^\W_])")
_GAPS = re.compile(_GAP)
_TWICE = re.compile(r"(.)\1")
_STRETCHED = re.compile(r"(.)\1{3,}")
_JOINTS = re.compile(f"[{re.escape(SEPARATORS)}]+")
# Log-probabilities of the channel.
_SWAP, _DROP, _KEEP_SIGN, _DROP_LETTER = -1.0, -1.0, -6.0, -1.0
_UNSEEN = -12.0


@dataclass
class CharModel:
    """Interpolated trigram model of lower-case words; ``^`` and ``$`` stand for their ends."""

    trigrams: dict[str, int]
    _pairs: dict[str, int] = field(default_factory=dict)
    _heads: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        pairs, heads, tails, ones = Counter(), Counter(), Counter(), Counter()
        for gram, n in self.trigrams.items():
            pairs[gram[:2]] += n
            tails[gram[1:]] += n
            heads[gram[1]] += n
            ones[gram[2]] += n
        self._pairs, self._tails, self._heads, self._ones = pairs, tails, heads, ones
        self._total = sum(ones.values()) or 1
        self._logs: dict[str, float] = {}

    def log(self, before: str, c: str) -> float:
        found = self._logs.get(before + c)
        if found is None:
            if len(self._logs) >= CACHED_WORDS:
                self._logs.clear()
            found = self._logs[before + c] = self._log(before, c)
        return found

    def _log(self, before: str, c: str) -> float:
        three = self.trigrams.get(before + c, 0) / self._pairs[before] if before in self._pairs else 0.0
        two = self._tails.get(before[1] + c, 0) / self._heads[before[1]] if before[1] in self._heads else 0.0
        p = 0.8 * three + 0.15 * two + 0.05 * self._ones.get(c, 0) / self._total
        return math.log(p) if p > 0 else _UNSEEN

    def restore(self, seen: str) -> str:
        """Likeliest word behind ``seen``: signs for letters, separators and repetition undone."""
        states: dict[str, tuple[float, str]] = {"^^": (0.0, "")}
        last = ""
        for c in seen:
            if len(states) == 1 and c != last and c.isalpha() and c not in LEET:
                # One path, one way on.
                [(before, (score, word))] = states.items()
                states, last = {before[1] + c: (score + self.log(before, c), word + c)}, c
                continue
            options = [(c, 0.0)] if c.isalpha() else [(c, _KEEP_SIGN)]
            if c.isalpha() and c == last:
                options.append(("", _DROP_LETTER))
            options += [(letter, _SWAP) for letter in LEET.get(c, "")]
            if c in SEPARATORS or (c in LEET and c == last):
                options.append(("", _DROP))
            following: dict[str, tuple[float, str]] = {}
            for before, (score, word) in states.items():
                for letter, cost in options:
                    total = score + cost + (self.log(before, letter) if letter else 0.0)
                    state = (before + letter)[-2:]
                    if state not in following or total > following[state][0]:
                        following[state] = (total, word + letter)
            states, last = following, c
        return max((score + self.log(before, "$"), word) for before, (score, word) in states.items())[1]


def fit_char_model(docs: DataFrame, most: int = LM_TRIGRAMS) -> CharModel:
    """Trigram counts over the plain words of all texts, counted per batch and then together.

    The ``most`` frequent trigrams are kept, which bounds what goes to the tasks.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: Counter[str] = Counter()
            for text in batch.column("text").to_pylist():
                words.update((text or "").split())
            grams = _trigrams(words)
            yield pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], ["gram", "n"])

    counts = docs.select("text").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    table = counts.orderBy(F.desc("n"), "gram").limit(most).toArrow()
    return CharModel(dict(zip(table["gram"].to_pylist(), table["n"].to_pylist(), strict=True)))


def _trigrams(words: Counter[str]) -> dict[str, int]:
    """Trigrams of plain words with their ends, as often as the words occur."""
    plain: Counter[str] = Counter()
    for word, n in words.items():
        core = _core(word)
        if core.isalpha() and len(core) <= LONGEST_WORD:
            plain[core] += n
    # Words one after the other, two signs before and one after each; no trigram crosses from one into the next.
    padded = "".join(f"^^{word}$" for word in plain)
    codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if not codes.size:
        return {}
    lengths = np.fromiter(map(len, plain), np.int64, len(plain))
    owner = np.repeat(np.arange(len(plain)), lengths + 3)
    inside = np.flatnonzero(owner[:-2] == owner[2:])
    keys = (codes[inside] << 42) | (codes[inside + 1] << 21) | codes[inside + 2]
    found, which = np.unique(keys, return_inverse=True)
    counts = np.bincount(which, np.fromiter(plain.values(), np.int64, len(plain))[owner[inside]]).astype(np.int64)
    mask = (1 << 21) - 1
    return {chr(key >> 42) + chr(key >> 21 & mask) + chr(key & mask): n for key, n in zip(found.tolist(), counts.tolist())}


def _core(word: str) -> str:
    """Lower case without the punctuation around it."""
    low = word.lower()
    if low.isalpha():
        return low
    start, end = 0, len(low)
    while start < end and not (low[start].isalnum() or low[start] in LEET):
        start += 1
    while end > start and not low[end - 1].isalnum():
        end -= 1
    return low[start:end]


class Restorer:
    """Features of texts after restoration; keeps words it has met, up to a fixed number.

    ``longest`` is the length up to which words are looked for inside spelled-out runs and
    unbroken tokens.
    """

    def __init__(self, model: CharModel, longest: int = LONGEST_ENTRY) -> None:
        self._model = model
        self._longest = longest
        self._met: dict[str, tuple[str, ...]] = {}

    def _readings(self, word: str) -> tuple[str, ...]:
        found = self._met.get(word)
        if found is None:
            plain = _core(word)
            if (plain.isalpha() and not _TWICE.search(plain)) or not plain:
                # The lattice has one path.
                found = (plain,)
            else:
                # Trailing signs may be punctuation or letters.
                found = (self._model.restore(plain), _core(plain.strip("".join(LEET) + SEPARATORS)))
                # Whole words may be joined by separators.
                parts = [part for part in _JOINTS.split(plain) if 3 <= len(part) < len(plain)]
                found = tuple(dict.fromkeys([*found, *[reading for part in parts for reading in self._readings(part)]]))
            if len(self._met) >= CACHED_WORDS:
                self._met.clear()
            self._met[word] = found
        return found

    def _spelled(self, letters: str) -> Iterator[str]:
        """Restored words at any place of a run of any length, read in windows that overlap by
        more than a word of ``longest`` letters with each of them three times."""
        low = _STRETCHED.sub(r"\1\1\1", letters.lower())
        overlap = 3 * self._longest + 8
        size = max(LONGEST_WORD, 2 * overlap)
        for start in range(0, max(1, len(low) - overlap), size - overlap):
            window = low[start : start + size]
            whole = window if window.isalpha() and not _TWICE.search(window) else self._model.restore(window)
            yield whole
            # Single-letter words may stand on either side of a spelled word.
            for a in range(len(whole)):
                for b in range(a + 3, min(len(whole), a + self._longest) + 1):
                    yield whole[a:b]

    def _long(self, word: str) -> Iterator[str]:
        """Readings of an unbroken token of any length; repetition is undone first."""
        low = _STRETCHED.sub(r"\1\1\1", word.lower())
        if len(low) <= LONGEST_WORD:
            yield from self._readings(low)
            return
        for part in set(_JOINTS.split(low)):
            if 3 <= len(part) <= LONGEST_WORD:
                yield from self._readings(part)
        yield from self._spelled(_JOINTS.sub("", low))

    def word_readings(self, word: str) -> Iterable[str]:
        """Restored words behind one word of a text."""
        if len(word) > LONGEST_WORD:
            return self._long(word)
        if word.isalpha() and not _TWICE.search(word.lower()):
            # One path through the lattice: nothing to look up or keep.
            return (word.lower(),)
        return self._met.get(word) or self._readings(word)

    def spelled_readings(self, text: str) -> Iterator[str]:
        """Restored words that are spelled out letter by letter."""
        for spaced in _SPACED.finditer(text):
            yield from self._spelled(_GAPS.sub("", spaced[0]))

    def readings(self, text: str) -> Iterator[str]:
        """Restored words of a text, with those spelled out letter by letter; some more than once."""
        found: set[str] = set()
        for word in set(text.split()):
            if len(word) > LONGEST_WORD:
                yield from self._long(word)
            else:
                found.update(self.word_readings(word))
        yield from found
        yield from self.spelled_readings(text)

    def words(self, text: str) -> set[str]:
        """Distinct restored words of a text."""
        return {word for word in self.readings(text) if word}


def _features(words: Iterable[str]) -> set[str]:
    """Words, and beginnings of words that inflection leaves alone."""
    out = set()
    for word in words:
        if len(word) >= 3 and len(word) <= LONGEST_WORD:
            out.add(f"={word}")
            out.update(word[:k] for k in range(4, min(7, len(word) + 1)))
    return out


def _counts(toxic: Counter[str], every: Counter[str]) -> pa.RecordBatch:
    names = list(every)
    arrays = [pa.array(names, pa.string()), *[pa.array([c[f] for f in names], pa.int64()) for c in (toxic, every)]]
    return pa.RecordBatch.from_arrays(arrays, ["feature", "n1", "n"])


@dataclass
class Lexicon:
    """Chosen features with the share of toxic ones among the documents that have them; ``base``
    is that share among documents that have none."""

    weights: dict[str, float]
    base: float
    _starts: set[str] = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self._starts = {key[:3] for key in self.weights} | {key[1:4] for key in self.weights}

    @property
    def longest(self) -> int:
        """Letters of the longest word, ``LONGEST_ENTRY`` at least."""
        return max([LONGEST_ENTRY, *[len(key) - 1 for key in self.weights if key.startswith("=")]])

    def hits(self, word: str) -> list[str]:
        """The features a restored word has."""
        if word[:3] not in self._starts:
            return []
        return [key for key in (f"={word}", word[:4], word[:5], word[:6]) if key in self.weights]

    def score(self, words: Iterable[str]) -> float:
        return self.score_hits({key for word in words for key in self.hits(word)})

    def score_hits(self, hits: set[str]) -> float:
        clean = 1.0
        for key in sorted(hits):
            clean *= 1.0 - self.weights[key]
        return min(1.0, max(0.0, 1.0 - clean)) if hits else self.base


class Scorer:
    """Scores of texts. Words of which no reading has a feature are kept, up to a fixed number, so that
    most of a text is passed over at once."""

    def __init__(self, model: CharModel, lexicon: Lexicon) -> None:
        self._reader = Restorer(model, lexicon.longest)
        self._lexicon = lexicon
        self._dull: set[str] = set()

    def score(self, text: str) -> float:
        hits: set[str] = set()
        dull: list[str] = []
        for word in set(text.split()) - self._dull:
            found = [key for reading in self._reader.word_readings(word) for key in self._lexicon.hits(reading)]
            if found:
                hits.update(found)
            elif len(word) <= LONGEST_WORD:
                dull.append(word)
        if len(self._dull) + len(dull) > DULL_WORDS:
            self._dull.clear()
        self._dull.update(dull[:DULL_WORDS])
        for reading in self._reader.spelled_readings(text):
            hits.update(self._lexicon.hits(reading))
        return self._lexicon.score_hits(hits)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit_lexicon(
    docs: DataFrame, labels: DataFrame, model: CharModel, toxic_rows: int = FIT_TOXIC, clean_rows: int = FIT_CLEAN
) -> Lexicon:
    """Fit on at most ``toxic_rows`` + ``clean_rows`` labelled documents outside the held-out fold,
    drawn by digest of doc_id; each distinct text counts once."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.select("doc_id", "toxic").distinct()
    drawn = [
        usable.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        for kind, rows in ((1, toxic_rows), (0, clean_rows))
    ]
    picked = materialise(drawn[0].unionByName(drawn[1]))
    texts = docs.where("text IS NOT NULL").join(F.broadcast(picked), "doc_id").select("text", "toxic").dropDuplicates(["text", "toxic"])

    marks = [f"mark{k}" for k in range(FAMILY_MARKS)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            sets = [shingle_set(words, 5).view(np.uint64) for words in text_words(batch.column("text"), hasher)]
            least = [
                pa.array([int(mix(s + np.uint64(k)).view(np.int64).min()) if len(s) else None for s in sets], pa.int64())
                for k in range(len(marks))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *least], ["text", "toxic", *marks])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Restorer(model)
        toxic: Counter[str] = Counter()
        every: Counter[str] = Counter()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                features = _features(reader.readings(text))
                every.update(features)
                if label == 1:
                    toxic.update(features)
                if len(every) > COUNTED_AT_ONCE:
                    yield _counts(toxic, every)
                    toxic.clear(), every.clear()
        yield _counts(toxic, every)

    kind = labels.schema["toxic"].dataType.simpleString()
    # Near copies mostly share their smallest shingle digest, so that a few such marks one after
    # the other leave one of a family to stand for all.
    placed = texts.mapInArrow(place, f"text string, toxic {kind}, " + ", ".join(f"{m} long" for m in marks))
    for mark in marks:
        placed = placed.dropDuplicates([mark, "toxic"])
    rows = materialise(placed.drop(*marks))
    partial = rows.select("text", "toxic").mapInArrow(count, "feature string, n1 long, n long")
    counts = materialise(partial.groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n").alias("n")))
    sums = rows.agg(F.sum(F.col("toxic").cast("long")).alias("n1"), F.count(F.lit(1)).alias("n")).first()
    if not sums["n1"]:
        return Lexicon({}, 0.0)
    rate = sums["n1"] / sums["n"]
    share = (F.col("n1") + 0.5) / (F.col("n") + 1.0)
    evidence = F.col("n1") * F.log(share / rate) + (F.col("n") - F.col("n1")) * F.log((1 - share) / (1 - min(rate, 0.99)))
    # More than chance gives to the best of all features tried.
    beats_chance = evidence > math.log(max(1, counts.count()) / CHANCE)
    good = counts.where((F.col("n1") >= MIN_DOCS) & (share >= MIN_PRECISION) & beats_chance)
    good = good.orderBy(F.desc(evidence), "feature").limit(MOST_FEATURES).select("feature", share.alias("share")).toArrow()
    weights = dict(zip(good["feature"].to_pylist(), good["share"].to_pylist(), strict=True))
    # What documents without any of them are: scored once more, over the fitted rows.
    lexicon = Lexicon(weights, 0.0)

    def misses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model, lexicon)
        for batch in batches:
            hit = [scorer.score(text) > 0 for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(hit, pa.bool_())], ["toxic", "hit"])

    judged = rows.select("text", "toxic").mapInArrow(misses, f"toxic {kind}, hit boolean").where("NOT hit")
    rest = judged.agg(F.sum(F.col("toxic").cast("long")).alias("n1"), F.count(F.lit(1)).alias("n")).first()
    base = ((rest["n1"] or 0) + 0.5) / (rest["n"] + 1.0) if rest["n"] else 0.0
    return Lexicon(weights, min(base, 0.49))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All columns of ``docs`` with ``held_out``, ``score`` (0 to 1) and ``predicted`` (columns of
    these names are replaced).

    Words that hold signs, separators or a doubled letter, and words spelled out sign by sign with
    any run of blanks or separators between, become a character lattice that Viterbi decoding reads under a trigram model of all
    texts; the restored words are scored by a lexicon learnt from labelled rows outside the
    held-out fold. Labels, language, source and doc_id do not enter a score. Null and empty texts
    get the score of a text without lexicon words. Without usable labels every score is 0.
    Repeated rows get repeated results; an empty table gives none. Texts are scored whole:
    spelled-out runs and unbroken tokens are decoded at any length, in overlapping windows.
    """
    plain = only(docs, doc_id=doc_id, text=text)
    model = fit_char_model(plain)
    lexicon = fit_lexicon(plain, labels, model)
    shared = docs.sparkSession.sparkContext.broadcast((model, lexicon))
    kept = [name for name in docs.columns if name not in ("held_out", "score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        char_model, table = shared.value
        scorer = Scorer(char_model, table)
        for batch in batches:
            scores = [scorer.score(value or "") for value in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], pa.array(scores, pa.float64())], [*kept, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in kept)
    scored = docs.select(*kept, docs[text].alias("_text")).mapInArrow(run, f"{fields}, score double")
    return scored.withColumns({"held_out": held_out(F.col(doc_id)), "predicted": (F.col("score") >= 0.5).cast("int")})
