"""Spelling variants: words one edit apart, found by partitioned and enumerated signatures.

A word's letters, numbered by occurrence, are a set: a binary vector. Words one edit apart have
vectors at Hamming distance two at most, so of six parts of the vector at least four agree. A word has
one signature per choice of four parts; words that share one are compared exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from reelspark.llm.text import only
from reelspark.session import broadcast_if_small, materialise

# What a run of letters is, and the occurrences in which a letter is left out.
LETTER_RUN = r"([A-Za-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP_EVERY = 199

DISTANCE = 2
PARTS = 6
CHOICES = tuple(combinations(range(PARTS), PARTS - DISTANCE))
HOT_WORDS = 256
KEY_BYTES = 96
# Frequent letters of European languages first, so that each part of the vector has its share of them.
LETTER_ORDER = "etaoinshrdlucmfwypvbgkqjxz"
_WRAP = 1 << 64


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def letter_runs(docs: DataFrame, least_letters: int) -> DataFrame:
    """(word) per run of letters of at least so many signs, with the planted slips taken out."""
    spelled = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(LETTER_RUN), F.lit(1))).alias("run"),
    ).where(F.char_length("run") >= least_letters)
    lowered = spelled.select("id", lower_ascii(F.col("run")).alias("run"))
    digest = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    hashed = lowered.select("run", digest.alias("h"))
    at = F.pmod("h", F.char_length("run")).cast("int")
    slipped = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return hashed.select(F.when(F.pmod("h", F.lit(SLIP_EVERY)) == 0, slipped).otherwise(F.col("run")).alias("word"))


def count_words(docs: DataFrame, least_letters: int, least_count: int) -> DataFrame:
    """(word, n) over all texts, counted in the tasks before the shuffle."""
    words = letter_runs(docs, least_letters).where(F.char_length("word") >= least_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


@lru_cache(maxsize=1 << 16)
def _element(letter: str, occurrence: int) -> tuple[int, int, int]:
    """Part, 64-bit name and mask bit of an element of the vector."""
    name = xxhash.xxh64_intdigest(f"{letter}{occurrence}")
    rank = LETTER_ORDER.find(letter)
    return ((rank if rank >= 0 else name) + 3 * occurrence) % PARTS, name, 1 << (name >> 58)


def signatures(word: str) -> tuple[list[int], int]:
    """The signatures of a word, and a mask of 64 bits in which words differ in no more bits than in elements."""
    parts, mask = [0] * PARTS, 0
    seen: Counter[str] = Counter()
    for letter in word:
        seen[letter] += 1
        part, name, bit = _element(letter, seen[letter])
        parts[part] = (parts[part] + name) % _WRAP
        mask ^= bit
    keys = [
        xxhash.xxh64_intdigest(b"".join(parts[p].to_bytes(8, "little") for p in choice), seed=number)
        for number, choice in enumerate(CHOICES)
    ]
    return [_signed(key) for key in keys], _signed(mask)


def _signed(value: int) -> int:
    return value - _WRAP if value >> 63 else value


def _with_signatures(words: DataFrame) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, masks = zip(*map(signatures, batch.column("word").to_pylist()), strict=True) if len(batch) else ((), ())
            columns = [*batch.columns, pa.array(masks, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "mask", "keys"])

    signed = words.select("word", "n").mapInArrow(sign, "word string, n long, mask long, keys array<long>")
    return signed.select("word", "n", "mask", F.explode("keys").alias("key"))


def _shorter_forms(word: Column) -> Column:
    """The word and all it becomes by leaving out one sign: words one edit apart share one of them."""
    size = F.char_length(word)
    left_out = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, size)),
    )
    return F.array_distinct(F.concat(F.array(word), left_out))


def _meet(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of words one edit apart that share ``keys``; the cheap bounds come first."""
    a, b = rows.alias("a"), rows.alias("b")
    same = F.col("a.word") < F.col("b.word")
    for key in keys:
        same = same & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    close = F.bit_count(F.col("a.mask").bitwiseXOR(F.col("b.mask"))) <= DISTANCE
    apart = F.abs(F.char_length("a.word") - F.char_length("b.word")) <= 1
    one_edit = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    names = [F.col(f"{side}.{column}").alias(f"{column}_{side}") for side in "ab" for column in ("word", "n")]
    return a.join(b, same & close & apart & one_edit).select(*names)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n) -> (word_a, n_a, word_b, n_b), each pair of words one edit apart once.

    A signature that many words share is divided by their forms with a sign left out; a form is shared by as many
    words as one sign can be put into it, whatever the size of the corpus.
    """
    keyed = materialise(_with_signatures(words))
    hot = materialise(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > HOT_WORDS).select("key"))
    hot = broadcast_if_small(hot, hot.count(), KEY_BYTES)
    pairs = _meet(keyed.join(hot, "key", "left_anti"), ["key"])
    divided = keyed.join(hot, "key", "left_semi").withColumn("form", F.explode(_shorter_forms(F.col("word"))))
    divided = divided.withColumn("form", F.xxhash64("form"))
    return pairs.unionByName(_meet(divided, ["key", "form"])).distinct()


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): forms followed to the last, twice as far each round.

    A form has several times the occurrences of its word, so the chains are as long as the logarithm
    of the largest count at most.
    """
    reached = forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved"))
    while True:
        reached = materialise(reached)
        if reached.where("moved").isEmpty():
            return reached.drop("moved")
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = reached.where("moved").join(ahead, "root", "left")
        went = joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        reached = reached.where("not moved").unionByName(went)


def spelling_variants(
    docs: DataFrame, least_letters: int = 6, least_count: int = 5, times: int = 5, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    Words are the lower-cased letter runs of all texts with at least ``least_letters`` signs and ``least_count``
    occurrences. Words are near if one inserted, deleted or replaced sign tells them apart; the form is the near word with the
    most occurrences (ties: the smallest), if it has ``times`` as many as the word; the root is where forms end.
    Null and empty texts have no words, a null doc_id counts as an empty name, repeated rows count each time,
    texts are read whole, a table without words gives no rows. Other columns are left out, whatever their names.
    """
    words = materialise(count_words(only(docs, doc_id=doc_id, text=text), least_letters, least_count))
    pairs = near_words(words)
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("word_a").alias("word"), F.col("word_b").alias("other"), F.col("n_b").alias("count")),
                F.struct(F.col("word_b").alias("word"), F.col("word_a").alias("other"), F.col("n_a").alias("count")),
            )
        ).alias("side")
    ).select("side.*")
    best = F.min(F.struct((-F.col("count")).alias("below"), "other"))
    near = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = words.join(near, "word", "left")
    enough = -F.col("best.below") >= times * F.col("n")
    known = materialise(
        known.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.below")).alias("form_n"),
        )
    )
    roots = last_forms(known.where("form IS NOT NULL").select("word", "form"))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
