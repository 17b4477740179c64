"""Quality rules: a threshold table compiled into Spark projections, without user functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from reelspark.llm.text import SPACES, only, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on this are or from at an not have "
    "der die das und in zu den von mit ist des im für auf nicht ein eine dem sich es "
    "le la les de des et en un une du que pour dans est par sur qui au avec pas "
    "el los las una por del se con su al lo como más pero y es"
).split()


@dataclass(frozen=True)
class Threshold:
    """``low * per - slack <= value <= high * per + slack``; a bound that is None does not apply.

    The slack keeps chance in short texts from deciding.
    """

    name: str
    value: str
    per: str
    low: float | None = None
    high: float | None = None
    slack: int = 0

    def passes(self) -> Column:
        bounds = []
        if self.low is not None:
            bounds.append(F.col(self.value) + self.slack >= F.lit(self.low) * F.col(self.per))
        if self.high is not None:
            bounds.append(F.col(self.value) - self.slack <= F.lit(self.high) * F.col(self.per))
        return reduce(lambda a, b: a & b, bounds, F.lit(True))


THRESHOLDS: tuple[Threshold, ...] = (
    Threshold("word_length", "word_chars", "n_words", low=2, high=16),
    Threshold("symbols", "n_symbols", "n_words", high=0.1),
    Threshold("stop_words", "n_stop_words", "n_words", low=0.02, slack=1),
    Threshold("dup_lines", "n_dup_lines", "n_lines", high=0.3, slack=1),
    Threshold("shouting", "n_shouts", "n_words", high=0.3),
)


def _windows(words: Column) -> Column:
    """64-bit digests of all windows in order."""
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    digest = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    return F.when(F.size(words) >= WINDOW, F.transform(starts, digest)).otherwise(F.array().cast("array<bigint>"))


def _repeat_starts(ordered: Column) -> Column:
    """Starts of windows whose digest has a twin beside it in sorted order, ascending."""

    def twin(x: Column, k: Column) -> Column:
        before = F.get(ordered, k - 1)["h"] == x["h"]
        after = F.get(ordered, k + 1)["h"] == x["h"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    return F.sort_array(F.transform(F.filter(ordered, twin), lambda x: x["i"]))


def _cover_start() -> Column:
    return F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))


def _cover_step(acc: Column, start: Column) -> Column:
    new = F.lit(WINDOW) - F.greatest(F.lit(0), acc["end"] - start)
    return F.struct((acc["n"] + new).alias("n"), (start + WINDOW).alias("end"))


def text_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of ``df`` with the counts of ``text`` that rules and classifiers use.

    Only projections: a row is counted by itself and nothing is shuffled. A null text counts as empty.
    """
    others = [name for name in df.columns if name != text]
    plain = F.coalesce(F.col(text), F.lit(""))
    without = lambda chars: F.length(F.translate(plain, chars, ""))
    base = df.select(
        *others,
        words_of(F.col(text)).alias("words"),
        F.filter(F.split(plain, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "").alias("lines"),
        without(SPACES).cast("bigint").alias("word_chars"),
        (F.length(plain) - without(SYMBOLS)).cast("bigint").alias("n_symbols"),
    )
    windows = base.withColumn("windows", _windows(F.col("words")))
    # Most texts repeat no window and stop here; an array a lambda looks into must be a column of
    # its own, or it would be built again for each element.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    tagged = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    ordered = windows.withColumn("ordered", F.when(repeats, F.sort_array(tagged)))
    return ordered.select(
        *others,
        F.size("words").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.col("ordered").isNull(), F.lit(0).cast("bigint"))
        .otherwise(F.aggregate(_repeat_starts(F.col("ordered")), _cover_start(), _cover_step, lambda acc: acc["n"]))
        .alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: w.isin(*dict.fromkeys(STOP_WORDS)))).cast("bigint").alias("n_stop_words"),
        F.size(F.filter("words", lambda w: w.endswith("!!"))).cast("bigint").alias("n_shouts"),
    )


def apply_rules(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", thresholds: Sequence[Threshold] = THRESHOLDS
) -> DataFrame:
    """One row per document: its counts, ``base_failed``, the rules it failed and ``kept``.

    Null and blank texts have no words and fail the base. Repeated rows give repeated results.
    Columns other than the two named are ignored. An empty table gives no rows.
    """
    counted = text_counts(only(df, doc_id=doc_id, text=text))
    failed = F.filter(
        F.array(*[F.when(~rule.passes(), F.lit(rule.name)) for rule in thresholds]), lambda name: name.isNotNull()
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")
    )
    judged = counted.withColumn("base_failed", base_failed).withColumn("failed_rules", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
