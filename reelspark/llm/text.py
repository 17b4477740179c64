"""What the text operators share: word classes, column choice and small pure helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The characters that separate words.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; a null or blank text has none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_CLASS + "+"))


def count_words(text: Column) -> Column:
    """Number of words without building them: starts of words after blanks are unified."""
    unified = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.regexp_count(unified, F.lit("[^ ]+")).cast("long")


def quoted(name: str) -> Column:
    """A column by its whole name, whatever dots or backticks are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the names an operator works with; all others are left out,
    so extra columns cannot clash with its own."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def split_count(rows: int, per_group: int) -> int:
    """Groups needed so that none holds more than about ``per_group`` rows."""
    return max(1, -(-rows // per_group))
