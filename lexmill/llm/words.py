"""Word expressions shared by the native operators: words are runs without ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is anything between these characters.
BLANK = r"[\x20\x09-\x0D]"
_BLANKS = " \t\n\x0b\x0c\r"


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text: Column | str) -> Column:
    """Array of the words; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(column(text), F.lit("")), F.lit(_BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK + "+"))


def word_count(text: Column | str) -> Column:
    return F.regexp_count(F.coalesce(column(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body(value)`` several times."""
    return F.transform(F.array(value), body)[0]


ROW = "_row"


def whole_rows(df: DataFrame, *columns: Column) -> DataFrame:
    """The rows as one struct ``ROW``, so that no name of theirs clashes with the columns added."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW), *columns)
