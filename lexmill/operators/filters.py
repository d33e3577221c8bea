"""Document filters (row-wise)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import lexicon as lx
from lexmill.functions import patterns as rx
from lexmill.functions import tokens
from lexmill.functions.language import primary_script
from lexmill.functions.quality import FILTER_COLUMNS, filter_reason, quality


def with_filter_reason(df: DataFrame, text: str = "text", language: Column | str | None = None) -> DataFrame:
    """Add ``filter_reason``, evaluated once per row; null means the document is kept."""
    reason = rx.bind(
        {"t": F.col(text), "q": quality(text, language, FILTER_COLUMNS)}, lambda s: filter_reason(s["t"], s["q"]))
    return rx.add_once(df, {"filter_reason": reason})


def keep_good_quality(df: DataFrame, text: str = "text", language: Column | str | None = None) -> DataFrame:
    """Documents that no quality rule drops."""
    return with_filter_reason(df, text, language).where(F.col("filter_reason").isNull()).drop("filter_reason")


def min_length(text: Column | str, n: int = 100) -> Column:
    return F.length(rx.as_col(text)) >= n


def not_blank(text: Column | str) -> Column:
    return rx.strip(text) != ""


def remove_remnants(text: Column | str) -> Column:
    """Tags, entities and template markup to blanks; then drop symbol-heavy and interface lines."""
    cleaned = rx.replace_chain(text, [(r, " ") for r in lx.REMNANT_RULES])
    interface = "|".join(f"(?:{rule})" for rule, _ in lx.PATTERN_FILTER_BOILERPLATE)

    def keep(line: Column) -> Column:
        symbols = rx.count_symbols(line)
        return (line != "") & (symbols / F.length(line) <= 0.3) & ~rx.matches(line, interface, ignore_case=True)

    return F.array_join(F.filter(F.transform(tokens.lines(cleaned), rx.strip), keep), "\n")


def _looks_like_exam(text: Column) -> Column:
    def found(name: str) -> Column:
        return rx.rules_found(text, rx.compiled(lx.PATTERN_FILTER_EXAM[name], ignore_case=True))

    any_script = [
        rx.count_matches(text, r, ignore_case=True, multiline=True) >= 3 for r in lx.PATTERN_FILTER_EXAM_ANY_SCRIPT
    ]
    own = rx.let(primary_script(text), lambda script: F.when(script == "chinese", found("chinese"))
                 .when(script == "japanese", found("japanese")).otherwise(found("english")))
    return rx.any_of(any_script) | (own >= 2)


def _looks_like_boilerplate(text: Column) -> Column:
    strong = [r for r, s in lx.PATTERN_FILTER_BOILERPLATE if s]
    weak = rx.compiled([r for r, s in lx.PATTERN_FILTER_BOILERPLATE if not s], ignore_case=True)
    return rx.matches(text, "|".join(f"(?:{r})" for r in strong), ignore_case=True) | (
        rx.rules_found(text, weak) >= lx.PATTERN_FILTER_WEAK_LIMIT)


def pattern_filtered(text: Column | str) -> Column:
    """Multilingual pattern filter for multi-line text.

    The text without remnants, white space collapsed; null where the document
    is dropped.
    """
    def repetitive(t: Column) -> Column:
        return rx.let(tokens.words(F.lower(t)), lambda w: (F.size(w) > 30) & (
            F.size(F.array_distinct(w)) / F.size(w) < 0.2))

    def enough_text(body: Column) -> Column:
        flat = F.when(F.size(F.split(body, "\n")) >= 3, F.trim(rx.collapse_spaces(body)))
        return rx.let(flat, lambda x: F.when(F.length(x) >= 50, x))

    return rx.let(rx.as_col(text), lambda t: F.when(
        (F.length(t) >= 50) & ~_looks_like_exam(t) & ~_looks_like_boilerplate(t) & ~repetitive(t),
        rx.let(remove_remnants(t), enough_text)))


def with_pattern_filter(df: DataFrame, text: str = "text", out: str = "clean_text") -> DataFrame:
    """Add the pattern-filtered text, evaluated once per row."""
    return rx.add_once(df, {out: pattern_filtered(text)})


def pattern_filter(df: DataFrame, text: str = "text") -> DataFrame:
    """Documents that pass the pattern filter, with their cleaned text in place."""
    kept = with_pattern_filter(df, text, "_pf_out").where(F.col("_pf_out").isNotNull())
    return kept.withColumn(text, F.col("_pf_out")).drop("_pf_out")
