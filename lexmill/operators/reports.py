"""Aggregate reports over documents and metrics."""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import patterns as rx
from lexmill.functions import tokens
from lexmill.functions.metrics import TEXT_METRICS, composite_score, sentence_length_score


def quality_report(scored: DataFrame) -> DataFrame:
    """Documents, mean score and counts per category; the ``all`` row holds the total.

    Input: the columns of ``with_quality``.  Unscored short texts are counted
    as ``very_low``, their score being 0.
    """
    category = F.coalesce("quality_category", F.lit("very_low"))
    grouped = scored.select(category.alias("category"), "quality_score").rollup("category")
    return grouped.agg(F.count("*").alias("n"), F.avg("quality_score").alias("avg_score")).withColumn(
        "category", F.coalesce("category", F.lit("all")))


def file_report(scored: DataFrame, name: str = "filename") -> DataFrame:
    """One report line per document: score, category, language, length, diversity."""
    return scored.select(name, "quality_score", "quality_category", "language", "length", "lexical_diversity")


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def language_counts(metrics: DataFrame, language: str = "language", length: str = "length") -> DataFrame:
    return metrics.groupBy(language).agg(F.count("*").alias("n"), F.avg(length).alias("avg_length"))


def sentence_length_by_language(metrics: DataFrame) -> DataFrame:
    """Mean sentence length per language, longest first."""
    return metrics.groupBy("language").agg(F.avg("avg_sentence_length").alias("avg_sentence_length")).orderBy(
        F.col("avg_sentence_length").desc(), "language")


def metrics_correlation(metrics: DataFrame, columns: list[str] = TEXT_METRICS) -> DataFrame:
    """Pearson correlation of every pair: (metric_a, metric_b, r); one pass."""
    pairs = list(combinations_with_replacement(columns, 2))
    row = metrics.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    both = {(x, y): f"{a}|{b}" for a, b in pairs for x, y in ((a, b), (b, a))}
    entries = F.array(*[
        F.struct(F.lit(a).alias("metric_a"), F.lit(b).alias("metric_b"), F.col(f"`{c}`").alias("r"))
        for (a, b), c in both.items()
    ])
    return row.select(F.inline(entries))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram: (bin, lower, upper, n); the last bin is closed."""
    bounds = df.agg(F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).alias("b"))
    b = bounds.scalar()
    lo = b["lo"]
    # A constant column gets a range of width 1 around it.
    flat = b["lo"] == b["hi"]
    lo, hi = F.when(flat, lo - 0.5).otherwise(lo), F.when(flat, b["hi"] + 0.5).otherwise(b["hi"])
    width = (hi - lo) / bins
    index = F.least(F.floor((F.col(column) - lo) / width), F.lit(bins - 1))
    counted = df.where(F.col(column).isNotNull()).groupBy(index.alias("bin")).agg(F.count("*").alias("n"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return all_bins.join(F.broadcast(counted), "bin", "left").select(
        "bin", (lo + F.col("bin") * width).alias("lower"), (lo + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"))


_LINE, _BLANK, _WORD = 0, 1, 2


def line_profile(df: DataFrame, by: list[str] | None = None, text: str = "text") -> DataFrame:
    """Line statistics of a corpus, or per group of the ``by`` columns.

    Non-blank lines, their mean length and words, distinct words, and the
    ratios of symbols, duplicate, empty and malformed lines (under 3 characters,
    or more ``[`` than ``]``).  Lines and words are distributed by value before
    anything distinct is counted, so a large group is not gathered in one task.
    """
    by = by or []
    count_of = lambda s, ch: F.length(s) - F.length(F.replace(s, F.lit(ch), F.lit("")))
    digest = lambda x: (F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"))
    zero = F.lit(0)

    def of_line(line: Column) -> Column:
        malformed = (F.length(line) < 3) | (count_of(line, "[") > count_of(line, "]"))
        # A 128-bit digest stands for the line; lines themselves do not travel.
        return F.struct(
            F.when(line != "", F.lit(_LINE)).otherwise(F.lit(_BLANK)).alias("kind"), *digest(line), F.length(line).alias("chars"),
            F.regexp_count(line, F.lit(rx.NON_SPACE + "+")).alias("words"), rx.count_symbols(line).alias("symbols"),
            malformed.cast("int").alias("malformed"))

    def of_word(word: Column) -> Column:
        return F.struct(F.lit(_WORD).alias("kind"), *digest(word), *[zero.alias(c) for c in ("chars", "words", "symbols", "malformed")])

    # Words do not cross lines; repeats inside a text go before the shuffle.
    spelled = F.array_distinct(F.array_remove(F.split(text, rx.SPACE + "+"), ""))
    entries = F.concat(
        F.transform(tokens.lines(text), lambda x: rx.let(rx.strip(x), of_line)), F.transform(spelled, of_word))
    sums = ["chars", "words", "symbols", "malformed"]
    # One row per distinct line or word of a group, combined before the shuffle; equal ones have equal measures.
    distinct = df.select(*by, F.inline(entries)).groupBy(*by, "kind", "a", "b").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in sums])
    of = lambda kind, x: F.sum(F.when(F.col("kind") == kind, x))
    stats = distinct.groupBy(*by).agg(
        of(_LINE, F.col("n")).alias("line_count"), F.coalesce(of(_BLANK, F.col("n")), zero).alias("_empty"),
        F.count_if(F.col("kind") == _LINE).alias("_distinct"), F.count_if(F.col("kind") == _WORD).alias("vocabulary_size"),
        *[of(_LINE, F.col("n") * F.col(c)).alias(f"_{c}") for c in sums])
    lines = F.col("line_count")
    stats = stats.where(lines > 0)
    return stats.select(
        *by,
        "line_count",
        (F.col("_chars") / lines).alias("avg_line_length"),
        (F.col("_words") / lines).alias("avg_word_count"),
        "vocabulary_size",
        (F.col("_symbols") / F.col("_chars")).alias("special_char_ratio"),
        (1 - F.col("_distinct") / lines).alias("duplicated_line_ratio"),
        (F.col("_empty") / (lines + F.col("_empty"))).alias("empty_line_ratio"),
        (F.col("_malformed") / lines).alias("malformed_line_ratio"),
    )


def size_reduction_report(analysed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Original size, expected sizes after cleaning, and four indicators.

    Input: the columns of ``with_noise_analysis``.
    """
    length = F.col("text_length")
    left = lambda c: length * (1 - F.col(c) / 100)
    return analysed.withColumn("_score", composite_score()).groupBy(*(by or [])).agg(
        F.sum(length).alias("original_chars"),
        F.sum(left("regular_reduction")).alias("regular_chars"),
        F.sum(left("deep_reduction")).alias("deep_chars"),
        F.avg("_score").alias("overall_score"),
        F.avg(1.0 - F.col("html_ratio")).alias("html_cleanliness"),
        F.avg(sentence_length_score("avg_sentence_length")).alias("text_quality"),
        F.avg(1.0 - F.least(F.lit(1.0), F.col("noise_ratio") * 10)).alias("noise_level"),
    )


def text_sanity(df: DataFrame, text: str = "text", shortest: int = 10) -> DataFrame:
    """One row: mean length of all items and whether they look too short."""
    return df.agg(F.avg(F.length(text)).alias("avg_length")).withColumn("too_short", F.col("avg_length") < shortest)


def training_profile(
    train: DataFrame, vocabulary: DataFrame, label: str = "label", batch_size: int = 32, epochs: int = 10,
    test_rows: int | None = None,
) -> DataFrame:
    """One row: size of the problem and the recommended training parameters."""
    n = F.col("n_train")
    batch = F.when(n > 100_000, F.greatest(F.lit(64), F.lit(batch_size))).otherwise(F.lit(batch_size))
    tiny_test = F.lit(test_rows is not None and test_rows < 3)
    profile = train.agg(F.count("*").alias("n_train"), F.count_distinct(label).alias("n_labels"))
    return profile.select(
        "n_train",
        "n_labels",
        vocabulary.agg(F.count("*").alias("n")).scalar().alias("vocabulary_size"),
        F.least(batch.cast("long"), n).alias("batch_size"),
        F.when(n < 10, 0.001).when(n > 100_000, 0.005).otherwise(0.01).alias("learning_rate"),
        F.when((n < 10) & tiny_test, F.greatest(F.lit(20), F.lit(epochs))).otherwise(F.lit(epochs)).alias("epochs"),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def distinct_values(df: DataFrame, column: str | Column) -> DataFrame:
    return df.select(column).distinct()
