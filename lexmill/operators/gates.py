"""Cleaning decided by measured quality (row-wise)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import lexicon as lx
from lexmill.functions import patterns as rx
from lexmill.functions.cleaning import cjk_language, clean_basic, clean_cjk, clean_text
from lexmill.functions.metrics import composite_score, needs_deep_cleaning, noise_analysis, with_noise_analysis
from lexmill.functions.quality import quality, word_stats

#: What clean_text cuts out of words, by a mark in each, and the letter whose lower case depends on its neighbours.
_WORDS_MAY_CHANGE = ["http", "www.", "&", "@", "\u03a3"]


def clean_by_quality(df: DataFrame, text: str = "text", out: str = "clean_text", mode: str = "document") -> DataFrame:
    """Basic cleaning for high-quality texts, deep cleaning for the rest.

    Adds the cleaned text, ``cleaning_applied``, ``quality_before``,
    ``quality_after`` and ``quality_improvement``.
    """
    marked = rx.any_of([F.col(text).contains(m) for m in _WORDS_MAY_CHANGE])
    before = rx.add_once(df, {"_words": word_stats(text), "_cjk": cjk_language(text), "_marked": marked})
    before = rx.add_once(before, {"_before": quality(text, columns=["quality_score"], words=F.col("_words"))})
    language, score = F.col("_cjk"), F.col("_before.quality_score")
    high = score >= lx.QUALITY_THRESHOLDS["high"]
    deep = rx.bind({"x": clean_text(text, True, mode), "lang": language}, lambda s: F.when(
        s["lang"].isin(lx.CJK_LANGUAGES), clean_cjk(s["x"], s["lang"])).otherwise(s["x"]))
    cleaned = rx.add_once(before, {out: F.when(high, clean_basic(text, mode)).otherwise(deep)})
    # A document that is kept as one line loses white space and symbols: its words stay, and with them what is counted of them.
    changed = F.col("_marked") | F.col("_cjk").isNotNull() | (F.col(out) == "")
    words = word_stats(out) if mode != "document" else F.when(changed, word_stats(out)).otherwise(F.col("_words"))
    after = rx.add_once(cleaned, {"quality_after": quality(out, columns=["quality_score"], words=words)["quality_score"]})
    return after.withColumns({
        "cleaning_applied": F.when(high, "minimal").otherwise("deep"),
        "quality_before": score,
        "quality_improvement": F.col("quality_after") - score,
    }).drop("_before", "_words", "_cjk", "_marked")


def clean_from_analysis(df: DataFrame, text: str = "text", out: str = "clean_text", mode: str = "document") -> DataFrame:
    """Clean by the noise analysis columns: deep unless regular cleaning suffices.

    Adds ``out`` and ``deep_cleaned``.
    """
    df = df.withColumn("deep_cleaned", needs_deep_cleaning())
    return rx.add_once(df, {
        out: F.when(F.col("deep_cleaned"), clean_text(text, True, mode)).otherwise(clean_basic(text, mode))})


def clean_if_better(
    df: DataFrame, text: str = "text", threshold: float = 0.7, out: str = "clean_text", mode: str = "document",
) -> DataFrame:
    """Clean texts scoring under ``threshold``; keep the result only if it scores higher.

    Adds ``out``, ``score_before``, ``score_after`` (null where not cleaned) and
    ``was_cleaned``.
    """
    # Cleaned both ways once: for the analysis and as the result that is tried.
    df = rx.add_once(df, {"_basic": clean_basic(text, mode), "_deep": clean_text(text, True, mode)})
    df = rx.add_once(df, {"_noise": noise_analysis(text, True, mode, cleaned=("_basic", "_deep"))})
    df = df.withColumn("score_before", composite_score(F.col("_noise")))
    tried = F.when(F.col("score_before") < threshold, F.when(
        needs_deep_cleaning(F.col("_noise")), F.col("_deep")).otherwise(F.col("_basic")))
    df = rx.add_once(df, {"_cleaned": tried}).drop("_noise", "_basic", "_deep")
    after = F.when(F.col("_cleaned").isNotNull(), rx.let(noise_analysis("_cleaned", True, mode), composite_score))
    df = rx.add_once(df, {"score_after": after})
    df = df.withColumn("was_cleaned", F.coalesce(F.col("score_after") > F.col("score_before"), F.lit(False)))
    return df.withColumn(out, F.when(F.col("was_cleaned"), F.col("_cleaned")).otherwise(F.col(text))).drop("_cleaned")


def mean_analysis(df: DataFrame, text: str = "text", mode: str = "document") -> DataFrame:
    """One row: mean score and whether basic cleaning is enough by the mean reductions."""
    analysed = with_noise_analysis(df.select(text), text, mode=mode)
    regular, deep = F.avg("regular_reduction"), F.avg("deep_reduction")
    return analysed.withColumn("_score", composite_score()).agg(
        F.avg("_score").alias("score"), F.coalesce((deep - regular < 10) & (regular > 30), F.lit(False)).alias("basic_is_enough"))
