"""Sketches of a growing corpus: a few kilobytes per group that add up, instead of another pass over all texts.

Each run sketches its new documents and keeps the sketches; merged, they answer for the whole
corpus.  Counts and sums are exact; quantiles, distinct lines and distinct words are
estimates within the errors named below.  ``reports`` has the exact forms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import patterns as rx
from lexmill.functions import tokens
from lexmill.sources.sinks import replace_output

#: Sizes of the sketches: ranks of quantiles are off by about 0.4 %, distinct counts by 0.8 % (standard error), and
#: fewer distinct values than 2 ** LINE_BITS are counted exactly.
QUANTILE_SIZE, LINE_BITS, WORD_BITS = 800, 14, 14

_SUMS = ("n_texts", "n_chars", "n_lines", "n_empty_lines")


def corpus_sketches(df: DataFrame, by: Sequence[str] = (), text: str = "text") -> DataFrame:
    """One row per group: exact counts, and sketches of text lengths, lines and words.

    One pass over the texts; tasks send one sketch per group, never the lines or words, so a
    group with most of the texts is no hot task.  Null texts are left out.
    """
    entry = lambda kind, value, length: F.struct(F.lit(kind).alias("kind"), value.alias("h"), length.cast("long").alias("n"))
    none = F.lit(None).cast("long")
    body = F.col(f"`{text}`")
    lines = F.transform(tokens.lines(body), rx.strip)
    words = F.array_distinct(F.array_remove(F.split(body, rx.SPACE + "+"), ""))
    entries = F.concat(
        F.array(entry(0, none, F.length(body))),
        F.transform(lines, lambda x: entry(1, F.when(x != "", F.xxhash64(x)), F.length(x))),
        F.transform(words, lambda x: entry(2, F.xxhash64(x), F.lit(0))))
    rows = df.where(body.isNotNull()).select(*[F.col(f"`{c}`") for c in by], F.explode(entries).alias("e"))
    kind, h, n = F.col("e.kind"), F.col("e.h"), F.col("e.n")
    return rows.groupBy(*[f"`{c}`" for c in by]).agg(
        F.count_if(kind == 0).alias("n_texts"), F.coalesce(F.sum(F.when(kind == 0, n)), F.lit(0)).alias("n_chars"),
        F.count_if((kind == 1) & h.isNotNull()).alias("n_lines"), F.count_if((kind == 1) & h.isNull()).alias("n_empty_lines"),
        F.kll_sketch_agg_bigint(F.when(kind == 0, n), QUANTILE_SIZE).alias("lengths"),
        F.theta_sketch_agg(F.when(kind == 1, h), LINE_BITS).alias("lines"),
        F.hll_sketch_agg(F.when(kind == 2, h), WORD_BITS).alias("words"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of runs or groups added up, as if their texts had been sketched together."""
    return sketches.groupBy(*[f"`{c}`" for c in by]).agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.kll_merge_agg_bigint("lengths").alias("lengths"),
        F.theta_union_agg("lines", LINE_BITS).alias("lines"), F.hll_union_agg("words", False).alias("words"))


def describe_sketches(sketches: DataFrame, quantiles: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Counts, mean length, length at the quantiles, distinct lines, share of repeated lines and vocabulary size."""
    kept = [F.col(f"`{c}`") for c in sketches.columns if c not in (*_SUMS, "lengths", "lines", "words")]
    distinct = F.least(F.theta_sketch_estimate("lines"), F.col("n_lines"))
    return sketches.select(
        *kept, *_SUMS, (F.col("n_chars") / F.col("n_texts")).alias("avg_length"),
        *[F.kll_sketch_get_quantile_bigint("lengths", F.lit(q)).alias(f"length_p{q * 100:g}".replace(".", "_")) for q in quantiles],
        distinct.alias("distinct_lines"), (1 - distinct / F.nullif("n_lines", F.lit(0))).alias("duplicated_line_ratio"),
        F.hll_sketch_estimate("words").alias("vocabulary_size"))


def sketch_histogram(sketches: DataFrame, edges: Sequence[int]) -> DataFrame:
    """(group columns, lower, upper, n): texts with lower <= length < upper, estimated, for each pair of edges."""
    kept = [F.col(f"`{c}`") for c in sketches.columns if c not in (*_SUMS, "lengths", "lines", "words")]
    # Lengths are whole numbers, so below an edge is up to the number before it.
    rank = lambda e: F.kll_sketch_get_rank_bigint("lengths", F.lit(e - 1).cast("long"))
    bins = F.array(*[
        F.struct(F.lit(a).alias("lower"), F.lit(b).alias("upper"), F.round((rank(b) - rank(a)) * F.col("n_texts")).cast("long").alias("n"))
        for a, b in zip(edges, edges[1:])])
    return sketches.select(*kept, F.inline(bins))


def save_sketches(sketches: DataFrame, path: str, run: str) -> None:
    """Keep the sketches of one run; a repeated run replaces its own."""
    replace_output(sketches.sparkSession, f"{path.rstrip('/')}/run={run}", sketches.write.parquet)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """Sketches of all runs, with the column ``run``."""
    return spark.read.parquet(path)
