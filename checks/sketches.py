"""Sketches kept per run and merged, against the exact answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sqltext as s
from checks.registry import query, table
from lexmill.functions import patterns as rx
from lexmill.functions import tokens
from lexmill.operators import sketches as sk
from lexmill.operators.scratch import materialized, new_folder

_LINES = f"l AS (SELECT source, {s.strip('x')} AS l FROM (SELECT source, unnest(string_split(text, chr(10))) AS x FROM documents))"


def _in_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs of documents, the first of them repeated, by source."""
    folder, docs = new_folder(spark), table(spark, sf, "documents")
    for run in (0, 1, 2, 0):
        part = docs.where(F.col("doc_id") % 3 == run)
        sk.save_sketches(sk.corpus_sketches(part, ["source"]), folder, str(run))
    return materialized(sk.merge_sketches(sk.read_sketches(spark, folder), ["source"]))


# Exact counts by source, and whether the estimates are within 3 % of the exact answers, which SQL states.
@query(f"""WITH {_LINES}, w AS (SELECT source, unnest(regexp_extract_all(text, '[^\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]+')) AS w FROM documents),
a AS (SELECT source, count(*) AS n_texts, sum(length(text))::BIGINT AS n_chars FROM documents GROUP BY source),
b AS (SELECT source, count(*) FILTER (l <> '') AS n_lines, count(DISTINCT l) FILTER (l <> '') AS exact_lines FROM l GROUP BY source),
c AS (SELECT source, count(DISTINCT w) AS exact_words FROM w GROUP BY source)
SELECT source, n_texts, n_chars, n_lines, exact_lines, exact_words, true AS lines_near, true AS words_near FROM a JOIN b USING (source) JOIN c USING (source)""")
def sketches_by_source(spark: SparkSession, sf: str) -> DataFrame:
    told = sk.describe_sketches(_in_runs(spark, sf))
    docs = table(spark, sf, "documents")
    lines = docs.select("source", F.explode(tokens.lines("text")).alias("x")).select("source", rx.strip("x").alias("x")).where("x <> ''")
    words = docs.select("source", F.explode(F.array_remove(F.split("text", rx.SPACE + "+"), "")).alias("x"))
    exact = lines.groupBy("source").agg(F.count_distinct("x").alias("exact_lines")).join(
        words.groupBy("source").agg(F.count_distinct("x").alias("exact_words")), "source")
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 0.03 * F.col(b)
    return told.join(exact, "source").select(
        "source", "n_texts", "n_chars", "n_lines", "exact_lines", "exact_words",
        near("distinct_lines", "exact_lines").alias("lines_near"), near("vocabulary_size", "exact_words").alias("words_near"))


# All sources merged: half, nine tenths and so on of the texts are no longer than the estimates, within 2 %, and bins are as full as counted.
@query("""SELECT lower, upper, count(length) AS exact, true AS near, true AS quantiles_near FROM (VALUES (0, 500), (500, 1000), (1000, 2000), (2000, 4000), (4000, 1000000)) e(lower, upper)
LEFT JOIN (SELECT length(text) AS length FROM documents) ON length >= lower AND length < upper GROUP BY lower, upper""")
def sketch_length_histogram(spark: SparkSession, sf: str) -> DataFrame:
    edges = [0, 500, 1000, 2000, 4000, 1_000_000]
    merged = materialized(sk.merge_sketches(_in_runs(spark, sf)))
    lengths = materialized(table(spark, sf, "documents").select(F.length("text").alias("length")))
    total = F.col("all")
    told = sk.describe_sketches(merged).select(F.array("length_p50", "length_p90", "length_p99").alias("q"))
    shares = lengths.withColumn("q", told.select("q").scalar()).agg(*[
        F.avg((F.col("length") <= F.col("q")[i]).cast("int")).alias(f"s{i}") for i in range(3)])
    good = shares.select(
        F.greatest(F.abs(F.col("s0") - 0.5), F.abs(F.col("s1") - 0.9), F.abs(F.col("s2") - 0.99)).alias("worst"))
    place = F.element_at(F.array(*[F.lit(e) for e in edges]), F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= F.col("length"))))
    exact = lengths.groupBy(place.alias("low")).agg(F.count("*").alias("exact"))
    bins = sk.sketch_histogram(merged, edges).withColumn("all", lengths.agg(F.count("*").alias("n")).scalar())
    return bins.join(exact, bins.lower == exact.low, "left").select(
        "lower", "upper", F.coalesce("exact", F.lit(0)).alias("exact"),
        (F.abs(F.col("n") - F.coalesce("exact", F.lit(0))) <= 0.02 * total).alias("near"),
        (good.scalar() <= 0.02).alias("quantiles_near"))
