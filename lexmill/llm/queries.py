"""Registered queries of the operators, with SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import decontaminate, merkle, mixing, periodic_runs, pii, quality_classifier, quality_rules, secrets, simhash, suffixes, token_counts, url_filter, wrappers
from lexmill.llm import oracles

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = dict(oracles.SQL)


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@_query
def op1_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    judged = url_filter.filter_urls(_table(spark, sf, "pages"), url_filter.PRODUCTION_RULES, keep=["page_id"])
    return judged.select("page_id", "host", "path", "rule", "verdict")


@_query
def op2_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf, "documents").select("doc_id", "text"))


@_query
def op3_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = suffixes.find_repeats(_table(spark, sf, "documents").select("doc_id", "text"))
    places = F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string")))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.array_join(places, ",").alias("spans"),
        (F.col("n_removed") > 0).alias("changed"))


@_query
def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = token_counts.Vocabulary.from_file(token_counts.DEFAULT_VOCABULARY)
    docs = _table(spark, sf, "documents").select("doc_id", token_counts.token_counts("text", vocabulary).alias("n"))
    return docs.select("doc_id", "n.n_words", "n.n_tokens", "n.n_chars")


@_query
def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs, items = _table(spark, sf, "documents").select("doc_id", "text"), _table(spark, sf, "benchmark")
    found = decontaminate.find_contamination(docs, items, out="c").drop("text")
    return found.select(
        "doc_id", "c.n_words", "c.n_hit", "c.n_items", decontaminate.items_digest("c.items").alias("items_sha256"),
        "c.contaminated")


@_query
def op6_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", *secrets.secret_digests("secrets"))


@_query
def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.quality_verdicts(_table(spark, sf, "documents").select("doc_id", "source", "text"))


@_query
def op8_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return wrappers.extract_articles(_table(spark, sf, "pages"))


@_query
def op9_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_table(spark, sf, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


@_query
def op10_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", *pii.pii_digests("base", "spans"))


@_query
def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", periodic_runs.planted("doc_id", "text").alias("text"))
    found = periodic_runs.find_runs(docs, out="periodic")
    return found.select("doc_id", *periodic_runs.run_digests("periodic"))


@_query
def op12_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, _table(spark, sf, "labels"))
    scored = quality_classifier.add_quality(docs, model)
    return scored.select("doc_id", quality_classifier.held_out("doc_id").alias("held_out"), "score", "predicted")


@_query
def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return merkle.prove(docs, given=merkle.lower_case_tampering("doc_id", "text"))
