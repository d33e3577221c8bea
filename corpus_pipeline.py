"""The training corpus, stage by stage: quality, near-duplicates, benchmarks, secrets, mixture.

Each stage takes ``documents`` (doc_id, text, lang, source, n_chars and any others, whatever their
names) and reads whole texts, however long.  Null and empty texts fail the quality rules; the other
stages would keep one of them, find nothing in them and give them size 0.  Null sources are one
source and null keys are told apart by the text; repeated rows are judged alike, and one of
them is left by the second stage; ties fall to the smallest key or its hash; an empty table
gives no rows.  All stages but the last return the columns that they get.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import decontaminate, mixing, quality_rules, secrets, simhash
from lexmill.operators.scratch import drop_scratch, materialized, scratch_folders


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go; the others stay as they are."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that SimHash links, with the shingles and bits of its contract, the smallest id stays."""
    return simhash.keep_one(docs, shingle_words=simhash.SHINGLE_WORDS, max_bits=simhash.MAX_BITS)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; no document goes.  ``n_chars`` follows the text."""
    return secrets.redact_secrets(docs, length="n_chars")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, with size, source_size, target, taken and position."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality),
    ("near-dedup", near_duplicates),
    ("benchmark decontamination", benchmarks),
    ("secret scans", secret_scan),
    ("source mixing", mixture),
]

#: SQL has neither the hash of the fingerprints nor an automaton; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again.

    What a stage has written meanwhile goes as soon as its result is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = scratch_folders()
    for _, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir))
        drop_scratch(spark, since=before, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)
