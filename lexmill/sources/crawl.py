"""Local snapshots of crawl catalogues and archive manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.sampling import hash_sample

# Fixed value: crawl used when the catalogue is empty.
FALLBACK_CRAWL = "CC-MAIN-2025-08"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Archive paths of a (gzipped) manifest: (archive)."""
    lines = spark.read.text(path).select(F.col("value").alias("archive"))
    return lines.where(F.col("archive").endswith(".warc.gz"))


def sample_archives(archives: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """At most ``k`` archives, the same on every run."""
    return hash_sample(archives, k, "archive", seed)


def read_crawls(spark: SparkSession, path: str) -> DataFrame:
    """Crawls of a JSON catalogue, newest first: (position, id)."""
    catalogue = spark.read.json(path, multiLine=True, schema="id string, name string")
    # A catalogue is one small JSON list; it is read as one record batch in file order.
    return catalogue.select(F.monotonically_increasing_id().alias("position"), "id")


def latest_crawl(crawls: DataFrame, fallback: str = FALLBACK_CRAWL) -> DataFrame:
    """One row: the newest crawl id, or the fallback for an empty catalogue."""
    return crawls.agg(F.coalesce(F.min_by("id", "position"), F.lit(fallback)).alias("id"))


def choose_crawl(crawls: DataFrame, requested: str | None = None, force_latest: bool = False) -> DataFrame:
    """One row: the requested crawl, or the newest if none is requested or it is forced."""
    if requested and not force_latest:
        return crawls.sparkSession.range(1).select(F.lit(requested).alias("id"))
    return latest_crawl(crawls)
