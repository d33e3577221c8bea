"""Incremental page processing: the batch transforms on streams of files and archives."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import LongType, StructType

from lexmill.plans.jobs import documents_of_pages
from lexmill.sources.warc import stream_warc

#: State store of keyed streams; it keeps its tables on disk, so keys need not fit in memory.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SKIP, REPLACE = "skip", "replace"


def stream_pages(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of page records under ``path`` as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def process_new_pages(
    spark: SparkSession,
    source: str,
    output: str,
    checkpoint: str,
    schema: StructType,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int | None = None,
    **options,
) -> StreamingQuery:
    """Process the files that arrived since the last run, then stop.

    The checkpoint remembers finished files and the Parquet sink commits whole
    batches, so a rerun or a restart after a failure adds nothing twice.  Every
    transform is row-wise, so batch and stream give the same documents.
    """
    pages = stream_pages(spark, source, schema, files_per_batch)
    docs = (transform or (lambda df: documents_of_pages(df, **options)))(pages)
    return (
        docs.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _versions(replace: bool, ttl_ms: int | None):
    """Per key: the state is the digest of the newest content and its version number."""

    def changed(key: tuple, batches: Iterator, state) -> Iterator:
        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        newest = None
        for batch in batches:
            for order, digest, page in zip(batch["_order"], batch["_digest"], batch["_page"], strict=True):
                if newest is None or (order > newest[0]) == replace:
                    newest = order, digest, page
        held = state.get if state.exists else None
        if held is None or replace and held[0] != newest[1]:
            version = 1 if held is None else held[1] + 1
            state.update((newest[1], version))
            yield pd.DataFrame({"_page": [newest[2]], "version": [version]})
        if ttl_ms:
            state.setTimeoutDuration(ttl_ms)

    return changed


def _newest_of_each(order: str, replace: bool):
    """Of the rows of a task's batch with one key the one that counts, so that a page sent very often is no hot task."""

    def newest(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keys, orders, kept = batch.column("_key").to_pylist(), batch.column(order).to_pylist(), {}
            for i, key in enumerate(keys):
                j = kept.get(key)
                if j is None or (orders[i] > orders[j]) == replace:
                    kept[key] = i
            yield batch.take(pa.array(sorted(kept.values()), pa.int64()))

    return newest


def keep_new_pages(
    pages: DataFrame, key: str = "url", order: Sequence[str] = ("warc_file", "record_no"), content: str = "content",
    on_repeat: str = SKIP, ttl_ms: int | None = None,
) -> DataFrame:
    """Pages of a stream that are new by their key, with a column ``version``.

    A key that comes again is passed over (``skip``), or passed on with the next version
    number if its content differs from the newest known (``replace``); of rows of one
    batch with one key the first or the newest by ``order`` counts.  Rows with a null key are
    always passed on, as version 1.  What is kept of a key is a digest and a number, until
    it has not been met for ``ttl_ms`` milliseconds if given, else for ever; see ``use_keyed_state``.
    """
    if on_repeat not in (SKIP, REPLACE):
        raise ValueError(f"on_repeat must be {SKIP!r} or {REPLACE!r}, not {on_repeat!r}")
    replace, columns = on_repeat == REPLACE, [F.col(f"`{c}`") for c in pages.columns]
    # Numbers are padded, so that texts sort like them.
    place = F.to_json(F.struct(*[
        (F.lpad(F.col(c).cast("string"), 20, "0") if pages.schema[c].dataType.typeName() in ("integer", "long") else F.col(c).cast("string")).alias(f"o{i}")
        for i, c in enumerate(order)]), {"ignoreNullFields": "false"})
    keyed = pages.where(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").cast("string").alias("_key"), place.alias("_order"),
        F.sha2(F.coalesce(F.col(f"`{content}`").cast("binary"), F.lit(b"")), 256).alias("_digest"), F.struct(*columns).alias("_page"))
    once = keyed.mapInArrow(_newest_of_each("_order", replace), keyed.schema)
    out = StructType().add("_page", pages.schema).add("version", LongType())
    timeout = GroupStateTimeout.ProcessingTimeTimeout if ttl_ms else GroupStateTimeout.NoTimeout
    new = once.groupBy("_key").applyInPandasWithState(_versions(replace, ttl_ms), out, "digest string, version long", "append", timeout)
    known = new.select("_page.*", "version")
    return known.union(pages.where(F.col(f"`{key}`").isNull()).withColumn("version", F.lit(1).cast("long")))


def use_keyed_state(spark: SparkSession) -> None:
    """Choose the state store that fits many keys; a stream that has begun keeps its own."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def newest_versions(pages: DataFrame, key: str = "url") -> DataFrame:
    """Of each key the row with the highest version; rows with a null key all stay."""
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns])
    named = pages.where(F.col(f"`{key}`").isNotNull())
    newest = named.groupBy(F.col(f"`{key}`").alias("_k")).agg(F.max_by(row, "version").alias("_row")).select("_row.*")
    return newest.union(pages.where(F.col(f"`{key}`").isNull()))


def process_new_archives(
    spark: SparkSession, source: str, output: str, checkpoint: str, key: str | None = "url", on_repeat: str = SKIP,
    transform: Callable[[DataFrame], DataFrame] | None = None, files_per_batch: int | None = None, ttl_ms: int | None = None,
    pattern: str = "*", recursive: bool = False,
) -> StreamingQuery:
    """Process the archives that arrived since the last run, then stop; Parquet files go to ``output``.

    With ``key`` a page that comes again is skipped or replaced, see ``keep_new_pages``; ``transform``
    is applied to what is left.  A restart after a failure adds nothing twice.
    """
    pages = stream_warc(spark, source, pattern, recursive, files_per_batch)
    if key is not None:
        use_keyed_state(spark)
        pages = keep_new_pages(pages, key, on_repeat=on_repeat, ttl_ms=ttl_ms)
    docs = transform(pages) if transform else pages
    return (
        docs.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start())
