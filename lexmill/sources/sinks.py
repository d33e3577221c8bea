"""Writers: document text, datasets, metadata, metrics, catalogues.

Every output is replaced as a whole: it is written beside its place and moved there when all
tasks have ended.  A repeated run leaves the same rows, and a failed one leaves what was there.
"""

from __future__ import annotations

import urllib.parse
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.ranking import join_on, with_ordered_rank
from lexmill.operators.scratch import materialized
from lexmill.sources.text import DOCUMENT_RULER
from lexmill.sources.warc import _filesystem


def replace_output(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a folder beside ``path``, and put it there once that has succeeded.

    Readers see the former output until then.  If ``write`` fails, its folder goes.  Moves
    are made by the file system that holds ``path``.
    """
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path
    target = folder(path.rstrip("/"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    mark = uuid.uuid4().hex
    # Names that begin with an underscore are passed over by readers of the parent.
    new, old = (folder(target.getParent(), f"_{kind}-{mark}") for kind in ("writing", "former"))
    try:
        write(new.toString())
    except BaseException:
        fs.delete(new, True)
        raise
    if not fs.exists(new):
        return
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move the former output of {path}")
    if not fs.rename(new, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot move the output to {path}")
    if had:
        fs.delete(old, True)


def document_block(number: Column, text: Column) -> Column:
    """``# Document N``, the text and a ruler, each followed by a blank line."""
    return F.concat(
        F.lit("# Document "), number.cast("string"), F.lit("\n\n"), text, F.lit("\n\n" + DOCUMENT_RULER + "\n"))


def archive_stem(path: Column) -> Column:
    """File name without folder and archive extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.warc(\.gz)?$", "")


def numbered_documents(
    df: DataFrame, source: str = "warc_file", order: str = "record_no", text: str = "text",
    max_records: int | None = None,
) -> DataFrame:
    """(output, number, block): documents numbered from 1 inside their source file.

    Numbers come from the overall rank minus the first rank of the source, so
    one very large source does not end up in one task.
    """
    ranked = with_ordered_rank(df.select(source, order, text), [source, order], "_rank")
    first = ranked.groupBy(source).agg(F.min("_rank").alias("_first"))
    suffix = f"_sample{max_records}" if max_records else ""
    numbered = join_on(ranked, first, [source]).withColumn("number", F.col("_rank") - F.col("_first") + 1)
    return numbered.select(
        F.concat(archive_stem(F.col(source)), F.lit(suffix)).alias("output"),
        "number",
        document_block(F.col("number"), F.col(text)).alias("block"),
    )


def write_document_text(df: DataFrame, path: str, max_records: int | None = None, **columns: str) -> None:
    """Write numbered documents as text, one folder ``output=<source>`` per source file."""
    docs = numbered_documents(df, max_records=max_records, **columns)
    ordered = docs.repartitionByRange("output", "number").sortWithinPartitions("output", "number")
    texts = ordered.select("output", F.col("block").alias("value"))
    replace_output(df.sparkSession, path, lambda p: texts.write.partitionBy("output").text(p))


#: Folders over which the files of ``write_text_files`` are dealt.
TEXT_FOLDERS = 1024


def _write_files(path: str):
    def files(batches: Iterator) -> Iterator:
        import pyarrow as pa

        filesystem, root = _filesystem(path)
        made, out, name, n = set(), None, None, 0
        for batch in batches:
            for folder, this, line in zip(*(batch.column(c).to_pylist() for c in ("folder", "name", "line")), strict=True):
                if folder not in made:
                    filesystem.create_dir(f"{root}/{folder:04d}", recursive=True)
                    made.add(folder)
                if out is None or this != name:
                    if out is not None:
                        out.close()
                    name, n = this, n + 1
                    out = filesystem.open_output_stream(f"{root}/{folder:04d}/{urllib.parse.quote(str(name), safe='=')}.txt")
                out.write((line or "").encode() + b"\n")
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return files


def write_text_files(df: DataFrame, path: str, name: str, text: str) -> None:
    """One file ``<folder>/<name>.txt`` for each name, whose lines are the texts of its rows.

    Names are dealt over ``TEXT_FOLDERS`` folders, so no folder has all files.  Tasks write the
    files themselves, one after the other: many small files cost little more than their bytes.
    """
    rows = df.select(F.col(name).cast("string").alias("name"), F.col(text).alias("line"))
    dealt = rows.withColumn("folder", F.pmod(F.xxhash64("name"), F.lit(TEXT_FOLDERS)).cast("int")).repartition("folder")
    ordered = dealt.sortWithinPartitions("folder", "name")
    replace_output(df.sparkSession, path, lambda p: ordered.mapInArrow(_write_files(p), "n long").agg(F.sum("n")).collect())


def write_dataset(df: DataFrame, path: str, text: str | None = None, split: str = "split") -> None:
    """Write a split dataset as Parquet, and its texts as readable blocks."""

    def write(folder: str) -> None:
        df.write.partitionBy(split).parquet(f"{folder}/data")
        if text:
            # Read back what was written, so the plan of the dataset runs once.
            written = df.sparkSession.read.parquet(f"{folder}/data")
            sample = F.concat(F.lit("--- Sample ---\n"), F.col(text), F.lit("\n"))
            written.select(split, sample.alias("value")).write.partitionBy(split).text(f"{folder}/text")

    replace_output(df.sparkSession, path, write)


def dataset_counts(df: DataFrame, split: str = "split") -> DataFrame:
    """One row: total, train and test documents."""
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(split) == "train").alias("train"),
        F.count_if(F.col(split) == "test").alias("test"),
    )


def write_metadata(df: DataFrame, path: str, split: str = "split", **parameters: object) -> None:
    """One JSON row: counts, parameters and the time of writing."""
    fixed = [F.lit(v).alias(k) for k, v in parameters.items() if v is not None]
    row = dataset_counts(df, split).select("*", *fixed, F.current_timestamp().alias("created_at"))
    replace_output(df.sparkSession, path, row.write.json)


def write_metrics_csv(metrics: DataFrame, path: str) -> None:
    replace_output(metrics.sparkSession, path, lambda p: metrics.write.csv(p, header=True))


def write_summary(metrics: DataFrame, path: str, language: str = "language", length: str = "length") -> None:
    """One JSON row: texts, texts per language and mean length."""
    replace_output(metrics.sparkSession, path, summary(metrics, language, length).write.json)


def summary(metrics: DataFrame, language: str = "language", length: str = "length") -> DataFrame:
    per_language = metrics.groupBy(language).agg(F.count("*").alias("n"), F.sum(length).alias("chars"))
    # One row per language from here on.
    return per_language.agg(
        F.sum("n").alias("total_texts"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.coalesce(language, F.lit("unknown")), "n")))).alias("languages"),
        (F.sum("chars") / F.sum("n")).alias("avg_text_length"),
    )


def write_catalogue(processed: DataFrame, path: str, name: str = "name", run: str | None = None) -> None:
    """Add the names of processed inputs, one per line, for later incremental runs.

    Each run has a folder of its own, named ``run`` or else by a digest of its names, so a
    repeated run replaces what it has written before.
    """
    names = materialized(processed.select(F.col(name).cast("string").alias("value")).distinct())
    if run is None:
        total = names.agg(F.sum(F.xxhash64("value").cast("decimal(38,0)")), F.count("*")).first()
        run = f"{total[0] or 0}-{total[1]}"
    replace_output(names.sparkSession, f"{path.rstrip('/')}/run={run}", names.write.text)


def read_catalogue(spark: SparkSession, path: str, name: str = "name") -> DataFrame:
    return spark.read.text(path, recursiveFileLookup=True).select(F.col("value").alias(name)).distinct()


def not_yet_processed(inputs: DataFrame, done: DataFrame, on: str | list[str], force: bool = False) -> DataFrame:
    """Inputs without an output; all of them if processing is forced."""
    return inputs if force else inputs.join(done, on, "left_anti")


def write_clean_corpus(df: DataFrame, path: str, source: str, text: str = "clean_text") -> None:
    """Cleaned texts, one folder ``source=<input>`` for each input file or source.

    Rows are dealt out by source first, so a source has a few files however many
    tasks cleaned it, and a large one is still split.
    """
    texts = df.select(F.col(source).alias("source"), F.col(text).alias("value"))
    dealt = texts.repartitionByRange("source", F.xxhash64("value")).sortWithinPartitions("source")
    replace_output(df.sparkSession, path, lambda p: dealt.write.partitionBy("source").text(p))


