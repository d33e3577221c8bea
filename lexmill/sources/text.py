"""Text readers: whole files, delimited documents, lines and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import patterns as rx
from lexmill.operators.ranking import with_ordered_rank

DOCUMENT_RULER = "-" * 80
LABEL_RULE = r"_class_(\d+)(?:_|\.|$)"


def read_text_files(spark: SparkSession, path: str, pattern: str = "*.txt", recursive: bool = False) -> DataFrame:
    """One row per file: (filename, path, text); invalid UTF-8 becomes U+FFFD."""
    files = spark.read.text(
        path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=recursive)
    return files.select(
        F.col("_metadata.file_name").alias("filename"),
        F.col("_metadata.file_path").alias("path"),
        F.make_valid_utf8("value").alias("text"),
    )


def split_documents(text: Column | str, min_length: int = 100) -> Column:
    """Documents of a text with ruler lines: stripped, longer than ``min_length``."""
    parts = F.transform(F.split(rx.as_col(text), DOCUMENT_RULER), rx.strip)
    return F.filter(parts, lambda x: F.length(x) > min_length)


def read_delimited_documents(spark: SparkSession, path: str, min_length: int = 100) -> DataFrame:
    """Documents between rulers of 80 dashes; Spark splits large files at the rulers."""
    docs = spark.read.text(path, lineSep=DOCUMENT_RULER)
    docs = docs.select(
        F.col("_metadata.file_name").alias("filename"), F.col("_metadata.file_path").alias("path"),
        rx.strip(F.make_valid_utf8("value")).alias("text"))
    return docs.where(F.length("text") > min_length)


def read_lines(spark: SparkSession, path: str, overall: bool = False) -> DataFrame:
    """One item per non-blank stripped line: (filename, line_no, text), numbered from 0 per file.

    With ``overall`` the numbers go on from file to file, in the order of their paths.
    Lines are numbered without a sort: consecutive ids inside a file block,
    plus the number of items in the blocks before it.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("filename"),
        F.col("_metadata.file_block_start").alias("_block"),
        rx.strip(F.make_valid_utf8("value")).alias("text"),
    ).where(F.col("text") != "").withColumn("_id", F.monotonically_increasing_id())
    blocks = raw.groupBy("_path", "_block").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    # One row per file block (128 MB by default).
    order = Window.partitionBy(F.lit(0)).orderBy("_path", "_block") if overall else Window.partitionBy("_path").orderBy("_block")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = blocks.select("_path", "_block", "_first", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"))
    numbered = raw.join(starts, ["_path", "_block"])
    return numbered.select(
        "filename", (F.col("_id") - F.col("_first") + F.col("_before")).alias("line_no"), "text")


def split_label(value: Column | str) -> list[Column]:
    """``label<TAB>text`` -> label, text and a flag for lines without a tab."""
    v = rx.as_col(value)
    has_tab = v.contains("\t")
    parts = F.split(v, "\t", 2)
    return [
        F.when(has_tab, F.get(parts, F.lit(0))).alias("label"),
        F.when(has_tab, F.get(parts, F.lit(1))).alias("text"),
        (~has_tab).alias("malformed"),
    ]


def integer_label(label: Column | str) -> Column:
    """Label as long where it is all digits, else null."""
    c = rx.as_col(label)
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("long"))


def read_labelled_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, label, text, malformed) of a ``label<TAB>text`` file.

    Lines without a tab are flagged, so label and text never get out of step.
    """
    items = read_lines(spark, path)
    return items.select("line_no", *split_label("text"))


def zip_by_position(texts: DataFrame, labels: DataFrame, on: str = "line_no") -> DataFrame:
    """Texts with the labels of the same position; where one side has no such position its columns are null."""
    return texts.join(labels, on, "full")


def read_texts_with_label_file(spark: SparkSession, text_path: str, label_path: str) -> DataFrame:
    """(line_no, text, label): items and labels in the order of their files, aligned by number.

    Both sides may be several files, cut at different places.  Surplus items have a null
    label and surplus labels a null text; no item is null otherwise.
    """
    texts = read_lines(spark, text_path, overall=True).select("line_no", "text")
    labels = read_lines(spark, label_path, overall=True).select("line_no", F.col("text").alias("label"))
    return zip_by_position(texts, labels)


def directory_label(filename: Column, parent: Column, root_name: str, position: Column) -> Column:
    """Label of a file: ``_class_N_`` in its name, else its folder, else its position."""
    from_name = F.regexp_extract(filename, LABEL_RULE, 1).try_cast("long")
    from_folder = F.when(
        (parent != root_name) & ~filename.contains("_class_"), F.pmod(F.xxhash64(parent), F.lit(2)))
    return F.coalesce(from_name, from_folder, F.pmod(position, F.lit(2)))


def _text_files_of(spark: SparkSession, root: str) -> tuple[str, bool] | None:
    """The pattern of the text files of a folder and whether to look below it: the first kind that has any; one listing."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(root)
    qualified = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(jvm_path).toString()
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    kinds = [(ext, deep) for ext in (".txt", ".text", ".md", ".csv", ".json") for deep in (False, True)]
    top = F.regexp_replace("path", "/[^/]*$", "") == qualified
    found = listed.agg(*[F.count_if(F.col("path").endswith(ext) & (F.lit(deep) | top)).alias(f"n{i}") for i, (ext, deep) in enumerate(kinds)]).first()
    return next(((f"*{ext}", deep) for (ext, deep), n in zip(kinds, found, strict=True) if n), None)


def read_labelled_directory(spark: SparkSession, path: str) -> DataFrame:
    """(filename, text, label) of the text files of a folder.

    Looks for ``*.txt`` in the folder, then below it, then for other text
    extensions; blank files are left out.
    """
    chosen = _text_files_of(spark, path)
    if chosen is None:
        raise ValueError(f"no text files under {path}")
    files = read_text_files(spark, path, *chosen).where(rx.strip(F.col("text")) != "")
    root_name = path.rstrip("/").rsplit("/", 1)[-1]
    parent = F.element_at(F.split("path", "/"), -2)
    ranked = with_ordered_rank(files, ["path"], "_rank")
    return ranked.select(
        "filename", "text", directory_label(F.col("filename"), parent, root_name, F.col("_rank") - 1).alias("label"))


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A saved dataset with its ``split`` column."""
    return spark.read.parquet(path)


def concat_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    """One frame of an already split dataset."""
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
