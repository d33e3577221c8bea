"""End-to-end jobs.  Each is one declarative plan plus its writes.

A job that ranks or splits its own output first writes it once
(:func:`materialized`), so that the counting passes read a key column instead
of extracting and cleaning again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import patterns as rx
from lexmill.functions.cleaning import clean_text, with_clean_text
from lexmill.functions.language import with_language
from lexmill.functions.metrics import with_text_metrics
from lexmill.functions.quality import with_issue_flags, with_quality
from lexmill.operators.extraction import pages_to_documents
from lexmill.operators.filters import keep_good_quality, min_length
from lexmill.operators.gates import clean_if_better, mean_analysis
from lexmill.operators.models import evaluate, load_model, predict, save_model, train_text_classifier
from lexmill.operators.reports import quality_report
from lexmill.operators.sampling import decode_labels, encode_labels, label_index, random_split, ratio_split
from lexmill.operators.scratch import materialized, settings
from lexmill.operators.vocabulary import (
    INLINE_WORDS,
    build_large_vocabulary,
    build_vocabulary,
    texts_to_sequences,
    texts_to_sequences_joined,
)
from lexmill.sources import sinks
from lexmill.sources.text import read_text_files
from lexmill.sources.warc import read_warc


def documents_of_pages(
    pages: DataFrame,
    content: str = "content",
    url: str = "url",
    content_type: str | None = "content_type",
    topics: list[str] | None = None,
    domains: list[str] | None = None,
    language: str | None = None,
    clean: bool = True,
    deep: bool = True,
    mode: str = "document",
    min_chars: int = 100,
) -> DataFrame:
    """Extract, filter by quality, clean and drop short documents (row-wise)."""
    docs = pages_to_documents(
        pages, content=content, url=url, content_type=content_type, topics=topics, domains=domains)
    docs = keep_good_quality(docs, "text", language)
    if clean:
        docs = with_clean_text(docs, "text", out="_cleaned", deep=deep, mode=mode)
        docs = docs.withColumn("text", F.col("_cleaned")).drop("_cleaned")
    return docs.where(F.length("text") > min_chars)


def build_dataset(
    pages: DataFrame, key: str = "page_id", ratio: float = 0.8, seed: int = 42, **options,
) -> DataFrame:
    """Documents of pages with an exact train/test split."""
    docs = materialized(documents_of_pages(pages, **options))
    return ratio_split(docs, key, ratio, seed)


def build_dataset_from_archives(
    spark: SparkSession, archives: str, output: str, ratio: float = 0.8, seed: int = 42,
    max_records: int | None = None, **options,
) -> DataFrame:
    """Archives -> documents -> split dataset and metadata on disk."""
    records = read_warc(spark, archives, max_records=max_records)
    records = records.withColumn("doc_key", F.concat_ws("#", "warc_file", "record_no"))
    dataset = build_dataset(records, "doc_key", ratio, seed, **options)
    sides = dataset.agg(F.count_distinct("split").alias("n")).first()["n"]
    if sides < 2:
        raise ValueError("not enough documents for a train and a test part")
    sinks.write_dataset(dataset, output, text="text")
    written = spark.read.parquet(f"{output}/data")
    sinks.write_metadata(
        written, f"{output}/metadata", split_ratio=ratio, seed=seed,
        cleaned=options.get("clean", True), deep_cleaned=options.get("deep", True))
    return written


def text_quality(df: DataFrame, text: str = "text", key: str = "id") -> DataFrame:
    """Text metrics per text with its identified language (row-wise)."""
    tagged = with_language(df.select(key, text), text, out="_lang")
    tagged = tagged.withColumn("language", F.col("_lang.language")).drop("_lang")
    return with_text_metrics(tagged, text, "language").drop(text)


#: Bytes that could be read while a file is opened; Spark's 4 MB would make a task of every few small files.
_OPEN_COST = str(32 << 10)


def text_folder_dataset(
    spark: SparkSession, folder: str, output: str, test_size: float = 0.2, min_chars: int = 100, seed: int = 42,
    recursive: bool = False,
) -> DataFrame:
    """Folder of text files -> quality metrics, split dataset, metadata and summary on disk.

    The files, which may be small and many, are opened once, hundreds of small ones by a task.
    """
    with settings(spark, open_cost=_OPEN_COST, drop_shuffles="true"):
        found = read_text_files(spark, folder, recursive=recursive).select("path", "filename", "text")
        files = materialized(found.repartition("path"))
    metrics = materialized(text_quality(files, key="path"))
    sinks.write_metrics_csv(metrics, f"{output}/text_quality_metrics")
    sinks.write_summary(metrics, f"{output}/summary")
    dataset = random_split(files.where(min_length("text", min_chars)), "path", test_size, seed)
    sinks.write_dataset(dataset, f"{output}/dataset", text="text")
    written = spark.read.parquet(f"{output}/dataset/data")
    sinks.write_metadata(written, f"{output}/metadata", test_size=test_size, seed=seed)
    return written


def analyse_corpus(df: DataFrame, text: str = "text", deep: bool = True) -> DataFrame:
    """Quality columns per document, with issue flags if ``deep`` (row-wise)."""
    scored = with_quality(df, text)
    return with_issue_flags(scored, text) if deep else scored


def corpus_quality_report(df: DataFrame, text: str = "text") -> DataFrame:
    return quality_report(with_quality(df, text))


@dataclass
class PreparedData:
    train: DataFrame
    test: DataFrame
    vocabulary: DataFrame


def prepare_sequences(
    split: DataFrame, key: str = "id", text: str = "text", max_vocabulary: int = 10_000, length: int = 100,
) -> PreparedData:
    """Vocabulary of the train part; index sequences of both parts."""
    train, test = (split.where(F.col("split") == side) for side in ("train", "test"))
    # The size that may be reached decides the way, so a growing corpus does not change it.
    large = max_vocabulary > INLINE_WORDS
    vocabulary = materialized((build_large_vocabulary if large else build_vocabulary)(train, text, max_vocabulary))
    sequences = texts_to_sequences_joined if large else texts_to_sequences
    return PreparedData(
        sequences(train, vocabulary, key, text, length), sequences(test, vocabulary, key, text, length), vocabulary)


@dataclass
class TrainedClassifier:
    model: PipelineModel
    labels: DataFrame
    evaluation: DataFrame


def majority_share(df: DataFrame, label: str = "label_idx") -> Column:
    """Share of the commonest label, which a constant answer would reach."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.agg((F.max("n") / F.sum("n")).alias("share")).scalar()


def train_on_clean_text(
    df: DataFrame, key: str = "id", text: str = "text", label: str = "label", threshold: float = 0.7,
    test_size: float = 0.2, seed: int = 42, output: str | None = None, **options,
) -> TrainedClassifier:
    """Quality-gated cleaning, split, label index, training and evaluation."""
    gated = clean_if_better(df.select(key, text, label), text, threshold)
    gated = materialized(gated.select(key, F.col("clean_text").alias(text), label))
    split = materialized(random_split(gated, key, test_size, seed))
    train, test = (split.where(F.col("split") == side) for side in ("train", "test"))
    labels = materialized(label_index(train, label))
    num_classes = labels.count()
    model = train_text_classifier(encode_labels(train, labels, label), num_classes, text=text, seed=seed, **options)
    scored = predict(model, encode_labels(test, labels, label, unseen="skip"))
    evaluation = materialized(evaluate(scored).withColumn("majority", majority_share(scored)))
    if output:
        save_model(model, f"{output}/model")
        labels.write.parquet(f"{output}/labels")
        evaluation.write.json(f"{output}/evaluation")
    return TrainedClassifier(model, labels, evaluation)


def predict_texts(df: DataFrame, model_path: str, labels_path: str, text: str = "text") -> DataFrame:
    """Add class, class_index, confidence and probabilities from a saved model and its label table."""
    spark = df.sparkSession
    scored = predict(load_model(model_path), df)
    return decode_labels(scored, spark.read.parquet(labels_path))


def clean_corpus_if_better(
    split: DataFrame, text: str = "text", threshold: float = 0.7, out: str = "clean_text", mode: str = "document",
) -> DataFrame:
    """One cleaning decision for a whole corpus, taken on its train part.

    If the mean score of the train part is under ``threshold``, train and test are
    cleaned, deeply unless the mean reductions say that basic cleaning does; all
    results are kept if the mean score of the train part rises, else none.  Adds ``out``
    and ``was_cleaned``.  The decisions are scalars of the plan; texts stay where they are.
    """
    train = split.where(F.col("split") == "train")
    before = materialized(mean_analysis(train, text, mode))
    deep = before.select(~F.col("basic_is_enough")).scalar()
    tried = F.when(deep, clean_text(text, True, mode)).otherwise(clean_text(text, False, mode))
    cleaned = materialized(rx.add_once(split, {"_cleaned": tried}))
    after = mean_analysis(cleaned.where(F.col("split") == "train"), "_cleaned", mode).select("score").scalar()
    score = before.select("score").scalar()
    better = F.coalesce((score < threshold) & (after > score), F.lit(False))
    judged = cleaned.withColumn("was_cleaned", better)
    return judged.withColumn(out, F.when(F.col("was_cleaned"), F.col("_cleaned")).otherwise(F.col(text))).drop("_cleaned")
