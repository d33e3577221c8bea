"""End-to-end jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sqltext as s
from checks.cleaning import noise_cte
from checks.metrics import _M
from checks.registry import ORACLES, as_long, pages, query, r6, table, texts
from lexmill.functions.metrics import TEXT_METRICS
from lexmill.functions.quality import INDICATORS, ISSUE_COLUMNS, with_quality
from lexmill.operators.extraction import pages_to_documents
from lexmill.operators.filters import keep_good_quality, min_length
from lexmill.operators.reports import quality_report
from lexmill.operators.sampling import random_split, ratio_split
from lexmill.operators.scratch import materialized, new_folder
from lexmill.plans import jobs
from lexmill.streaming.incremental import process_new_pages

_PAGES = f"""px AS (SELECT page_id, url, {s.html_text('html')} AS x FROM pages
  WHERE {s.found('html', '<!DOCTYPE' + chr(92) + 's+html|<html|<head|<body|<div|<p>|<a' + chr(92) + 's+href', 'i')}
    AND octet_length(encode(html)) >= 50),
pd AS (SELECT * FROM px WHERE length({s.strip('x')}) >= 11)"""


@query(f"""WITH {_PAGES}, {s.quality_cte('pd', 'page_id', 'x', 'en')},
k AS (SELECT key AS page_id, quality_score FROM (SELECT *, {s.FILTER_REASON} AS r FROM quality) WHERE r IS NULL),
sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42:' || page_id), page_id) <= floor(count(*) OVER () * 0.8)
  THEN 'train' ELSE 'test' END AS split FROM k)
SELECT split, count(*) AS n, round(avg(quality_score), 6) AS avg_score FROM sp GROUP BY split""")
def dataset_overview(spark: SparkSession, sf: str) -> DataFrame:
    docs = pages_to_documents(pages(spark, sf), content="html", content_type=None)
    kept = keep_good_quality(docs, language=F.lit("en"))
    scored = materialized(with_quality(kept, language=F.lit("en"), columns=["quality_score"]).select("page_id", "quality_score"))
    split = ratio_split(scored, "page_id")
    return split.groupBy("split").agg(F.count("*").alias("n"), F.round(F.avg("quality_score"), 6).alias("avg_score"))


@query(f"""WITH {_PAGES}, {s.quality_cte('pd', 'page_id', 'x')},
k AS (SELECT key AS page_id, text AS t FROM (SELECT *, {s.FILTER_REASON} AS r FROM quality) WHERE r IS NULL),
c AS (SELECT * FROM (SELECT page_id, {s.clean_deep('t')} AS text FROM k) WHERE length(text) > 100)
SELECT page_id, url, text, CASE WHEN row_number() OVER (ORDER BY md5('42:' || page_id), page_id) <= floor(count(*) OVER () * 0.8)
  THEN 'train' ELSE 'test' END AS split FROM c JOIN pages USING (page_id)""")
def build_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.build_dataset(pages(spark, sf), "page_id", content="html", content_type=None)


@query(f"""WITH {_PAGES}, {s.quality_cte('pd', 'page_id', 'x')},
k AS (SELECT key AS page_id, text AS t FROM (SELECT *, {s.FILTER_REASON} AS r FROM quality) WHERE r IS NULL)
SELECT page_id, url, text FROM (SELECT page_id, {s.clean_deep('t')} AS text FROM k) JOIN pages USING (page_id) WHERE length(text) > 100""")
def stream_equals_batch(spark: SparkSession, sf: str) -> DataFrame:
    base = new_folder(spark)
    web = pages(spark, sf)
    web.write.parquet(f"{base}/in")
    for _ in range(2):  # The second run finds nothing new.
        process_new_pages(
            spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", web.schema, content="html", content_type=None,
        ).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("page_id", "url", "text")


@query(f"""WITH {_M}, sp AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= count(*) OVER () - ceil(count(*) OVER () * 0.2) AS train
  FROM documents WHERE length(text) >= 100)
SELECT doc_id, language, length, {', '.join(f'round({m}, 6) AS {m}' for m in TEXT_METRICS[1:])},
  CASE WHEN train THEN 'train' ELSE 'test' END AS split FROM metrics JOIN sp USING (doc_id)""")
def text_dir_dataset(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf)
    metrics = jobs.text_quality(docs, key="doc_id")
    split = random_split(docs.where(min_length("text")).select("doc_id"), "doc_id")
    return metrics.join(split, "doc_id").select(
        "doc_id", "language", *as_long("length"), *[r6(m) for m in TEXT_METRICS[1:]], "split")


@query(f"""WITH {s.quality_cte('pages', 'page_id', 'html')}
SELECT key AS page_id, language, {', '.join(f'round({c}, 6) AS {c}' for c in INDICATORS)}, round(quality_score, 6) AS quality_score, quality_category
FROM quality""")
def analyse_pages(spark: SparkSession, sf: str) -> DataFrame:
    analysed = jobs.analyse_corpus(pages(spark, sf).select("page_id", "html"), "html", deep=False)
    return analysed.select("page_id", "language", *[r6(c) for c in INDICATORS], r6("quality_score"), "quality_category")


@query(f"""SELECT quality_category, {', '.join(ISSUE_COLUMNS)}, count(*) AS n
FROM ({ORACLES['quality_score']}) q JOIN ({ORACLES['issue_flags']}) i ON i.doc_id = q.doc_id GROUP BY ALL""")
def analyse_corpus_deep(spark: SparkSession, sf: str) -> DataFrame:
    analysed = jobs.analyse_corpus(texts(spark, sf))
    return analysed.groupBy("quality_category", *ISSUE_COLUMNS).agg(F.count("*").alias("n"))


@query(f"""WITH {s.quality_cte('conversations', "(conv_id * 100000 + turn)", 'text')}
SELECT coalesce(c, 'all') AS category, count(*) AS n, round(avg(quality_score), 6) AS avg_score
FROM (SELECT coalesce(quality_category, 'very_low') AS c, quality_score FROM quality) GROUP BY ROLLUP (c)""")
def conversation_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality_report(with_quality(
        table(spark, sf, "conversations").select("text"), columns=["quality_score", "quality_category"])).select(
        "category", "n", r6("avg_score"))


# A fifth of the labelled documents is held out.
@query("""SELECT ceil(count(*) * 0.2)::BIGINT AS n, true AS in_range, true AS better FROM labels JOIN documents USING (doc_id)""")
def train_on_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = texts(spark, sf).join(labels, "doc_id")
    trained = jobs.train_on_clean_text(docs, "doc_id", features=256, max_iter=15)
    return trained.evaluation.select(
        "n", (F.col("accuracy").between(0, 1) & (F.col("loss") >= 0)).alias("in_range"), (F.col("accuracy") > F.col("majority")).alias("better"))


# One decision for the whole corpus: clean train and test if the mean score of the train part rises.
@query(f"""WITH sp AS (SELECT doc_id, text, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= floor(count(*) OVER () * 0.8)
  THEN 'train' ELSE 'test' END AS split FROM documents),
{noise_cte('n', 'sp', 'doc_id', 'text', False)},
b AS (SELECT avg(score) AS before, avg(deep_reduction) - avg(regular_reduction) < 10 AND avg(regular_reduction) > 30 AS enough
  FROM n JOIN sp ON key = doc_id WHERE split = 'train'),
t AS (SELECT doc_id AS k, split, text, CASE WHEN enough THEN {s.clean_basic('text')} ELSE {s.clean_deep('text')} END AS c FROM sp, b),
{noise_cte('a', 't', 'k', 'c', False)},
g AS (SELECT before < 0.9 AND (SELECT avg(score) FROM a JOIN t ON key = k WHERE split = 'train') > before AS good FROM b)
SELECT split, count(*) AS n, good AS was_cleaned, sum(length(CASE WHEN good THEN c ELSE text END))::BIGINT AS chars FROM t, g GROUP BY split, good""")
def corpus_clean_gate(spark: SparkSession, sf: str) -> DataFrame:
    gated = jobs.clean_corpus_if_better(ratio_split(texts(spark, sf), "doc_id"), threshold=0.9)
    return gated.groupBy("split", "was_cleaned").agg(
        F.count("*").alias("n"), F.sum(F.length("clean_text")).alias("chars"))
