"""Pages: recognition, extraction, topics, decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import sqltext as s
from checks.registry import pages, query, r6, table
from lexmill.functions.html import html_to_text, is_probably_html, matches_topics
from lexmill.functions.quality import INDICATORS, with_quality
from lexmill.operators.extraction import (
    extraction_report,
    pages_to_documents,
    with_extracted_text,
)
from lexmill.operators.scratch import materialized, new_folder
from lexmill.operators.topics import match_topic_table, with_topics
from lexmill.sources.warc import read_warc, write_warc
from lexmill.streaming.incremental import REPLACE, newest_versions, process_new_archives

TOPICS, DOMAINS = ["Ereau", "with the"], ["Example.ORG"]


@query(f"SELECT page_id, {s.found('html', '<!DOCTYPE' + chr(92) + 's+html|<html|<head|<body|<div|<p>|<a' + chr(92) + 's+href', 'i')} AS is_html FROM pages")
def html_sniff(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).select("page_id", is_probably_html("html").alias("is_html"))


@query(f"SELECT page_id, {s.html_text('html')} AS text FROM pages")
def html_to_text_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).select("page_id", html_to_text("html").alias("text"))


@query(f"""SELECT page_id, contains(lower(url), 'example.org') OR contains(lower(x), 'ereau') OR contains(lower(x), 'with the') AS matched
FROM (SELECT page_id, url, {s.html_text('html')} AS x FROM pages)""")
def topic_domain_match(spark: SparkSession, sf: str) -> DataFrame:
    web = pages(spark, sf).select("page_id", "url", html_to_text("html").alias("text"))
    return web.select("page_id", matches_topics("text", "url", TOPICS, DOMAINS).alias("matched"))


_OUTCOME = f"""SELECT page_id, url, x AS text, CASE
    WHEN octet_length(encode(html)) < 50 THEN 'too_small'
    WHEN NOT {s.found('html', '<!DOCTYPE' + chr(92) + 's+html|<html|<head|<body|<div|<p>|<a' + chr(92) + 's+href', 'i')} THEN 'not_html'
    WHEN NOT length({s.strip('x')}) > 10 THEN 'length'
    WHEN NOT (contains(lower(url), 'example.org') OR contains(lower(x), 'ereau') OR contains(lower(x), 'with the')) THEN 'off_topic'
    ELSE 'extracted' END AS outcome
  FROM (SELECT *, {s.html_text('html')} AS x FROM pages)"""


@query(f"SELECT outcome, count(*) AS n FROM ({_OUTCOME}) GROUP BY outcome")
def page_extract_report(spark: SparkSession, sf: str) -> DataFrame:
    extracted = with_extracted_text(
        pages(spark, sf), content="html", content_type=None, topics=TOPICS, domains=DOMAINS)
    return extraction_report(extracted)


@query(f"SELECT page_id, url, text FROM ({_OUTCOME}) WHERE outcome = 'extracted'")
def page_documents(spark: SparkSession, sf: str) -> DataFrame:
    return pages_to_documents(
        pages(spark, sf), content="html", content_type=None, topics=TOPICS, domains=DOMAINS)


# Payloads in two encodings, with the charset in the header or not at all.
_PAYLOAD = """CASE page_id % 2 WHEN 1 THEN regexp_replace(html, '[^\\x00-\\xFF]', '?', 'g') ELSE html END"""


@query(f"SELECT page_id, {s.html_text('p')} AS text FROM (SELECT page_id, {_PAYLOAD} AS p FROM pages)")
def decoded_payloads(spark: SparkSession, sf: str) -> DataFrame:
    latin1 = F.col("page_id") % 2 == 1
    records = pages(spark, sf).select(
        "page_id", "url",
        F.when(latin1, F.lit('text/html; charset="iso-8859-1"')).otherwise(F.lit("text/html")).alias("content_type"),
        F.when(latin1, F.encode(F.regexp_replace("html", r"[^\x00-\xFF]", "?"), "ISO-8859-1"))
        .otherwise(F.encode("html", "UTF-8")).alias("content"),
    )
    return pages_to_documents(records).select("page_id", "text")


# The charset in the meta tag alone, and payloads that are no text by their media type.
@query(f"""SELECT page_id, {s.html_text('p')} AS text FROM (SELECT page_id, regexp_replace(html, '[^\\x00-\\xFF]', '?', 'g') AS p FROM pages WHERE page_id % 3 <> 0)""")
def decoded_by_meta_tag(spark: SparkSession, sf: str) -> DataFrame:
    latin = F.regexp_replace(F.regexp_replace("html", r"[^\x00-\xFF]", "?"), '<meta charset="utf-8">', '<meta charset="iso-8859-1">')
    records = pages(spark, sf).select(
        "page_id", "url", F.when(F.col("page_id") % 3 == 0, "image/png").otherwise("text/html").alias("content_type"),
        F.encode(latin, "ISO-8859-1").alias("content"))
    return pages_to_documents(records).select("page_id", "text")


def _write_archives(df: DataFrame, folder: str) -> None:
    """Write (url, html) as gzipped archives: a request, a response and a damaged record for each row.

    Spark writes the files, so they lie where all executors see them; only their names change.
    """
    def record(kind: str, block, length=None):
        size = F.octet_length(block).cast("string") if length is None else F.lit(length)
        return F.concat(
            F.lit(f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: "), "url", F.lit("\r\nContent-Length: "), size,
            F.lit("\r\n\r\n"), block, F.lit("\r\n\r\n"))

    page = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"), "html")
    parts = [record("request", F.lit("GET / HTTP/1.1\r\n\r\n")), record("response", page), record("response", F.lit("damaged"), "x")]
    df.select(F.concat(*parts)).write.option("compression", "gzip").text(folder)
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(path(folder)):
        name = status.getPath().getName()
        if name.endswith(".txt.gz"):
            fs.rename(status.getPath(), path(f"{folder}/{name.removesuffix('.txt.gz')}.warc.gz"))


# The pages as archives and back: damaged records are passed over.
@query("SELECT url, 'text/html; charset=utf-8' AS content_type, html AS text FROM pages")
def warc_pages(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    _write_archives(pages(spark, sf).select("url", "html"), folder)
    return read_warc(spark, folder).select("url", "content_type", F.col("content").cast("string").alias("text"))


@query("SELECT 'bad content length: x' AS error, count(*) AS n FROM pages")
def warc_errors(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    _write_archives(pages(spark, sf).select("url", "html"), folder)
    records = read_warc(spark, folder, errors=True)
    return records.where("error is not null").groupBy("error").agg(F.count("*").alias("n"))


# Archives of members, each with a range of the pages, read in ranges by several tasks: the same records, numbered on from archive to archive.
@query("SELECT url, html AS text, true AS several, row_number() OVER (ORDER BY page_id) AS record_no FROM pages")
def warc_ranges(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    web = pages(spark, sf)
    write_warc(web.repartitionByRange("page_id").sortWithinPartitions("page_id"), folder, content="html")
    records = read_warc(spark, folder, split_bytes=200_000).withColumn("task", F.spark_partition_id())
    counted = materialized(records.groupBy("warc_file", "task").agg(F.count("*").alias("n")))
    tasks = counted.agg((F.count_distinct("task") > 1).alias("b")).select("b").scalar()
    # One row for each archive from here on; their names are in the order of the ranges.
    sizes = counted.groupBy("warc_file").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(F.lit(0)).orderBy("warc_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("warc_file", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    numbered = records.join(F.broadcast(starts), "warc_file")
    return numbered.select("url", F.col("content").cast("string").alias("text"), tasks.alias("several"), (F.col("before") + F.col("record_no")).alias("record_no"))


# Archives arrive in two parts; the stream processes each once.
@query("SELECT url, html AS text FROM pages")
def warc_stream(spark: SparkSession, sf: str) -> DataFrame:
    base = new_folder(spark)
    for part in range(2):
        _write_archives(pages(spark, sf).where(F.col("page_id") % 2 == part).select("url", "html"), f"{base}/in/{part}")
        for _ in range(2):  # The second run of each finds nothing new.
            process_new_archives(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", key=None, recursive=True).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("url", F.col("content").cast("string").alias("text"))


def _resent(spark: SparkSession, sf: str, on_repeat: str) -> DataFrame:
    """Two thirds of the pages; then all of them, a quarter changed; then half of them again as they were at first."""
    base, web = new_folder(spark), pages(spark, sf)
    changed = web.withColumn("html", F.when(F.col("page_id") % 4 == 0, F.concat("html", F.lit(" changed"))).otherwise(F.col("html")))
    for n, part in enumerate([web.where("page_id % 3 <> 0"), changed, web.where("page_id % 2 = 0")]):
        _write_archives(part.select("url", "html"), f"{base}/in/{n}")
        process_new_archives(
            spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", on_repeat=on_repeat, recursive=True).awaitTermination()
    return spark.read.parquet(f"{base}/out")


# Sent again, a page is passed over.
@query("SELECT url, html || CASE WHEN page_id % 3 = 0 AND page_id % 4 = 0 THEN ' changed' ELSE '' END AS text, 1::BIGINT AS version FROM pages")
def warc_stream_skip(spark: SparkSession, sf: str) -> DataFrame:
    return _resent(spark, sf, "skip").select("url", F.col("content").cast("string").alias("text"), "version")


# Sent again with other content, a page is replaced, also by what it was before.
@query("""SELECT url, html AS text, CASE WHEN page_id % 4 <> 0 THEN 1 WHEN page_id % 3 <> 0 THEN 3 ELSE 2 END::BIGINT AS version FROM pages""")
def warc_stream_replace(spark: SparkSession, sf: str) -> DataFrame:
    kept = newest_versions(_resent(spark, sf, REPLACE))
    return kept.select("url", F.col("content").cast("string").alias("text"), "version")


@query(f"""WITH topics AS (SELECT DISTINCT regexp_extract(lower(text), '[a-z]{{7,}}') AS topic FROM benchmark),
x AS (SELECT page_id, lower({s.html_text('html')}) AS t FROM pages)
SELECT page_id FROM x WHERE EXISTS (SELECT 1 FROM topics WHERE topic <> '' AND contains(t, topic))""")
def topic_table_match(spark: SparkSession, sf: str) -> DataFrame:
    topics = table(spark, sf, "benchmark").select(
        F.regexp_extract(F.lower("text"), "[a-z]{7,}", 0).alias("topic"))
    web = pages(spark, sf).select("page_id", html_to_text("html").alias("text"))
    return match_topic_table(web, topics).select("page_id")


# Every word of seven letters or more of the benchmark, with nulls and repeated rows in both tables.
@query(f"""WITH topics AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{{7,}}')) AS topic FROM benchmark),
x AS (SELECT page_id, lower({s.html_text('html')}) AS t FROM pages),
hit AS (SELECT page_id FROM x WHERE EXISTS (SELECT 1 FROM topics WHERE contains(t, topic)))
SELECT CASE WHEN page_id % 7 <> 0 THEN page_id END AS page_id, copy FROM hit, range(2) AS r(copy)""")
def topic_table_match_many(spark: SparkSession, sf: str) -> DataFrame:
    words = table(spark, sf, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{7,}"), F.lit(0))).alias("topic"))
    topics = words.union(words).union(words.select(F.lit(None).cast("string")))
    web = pages(spark, sf).select(
        F.when(F.col("page_id") % 7 != 0, F.col("page_id")).alias("page_id"), html_to_text("html").alias("text"),
        F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("copy"))
    return match_topic_table(web, topics).select("page_id", "copy")


# All pairs of words of the documents as topics, over 100,000 at sf0.01: a page has one if it has two runs of letters
# with a blank between them, of which the first ends and the second begins like the topic's words.
_PAIRS = f"""topics AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+ [a-z]+')) AS topic FROM documents),
x AS (SELECT page_id, string_split(lower({s.html_text('html')}), ' ') AS w FROM pages),
n AS (SELECT page_id, regexp_extract(p, '[a-z]+$') AS l, regexp_extract(q, '^[a-z]+') AS r FROM (
 SELECT page_id, unnest(w[:-2]) AS p, unnest(w[2:]) AS q FROM x)),
hit AS (SELECT DISTINCT page_id, topic FROM (
 SELECT page_id, right(l, i) || ' ' || left(r, j) AS topic FROM (SELECT DISTINCT * FROM n WHERE l <> '' AND r <> ''), range(1, 40) a(i), range(1, 40) b(j)
 WHERE i <= length(l) AND j <= length(r)) JOIN topics USING (topic))"""


def _word_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+ [a-z]+"), F.lit(0))).alias("topic"))


@query(f"WITH {_PAIRS} SELECT page_id FROM hit GROUP BY page_id")
def topic_table_match_large(spark: SparkSession, sf: str) -> DataFrame:
    web = pages(spark, sf).select("page_id", html_to_text("html").alias("text"))
    return match_topic_table(web, _word_pairs(spark, sf)).select("page_id")


@query(f"""WITH {_PAIRS} SELECT page_id, count(topic) AS n_topics, coalesce(string_agg(topic, ',' ORDER BY topic), '') AS topics
FROM pages LEFT JOIN hit USING (page_id) GROUP BY page_id""")
def topics_per_page(spark: SparkSession, sf: str) -> DataFrame:
    web = pages(spark, sf).select("page_id", html_to_text("html").alias("text"))
    found = with_topics(web, _word_pairs(spark, sf))
    return found.select("page_id", F.size("topics").cast("long").alias("n_topics"), F.array_join("topics", ",").alias("topics"))


@query(f"""WITH px AS (SELECT page_id, {s.html_text('html')} AS x FROM pages), {s.quality_cte('px', 'page_id', 'x', 'en')}
SELECT key AS page_id, {", ".join(f"round({c}, 6) AS {c}" for c in [*INDICATORS, "quality_score"])} FROM quality""")
def page_quality(spark: SparkSession, sf: str) -> DataFrame:
    web = pages(spark, sf).select("page_id", html_to_text("html").alias("text"))
    return with_quality(web, language=F.lit("en")).select("page_id", *[r6(c) for c in [*INDICATORS, "quality_score"]])
