"""Splits, samples, labels, scans over derived lines, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sqltext as s
from checks.registry import query, table, texts
from lexmill.functions import patterns as rx
from lexmill.operators import reports, sampling
from lexmill.operators.filters import min_length, not_blank
from lexmill.sources.sinks import not_yet_processed
from lexmill.sources import sinks
from lexmill.sources.text import concat_splits as concat
from lexmill.sources.text import integer_label, split_documents, split_label


def _ids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id")


_ORDER = "row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id)"


@query(f"""SELECT doc_id, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split
FROM (SELECT doc_id, {_ORDER} AS rn, count(*) OVER () AS n FROM documents)""")
def ratio_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.ratio_split(_ids(spark, sf), "doc_id")


@query(f"""SELECT doc_id, CASE WHEN rn <= n - ceil(n * 0.2) THEN 'train' ELSE 'test' END AS split
FROM (SELECT doc_id, {_ORDER} AS rn, count(*) OVER () AS n FROM documents)""")
def random_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.random_split(_ids(spark, sf), "doc_id")


@query("""SELECT doc_id, CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT < 3435973836 THEN 'train' ELSE 'test' END AS split
FROM documents""")
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.hash_split(_ids(spark, sf), "doc_id")


@query("""WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality), t AS (SELECT sum(n)::BIGINT AS total FROM c),
d AS (SELECT quality, n, total, (total - ceil(total * 0.2))::BIGINT AS draws FROM c, t),
w AS (SELECT *, (draws * n) // total AS whole, (draws * n) % total AS rest FROM d),
q AS (SELECT quality, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, quality) <= draws - sum(whole) OVER () THEN 1 ELSE 0 END AS k FROM w)
SELECT doc_id, l.quality, CASE WHEN row_number() OVER (PARTITION BY l.quality ORDER BY md5('42:' || doc_id), doc_id) <= k
  THEN 'train' ELSE 'test' END AS split FROM labels l JOIN q ON q.quality = l.quality""")
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified_split(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query("""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS split
FROM documents""")
def head_tail_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.head_tail_split(_ids(spark, sf), "doc_id")


@query("""SELECT doc_id, quality FROM (SELECT doc_id, quality, n, min(n) OVER () AS k,
  row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) AS rn
  FROM labels JOIN (SELECT quality, count(*) AS n FROM labels GROUP BY quality) USING (quality)) WHERE rn <= k""")
def balance_classes(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.balance_classes(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query("SELECT doc_id, left(text, 10000) AS text FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 300")
def bounded_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.bounded_sample(texts(spark, sf), "doc_id", "text", k=300)


@query("SELECT url FROM pages ORDER BY md5('42:' || url), url LIMIT 5")
def input_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.hash_sample(table(spark, sf, "pages").select("url"), 5, "url")


@query(f"SELECT doc_id, {_ORDER} AS position FROM documents")
def seeded_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.seeded_shuffle(_ids(spark, sf), "doc_id")


@query("""WITH c AS (SELECT quality, sum(count(*)) OVER (ORDER BY quality) AS upto, sum(count(*)) OVER () AS total FROM labels GROUP BY quality),
u AS (SELECT doc_id, ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM documents)
SELECT doc_id, min(quality) AS label FROM u, c WHERE u < upto / total::DOUBLE GROUP BY doc_id""")
def weighted_labels(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.weighted_labels(_ids(spark, sf), table(spark, sf, "labels"), "quality", "doc_id")


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) % 2 AS label FROM documents")
def alternating_labels(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.alternating_labels(_ids(spark, sf), "doc_id")


@query("SELECT doc_id, CASE WHEN length(text) > 500 THEN 1 ELSE 0 END AS label FROM documents")
def length_labels(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf).select("doc_id", sampling.length_labels("text").alias("label"))


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 32 AS batch FROM documents")
def mini_batches(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.mini_batches(_ids(spark, sf), 32, "doc_id")


@query("""SELECT doc_id, source, (dense_rank() OVER (ORDER BY source) - 1) AS label_idx FROM documents""")
def label_encode(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return sampling.encode_labels(docs, sampling.label_index(docs, "source"), "source")


# Index 0 to 9 of the vectors; only the first languages have a label.
@query("""WITH m AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS i FROM (SELECT DISTINCT lang FROM documents))
SELECT vec_id, label::BIGINT AS class_index, coalesce(lang, label::VARCHAR) AS class FROM embeddings LEFT JOIN m ON i = label""")
def label_decode(spark: SparkSession, sf: str) -> DataFrame:
    mapping = sampling.label_index(table(spark, sf, "documents"), "lang")
    vectors = table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("long").alias("class_index"))
    return sampling.decode_labels(vectors, mapping, label="lang")


@query("SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def incremental_anti(spark: SparkSession, sf: str) -> DataFrame:
    return not_yet_processed(texts(spark, sf), table(spark, sf, "labels"), "doc_id")


@query("SELECT quality AS label, count(*) AS n FROM labels GROUP BY quality")
def label_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return reports.label_distribution(table(spark, sf, "labels").withColumnRenamed("quality", "label"))


@query("SELECT count(*) AS total, floor(count(*) * 0.8)::BIGINT AS train, count(*) - floor(count(*) * 0.8)::BIGINT AS test FROM documents")
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.dataset_counts(sampling.ratio_split(_ids(spark, sf), "doc_id"))


# One text per source: its documents between rulers.
@query(f"""SELECT source, trim(x, chr(32) || chr(10)) AS text FROM (
  SELECT source, unnest(string_split(string_agg(text || chr(10) || repeat('-', 80) || chr(10), '' ORDER BY doc_id), repeat('-', 80))) AS x
  FROM documents GROUP BY source) WHERE length({s.strip('x')}) > 100""")
def doc_delimited_scan(spark: SparkSession, sf: str) -> DataFrame:
    # As many documents per text as a source has, as in one extracted file per archive.
    block = F.concat("text", F.lit("\n" + "-" * 80 + "\n"))
    docs = table(spark, sf, "documents").select("source", "doc_id", block.alias("b"))
    per_doc = docs.select("source", F.explode(split_documents("b")).alias("text"))
    return per_doc


@query("""SELECT conv_id, turn, CASE WHEN role = 'user' THEN turn::VARCHAR ELSE role END AS label, text, false AS malformed,
  CASE WHEN role = 'user' THEN turn END AS label_number FROM conversations""")
def tsv_label_scan(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    label = F.when(F.col("role") == "user", F.col("turn").cast("string")).otherwise(F.col("role"))
    lines = turns.select("conv_id", "turn", F.concat(label, F.lit("\t"), "text").alias("value"))
    return lines.select("conv_id", "turn", *split_label("value")).withColumn("label_number", integer_label("label"))


@query("""SELECT doc_id, text, 'train' AS split FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, text, 'test' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def concat_splits(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = texts(spark, sf), table(spark, sf, "labels")
    return concat(docs.join(labels, "doc_id", "left_semi"), docs.join(labels, "doc_id", "left_anti"))


@query("SELECT text FROM documents UNION ALL SELECT text FROM benchmark UNION ALL SELECT text FROM conversations")
def pooled_texts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.union_all([table(spark, sf, t).select("text") for t in ("documents", "benchmark", "conversations")])


@query(f"SELECT DISTINCT {s.strip('l')} AS line FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM conversations)")
def distinct_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "conversations").select(F.explode(F.split("text", "\n")).alias("l"))
    return reports.distinct_values(lines.select(rx.strip("l").alias("line")), "line")


@query(f"SELECT doc_id, length(text) >= 100 AS long_enough, {s.strip('text')} <> '' AS not_blank FROM documents")
def length_filters(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf).select(
        "doc_id", min_length("text").alias("long_enough"), not_blank("text").alias("not_blank"))


@query("SELECT lang, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents GROUP BY lang")
def corpus_summary(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("lang", F.length("text").cast("long").alias("length"))
    per_language = sinks.summary(docs, "lang").select(F.explode("languages").alias("lang", "n"))
    chars = docs.groupBy("lang").agg(F.sum("length").alias("chars"))
    return per_language.join(chars, "lang").select("lang", "n", "chars")


# Labels and keys with nulls: a null label is a class, a null key a row.
_NULLS = """(SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE doc_id % 3 END AS label FROM documents)"""


def _null_labels(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("doc_id") % 5 != 0, F.col("doc_id") % 3)
    return table(spark, sf, "documents").select("doc_id", label.alias("label"))


@query(f"""WITH r AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id), doc_id) AS i FROM {_NULLS}),
m AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM {_NULLS} GROUP BY label))
SELECT label, count(*) AS n FROM r, m WHERE i <= m.n GROUP BY label""")
def balance_null_class(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.balance_classes(_null_labels(spark, sf), "label", "doc_id").groupBy("label").agg(F.count("*").alias("n"))


@query(f"""WITH c AS (SELECT label, count(*) AS n FROM {_NULLS} GROUP BY label), t AS (SELECT sum(n) AS a, sum(n) - ceil(sum(n) * 0.2) AS d FROM c),
w AS (SELECT label, n, floor(d * n / a) AS k, d * n - floor(d * n / a) * a AS rest, d FROM c, t),
q AS (SELECT label, n, k + CASE WHEN row_number() OVER (ORDER BY rest DESC, label NULLS FIRST) <= d - sum(k) OVER () THEN 1 ELSE 0 END AS k FROM w)
SELECT label, 'train' AS split, k::BIGINT AS n FROM q UNION ALL SELECT label, 'test', (n - k)::BIGINT FROM q""")
def stratified_null_label(spark: SparkSession, sf: str) -> DataFrame:
    split = sampling.stratified_split(_null_labels(spark, sf), "label", "doc_id")
    return split.groupBy("label", "split").agg(F.count("*").alias("n"))


@query("""SELECT b AS batch, count(*) AS n FROM (SELECT (row_number() OVER (ORDER BY k NULLS FIRST) - 1) // 32 AS b
FROM (SELECT DISTINCT CASE WHEN doc_id > 0 THEN doc_id END AS k FROM documents)) GROUP BY b""")
def batches_null_key(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "documents").select(F.when(F.col("doc_id") > 0, F.col("doc_id")).alias("k"))
    return sampling.mini_batches(keys, 32, "k").groupBy("batch").agg(F.count("*").alias("n"))
