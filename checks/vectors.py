"""Vocabulary, sequences, TF-IDF."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sqltext as s
from checks.registry import query, r6, table, texts
from lexmill.functions.stopwords import STOP_WORDS
from lexmill.functions.tokens import whitespace_tokens
from lexmill.operators import vocabulary as v
from lexmill.plans.jobs import prepare_sequences as prepare
from lexmill.operators.sampling import ratio_split

_TOKENS = f"regexp_extract_all(lower(text), '{s.NWS}+')"


@query(f"SELECT doc_id, len({_TOKENS}) AS n, array_to_string({_TOKENS}, ' ') AS joined FROM documents")
def tokenise(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf).select("doc_id", whitespace_tokens("text").alias("w"))
    return docs.select("doc_id", F.size("w").cast("long").alias("n"), F.array_join("w", " ").alias("joined"))


@query(f"SELECT word, count(*) AS n FROM (SELECT unnest({_TOKENS}) AS word FROM documents) GROUP BY word")
def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return v.word_counts(texts(spark, sf))


@query(f"""SELECT '<PAD>' AS word, 0::BIGINT AS idx, NULL::BIGINT AS n UNION ALL SELECT '<UNK>', 1, NULL UNION ALL
SELECT word, row_number() OVER (ORDER BY n DESC, word) + 1 AS idx, n FROM (
  SELECT word, count(*) AS n FROM (SELECT unnest({_TOKENS}) AS word FROM documents) GROUP BY word ORDER BY n DESC, word LIMIT 9998)""")
def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return v.build_vocabulary(texts(spark, sf))


def _vocab(source: str, size: int) -> str:
    return f"""vocab AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) + 1 AS idx FROM (
  SELECT word, count(*) AS n FROM (SELECT unnest({_TOKENS}) AS word FROM {source}) GROUP BY word ORDER BY n DESC, word LIMIT {size - 2}))"""


@query(f"""WITH {_vocab('documents', 2000)}, w AS (SELECT unnest({_TOKENS}) AS word FROM benchmark)
SELECT count(*) AS tokens, count(*) FILTER (idx IS NULL) AS unknown, round(count(*) FILTER (idx IS NULL) / count(*)::DOUBLE, 6) AS unknown_share
FROM w LEFT JOIN vocab USING (word)""")
def oov_rate(spark: SparkSession, sf: str) -> DataFrame:
    vocab = v.build_vocabulary(texts(spark, sf), max_size=2000)
    return v.unknown_rate(table(spark, sf, "benchmark"), vocab).select("tokens", "unknown", r6("unknown_share"))


def _sequences(source: str, length: int) -> str:
    """Sequences of a relation, joined to text; position by position."""
    return f"""(WITH w AS (SELECT doc_id, unnest({_TOKENS}) AS word, generate_subscripts({_TOKENS}, 1) AS i FROM {source}),
 x AS (SELECT doc_id, i, coalesce(idx, 1) AS idx FROM w LEFT JOIN vocab USING (word) WHERE i <= {length}),
 g AS (SELECT d.doc_id, p.i, coalesce(x.idx, 0) AS idx FROM {source} d CROSS JOIN range(1, {length + 1}) AS p(i)
       LEFT JOIN x ON x.doc_id = d.doc_id AND x.i = p.i)
 SELECT doc_id, string_agg(idx::VARCHAR, ' ' ORDER BY i) AS sequence FROM g GROUP BY doc_id)"""


@query(f"WITH {_vocab('documents', 10000)} SELECT * FROM {_sequences('documents', 100)}")
def sequences(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf)
    out = v.texts_to_sequences(docs, v.build_vocabulary(docs), "doc_id")
    return out.select("doc_id", F.array_join("sequence", " ").alias("sequence"))


# Every word of the corpus in a vocabulary of any size; 500 words travel, the others are joined.
@query(f"WITH {_vocab('documents', 100_000_000)} SELECT * FROM {_sequences('documents', 100)}")
def sequences_large_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf)
    out = v.texts_to_sequences_joined(docs, v.build_large_vocabulary(docs), "doc_id", heavy_words=500)
    return out.select("doc_id", F.array_join("sequence", " ").alias("sequence"))


@query(f"""WITH sp AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= floor(count(*) OVER () * 0.8) AS train FROM documents),
tr AS (SELECT * FROM sp WHERE train), {_vocab('tr', 5000)}
SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS split, doc_id, sequence FROM {_sequences('documents', 50)} JOIN sp USING (doc_id)""")
def prepare_sequences(spark: SparkSession, sf: str) -> DataFrame:
    data = prepare(ratio_split(texts(spark, sf), "doc_id"), "doc_id", max_vocabulary=5000, length=50)
    both = [df.withColumn("split", F.lit(name)) for name, df in (("train", data.train), ("test", data.test))]
    return both[0].unionByName(both[1]).select("split", "doc_id", F.array_join("sequence", " ").alias("sequence"))


_STOPPED = ", ".join(s.lit(w) for w in STOP_WORDS["english"])
_TFIDF = f"""WITH w AS (SELECT doc_id, word, count(*) AS tf FROM (
   SELECT doc_id, unnest(regexp_extract_all(lower(text), '{s.W}+')) AS word FROM documents)
   WHERE length(word) >= 2 AND word NOT IN ({_STOPPED}) GROUP BY ALL),
f AS (SELECT word, count(*) AS df FROM w GROUP BY word ORDER BY sum(tf) DESC, word LIMIT 1000),
r AS (SELECT doc_id, word, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)::DOUBLE) + 1) AS raw FROM w JOIN f USING (word)),
n AS (SELECT doc_id, sqrt(sum(raw * raw)) AS norm FROM r GROUP BY doc_id)"""


@query(f"{_TFIDF} SELECT doc_id, word AS term, round(raw / norm, 6) AS weight FROM r JOIN n USING (doc_id)")
def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    return v.tfidf(texts(spark, sf), "doc_id").select("doc_id", "term", r6("weight"))


@query(f"""{_TFIDF} SELECT d.doc_id, count(word) AS terms, round(coalesce(sum(raw / norm), 0.0), 6) AS total
FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""")
def tfidf_vectors(spark: SparkSession, sf: str) -> DataFrame:
    vectors = v.tfidf_vectors(texts(spark, sf), "doc_id").select("doc_id", vector_to_array("features").alias("x"))
    total = F.aggregate("x", F.lit(0.0), lambda a, x: a + x)
    return vectors.select(
        "doc_id", F.size(F.filter("x", lambda x: x > 0)).cast("long").alias("terms"), r6(total, "total"))
