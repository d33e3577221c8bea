"""Readability metrics and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sqltext as s
from checks.registry import as_long, query, r6, table, texts
from lexmill.functions import lexicon as lx
from lexmill.functions.language import with_language
from lexmill.functions.metrics import TEXT_METRICS, big_text_sample, with_text_metrics
from lexmill.functions.stopwords import STOP_WORDS
from lexmill.operators import reports
from lexmill.operators.scratch import materialized

# Languages of the data; the other lists are never consulted here.
_STOP = "(CASE language " + " ".join(
    f"WHEN '{c}' THEN len(list_filter(w, lambda x: x IN ({', '.join(s.lit(x) for x in STOP_WORDS[lx.STOP_WORD_LANGUAGES[c]])})))"
    for c in ("en", "es", "fr", "de")) + " ELSE 0 END)"

# Words per sentence are counted sentence by sentence here.
_M = f"""{s.language_cte('documents', 'doc_id', 'text')},
tm_d AS (SELECT doc_id, text AS t, language, regexp_extract_all(lower(text), '{s.W}+') AS w FROM documents JOIN lang ON k = doc_id),
tm_s AS (SELECT doc_id, count(*) AS ns, avg({s.hits('lower(x)', chr(92) + 'w+')}) AS asl FROM (
  SELECT doc_id, unnest(regexp_split_to_array(t, '[.!?]+')) AS x FROM tm_d) WHERE {s.strip('x')} <> '' GROUP BY doc_id),
tm_v AS (SELECT tm_d.doc_id, t, language, w, len(w) AS n, coalesce(ns, 0) AS ns, coalesce(asl, 0.0) AS asl,
  coalesce(list_sum([length(x) for x in w]) / nullif(len(w), 0)::DOUBLE, 0.0) AS awl,
  list_sum([greatest(1, len(regexp_extract_all(x, '[aeiouy]+'))) for x in w]) AS syl
 FROM tm_d LEFT JOIN tm_s ON tm_s.doc_id = tm_d.doc_id),
metrics AS (SELECT doc_id, language, length(t) AS length, awl AS avg_word_length, asl AS avg_sentence_length,
  coalesce(list_unique(w) / nullif(n, 0)::DOUBLE, 0.0) AS vocab_richness,
  CASE WHEN {s.strip('t')} = '' THEN 0.0 WHEN language = 'en' THEN CASE WHEN n > 0 THEN
     206.835::DOUBLE - 1.015::DOUBLE * (n / greatest(1, ns)::DOUBLE) - 84.6::DOUBLE * (syl / n::DOUBLE) ELSE 0.0 END
   ELSE 100 - least(100.0::DOUBLE, 4.71::DOUBLE * awl + 0.5::DOUBLE * asl) END AS readability,
  coalesce({_STOP} / nullif(n, 0)::DOUBLE, 0.0) AS stopword_ratio FROM tm_v)"""


def _measured(spark: SparkSession, sf: str) -> DataFrame:
    tagged = with_language(texts(spark, sf), out="_lang").withColumn("language", F.col("_lang.language")).drop("_lang")
    return with_text_metrics(tagged).drop("text")


@query(f"WITH {_M} SELECT doc_id, language, length, {', '.join(f'round({m}, 6) AS {m}' for m in TEXT_METRICS[1:])} FROM metrics")
def text_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _measured(spark, sf).select("doc_id", "language", *as_long("length"), *[r6(m) for m in TEXT_METRICS[1:]])


@query(f"WITH {_M} SELECT language, round(avg(avg_sentence_length), 6) AS avg_sentence_length FROM metrics GROUP BY language")
def metrics_by_language(spark: SparkSession, sf: str) -> DataFrame:
    return reports.sentence_length_by_language(_measured(spark, sf)).select("language", r6("avg_sentence_length"))


@query(f"WITH {_M} SELECT language, count(*) AS n, round(avg(length), 6) AS avg_length FROM metrics GROUP BY language")
def language_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.language_counts(_measured(spark, sf)).select("language", "n", r6("avg_length"))


@query(f"WITH {_M} " + " UNION ALL ".join(
    f"SELECT '{a}' AS metric_a, '{b}' AS metric_b, round(corr({a}, {b}), 6) AS r FROM metrics"
    for a in TEXT_METRICS for b in TEXT_METRICS))
def metrics_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return reports.metrics_correlation(_measured(spark, sf)).select("metric_a", "metric_b", r6("r"))


def _histogram_sql(source: str, column: str) -> str:
    return f"""b AS (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM {source}),
i AS (SELECT least(floor(({column} - lo) / ((hi - lo) / 30)), 29)::BIGINT AS bin FROM {source}, b)
SELECT r.bin, round(lo + r.bin * (hi - lo) / 30, 4) AS lower, round(lo + (r.bin + 1) * (hi - lo) / 30, 4) AS upper,
 (SELECT count(*) FROM i WHERE i.bin = r.bin) AS n FROM range(30) AS r(bin), b"""


@query(f"WITH h AS (SELECT length(text) AS v FROM documents), {_histogram_sql('h', 'v')}")
def length_histogram(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf).select(F.length("text").alias("v"))
    return reports.histogram(docs, "v").select("bin", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), "n")


@query(f"WITH {_M}, {_histogram_sql('metrics', 'readability')}")
def readability_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return reports.histogram(materialized(_measured(spark, sf)), "readability").select(
        "bin", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), "n")


def _profile_sql(by: str) -> str:
    group = f"{by}, " if by else ""
    key = f"GROUP BY {by}" if by else ""
    join = f"JOIN v USING ({by})" if by else ", v"
    return f"""WITH l AS (SELECT {group}{s.strip('x')} AS l FROM (SELECT {group}unnest(string_split(text, chr(10))) AS x FROM documents)),
a AS (SELECT {group}count(*) FILTER (l <> '') AS line_count, sum(length(l)) AS chars,
  sum({s.hits('l', chr(92) + 'S+')}) AS words, sum(len(regexp_extract_all(l, '[^\\p{{L}}\\p{{N}}\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]'))) AS special,
  count(DISTINCT l) FILTER (l <> '') AS uniq, count(*) FILTER (l = '') AS empty,
  count(*) FILTER (l <> '' AND (length(l) < 3 OR {s.hits('l', chr(92) + '[')} > {s.hits('l', chr(92) + ']')})) AS malformed FROM l {key}),
v AS (SELECT {group}count(DISTINCT w) AS vocabulary_size FROM (SELECT {group}unnest(regexp_extract_all(l, '{s.NWS}+')) AS w FROM l) {key})
SELECT {group}line_count, round(chars / line_count, 6) AS avg_line_length, round(words / line_count, 6) AS avg_word_count, vocabulary_size,
  round(special / chars, 6) AS special_char_ratio, round(1 - uniq / line_count::DOUBLE, 6) AS duplicated_line_ratio,
  round(empty / (line_count + empty)::DOUBLE, 6) AS empty_line_ratio, round(malformed / line_count::DOUBLE, 6) AS malformed_line_ratio
FROM a {join} WHERE line_count > 0"""


def _profiled(df: DataFrame, by: list[str]) -> DataFrame:
    p = reports.line_profile(df, by)
    return p.select(*by, "line_count", "vocabulary_size", *[r6(c) for c in p.columns if c not in (*by, "line_count", "vocabulary_size")])


@query(_profile_sql(""))
def line_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _profiled(texts(spark, sf), [])


@query(_profile_sql("source"))
def line_profile_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return _profiled(table(spark, sf, "documents").select("source", "text"), ["source"])


# Small limits, so that the windows apply to the documents at hand.
@query("""WITH d AS (SELECT doc_id, text AS t, length(text) AS n, least(400, length(text) // 20) AS z FROM documents),
w AS (SELECT *, substr(t, n // 2 - z // 2 + 1) AS mid, substr(t, greatest(0, n - z) + 1) AS tail FROM d)
SELECT doc_id, CASE WHEN n < 2000 THEN left(t, 1000) ELSE left(t, z)
  || CASE WHEN instr(mid, chr(10)) > 0 THEN substr(mid, instr(mid, chr(10)) + 1, z) ELSE '' END
  || CASE WHEN instr(tail, chr(10)) > 0 THEN substr(tail, instr(tail, chr(10)) + 1, z) ELSE '' END END AS sample FROM w""")
def big_text_windows(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf).select("doc_id", big_text_sample("text", small=2000, head=1000, window=400).alias("sample"))


@query("""SELECT round(avg(length(text)), 6) AS avg_length, avg(length(text)) < 10 AS too_short
FROM documents""")
def text_sanity(spark: SparkSession, sf: str) -> DataFrame:
    return reports.text_sanity(texts(spark, sf)).select(r6("avg_length"), "too_short")
