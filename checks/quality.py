"""Quality indicators, filters, language and reports over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sqltext as s
from checks.registry import as_long, pages, query, r6, table, texts
from lexmill.functions import lexicon as lx
from lexmill.functions.language import primary_script, script_guess, with_language
from lexmill.functions.quality import (
    ISSUE_COLUMNS,
    quality,
    with_issue_flags,
    with_paragraph_metrics,
    with_quality,
)
from lexmill.operators.filters import keep_good_quality, with_filter_reason, with_pattern_filter
from lexmill.operators.reports import quality_report

_Q = f"WITH {s.quality_cte('documents', 'doc_id', 'text')}"


def _rounded(*columns: str) -> str:
    return f"{_Q} SELECT key AS doc_id, {', '.join(f'round({c}, 6) AS {c}' for c in columns)} FROM quality"


def _scored(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return with_quality(texts(spark, sf), columns=columns).select("doc_id", *[r6(c) for c in columns])


@query(f"""SELECT doc_id, CASE WHEN ok THEN length(text) END AS length,
  CASE WHEN ok THEN len(string_split(text, chr(10))) END AS line_count,
  CASE WHEN ok THEN {s.hits('text', chr(92) + 'w+')} END AS word_count
FROM (SELECT *, length(text) >= 10 AS ok FROM documents)""")
def doc_size(spark: SparkSession, sf: str) -> DataFrame:
    return with_quality(texts(spark, sf), columns=["length", "line_count", "word_count"]).select("doc_id", *as_long("length", "line_count", "word_count"))


@query(_rounded("lexical_diversity"))
def lexical_diversity(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, "lexical_diversity")


@query(_rounded("top5_concentration"))
def top5_concentration(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, "top5_concentration")


@query(_rounded("avg_line_length", "short_line_ratio", "long_line_ratio"))
def line_shape(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, "avg_line_length", "short_line_ratio", "long_line_ratio")


@query(_rounded("boilerplate_density"))
def boilerplate_density(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, "boilerplate_density")


@query(_rounded("html_density"))
def html_density(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, "html_density")


@query(f"""SELECT page_id, round(least(1.0, {s.hits('html', '</?[a-z]+>|&[a-z]+;', 'i')} / greatest(1.0, length(html) / 100::DOUBLE)), 6)
  AS html_density FROM pages""")
def html_density_pages(spark: SparkSession, sf: str) -> DataFrame:
    return with_quality(pages(spark, sf), "html", language=F.lit("en"), columns=["html_density"]).select("page_id", r6("html_density"))


@query(_rounded("question_density", "choice_density", "exam_content_likelihood"))
def exam_likelihood(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, "question_density", "choice_density", "exam_content_likelihood")


@query(f"{_Q} SELECT key AS doc_id, language, round(quality_score, 6) AS quality_score, quality_category FROM quality")
def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    return with_quality(texts(spark, sf)).select("doc_id", "language", r6("quality_score"), "quality_category")


@query(f"""{_Q} SELECT coalesce(c, 'all') AS category, count(*) AS n, round(avg(quality_score), 6) AS avg_score
FROM (SELECT coalesce(quality_category, 'very_low') AS c, quality_score FROM quality) GROUP BY ROLLUP (c)""")
def quality_category_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality_report(with_quality(texts(spark, sf), columns=["quality_score", "quality_category"])).select("category", "n", r6("avg_score"))


@query(f"{_Q} SELECT key AS doc_id, {s.FILTER_REASON} AS filter_reason FROM quality")
def filter_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return with_filter_reason(texts(spark, sf)).select("doc_id", "filter_reason")


@query(f"{_Q} SELECT key AS doc_id, text FROM (SELECT *, {s.FILTER_REASON} AS r FROM quality) WHERE r IS NULL")
def low_quality_filter(spark: SparkSession, sf: str) -> DataFrame:
    return keep_good_quality(texts(spark, sf))


_L = f"WITH {s.language_cte('documents', 'doc_id', 'text')}"


@query(f"{_L} SELECT k AS doc_id, language, round(confidence, 6) AS confidence FROM lang")
def detect_language(spark: SparkSession, sf: str) -> DataFrame:
    return with_language(texts(spark, sf), out="lang").select(
        "doc_id", "lang.language", r6(F.col("lang.confidence"), "confidence"))


@query(f"{_L} SELECT d.lang AS declared, lang.language AS detected, count(*) AS n FROM lang JOIN documents d ON d.doc_id = k GROUP BY ALL")
def language_confusion(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("text", F.col("lang").alias("declared"))
    tagged = with_language(docs, out="found").withColumn("detected", F.col("found.language"))
    return tagged.groupBy("declared", "detected").agg(F.count("*").alias("n"))


# Texts in other scripts, derived from the documents by shifting their letters.
_SHIFT = {"ja": (0x3041, "ja"), "ko": (0xAC00, "ko"), "zh": (0x4E00, "zh"), "ru": (0x0430, "ru")}
_LATIN = "abcdefghijklmnopqrstuvwxyz"


def _shifted(start: int) -> str:
    return "".join(chr(start + i) for i in range(len(_LATIN)))


def _script_case(column: str) -> str:
    cases = " ".join(
        f"WHEN {i} THEN translate(lower({column}), '{_LATIN}', '{_shifted(start)}')"
        for i, (start, _) in enumerate(_SHIFT.values()))
    return f"CASE doc_id % 5 {cases} ELSE {column} END"


def _in_scripts(docs: DataFrame) -> DataFrame:
    value = F.col("text")
    for i, (start, _) in enumerate(_SHIFT.values()):
        shifted = F.translate(F.lower("text"), _LATIN, _shifted(start))
        value = F.when(F.col("doc_id") % 5 == i, shifted).otherwise(value)
    return docs.select("doc_id", value.alias("text"))


@query(f"""SELECT doc_id, CASE WHEN {s.hits('h', '[' + chr(92) + 'x{4E00}-' + chr(92) + 'x{9FFF}]')} > 100 THEN 'zh'
  WHEN {s.hits('h', '[' + chr(92) + 'x{3040}-' + chr(92) + 'x{30FF}]')} > 50 THEN 'ja'
  WHEN {s.hits('h', '[' + chr(92) + 'x{AC00}-' + chr(92) + 'x{D7A3}]')} > 50 THEN 'ko'
  WHEN {s.hits('h', '[' + chr(92) + 'x{0400}-' + chr(92) + 'x{04FF}]')} > 50 THEN 'ru' ELSE 'en' END AS language
FROM (SELECT doc_id, {_script_case('text')} AS h FROM documents)""")
def script_guess_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _in_scripts(texts(spark, sf)).select("doc_id", script_guess("text").alias("language"))


@query(f"""WITH h AS (SELECT doc_id, {_script_case('text')} AS h FROM documents),
c AS (SELECT doc_id, 1 AS r, 'chinese' AS script, {s.hits('h', '[' + chr(92) + 'x{4E00}-' + chr(92) + 'x{9FFF}]')} AS n FROM h
 UNION ALL SELECT doc_id, 2, 'japanese', {s.hits('h', '[' + chr(92) + 'x{3040}-' + chr(92) + 'x{30FF}]')} FROM h
 UNION ALL SELECT doc_id, 3, 'korean', {s.hits('h', '[' + chr(92) + 'x{AC00}-' + chr(92) + 'x{D7A3}]')} FROM h
 UNION ALL SELECT doc_id, 4, 'arabic', {s.hits('h', '[' + chr(92) + 'x{0600}-' + chr(92) + 'x{06FF}]')} FROM h
 UNION ALL SELECT doc_id, 5, 'cyrillic', {s.hits('h', '[' + chr(92) + 'x{0400}-' + chr(92) + 'x{04FF}]')} FROM h
 UNION ALL SELECT doc_id, 0, 'english', 10 FROM h)
SELECT doc_id, script FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, r) AS rn FROM c) WHERE rn = 1""")
def primary_script_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _in_scripts(texts(spark, sf)).select("doc_id", primary_script("text").alias("script"))


@query(f"""WITH m AS (SELECT doc_id, {_script_case('text')} AS x FROM documents), {s.language_cte('m', 'doc_id', 'x')}
SELECT k AS doc_id, language, round(confidence, 6) AS confidence FROM lang""")
def detect_language_scripts(spark: SparkSession, sf: str) -> DataFrame:
    return with_language(_in_scripts(texts(spark, sf)), out="lang").select(
        "doc_id", "lang.language", r6(F.col("lang.confidence"), "confidence"))


# Blank-line paragraphs, made by doubling the line feeds.
@query("""WITH p AS (SELECT doc_id, unnest(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10))) AS p FROM documents),
k AS (SELECT doc_id, p, CASE WHEN length(p) >= 50 THEN lower(left(p, 50)) END AS f FROM p WHERE """ + s.strip("p") + """ <> ''),
a AS (SELECT doc_id, count(*) AS paragraph_count, avg(length(p)) AS avg_paragraph_length, count(f) AS nf, count(DISTINCT f) AS df FROM k GROUP BY doc_id)
SELECT d.doc_id, paragraph_count, round(avg_paragraph_length, 6) AS avg_paragraph_length,
 round(CASE WHEN paragraph_count > 1 AND nf > 0 THEN (nf - df) / greatest(1, nf - 1)::DOUBLE WHEN paragraph_count > 0 THEN 0.0 END, 6) AS paragraph_repetition
FROM documents d LEFT JOIN a ON a.doc_id = d.doc_id""")
def paragraph_metrics(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf).withColumn("text", F.replace("text", F.lit("\n"), F.lit("\n\n")))
    return with_paragraph_metrics(docs).select(
        "doc_id", *as_long("paragraph_count"), r6("avg_paragraph_length"), r6("paragraph_repetition"))


def _any(rules: list[str]) -> str:
    return "(" + " + ".join(f"{s.found('t', r, 'i')}::INT" for r in rules) + ")"


_EXAM = "CASE " + " ".join(f"WHEN language = '{c}' THEN {_any(r)}" for c, r in lx.EXAM_PHRASES.items()) + " ELSE 0 END"
_BOIL = "CASE " + " ".join(
    f"WHEN language = '{c}' THEN {_any(r)}" for c, r in lx.ISSUE_BOILERPLATE.items() if c != "common") + " ELSE 0 END"


@query(f"""WITH {s.language_cte('documents', 'doc_id', 'text')},
d AS (SELECT doc_id, text AS t, language, length(text) AS n FROM documents JOIN lang ON k = doc_id),
sent AS (SELECT doc_id, count(*) AS ns, avg(length(x)) AS mu, stddev_pop(length(x)) AS sd
         FROM (SELECT doc_id, unnest(regexp_split_to_array(t, '[.!?。！？]+')) AS x FROM d) GROUP BY doc_id),
w AS (SELECT doc_id, regexp_extract_all(lower(t), '{s.W}+') AS w FROM d),
f AS (SELECT d.doc_id,
  ({_EXAM}) + {_any(lx.EXAM_PHRASES['en'])} >= 2 OR {s.found('t', '[A-D]' + chr(92) + '.(.*)[A-D]' + chr(92) + '.(.*)[A-D]' + chr(92) + '.', 's')} AS exam_content,
  ({_BOIL}) + {_any(lx.ISSUE_BOILERPLATE['common'])} >= 3 AS excessive_boilerplate,
  {s.hits('t', '<[^>]+>', 'i')} + {s.hits('t', '&[a-z]+;', 'i')} + {s.hits('t', chr(92) + '[/?[a-z]+' + chr(92) + ']', 'i')} > n * 0.02 AS excessive_formatting,
  ns > 5 AND sd < mu * 0.3 AND mu > 20 AS machine_generated,
  len(w) > 50 AND list_unique(w) / len(w)::DOUBLE < 0.3 AS highly_repetitive
 FROM d JOIN sent ON sent.doc_id = d.doc_id JOIN w ON w.doc_id = d.doc_id)
SELECT *, exam_content OR excessive_boilerplate OR excessive_formatting OR machine_generated OR highly_repetitive AS should_filter FROM f""")
def issue_flags(spark: SparkSession, sf: str) -> DataFrame:
    tagged = with_language(texts(spark, sf), out="lang")
    tagged = tagged.withColumn("language", F.col("lang.language"))
    return with_issue_flags(tagged).select("doc_id", *ISSUE_COLUMNS, "should_filter")


_STRONG = [r for r, strong in lx.PATTERN_FILTER_BOILERPLATE if strong]
_WEAK = [r for r, strong in lx.PATTERN_FILTER_BOILERPLATE if not strong]
_ANY_LINE = " OR ".join(s.found("l", r, "i") for r, _ in lx.PATTERN_FILTER_BOILERPLATE)


# The data holds no CJK text, so the English rules apply throughout.
@query(f"""WITH d AS (SELECT doc_id, text AS t, regexp_extract_all(lower(text), '{s.W}+') AS w FROM documents WHERE length(text) >= 50),
kept AS (SELECT doc_id, t FROM d
  WHERE NOT ({s.hits('t', chr(92) + '(?[A-D]' + chr(92) + ')?[' + chr(92) + 's.)' + chr(92) + ']]+', 'im')} >= 3
          OR {s.hits('t', chr(92) + 'd+[' + chr(92) + 's.)' + chr(92) + ']]+' + chr(92) + '(?[A-D]' + chr(92) + ')?', 'im')} >= 3
          OR {_any(lx.PATTERN_FILTER_EXAM['english'])} >= 2)
    AND NOT ({_any(_STRONG)} > 0 OR {_any(_WEAK)} >= 4)
    AND NOT (len(w) > 30 AND list_unique(w) / len(w)::DOUBLE < 0.2)),
body AS (SELECT doc_id, list_filter([{s.strip('l')} for l in string_split({s.subs('t', *[(r, ' ') for r in lx.REMNANT_RULES])}, chr(10))],
  lambda l: l <> '' AND len(regexp_extract_all(l, '[^\\p{{L}}\\p{{N}}\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]')) / length(l)::DOUBLE <= 0.3
            AND NOT ({_ANY_LINE})) AS ls FROM kept),
flat AS (SELECT doc_id, CASE WHEN len(ls) >= 3 THEN trim({s.sub("array_to_string(ls, ' ')", chr(92) + 's+', ' ')}) END AS x FROM body)
SELECT d.doc_id, CASE WHEN length(x) >= 50 THEN x END AS clean_text FROM documents d LEFT JOIN flat ON flat.doc_id = d.doc_id""")
def pattern_filter(spark: SparkSession, sf: str) -> DataFrame:
    return with_pattern_filter(texts(spark, sf)).select("doc_id", "clean_text")


# Language and script judged by the beginning of each text, as asked for by name.
@query(f"""WITH {s.quality_cte("(SELECT doc_id, text[:600] AS head FROM documents)", "doc_id", "head")},
h AS (SELECT doc_id, {_script_case('text')}[:300] AS h FROM documents)
SELECT key AS doc_id, language, CASE WHEN {s.hits('h', '[' + chr(92) + 'x{4E00}-' + chr(92) + 'x{9FFF}]')} > 100 THEN 'zh'
  WHEN {s.hits('h', '[' + chr(92) + 'x{3040}-' + chr(92) + 'x{30FF}]')} > 50 THEN 'ja'
  WHEN {s.hits('h', '[' + chr(92) + 'x{AC00}-' + chr(92) + 'x{D7A3}]')} > 50 THEN 'ko'
  WHEN {s.hits('h', '[' + chr(92) + 'x{0400}-' + chr(92) + 'x{04FF}]')} > 50 THEN 'ru' ELSE 'en' END AS script FROM quality JOIN h ON key = doc_id""")
def language_of_beginning(spark: SparkSession, sf: str) -> DataFrame:
    by_text = texts(spark, sf).select("doc_id", quality("text", columns=["language"], language_chars=600)["language"].alias("language"))
    by_script = _in_scripts(texts(spark, sf)).select("doc_id", script_guess("text", chars=300).alias("script"))
    return by_text.join(by_script, "doc_id")
