"""Cleaning rules over documents, conversations and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sqltext as s
from checks.registry import pages, query, r6, table, texts
from lexmill.functions import cleaning as c
from lexmill.functions import lexicon as lx
from lexmill.functions.metrics import composite_score, with_noise_analysis
from lexmill.operators.filters import remove_remnants as remnants
from lexmill.operators.gates import clean_by_quality as by_quality
from lexmill.operators.gates import clean_from_analysis, clean_if_better as if_better


@query(f"SELECT doc_id, {s.clean_basic('text')} AS text FROM documents")
def clean_basic(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf).select("doc_id", c.clean_basic("text").alias("text"))


@query(f"SELECT page_id, {s.clean_basic('html')} AS text FROM pages")
def clean_basic_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).select("page_id", c.clean_basic("html").alias("text"))


@query(f"SELECT doc_id, {s.clean_basic_lines('text')} AS text FROM documents")
def clean_basic_lines(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf).select("doc_id", c.clean_basic("text", mode="lines").alias("text"))


@query(f"SELECT doc_id, {s.special_chars('text')} AS text FROM documents")
def clean_special_chars(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf).select("doc_id", c.clean_special_chars("text").alias("text"))


@query(f"SELECT doc_id, {s.clean_deep('text')} AS text FROM documents")
def clean_deep_document(spark: SparkSession, sf: str) -> DataFrame:
    return c.with_clean_text(texts(spark, sf), deep=True).select("doc_id", F.col("clean_text").alias("text"))


@query(f"SELECT page_id, {s.clean_deep('html')} AS text FROM pages")
def clean_deep_pages(spark: SparkSession, sf: str) -> DataFrame:
    return c.with_clean_text(pages(spark, sf), "html", deep=True).select(
        "page_id", F.col("clean_text").alias("text"))


def _lines(text: str) -> str:
    return f"[{s.strip('l')} for l in string_split({text}, chr(10))]"


def _noise_lines(text: str) -> str:
    return f"list_filter({_lines(text)}, lambda l: l <> '' AND {s.content_line('l')})"


def _boilerplate_lines(lines: str) -> str:
    """Lines kept by the boilerplate rules, given non-empty stripped lines; joined."""
    return f"""(SELECT CASE WHEN len(ls) = 0 THEN '' WHEN (len(ls) - len(kept)) / len(ls)::DOUBLE > 0.5
      THEN array_to_string(list_filter(kept, lambda l: {s.substantial_line('l')}), chr(10))
      ELSE array_to_string(kept, chr(10)) END
    FROM (SELECT ls, list_filter(ls, lambda l: NOT {s.boilerplate_line('l')}) AS kept FROM (SELECT {lines} AS ls)))"""


_TURN = ["conv_id", "turn"]
# Turns get interface lines put around them: one cue per role, from the row's own words.
_DIRTY_SQL = """role || ' ' || turn || chr(10) || upper(replace(left(text, 30), 'ß', 's')) || chr(10) || text || chr(10)
  || CASE WHEN role = 'user' THEN 'Share ' || left(text, 12) ELSE conv_id || '. A. ' || left(text, 40) END
  || chr(10) || '[ ' || turn || ' ]' || chr(10) || '- ' || split_part(text, ' ', 1)"""


def _dirty(turns: DataFrame) -> DataFrame:
    first_word = F.split_part("text", F.lit(" "), F.lit(1))
    cue = F.when(F.col("role") == "user", F.concat(F.lit("Share "), F.left("text", F.lit(12)))).otherwise(
        F.concat(F.col("conv_id").cast("string"), F.lit(". A. "), F.left("text", F.lit(40))))
    turn = F.col("turn").cast("string")
    return turns.select(*_TURN, F.concat(
        F.col("role"), F.lit(" "), turn, F.lit("\n"), F.upper(F.replace(F.left("text", F.lit(30)), F.lit("ß"), F.lit("s"))), F.lit("\n"), F.col("text"),
        F.lit("\n"), cue, F.lit("\n[ "), turn, F.lit(" ]\n- "), first_word).alias("text"))


_CONV = f"(SELECT conv_id, turn, {_DIRTY_SQL} AS text FROM conversations)"


@query(f"SELECT conv_id, turn, array_to_string({_noise_lines('text')}, chr(10)) AS text FROM {_CONV}")
def drop_noise_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _dirty(table(spark, sf, "conversations")).select(*_TURN, c.drop_noise_lines("text").alias("text"))


@query(f"""SELECT conv_id, turn, {_boilerplate_lines(f"list_filter({_lines('text')}, lambda l: l <> '')")} AS text FROM {_CONV}""")
def drop_boilerplate_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _dirty(table(spark, sf, "conversations")).select(*_TURN, c.drop_boilerplate_lines("text").alias("text"))


@query(f"""SELECT conv_id, turn, array_to_string(list_filter({_lines('text')}, lambda l: {s.substantial_line('l')}), chr(10)) AS text
FROM {_CONV}""")
def drop_navigation_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _dirty(table(spark, sf, "conversations")).select(*_TURN, c.drop_navigation_lines("text").alias("text"))


@query(f"""SELECT doc_id, {s.sub(s.sub(_boilerplate_lines(_noise_lines(s.special_chars(s.clean_basic_lines('text')))),
    lx.LEADING_WELCOME, ''), lx.TRAILING_NOTICE, '')} AS text FROM documents""")
def clean_deep_lines(spark: SparkSession, sf: str) -> DataFrame:
    return c.with_clean_text(texts(spark, sf), deep=True, mode="lines").select(
        "doc_id", F.col("clean_text").alias("text"))


# Documents wrapped into a header, blank lines and rulers, as in extracted text files.
_WRAPPED = """'intro ' || doc_id || chr(10) || '-----' || chr(10) || '# Document ' || doc_id || chr(10) || chr(10) || ' ' || chr(10)
  || text || chr(10) || repeat('-', 80) || chr(10) || chr(10) || chr(10) || chr(10) || '# Document 7 (again)' || chr(10) || 'end of ' || doc_id"""


@query(f"""WITH lines AS (SELECT doc_id, unnest(string_split({_WRAPPED}, chr(10))) AS l,
         generate_subscripts(string_split({_WRAPPED}, chr(10)), 1) AS i FROM documents),
kinds AS (SELECT *, CASE WHEN {s.found(s.strip('l'), '^-{5,}$')} THEN 'ruler'
  WHEN {s.found('l', '^#' + chr(92) + 's*Document' + chr(92) + 's+' + chr(92) + 'd+')} THEN 'header'
  WHEN {s.strip('l')} = '' THEN 'blank' ELSE 'text' END AS kind FROM lines),
seen AS (SELECT *, last_value(CASE WHEN kind IN ('header', 'text') THEN kind END IGNORE NULLS)
  OVER (PARTITION BY doc_id ORDER BY i) AS state FROM kinds),
kept AS (SELECT doc_id, string_agg(l, chr(10) ORDER BY i) AS x FROM seen
  WHERE kind = 'text' OR (kind = 'blank' AND state IS DISTINCT FROM 'header') GROUP BY doc_id)
SELECT doc_id, {s.sub(s.sub(s.sub('x', chr(92) + 'n{3,}', chr(10) + chr(10)), lx.LEADING_WELCOME, ''), lx.TRAILING_NOTICE, '')} AS text FROM kept""")
def clean_structure(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("doc_id").cast("string")
    wrapped = F.concat(
        F.lit("intro "), n, F.lit("\n-----\n# Document "), n, F.lit("\n\n \n"), F.col("text"),
        F.lit("\n" + "-" * 80 + "\n\n\n\n# Document 7 (again)\nend of "), n)
    return texts(spark, sf).select("doc_id", c.clean_structure(wrapped).alias("text"))


@query(f"SELECT page_id, trim({s.subs('html', ('<[^>]+>', ' '), ('&[a-z]+;', ' '), (chr(92) + 's+', ' '))}) AS text FROM pages")
def clean_minimal(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).select("page_id", c.clean_minimal("html").alias("text"))


# CJK phrases put into the documents, so that every rule of a language can fire.
def _cjk_case(lang: str) -> str:
    text = "t"
    for rule in lx.CJK_STEPS.get(lang, []):
        text = s.sub(text, rule, "")
    return s.sub(text, r"\s+", " ")


_PHRASES = ("点击查看 A. ", " 登录 & 注册 [12] 答案解析 ", " ログイン 登録 ", " 로그인 가입 ", " 欢迎来到 x 网站 ")


@query(f"""WITH d AS (SELECT doc_id, '{_PHRASES[0]}' || text || '{_PHRASES[1]}' || doc_id || '{_PHRASES[2]}' || '{_PHRASES[3]}' || '{_PHRASES[4]}' AS t,
  CASE doc_id % 4 WHEN 0 THEN 'zh' WHEN 1 THEN 'ja' WHEN 2 THEN 'ko' ELSE 'en' END AS language FROM documents)
SELECT doc_id, language, CASE language WHEN 'zh' THEN {_cjk_case('zh')} WHEN 'ja' THEN {_cjk_case('ja')}
  WHEN 'ko' THEN {_cjk_case('ko')} ELSE {_cjk_case('en')} END AS text FROM d""")
def clean_cjk(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("doc_id")
    language = F.when(n % 4 == 0, "zh").when(n % 4 == 1, "ja").when(n % 4 == 2, "ko").otherwise("en")
    mixed = F.concat(
        F.lit(_PHRASES[0]), F.col("text"), F.lit(_PHRASES[1]), n.cast("string"), *[F.lit(p) for p in _PHRASES[2:]])
    docs = texts(spark, sf).select("doc_id", language.alias("language"), mixed.alias("text"))
    return docs.select("doc_id", "language", c.clean_cjk("text", "language").alias("text"))


@query(f"""WITH x AS (SELECT page_id, {s.subs('html', *[(r, ' ') for r in lx.REMNANT_RULES])} AS t FROM pages)
SELECT page_id, array_to_string(list_filter([{s.strip('l')} for l in string_split(t, chr(10))],
  lambda l: l <> '' AND len(regexp_extract_all(l, '[^\\p{{L}}\\p{{N}}\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]')) / length(l)::DOUBLE <= 0.3
   AND NOT ({" OR ".join(s.found("l", r, "i") for r, _ in lx.PATTERN_FILTER_BOILERPLATE)})), chr(10)) AS text FROM x""")
def remove_remnants(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).select("page_id", remnants("html").alias("text"))


# --- decisions ----------------------------------------------------------------

_DEEP = f"dp AS (SELECT doc_id, {s.clean_deep('text')} AS c FROM documents)"


@query(f"""WITH b AS (WITH {s.quality_cte('documents', 'doc_id', 'text')} SELECT key, quality_score FROM quality), {_DEEP},
a AS (WITH {s.quality_cte('dp', 'doc_id', 'c')} SELECT key, quality_score FROM quality)
SELECT b.key AS doc_id, dp.c AS clean_text, 'deep' AS cleaning_applied, round(b.quality_score, 6) AS quality_before,
  round(a.quality_score, 6) AS quality_after, round(a.quality_score - b.quality_score, 6) + 0.0 AS quality_improvement
FROM b JOIN dp ON dp.doc_id = b.key JOIN a ON a.key = b.key""")
def clean_by_quality(spark: SparkSession, sf: str) -> DataFrame:
    out = by_quality(texts(spark, sf))
    return out.select(
        "doc_id", "clean_text", "cleaning_applied", r6("quality_before"), r6("quality_after"), r6("quality_improvement"))


def noise_cte(name: str, source: str, key: str, text: str, full: bool, sampled: bool = False) -> str:
    """CTEs ending in ``name(key, …)``: the noise analysis of a relation."""
    p = name
    sample = f"""CASE WHEN length({text}) <= 10000 THEN {text} ELSE left({text}, 3333)
      || substr({text}, length({text}) // 2 - 1666 + 1, 3333) || right({text}, 3334) END"""
    if not sampled:
        sample = text
    head, first = ("left(sample, 2000)", "left(sample, 1000)") if sampled else ("sample", "sample")
    within = "least(2000, length(sample))" if sampled else "length(sample)"
    if full:
        reduced = lambda x: f"CASE WHEN length({head}) > 0 THEN (1 - length({x})::DOUBLE / length({head})) * 100 ELSE 0.0 END"
        regular, deep = reduced("basic"), reduced("deep")
    else:
        regular = "least(80.0::DOUBLE, html_ratio * 100 + noise_ratio * 50)"
        deep = f"least(90.0::DOUBLE, {regular} * 1.3::DOUBLE)"
    return f"""{p}_s AS (SELECT {key} AS key, {text} AS t, {sample} AS sample FROM {source} WHERE {text} IS NOT NULL),
{p}_m AS (SELECT key, length(t) AS text_length, length(sample) AS sample_length,
   contains(sample, '<') AND contains(sample, '>') AS has_html,
   CASE WHEN contains(sample, '<') AND contains(sample, '>') THEN
     (CASE WHEN {s.hits(first, '<[^>]+>')} > 0 THEN floor({s.hits('sample', '<')} * ({s.hits(first, '<[^>]+>')} / {s.hits(first, '<')}::DOUBLE))
      ELSE {s.hits('sample', '<')} END) / length(sample)::DOUBLE ELSE 0.0 END AS html_ratio,
   CASE WHEN length(sample) > 0 THEN len(regexp_extract_all({head}, '[^\\p{{L}}\\p{{N}}\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]'))
     / {within}::DOUBLE ELSE 0.0 END AS noise_ratio,
   greatest(1, {s.hits('sample', '[.!?]')}) AS sentence_count,
   {s.hits('sample', chr(92) + 'S+')} / greatest(1, {s.hits('sample', '[.!?]')})::DOUBLE AS avg_sentence_length,
   {f"{s.clean_basic(head)} AS basic, {s.clean_deep(head)} AS deep, sample" if full else "sample"} FROM {p}_s),
{p}_r AS (SELECT *, {regular} AS regular_reduction, {deep} AS deep_reduction FROM {p}_m),
{p} AS (SELECT *, deep_reduction - regular_reduction AS additional_reduction,
   0.15::DOUBLE * least(1.0, text_length / 10000::DOUBLE) + 0.1::DOUBLE * least(1.0, regular_reduction / 100)
   + 0.1::DOUBLE * least(1.0, deep_reduction / 100)
   + 0.2::DOUBLE * (CASE WHEN avg_sentence_length < 50 THEN least(1.0, avg_sentence_length / 20)
                    ELSE 1.0 - least(1.0, (avg_sentence_length - 50) / 100) END)
   + 0.25::DOUBLE * (1.0 - least(1.0, html_ratio)) + 0.2::DOUBLE * (1.0 - least(1.0, noise_ratio * 10)) AS score
 FROM {p}_r)"""


_CHOICE = f"WITH {noise_cte('n', 'pages', 'page_id', 'html', False)}"
_NEEDS_DEEP = "NOT (deep_reduction - regular_reduction < 10 AND regular_reduction > 30)"


@query(f"""{_CHOICE} SELECT page_id, {_NEEDS_DEEP} AS deep_cleaned, CASE WHEN {_NEEDS_DEEP} THEN {s.clean_deep('html')}
  ELSE {s.clean_basic('html')} END AS clean_text FROM pages JOIN n ON n.key = page_id""")
def clean_choice(spark: SparkSession, sf: str) -> DataFrame:
    analysed = with_noise_analysis(pages(spark, sf), "html")
    return clean_from_analysis(analysed, "html").select("page_id", "deep_cleaned", "clean_text")


@query(f"""WITH {noise_cte('n', 'pages', 'page_id', 'html', True)},
t AS (SELECT key, score, CASE WHEN score < 0.7 THEN CASE WHEN {_NEEDS_DEEP} THEN {s.clean_deep('html')} ELSE {s.clean_basic('html')} END END AS c
      FROM n JOIN pages ON page_id = key),
{noise_cte('a', 't', 'key', 'c', True)}
SELECT t.key AS page_id, round(t.score, 6) AS score_before, round(a.score, 6) AS score_after,
  coalesce(a.score > t.score, false) AS was_cleaned, CASE WHEN a.score > t.score THEN c ELSE html END AS clean_text
FROM t LEFT JOIN a ON a.key = t.key JOIN pages ON page_id = t.key""")
def clean_if_better(spark: SparkSession, sf: str) -> DataFrame:
    web = pages(spark, sf).select("page_id", "html")
    return if_better(web, "html").select(
        "page_id", r6("score_before"), r6("score_after"), "was_cleaned", "clean_text")


_NOISE = ["text_length", "sample_length", "has_html", "html_ratio", "noise_ratio", "sentence_count",
          "avg_sentence_length", "regular_reduction", "deep_reduction", "additional_reduction"]
_NOISE_INT = {"text_length", "sample_length", "sentence_count"}


def _noise_select(key: str) -> str:
    cols = [f"{c}::BIGINT AS {c}" if c in _NOISE_INT else c if c == "has_html" else f"round({c}, 6) + 0.0 AS {c}" for c in _NOISE]
    return f"SELECT key AS {key}, {', '.join(cols)}, round(score, 6) AS score FROM n"


def _noise_columns() -> list:
    return [F.col(x).cast("long").alias(x) if x in _NOISE_INT else F.col(x) if x == "has_html" else r6(x) for x in _NOISE]


# The sampled form, asked for by name.
@query(f"WITH {noise_cte('n', 'documents', 'doc_id', 'text', False, sampled=True)} {_noise_select('doc_id')}")
def noise_sample(spark: SparkSession, sf: str) -> DataFrame:
    return with_noise_analysis(texts(spark, sf), sampled=True).select("doc_id", *_noise_columns(), r6(composite_score(), "score"))


@query(f"WITH {noise_cte('n', 'documents', 'doc_id', 'text', False)} {_noise_select('doc_id')}")
def noise_whole(spark: SparkSession, sf: str) -> DataFrame:
    return with_noise_analysis(texts(spark, sf)).select("doc_id", *_noise_columns(), r6(composite_score(), "score"))


@query(f"WITH {noise_cte('n', 'pages', 'page_id', 'html', True)} {_noise_select('page_id')}")
def noise_full_pages(spark: SparkSession, sf: str) -> DataFrame:
    return with_noise_analysis(pages(spark, sf), "html", full=True).select(
        "page_id", *_noise_columns(), r6(composite_score(), "score"))


@query(f"""WITH {noise_cte('n', 'documents', 'doc_id', 'text', False)}
SELECT d.source, sum(text_length)::BIGINT AS original_chars, round(sum(text_length * (1 - regular_reduction / 100)), 2) AS regular_chars,
  round(sum(text_length * (1 - deep_reduction / 100)), 2) AS deep_chars, round(avg(score), 6) AS overall_score,
  round(avg(1.0 - html_ratio), 6) AS html_cleanliness,
  round(avg(CASE WHEN avg_sentence_length < 50 THEN least(1.0, avg_sentence_length / 20) ELSE 1.0 - least(1.0, (avg_sentence_length - 50) / 100) END), 6) AS text_quality,
  round(avg(1.0 - least(1.0, noise_ratio * 10)), 6) AS noise_level
FROM n JOIN documents d ON d.doc_id = n.key GROUP BY d.source""")
def size_reduction(spark: SparkSession, sf: str) -> DataFrame:
    from lexmill.operators.reports import size_reduction_report

    docs = table(spark, sf, "documents").select("source", "text")
    report = size_reduction_report(with_noise_analysis(docs), ["source"])
    return report.select(
        "source", "original_chars", F.round("regular_chars", 2).alias("regular_chars"),
        F.round("deep_chars", 2).alias("deep_chars"), r6("overall_score"), r6("html_cleanliness"),
        r6("text_quality"), r6("noise_level"))
