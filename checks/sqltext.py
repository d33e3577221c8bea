"""SQL building blocks of the oracles (DuckDB, RE2 regular expressions)."""

from __future__ import annotations

from lexmill.functions import lexicon as lx

WS = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
NWS = r"[^\s\x0B\x1C-\x1F\x{85}\p{Z}]"
W = r"[\p{L}\p{N}_]"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def re2(rule: str, flags: str = "") -> str:
    """A rule with short classes as an RE2 literal with Unicode classes."""
    out, in_class, i = "", False, 0
    inner = {"s": r"\s\x0B\x1C-\x1F\x{85}\p{Z}", "w": r"\p{L}\p{N}_", "d": r"\p{Nd}"}
    while i < len(rule):
        two = rule[i:i + 2]
        if two[0] == "\\" and two[1:] in inner:
            out += inner[two[1]] if in_class else "[" + inner[two[1]] + "]"
            i += 2
        elif two == r"\S":
            out += NWS
            i += 2
        elif two[0] == "\\":
            out += two
            i += 2
        else:
            in_class = {"[": True, "]": False}.get(two[0], in_class)
            out += two[0]
            i += 1
    return lit((f"(?{flags})" if flags else "") + out)


def found(text: str, rule: str, flags: str = "") -> str:
    return f"regexp_matches({text}, {re2(rule, flags)})"


def hits(text: str, rule: str, flags: str = "") -> str:
    return f"len(regexp_extract_all({text}, {re2(rule, flags)}))"


def sub(text: str, rule: str, by: str, flags: str = "") -> str:
    return f"regexp_replace({text}, {re2(rule, flags)}, {lit(by)}, 'g')"


def subs(text: str, *steps: tuple[str, str]) -> str:
    for rule, by in steps:
        text = sub(text, rule, by)
    return text


def strip(text: str) -> str:
    return sub(text, r"^\s+|\s+$", "")


def html_text(html: str) -> str:
    """Visible text; blocks go one tag at a time, head first (RE2 has no back-references)."""
    body = f"(CASE WHEN {found(html, '<body[^>]*>.*?</body>', 'is')} THEN regexp_extract({html}, " \
           f"{re2('<body[^>]*>(.*?)</body>', 'is')}, 1) ELSE {html} END)"
    for tag in ["head", "script", "style", "noscript", "iframe", "footer", "nav"]:
        body = sub(body, f"<{tag}[^>]*>.*?</{tag}>", " ", "is")
    text = sub(body, r"<[^>]+>", " ")
    text = f"trim({sub(text, chr(92) + 's+', ' ')})"
    return sub(text, r"[\x00-\x08\x0B-\x1F]", "")


def language_cte(source: str, key: str, text: str) -> str:
    """CTEs ending in ``lang(key, language, confidence)`` over a relation (key, text)."""
    rows = ", ".join(
        f"({i}, {lit(lang)}, {lit(ch)}, {share}, {len(sig)})"
        for i, (lang, sig) in enumerate(lx.LANGUAGE_SIGNATURES.items()) for ch, share in sig.items()
    )
    skipped = lit("0123456789.,!?;:()[]{}\"'`~@#$%^&*_+-=<>|\\/")
    scripts = {"zh": "[\\x{4E00}-\\x{9FFF}]", "ja": "[\\x{3040}-\\x{30FF}]",
               "ko": "[\\x{AC00}-\\x{D7A3}]", "ar": "[\\x{0600}-\\x{06FF}]"}
    over = ", ".join(f"{hits('t', r)} > 10 AND coalesce(s_{c}, 0) > 0 AS o_{c}" for c, r in scripts.items())
    return f"""
  src AS (SELECT {key} AS k, {text} AS t FROM {source}),
  ch AS (SELECT k, c, count(*) AS n FROM (
           SELECT k, unnest(regexp_extract_all(lower(t), '(?s).')) AS c FROM src WHERE length(t) >= 100)
         WHERE NOT regexp_matches(c, {re2(chr(92) + 's')}) AND NOT contains({skipped}, c) GROUP BY k, c),
  tot AS (SELECT k, sum(n) AS total FROM ch GROUP BY k),
  sig(rank, lang, c, share, size) AS (VALUES {rows}),
  per AS (SELECT ch.k, lang, any_value(rank) AS rank,
                 sum(1.0::DOUBLE - least(abs(n / total * 100.0 - share) / share, 1.0)) / any_value(size)
                 * (count(*) / any_value(size)::DOUBLE) AS score
          FROM ch JOIN tot ON ch.k = tot.k JOIN sig ON sig.c = ch.c GROUP BY ch.k, lang),
  best AS (SELECT k, arg_min(lang, struct_pack(a := -round(score, 12), b := rank)) AS lang, max(score) AS score,
                  {", ".join(f"max(score) FILTER (lang = '{c}') AS s_{c}" for c in scripts)}
           FROM per WHERE score > 0 GROUP BY k),
  over AS (SELECT src.k, best.lang, best.score, total, {", ".join("s_" + c for c in scripts)}, {over}
           FROM src LEFT JOIN tot ON src.k = tot.k LEFT JOIN best ON src.k = best.k),
  lang AS (SELECT k, CASE WHEN total IS NULL THEN 'unknown' WHEN o_ar THEN 'ar' WHEN o_ko THEN 'ko'
                     WHEN o_ja THEN 'ja' WHEN o_zh THEN 'zh' ELSE coalesce(lang, 'unknown') END AS language,
           coalesce(least(greatest(score, CASE WHEN o_zh THEN s_zh + 0.3 ELSE 0 END, CASE WHEN o_ja THEN s_ja + 0.3 ELSE 0 END,
             CASE WHEN o_ko THEN s_ko + 0.3 ELSE 0 END, CASE WHEN o_ar THEN s_ar + 0.3 ELSE 0 END), 1.0), 0.0) AS confidence
           FROM over)"""


def _summed(text: str, rules: list[str], flags: str) -> str:
    return "(" + " + ".join(hits(text, r, flags) for r in rules) + ")"


def _per_language(lang: str, parts: dict[str, str]) -> str:
    return "(CASE " + " ".join(f"WHEN {lang} = '{c}' THEN {x}" for c, x in parts.items()) + " ELSE 0 END)"


def quality_cte(source: str, key: str, text: str, language: str | None = None) -> str:
    """CTEs ending in ``quality(key, text, …)`` over a relation; short texts have score 0."""
    lang = language_cte(source, key, text) if language is None else \
        f"lang AS (SELECT {key} AS k, {lit(language)} AS language FROM {source})"
    bp = _summed("t", lx.BOILERPLATE_COMMON, "i") + " + " + _per_language(
        "language", {c: _summed("t", r, "i") for c, r in lx.BOILERPLATE_BY_LANGUAGE.items()})
    q = _summed("t", lx.QUESTION_COMMON, "m") + " + " + _per_language(
        "language", {c: _summed("t", r, "m") for c, r in lx.QUESTION_BY_LANGUAGE.items()})
    ch = _summed("t", lx.CHOICE_COMMON, "m") + " + " + _per_language(
        "language", {c: _summed("t", r, "m") for c, r in lx.CHOICE_BY_LANGUAGE.items()})
    return f"""{lang},
  doc AS (SELECT {key} AS k, {text} AS t, length({text}) AS n, language
          FROM {source} JOIN lang ON lang.k = {key} WHERE length({text}) >= 10),
  wc AS (SELECT k, w, count(*) AS c FROM (
           SELECT k, unnest(regexp_extract_all(lower(t), '{W}+')) AS w FROM doc) GROUP BY k, w),
  wr AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY c DESC, w) AS rn FROM wc),
  ws AS (SELECT k, sum(c) AS words, count(*) AS uniq, sum(c) FILTER (rn <= 5) AS top5 FROM wr GROUP BY k),
  ln AS (SELECT k, count(*) AS full_lines, sum(length(l)) AS chars,
                count(*) FILTER (length(s) < 40) AS short_lines, count(*) FILTER (length(s) > 300) AS long_lines
         FROM (SELECT k, l, {strip("l")} AS s FROM (SELECT k, unnest(string_split(t, chr(10))) AS l FROM doc))
         WHERE s <> '' GROUP BY k),
  cnt AS (SELECT k, ({bp})::DOUBLE AS bp, {hits("t", "</?[a-z]+>|&[a-z]+;", "i")}::DOUBLE AS html,
                 ({q})::DOUBLE AS q, ({ch})::DOUBLE AS ch FROM doc),
  ind AS (SELECT doc.k, t, n AS length, length(t) - length(replace(t, chr(10), '')) + 1 AS line_count,
            {hits("t", chr(92) + "w+")} AS word_count, language,
            coalesce(uniq / words::DOUBLE, 0.0) AS lexical_diversity,
            coalesce(top5 / words::DOUBLE, 1.0) AS top5_concentration,
            coalesce(chars / full_lines::DOUBLE, 0.0) AS avg_line_length,
            coalesce(short_lines / full_lines::DOUBLE, 1.0) AS short_line_ratio,
            coalesce(long_lines / full_lines::DOUBLE, 0.0) AS long_line_ratio,
            least(1.0, bp / greatest(1.0, n / 1000::DOUBLE)) AS boilerplate_density,
            least(1.0, html / greatest(1.0, n / 100::DOUBLE)) AS html_density,
            least(1.0, q / greatest(1, coalesce(full_lines, 0))) AS question_density,
            least(1.0, ch / greatest(1, coalesce(full_lines, 0))) AS choice_density,
            CASE WHEN q > 1 AND ch > 1 THEN least(1.0, q * ch / (full_lines * full_lines)) ELSE 0.0 END
              AS exam_content_likelihood
          FROM doc LEFT JOIN ws ON ws.k = doc.k LEFT JOIN ln ON ln.k = doc.k JOIN cnt ON cnt.k = doc.k),
  scored AS (SELECT *, greatest(0.0, least(1.0,
              0.5::DOUBLE + 0.25::DOUBLE * lexical_diversity - 0.10::DOUBLE * top5_concentration
              + 0.05::DOUBLE * (CASE WHEN avg_line_length BETWEEN 40 AND 200
                                THEN 1.0::DOUBLE - abs(avg_line_length - 120) / 120 ELSE 0.2::DOUBLE END)
              - 0.10::DOUBLE * short_line_ratio - 0.05::DOUBLE * long_line_ratio
              - 0.20::DOUBLE * boilerplate_density - 0.10::DOUBLE * html_density
              - 0.05::DOUBLE * question_density - 0.05::DOUBLE * choice_density
              - 0.10::DOUBLE * exam_content_likelihood)) AS quality_score FROM ind),
  quality AS (SELECT {key} AS key, {text} AS text, length({text}) AS n_chars, scored.* EXCLUDE (k, t, quality_score),
                coalesce(quality_score, 0.0) AS quality_score,
                CASE WHEN quality_score >= 0.8 THEN 'high' WHEN quality_score >= 0.5 THEN 'medium'
                     WHEN quality_score >= 0.3 THEN 'low' WHEN quality_score IS NOT NULL THEN 'very_low' END
                  AS quality_category
              FROM {source} LEFT JOIN scored ON scored.k = {key})"""


FILTER_REASON = """CASE WHEN n_chars < 50 THEN 'too_short' WHEN exam_content_likelihood > 0.5 THEN 'exam_content'
    WHEN boilerplate_density > 0.3 THEN 'boilerplate' WHEN lexical_diversity < 0.3 AND n_chars > 200 THEN 'low_diversity'
    WHEN html_density > 0.2 THEN 'html_artifacts' WHEN quality_score < 0.3 THEN 'low_score' END"""


def clean_basic(text: str) -> str:
    t = subs(text, (r"\s+", " "), (r"https?://\S+", ""), (r"www\.\S+", ""), (r"&[a-z]+;", " "))
    return f"(CASE WHEN length(trim({t})) > 5 THEN {t} ELSE '' END)"


def clean_basic_lines(text: str) -> str:
    t = subs(text, (r"[\t\x0B\f\r\x1C-\x1F \x{85}\p{Zs}\x{2028}\x{2029}]+", " "), (r"https?://\S+", ""),
             (r"www\.\S+", ""), (r"&[a-z]+;", " "))
    return f"array_to_string(list_filter(string_split({t}, chr(10)), lambda l: length(trim(l)) > 5), chr(10))"


def special_chars(text: str) -> str:
    return subs(
        text, (r"[\w.+-]+@[\w-]+\.[\w.-]+", ""), (r"[^\w\s.,!?;:'" + '"' + r"-]", " "),
        *[(re_ch + "+", ch) for re_ch, ch in [(r"\.", "."), (",", ","), ("!", "!"), (r"\?", "?"), (";", ";"), (":", ":")]],
        (r" +", " "))


def content_line(line: str) -> str:
    terms = " OR ".join(f"contains({line}, {lit(t)})" for t in lx.NOISE_TERMS)
    return f"""NOT ((regexp_matches({line}, '\\p{{Lu}}') AND NOT regexp_matches({line}, '[\\p{{Ll}}\\p{{Lt}}]') AND length({line}) > 10)
      OR {hits(line, chr(92) + "d")} > length({line}) * 0.5 OR {found(line, "^[A-D][" + chr(92) + "s.、:：]+")}
      OR ({found(line, "^" + chr(92) + "d+[" + chr(92) + "s.、:：]+")} AND length({line}) < 30) OR {terms})"""


def boilerplate_line(line: str) -> str:
    return "(" + " OR ".join(found(line, r, "i") for r in lx.BOILERPLATE_LINE_RULES) + ")"


def substantial_line(line: str) -> str:
    return f"""(length({line}) >= 20 AND NOT {found(line, "^[^，。！？,.!?]{1,10}$")}
      AND NOT {found(line, "^" + chr(92) + "s*[" + chr(92) + "-*•◦]" + chr(92) + "s+" + chr(92) + "w+$")}
      AND {found(line, chr(92) + "s")})"""


def clean_deep(text: str) -> str:
    """Deep cleaning of one line (non-CJK), from the steps one after the other."""
    return f"""(SELECT CASE WHEN x = '' OR NOT ({content_line("x")}) OR {boilerplate_line("x")} THEN '' ELSE x END
      FROM (SELECT trim({special_chars("b")}) AS x FROM (SELECT {clean_basic(text)} AS b)))"""
