"""Document quality: indicators, score, category and issue flags (row-wise)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import lexicon as lx
from lexmill.functions import patterns as rx
from lexmill.functions import tokens
from lexmill.functions.language import BEYOND_LATIN, LATIN, detect_language

INDICATORS = list(lx.QUALITY_WEIGHTS)
QUALITY_COLUMNS = [
    "length", "line_count", "word_count", "language", *INDICATORS, "quality_score", "quality_category",
]

# What each output column is computed from.
_NEEDS = {
    "length": set(), "line_count": set(), "language": {"language"},
    "word_count": {"words"}, "lexical_diversity": {"words"}, "top5_concentration": {"words"},
    "avg_line_length": {"lines"}, "short_line_ratio": {"lines"}, "long_line_ratio": {"lines"},
    "boilerplate_density": {"language", "boilerplate"}, "html_density": {"html"},
    "question_density": {"language", "lines", "questions"}, "choice_density": {"language", "lines", "choices"},
    "exam_content_likelihood": {"language", "lines", "questions", "choices"},
}
_NEEDS["quality_score"] = set().union(*(_NEEDS[c] for c in INDICATORS))
_NEEDS["quality_category"] = _NEEDS["quality_score"]


def boilerplate_matches(text: Column, low: Column, language: Column) -> Column:
    """Number of boilerplate phrases, common and of the language."""
    own = rx.guarded_rules_of(language, lx.BOILERPLATE_BY_LANGUAGE)
    return rx.sum_guarded(text, low, rx.guarded_rules(lx.BOILERPLATE_COMMON)) + rx.sum_guarded(text, low, own)


def _structure_matches(text: Column, language: Column, common: list[str], own: dict[str, list[str]]) -> Column:
    by_language = None
    for code, rules in own.items():
        hits = rx.sum_line_rules(text, rules)
        by_language = F.when(language == code, hits) if by_language is None else by_language.when(language == code, hits)
    return rx.sum_line_rules(text, common) + F.coalesce(by_language, F.lit(0))


def question_matches(text: Column, language: Column) -> Column:
    return _structure_matches(text, language, lx.QUESTION_COMMON, lx.QUESTION_BY_LANGUAGE)


def choice_matches(text: Column, language: Column) -> Column:
    return _structure_matches(text, language, lx.CHOICE_COMMON, lx.CHOICE_BY_LANGUAGE)


def html_matches(text: Column) -> Column:
    return F.when(
        text.contains("<") | text.contains("&"), rx.count_matches(text, r"</?[a-z]+>|&[a-z]+;", ignore_case=True),
    ).otherwise(F.lit(0))


def quality_score(value: dict[str, Column]) -> Column:
    """Weighted sum of the indicators, in [0, 1]."""
    length = value["avg_line_length"]
    shaped = F.when(length.between(40, 200), F.lit(1.0) - F.abs(length - 120) / 120).otherwise(F.lit(0.2))
    terms = [
        F.lit(w) * (shaped if name == "avg_line_length" else value[name]) for name, w in lx.QUALITY_WEIGHTS.items()
    ]
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), rx.total([F.lit(lx.QUALITY_BASE), *terms])))


def quality_category(score: Column | str) -> Column:
    s, limits = rx.as_col(score), lx.QUALITY_THRESHOLDS
    return (
        F.when(s >= limits["high"], "high")
        .when(s >= limits["medium"], "medium")
        .when(s >= limits["low"], "low")
        .when(s.isNotNull(), "very_low")
    )


def rules_may_differ(text: Column, low: Column) -> Column:
    """False where no language has a rule of its own that the text meets, so that its language decides nothing.

    Other than Latin scripts may do; the rules of languages in Latin script are tried.
    """
    found = [text.rlike(BEYOND_LATIN)]
    for code in LATIN:
        if code in lx.BOILERPLATE_BY_LANGUAGE:
            found.append(rx.sum_guarded(text, low, rx.guarded_rules(lx.BOILERPLATE_BY_LANGUAGE[code]), once=True) > 0)
        found += [rx.matches(text, r, multiline=True) for t in (lx.QUESTION_BY_LANGUAGE, lx.CHOICE_BY_LANGUAGE) for r in t.get(code, [])]
    return rx.any_of(found)


def word_stats(text: Column | str) -> Column:
    """What :func:`quality` counts of the words of a text, to be passed to it; null for texts that it does not score."""
    return rx.let(rx.as_col(text), lambda t: F.when(F.length(t) >= 10, _word_stats(t, F.lower(t))))


def _word_stats(text: Column, low: Column) -> Column:
    """struct(n, distinct, top5, spelled): word count, distinct words, top-5 sum, words as spelled."""
    # lower() splits a word only at the dotted capital I; elsewhere both counts agree.
    return rx.let(tokens.words(low), lambda w: rx.let(tokens.run_lengths(w), lambda c: F.struct(
        F.size(w).alias("n"), F.size(c).alias("distinct"), tokens.top_sum(c).alias("top5"),
        F.when(text.contains("\u0130"), F.size(tokens.words(text))).otherwise(F.size(w)).alias("spelled"),
    )))


def _line_stats(text: Column) -> Column:
    """struct(n, chars, short, long) over the non-blank lines."""
    full = F.filter(tokens.lines(text), lambda x: rx.strip(x) != "")
    return rx.let(full, lambda f: rx.let(F.transform(f, lambda x: F.length(rx.strip(x))), lambda n: F.struct(
        F.size(f).alias("n"),
        tokens.array_sum(F.transform(f, F.length)).alias("chars"),
        F.size(F.filter(n, lambda x: x < 40)).alias("short"),
        F.size(F.filter(n, lambda x: x > 300)).alias("long"),
    )))


def quality(
    text: Column | str, language: Column | str | None = None, columns: Sequence[str] = QUALITY_COLUMNS,
    language_chars: int | None = None, words: Column | None = None,
) -> Column:
    """Struct of quality columns of a text; only what they need is computed.

    ``language`` is a column; without it a text is identified, by its first
    ``language_chars`` characters only if that is given, and only where its language is
    asked for or decides about a rule.  ``words`` are the :func:`word_stats` of the text, if
    known.  Texts under 10 characters get score 0 and nulls.
    """
    columns = list(columns)
    needs = set().union(*(_NEEDS[c] for c in columns))
    types = {"language": "string", "quality_category": "string", "length": "int", "line_count": "int", "word_count": "int"}

    def indicators(s: Column) -> dict[str, Column]:
        t = s["t"]
        n = F.length(t)
        per = lambda hits, floor: F.least(F.lit(1.0), hits / floor)
        v: dict[str, Column] = {"length": n, "line_count": F.size(tokens.lines(t))}
        if "language" in needs:
            v["language"] = s["language"]
        if "words" in needs:
            w = s["words"]
            v["word_count"] = w["spelled"]
            v["lexical_diversity"] = F.when(w["n"] > 0, w["distinct"] / w["n"]).otherwise(F.lit(0.0))
            v["top5_concentration"] = F.when(w["n"] > 0, w["top5"] / w["n"]).otherwise(F.lit(1.0))
        if "lines" in needs:
            ln = s["lines"]
            v["avg_line_length"] = F.when(ln["n"] > 0, ln["chars"] / ln["n"]).otherwise(F.lit(0.0))
            v["short_line_ratio"] = F.when(ln["n"] > 0, ln["short"] / ln["n"]).otherwise(F.lit(1.0))
            v["long_line_ratio"] = F.when(ln["n"] > 0, ln["long"] / ln["n"]).otherwise(F.lit(0.0))
            per_line = F.greatest(F.lit(1), ln["n"])
        if "boilerplate" in needs:
            v["boilerplate_density"] = per(s["boilerplate"], F.greatest(F.lit(1.0), n / 1000))
        if "html" in needs:
            v["html_density"] = per(s["html"], F.greatest(F.lit(1.0), n / 100))
        if "questions" in needs:
            v["question_density"] = per(s["questions"], per_line)
        if "choices" in needs:
            v["choice_density"] = per(s["choices"], per_line)
        if {"questions", "choices"} <= needs:
            q, c, lines = s["questions"], s["choices"], s["lines"]["n"].cast("double")
            v["exam_content_likelihood"] = F.when(
                (q > 1) & (c > 1), per(q.cast("double") * c, lines * lines)).otherwise(F.lit(0.0))
        return v

    def finish(s: Column) -> Column:
        v = indicators(s)
        wants_score = {"quality_score", "quality_category"} & set(columns)
        plain = {c: v[c] for c in (set(columns) | set(INDICATORS if wants_score else [])) & set(v)}

        def scored(i: Column) -> Column:
            score = quality_score({c: i[c] for c in INDICATORS}) if wants_score else F.lit(None)
            return rx.let(score, lambda q: F.struct(*[
                (q if c == "quality_score" else quality_category(q) if c == "quality_category" else i[c]).alias(c)
                for c in columns
            ]))

        return rx.bind(plain, scored) if plain else scored(s)

    def blocks(s: Column) -> Column:
        t, low, lang = s["t"], s["low"], s["language"]
        b: dict[str, Column] = {"t": t, "language": lang}
        if "words" in needs:
            b["words"] = _word_stats(t, low) if words is None else s["counted"]
        if "lines" in needs:
            b["lines"] = _line_stats(t)
        if "boilerplate" in needs:
            b["boilerplate"] = boilerplate_matches(t, low, lang)
        if "html" in needs:
            b["html"] = html_matches(t)
        if "questions" in needs:
            b["questions"] = question_matches(t, lang)
        if "choices" in needs:
            b["choices"] = choice_matches(t, lang)
        return rx.bind(b, finish)

    def start(s: Column) -> Column:
        t = s["t"]
        low = F.lower(t) if needs & {"words", "boilerplate"} else F.lit(None).cast("string")
        return rx.bind({"t": t, "low": low, "given": s["given"], "counted": s["counted"]}, identified)

    def identified(s: Column) -> Column:
        t = s["t"]
        if "language" not in needs:
            lang = F.lit(None).cast("string")
        elif language is None:
            lang = detect_language(t if language_chars is None else F.substring(t, 1, language_chars))["language"]
            if "language" not in columns and "boilerplate" in needs:
                lang = F.when(rules_may_differ(t, s["low"]), lang)
        else:
            lang = s["given"]
        return rx.bind({"t": t, "low": s["low"], "language": lang, "counted": s["counted"]}, blocks)

    empty = F.struct(*[
        (F.lit(0.0) if c == "quality_score" else F.lit(None).cast(types.get(c, "double"))).alias(c) for c in columns
    ])
    given = F.lit(None).cast("string") if language is None else rx.as_col(language)
    return rx.bind(
        {"t": rx.as_col(text), "given": given, "counted": F.lit(None) if words is None else words}, lambda s: F.when(F.length(s["t"]) >= 10, start(s)).otherwise(empty))


def with_quality(
    df: DataFrame,
    text: str = "text",
    language: Column | str | None = None,
    prefix: str = "",
    columns: Sequence[str] = QUALITY_COLUMNS,
) -> DataFrame:
    """Add quality columns, evaluated once per row; see :func:`quality`.

    ``prefix`` goes before every output column.
    """
    names = {c: prefix + c for c in columns}
    made = rx.add_once(df, {f"_{prefix}quality": quality(text, language, columns)})
    kept = [c for c in df.columns if c not in names.values()]
    return made.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"_{prefix}quality.{c}").alias(n) for c, n in names.items()])


FILTER_COLUMNS = [
    "exam_content_likelihood", "boilerplate_density", "lexical_diversity", "html_density", "quality_score",
]


def filter_reason(text: Column, q: Column) -> Column:
    """Why a document with the quality struct ``q`` is dropped; null if it is kept.  First rule wins."""
    lim = lx.FILTER_THRESHOLDS
    n = F.length(text)
    return (
        F.when(n.isNull() | (n < lim["min_length"]), "too_short")
        .when(q["exam_content_likelihood"] > lim["exam"], "exam_content")
        .when(q["boilerplate_density"] > lim["boilerplate"], "boilerplate")
        .when((q["lexical_diversity"] < lim["diversity"]) & (n > lim["diversity_min_length"]), "low_diversity")
        .when(q["html_density"] > lim["html"], "html_artifacts")
        .when(q["quality_score"] < lim["score"], "low_score")
    )


PARAGRAPH_COLUMNS = ["paragraph_count", "avg_paragraph_length", "paragraph_repetition"]


def paragraph_metrics(text: Column | str) -> Column:
    """struct(paragraph_count, avg_paragraph_length, paragraph_repetition); nulls without a paragraph."""

    def stats(p: Column) -> Column:
        some = F.size(p) > 0
        prints = F.transform(F.filter(p, lambda x: F.length(x) >= 50), lambda x: F.lower(F.substring(x, 1, 50)))

        def repetition(f: Column) -> Column:
            # Sum of (count - 1) over the fingerprints = all minus distinct.
            share = (F.size(f) - F.size(F.array_distinct(f))) / F.greatest(F.lit(1), F.size(f) - 1)
            return F.when(some & (F.size(p) > 1) & (F.size(f) > 0), share).when(some, F.lit(0.0))

        return F.struct(
            F.when(some, F.size(p)).alias("paragraph_count"),
            F.when(some, tokens.array_sum(F.transform(p, F.length)) / F.size(p)).alias("avg_paragraph_length"),
            rx.let(prints, repetition).alias("paragraph_repetition"),
        )

    return rx.let(F.filter(F.split(rx.as_col(text), "\n\n"), lambda x: rx.strip(x) != ""), stats)


def with_paragraph_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    made = rx.add_once(df, {"_pm": paragraph_metrics(text)})
    return made.select("*", "_pm.*").drop("_pm")


ISSUE_COLUMNS = ["exam_content", "excessive_boilerplate", "excessive_formatting", "machine_generated", "highly_repetitive"]


def issue_flags(text: Column | str, language: Column | str) -> Column:
    """Struct of five issue flags and ``should_filter``, their disjunction."""

    def phrases(s: Column, table: dict[str, list[str]], common: str) -> Column:
        own = rx.guarded_rules_of(s["lang"], {code: ps for code, ps in table.items() if code != "common"})
        shared = rx.guarded_rules(table[common])
        return rx.sum_guarded(s["t"], s["low"], shared, once=True) + rx.sum_guarded(s["t"], s["low"], own, once=True)

    def uneven(lens: Column) -> Column:
        """False where sentence lengths vary little around a mean above 20."""
        n = F.size(lens)

        def by_mean(mean: Column) -> Column:
            squares = F.aggregate(lens, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
            return (n > 5) & (mean > 20) & (F.sqrt(squares / n) < mean * 0.3)

        return rx.let(tokens.array_sum(lens) / n, by_mean)

    def flags(s: Column) -> Column:
        t = s["t"]
        formatting = rx.total([
            F.when(t.contains(mark), rx.count_matches(t, r, ignore_case=True)).otherwise(F.lit(0))
            for mark, r in zip("<&[", lx.FORMATTING_RULES)
        ])
        lens = F.transform(F.split(t, "[.!?。！？]+", -1), F.length)
        repetitive = rx.let(tokens.words(s["low"]), lambda w: (F.size(w) > 50) & (
            F.size(F.array_distinct(w)) / F.size(w) < 0.3))
        return F.struct(
            # English phrases count for every language, and so twice for English.  Three option
            # marks anywhere are the same as mark, anything, mark, anything, mark.
            ((phrases(s, lx.EXAM_PHRASES, "en") >= 2) | (rx.count_matches(t, r"[A-D]\.") >= 3)).alias("exam_content"),
            (phrases(s, lx.ISSUE_BOILERPLATE, "common") >= 3).alias("excessive_boilerplate"),
            (formatting > F.length(t) * 0.02).alias("excessive_formatting"),
            rx.let(lens, uneven).alias("machine_generated"),
            repetitive.alias("highly_repetitive"),
        )

    def with_verdict(f: Column) -> Column:
        return F.struct(*[f[c].alias(c) for c in ISSUE_COLUMNS], rx.any_of([f[c] for c in ISSUE_COLUMNS]).alias("should_filter"))

    return rx.let(
        rx.bind({"t": rx.as_col(text), "low": F.lower(text), "lang": rx.as_col(language)}, flags), with_verdict)


def with_issue_flags(df: DataFrame, text: str = "text", language: Column | str = "language") -> DataFrame:
    """Add the issue flags and ``should_filter``, evaluated once per row."""
    made = rx.add_once(df, {"_issues": issue_flags(text, language)})
    return made.select("*", "_issues.*").drop("_issues")
