"""Language and script identification by character statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import lexicon as lx
from lexmill.functions import patterns as rx

LATIN = ["en", "es", "fr", "de"]
_OTHER = [lang for lang in lx.LANGUAGE_SIGNATURES if lang not in LATIN]
#: Only a text with such a character can be of one of the others.
BEYOND_LATIN = r"[\x{0400}-\x{FFFF}]"
#: Runs of what counts as a letter: anything but white space and the listed characters.
_LETTERS = "[a-z[^" + rx.SPACE_SET + "".join("\\" + c if not c.isalnum() else c for c in lx.NON_LETTERS) + "]]++"


def _signature_scores(low: Column, n: Column, languages: list[str]) -> Column:
    """Array of closeness scores to the signatures, each in [0, 1].

    A score is the mean closeness of the character shares times the share of
    signature characters that occur.  An absent character has share 0, hence
    closeness 0.
    """
    signatures = [lx.LANGUAGE_SIGNATURES[lang] for lang in languages]
    chars = sorted({ch for sig in signatures for ch in sig})
    # Byte lengths are known without a scan.
    counts = F.transform(rx.text_array(chars), lambda ch: (
        F.octet_length(low) - F.octet_length(F.replace(low, ch, F.lit("")))) / F.octet_length(ch))
    table = F.expr("array(" + ", ".join(
        "array(" + ", ".join(f"named_struct('at', {chars.index(ch)}, 'share', {share}D)" for ch, share in sig.items()) + ")"
        for sig in signatures) + ")")

    def score(sig: Column, c: Column) -> Column:
        k = F.size(sig).cast("double")
        closeness = F.aggregate(sig, F.lit(0.0), lambda a, e: a + (
            F.lit(1.0) - F.least(F.abs(F.get(c, e["at"]) / n * 100.0 - e["share"]) / e["share"], F.lit(1.0))))
        present = F.size(F.filter(sig, lambda e: F.get(c, e["at"]) > 0))
        return closeness / k * (present / k)

    return rx.let(counts, lambda c: F.transform(table, lambda sig: score(sig, c)))


def detect_language(text: Column | str, min_length: int = 100) -> Column:
    """struct(language, confidence, all_scores) of a text.

    Texts under ``min_length`` characters, or without letters, are ``unknown``.
    Pass ``substring(text, 1, n)`` to identify by a prefix.
    """
    codes = LATIN + _OTHER
    scripts = list(lx.SCRIPT_OVERRIDES)

    def result(language: Column, confidence: Column, scores: Column | None) -> Column:
        named = F.lit(None).cast("map<string,double>") if scores is None else F.map_from_arrays(rx.text_array(codes), scores)
        return F.struct(language.alias("language"), confidence.alias("confidence"), named.alias("all_scores"))

    unknown = result(F.lit("unknown"), F.lit(0.0), None)

    def decide(s: Column) -> Column:
        scores, hits = s["scores"], s["hits"]
        language = None
        boosted = [F.array_max(scores)]
        # Later scripts override earlier ones.
        for code in reversed(scripts):
            own = F.get(scores, F.lit(codes.index(code)))
            hit = (F.get(hits, F.lit(scripts.index(code))) > lx.SCRIPT_OVERRIDE_MIN) & (own > 0)
            language = F.when(hit, code) if language is None else language.when(hit, code)
            boosted.append(F.when(hit, own + lx.SCRIPT_BONUS))
        best = boosted[0]
        language = language.when(best <= 0, "unknown").otherwise(
            F.element_at(rx.text_array(codes), F.array_position(scores, best).cast("int")))
        return result(language, F.least(F.greatest(*boosted), F.lit(1.0)), scores)

    def scored(s: Column) -> Column:
        # Only texts with characters beyond Latin letters pay for the other signatures.
        others = F.when(s["other"], _signature_scores(s["low"], s["n"], _OTHER)).otherwise(
            F.array_repeat(F.lit(0.0), len(_OTHER)))
        hits = F.when(
            s["other"],
            F.array(*[F.regexp_count(s["t"], F.lit(r)) for r in lx.SCRIPT_OVERRIDES.values()]),
        ).otherwise(F.array_repeat(F.lit(0), len(scripts)))
        values = {"scores": F.concat(_signature_scores(s["low"], s["n"], LATIN), others), "hits": hits}
        return F.when(s["n"] > 0, rx.bind(values, decide)).otherwise(unknown)

    def lettered(t: Column) -> Column:
        return rx.let(F.lower(t), lambda low: rx.bind(
            {"t": t, "low": low, "other": t.rlike(BEYOND_LATIN),
             "n": F.length(low) - F.length(F.regexp_replace(low, _LETTERS, ""))}, scored))

    return rx.let(
        F.coalesce(rx.as_col(text), F.lit("")),
        lambda t: F.when(F.length(t) < min_length, unknown).otherwise(lettered(t)),
    )


def with_language(df: DataFrame, text: Column | str = "text", out: str = "language", min_length: int = 100) -> DataFrame:
    """Add ``out``: the language result struct, evaluated once per row."""
    return rx.add_once(df, {out: detect_language(text, min_length)})


def _head(text: Column | str, chars: int | None) -> Column:
    return rx.as_col(text) if chars is None else F.substring(rx.as_col(text), 1, chars)


def script_guess(text: Column | str, chars: int | None = None) -> Column:
    """Language by script counts, else ``en``; in the first ``chars`` characters if given."""
    return rx.let(_head(text, chars), lambda head: (
        F.when(rx.count_matches(head, lx.SCRIPT_OVERRIDES["zh"]) > 100, "zh")
        .when(rx.count_matches(head, lx.SCRIPT_OVERRIDES["ja"]) > 50, "ja")
        .when(rx.count_matches(head, lx.SCRIPT_OVERRIDES["ko"]) > 50, "ko")
        .when(rx.count_matches(head, lx.CYRILLIC) > 50, "ru")
        .otherwise("en")
    ))


def primary_script(text: Column | str, chars: int | None = None) -> Column:
    """Most frequent script, above 10 hits; first wins ties; in the first ``chars`` characters if given."""
    names, rules = list(lx.PRIMARY_SCRIPTS), list(lx.PRIMARY_SCRIPTS.values())
    counts = rx.let(_head(text, chars), lambda head: F.array(*[F.regexp_count(head, F.lit(r)) for r in rules]))
    return rx.let(counts, lambda c: F.when(
        F.array_max(c) > 10, F.element_at(rx.text_array(names), F.array_position(c, F.array_max(c)).cast("int")),
    ).otherwise("english"))
