"""Text cleaning.

``mode`` says what a line is.  ``"document"`` (the default) collapses all white
space first, so every line rule judges the whole document.  ``"lines"`` keeps
line feeds, so the rules judge each line.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import lexicon as lx
from lexmill.functions import patterns as rx
from lexmill.functions import tokens
from lexmill.functions.language import detect_language

_EMAIL_HEAD = r"[\w.+-]"
# Tried only where a run of address characters begins (or the last match ended),
# and without giving characters back: linear also on very long runs.
_EMAIL = rf"(?:(?<!{_EMAIL_HEAD})|\G){_EMAIL_HEAD}++@[\w-]+\.[\w.-]+"


def _check(mode: str) -> None:
    if mode not in ("document", "lines"):
        raise ValueError(f"mode must be 'document' or 'lines', not {mode!r}")


def _keep_lines(text: Column, keep: Callable[[Column], Column], mode: str) -> Column:
    """Stripped, non-empty lines that satisfy ``keep``."""
    if mode == "document":
        return rx.let(rx.strip(text), lambda t: F.when((t != "") & keep(t), t).otherwise(F.lit("")))
    stripped = F.transform(tokens.lines(text), rx.strip)
    return F.array_join(F.filter(stripped, lambda t: (t != "") & keep(t)), "\n")


def clean_basic(text: Column | str, mode: str = "document") -> Column:
    """Collapse white space; drop URLs, entities and lines of up to 5 characters."""
    _check(mode)
    t = rx.collapse_spaces(text) if mode == "document" else F.regexp_replace(rx.as_col(text), f"[{rx.BLANK_SET}]+", " ")
    for mark, rule, by in [("http", r"https?://\S+", ""), ("www.", r"www\.\S+", ""), ("&", r"&[a-z]+;", " ")]:
        t = rx.replace_if(t, mark, rule, by)
    if mode == "document":
        return rx.let(t, lambda x: F.when(F.length(F.trim(x)) > 5, x).otherwise(F.lit("")))
    return F.array_join(F.filter(tokens.lines(t), lambda x: F.length(rx.strip(x)) > 5), "\n")


def clean_special_chars(text: Column | str) -> Column:
    """Drop e-mail addresses, special characters and repeated punctuation."""
    return rx.single_blanks(rx.replace_chain(rx.replace_if(text, "@", _EMAIL), [
        # Everything but words, white space and punctuation; letters, blanks and punctuation are dismissed first.
        (rf"[[^{rx.LISTED} .,!?;:'\"\-]&&[^\w\s.,!?;:'\"-]]", " "),
        (r"([.,!?;:])\1+", "$1"),
    ]))


def _is_content_line(line: Column) -> Column:
    n = F.length(line)
    shouting = line.rlike(r"\p{Lu}") & ~line.rlike(r"[\p{Ll}\p{Lt}]") & (n > 10)
    numeric = rx.count_matches(line, r"\d") > n * 0.5
    option = rx.starts_with(line, r"[A-D][\s.、:：]+")
    numbered = (n < 30) & rx.starts_with(line, r"\d+[\s.、:：]+")
    term = rx.any_of([line.contains(t) for t in lx.NOISE_TERMS])
    return ~(shouting | numeric | option | numbered | term)


def drop_noise_lines(text: Column | str, mode: str = "lines") -> Column:
    """Drop lines in capitals, of digits, answer options, question numbers, exam terms."""
    _check(mode)
    return _keep_lines(rx.as_col(text), _is_content_line, mode)


# A rule that may end in anything is satisfied by its head; the others are searched at the end of a line.
_LINE_HEADS = [r.removeprefix("^").removesuffix(".*$") for r in lx.BOILERPLATE_LINE_RULES if r.startswith("^")]
_LINE_TAILS = [r.removeprefix(".*") for r in lx.BOILERPLATE_LINE_RULES if not r.startswith("^")]


def _is_boilerplate_line(line: Column) -> Column:
    return rx.starts_with(line, "|".join(_LINE_HEADS), ignore_case=True) | (
        line.endswith("]") & rx.matches(line, "|".join(_LINE_TAILS)))


def _is_substantial_line(line: Column) -> Column:
    # A line of 20 characters is never one of the up to 10 unpunctuated ones.
    return (
        (F.length(line) >= 20)
        & ~rx.matches(line, r"^\s*[\-\*•◦]\s+\w+$")
        & rx.matches(line, r"\s")
    )


def drop_navigation_lines(text: Column | str) -> Column:
    """Keep lines that look like running text (for texts full of boilerplate)."""
    return _keep_lines(rx.as_col(text), _is_substantial_line, "lines")


def drop_boilerplate_lines(text: Column | str, mode: str = "lines") -> Column:
    """Drop web boilerplate lines; if they are the majority, judge the rest strictly."""
    _check(mode)
    t = rx.as_col(text)
    if mode == "document":
        # One line: either it stays, or nothing does.
        return _keep_lines(t, lambda x: ~_is_boilerplate_line(x), mode)

    def finish(all_lines: Column) -> Column:
        return rx.let(
            F.filter(all_lines, lambda x: ~_is_boilerplate_line(x)),
            lambda kept: F.when(
                (F.size(all_lines) - F.size(kept)) / F.size(all_lines) > lx.HIGH_BOILERPLATE_RATIO,
                F.array_join(F.filter(kept, _is_substantial_line), "\n"),
            ).otherwise(F.array_join(kept, "\n")),
        )

    stripped = F.filter(F.transform(tokens.lines(t), rx.strip), lambda x: x != "")
    return rx.let(stripped, lambda ls: F.when(F.size(ls) == 0, F.lit("")).otherwise(finish(ls)))


def clean_cjk(text: Column | str, language: Column | str) -> Column:
    """Language-specific phrases of zh, ja and ko, then white space."""
    t, lang = rx.as_col(text), rx.as_col(language)
    cleaned = t
    for code, steps in lx.CJK_STEPS.items():
        cleaned = F.when(lang == code, rx.replace_chain(t, [(s, "") for s in steps])).otherwise(cleaned)
    return rx.collapse_spaces(cleaned)


def cjk_language(text: Column | str) -> Column:
    """The language, null where the text has no signature character of zh, ja or ko and so is none of them."""
    chars = "".join(ch for code in lx.CJK_LANGUAGES for ch in lx.LANGUAGE_SIGNATURES[code])
    # The range dismisses other scripts at once.
    return F.when(rx.as_col(text).rlike(rf"[\x{{3040}}-\x{{D7A3}}&&[{chars}]]"), detect_language(text)["language"])


def clean_structure(text: Column | str) -> Column:
    """Drop document headers, rulers, a leading welcome and a trailing notice line.

    Headers take the blank lines and rulers after them along.  Without any
    header the lines stay as they are.
    """
    b = f"[{rx.BLANK_SET}]*"
    header = rf"(?md)^#{b}Document[{rx.BLANK_SET}]+{rx.DIGIT}+[^\n]*\n(?:{b}(?:-{{5,}}{b})?\n)*+"
    ruler = rf"(?md)^{b}-{{5,}}{b}\n"

    def without_headers(t: Column) -> Column:
        ended = F.concat(t, F.lit("\n"))
        kept = F.regexp_replace(F.regexp_replace(ended, header, ""), ruler, "")
        joined = rx.let(kept, lambda k: F.substring(k, F.lit(1), F.length(k) - 1))
        return rx.replace_all(joined, r"\n{3,}", "\n\n")

    has_header = rf"(?md)^#{b}Document[{rx.BLANK_SET}]+{rx.DIGIT}"
    body = rx.let(rx.as_col(text), lambda t: F.when(t.rlike(has_header), without_headers(t)).otherwise(t))
    return rx.replace_chain(body, [(lx.LEADING_WELCOME, ""), (lx.TRAILING_NOTICE, "")])


def clean_minimal(text: Column | str) -> Column:
    """Tags and entities to blanks, white space collapsed, stripped."""
    t = rx.replace_chain(text, [(r"<[^>]+>", " "), (r"&[a-z]+;", " ")])
    return F.trim(rx.collapse_spaces(t))


def clean_text(
    text: Column | str, deep: bool = False, mode: str = "document", language_chars: int | None = None,
) -> Column:
    """The cleaned text.

    Deep cleaning adds special characters, noise and boilerplate lines, CJK
    phrases and document structure.  The language is that of the whole text, or of
    its first ``language_chars`` characters if given.
    """
    if not deep:
        return clean_basic(text, mode)
    t = rx.as_col(text)
    cleaned = clean_special_chars(clean_basic(t, mode))
    cleaned = drop_boilerplate_lines(drop_noise_lines(cleaned, mode), mode)

    def finish(s: Column) -> Column:
        body = rx.bind({"code": cjk_language(s["head"]), "x": s["x"]}, lambda b: F.when(
            b["code"].isin(lx.CJK_LANGUAGES), clean_cjk(b["x"], b["code"])).otherwise(b["x"]))
        # In document mode no line feed and no '#' is left, so structure rules cannot apply.
        return clean_structure(body) if mode == "lines" else body

    return rx.bind({"x": cleaned, "head": t if language_chars is None else F.substring(t, 1, language_chars)}, finish)


def with_clean_text(
    df: DataFrame, text: str = "text", out: str = "clean_text", deep: bool = False, mode: str = "document",
) -> DataFrame:
    """Add the cleaned text, evaluated once per row."""
    return rx.add_once(df, {out: clean_text(text, deep, mode)})
