"""Regular-expression classes that mean the same in Spark and in the rules.

The cleaning and scoring rules are defined with Unicode-aware character
classes.  Java's ``\\s``, ``\\w`` and ``\\d`` are ASCII-only and its ``(?U)``
variants follow older Unicode tables, so rules are written with the usual
short classes and expanded here.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Character classes to be used inside [...].  White space is intersected with
# two plain ranges first, so that ordinary letters are dismissed at once.
SPACE_SET = r"[\x00-\x20\x{85}-\x{3000}&&[\s\x0B\x1C-\x1F\x{85}\p{Z}]]"
WORD_SET = r"\p{L}\p{N}_"
DIGIT_SET = r"\p{Nd}"
# White space other than the line feed.
BLANK_SET = r"[\x00-\x20\x{85}-\x{3000}&&[\t\x0B\f\r\x1C-\x1F \x{85}\p{Zs}\x{2028}\x{2029}]]"

SPACE = f"[{SPACE_SET}]"
NON_SPACE = f"[^{SPACE_SET}]"
WORD = f"[{WORD_SET}]"
# Letters that fill most texts.  A class that lists them one by one is a table lookup in Java.
LISTED = "".join(chr(c) for c in [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)] if c not in (0xD7, 0xF7))
NON_WORD = f"[[^{LISTED}]&&[^{WORD_SET}]]"
DIGIT = f"[{DIGIT_SET}]"
# Neither letter, digit nor white space.  Letters and the blank are dismissed one after the other: one class without all
# of them takes Java over ten times as long.
SYMBOL = rf"[[^a-zA-Z]&&[^ ]&&[^\p{{L}}\p{{N}}{SPACE_SET}]]"

# Runs of everything else.
_NO_SYMBOLS = rf"[a-zA-Z \p{{L}}\p{{N}}{SPACE_SET}]++"

# Every white-space code point, for trim().
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

_CLASS_BODIES = {"s": SPACE_SET, "w": WORD_SET, "d": DIGIT_SET}


def expand(rule: str) -> str:
    """Replace ``\\s \\S \\w \\d`` in a rule by the Unicode classes above."""
    out, i, in_class = [], 0, False
    while i < len(rule):
        ch = rule[i]
        if ch == "\\":
            nxt = rule[i + 1]
            if nxt in _CLASS_BODIES:
                body = _CLASS_BODIES[nxt]
                out.append(body if in_class else f"[{body}]")
            elif nxt == "S" and not in_class:
                out.append(NON_SPACE)
            else:
                out.append(ch + nxt)
            i += 2
            continue
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]" and in_class:
            in_class = False
        out.append(ch)
        i += 1
    return "".join(out)


def flags(ignore_case: bool = False, multiline: bool = False, dotall: bool = False) -> str:
    """Inline flags; ``d`` keeps ``\\n`` the only line terminator."""
    return "(?" + ("iu" if ignore_case else "") + ("m" if multiline else "") + ("s" if dotall else "") + "d)"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def matches(text: Column | str, rule: str, **kw: bool) -> Column:
    """True where the rule is found anywhere in the text."""
    return as_col(text).rlike(flags(**kw) + expand(rule))


def count_matches(text: Column | str, rule: str, **kw: bool) -> Column:
    """Number of non-overlapping matches of the rule."""
    return F.regexp_count(as_col(text), F.lit(flags(**kw) + expand(rule)))


def count_symbols(text: Column | str) -> Column:
    """Number of ``SYMBOL`` characters: what is left without the runs of all others."""
    return F.length(F.regexp_replace(as_col(text), _NO_SYMBOLS, ""))


def starts_with(text: Column | str, rule: str, **kw: bool) -> Column:
    """True where the rule matches at the beginning.

    The empty alternative ends the search there instead of trying the rule at
    every later position.  The rule must not match the empty text.
    """
    return F.regexp_extract(as_col(text), f"{flags(**kw)}^(?:({expand(rule)})|)", 1) != ""


def replace_if(text: Column | str, mark: str, rule: str, by: str = "") -> Column:
    """Replace a rule whose matches all contain ``mark``; other texts are only searched for it."""
    return let(as_col(text), lambda t: F.when(t.contains(mark), replace_all(t, rule, by)).otherwise(t))


def replace_all(text: Column | str, rule: str, by: str = "", **kw: bool) -> Column:
    return F.regexp_replace(as_col(text), flags(**kw) + expand(rule), by)


def replace_chain(text: Column | str, steps: list[tuple[str, str]], **kw: bool) -> Column:
    """Apply ``(rule, replacement)`` steps in order."""
    return reduce(lambda t, step: replace_all(t, step[0], step[1], **kw), steps, as_col(text))


def strip(text: Column | str) -> Column:
    """Trim Unicode white space from both ends."""
    return F.trim(as_col(text), F.lit(WHITESPACE_CHARS))


def single_blanks(text: Column | str) -> Column:
    """Every run of blanks becomes one; most texts have none and are only searched."""
    return let(as_col(text), lambda t: F.when(t.contains("  "), F.regexp_replace(t, " {2,}", " ")).otherwise(t))


def collapse_spaces(text: Column | str) -> Column:
    """Every run of white space becomes one blank; the blanks between words are not replaced by themselves."""
    return single_blanks(F.regexp_replace(as_col(text), f"[[^ {LISTED}]&&[{SPACE_SET}]]+", " "))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and pass it to ``fn``."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def bind(values: dict[str, Column], fn: Callable[[Column], Column]) -> Column:
    """Evaluate several values once; ``fn`` reads them as ``s["name"]``."""
    return let(F.struct(*[v.alias(k) for k, v in values.items()]), fn)


def add_once(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Add columns that later filters and projections reuse without evaluating again.

    A predicate on an ordinary derived column is pushed below it, by copying
    its expression.  Columns out of a generator are not copied, so costly text
    work runs once per row.
    """
    rest = [c for c in df.columns if c not in values]
    return df.select(
        *[F.col(f"`{c}`") for c in rest],
        F.inline(F.array(F.struct(*[v.alias(k) for k, v in values.items()]))),
    )


def compiled(rules: list[str], **kw: bool) -> list[str]:
    """Rules with their flags and classes, ready to be used as data."""
    return [flags(**kw) + expand(r) for r in rules]


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_array(values: Iterable[str]) -> str:
    return "array(" + ", ".join(sql_text(v) for v in values) + ")"


@cache
def _text_array(values: tuple[str, ...]) -> str:
    return sql_array(values) if values else "cast(array() as array<string>)"


def text_array(values: Iterable[str]) -> Column:
    """Constant array of strings (one parsed literal instead of many small columns)."""
    return F.expr(_text_array(tuple(values)))


def count_members(values: Column, listed: Iterable[str]) -> Column:
    """How many elements of an array are in a constant list (a hash lookup each)."""
    members = ", ".join(sql_text(v) for v in listed)
    return F.size(F.call_function("filter", values, F.expr(f"x -> x IN ({members})")))


# Letters with case variants that lower() does not map back to them; those of the Latin ones.
_LOOSE_LETTERS = set("is") | set("вдостъѣ")
_LATIN_VARIANTS = "\u0130\u0131\u017f"


def guard(rule: str, loose: Iterable[str] = _LOOSE_LETTERS) -> str:
    """Longest literal run that the lower-cased text of every match contains; may be empty.

    ``loose`` letters are left out of it.
    """
    literal = re.sub(r"\\.[+*?]?", " ", re.split(r"[(\[|]", rule)[0]).lower()
    runs = "".join(ch if ch.isalpha() and ch not in loose else " " for ch in literal).split()
    return max(runs, key=len, default="")


def _guarded(rules: list[str]) -> str:
    return "array(" + ", ".join(
        f"named_struct('guard', {sql_text(guard(r))}, 'strict', {sql_text(guard(r, _LOOSE_LETTERS - set('is')))}, 'rule', {sql_text(c)})"
        for r, c in zip(rules, compiled(rules, ignore_case=True))) + ")"


def guarded_rules(rules: list[str]) -> Column:
    """Case-insensitive rules, each with a substring every match contains in lower case.

    ``strict`` is a longer one, for texts without variants of i and s.
    """
    return F.expr(_guarded(rules))


def guarded_rules_of(language: Column, per_language: dict[str, list[str]]) -> Column:
    """The guarded rules of the row's language; null for a language without any."""
    entries = [f"{sql_text(code)}, {_guarded(rs)}" for code, rs in per_language.items()]
    return F.try_element_at(F.expr(f"map({', '.join(entries)})"), language)


def sum_guarded(text: Column, low: Column, rules: Column, once: bool = False) -> Column:
    """Sum of the match counts of guarded rules (or how many are found at all); 0 for null.

    A substring test on the lower-cased text spares most regular expressions.
    """
    def hits(e: Column) -> Column:
        return F.rlike(text, e["rule"]).cast("int") if once else F.regexp_count(text, e["rule"])

    loose = any_of([text.contains(ch) for ch in _LATIN_VARIANTS])
    return F.coalesce(let(loose, lambda wide: F.aggregate(rules, F.lit(0), lambda a, e: a + F.when(
        F.contains(low, F.when(wide, e["guard"]).otherwise(e["strict"])), hits(e)).otherwise(F.lit(0)))), F.lit(0))


def sum_line_rules(text: Column, rules: list[str]) -> Column:
    """Sum of the match counts of multi-line rules; 0 for null.

    Each rule is a literal, compiled once and not per row, and counted only where one
    rule says that any of them matches; where all begin a line it looks at nothing else.
    """
    anchored = all(r.startswith("^") for r in rules)
    any_of_them = "^(?:" + "|".join(r.removeprefix("^") for r in rules) + ")" if anchored else "|".join(f"(?:{r})" for r in rules)
    return F.when(
        text.rlike(compiled([any_of_them], multiline=True)[0]), total([count_matches(text, r, multiline=True) for r in rules])).otherwise(F.lit(0))


def rules_found(text: Column, rules: list[str]) -> Column:
    """How many compiled rules are found at all.  Each is a literal, compiled once and not per row."""
    return total([text.rlike(r).cast("int") for r in rules])


def total(values: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, values)
