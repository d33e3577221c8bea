"""Spans of pattern matches as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.llm.words import let

_STEP = 256
#: Characters of context that a span carries.
BEFORE = 64


def _total(lengths: Column, first: Column, n: Column | int) -> Column:
    return F.aggregate(F.slice(lengths, first, n), F.lit(0), lambda s, x: s + x)


def running_starts(lengths: Column) -> Column:
    """For each element the sum of those before it, in steps of _STEP so that many elements stay cheap."""

    def starts(x: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(x) - 1) / _STEP).cast("int")), lambda b: _total(x, b * _STEP + 1, _STEP))

        def within(sums: Column) -> Column:
            before = F.transform(sums, lambda _, b: _total(sums, F.lit(1), b))
            return let(before, lambda c: F.transform(x, lambda _, i: F.get(c, F.floor(i / _STEP).cast("int")) + _total(
                x, F.floor(i / _STEP).cast("int") * _STEP + 1, i % _STEP)))

        return let(blocks, within)

    return let(lengths, lambda x: F.when(F.size(x) == 0, F.array().cast("array<int>")).otherwise(starts(x)))


def match_spans(text: Column, pattern: str, group: int | None = None) -> Column:
    """array(struct(start, stop, value, before)) of all matches: code points from 0.

    ``value`` is the match or a group of it, ``before`` the last BEFORE characters
    between it and the previous match. The pieces between matches and the matches
    themselves alternate, so their lengths add up to the places.  The pattern must not match the empty string.
    """

    def spans(found: Column) -> Column:
        values = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        pieces = F.zip_with(
            F.slice(F.split(text, pattern, -1), 1, F.size(found)), found,
            lambda a, b: F.struct(F.length(a).alias("gap"), F.length(b).alias("n"), F.right(a, F.lit(BEFORE)).alias("before")))
        placed = let(pieces, lambda w: F.zip_with(
            w, running_starts(F.transform(w, lambda p: p["gap"] + p["n"])), lambda p, s: F.struct(
                (s + p["gap"]).alias("start"), (s + p["gap"] + p["n"]).alias("stop"), p["before"].alias("before"))))
        return F.zip_with(placed, values, lambda p, v: F.struct(
            p["start"].alias("start"), p["stop"].alias("stop"), v.alias("value"), p["before"].alias("before")))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


SPAN = "array<struct<start:int,stop:int,value:string,before:string>>"


def no_spans() -> Column:
    return F.array().cast(SPAN)


def label(spans: Column, kind: str, order: int) -> Column:
    """Spans with the number and the name of their kind."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("nth"), s["stop"].alias("stop"), F.lit(kind).alias("kind")))


def joined(spans: Column) -> Column:
    """kind:start:end of labelled spans in their order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark) -> Column:
    """The text with each span replaced by ``mark(kind)``; of overlapping spans the union, marked by the first."""

    def cut(ordered: Column) -> Column:
        # Merge first, so that pieces can be cut independently of each other.
        step = lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["start"] < F.element_at(acc, -1)["stop"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["stop"], s["stop"]).alias("stop"),
                F.element_at(acc, -1)["kind"].alias("kind"))))
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))))
        merged = F.aggregate(ordered, F.array().cast("array<struct<start:int,stop:int,kind:string>>"), step)

        def pieces(m: Column) -> Column:
            before = F.transform(m, lambda s, i: F.concat(
                F.substring(text, F.when(i == 0, F.lit(1)).otherwise(F.coalesce(F.get(m, i - 1)["stop"], F.lit(0)) + 1),
                            s["start"] - F.when(i == 0, F.lit(0)).otherwise(F.coalesce(F.get(m, i - 1)["stop"], F.lit(0)))),
                mark(s["kind"])))
            return F.concat(F.array_join(before, ""), F.substr(text, F.element_at(m, -1)["stop"] + 1))

        return let(merged, pieces)

    return F.when(F.size(spans) > 0, cut(F.array_sort(spans))).otherwise(text)
