"""Word and line arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions import patterns as rx


def words(low: Column | str) -> Column:
    """Maximal runs of word characters; pass lower-cased text for word forms."""
    return F.array_remove(F.split(rx.as_col(low), rx.NON_WORD + "+"), "")


def whitespace_tokens(text: Column | str) -> Column:
    """Lower-cased tokens between white space."""
    return F.array_remove(F.split(F.lower(rx.as_col(text)), rx.SPACE + "+"), "")


def lines(text: Column | str) -> Column:
    return F.split(rx.as_col(text), "\n")


def run_lengths(values: Column) -> Column:
    """Multiplicity of each distinct value of an array (order unspecified).

    Sort, mark the position where each run ends, take differences: no shuffle
    and no per-word search.
    """
    ends = rx.let(
        F.sort_array(values),
        lambda s: F.filter(
            F.sequence(F.lit(1), F.size(s)),
            lambda i: ~F.coalesce(F.get(s, i) == F.get(s, i - 1), F.lit(False)),
        ),
    )
    return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(
        rx.let(ends, lambda e: F.transform(e, lambda end, i: end - F.coalesce(F.get(e, i - 1), F.lit(0))))
    )


def counted(values: Column) -> Column:
    """array(struct(value, n)): each distinct value with its multiplicity, in value order.

    Nulls are left out.  Sorted once; a run ends where the next value differs.
    """
    def runs(s: Column) -> Column:
        last = F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: ~F.coalesce(F.get(s, i) == F.get(s, i - 1), F.lit(False)))
        return rx.let(last, lambda e: F.transform(e, lambda end, i: F.struct(
            F.get(s, end - 1).alias("value"), (end - F.coalesce(F.get(e, i - 1), F.lit(0))).alias("n"))))

    none = F.array().cast("array<struct<value:string,n:int>>")
    return rx.let(F.sort_array(F.array_compact(values)), lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(none))


def top_sum(counts: Column, k: int = 5) -> Column:
    """Sum of the ``k`` largest counts."""
    return F.aggregate(F.slice(F.sort_array(counts, asc=False), 1, k), F.lit(0), lambda a, x: a + x)


def array_sum(values: Column) -> Column:
    """Sum of an integer array as long."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)
