"""Exact order statistics and ranks without a single-task sort.

A plain ``row_number().over(orderBy(...))`` moves all rows into one task, and
``partitionBy(label)`` moves a frequent label into one.  Here rows are counted
per key bucket first; only the small count table is accumulated in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.operators.scratch import materialized

# Hash keys are hexadecimal text; four digits give 65,536 even buckets.
BUCKET_DIGITS = 4


def hash_order_key(seed: int, *ids: Column | str) -> Column:
    """Reproducible random order: the MD5 of seed and identity, as text."""
    parts = [F.col(c) if isinstance(c, str) else c for c in ids]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]).cast("binary"))


def join_on(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where null equals null; the columns of ``left`` stay.

    Whether the right side is sent to every task is left to adaptive execution,
    which decides by its bytes.
    """
    other = {n: f"_other_{n}" for n in names}
    renamed = right.withColumnsRenamed(other)
    match = [F.col(n).eqNullSafe(F.col(o)) for n, o in other.items()]
    return left.join(renamed, match, how).drop(*other.values())


def _bucket_offsets(keys: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows per (group, bucket) and how many rows of the group precede the bucket."""
    counts = keys.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    # At most 16 ** BUCKET_DIGITS rows per group, however many rows are ranked.
    before = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("_before", F.sum("_n").over(before) - F.col("_n"))


def kth_keys(
    df: DataFrame,
    key: Column,
    tie: str,
    quotas: DataFrame,
    groups: Sequence[str] = (),
) -> DataFrame:
    """The key of the k-th row in key order, per group.

    ``quotas`` holds the group columns and ``k``.  The result holds the groups
    and ``cut``: struct(key, tie) of the k-th row, null for k = 0, so that
    ``struct(key, tie) <= cut`` selects exactly k rows.  Only identities and
    keys of one bucket per group are sorted.
    """
    keys = df.select(*groups, key.alias("_key"), F.col(tie).alias("_tie"))
    keys = keys.withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    offsets = _bucket_offsets(keys, groups)
    if groups:
        hit = join_on(offsets, quotas, groups)
    else:
        hit = offsets.withColumn("k", quotas.select("k").scalar())
    hit = hit.where((F.col("_before") < F.col("k")) & (F.col("k") <= F.col("_before") + F.col("_n")))
    hit = hit.select(*groups, "_bucket", (F.col("k") - F.col("_before")).alias("_rest"))
    if groups:
        inside = join_on(keys, hit, [*groups, "_bucket"])
    else:
        inside = keys.where(F.col("_bucket") == hit.select("_bucket").scalar())
        inside = inside.withColumn("_rest", hit.select("_rest").scalar())
    order = Window.partitionBy(*groups, "_bucket").orderBy("_key", "_tie")
    cut = (
        inside.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == F.col("_rest"))
        .select(*groups, F.struct(F.col("_key").alias("key"), F.col("_tie").alias("tie")).alias("cut"))
    )
    return cut


def with_first_k(
    df: DataFrame,
    key: Column,
    tie: str,
    quotas: DataFrame,
    out: str,
    groups: Sequence[str] = (),
) -> DataFrame:
    """Add the flag ``out``: the row is among the first k of its group in key order.

    Row payloads are never shuffled: the cut keys come from identities alone
    and reach the rows as a scalar, or as one small row per group.
    """
    cuts = kth_keys(df, key, tie, quotas, groups)
    here = F.struct(key.alias("key"), F.col(tie).alias("tie"))
    if not groups:
        return df.withColumn(out, F.coalesce(here <= cuts.select("cut").scalar(), F.lit(False)))
    joined = join_on(df, cuts.withColumnRenamed("cut", "_cut"), groups, "left")
    return joined.withColumn(out, F.coalesce(here <= F.col("_cut"), F.lit(False))).drop("_cut")


def with_hash_rank(
    df: DataFrame,
    key: Column,
    tie: str,
    out: str = "rank",
    groups: Sequence[str] = (),
) -> DataFrame:
    """Add the exact 1-based rank in hash-key order, overall or per group.

    Rank = rows in earlier buckets + position inside the bucket.  Each window
    partition is one bucket, an even 1/65,536 of the group.  Whole rows move once, dealt out by
    group and bucket for the window and the join alike; give it few columns where texts need no rank.
    """
    keyed = df.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    offsets = _bucket_offsets(keyed.select(*groups, "_bucket"), groups).drop("_n")
    inside = Window.partitionBy(*groups, "_bucket").orderBy("_key", tie)
    ranked = keyed.withColumn("_at", F.row_number().over(inside))
    joined = join_on(ranked, offsets, [*groups, "_bucket"])
    return joined.withColumn(out, F.col("_at") + F.col("_before")).drop("_key", "_bucket", "_at", "_before")


def ordered_ranks(df: DataFrame, order: Sequence[str], out: str = "rank") -> DataFrame:
    """(order columns, rank): the exact 1-based rank in the order of the columns.

    Range-sorts the order columns alone, numbers each sorted partition, and
    adds the sizes of the partitions before it.  The sorted keys are written
    once, since a second evaluation could cut the ranges elsewhere.
    ``order`` must identify the rows.
    """
    keys = df.select(*order)
    position = F.monotonically_increasing_id()
    sorted_keys = materialized(keys.orderBy(*order).withColumn("_pos", position))
    part, at = F.shiftright("_pos", 33), F.col("_pos").bitwiseAND((1 << 33) - 1)
    sizes = sorted_keys.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row per partition of the sort.
    upto = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = sizes.select("_part", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"))
    return (
        sorted_keys.withColumn("_part", part)
        .join(starts, "_part")
        .select(*order, (at + F.col("_before") + 1).alias(out))
    )


def with_ordered_rank(df: DataFrame, order: Sequence[str], out: str = "rank") -> DataFrame:
    """Add the exact 1-based rank in the order of the columns, which identify the rows.

    Only the order columns are sorted; whole rows move once, to meet their rank.
    """
    return join_on(df, ordered_ranks(df, order, out), order)
