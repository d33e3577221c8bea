"""Seeded samples, shuffles, splits and label rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import patterns as rx
from lexmill.operators.ranking import (
    hash_order_key,
    join_on,
    ordered_ranks,
    with_first_k,
    with_hash_rank,
    with_ordered_rank,
)


def hash_sample(df: DataFrame, k: int, key: str = "id", seed: int = 42) -> DataFrame:
    """``k`` rows drawn without replacement, the same ones on every run."""
    return with_first_k(df, hash_order_key(seed, key), key, _constant_quota(df, k), "_in").where("_in").drop("_in")


def bounded_sample(df: DataFrame, key: str, text: str, k: int = 10_000, max_chars: int = 10_000, seed: int = 42) -> DataFrame:
    """At most ``k`` rows, each text cut to ``max_chars`` (clustering input)."""
    return hash_sample(df, k, key, seed).withColumn(text, F.substring(text, 1, max_chars))


def seeded_shuffle(df: DataFrame, key: str = "id", seed: int = 42, out: str = "position") -> DataFrame:
    """Number the rows 1..n in a reproducible random order."""
    return with_hash_rank(df, hash_order_key(seed, key), key, out)


def _constant_quota(df: DataFrame, k: int) -> DataFrame:
    # Asking for more rows than there are selects all.
    return df.agg(F.least(F.count("*"), F.lit(k)).alias("k"))


def _train_test(flag: str, out: str) -> Column:
    return F.when(F.col(flag), "train").otherwise("test").alias(out)


def ratio_split(df: DataFrame, key: str = "id", ratio: float = 0.8, seed: int = 42, out: str = "split") -> DataFrame:
    """The first ``floor(n * ratio)`` rows in shuffled order are ``train``."""
    quota = df.agg(F.floor(F.count("*") * F.lit(ratio)).alias("k"))
    flagged = with_first_k(df, hash_order_key(seed, key), key, quota, "_train")
    return flagged.withColumn(out, _train_test("_train", out)).drop("_train")


def random_split(df: DataFrame, key: str = "id", test_size: float = 0.2, seed: int = 42, out: str = "split") -> DataFrame:
    """``ceil(n * test_size)`` random rows are ``test``."""
    quota = df.agg((F.count("*") - F.ceil(F.count("*") * F.lit(test_size))).alias("k"))
    flagged = with_first_k(df, hash_order_key(seed, key), key, quota, "_train")
    return flagged.withColumn(out, _train_test("_train", out)).drop("_train")


def hash_split(df: DataFrame, key: str = "id", ratio: float = 0.8, seed: int = 42, out: str = "split") -> DataFrame:
    """Row-wise split by hash threshold: no counting pass, also for streams.

    The train share is ``ratio`` in expectation, not exactly.
    """
    bucket = F.conv(F.substring(hash_order_key(seed, key), 1, 8), 16, 10).cast("long")
    return df.withColumn(out, F.when(bucket < int(ratio * (1 << 32)), "train").otherwise("test"))


def stratified_split(
    df: DataFrame, label: str, key: str = "id", test_size: float = 0.2, seed: int = 42, out: str = "split",
) -> DataFrame:
    """Random split that keeps the label shares.

    ``n - ceil(n * test_size)`` train rows are apportioned to the labels by
    largest remainder (ties to the smaller label).
    """
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    # One row per label; the label count is bounded by the class count.
    every = Window.partitionBy(F.lit(0))
    n = F.sum("n").over(every)
    sized = counts.withColumn("_draws", n - F.ceil(n * F.lit(test_size))).withColumn("_all", n)
    share = sized.withColumn("_fair", F.col("_draws") * F.col("n"))
    whole = share.withColumn("_whole", F.floor(F.col("_fair") / F.col("_all")))
    whole = whole.withColumn("_left", F.col("_fair") - F.col("_whole") * F.col("_all"))
    by_rest = every.orderBy(F.col("_left").desc(), F.col(label))
    quotas = whole.withColumn("_spare", F.col("_draws") - F.sum("_whole").over(every)).select(
        label,
        (F.col("_whole") + (F.row_number().over(by_rest) <= F.col("_spare")).cast("long")).alias("k"),
    )
    flagged = with_first_k(df, hash_order_key(seed, key), key, quotas, "_train", groups=[label])
    return flagged.withColumn(out, _train_test("_train", out)).drop("_train")


def balance_classes(df: DataFrame, label: str, key: str = "id", seed: int = 42) -> DataFrame:
    """Down-sample every class to the size of the smallest."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    quotas = counts.select(label, F.min("n").over(Window.partitionBy(F.lit(0))).alias("k"))
    flagged = with_first_k(df, hash_order_key(seed, key), key, quotas, "_in", groups=[label])
    return flagged.where("_in").drop("_in")


def head_tail_split(df: DataFrame, order: str = "id", ratio: float = 0.8, out: str = "split") -> DataFrame:
    """The first ``floor(n * ratio)`` rows in the given order are ``train``."""
    ranks = ordered_ranks(df, [order], "_rank")
    quota = df.agg(F.floor(F.count("*") * F.lit(ratio)).alias("k")).select("k").scalar()
    # The last train key reaches the rows as a scalar; texts are not shuffled.
    last = ranks.where(F.col("_rank") == quota).select(order).scalar()
    return df.withColumn(out, F.when(F.col(order) <= last, "train").otherwise("test"))


def mini_batches(df: DataFrame, batch_size: int, order: str = "id", out: str = "batch") -> DataFrame:
    """Number consecutive batches 0, 1, … of ``batch_size`` rows."""
    ranked = with_ordered_rank(df, [order], "_rank")
    return ranked.withColumn(out, F.floor((F.col("_rank") - 1) / batch_size)).drop("_rank")


def alternating_labels(df: DataFrame, order: str = "id", out: str = "label") -> DataFrame:
    """Labels 0, 1, 0, 1, … in the given order, for unlabelled data."""
    ranked = with_ordered_rank(df, [order], "_rank")
    return ranked.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(2))).drop("_rank")


def length_labels(text: Column | str = "text", threshold: int = 500) -> Column:
    """1 for texts longer than the threshold, else 0."""
    return F.when(F.length(text) > threshold, 1).otherwise(0)


def weighted_labels(
    df: DataFrame, labelled: DataFrame, label: str = "label", key: str = "id", seed: int = 42, out: str = "label",
) -> DataFrame:
    """Draw a label per row from the label distribution of ``labelled``.

    A hash of the identity is the uniform draw; the label whose cumulative
    share covers it is taken.  The distribution is folded into one array, so no
    range join is needed.
    """
    counts = labelled.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(F.lit(0)).orderBy("_label").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cumulative = counts.select("_label", F.sum("_n").over(upto).alias("_upto"))
    table = cumulative.agg(F.sort_array(F.collect_list(F.struct("_upto", "_label"))).alias("t"))
    draw = F.conv(F.substring(hash_order_key(seed, key), 1, 8), 16, 10).cast("long")
    with_table = df.withColumn("_t", table.scalar())

    def covering(s: Column) -> Column:
        # u < upto / total, kept in integers.
        return F.get(F.filter(s["t"], lambda e: s["goal"] < e["_upto"] * (1 << 32)), F.lit(0))["_label"]

    goal = draw * F.element_at("_t", -1)["_upto"]
    label_of = rx.bind({"t": F.col("_t"), "goal": goal}, covering)
    return with_table.withColumn(out, label_of).drop("_t")


def label_index(labels: DataFrame, label: str = "label", out: str = "label_idx") -> DataFrame:
    """Sorted distinct labels -> 0..k-1, one row per class."""
    distinct = labels.select(label).distinct()
    by_label = Window.partitionBy(F.lit(0)).orderBy(label)
    return distinct.withColumn(out, (F.row_number().over(by_label) - 1).cast("long"))


def encode_labels(
    df: DataFrame, mapping: DataFrame, label: str = "label", idx: str = "label_idx", unseen: str = "error",
) -> DataFrame:
    """Attach class indices.  ``unseen``: ``error``, ``skip`` or ``keep`` (null index)."""
    if unseen not in ("error", "skip", "keep"):
        raise ValueError(f"unseen must be 'error', 'skip' or 'keep', not {unseen!r}")
    joined = join_on(df, mapping, [label], "inner" if unseen == "skip" else "left")
    if unseen == "error":
        missing = F.concat(F.lit("label without an index: "), F.col(label).cast("string"))
        joined = joined.withColumn(idx, F.coalesce(F.col(idx), F.raise_error(missing).cast("long")))
    return joined


def decode_labels(
    df: DataFrame, mapping: DataFrame, index: str = "class_index", label: str = "label", idx: str = "label_idx",
    out: str = "class",
) -> DataFrame:
    """Class index -> label; an index without a label stays itself."""
    side = mapping.select(F.col(idx).alias("_i"), F.col(label).cast("string").alias("_l"))
    joined = df.join(side, F.col(index) == F.col("_i"), "left")
    return joined.withColumn(out, F.coalesce("_l", F.col(index).cast("string"))).drop("_i", "_l")
