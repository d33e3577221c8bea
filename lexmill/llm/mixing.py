"""Mixing sources to target weights along a curriculum, in native Spark operations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.words import column, let, word_count

#: Hexadecimal digits of the order key that make a bucket: 65,536 buckets in a source.
BUCKET_DIGITS = 4
#: Of these, digits that make a block of buckets.
BLOCK_DIGITS = 2
#: A document may be read so often.
MAX_REPEATS = 2


@dataclass(frozen=True)
class Schedule:
    """Weight of a source over the run: straight lines between ``knots`` of (time, level).

    Times rise from 0 to 1; levels are positive and relative, as the source's whole
    share comes from its weight.
    """

    knots: tuple[tuple[float, float], ...] = ((0.0, 1.0), (1.0, 1.0))

    def segments(self) -> list[tuple[float, float, float, float, float]]:
        """(t0, width, level, rise, demand before) with the levels scaled to an integral of 1."""
        times, levels = zip(*self.knots, strict=True)
        if times[0] != 0 or times[-1] != 1 or min(levels) <= 0 or any(b <= a for a, b in zip(times, times[1:])):
            raise ValueError("knots must rise from time 0 to 1 with positive levels")
        parts = list(zip(self.knots, self.knots[1:]))
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in parts)
        out, before = [], 0.0
        for (t0, l0), (t1, l1) in parts:
            out.append((t0, t1 - t0, l0 / area, (l1 - l0) / area, before))
            before += (t1 - t0) * (l0 + l1) / 2 / area
        return out


#: Weights and schedules of the registered query, repeating over the sources in order: even, growing, fading.
PRODUCTION_WEIGHTS = (3.0, 1.0, 2.0)
PRODUCTION_SCHEDULES = (
    Schedule(), Schedule(((0.0, 0.5), (1.0, 1.5))), Schedule(((0.0, 1.5), (1.0, 0.5))),
)
PRODUCTION_SHARE = 1.5


def _invert(schedule: Schedule, demand: Column) -> Column:
    """Time at which the cumulative demand (a share of the whole, 0 to 1) is reached."""
    result = following = None
    for t0, width, level, rise, before in reversed(schedule.segments()):
        # width * (level * s + rise * s * s / 2) = demand - before, for s from 0 to 1.
        x = (demand - F.lit(before)) / F.lit(width)
        s = 2 * x / (F.lit(level) + F.sqrt(F.greatest(F.lit(0.0), F.lit(level * level) + 2 * F.lit(rise) * x)))
        at = F.lit(t0) + F.lit(width) * F.least(F.lit(1.0), s)
        result = at if result is None else F.when(demand < following, at).otherwise(result)
        following = F.lit(before)
    return result


def _inverse(schedule: Schedule):
    return lambda demand: _invert(schedule, demand)


def source_targets(
    sizes: DataFrame, source: str, size: str, weights: Sequence[float], share: float, max_repeats: float = MAX_REPEATS,
) -> DataFrame:
    """(source, source_size, target, place): words wanted from each source.

    Sources in the order of their code points, null last, have ``weights`` in turn and
    divide ``share`` times all words by them.  No target exceeds ``max_repeats`` times
    the source; what is over is divided by weight among the others, until none is
    above.  That fixed point is found at once: sources sorted by their limit per unit
    of weight are filled up in that order.
    """
    # One row per source from here on.
    totals = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(F.col(size)).cast("long").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    in_order = everything.orderBy(F.col("source").asc_nulls_last())
    placed = totals.withColumn("place", F.row_number().over(in_order) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = placed.withColumn("weight", F.element_at(cycle, (F.pmod("place", F.lit(len(weights))) + 1).cast("int")))
    weighed = weighed.withColumn("limit", F.lit(float(max_repeats)) * F.col("source_size"))
    filled = everything.orderBy(F.col("limit") / F.col("weight"), "place")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / F.sum("weight").over(after)
    # The level at which a source still fits is the level of all that follow.
    leveled = weighed.withColumn("_level", level).withColumn("_fits", F.col("_level") * F.col("weight") <= F.col("limit"))
    common = F.min(F.when(F.col("_fits"), F.struct(F.col("limit") / F.col("weight"), F.col("place"), F.col("_level").alias("at")))).over(everything)
    target = F.when(F.col("_fits"), F.least("limit", common["at"] * F.col("weight"))).otherwise(F.col("limit"))
    return leveled.select("source", "source_size", target.alias("target"), "place")


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    size: Column | str | None = None,
    text: str = "text",
    weights: Sequence[float] = PRODUCTION_WEIGHTS,
    schedules: Sequence[Schedule] = PRODUCTION_SCHEDULES,
    share: float = PRODUCTION_SHARE,
    seed: int = 42,
    out: Sequence[str] = ("size", "source_size", "target", "taken", "position"),
    readings: str | None = None,
) -> DataFrame:
    """The documents in training order, with five more columns named by ``out``.

    ``readings`` names a sixth: the times of all readings of the document, first and second, so that
    a source that is read twice can be placed twice.

    ``size``: words of the text unless a column is given; ``source_size`` and
    ``target``: see ``source_targets``; ``taken``: words that the mix reads from the
    document; ``position``: time of its first reading, from 0 to 1, null if it is not
    read.  The result is range-sorted by position, documents that are not read last.

    The documents of a source form a tape in the order of a hash of seed, key and size,
    read from its start until the target is reached, a second time if it is longer than
    the tape; the document at the end is read in part, so that each source meets its
    target to the word and none is read more than twice its size.  The position of a word
    follows from the source's schedule: the share of the source's demand before it is
    turned into the time at which the integral of the schedule reaches that share.

    Null texts have size 0, texts of any length are read whole; null sources are one source, the last; null keys are
    ordered by their hash; repeated rows are documents of their own, indistinguishable;
    an empty table gives no rows.  Columns of ``docs`` named like an output or starting
    with ``_mix`` are replaced.

    Tapes are added up per bucket of the order key, so a source with most of the rows is
    no hot task.
    """
    measured = word_count(text) if size is None else column(size).cast("long")
    order_key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")), F.col("_mix_size").cast("string")))
    rows = docs.drop(*[c for c in out if c in docs.columns and c != size])
    rows = rows.withColumn("_mix_size", measured).withColumn("_mix_key", order_key)
    # A name for the source that is never null, so that window and join deal the rows out alike, once.
    group = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    rows = rows.withColumn("_mix_bucket", F.substring("_mix_key", 1, BUCKET_DIGITS)).withColumn("_mix_group", group)
    counted = rows.groupBy(F.col(source).alias("_mix_source"), "_mix_group", "_mix_bucket").agg(F.sum("_mix_size").alias("n"))
    targets = source_targets(counted, "_mix_source", "n", weights, share)
    # In two steps, so that no task adds up more than the buckets of one block or the blocks of one source.
    upto = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counted.withColumn("_mix_block", F.substring("_mix_bucket", 1, BLOCK_DIGITS))
    blocks = counted.groupBy("_mix_group", "_mix_block").agg(F.sum("n").alias("_mix_n"))
    blocks = blocks.withColumn("_mix_ahead", F.sum("_mix_n").over(upto("_mix_group").orderBy("_mix_block")) - F.col("_mix_n")).drop("_mix_n")
    starts = counted.withColumn("_mix_before", F.sum("n").over(upto("_mix_group", "_mix_block").orderBy("_mix_bucket")) - F.col("n")).drop("n")
    starts = starts.join(blocks, ["_mix_group", "_mix_block"]).withColumn("_mix_before", F.col("_mix_before") + F.col("_mix_ahead"))
    starts = starts.join(
        targets, F.col("_mix_source").eqNullSafe(F.col("source"))
    ).select("_mix_group", "_mix_bucket", "_mix_before", F.col("source_size").alias("_mix_total"), F.col("target").alias("_mix_target"), F.col("place").alias("_mix_place"))
    inside = Window.partitionBy("_mix_group", "_mix_bucket").orderBy("_mix_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taped = rows.withColumn("_mix_at", F.sum("_mix_size").over(inside) - F.col("_mix_size"))
    joined = taped.join(starts, ["_mix_group", "_mix_bucket"]).withColumn("_mix_start", F.col("_mix_at") + F.col("_mix_before"))
    n, total, target, start = (F.col(f"_mix_{c}") for c in ("size", "total", "target", "start"))
    goal = F.round(target).cast("long")
    reading = lambda turn: F.greatest(F.lit(0), F.least(n, goal - start - turn * total))
    taken = sum((reading(turn) for turn in range(1, MAX_REPEATS)), reading(0))

    def time_of(turn: int) -> Column:
        """When a reading begins: the share of the source's demand before it, turned into time."""
        demand, found = (start + turn * total) / F.nullif(target, F.lit(0.0)), None
        for i, schedule in enumerate(schedules):
            at = F.pmod("_mix_place", F.lit(len(schedules))) == i
            value = let(demand, _inverse(schedule))
            found = F.when(at, value) if found is None else found.when(at, value)
        return found

    position, more = time_of(0), []
    if readings is not None:
        times = F.array(*[F.when(reading(turn) > 0, time_of(turn)) for turn in range(MAX_REPEATS)])
        more = [F.array_compact(times).alias(readings)]
    result = joined.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in out and c != readings],
        n.alias(out[0]), total.alias(out[1]), target.alias(out[2]), taken.cast("long").alias(out[3]),
        F.when(taken > 0, position).alias(out[4]), *more, F.col("_mix_key"))
    return result.orderBy(F.col(out[4]).asc_nulls_last(), "_mix_key").drop("_mix_key")
