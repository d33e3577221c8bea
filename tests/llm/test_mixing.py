"""Targets, readings and positions of a mixture against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from lexmill.llm.mixing import Schedule, mix


def water(sizes, weights, share):
    """Targets by repeated resharing of what is above the limit."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        unit = left / sum(w[s] for s in open_)
        left = 0.0
        for s in sorted(open_, key=str):
            target[s] += unit * w[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def rows_of(seed):
    r = random.Random(seed)
    rows = [(i, "w " * r.choice([0, 1, 3, 30, 400]), r.choice(["b", "a", None, "ä", "", "z"]), 1) for i in range(300)]
    return rows + [(900, "w " * 5000, "big", 1), (901, None, "big", 1), (None, "w w", "a", 1), (5, "w w w", "b", 1), (5, "w w w", "b", 1), (902, "", "none", 1)]


@pytest.mark.parametrize("weights", [(3.0, 1.0, 2.0), (1.0, 50.0)])
def test_targets_and_readings(spark, weights):
    rows = rows_of(1)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int").repartition(5)
    got = mix(df, weights=weights).collect()
    assert got[0].__fields__ == ["doc_id", "text", "source", "size", "source_size", "target", "taken", "position"]
    sizes = {}
    for x in got:
        sizes[x.source] = sizes.get(x.source, 0) + x.size
    want = water(sizes, weights, 1.5)
    for s in sizes:
        mine = [x for x in got if x.source == s]
        assert all(x.source_size == sizes[s] and abs(x.target - want[s]) < 1e-6 * (1 + want[s]) for x in mine)
        assert abs(sum(x.taken for x in mine) - want[s]) <= 1
        assert all(0 <= x.taken <= 2 * x.size and x.size == len((x.text or "").split()) for x in mine)
    places = [x.position for x in got if x.position is not None]
    assert places == sorted(places) and all(0 <= p <= 1 for p in places) and len(got) == len(rows)
    assert all((x.position is None) == (x.taken == 0) for x in got)
    again = mix(df.repartition(2), weights=weights).collect()
    key = lambda x: (str(x.doc_id), x.size, x.taken, x.position or -1)
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_positions_follow_the_schedule(spark):
    schedule = Schedule(((0.0, 3.0), (0.5, 1.0), (1.0, 2.0)))
    df = spark.createDataFrame([(i, "w", "s") for i in range(3000)], "doc_id long, text string, source string")
    got = [x.position for x in mix(df, schedules=(schedule,), share=1.0).collect()]
    steps = 4000
    level = lambda t: 3 - 4 * t if t < 0.5 else 1 + 2 * (t - 0.5)
    area = sum(level((i + 0.5) / steps) for i in range(steps))
    demand, at = 0.0, 0
    for i in range(steps):
        demand += level((i + 0.5) / steps) / area
        while at < len(got) and got[at] < (i + 1) / steps:
            at += 1
        assert abs(at / len(got) - demand) < 2e-3
    with pytest.raises(ValueError):
        Schedule(((0.0, 1.0), (0.9, 1.0))).segments()


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix(df).count() == 0
    only = spark.createDataFrame([(1, "", None), (2, None, None)], "doc_id long, text string, source string")
    assert [(x.target, x.taken, x.position) for x in mix(only).collect()] == [(0.0, 0, None)] * 2


def test_all_readings_have_a_time(spark):
    rows = rows_of(2)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int").withColumn("a.b", F.lit(1))
    got = mix(df, weights=(1.0, 50.0), readings="times").collect()
    assert got[0].__fields__[-1] == "times" and "a.b" in got[0].__fields__
    twice = 0
    for x in got:
        assert len(x.times) == (x.taken > 0) + (x.taken > x.size)
        assert x.times == sorted(x.times) and all(0 <= t <= 1 for t in x.times) and x.times[:1] == [x.position] * (x.taken > 0)
        twice += len(x.times) == 2
    assert twice
    # All first readings of a source stand before its second ones.
    for s in {x.source for x in got}:
        mine = [x for x in got if x.source == s and x.times]
        second = [x.times[1] for x in mine if len(x.times) == 2]
        assert not second or max(x.times[0] for x in mine) <= min(second) + 1e-9
