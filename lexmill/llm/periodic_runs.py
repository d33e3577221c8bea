"""Runs of repeated words, found online by catchers over blocks of power-of-two size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.words import ROW, column, let, whole_rows, words

#: A run repeats its period so often, and has so many words.
MIN_EXPONENT = 4
MIN_LENGTH = 6
#: Words appended to the catchers at a time.
APPEND = 1 << 16

RUN = "struct<start:long,length:long,period:long>"
RUNS = f"struct<n_words:long,runs:array<{RUN}>,collapsed:string>"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, longer as texts need."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                steps = np.full(n, base)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))


_POWERS = _Powers()


def _mixed(ids: np.ndarray) -> np.ndarray:
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    return x * np.uint64(0x94D049BB133111EB)


class SquareCatchers:
    """Maximal runs of a growing sequence of word numbers.

    Level ``l`` cuts the words into blocks of ``B = 2**l``.  Each completed block is a
    catcher: it waits for its own words to come again ``p`` words later, ``2B - 1 <= p <=
    4B - 2``.  The levels share out all periods, and a square of period ``p`` holds
    a whole block of its level in its first half, so no square escapes.  An appended word
    completes one suffix of ``B`` words per level, which is compared (by hash) with the
    two catchers alive at those distances.  Catches of one period on neighbouring blocks
    are squares that merge; merged ones of enough blocks are compared word by word and
    stretched to the maximal run, so that equal hashes of different words do no harm.

    Catches inside a run whose period divides theirs say nothing new and are dropped,
    so a long run of a short period costs its length per level, not its square.
    """

    def __init__(self, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> None:
        if min_exponent < 2:
            raise ValueError("a run repeats its period twice at least")
        self.min_exponent, self.min_length = min_exponent, min_length
        self.n = 0
        self._ids, self._sums = np.empty(0, np.int64), np.zeros(1, np.uint64)
        self._next: list[int] = []
        self._open: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._final: dict[tuple[int, int], int] = {}
        self._growing: dict[tuple[int, int], int] = {}

    def append(self, ids: np.ndarray) -> None:
        """Append words; equal numbers are equal words."""
        if not len(ids):
            return
        n = self.n + len(ids)
        if n > len(self._ids):
            room = n if not self.n else max(n, 2 * len(self._ids))
            self._ids = np.concatenate([self._ids[:self.n], np.empty(room - self.n, np.int64)])
            self._sums = np.concatenate([self._sums[:self.n + 1], np.empty(room - self.n, np.uint64)])
        _POWERS.reach(n + 1)
        self._ids[self.n:n] = ids
        self._sums[self.n + 1:n + 1] = self._sums[self.n] + np.cumsum(_mixed(np.asarray(ids)) * _POWERS.up[self.n:n], dtype=np.uint64)
        self.n = n
        self._growing = {}
        level = 0
        while self.min_exponent * (2 * (1 << level) - 1) <= n:
            if level == len(self._next):
                self._next.append(2 * (1 << level) - 1)
                self._open.append((np.empty(0, np.int64),) * 3)
            self._advance(level)
            level += 1

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs of the words so far, by start, then period."""
        found = self._final | self._growing
        return sorted((a, b - a, p) for (a, b), p in found.items())

    def _suffixes(self, low: int, high: int, size: int) -> np.ndarray:
        """Hashes of the ``size`` words from each place in [low, high)."""
        sums = self._sums
        return (sums[low + size:high + size] - sums[low:high]) * _POWERS.down[low:high]

    def _advance(self, level: int) -> None:
        size = 1 << level
        low, high = self._next[level], self.n - size + 1
        if low >= high:
            return
        self._next[level] = high
        back = max(0, low - 4 * size + 2)
        hashes = self._suffixes(back, high, size)
        new = np.arange(low, high)
        near = (new - 2 * size + 1) // size * size
        caught = hashes[low - back:] == hashes[near - back]
        places, catchers = [new[caught]], [near[caught]]
        far = near - size
        alive = int(np.searchsorted(far, 0))
        caught = hashes[low - back + alive:] == hashes[far[alive:] - back]
        places.append(new[alive:][caught])
        catchers.append(far[alive:][caught])
        first = np.concatenate(catchers)
        period = np.concatenate(places) - first
        period, first = self._telling(period, first, size)
        period = np.concatenate([self._open[level][0], period])
        last = np.concatenate([self._open[level][2], first])
        first = np.concatenate([self._open[level][1], first])
        if not len(period):
            return
        order = np.lexsort((first, period))
        period, first, last = period[order], first[order], last[order]
        joins = (period[1:] == period[:-1]) & (first[1:] == last[:-1] + size)
        begins = np.flatnonzero(np.concatenate([[True], ~joins]))
        ends = np.append(begins[1:], len(period)) - 1
        period, first, last = period[begins], first[begins], last[ends]
        pending = last + size + period >= high
        # A stretch holds all its blocks and less than one more at either end.
        enough = last - first + 3 * size - 2 >= self._needed(period)
        for p, a, b in zip(period[enough].tolist(), first[enough].tolist(), last[enough].tolist(), strict=True):
            self._stretch(p, a, b + size, size)
        self._open[level] = (period[pending], first[pending], last[pending])

    def _needed(self, period):
        """Places that must equal the one a period later."""
        return np.maximum((self.min_exponent - 1) * period, self.min_length - period)

    def _telling(self, period: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Catches without those inside a known run whose period divides theirs."""
        known = [(a, b, p) for (a, b), p in (self._final | self._growing).items() if p < 2 * size - 1]
        if not known or not len(period):
            return period, first
        starts, stops, periods = np.array(sorted(known)).T
        furthest = np.maximum.accumulate(stops)
        holder = np.maximum.accumulate(np.where(stops == furthest, np.arange(len(stops)), 0))
        at = np.searchsorted(starts, first, "right") - 1
        inside = (at >= 0) & (furthest[at] >= first + period + size)
        dull = inside & (period % periods[holder[at]] == 0)
        return period[~dull], first[~dull]

    def _stretch(self, period: int, low: int, high: int, size: int) -> None:
        """Compare words from ``low`` to ``high`` with those a period later, and beyond while they are equal."""
        ids, limit = self._ids, self.n - period
        low, high = max(0, low - size), min(limit, high + size)
        while low and ids[low] == ids[low + period]:
            low = max(0, low - size)
        while high < limit and ids[high - 1] == ids[high - 1 + period]:
            high = min(limit, high + size)
        same = np.concatenate([[False], ids[low:high] == ids[low + period:high + period], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip((turns[::2] + low).tolist(), (turns[1::2] + low + period).tolist(), strict=True):
            if b - a - period < self._needed(period):
                continue
            run = (a, b)
            if run not in self._final and run not in self._growing:
                (self._growing if b == self.n else self._final)[run] = period


def runs_of(ids: Iterable[int], min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers."""
    ids, catchers = np.asarray(ids, np.int64), SquareCatchers(min_exponent, min_length)
    for at in range(0, len(ids), APPEND):
        catchers.append(ids[at:at + APPEND])
    return catchers.runs()


def _collapse(parts: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats, with one space between."""
    if not runs:
        return b" ".join(parts)
    kept = np.ones(len(parts), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return b" ".join([parts[i] for i in np.flatnonzero(kept).tolist()])


def _scan(min_exponent: int, min_length: int):
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                # Bytes are split at the six ASCII blanks, and only there.
                parts = text.encode("utf-8", "surrogatepass").split() if text else []
                number = {w: i for i, w in enumerate(dict.fromkeys(parts))}
                runs = runs_of(np.fromiter(map(number.__getitem__, parts), np.int64, len(parts)), min_exponent, min_length)
                listed = [{"start": a, "length": n, "period": p} for a, n, p in runs]
                rows.append((len(parts), listed, _collapse(parts, runs).decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])

    return scan


def word_runs(text: Column | str, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> Column:
    """Struct n_words, runs (start, length, period; by start, then period), collapsed.

    Words are cut at ASCII white space and numbered from 0.  A run is a stretch of words
    with smallest period ``period`` that no neighbouring word continues, ``min_exponent``
    periods and ``min_length`` words long at least.  ``collapsed`` has the words that no
    run holds after its first period, with one space between.  Null, empty and blank
    texts have no words and no runs.  Whole texts are read; memory is a few
    numbers per word of the longest text.
    """
    return F.pandas_udf(_scan(min_exponent, min_length), RUNS)(column(text))


def find_runs(docs: DataFrame, text: str = "text", out: str = "periodic", **limits: int) -> DataFrame:
    """The rows with a struct column ``out``, see ``word_runs``.

    Every row is judged for itself, without a shuffle: repeated rows give equal results,
    null keys are no different, an empty table gives no rows, an existing column
    ``out`` is replaced and other names, dotted ones too, stay as they are.
    """
    rows = whole_rows(docs.drop(out), word_runs(F.col(f"`{text}`"), **limits).alias(out))
    return rows.select(f"{ROW}.*", f"`{out}`")


def collapse_runs(docs: DataFrame, text: str = "text", **limits: int) -> DataFrame:
    """The rows with runs taken out of texts that have some; other texts, null ones too, and all columns stay."""
    name = "_collapsed"
    while name in docs.columns:
        name += "_"
    found = find_runs(docs, text, name, **limits)
    changed = F.when(F.size(f"{name}.runs") > 0, F.col(name)["collapsed"]).otherwise(F.col(f"`{text}`"))
    return found.select(*[changed.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def planted(key: Column | str, text: Column | str) -> Column:
    """The text with a run of the contract in one of ten documents, chosen by the CRC-32 of the key.

    With checksum ``h``, ``g = h div 10`` and ``n`` words, a document with ``h % 10 = 0`` repeats the
    ``1 + (n - a) div (3 + g % 8)`` words from ``a = g % n`` on to its end.  Others, and
    those with a null key or without words, are unchanged.
    """
    checksum = F.crc32(column(key).cast("string").cast("binary"))

    def repeat(shape: Column) -> Column:
        parts, g = shape["words"], shape["g"]
        n = F.size(parts).cast("long")

        def spread(at: Column) -> Column:
            period = F.lit(1) + F.floor((n - at) / (F.lit(3) + g % 8))
            source = lambda i: F.when(i < at, i).otherwise(at + (i - at) % period)
            return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(parts, source(i).cast("int"))), " ")

        return F.when(n > 0, let(g % n, spread)).otherwise(column(text))

    shape = F.struct(words(text).alias("words"), F.floor(checksum / 10).alias("g"))
    return F.when(checksum % 10 == 0, let(shape, repeat)).otherwise(column(text))


def run_digests(found: Column | str) -> list[Column]:
    """n_runs, the longest run's start, length, period and exponent_milli, and the digests of runs and collapsed text."""
    found = column(found)
    runs = found["runs"]
    # Of equal lengths the smallest start, then the smallest period.
    best = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return [
        F.size(runs).cast("long").alias("n_runs"), (-best["start"]).alias("start"), best["length"].alias("length"),
        (-best["period"]).alias("period"), F.floor(F.lit(1000) * best["length"] / -best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(found["collapsed"], 256).alias("collapsed_sha256"),
    ]
