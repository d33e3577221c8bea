"""Many topics at once: an index of the rarest windows of the topics, met by every text where it is.

A text that contains a topic contains each window of its bytes.  So every topic is filed under
one window, the one that fewest topics share, and a text looks up only its own windows:
the work follows the text and its hits, not the number of topics.  A small index
reaches the tasks whole.  Beyond ``INDEX_BYTES`` bits tell which strings of a text may be
topics, and a join of these strings with the topics tells which are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.operators.scratch import materialized, settings

#: Window sizes; a topic is filed under one of the largest size that it holds.
SIZES = (1, 2, 4, 8)
#: Bytes of an index that the driver and a task hold; more topics are joined with the windows of the texts.
INDEX_BYTES = 16 << 20
#: Bytes that a topic takes beside its text.
_ENTRY_BYTES = 40
#: Bytes of a text whose windows are looked up at a time.
PIECE = 1 << 20
#: Windows are counted in 2 ** so many counters a size.
COUNTER_BITS = 21
_BLOCK = 1 << 16
#: Beyond an index, at most 2 ** so many bits tell which strings may be topics; with more topics more strings pass that are none.
FILTER_BITS = 29
#: Bits that are set for a whole topic.
_PROBES = 8
#: Texts that reach Python together with the strings that are found in them.
_TEXTS = "256"
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_TWIST = np.uint64(0xC2B2AE3D27D4EB4F)
_TURN = np.uint64(0x165667B19E3779F9)
#: Added to a width: what the numbers of beginnings and ends are mixed with.
_BEGIN, _END = np.array([1 << 32], np.uint64), np.array([1 << 33], np.uint64)


def _windows(raw: np.ndarray, size: int) -> np.ndarray:
    """The numbers that ``size`` bytes in a row form, at each place."""
    out, width = raw.astype(np.uint64), 1
    while width < size:
        out = out[:-width] | out[width:] << np.uint64(8 * width)
        width *= 2
    return out


def _slots(windows: np.ndarray, bits: int) -> np.ndarray:
    return windows * _SPREAD >> np.uint64(64 - bits)


def _topic_windows(topics: pd.Series) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(size, topic, window, place), arrays but for the size: every window of the topics, by their sizes."""
    raw = [t.encode("utf-8", "surrogatepass") for t in topics]
    size = np.array([max(s for s in SIZES if s <= len(r)) for r in raw], np.int64)
    count = np.array([len(r) for r in raw], np.int64) - size + 1
    # All topics of one size as one text; windows that reach into the next topic are passed over.
    for each in np.unique(size).tolist():
        mine = np.flatnonzero(size == each)
        joined = np.frombuffer(b"".join(raw[i] for i in mine.tolist()), np.uint8)
        starts = np.cumsum(count[mine] + each - 1) - (count[mine] + each - 1)
        at = np.arange(count[mine].sum()) - np.repeat(np.cumsum(count[mine]) - count[mine], count[mine])
        yield each, np.repeat(mine, count[mine]), _windows(joined, each)[np.repeat(starts, count[mine]) + at], at


def _count_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The counters of a task, in blocks of ``_BLOCK``."""
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for size, _, grams, _ in _topic_windows(batch["topic"]):
            total = counts.setdefault(size, np.zeros(1 << COUNTER_BITS, np.int64))
            total += np.bincount(_slots(grams, COUNTER_BITS).astype(np.int64), minlength=len(total))
    for size, total in counts.items():
        blocks = [x.astype(np.int32).tobytes() for x in total.reshape(-1, _BLOCK)]
        yield pd.DataFrame({"size": np.int32(size), "block": np.arange(len(blocks), dtype=np.int32), "n": blocks})


def _add_counts(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(n, np.int32) for n in rows["n"]], axis=0, dtype=np.int64)
    return rows.head(1)[["size", "block"]].assign(n=np.minimum(total, np.iinfo(np.int32).max).astype(np.int32).tobytes())


def _window_counts(topics: DataFrame) -> dict[int, np.ndarray]:
    """By size: how many windows of topics fall to each of 2 ** ``COUNTER_BITS`` counters; no window has more than its counter."""
    schema = "size int, block int, n binary"
    rows = topics.mapInPandas(_count_windows, schema).groupBy("size", "block").applyInPandas(_add_counts, schema)
    counts: dict[int, np.ndarray] = {}
    for size, block, n in rows.collect():
        counts.setdefault(size, np.zeros(1 << COUNTER_BITS, np.int32))[block * _BLOCK:(block + 1) * _BLOCK] = np.frombuffer(n, np.int32)
    return counts


def _rarest(counts):
    """File each topic under the first of its windows with the least counter."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, topic, grams, at in _topic_windows(batch["topic"]):
                order = np.lexsort((at, counts.value[size][_slots(grams, COUNTER_BITS)], topic))
                first = order[np.flatnonzero(np.diff(topic[order], prepend=-1))]
                yield pd.DataFrame({
                    "topic": batch["topic"].to_numpy()[topic[first]], "size": np.int32(size),
                    "gram": grams[first].view(np.int64), "at": at[first].astype(np.int32)})

    return rows


def topic_keys(topics: DataFrame, topic: str = "topic") -> DataFrame:
    """(topic, size, gram, at): each distinct topic in lower case with its rarest window and where that starts, in bytes.

    Null and empty topics are left out; of equally rare windows the first is taken.  Windows
    are counted by hash, in counters whose number is bounded, so topics move once and
    windows never; where windows share a counter, another than the rarest may be taken.
    """
    return _filed(_distinct_topics(topics, topic))


def _distinct_topics(topics: DataFrame, topic: str) -> DataFrame:
    distinct = topics.select(F.lower(topic).alias("topic")).where(F.col("topic") != "").distinct()
    with settings(topics.sparkSession, drop_shuffles="true"):
        return materialized(distinct)


def _filed(distinct: DataFrame) -> DataFrame:
    counts = distinct.sparkSession.sparkContext.broadcast(_window_counts(distinct))
    return distinct.mapInPandas(_rarest(counts), "topic string, size int, gram long, at int")


class TopicIndex:
    """Topics filed under windows: sorted window numbers, and for each the topics with the window's place in them."""

    def __init__(self, keyed: pd.DataFrame) -> None:
        keyed = keyed.sort_values(["size", "gram", "topic"], ignore_index=True)
        self.topics = keyed["topic"].tolist()
        self.raw = [t.encode("utf-8", "surrogatepass") for t in self.topics]
        self.at, self.parts = keyed["at"].to_numpy(np.int64), {}
        for size, rows in keyed.groupby("size"):
            grams = rows["gram"].to_numpy(np.int64).copy().view(np.uint64)
            order = np.argsort(grams, kind="stable")
            keys, starts = np.unique(grams[order], return_index=True)
            bits = max(10, int(np.ceil(np.log2(8 * len(keys)))))
            known = np.zeros(1 << bits, bool)
            known[_slots(keys, bits)] = True
            self.parts[int(size)] = keys, np.append(starts, len(grams)), rows.index.to_numpy()[order], bits, known

    def _candidates(self, raw: bytes) -> Iterator[tuple[int, int]]:
        """(topic, start): where a text has a topic's window."""
        for base in range(0, len(raw), PIECE):
            piece = np.frombuffer(raw, np.uint8, min(len(raw) - base, PIECE + SIZES[-1] - 1), base)
            for size, (keys, starts, topics, bits, known) in self.parts.items():
                if len(piece) < size:
                    continue
                windows = _windows(piece, size)[:PIECE]
                places = np.flatnonzero(known[_slots(windows, bits)])
                group = np.searchsorted(keys, windows[places])
                group[group == len(keys)] = 0
                hit = keys[group] == windows[places]
                for place, k in zip((places[hit] + base).tolist(), group[hit].tolist(), strict=True):
                    for t in topics[starts[k]:starts[k + 1]].tolist():
                        yield t, place - int(self.at[t])

    def found(self, text: str | None) -> Iterator[int]:
        """Topics of the text, each as often as it is met."""
        raw = (text or "").encode("utf-8", "surrogatepass")
        for t, start in self._candidates(raw):
            if start >= 0 and raw.startswith(self.raw[t], start):
                yield t


def _index_bytes(distinct: DataFrame) -> int:
    return distinct.agg(F.sum(F.octet_length("topic") + _ENTRY_BYTES)).first()[0] or 0


def _shared_index(keyed: DataFrame):
    """The index of topics whose size has been measured, for all tasks."""
    return keyed.sparkSession.sparkContext.broadcast(TopicIndex(keyed.toPandas()))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ b * _SPREAD + _TURN) * _TWIST
    return x ^ x >> np.uint64(32)


def _prints(raw: np.ndarray, widest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(width, numbers) for widths of 1, 2, 4, … up to ``widest``: a number for so many bytes in a row, at each place."""
    out, width = raw.astype(np.uint64), 1
    while width <= widest and len(out):
        yield width, out
        # Up to eight bytes the bytes themselves, then a hash of both halves.
        out = out[:-width] | out[width:] << np.uint64(8 * width) if width < 8 else _mixed(out[:-width], out[width:])
        width *= 2


def _string_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings, one after the other, and where each begins and the last ends; null is empty."""
    values = strings.cast(pa.large_binary()).fill_null(b"")
    _, places, data = values.buffers()
    places = np.frombuffer(places, np.int64)[values.offset:values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[places[0]:places[-1]], places - places[0]


def _groups(places: np.ndarray) -> Iterator[tuple[int, int]]:
    """Strings in a row, (first, after the last), of about ``PIECE`` bytes together; ``places`` as of ``_string_bytes``."""
    first = 0
    while first < len(places) - 1:
        last = max(first + 1, int(np.searchsorted(places, places[first] + PIECE, "right")) - 1)
        yield first, last
        first = last


def _cut_out(raw: np.ndarray, places: np.ndarray, length: np.ndarray) -> pa.Array:
    """The strings of ``length`` bytes from ``places`` on."""
    upto, parts = np.append(0, np.cumsum(length)), []
    for first, last in _groups(upto):
        own = length[first:last]
        parts.append(raw[np.repeat(places[first:last] - upto[first:last], own) + np.arange(upto[first], upto[last])])
    data = np.concatenate(parts) if parts else raw[:0]
    return pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(upto.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _string_prints(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each string, none empty, the numbers of its beginning, its end and the whole."""
    raw, places = _string_bytes(strings)
    starts, length = places[:-1], np.diff(places)
    width = np.int64(1) << np.frexp(length.astype(float))[1].astype(np.int64) - 1
    begin, end, whole = (np.zeros(len(starts), np.uint64) for _ in range(3))
    for first, last in _groups(places):
        base = places[first]
        for each, prints in _prints(raw[base:places[last]], int(width[first:last].max())):
            mine = np.flatnonzero(width[first:last] == each) + first
            head, tail = prints[starts[mine] - base], prints[starts[mine] - base + length[mine] - each]
            begin[mine], end[mine] = _mixed(head, _BEGIN + np.uint64(each)), _mixed(tail, _END + np.uint64(each))
            whole[mine] = _mixed(_mixed(head, tail), length[mine].astype(np.uint64))
    return begin, end, whole


def _probe(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1).view(bool)


def _whole_slots(whole: np.ndarray, bits: int, i: int) -> np.ndarray:
    return whole * _SPREAD + np.uint64(i) * (whole * _TWIST | np.uint64(1)) >> np.uint64(64 - bits)


def _set_bits(bits: int):
    """The bits of the topics of a task, in blocks of ``_BLOCK`` bytes that have any."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(1 << bits - 3, np.uint8)
        for batch in batches:
            begin, end, whole = _string_prints(batch.column("topic"))
            for slots in (_slots(begin, bits), _slots(end, bits), *(_whole_slots(whole, bits, i) for i in range(_PROBES))):
                np.bitwise_or.at(bitmap, slots >> np.uint64(3), np.uint8(1) << (slots & np.uint64(7)).astype(np.uint8))
        for block in range(-(-len(bitmap) // _BLOCK)):
            part = bitmap[block * _BLOCK:(block + 1) * _BLOCK]
            if part.any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "bits": [zlib.compress(part.tobytes(), 1)]})

    return rows


def _join_bits(rows: pd.DataFrame) -> pd.DataFrame:
    whole = np.bitwise_or.reduce([np.frombuffer(zlib.decompress(b), np.uint8) for b in rows["bits"]])
    return rows.head(1)[["block"]].assign(bits=zlib.compress(whole.tobytes(), 1))


def _known_strings(strings: DataFrame) -> tuple[int, np.ndarray, dict[int, list[int]]]:
    """(bits, bitmap, lengths by width) of distinct topics: ``_PROBES`` bits for each and two for its ends, 2 ** ``FILTER_BITS`` at most."""
    sizes = strings.groupBy(F.octet_length("topic").alias("n")).agg(F.count("*").alias("k")).collect()
    bits = min(FILTER_BITS, max(15, (32 * sum(r["k"] for r in sizes)).bit_length()))
    # As many tasks as run at once, since each has a bitmap of its own.
    few = strings.coalesce(strings.sparkSession.sparkContext.defaultParallelism)
    schema, bitmap = "block int, bits binary", np.zeros(1 << bits - 3, np.uint8)
    for block, part in few.mapInArrow(_set_bits(bits), schema).groupBy("block").applyInPandas(_join_bits, schema).collect():
        piece = np.frombuffer(zlib.decompress(part), np.uint8)
        bitmap[block * _BLOCK:block * _BLOCK + len(piece)] = piece
    lengths: dict[int, list[int]] = {}
    for n in sorted(r["n"] for r in sizes):
        lengths.setdefault(1 << n.bit_length() - 1, []).append(n)
    return bits, bitmap, lengths


def _first_places(row: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Which strings of one length to keep so that a text has each of them once; those of 16 bytes at most are told apart by all their bytes."""
    _, first, same = np.unique(_mixed(_mixed(head, tail), row.astype(np.uint64)), return_index=True, return_inverse=True)
    own = first[same]
    other = (row != row[own]) | (head != head[own]) | (tail != tail[own])
    return np.append(first, np.flatnonzero(other))


def _met_in(raw: np.ndarray, ends: np.ndarray, known) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, texts, places): where texts, one after the other, have the bits of a topic of that length; ``ends`` has the end of each text.

    What a text has several times is met once in each piece.
    """
    bits, bitmap, lengths = known
    longest = max(n[-1] for n in lengths.values())
    step = max(PIECE, longest)
    for base in range(0, len(raw), step):
        for width, prints in _prints(raw[base:base + step + longest - 1], max(lengths)):
            if width not in lengths:
                continue
            at = np.flatnonzero(_probe(bitmap, _slots(_mixed(prints[:step], _BEGIN + np.uint64(width)), bits)))
            closes = _probe(bitmap, _slots(_mixed(prints, _END + np.uint64(width)), bits))
            room = ends[np.searchsorted(ends, at + base, "right")] - base - at
            for n in lengths[width]:
                at, room = at[room >= n], room[room >= n]
                if not len(at):
                    break
                places = at[closes[at + (n - width)]]
                whole = _mixed(_mixed(prints[places], prints[places + (n - width)]), np.array([n], np.uint64))
                for i in range(_PROBES):
                    there = _probe(bitmap, _whole_slots(whole, bits, i))
                    places, whole = places[there], whole[there]
                row = np.searchsorted(ends, places + base, "right")
                first = _first_places(row, prints[places], prints[places + (n - width)])
                yield n, row[first], places[first] + base


def _inside(raw: np.ndarray) -> np.ndarray:
    """Where a byte goes on with the character before it."""
    return np.append(raw & 0xC0 == 0x80, False)


def _met_topics(text: Column, known) -> Column:
    """The strings of a text that have the bits of a topic, all its topics among them."""

    @F.arrow_udf("array<string>")
    def met(texts: pa.Array) -> pa.Array:
        raw, bounds = _string_bytes(texts)
        inside, parts = _inside(raw), [pa.array([], pa.list_(pa.string()))]
        for first, last in _groups(bounds):
            base, hits = bounds[first], []
            for n, row, places in _met_in(raw[base:bounds[last]], bounds[first + 1:last + 1] - base, known.value):
                whole = ~(inside[places + base] | inside[places + base + n])
                hits.append((row[whole], places[whole] + base, np.full(whole.sum(), n)))
            row, places, length = (np.concatenate([h[i] for h in hits]) if hits else np.zeros(0, np.int64) for i in range(3))
            order = np.argsort(row, kind="stable")
            upto = np.append(0, np.cumsum(np.bincount(row, minlength=last - first))).astype(np.int32)
            parts.append(pa.ListArray.from_arrays(upto, _cut_out(raw, places[order], length[order])))
        return pa.concat_arrays(parts)

    return F.array_distinct(met(text))


def _doubtful(met: Column, known) -> Column:
    """Of an array of strings those that have the bits of a known one."""

    @F.arrow_udf("array<string>")
    def doubtful(arrays: pa.Array) -> pa.Array:
        bits, bitmap, _ = known.value
        strings, places = arrays.flatten(), arrays.offsets.to_numpy()
        there = np.ones(len(strings), bool)
        whole = _string_prints(strings)[2]
        for i in range(_PROBES):
            there &= _probe(bitmap, _whole_slots(whole, bits, i))
        kept = np.append(0, np.cumsum(there))[places - places[0]]
        return pa.ListArray.from_arrays(kept.astype(np.int32), strings.filter(pa.array(there)))

    return doubtful(met)


def _with_met_topics(df: DataFrame, distinct: DataFrame, text: str) -> DataFrame:
    """The rows with the array ``_topics`` of the topics that the text contains, each once.

    Bits tell which strings of a text may be topics.  All such strings are then met with
    the topics, and rows lose those that are none.  So the texts are never
    moved, and what is moved is each string once for a task, not once for a place.
    """
    spark = distinct.sparkSession
    share = spark.sparkContext.broadcast
    with settings(spark, drop_shuffles="true"):
        known = share(_known_strings(distinct))
        met = _met_topics(F.lower(F.col(f"`{text}`")), known)
        with settings(spark, batch=_TEXTS):
            rows = materialized(df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_topics", met))
        strings = rows.select(F.explode("_topics").alias("topic")).distinct()
        wrong = materialized(strings.join(distinct, "topic", "left_anti"))
        if wrong.isEmpty():
            return rows.drop("_row")
        doubtful = _doubtful(F.col("_topics"), share(_known_strings(wrong)))
        doubts = rows.select(F.col("_row").alias("r"), F.explode(doubtful).alias("topic")).join(wrong, "topic", "left_semi")
        with settings(spark, batch=_TEXTS):
            lost = materialized(doubts.groupBy("r").agg(F.collect_list("topic").alias("_lost")))
    kept = F.when(F.col("_lost").isNull(), F.col("_topics")).otherwise(F.array_except("_topics", "_lost"))
    return rows.join(lost, F.col("_row") == F.col("r"), "left").withColumn("_topics", kept).drop("_row", "r", "_lost")


def _has_topic(text: Column, index) -> Column:
    @F.pandas_udf("boolean")
    def has(texts: pd.Series) -> pd.Series:
        return pd.Series([next(index.value.found(t), None) is not None for t in texts], dtype="bool")

    return has(F.lower(text))


def _topics_of(text: Column, index) -> Column:
    @F.pandas_udf("array<string>")
    def listed(texts: pd.Series) -> pd.Series:
        return pd.Series([[index.value.topics[i] for i in sorted(set(index.value.found(t)))] for t in texts], dtype="object")

    return listed(F.lower(text))


def match_topic_table(
    df: DataFrame, topics: DataFrame, text: str = "text", topic: str = "topic", index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """Rows whose text contains any topic of a table, ignoring case.

    Null and empty topics and null texts match nothing; repeated topics count once.  Rows
    need no identity, and none is repeated.  Topics whose index would exceed
    ``index_bytes`` are joined with the strings of the texts that may be topics, and the
    rows are written once before; the answer is the same.
    """
    distinct = _distinct_topics(topics, topic)
    total = _index_bytes(distinct)
    if not total:
        return df.limit(0)
    if total <= index_bytes:
        return df.where(_has_topic(F.col(f"`{text}`"), _shared_index(_filed(distinct))))
    return _with_met_topics(df, distinct, text).where(F.size("_topics") > 0).drop("_topics")


def with_topics(
    df: DataFrame, topics: DataFrame, text: str = "text", topic: str = "topic", out: str = "topics", index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """Add the sorted array ``out`` of the topics, in lower case, that each text contains; empty where none is."""
    distinct = _distinct_topics(topics, topic)
    total = _index_bytes(distinct)
    if not total:
        return df.withColumn(out, F.array().cast("array<string>"))
    if total <= index_bytes:
        return df.withColumn(out, F.array_sort(_topics_of(F.col(f"`{text}`"), _shared_index(_filed(distinct)))))
    return _with_met_topics(df, distinct, text).withColumn(out, F.array_sort("_topics")).drop("_topics")
