"""Removal of long repeated strings with a logarithmic family of sparse suffix arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.anchors import window_anchors
from lexmill.operators.scratch import materialized

LENGTH = 400
#: Leading bytes by which suffixes are compared in the arrays.
GRAM = 64
BATCHES = 4
#: Different surroundings of one anchor that a task compares; with more, their windows are counted by Spark.
GROUP_LIMIT = 20_000
#: Bytes of text that a task works on together.
CHUNK = 4 << 20


def _row_key(key: Column, text: Column) -> list[Column]:
    """Identity of a row by its content, in 128 bits; equal rows share it."""
    return [F.xxhash64(key, text).alias("k1"), F.xxhash64(text, F.lit(1), key).alias("k2")]


_ANCHORS = "k1 long, k2 long, head long, print long, hull long, place int, first int, last int, times int"


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _met_again(rows: pd.DataFrame) -> pd.DataFrame:
    """Equal rows of a text become the first of them and their number (times); their starts come as runs (times 0).

    A run of one letter or of a short period has an anchor at nearly every place, all
    with the same surroundings, whose windows repeat whatever other texts hold.
    """
    same = ["text", "head", "print", "hull"]
    again = rows.duplicated(same, keep=False).to_numpy()
    rows["times"] = np.int32(1)
    if not again.any():
        return rows
    equal = rows[again]
    text, first, last = (equal[c].to_numpy() for c in ("text", "first", "last"))
    new = np.concatenate(([True], (text[1:] != text[:-1]) | (first[1:] != last[:-1] + 1)))
    at = np.flatnonzero(new)
    runs = equal.iloc[at].assign(last=last[np.concatenate((at[1:] - 1, [len(last) - 1]))], times=np.int32(0))
    one = equal.drop_duplicates(same).assign(times=equal.groupby(same, sort=False).size().to_numpy(np.int32))
    return pd.concat([rows[~again], one, runs])


def _anchor_rows(length: int, gram: int):
    """Per window run: the suffix at its anchor (first bytes in text order, hash of ``gram`` bytes) and its surroundings."""

    def of(keys: list[tuple[int, int]], texts: list[bytes]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_64_intdigest
        for text, place, first, last in window_anchors(texts, length, gram):
            head, prints, hulls = [], [], []
            for t, p, a, b in zip(text.tolist(), place.tolist(), first.tolist(), last.tolist(), strict=True):
                body = texts[t]
                head.append(int.from_bytes(body[p:p + 8]) ^ 1 << 63)
                prints.append(digest(body[p:p + gram]))
                hulls.append(digest(body[a:b + length]))
            found = _met_again(pd.DataFrame({
                "text": text, "head": _signed(head), "print": _signed(prints), "hull": _signed(hulls),
                "place": place.astype(np.int32), "first": first.astype(np.int32), "last": last.astype(np.int32)}))
            both = np.array(keys, np.int64)[found.pop("text").to_numpy()]
            found.insert(0, "k1", both[:, 0])
            found.insert(1, "k2", both[:, 1])
            yield found

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, texts, size = [], [], 0
        for batch in batches:
            for k1, k2, text in zip(batch["k1"], batch["k2"], batch["text"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                if len(raw) < length:
                    continue
                if texts and size + len(raw) > CHUNK:
                    yield from of(keys, texts)
                    keys, texts, size = [], [], 0
                keys.append((k1, k2))
                texts.append(raw)
                size += len(raw)
        if texts:
            yield from of(keys, texts)

    return rows


class SuffixArrayFamily:
    """Sorted arrays of suffixes; level n holds the entries of 2 ** n batches, at most one array a level.

    An entry is a suffix at an anchor, given by its first bytes in text order and a hash
    of its first ``gram`` bytes.  A new batch becomes an array, is merge-scanned against
    every level for suffixes that agree that far, and then joins the levels: two
    arrays of one size are merged into one of the next, so each entry is rewritten a
    logarithmic number of times.
    """

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}

    @staticmethod
    def _array(entries: DataFrame) -> DataFrame:
        return materialized(entries.repartitionByRange("head", "print").sortWithinPartitions("head", "print"))

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Enter a batch (columns head, print); returns the entries seen twice or more by now because of it."""
        array = self._array(suffixes.groupBy("head", "print").agg(F.count("*").alias("n")))
        repeated = array.where("n > 1").select("head", "print")
        entries = array.select("head", "print")
        for level in self.levels.values():
            repeated = repeated.union(entries.join(level, ["head", "print"]))
        found = materialized(repeated.distinct())
        rank = 0
        while rank in self.levels:
            entries = self._array(entries.union(self.levels.pop(rank)).distinct())
            rank += 1
        self.levels[rank] = entries
        return found


def repeated_suffixes(anchors: DataFrame, batches: int) -> DataFrame:
    """(head, print) of suffixes that occur more than once; documents arrive in ``batches`` parts by their hash."""
    family = SuffixArrayFamily()
    found = None
    for n in range(batches):
        new = family.add(anchors.where(F.pmod("k1", F.lit(batches)) == n).select("head", "print"))
        found = new if found is None else found.union(new)
    return materialized(found.distinct())


def _windows(body: bytes, length: int) -> list[int]:
    digest = xxhash.xxh3_64_intdigest
    return [digest(body[i:i + length]) for i in range(len(body) - length + 1)]


_WANTED = ("head", "print", "hull", "n", "big", "place", "first", "stop")


def _surroundings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut the wanted stretches out of each text; the lists of a text are parallel arrays."""
    for batch in batches:
        parts: dict[str, list] = {c: [] for c in (*_WANTED, "k1", "k2")}
        bodies: list[bytes] = []
        size = 0

        def frame(parts=parts, bodies=bodies) -> pd.DataFrame:
            c = {name: np.concatenate(values) for name, values in parts.items()}
            return pd.DataFrame({
                "head": c["head"], "print": c["print"], "hull": c["hull"], "single": c["n"] == 1, "big": c["big"].astype(bool),
                "k1": c["k1"], "k2": c["k2"], "place": c["place"], "first": c["first"], "body": bodies})

        for row in batch.itertuples(index=False):
            raw = zstandard.decompress(row.packed)
            for name in _WANTED:
                parts[name].append(np.asarray(getattr(row, f"w_{name}")))
            n = len(row.w_first)
            parts["k1"].append(np.full(n, row.k1, np.int64))
            parts["k2"].append(np.full(n, row.k2, np.int64))
            cuts = [raw[i:j] for i, j in zip(row.w_first.tolist(), row.w_stop.tolist(), strict=True)]
            bodies += cuts
            size += sum(map(len, cuts))
            if size > CHUNK:
                yield frame()
                for values in parts.values():
                    values.clear()
                bodies.clear()
                size = 0
        if bodies:
            yield frame()


_SURROUNDED = "head long, print long, hull long, single boolean, big boolean, k1 long, k2 long, place int, first int, body binary"
_MARKS = "k1 long, k2 long, first int, last int"


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.concatenate(([0], cuts + 1))].tolist(), starts[np.concatenate((cuts, [len(starts) - 1]))].tolist(), strict=True))


def _compare_groups(length: int):
    """Rows sorted by suffix: among the different surroundings of one suffix, mark windows that two of them have."""

    def marks(group: list) -> Iterator[tuple[int, int, int, int]]:
        distinct = list({r.hull: r for r in group}.values())
        if len(distinct) < 2:
            return
        hashes = [np.array(_windows(r.body, length), np.uint64) for r in distinct]
        # Distance from window to anchor: only windows with the same one can be equal.
        apart = [r.place - r.first - np.arange(len(h)) for r, h in zip(distinct, hashes, strict=True)]
        mixed = np.concatenate([h ^ (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for h, a in zip(hashes, apart, strict=True)])
        _, back, count = np.unique(mixed, return_inverse=True, return_counts=True)
        twice = count[back] > 1
        at = 0
        for r, h in zip(distinct, hashes, strict=True):
            mine = np.flatnonzero(twice[at:at + len(h)])
            at += len(h)
            if r.single and len(mine):
                for a, b in _runs(mine):
                    yield r.k1, r.k2, r.first + a, r.first + b

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, group, out = None, [], []
        for batch in batches:
            for row in batch.itertuples(index=False):
                if (row.head, row.print) != held:
                    out += marks(group)
                    held, group = (row.head, row.print), []
                    if len(out) > 50_000:
                        yield pd.DataFrame(out, columns=["k1", "k2", "first", "last"])
                        out = []
                group.append(row)
        out += marks(group)
        if out:
            yield pd.DataFrame(out, columns=["k1", "k2", "first", "last"])

    return compare


def _window_rows(length: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                h = _windows(r.body, length)
                starts = np.arange(len(h), dtype=np.int32) + np.int32(r.first)
                yield pd.DataFrame({
                    "head": r.head, "print": r.print, "apart": np.int32(r.place) - starts, "window": _signed(h),
                    "single": r.single, "k1": r.k1, "k2": r.k2, "first": starts, "last": starts})

    return rows


def repeated_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES) -> DataFrame:
    """(k1, k2, first, last): runs of starts in a document whose windows also start elsewhere.

    ``docs`` has k1, k2, text and packed (the text, compressed).  Each window has one
    anchor.  What a text repeats itself is marked where it is found.  Suffixes at anchors
    that occur twice come from the family of arrays; rows with the same suffix and the
    same surroundings are equal throughout; what remains are different surroundings of
    one suffix, whose windows are compared one by one.
    """
    if length < gram:
        raise ValueError("length must not be less than gram")
    found = materialized(docs.where("text is not null").select("k1", "k2", "text").mapInPandas(_anchor_rows(length, gram), _ANCHORS))
    own, anchors = found.where("times = 0").select("k1", "k2", "first", "last"), found.where("times > 0")
    suffix = ["head", "print"]
    repeated = materialized(anchors.join(repeated_suffixes(anchors, batches), suffix))
    one = F.struct("k1", "k2", "place", "first", "last")
    classes = materialized(repeated.groupBy(*suffix, "hull").agg(F.sum("times").alias("n"), F.min(one).alias("one")))
    same = repeated.where("times = 1").join(classes.where("n > 1").select(*suffix, "hull"), [*suffix, "hull"]).select("k1", "k2", "first", "last")
    several = classes.groupBy(*suffix).agg(F.count("*").alias("classes")).where("classes > 1")
    wanted = classes.join(several, suffix).select(
        "one.k1", "one.k2", F.struct("head", "print", "hull", "n", (F.col("classes") > GROUP_LIMIT).alias("big"), "one.place", "one.first", (F.col("one.last") + length).alias("stop")).alias("w"))
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list("w").alias("wanted"))
    columns = lists.select("k1", "k2", *[F.col(f"wanted.{c}").alias(f"w_{c}") for c in _WANTED])
    cut = materialized(docs.select("k1", "k2", "packed").join(columns, ["k1", "k2"]).mapInPandas(_surroundings, _SURROUNDED))
    near = cut.where("not big").drop("big").repartition(*suffix).sortWithinPartitions(*suffix).mapInPandas(_compare_groups(length), _MARKS)
    rows = cut.where("big").drop("big").dropDuplicates([*suffix, "hull"]).mapInPandas(
        _window_rows(length), "head long, print long, apart int, window long, single boolean, k1 long, k2 long, first int, last int")
    twice = rows.groupBy(*suffix, "apart", "window").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    far = rows.where("single").join(twice, [*suffix, "apart", "window"]).select("k1", "k2", "first", "last")
    return own.unionByName(same).unionByName(near).unionByName(far)


def _cut_spans(length: int):
    """n_bytes, n_removed, n_spans, kept_sha256 and the removed spans of each document."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            out = []
            for packed, firsts, lasts in zip(batch["packed"], batch["firsts"], batch["lasts"], strict=True):
                raw = zstandard.decompress(packed)
                spans: list[list[int]] = []
                marks = () if firsts is None else sorted(zip(firsts.tolist(), lasts.tolist(), strict=True))
                for first, last in marks:
                    if spans and first <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], last + length)
                    else:
                        spans.append([first, last + length])
                digest, at = hashlib.sha256(), 0
                for a, b in spans:
                    digest.update(raw[at:a])
                    at = b
                digest.update(raw[at:])
                out.append((len(raw), sum(b - a for a, b in spans), len(spans), digest.hexdigest(), [{"start": a, "stop": b} for a, b in spans]))
            frame = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
            frame.insert(0, "key", batch["key"].to_numpy())
            yield frame

    return cut


def _packed(text: str) -> Column:
    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        pack = zstandard.ZstdCompressor(level=3).compress
        return pd.Series([pack((t or "").encode("utf-8", "surrogatepass")) for t in texts], dtype="object")

    return packed(text)


def find_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES,
) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, spans) per row.

    A byte of the UTF-8 text is removed if a string of ``length`` bytes that covers it
    also starts at another place, in the same or another document; strings are
    judged on the input and never cross documents.  ``spans`` are the maximal removed
    runs (bytes, the end exclusive), ``kept_sha256`` the digest of the bytes that stay.

    Null texts are empty; texts shorter than ``length`` lose nothing; repeated rows are
    copies of each other; a null key is kept; an empty table gives no rows; other
    columns are ignored.  Texts move compressed, to meet the lists of their own places.
    """
    named = docs.select(F.col(key).alias("key"), *_row_key(F.col(key), F.col(text)), F.col(text).alias("text"))
    packed = named.withColumn("packed", _packed("text"))
    marks = repeated_windows(packed, length, gram, batches)
    lists = marks.groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("marks"))
    joined = packed.select("key", "k1", "k2", "packed").join(lists, ["k1", "k2"], "left").select(
        "key", "packed", F.col("marks.first").alias("firsts"), F.col("marks.last").alias("lasts"))
    kind = dict(joined.dtypes)["key"]
    done = joined.mapInPandas(
        _cut_spans(length),
        f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,stop:int>>")
    return done.withColumnRenamed("key", key)


def remove_spans(text: Column | str, spans: Column | str) -> Column:
    """The text without byte spans; a character that is cut in the middle goes whole."""

    @F.pandas_udf("string")
    def remove(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        def kept(value, marked):
            if value is None:
                return None
            raw, at, parts = value.encode("utf-8", "surrogatepass"), 0, []
            for s in marked if marked is not None else ():
                parts.append(raw[at:s["start"]].decode("utf-8", "ignore"))
                at = s["stop"]
            return "".join([*parts, raw[at:].decode("utf-8", "ignore")])

        return pd.Series([kept(t, s) for t, s in zip(texts, cuts, strict=True)], dtype="object")

    return remove(F.col(text) if isinstance(text, str) else text, F.col(spans) if isinstance(spans, str) else spans)
