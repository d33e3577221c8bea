"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.words import ROW, whole_rows

#: Every byte that is no word byte becomes a blank: words are digits, a-z and all of U+0080 and above.
_WORD_BYTES = bytes(b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" or b >= 0x80 else 0x20 for b in range(256))
#: Words of items that one automaton may hold; more items go to further automata, one after another.
BLOCK_WORDS = 2_000_000
WINDOW = 13


def normalised_words(text: str | None) -> list[bytes]:
    """Lower-case A-Z and cut into words; null has none."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_WORD_BYTES).split() if text else []


@dataclass(frozen=True)
class Item:
    key: str | None
    words: tuple[bytes, ...]


class SuffixAutomaton:
    """All word sequences of the items, with the items in which a window occurs.

    A state stands for sequences with the same ends; ``longest`` is the length of
    the longest, ``link`` the state of the longest suffix that ends elsewhere too.
    """

    def __init__(self, items: Sequence[Item], window: int = WINDOW) -> None:
        self.window, self.items = window, list(items)
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        walked = []
        for item in self.items:
            word_ids = [self.ids.setdefault(w, len(self.ids)) for w in item.words]
            last = 0
            for c in word_ids:
                last = self._extend(last, c)
            walked.append(word_ids)
        self._label(walked)

    def _state(self, longest: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.longest.append(longest)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, at: int, c: int) -> int:
        """The state of ``at``'s longest sequence followed by c, split off if it is not the longest of its state."""
        q = self.next[at][c]
        if self.longest[q] == self.longest[at] + 1:
            return q
        copy = self._state(self.longest[at] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while at >= 0 and self.next[at].get(c) == q:
            self.next[at][c] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        new = self._state(self.longest[last] + 1, {}, 0)
        at = last
        while at >= 0 and c not in self.next[at]:
            self.next[at][c] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, c)
        return new

    def _label(self, walked: list[list[int]]) -> None:
        """For each state: the items with the window that it holds, and whole items shorter than a window."""
        windows: list[set[int] | None] = [None] * len(self.next)
        shorts: list[dict[int, set[int]] | None] = [None] * len(self.next)
        for i, word_ids in enumerate(walked):
            at, length = 0, 0
            for c in word_ids:
                at, length = self.next[at][c], length + 1
                while self.longest[self.link[at]] >= self.window if at else False:
                    at = self.link[at]
                    length = self.longest[at]
                if length >= self.window:
                    windows[at] = windows[at] or set()
                    windows[at].add(i)
            if 0 < len(word_ids) < self.window:
                shorts[at] = shorts[at] or {}
                shorts[at].setdefault(len(word_ids), set()).add(i)
        self.window_items = windows
        # Short items that end a sequence of the state, shortest sequences on the links included.
        self.short_items: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for v in sorted(range(1, len(self.next)), key=self.longest.__getitem__):
            own = [(n, i) for n, found in (shorts[v] or {}).items() for i in found]
            self.short_items[v] = own + self.short_items[self.link[v]]

    def hits(self, words: Iterable[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Maximal runs [start, end) of words inside an occurrence, and the items that occur.

        The longest match that ends at a word is kept while it is extended word by
        word; on a mismatch the links give the next shorter one.
        """
        follow, link, longest, window = self.next, self.link, self.longest, self.window
        window_items, short_items, ids = self.window_items, self.short_items, self.ids
        at, length = 0, 0
        runs: list[tuple[int, int]] = []
        found: set[int] = set()

        def cover(start: int, end: int) -> None:
            while runs and start <= runs[-1][1]:
                start = min(start, runs.pop()[0])
            runs.append((start, end))

        for i, word in enumerate(words):
            c = ids.get(word)
            if c is None:
                at = length = 0
                continue
            nxt = follow[at].get(c)
            if nxt is None:
                while at and nxt is None:
                    at = link[at]
                    nxt = follow[at].get(c)
                length = longest[at]
                if nxt is None:
                    continue
            at, length = nxt, length + 1
            if length >= window:
                cover(i + 1 - window, i + 1)
                # Shorten to the state that holds exactly the last window.
                while longest[link[at]] >= window:
                    at = link[at]
                    length = longest[at]
                found |= window_items[at]
            for n, item in short_items[at]:
                if n <= length:
                    cover(i + 1 - n, i + 1)
                    found.add(item)
        return runs, found


def _collect_block(items: DataFrame, key: str, text: str) -> list[Item]:
    rows = items.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).distinct().collect()
    found = [Item(r.k, tuple(normalised_words(r.t))) for r in rows]
    return sorted({i for i in found if i.words}, key=lambda i: (i.key is None, i.key or "", i.words))


def _blocks(items: DataFrame, key: str, text: str, block_words: int) -> Iterator[list[Item]]:
    """Lists of items with about ``block_words`` words at most, fetched one after another.

    Sizes are added up in Spark first, so no block larger than the bound reaches the driver.
    """
    words = F.regexp_count(F.lower(text), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    total = items.agg(F.coalesce(F.sum(words), F.lit(0)).alias("n")).first().n
    parts = -(-2 * total // block_words) if total > block_words else 1
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64(text), F.lit(parts)) == part) if parts > 1 else items
        yield _collect_block(mine, key, text)


_MATCHES = "n_words long, runs array<struct<start:int,stop:int>>, items array<string>"


def _match(text: Column, items: list[Item], window: int) -> Column:
    @F.pandas_udf(_MATCHES)
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = SuffixAutomaton(items, window)
        for batch in batches:
            rows = []
            for value in batch:
                words = normalised_words(value)
                runs, found = automaton.hits(words)
                keys = sorted({items[i].key for i in found if items[i].key is not None})
                rows.append((len(words), [{"start": a, "stop": b} for a, b in runs], keys))
            yield pd.DataFrame(rows, columns=["n_words", "runs", "items"])

    return match(text)


def _merged_runs(runs: Column) -> Column:
    """Union of runs that may overlap."""
    step = lambda acc, r: F.when(
        (F.size(acc) > 0) & (r["start"] <= F.element_at(acc, -1)["stop"]),
        F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["stop"], r["stop"]).alias("stop"))))).otherwise(
        F.concat(acc, F.array(r)))
    return F.aggregate(F.array_sort(runs), F.array().cast("array<struct<start:int,stop:int>>"), step)


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    min_share: tuple[int, int] = (1, 20),
    block_words: int = BLOCK_WORDS,
    out: str = "contamination",
) -> DataFrame:
    """Add struct ``out``: n_words, n_hit, n_items, items, runs, contaminated.

    A window is ``window`` words in a row of an item, or a whole shorter item.
    ``runs`` are the maximal runs of document words (numbered from 0) inside any
    occurrence of a window, ``items`` the keys of the items that occur, and a
    document is contaminated if its hit words are at least the share ``min_share`` (a
    fraction, so that the limit itself is exact) of all.

    Null and empty texts have no words and no hits; items without words never
    occur; a repeated item counts once; an item with a null key is matched but
    not listed.  An empty document table gives no rows, an empty item table no
    hits.  An existing column ``out`` is replaced, other columns stay.  Items beyond ``block_words`` words are matched by several automata, one
    after another, over the same rows without moving them.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    found = whole_rows(docs.drop(out), F.col(text).alias("_text"))
    names = []
    for n, block in enumerate(_blocks(items, item_key, item_text, block_words)):
        names.append(f"_contamination_{n}")
        found = found.withColumn(names[-1], _match(F.col("_text"), block, window))
    first = F.col(names[0])
    if len(names) == 1:
        runs, keys = first["runs"], first["items"]
    else:
        runs = _merged_runs(F.flatten(F.array(*[F.col(n)["runs"] for n in names])))
        keys = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(n)["items"] for n in names]))))
    n_hit = F.aggregate(runs, F.lit(0).cast("long"), lambda s, r: s + (r["stop"] - r["start"]))
    summary = F.struct(
        first["n_words"].alias("n_words"), n_hit.alias("n_hit"), F.size(keys).cast("long").alias("n_items"),
        keys.alias("items"), runs.alias("runs"),
        ((n_hit > 0) & (n_hit * min_share[1] >= first["n_words"] * min_share[0])).alias("contaminated"))
    return found.select(ROW, summary.alias(out)).select(f"{ROW}.*", out)


def remove_runs(text: Column | str, runs: Column | str) -> Column:
    """The text without the words of ``runs`` and what lies between them; other text is untouched."""

    @F.pandas_udf("string")
    def remove(texts: pd.Series, spans: pd.Series) -> pd.Series:
        def cut(value, marked):
            if value is None or marked is None or len(marked) == 0:
                return value
            raw = value.encode("utf-8", "surrogatepass")
            plain = raw.lower().translate(_WORD_BYTES)
            places, at = [], 0
            for w in plain.split():
                at = plain.index(w, at)
                places.append((at, at + len(w)))
                at += len(w)
            parts, at = [], 0
            for r in marked:
                parts.append(raw[at:places[r["start"]][0]])
                at = places[r["stop"] - 1][1]
            return b"".join([*parts, raw[at:]]).decode("utf-8", "surrogatepass")

        return pd.Series([cut(v, s) for v, s in zip(texts, spans, strict=True)], dtype="object")

    return remove(F.col(text) if isinstance(text, str) else text, F.col(runs) if isinstance(runs, str) else runs)


def decontaminate(
    docs: DataFrame, items: DataFrame, text: str = "text", max_run: int | None = None, **options,
) -> DataFrame:
    """Drop contaminated documents; with ``max_run``, cut longer runs out of the others.

    Columns stay as they are, whatever their names.  Options are those of ``find_contamination``.
    Null and empty texts are kept; texts of any length are read whole; repeated rows are
    treated alike and null keys are no different; a share that just meets the limit contaminates; an
    empty document table gives no rows, an empty item table drops none.
    """
    name = "_found"
    while name in docs.columns:
        name += "_"
    found = find_contamination(docs, items, text, out=name, **options)
    kept = found.where(~F.col(name)["contaminated"])
    if max_run is not None:
        long_runs = F.filter(F.col(name)["runs"], lambda r: r["stop"] - r["start"] > max_run)
        kept = kept.withColumn(text, F.when(F.size(long_runs) > 0, remove_runs(text, long_runs)).otherwise(F.col(text)))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def items_digest(items: Column | str) -> Column:
    """SHA-256 of the keys, sorted as text and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)


def digest(keys: Iterable[str]) -> str:
    return hashlib.sha256(",".join(sorted(keys)).encode()).hexdigest()
