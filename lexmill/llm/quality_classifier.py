"""Quality scores by gradient-boosted trees over histograms of document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.words import ROW, column, whole_rows

#: Labelled documents that the trees are fitted on, at most: a sample in the order of a hash of the key.
SAMPLE = 20_000
TREES, DEPTH, RATE, BINS = 80, 4, 0.15, 64
#: Second derivatives that each side of a split needs at least, and the weight that draws leaves to zero.
LEAST, SHRINK = 1.0, 1.0
#: Score from which a document is predicted to be good.
THRESHOLD = 0.3
#: One of so many documents is held out.
FOLDS = 5

#: What is counted of a text, in the order of ``document_statistics``.
STATISTICS = (
    "log_bytes", "log_words", "log_lines", "mean_word", "spread_word", "longest_word", "upper", "digits", "stops",
    "symbols", "exclamations", "beyond_ascii", "controls", "blanks", "ends_symbol", "ends_stop", "ends_mark", "starts_upper", "starts_other",
    "distinct_words", "commonest_word", "repeated_next", "distinct_pairs", "repeated_lines", "mean_line", "byte_entropy",
)
_SYMBOLS, _STOPS, _MARKS = b"#*$%&|<>~^=+_\\{}[]@/", b".,;:", b"!?"


def _classes() -> np.ndarray:
    """For each byte, whether it is an upper-case letter, digit, stop, symbol, mark, beyond ASCII, control, blank."""
    byte = np.arange(256)
    blank = np.isin(byte, list(b" \t\n\x0b\x0c\r"))
    return np.stack([
        (byte >= 65) & (byte <= 90), (byte >= 48) & (byte <= 57), np.isin(byte, list(_STOPS)), np.isin(byte, list(_SYMBOLS)),
        np.isin(byte, list(_MARKS)), byte >= 128, (byte < 32) & ~blank, blank])


_CLASS = _classes()
_UPPER, _DIGIT, _STOP, _SYMBOL, _MARK, _BEYOND, _CONTROL, _BLANK = _CLASS
_LETTER_OR_DIGIT = _UPPER | _DIGIT | _BEYOND | ((np.arange(256) >= 97) & (np.arange(256) <= 122))


def document_statistics(text: str | None) -> np.ndarray:
    """The numbers of ``STATISTICS``, all from the whole text; null is an empty text, which has zeros."""
    out = np.zeros(len(STATISTICS), np.float32)
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return out
    data, parts = np.frombuffer(raw, np.uint8), raw.split()
    counts = np.bincount(data, minlength=256)
    out[0], out[1] = np.log1p(len(data)), np.log1p(len(parts))
    upper, digits, stops, symbols, marks, beyond, controls, blanks = (_CLASS @ counts) / len(data)
    out[6:14] = upper, digits, stops, symbols, marks, beyond, controls, blanks
    shares = counts[counts > 0] / len(data)
    out[25] = -(shares * np.log2(shares)).sum()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    if not parts:
        return out
    out[2], out[24] = np.log1p(len(lines)), np.log1p(len(data) / len(lines))
    out[23] = 1 - len(set(lines)) / len(lines)
    n = len(parts)
    sizes = np.fromiter(map(len, parts), np.int64, n)
    out[3], out[4], out[5] = sizes.mean(), sizes.std(), np.log1p(sizes.max())
    solid = ~_BLANK[data]
    last = data[solid & np.append(~solid[1:], True)]
    first = data[solid & np.concatenate([[True], ~solid[:-1]])]
    out[14], out[15], out[16] = _SYMBOL[last].mean(), _STOP[last].mean(), _MARK[last].mean()
    out[17], out[18] = _UPPER[first].mean(), (~_LETTER_OR_DIGIT[first]).mean()
    number = {w: i for i, w in enumerate(dict.fromkeys(parts))}
    ids = np.fromiter(map(number.__getitem__, parts), np.int64, n)
    out[19], out[20] = len(number) / n, np.bincount(ids).max() / n
    if n > 1:
        out[21] = (ids[1:] == ids[:-1]).mean()
        out[22] = len(np.unique(ids[1:] * len(number) + ids[:-1])) / (n - 1)
    return out


def statistics(text: Column | str) -> Column:
    """Array of the numbers of ``STATISTICS`` of whole texts."""

    @F.pandas_udf("array<float>")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series([document_statistics(t) for t in texts], dtype="object")

    return counted(column(text))


@dataclass(frozen=True)
class Trees:
    """Trees of equal depth, flattened: node ``i`` of a tree has its children at ``2i + 1`` and ``2i + 2``.

    ``feature`` and ``limit`` (trees x inner nodes): a row goes right if its feature is above the
    limit; ``value`` (trees x leaves); ``base``: log-odds without any tree.
    """

    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of the rows: all rows go down all trees together, one level at a time."""
        out = np.full(len(rows), self.base)
        n_trees, inner = self.feature.shape
        if not n_trees:
            return out
        of = np.arange(n_trees)
        for at in range(0, len(rows), 4096):
            block = rows[at:at + 4096]
            each, node = np.arange(len(block))[:, None], np.zeros((len(block), n_trees), np.int64)
            while node[0, 0] < inner:
                node = 2 * node + 1 + (block[each, self.feature[of, node]] > self.limit[of, node])
            out[at:at + 4096] += self.value[of, node - inner].sum(axis=1)
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -500, 500)))

    def score(self, statistics: Column) -> Column:
        """Probability of label 1, from an array of statistics."""

        @F.pandas_udf("double")
        def scored(rows: pd.Series) -> pd.Series:
            return pd.Series(self.probability(np.stack(rows.to_list())) if len(rows) else [], dtype="float64")

        return scored(statistics)


def bin_edges(rows: np.ndarray, bins: int) -> list[np.ndarray]:
    """Per feature, up to ``bins - 1`` values of the column at even ranks, below its largest; a row is in the bin of the first edge not below it."""
    out = []
    for values in rows.T:
        ranked = np.sort(values)
        edges = np.unique(ranked[(np.arange(1, bins) * len(ranked)) // bins])
        out.append(edges[edges < ranked[-1]])
    return out


def fit_trees(
    rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS,
    least: float = LEAST, shrink: float = SHRINK,
) -> Trees:
    """Boosted trees for the log-loss, grown level by level from histograms.

    Every level adds up first and second derivatives per node, feature and bin, and
    splits each node where the gain is greatest (ties: smallest feature, then limit).  A
    node without a gain sends all its rows left.  One class or no rows: no trees.
    """
    n, width = rows.shape
    positive = float(labels.sum())
    base = float(np.log((positive + 1) / (n - positive + 1)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    feature, limit, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, leaves))
    if not 0 < positive < n:
        return Trees(feature[:0], limit[:0], value[:0], base)
    edges = bin_edges(rows, bins)
    binned = np.stack([np.searchsorted(e, rows[:, f], "left") for f, e in enumerate(edges)], axis=1)
    places = binned + np.arange(width) * bins
    # Beyond a feature's own edges there is nothing to split.
    allowed = np.arange(bins)[None, :] < np.array([len(e) for e in edges])[:, None]
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = p - labels, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            count, offset = 1 << level, (1 << level) - 1
            at = (places + ((node - offset) * width * bins)[:, None]).ravel()
            shape = (count, width, bins)
            g = np.bincount(at, np.repeat(slope, width), count * width * bins).reshape(shape).cumsum(axis=2)
            h = np.bincount(at, np.repeat(bend, width), count * width * bins).reshape(shape).cumsum(axis=2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g ** 2 / (h + shrink) + (g_all - g) ** 2 / (h_all - h + shrink) - g_all ** 2 / (h_all + shrink)
            gain[~(allowed[None] & (h >= least) & (h_all - h >= least))] = 0
            flat = gain.reshape(count, -1)
            best = flat.argmax(axis=1)
            split = flat[np.arange(count), best] > 1e-9
            f, b = best // bins, best % bins
            for i in np.flatnonzero(split):
                feature[t, offset + i], limit[t, offset + i] = f[i], edges[f[i]][b[i]]
            own = node - offset
            right = split[own] & (binned[np.arange(n), f[own]] > b[own])
            node = 2 * node + 1 + right
        leaf = node - inner
        g, h = np.bincount(leaf, slope, leaves), np.bincount(leaf, bend, leaves)
        value[t] = -rate * g / (h + shrink)
        margin += value[t][leaf]
    return Trees(feature, limit, value, base)


def held_out(key: Column | str) -> Column:
    """Whether 5 divides the CRC-32 of the key as text; a null key is not held out."""
    return F.coalesce(F.crc32(column(key).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, **options,
) -> Trees:
    """Trees fitted on labelled documents that are not held out.

    Of all labelled keys the ``sample`` first in the order of a hash take part, one text
    each (of several the one with the least hash); a key labelled twice has the label
    of most of its rows, 1 in a tie; null labels and keys, and labels of no document, are left out.
    Only the sampled keys and their statistics, a few numbers each, reach the driver, where
    the trees are grown; the texts are read where they are.
    """
    known = labels.select(F.col(key).alias("k"), F.col(label).alias("y")).where(F.col("k").isNotNull() & F.col("y").isNotNull())
    voted = known.where(~held_out("k")).groupBy("k").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    chosen = voted.orderBy(F.xxhash64("k"), "k").limit(sample)
    # At most ``sample`` small rows.
    found = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).join(F.broadcast(chosen), "k")
    rows = found.select("k", "y", F.xxhash64("t").alias("h"), statistics("t").alias("x"))
    once = rows.groupBy("k").agg(F.min_by("x", "h").alias("x"), F.first("y").alias("y")).toPandas().sort_values("k")
    table = np.stack(once["x"].to_list()) if len(once) else np.zeros((0, len(STATISTICS)), np.float32)
    return fit_trees(table.astype(np.float32), once["y"].to_numpy(np.float64), **options)


def add_quality(
    docs: DataFrame, model: Trees, text: str = "text", threshold: float = THRESHOLD, out: tuple[str, str] = ("score", "predicted"),
) -> DataFrame:
    """The rows with the probability of label 1 and, from ``threshold`` on, prediction 1.

    Only whole texts are scored: null and empty ones as texts without words, equal
    texts alike; repeated rows all stay; an empty table gives no rows; columns named like an
    output are replaced, other names, dotted ones too, stay as they are.
    """
    rows = whole_rows(docs.drop(*out), model.score(statistics(F.col(f"`{text}`"))).alias("p"))
    return rows.select(f"{ROW}.*", F.col("p").alias(out[0]), (F.col("p") >= threshold).cast("int").alias(out[1]))
