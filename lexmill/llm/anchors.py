"""Content-defined anchors: the same places in every copy of a long string."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

#: Starts looked at together; a document longer than that is worked on in parts.
PART = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1


@cache
def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A scrambled value of each byte, powers of the base and of its inverse (modulo 2 ** 64)."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    values = x ^ (x >> np.uint64(29))
    one, inverse = np.ones(1, np.uint64), pow(_BASE, -1, 1 << 64)
    powers = np.multiply.accumulate(np.concatenate((one, np.full(n, _BASE, np.uint64))))
    inverses = np.multiply.accumulate(np.concatenate((one, np.full(n, inverse, np.uint64))))
    return values, powers, inverses


def _gram_order(data: np.ndarray, gram: int) -> np.ndarray:
    """A number for the ``gram`` bytes from each place that depends on nothing else."""
    values, powers, inverses = _tables(2 * PART)
    n = len(data)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[data] * powers[:n], dtype=np.uint64)))
    h = (sums[gram:] - sums[:-gram]) * inverses[:n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours: running minima from both ends of blocks of that width."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(x)] = x
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1:width - 1 + n])


def window_anchors(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, anchor, first, last) arrays: each window start of each text belongs to one row.

    A window is ``length`` bytes; its anchor is the place in it whose ``gram`` bytes
    come first in a scrambled order, the leftmost of equals.  That choice depends on
    the window alone, so equal windows have their anchor at the same distance.
    Starts ``first`` to ``last`` share the anchor.
    """
    pieces: list[tuple[int, int, int]] = []
    size = 0
    for i, text in enumerate(texts):
        for a in range(0, len(text) - length + 1, PART):
            b = min(len(text), a + PART + length - 1)
            if pieces and size + b - a > PART + length:
                yield _anchors_of(texts, pieces, length, gram)
                pieces, size = [], 0
            pieces.append((i, a, b))
            size += b - a
    if pieces:
        yield _anchors_of(texts, pieces, length, gram)


def _anchors_of(texts: list[bytes], pieces: list[tuple[int, int, int]], length: int, gram: int):
    data = np.frombuffer(b"".join(texts[i][a:b] for i, a, b in pieces), np.uint8)
    sizes = np.array([b - a for _, a, b in pieces])
    offsets = np.cumsum(sizes) - sizes
    order = _gram_order(data, gram)
    packed = (order & ~_PLACE) | np.arange(len(order), dtype=np.uint64)
    anchor = (_sliding_minimum(packed, length - gram + 1) & _PLACE).astype(np.int64)
    piece = np.repeat(np.arange(len(pieces)), sizes)[:len(anchor)]
    starts = np.arange(len(anchor))
    inside = starts + length <= (offsets + sizes)[piece]
    starts, anchor, piece = starts[inside], anchor[inside], piece[inside]
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])))
    at = np.flatnonzero(new)
    ends = np.concatenate((at[1:], [len(starts)])) - 1
    owner = piece[at]
    shift = np.array([a for _, a, _ in pieces])[owner] - offsets[owner]
    text = np.array([i for i, _, _ in pieces])[owner]
    return text, anchor[at] + shift, starts[at] + shift, starts[ends] + shift
