"""Word-piece counts from a linear longest-match automaton."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters in a row, single digits, and runs of anything else that is no white space.
WORDS = re.compile(r"[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: Words whose lengths a task remembers; the memory is emptied when it is full.
REMEMBERED_WORDS = 200_000
#: Added to the last byte of a word, so that pieces ending a word are told from others.
LAST = 256


@dataclass
class Vocabulary:
    """Pieces inside a word and pieces that end one, as bytes.

    Every byte is a piece in both roles (added if the file lacks it), so each word
    has a segmentation.
    """

    inner: set[bytes] = field(default_factory=set)
    final: set[bytes] = field(default_factory=set)

    def __post_init__(self) -> None:
        singles = {bytes([b]) for b in range(256)}
        self.inner = {p for p in self.inner if p} | singles
        self.final = {p for p in self.final if p} | singles

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        """A public vocabulary file: JSON with word ends, or lines of base64 pieces and ranks.

        Read once where the job is planned; pieces of a rank file may end a word or not.
        """
        if path.endswith(".tiktoken"):
            with open(path, "rb") as f:
                pieces = {base64.b64decode(line.split()[0]) for line in f if line.strip()}
            return cls(pieces, pieces)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        mark, alphabet = model.get("end_of_word_suffix") or "", _byte_alphabet()
        inner, final = set(), set()
        for piece in model["vocab"]:
            ends = bool(mark) and piece.endswith(mark)
            body = piece.removesuffix(mark) if ends else piece
            if all(c in alphabet for c in body):
                raw = bytes(alphabet[c] for c in body)
                if ends or not mark:
                    final.add(raw)
                if not ends:
                    inner.add(raw)
        return cls(inner, final)


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of bytes: visible Latin-1 stands for itself, the rest from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class LongestMatchAutomaton:
    """Trie of the pieces with failure links that say how many pieces they give off.

    Reading a symbol that the current node lacks follows its link: the pieces that
    greedy longest match would cut there are counted, not built, and the node of
    what remains goes on.  Each symbol is read once, whatever the pieces.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.children: list[dict[int, int]] = [{}]
        ends: set[int] = set()
        for piece in sorted(vocabulary.inner):
            ends.add(self._insert(list(piece)))
        for piece in sorted(vocabulary.final):
            ends.add(self._insert([*piece[:-1], piece[-1] + LAST]))
        self._link(ends)

    def _insert(self, symbols: list[int]) -> int:
        at = 0
        for s in symbols:
            nxt = self.children[at].get(s)
            if nxt is None:
                nxt = self.children[at][s] = len(self.children)
                self.children.append({})
            at = nxt
        return at

    def _link(self, ends: set[int]) -> None:
        n = len(self.children)
        self.failure, self.popped = [0] * n, [0] * n
        queue = [(0, s, v) for s, v in self.children[0].items()]
        for parent, s, v in queue:
            if v in ends:
                self.popped[v] = 1
            else:
                at, count = self.failure[parent], self.popped[parent]
                while s not in self.children[at]:
                    count += self.popped[at]
                    at = self.failure[at]
                self.failure[v], self.popped[v] = self.children[at][s], count
            queue.extend((v, t, w) for t, w in self.children[v].items())
        # Pieces still held when the word ends at a node.
        self.held = [0] * n
        for _, _, v in queue:
            at, count = v, 0
            while at:
                count += self.popped[at]
                at = self.failure[at]
            self.held[v] = count

    def count(self, word: bytes) -> int:
        """Pieces of greedy longest match over one word; an empty word has none."""
        if not word:
            return 0
        children, failure, popped = self.children, self.failure, self.popped
        at, count = 0, 0
        for s in [*word[:-1], word[-1] + LAST]:
            nxt = children[at].get(s)
            while nxt is None:
                count += popped[at]
                at = failure[at]
                nxt = children[at].get(s)
            at = nxt
        return count + self.held[at]


def token_counts(text: Column | str, vocabulary: Vocabulary, limit_bytes: int = 64 << 20) -> Column:
    """struct(n_words, n_tokens, n_chars): words and greedy word pieces of the whole text.

    Texts are put in lower case and cut into words by ``WORDS``.  Null and empty
    texts count zero, texts of any length are read whole, equal texts count alike, and a
    table without rows gives none; other columns may have any names.  The automaton travels with the task; ``limit_bytes`` bounds
    the pieces of the vocabulary, beyond which it is refused, since a vocabulary is
    fixed while the corpus grows.
    """
    if sum(map(len, vocabulary.inner | vocabulary.final)) > limit_bytes:
        raise ValueError("the vocabulary is larger than limit_bytes")
    pieces = vocabulary

    @F.pandas_udf("n_words long, n_tokens long, n_chars long")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = LongestMatchAutomaton(pieces)
        known: dict[str, int] = {}

        def measure(value: str | None) -> tuple[int, int, int]:
            if not value:
                return 0, 0, 0
            words, total = 0, 0
            for w in _words(value):
                n = known.get(w)
                if n is None:
                    if len(known) >= REMEMBERED_WORDS:
                        known.clear()
                    n = known[w] = automaton.count(w.encode("utf-8", "surrogatepass"))
                words += 1
                total += n
            return words, total, len(value)

        for batch in batches:
            yield pd.DataFrame([measure(v) for v in batch], columns=["n_words", "n_tokens", "n_chars"])

    return counts(F.col(text) if isinstance(text, str) else text)


def _words(value: str) -> Iterable[str]:
    return WORDS.findall(value.lower())


#: The lower-case vocabulary with word ends; any other file may be named instead.
DEFAULT_VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
