"""Runs against brute force over all periods, appended in pieces, and the registered query."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lexmill.llm.periodic_runs import SquareCatchers, collapse_runs, find_runs, runs_of
from lexmill.llm.queries import LLM_QUERIES


def plain_runs(words, exponent=4, least=6):
    """All (start, length, period): stretches of equal words a period apart, smallest period of each stretch."""
    n, found = len(words), {}
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(least, exponent * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i) + 1
    return sorted((a, n, p) for (a, n), p in found.items())


def sequences():
    r = random.Random(5)
    for size in (0, 1, 5, 6, 7, 40, 300, 900):
        for letters in (1, 2, 3, 50):
            yield [r.randrange(letters) for _ in range(size)]
    for _ in range(60):
        out = []
        while len(out) < 400:
            unit = [r.randrange(3) for _ in range(r.randrange(1, 40))]
            out += (unit * r.randrange(1, 9))[:r.randrange(1, 300)]
        yield out
    nested = [0, 0, 0, 0, 0, 0, 0, 1] * 9 + [2]
    yield nested * 5
    yield [x for i in range(50) for x in (i, i, i, i, i, i)]


@pytest.mark.parametrize("exponent,least", [(4, 6), (2, 2), (3, 1)])
def test_equals_brute_force(exponent, least):
    for words in sequences():
        assert runs_of(words, exponent, least) == plain_runs(words, exponent, least)


def test_appending_in_pieces_reports_what_is_there_so_far():
    r = random.Random(8)
    for words in sequences():
        catchers, at = SquareCatchers(), 0
        while at < len(words):
            step = r.choice([1, 2, 7, 60])
            catchers.append(np.array(words[at:at + step]))
            at += step
            if r.random() < 0.1:
                assert catchers.runs() == plain_runs(words[:at])
        assert catchers.runs() == plain_runs(words)


def test_equal_hashes_of_other_words_do_no_harm(monkeypatch):
    monkeypatch.setattr("lexmill.llm.periodic_runs._mixed", lambda ids: (ids % 2).astype(np.uint64))
    r = random.Random(2)
    for _ in range(20):
        words = [r.randrange(6) for _ in range(120)] + [1, 3] * 9 + [5]
        assert runs_of(words) == plain_runs(words)


def test_long_texts_are_linear():
    same, pair = np.zeros(300_000, np.int64), np.arange(300_000) % 1000
    assert runs_of(same) == [(0, 300_000, 1)]
    assert runs_of(pair) == [(0, 300_000, 1000)]


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for a, m, p in runs for i in range(a + p, a + m)}
    best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best and (best[0], best[1], best[2], 1000 * best[1] // best[2]) or (None,) * 4),
        digest("".join(f"{a},{m},{p}\n" for a, m, p in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_brute_force(spark, sf, tmp_path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    r = random.Random(1)
    rows += [(None, "a b " * 9), (7, None), (7, ""), (8, " \t\n"), (10_000, "x y x y " * 5 + "\x1c z"), (10_001, "one"), (10_001, "one")]
    rows += [(20_000 + i, " ".join(r.choice("abc") for _ in range(r.randrange(60)))) for i in range(120)]
    spark.createDataFrame([(*x, "other", 1) for x in rows], "doc_id long, text string, periodic string, n_runs int").write.parquet(f"{tmp_path}/documents.parquet")
    got = LLM_QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((plain_row(*x) for x in rows), key=str)
    assert sum(x.n_runs > 0 for x in got) > 20


def test_columns_and_empty_tables(spark):
    rows = [(1, "say say say say say say so", "a", 2), (None, None, None, None), (2, "plain  text\n", "c", 3)]
    docs = spark.createDataFrame(rows, "`doc.id` long, text string, `a.b` string, _row int")
    kept = collapse_runs(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, "say so", "a", 2), *rows[1:]], key=str)
    assert find_runs(docs, out="a.b").columns == ["doc.id", "text", "_row", "a.b"]
    assert find_runs(docs.limit(0)).count() == 0
