"""Repeated strings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from lexmill.llm import suffixes
from lexmill.llm.anchors import window_anchors


def plain(texts, length):
    """Removed bytes by a dictionary of every window."""
    raw = [(t or "").encode() for t in texts]
    where = {}
    for d, x in enumerate(raw):
        for i in range(len(x) - length + 1):
            where.setdefault(x[i:i + length], []).append((d, i))
    hit = [np.zeros(len(x), bool) for x in raw]
    for places in where.values():
        if len(places) > 1:
            for d, i in places:
                hit[d][i:i + length] = True
    out = []
    for x, h in zip(raw, hit):
        spans = int(np.sum(h[1:] & ~h[:-1]) + (len(h) > 0 and h[0]))
        kept = bytes(b for b, g in zip(x, h) if not g)
        out.append((len(x), int(h.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=40):
    r = random.Random(seed)
    passages = ["".join(r.choices("abcde é", k=r.randint(30, 260))) for _ in range(5)]
    texts = []
    for _ in range(n):
        parts = ["".join(r.choices("abcdefgh ü", k=r.choice([0, 5, 60, 200])))]
        for _ in range(r.randint(0, 3)):
            parts += [r.choice(passages), "".join(r.choices("xyz", k=r.choice([0, 3, 40])))]
        texts.append("".join(parts))
    for _ in range(12):
        t = list(r.choice(texts)) or ["a"]
        t[r.randrange(len(t))] = "#"
        texts.append("".join(t))
    return texts + [None, "", "ab" * 150, "q" * 300, "q" * 299, texts[3], texts[3]]


def test_every_window_has_one_anchor_chosen_by_its_content():
    texts = [t.encode() for t in corpus(2) if t]
    length, gram = 50, 8
    chosen = {}
    for text, place, first, last in window_anchors(texts, length, gram):
        for t, p, a, b in zip(text.tolist(), place.tolist(), first.tolist(), last.tolist()):
            for i in range(a, b + 1):
                assert 0 <= p - i <= length - gram
                assert chosen.setdefault(texts[t][i:i + length], p - i) == p - i
                chosen[t, i] = 1
    assert sum(isinstance(k, tuple) for k in chosen) == sum(max(0, len(x) - length + 1) for x in texts)


@pytest.mark.parametrize(("seed", "length", "gram", "limit"), [(1, 50, 8, 20_000), (2, 40, 16, 1)])
def test_documents_match_brute_force(spark, monkeypatch, seed, length, gram, limit):
    monkeypatch.setattr(suffixes, "GROUP_LIMIT", limit)
    texts = corpus(seed)
    df = spark.createDataFrame([(i, t, 0, 0) for i, t in enumerate(texts)] + [(None, "q" * 70, 0, 0)], "doc_id long, text string, k1 int, n_bytes int")
    got = {x.doc_id: x for x in suffixes.find_repeats(df.repartition(3), length=length, gram=gram, batches=3).collect()}
    want = plain([*texts, "q" * 70], length)
    for i in [*range(len(texts)), None]:
        x = got[i]
        assert (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) == want[len(texts) if i is None else i], (i, texts[i or 0])
    assert suffixes.find_repeats(df.limit(0)).count() == 0


def test_runs_of_a_short_period_are_a_few_rows(spark):
    """Thousands of equal windows in one text meet other texts as one row each, and all of them go."""
    import pandas as pd

    texts = ["q" * 3000, "x" + "ab" * 900, "abc" * 20 + "z" + "q" * 55 + "yy" + "q" * 500, "w" + "q" * 60, "ab" * 26, "qqq"]
    rows = pd.concat(suffixes._anchor_rows(50, 8)(iter([pd.DataFrame({"k1": range(6), "k2": range(6), "text": texts})])))
    assert len(rows) < 100
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in suffixes.find_repeats(df, length=50, gram=8).collect()}
    for i, want in enumerate(plain(texts, 50)):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == want, i


def test_repeated_rows_and_cut_text(spark):
    t = "é" * 30 + "".join(random.Random(1).choices("abc", k=80))
    df = spark.createDataFrame([(1, t), (1, t), (2, "z" + t[:40])], "doc_id long, text string")
    found = suffixes.find_repeats(df, length=20, gram=4).collect()
    assert len(found) == 3 and sum(x.n_removed == x.n_bytes for x in found) == 2
    cut = spark.createDataFrame([("aébc", [(2, 4)]), ("abc", []), (None, [])], "text string, spans array<struct<start:int,stop:int>>")
    assert [x.c for x in cut.select(suffixes.remove_spans("text", "spans").alias("c")).collect()] == ["ac", "abc", None]


def test_texts_longer_than_a_part(spark):
    """Texts are read in parts of half a megabyte; passages inside, across and far from the cuts are found alike."""
    from lexmill.llm.anchors import PART

    r = random.Random(11)
    passage = "".join(r.choices("abcdefgh ", k=700))
    letters = "".join(r.choices("abcdefghijklmnop ", k=2 * PART + 40_000))
    long = list(letters)
    for at in (1000, PART - 350, PART + 5000, 2 * PART - 10):
        long[at:at + 700] = passage
    texts = ["".join(long), "x" + passage[100:650] + "y", letters[PART - 300:PART + 300], "short"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in suffixes.find_repeats(df).collect()}
    length, where = suffixes.LENGTH, {}
    raw = [t.encode() for t in texts]
    for d, x in enumerate(raw):
        for i in range(len(x) - length + 1):
            where.setdefault(hash(x[i:i + length]), []).append((d, i))
    hit = [np.zeros(len(x), bool) for x in raw]
    for places in where.values():
        if len(places) > 1:
            for d, i in places:
                hit[d][i:i + length] = True
    for d, (x, h) in enumerate(zip(raw, hit)):
        kept = bytes(np.frombuffer(x, np.uint8)[~h])
        assert (got[d].n_removed, got[d].kept_sha256) == (int(h.sum()), hashlib.sha256(kept).hexdigest()), d
    assert got[0].n_spans >= 4 and got[1].n_removed == 550
