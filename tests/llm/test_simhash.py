"""SimHash fingerprints and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from lexmill.llm import simhash


def plain_fingerprint(text, k=3):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def components(fps):
    """Brute force over all pairs: number of the smallest member."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            for j in range(i):
                if (a ^ fps[j]).bit_count() <= 2 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_fingerprints(words):
    texts = ["", None, " \t\n", "One", "one two", "ÄB\x0bc d\x85e", " ".join(words(1, 20_000)), "a b a b a b a b"]
    assert [simhash.fingerprint_of(t) for t in texts] == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("radius", [0, 2, 3])
def test_index_finds_all_neighbours(radius):
    r = np.random.default_rng(radius)
    base = r.integers(0, 1 << 64, 40, dtype=np.uint64)
    near = base[r.integers(0, 40, 300)] ^ (np.uint64(1) << r.integers(0, 64, 300, dtype=np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 300, dtype=np.uint64))
    fps = np.unique(np.concatenate([base, near]))
    rank = fps.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    fps = fps[np.argsort(rank)]
    at, leaf = simhash.GrayIndex.of_fingerprints(fps).search(fps, radius)
    want = {(i, j) for i in range(len(fps)) for j in range(len(fps)) if int(fps[i] ^ fps[j]).bit_count() <= radius}
    assert set(zip(at.tolist(), leaf.tolist())) == want


def test_components_match_brute_force(spark, words, monkeypatch):
    r = random.Random(3)
    texts = []
    for i in range(60):
        base = words(i, r.choice([1, 2, 5, 40, 200]))
        for _ in range(r.choice([1, 1, 2, 6])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2])):
                w[r.randrange(len(w))] = r.choice(["x", "yy"])
            texts.append(" ".join(w))
    texts += ["", None, "  ", texts[0], texts[0]]
    rows = [(len(texts) - i, t, "f") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(3)
    fps = [plain_fingerprint(t) for _, t, _ in sorted(rows)]
    label = components(fps)
    want = {i + 1: (f"{fps[i]:016x}", label[i] + 1) for i in range(len(fps))}
    for size in (7, 10_000):
        monkeypatch.setattr(simhash, "GROUP_SIZE", size)
        marked = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in set(fps)], "fp long")
        links = simhash.fingerprint_links(marked, group_size=size).collect()
        assert all((np.uint64(x.a & (2**64 - 1)) != np.uint64(x.b & (2**64 - 1))) for x in links)
    got = {x.doc_id: (x.fingerprint, x.component_id) for x in simhash.near_duplicates(df).collect()}
    assert got == want


def test_small_groups_lose_no_link(spark):
    """Groups of a few fingerprints: links cross them everywhere."""
    r = random.Random(9)
    fps = {r.getrandbits(64) for _ in range(30)}
    for f in list(fps):
        for _ in range(6):
            f ^= 1 << r.randrange(64) | 1 << r.randrange(64)
            fps.add(f)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    rows = simhash.fingerprint_links(df, group_size=9).collect()
    at = {int(np.uint64(f).astype(np.int64)): i for i, f in enumerate(fps)}
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for x in rows:
        a, b = find(at[x.a]), find(at[x.b])
        label[max(a, b)] = min(a, b)
    want = components(fps)
    assert [find(i) for i in range(len(fps))] == want


def test_keep_one_and_odd_rows(spark, words):
    long_text = " ".join(words(4, 300))
    rows = [(5, long_text, "a"), (2, long_text + " ", "b"), (2, long_text, "c"), (None, long_text, "d"),
            (None, "alone in the world of words", "e"), (9, None, "f"), (8, "", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = simhash.keep_one(df).collect()
    assert sorted((x.doc_id is None, x.doc_id or 0) for x in kept) == [(False, 2), (False, 8), (True, 0)]
    assert kept[0].__fields__ == ["doc_id", "text", "component_id"]
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    only = spark.createDataFrame([(None, "x y z"), (None, "x y z")], "doc_id long, text string")
    assert [x.component_id for x in simhash.near_duplicates(only).collect()] == [None, None]
