"""The manifest against a plain tree, for many sizes, and the registered query."""

import hashlib
import random
import zlib

import pytest

from lexmill.llm.merkle import prove
from lexmill.llm.queries import LLM_QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(digests, fanout):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def siblings(levels, at, fanout):
    """[(left, right)] from the bottom up."""
    out = []
    for level in levels[:-1]:
        a = at // fanout * fanout
        out.append(("".join(level[a:at]), "".join(level[at + 1:a + fanout])))
        at //= fanout
    return out


def plain(rows, tamper, fanout=16):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = (own, levels_of([leaf_of(r) for r in own], fanout))
    top = levels_of([trees[s][1][-1][0] for s in sources], fanout)
    out = []
    for j, s in enumerate(sources):
        own, levels = trees[s]
        for i, r in enumerate(own):
            path = siblings(levels, i, fanout) + siblings(top, j, fanout)
            folded = leaf_of(tamper(r))
            for left, right in path:
                folded = H(left, folded, right)
            root = top[-1][0]
            out.append((r[0], leaf_of(r), levels[-1][0], root, H(*[x for p in path for x in p]), folded, folded == root))
    return out


def lowered(r):
    if r[0] is None or zlib.crc32(str(r[0]).encode()) % 5 or r[4] is None:
        return r
    return (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))


def key(x):
    return tuple(map(str, x))


@pytest.mark.parametrize("sizes", [[1], [1, 1], [16, 17], [2, 300, 1, 5], [40] * 3 + [1] * 20])
@pytest.mark.parametrize("fanout,levels", [(16, 2), (2, 2), (3, 1)])
def test_equals_plain_tree(spark, sizes, fanout, levels):
    r = random.Random(len(sizes))
    rows = [(i * 1000 + j, f"s{i}", "en", j, r.choice(["Ab", "x", "É A"]) + str(j)) for i, n in enumerate(sizes) for j in range(n)]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = prove(docs, fanout=fanout, levels=levels).collect()
    want = plain(rows, lambda x: x, fanout)
    assert all(x.verified for x in got)
    assert sorted(map(tuple, got)) == sorted(want)


def test_query_equals_plain_tree(spark, sf, tmp_path):
    given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    rows = [tuple(x) for x in given.collect()]
    rows += [(None, "src1", None, None, "Text"), (None, "src1", None, None, None), (None, None, None, None, None), (3, None, "", 0, "")]
    rows += [(2 ** 60 + 1, "é", "en", 1, "A"), (2 ** 60 + 1, "é", "en", 1, "A"), (2 ** 60 + 1, "é", "en", 1, "B"), (9, "", "en", 1, "Word " * 50_000)]
    rows += [(5000 + i, "big", "en", i, "Same text") for i in range(700)]
    random.Random(4).shuffle(rows)
    extra = [(*x, "clash", 1) for x in rows]
    spark.createDataFrame(extra, SCHEMA + ", root string, `a.b` int").write.parquet(f"{tmp_path}/documents.parquet")
    got = LLM_QUERIES["op13_merkle_manifest"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = got.collect()
    want = plain(rows, lowered)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert 50 < sum(not x.verified for x in got) < len(got) / 2


def test_empty_table(spark):
    assert prove(spark.createDataFrame([], SCHEMA)).count() == 0
