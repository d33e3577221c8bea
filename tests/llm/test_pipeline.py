"""The pipeline against plain versions of its stages, and each stage on odd rows."""

import random

import pyarrow as pa
import pyarrow.parquet as pq

import corpus_pipeline
from tests.llm.test_decontaminate import plain as hits_of
from tests.llm.test_quality_rules import Limits, plain_kept
from tests.llm.test_secrets import plain as secrets_of
from tests.llm.test_simhash import components, plain_fingerprint
from lexmill.llm.decontaminate import normalised_words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(words):
    r = random.Random(3)
    items = [(i, " ".join(words(700 + i, 25))) for i in range(4)]
    rows = []
    for i in range(60):
        w = words(i, r.choice([10, 40, 90, 200]))
        if i % 9 == 0:
            w[5:5] = items[i % 4][1].split()
        if i % 7 == 0:
            w[3:3] = ["token", "=", "abcdef0123456789"]
        rows.append([i, " ".join(w), "en", f"s{i % 3}", 0])
    for i in range(12):
        w = rows[i * 3][1].split()
        if i % 2:
            w[-1] = "end"
        rows.append([100 + i, " ".join(w), "en", "s1", 0])
    for x in rows:
        x[4] = len(x[1])
    return [tuple(x) for x in rows], items


def test_run_matches_plain_stages(spark, words, tmp_path):
    rows, items = corpus(words)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    pq.write_table(pa.table({c: [x[i] for x in rows] for i, c in enumerate(columns)}), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": [x[0] for x in items], "text": [x[1] for x in items]}), tmp_path / "benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = [x for x, (_, good) in zip(rows, plain_kept([(x[0], x[3], x[1]) for x in rows], Limits())) if good]
    kept.sort()
    label = components([plain_fingerprint(x[1]) for x in kept])
    kept = [x for i, x in enumerate(kept) if label[i] == i]
    bench = [(str(k), normalised_words(t)) for k, t in items]
    kept = [x for x in kept if (n := len(hits_of(w := normalised_words(x[1]), bench)[0])) == 0 or 20 * n < len(w)]
    assert 0 < len(kept) < len(rows)
    want = {}
    for x in kept:
        text, parts, at = x[1], [], 0
        last = -1
        for a, _, b, kind in secrets_of(text):
            if a < last:
                continue
            parts += [text[at:a], f"[{kind}]"]
            at = last = b
        want[x[0]] = "".join([*parts, text[at:]])
    assert {x.doc_id: x.text for x in got} == want
    assert all(x.n_chars == len(x.text) and x.size == len(x.text.split()) for x in got)
    total = sum(x.size for x in got)
    assert abs(sum(x.taken for x in got) - 1.5 * total) <= 3
    assert [n for n, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5


def test_stages_on_odd_rows(spark, sf):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "word " * 30_000, "en", "s", 1), (None, "a few words", None, "s", 3)]
    docs = spark.createDataFrame([(*x, 7, "k1", 1, 2) for x in rows], SCHEMA + ", fingerprint int, _k1 string, `a.b` int, a int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() <= len(rows), name
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert corpus_pipeline.mixture(spark, docs, sf).count() == len(rows)
