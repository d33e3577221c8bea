"""Trees against plain versions, held-out accuracy, and what a score must not depend on."""

import zlib

import numpy as np
import pytest

from lexmill.llm.quality_classifier import STATISTICS, Trees, add_quality, bin_edges, document_statistics, fit, fit_trees
from lexmill.llm.queries import LLM_QUERIES

SCHEMA = "doc_id long, text string"


def plain_margin(model, row):
    total = model.base
    for t in range(len(model.value)):
        node = 0
        while node < model.feature.shape[1]:
            node = 2 * node + (2 if row[model.feature[t, node]] > model.limit[t, node] else 1)
        total += model.value[t, node - model.feature.shape[1]]
    return total


def data(n=400, width=5, seed=1):
    r = np.random.default_rng(seed)
    rows = np.round(r.normal(size=(n, width)), 1).astype(np.float32)
    return rows, ((rows[:, 1] > 0.3) ^ (rows[:, 3] > 0)).astype(float)


def test_flat_traversal_equals_walking_each_tree():
    rows, labels = data()
    model = fit_trees(rows, labels, trees=9, depth=3)
    assert np.allclose(model.margin(rows), [plain_margin(model, x) for x in rows])
    assert ((model.probability(rows) > 0.5) == labels).mean() > 0.95
    assert len(model.margin(rows[:0])) == 0


def test_first_split_is_the_best_of_all():
    rows, labels = data(300, 4, 7)
    model = fit_trees(rows, labels, trees=1, depth=1, bins=512)
    p = 1 / (1 + np.exp(-model.base))
    slope, bend = p - labels, np.full(len(labels), p * (1 - p))
    best = None
    for f in range(rows.shape[1]):
        for limit in np.unique(rows[:, f])[:-1]:
            left = rows[:, f] <= limit
            if min(bend[left].sum(), bend[~left].sum()) < 1:
                continue
            gain = sum(slope[s].sum() ** 2 / (bend[s].sum() + 1) for s in (left, ~left))
            best = max(best or (gain, f, limit), (gain, f, limit), key=lambda x: x[0] - 1e-12 * x[1])
    assert (model.feature[0, 0], model.limit[0, 0]) == (best[1], best[2])


def test_edges_share_out_the_rows():
    rows = np.arange(1000, dtype=np.float32)[:, None]
    (edges,) = bin_edges(rows, 10)
    assert np.bincount(np.searchsorted(edges, rows[:, 0])).max() <= 101
    assert len(bin_edges(np.ones((5, 1), np.float32), 10)[0]) == 0


@pytest.mark.parametrize("labels,expected", [([], 0.5), ([1.0] * 6, 7 / 8), ([0.0] * 6, 1 / 8)])
def test_one_class_or_no_rows(labels, expected):
    model = fit_trees(np.zeros((len(labels), len(STATISTICS)), np.float32), np.array(labels))
    assert np.allclose(model.probability(np.ones((2, len(STATISTICS)))), expected)


def test_statistics_of_odd_texts():
    for text in (None, "", " \n\t", "a", "\x00", "É" * 5, "word " * 100_000, "x" * 200_000):
        values = document_statistics(text)
        assert values.shape == (len(STATISTICS),) and np.isfinite(values).all()
    assert not document_statistics(None).any() and not document_statistics("").any()
    named = dict(zip(STATISTICS, document_statistics("Ab ab ab, 12!\nab ab\nab ab"), strict=True))
    assert named["distinct_words"] == np.float32(4 / 8) and named["commonest_word"] == np.float32(5 / 8)
    assert named["repeated_lines"] == np.float32(1 / 3) and named["ends_mark"] == np.float32(1 / 8)


def auc(scores, labels):
    good, bad = scores[labels == 1], scores[labels == 0]
    return ((good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2)


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = LLM_QUERIES["op12_quality_classifier"](spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    got = got.toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(k).encode()) % 5 == 0 for k in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    both = got[got.held_out].merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    assert auc(both.score.to_numpy(), both.quality.to_numpy()) > 0.97
    assert (both.predicted == both.quality).mean() > max(0.95, both.quality.mean())


def test_held_out_labels_and_other_columns_do_not_matter(spark, sf, tmp_path):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    plain = {x.doc_id: x.score for x in LLM_QUERIES["op12_quality_classifier"](spark, sf).collect()}
    flipped = labels.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS string) AS binary)) % 5 = 0, 1 - quality, quality) AS quality", "1 - toxic AS toxic")
    odd = docs.selectExpr("doc_id", "text", "'xx' AS lang", "reverse(source) AS source", "0.5D AS score")
    assert odd.count() == len(plain)
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    flipped.write.parquet(f"{tmp_path}/labels.parquet")
    assert {x.doc_id: x.score for x in LLM_QUERIES["op12_quality_classifier"](spark, str(tmp_path)).collect()} == plain


def test_odd_tables(spark):
    rows = [(None, "a few words", 1), (1, None, 2), (1, "", 3), (2, "good words and more of them", 4), (2, "good words and more of them", 5), (3, "w " * 60_000, 6)]
    docs = spark.createDataFrame(rows, SCHEMA + ", `a.b` int").withColumnRenamed("a.b", "score.x").selectExpr("*", "'old' AS score")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (77, 1)], "doc_id long, quality int")
    model = fit(docs, labels, trees=3)
    out = add_quality(docs, model)
    assert out.columns == ["doc_id", "text", "score.x", "score", "predicted"] and out.count() == len(rows)
    assert all(0 <= x.score <= 1 for x in out.collect())
    assert add_quality(docs.limit(0), model).count() == 0
    assert fit(docs, labels.limit(0)).value.shape[0] == 0 and fit(docs.limit(0), labels).value.shape[0] == 0


def test_sample_is_bounded_and_repeatable(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    one, two = (fit(docs.repartition(n), labels.repartition(n), sample=30, trees=5) for n in (1, 3))
    assert isinstance(one, Trees) and one.base == two.base
    assert (one.feature == two.feature).all() and (one.value == two.value).all()
