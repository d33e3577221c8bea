"""Blocked layers, training in epochs, sketches and large vocabularies against their plain forms."""

import random

import pytest
from pyspark.sql import functions as F

from lexmill.operators import models as m
from lexmill.operators import sketches as sk
from lexmill.operators import vocabulary as v
from lexmill.plans.jobs import prepare_sequences


def test_blocked_layers_equal_whole_ones(spark):
    r = random.Random(4)
    sizes = [7, 5, 3]
    cells = [(n, o, i, r.uniform(-1, 1)) for n in range(2) for o in range(sizes[n + 1]) for i in range(sizes[n])]
    weights = spark.createDataFrame(cells, "layer int, out_i int, in_i int, w double")
    biases = spark.createDataFrame([(0, 1, 0.5), (0, 4, -0.25), (1, 0, 1.0)], "layer int, out_i int, b double")
    rows = [(k, [r.uniform(-1, 1) for _ in range(7)]) for k in range(40)]
    df = spark.createDataFrame(rows, "id int, x array<double>")
    for kinds in (["relu", "softmax"], ["sigmoid", "identity"]):
        whole = {x.id: x.scores for x in m.dense_scores(df, weights, biases, kinds, "x").collect()}
        for block in (1, 2, 3, 50):
            got = {x.id: x.scores for x in m.dense_scores_blocked(df, weights, biases, kinds, "x", "id", block=block, salts=3).collect()}
            assert got.keys() == whole.keys()
            assert all(got[k] == pytest.approx(whole[k]) for k in whole)
    assert m.dense_scores_blocked(df.limit(0), weights, biases, ["relu", "softmax"], "x", "id").count() == 0


def _talk(spark, n=240):
    r = random.Random(9)
    words = {0: "sun sand sea beach wave swim".split(), 1: "snow ice ski cold frost glove".split()}
    rows = [(i, " ".join(r.choices(words[i % 2] + ["the", "and"], k=12)), i % 2) for i in range(n)]
    return spark.createDataFrame(rows, "id int, text string, label_idx int")


def test_epochs_keep_the_best_and_stop(spark):
    docs = _talk(spark)
    trained = m.train_in_epochs(docs, 2, epochs=6, patience=2, steps=6, embedding=8, hidden=(6,), seed=3)
    rows = trained.history.orderBy("epoch").collect()
    chosen = [x for x in rows if x.chosen]
    assert len(chosen) == 1 and chosen[0].val_accuracy == max(x.val_accuracy for x in rows)
    assert all(x.val_accuracy < chosen[0].val_accuracy for x in rows if x.epoch < chosen[0].epoch)
    assert len(rows) == 6 or len(rows) - chosen[0].epoch == 2
    assert m.evaluate(m.predict(trained.model, docs)).first()["accuracy"] > 0.9
    # Each epoch goes on from the last one, so the loss on the training part falls.
    assert rows[-1].loss < rows[0].loss
    constant = m.train_in_epochs(docs.withColumn("label_idx", F.lit(0)), 2, epochs=5, patience=1, steps=1, features=16)
    assert constant.history.count() <= 3


def test_embeddings_are_learned_by_several_tasks_and_bounded(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(m, "EMBEDDING_CHARS", 4000)
    monkeypatch.setattr(m, "EMBEDDED_WORDS", 8)
    docs = _talk(spark)
    assert m.embedding_partitions(docs) > 1 and m.embedding_partitions(docs.limit(0)) == 1
    model = m.train_text_classifier(docs, 2, embedding=8, max_iter=20)
    assert model.stages[2].getNumPartitions() == m.embedding_partitions(docs)
    assert model.stages[2].getVectors().count() <= 8
    monkeypatch.setattr(m, "EMBEDDED_WORDS", 1 << 17)
    model = m.train_text_classifier(docs, 2, embedding=8, max_iter=20)
    m.save_model(model, str(tmp_path / "m"))
    for each in (model, m.load_model(str(tmp_path / "m"))):
        assert m.evaluate(m.predict(each, docs)).first()["accuracy"] > 0.9


def test_selection_tokenizes_once(spark, monkeypatch):
    seen = []
    whole = m.materialized
    monkeypatch.setattr(m, "materialized", lambda df: seen.append(df.columns) or whole(df))
    best = m.select_text_classifier(_talk(spark), 2, iterations=(1, 8), features=64, kind="logistic")
    assert seen == [["label_idx", "_tf"]] and len(best.validationMetrics) == 2
    assert m.evaluate(m.predict(best.bestModel, _talk(spark))).first()["accuracy"] > 0.9


def test_sketches_add_up(spark):
    r = random.Random(1)
    rows = [(i, r.choice(["a", "b", None]), "\n".join(r.choice(["x y", "y z", f"line {i}", ""]) for _ in range(r.randrange(1, 9)))) for i in range(300)]
    rows.append((400, "a", None))
    docs = spark.createDataFrame(rows, "id int, `s.x` string, text string")
    whole = sk.describe_sketches(sk.corpus_sketches(docs, ["s.x"]))
    parts = sk.corpus_sketches(docs.where("id % 2 = 0"), ["s.x"]).union(sk.corpus_sketches(docs.where("id % 2 = 1"), ["s.x"]))
    merged = sk.describe_sketches(sk.merge_sketches(parts, ["s.x"]))
    exact = ["n_texts", "n_chars", "n_lines", "n_empty_lines", "distinct_lines", "duplicated_line_ratio"]
    by = lambda df: {x["s.x"]: [x[c] for c in exact] for x in df.collect()}
    assert by(whole) == by(merged)
    for source in ("a", "b", None):
        texts = [t for _, s, t in rows if s == source and t is not None]
        lines = [x.strip() for t in texts for x in t.split("\n")]
        full = [x for x in lines if x]
        got = by(merged)[source]
        assert got[:5] == [len(texts), sum(map(len, texts)), len(full), len(lines) - len(full), len(set(full))]
    total = sk.merge_sketches(parts)
    lengths = sorted(len(t) for _, _, t in rows if t is not None)
    bins = {x.lower: x.n for x in sk.sketch_histogram(total, [0, 10, 20, 1000]).collect()}
    assert bins == {a: sum(a <= n < b for n in lengths) for a, b in ((0, 10), (10, 20), (20, 1000))}
    words = {w for _, _, t in rows if t for w in t.split()}
    assert sk.describe_sketches(total).first()["vocabulary_size"] == pytest.approx(len(words), rel=0.03)


def test_joined_sequences_equal_inline_ones(spark, monkeypatch):
    r = random.Random(2)
    rows = [(i % 50 or None, " ".join(r.choice(["the"] * 20 + [f"w{j}" for j in range(90)]) for _ in range(r.randrange(0, 40)))) for i in range(120)]
    rows += [(1, None), (1, ""), (7, "the The unseen the"), (7, "the The unseen the")]
    docs = spark.createDataFrame(rows, "id int, text string")
    fit = docs.where("text not like '%unseen%'")
    for size in (30, 500):
        small, large = v.build_vocabulary(fit, max_size=size), v.build_large_vocabulary(fit, max_size=size)
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
        for length in (None, 6):
            inline = sorted(map(str, v.texts_to_sequences(docs, small, length=length).collect()))
            for heavy in (0, 3, 1000):
                assert sorted(map(str, v.texts_to_sequences_joined(docs, large, length=length, heavy_words=heavy).collect())) == inline
    assert v.build_large_vocabulary(fit).count() == v.word_counts(fit).count() + 2
    monkeypatch.setattr("lexmill.plans.jobs.INLINE_WORDS", 20)
    split = docs.withColumn("split", F.when(F.col("id") % 2 == 0, "train").otherwise("test")).where("id is not null")
    joined = prepare_sequences(split, max_vocabulary=40, length=5)
    monkeypatch.setattr("lexmill.plans.jobs.INLINE_WORDS", 2000)
    plain = prepare_sequences(split, max_vocabulary=40, length=5)
    for side in ("train", "test"):
        assert sorted(map(str, getattr(joined, side).collect())) == sorted(map(str, getattr(plain, side).collect()))
