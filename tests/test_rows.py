"""Transforms that combine rows: exactness, skew, invariants, plans."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexmill.functions.language import primary_script, script_guess
from lexmill.functions.metrics import big_text_sample, noise_analysis, text_metrics
from lexmill.functions.quality import quality
from lexmill.operators import models as m
from lexmill.operators import ranking, reports
from lexmill.operators import sampling as sp
from lexmill.operators import vocabulary as v
from lexmill.operators.topics import match_topic_table, topic_keys, with_topics
from lexmill.operators.filters import with_pattern_filter


def order(ids, seed=42):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


@pytest.fixture(scope="module")
def skewed(spark):
    """1,000 rows; one label holds well over a third."""
    return spark.range(1000).select(
        "id", F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").otherwise("small").alias("label"))


def test_ratio_and_random_split_are_exact(skewed):
    ids = list(range(1000))
    for split, n in ((sp.ratio_split(skewed, ratio=0.73), 730), (sp.random_split(skewed, test_size=0.333), 667)):
        rows = {r["id"]: r["split"] for r in split.collect()}
        assert {i for i, s in rows.items() if s == "train"} == set(order(ids)[:n])
    # The same rows whatever the partitioning.
    again = {r["id"]: r["split"] for r in sp.random_split(skewed.repartition(13), test_size=0.333).collect()}
    assert again == rows


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_split_edges(spark, n):
    counts = Counter(r["split"] for r in sp.ratio_split(spark.range(n)).collect())
    assert counts["train"] == math.floor(n * 0.8) and sum(counts.values()) == n


def test_stratified_split_keeps_shares(skewed):
    rows = sp.stratified_split(skewed, "label").groupBy("label", "split").count().collect()
    assert {(r["label"], r["split"]): r["count"] for r in rows} == {
        ("big", "train"): 560, ("big", "test"): 140, ("mid", "train"): 160, ("mid", "test"): 40,
        ("small", "train"): 80, ("small", "test"): 20}


def test_balance(skewed):
    rows = sp.balance_classes(skewed, "label").collect()
    assert Counter(r["label"] for r in rows) == {"big": 100, "mid": 100, "small": 100}
    big = [i for i in range(1000) if i % 10 < 7]
    assert {r["id"] for r in rows if r["label"] == "big"} == set(order(big)[:100])


def test_ranks(skewed):
    by_hash = {r["id"]: r["rank"] for r in sp.seeded_shuffle(skewed, out="rank").collect()}
    assert by_hash == {i: n for n, i in enumerate(order(range(1000)), 1)}
    grouped = ranking.with_hash_rank(skewed, ranking.hash_order_key(42, "id"), "id", groups=["label"]).collect()
    assert sorted(r["rank"] for r in grouped if r["label"] == "big") == list(range(1, 701))
    ordered = {r["id"]: r["rank"] for r in ranking.with_ordered_rank(skewed.repartition(7), ["id"]).collect()}
    assert ordered == {i: i + 1 for i in range(1000)}


def test_null_keys_and_labels_lose_no_row(spark):
    rows = [(None, None)] + [(i, None if i % 3 == 0 else i % 2) for i in range(9)]
    df = spark.createDataFrame(rows, "id long, label long")
    assert sp.mini_batches(df, 4).groupBy("batch").count().orderBy("batch").collect()[2]["count"] == 2
    assert sp.alternating_labels(df.drop("label")).count() == 10
    parts = Counter((r["label"], r["split"]) for r in sp.stratified_split(df, "label", test_size=0.5).collect())
    assert sum(parts.values()) == 10 and parts[None, "train"] == 2
    assert Counter(r["label"] for r in sp.balance_classes(df, "label").collect()) == {None: 3, 0: 3, 1: 3}


def test_samples(skewed, spark):
    assert sorted(r["id"] for r in sp.hash_sample(skewed, 9).collect()) == sorted(order(range(1000))[:9])
    assert sp.hash_sample(spark.range(3), 9).count() == 3
    assert sp.mini_batches(spark.range(70), 32).groupBy("batch").count().orderBy("batch").collect()[2]["count"] == 6


def test_weighted_labels(skewed, spark):
    drawn = Counter(r["label"] for r in sp.weighted_labels(spark.range(5000), skewed).collect())
    assert sum(drawn.values()) == 5000 and abs(drawn["big"] / 5000 - 0.7) < 0.03


def test_label_maps(spark):
    data = spark.createDataFrame([(1, 10), (2, 2), (3, 7)], "id int, label int")
    index = sp.label_index(data)
    assert {r["label"]: r["label_idx"] for r in index.collect()} == {2: 0, 7: 1, 10: 2}
    new = spark.createDataFrame([(4, 99), (5, 7)], "id int, label int")
    assert [r["id"] for r in sp.encode_labels(new, index, unseen="skip").collect()] == [5]
    assert {r["id"]: r["label_idx"] for r in sp.encode_labels(new, index, unseen="keep").collect()} == {4: None, 5: 1}
    with pytest.raises(Exception, match="label without an index"):
        sp.encode_labels(new, index).collect()
    decoded = sp.decode_labels(spark.createDataFrame([(0,), (9,)], "class_index int"), index).collect()
    assert {r["class_index"]: r["class"] for r in decoded} == {0: "2", 9: "9"}


def test_sequences(spark):
    docs = spark.createDataFrame([(1, " The cat  the dog"), (2, ""), (3, "the bird sat on the mat")], "id int, text string")
    vocab = v.build_vocabulary(docs.where("id = 1"), max_size=4)
    assert [(r["word"], r["idx"], r["n"]) for r in vocab.orderBy("idx").collect()] == [
        ("<PAD>", 0, None), ("<UNK>", 1, None), ("the", 2, 2), ("cat", 3, 1)]
    rows = {r["id"]: r["sequence"] for r in v.texts_to_sequences(docs, vocab, length=5).collect()}
    assert rows == {1: [2, 3, 2, 1, 0], 2: [0] * 5, 3: [2, 1, 1, 1, 2]}
    whole = {r["id"]: r["sequence"] for r in v.texts_to_sequences(docs, vocab, length=None).collect()}
    assert whole == {1: [2, 3, 2, 1], 2: [], 3: [2, 1, 1, 1, 2, 1]}


def test_topic_table(spark):
    docs = spark.createDataFrame([(1, "Deep WATER"), (None, "ox"), (3, "été"), (4, ""), (5, None), (1, "Deep WATER")], "id int, text string")
    topics = spark.createDataFrame([("water",), ("x",), ("ÉT",), ("",), (None,), ("x",)], "topic string")
    many = topics.union(spark.range(3000).selectExpr("concat('topic', id)"))
    for table in (topics, many):
        for size in (1 << 20, 50_000, 50):
            if size == 50 and table is many:
                continue
            assert sorted(r["id"] or 0 for r in match_topic_table(docs, table, index_bytes=size).collect()) == [0, 1, 1, 3]
    assert match_topic_table(docs, topics.limit(0)).count() == 0
    assert match_topic_table(docs.limit(0), topics).count() == 0


def test_topics_of_texts_equal_plain_search(spark, monkeypatch):
    import random

    monkeypatch.setattr("lexmill.operators.topics.PIECE", 16)
    r = random.Random(3)
    make = lambda n: "".join(r.choice("abé ") for _ in range(n))
    topics = sorted({make(r.randrange(1, 14)).lower() for _ in range(300)} | {"aaaaaaaa", "a" * 20, "b", "é"})
    texts = [make(r.randrange(0, 90)) for _ in range(80)] + ["A" * 30, "B", "", None, "é" * 40]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "id int, text string, `a.b` int")
    table = spark.createDataFrame([(t,) for t in topics + topics[:9]] + [(None,), ("",)], "topic string")
    want = {i: sorted(t for t in topics if t in (text or "").lower()) for i, text in enumerate(texts)}
    for size in (1 << 20, 4000):
        got = with_topics(docs, table, index_bytes=size)
        assert got.columns == ["id", "text", "a.b", "topics"]
        assert {x.id: x.topics for x in got.collect()} == want
        kept = match_topic_table(docs, table, index_bytes=size)
        assert sorted(x.id for x in kept.collect()) == [i for i, found in want.items() if found]


def test_topics_beyond_an_index_never_reach_the_driver(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("the topics came to the driver")

    monkeypatch.setattr("lexmill.operators.topics.TopicIndex", refused)
    monkeypatch.setattr("lexmill.operators.topics.FILTER_BITS", 15)
    topics = spark.range(20_000).selectExpr("concat('topic ', id) AS topic")
    rows = [(1, "No TOPIC 7 and topic 12345 topic 7"), (1, "No TOPIC 7 and topic 12345 topic 7"), (None, "topic"), (3, None), (4, "x" * 9 + "Topic 19999")]
    docs = spark.createDataFrame(rows, "id int, text string")
    got = sorted((x.id or 0, x.topics) for x in with_topics(docs, topics, index_bytes=1000).collect())
    both = sorted(f"topic {n}" for n in (7, 1, 12, 123, 1234, 12345))
    assert got == [(0, []), (1, both), (1, both), (3, []), (4, sorted(f"topic {n}" for n in (1, 19, 199, 1999, 19999)))]
    assert sorted(x.id for x in match_topic_table(docs, topics, index_bytes=1000).collect()) == [1, 1, 4]


def test_texts_do_not_meet_every_topic_that_shares_a_window(spark):
    """A text has each of these topics at hundreds of places, and all begin alike there."""
    topics = spark.range(1, 600).selectExpr("repeat('ab', cast(id AS int)) AS topic")
    rows = [(1, "AB" * 500), (2, "ab" * 9 + "é" + "b" * 40), (3, "é" * 700), (4, None)]
    docs = spark.createDataFrame(rows, "id int, text string")
    got = with_topics(docs, topics, index_bytes=1000)
    assert {x.id: [len(t) for t in x.topics] for x in got.collect()} == {1: [*range(2, 1001, 2)], 2: [*range(2, 19, 2)], 3: [], 4: []}
    assert sorted(x.id for x in match_topic_table(docs, topics, index_bytes=1000).collect()) == [1, 2]
    # Neither places nor texts are joined.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "place" not in plan and "_raw" not in plan and "gram" not in plan


def test_strings_with_the_bits_of_topics_are_told_apart(spark, monkeypatch):
    """With few bits nearly all strings of a text have those of a topic."""
    monkeypatch.setattr("lexmill.operators.topics.FILTER_BITS", 15)
    topics = spark.range(60_000).selectExpr("concat(char(97 + id % 26), hex(id * 7919), 'é') AS topic")
    texts = [(i, " ".join(f"{chr(97 + n % 26)}{n * 7919 + (n % 3 == 0):X}é" for n in range(i, i + 60))) for i in range(0, 60_000, 6_000)]
    docs = spark.createDataFrame(texts, "id int, text string")
    known = {r.topic.lower() for r in topics.collect()}
    want = {i: sorted({t[a:b] for a in range(len(t)) for b in range(a + 2, a + 12) if t[a:b] in known}) for i, t in ((i, t.lower()) for i, t in texts)}
    got = {x.id: x.topics for x in with_topics(docs, topics, index_bytes=1000).collect()}
    assert got == want and all(len(t) >= 40 for t in got.values())


def test_topics_are_filed_under_their_rarest_window(spark):
    table = spark.createDataFrame([("commonwaterfall",), ("commonwaterside",), ("commonwater",), ("xy",)], "topic string")
    keys = {x.topic: (x.size, x.at) for x in topic_keys(table).collect()}
    assert keys["xy"] == (2, 0) and keys["commonwater"][0] == 8
    assert keys["commonwaterfall"][1] >= 4 and keys["commonwaterside"][1] >= 4


def test_metrics_and_noise(values):
    got = values(lambda t: text_metrics(t, F.lit("xx")), ["One two. Three!", " "])
    assert got[0]["avg_sentence_length"] == 1.5 and got[0]["avg_word_length"] == 11 / 3
    assert tuple(got[1]) == (0, 0.0, 0.0, 0.0, 0.0, 0.0)
    text = "<p>a b</p> c. " * 2000
    whole, = values(noise_analysis, [text])
    assert (whole["sample_length"], whole["html_ratio"]) == (len(text), len(re.findall("<[^>]+>", text)) / len(text))
    noise = values(lambda x: noise_analysis(x, sampled=True), [text, ""])
    assert (noise[0]["text_length"], noise[0]["sample_length"], noise[0]["has_html"]) == (len(text), 10_000, True)
    sample = text[:3333] + text[len(text) // 2 - 1666:][:3333] + text[-3334:]
    assert noise[0]["html_ratio"] == sample.count("<") / 10_000
    assert (noise[1]["html_ratio"], noise[1]["sentence_count"], noise[1]["deep_reduction"]) == (0.0, 1, 0.0)


def test_the_end_of_a_long_text_counts(values):
    english = "The people of the town were there and they had their own houses near the river. " * 400
    cyrillic = "Люди города жили там и имели свои дома у реки. " * 4000
    both = english + cyrillic
    assert values(script_guess, [both]) == ["ru"] and values(lambda t: script_guess(t, 2000), [both]) == ["en"]
    assert values(primary_script, [both]) == ["cyrillic"] and values(lambda t: primary_script(t, 1000), [both]) == ["english"]
    found = values(lambda t: quality(t, columns=["language"])["language"], [both])
    assert found == ["ru"] and values(lambda t: quality(t, columns=["language"], language_chars=5000)["language"], [both]) != ["ru"]
    marked = english + "<b>&nbsp;</b>" * 3000
    assert values(lambda t: noise_analysis(t)["html_ratio"], [marked])[0] > 0.05


def test_big_text_sample(values):
    text = "".join(f"line {i}\n" for i in range(1000))
    n, z = len(text), 50

    def window(start):
        return text[start:].split("\n", 1)[1][:z]

    expect = text[:z] + window(n // 2 - z // 2) + window(n - z)
    assert values(lambda t: big_text_sample(t, small=100, head=10, window=z), [text, "abc" * 20]) == [expect, ("abc" * 20)[:10]]


def test_pattern_filter_cleans(spark):
    # No word ends in a to d: such a letter before a blank counts as an answer option.
    lines = ["<i>Our river runs over low green hills</i>", "My sister sings when &nbsp; morning comes",
             "The moon is shining {{tpl}} on the lake tonight"]
    ok = "\n".join([lines[0], "### !!! ###", "subscribe now", lines[1], "", lines[2]])
    texts = [ok, "short", ok + "\ncopyright us", "\n".join(lines[:2]), ok + "\n1. A) x 2. B) y 3. C) z", "so " * 40 + ok]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = [r["clean_text"] for r in with_pattern_filter(df).orderBy("id").collect()]
    clean = ("Our river runs over low green hills My sister sings when morning comes "
             "The moon is shining on the lake tonight")
    assert rows == [clean, None, None, None, None, "so " * 40 + clean]


def test_line_profile_whole_and_grouped(spark):
    df = spark.createDataFrame([("a", "x y\n\nx y\n[z"), ("a", "x y"), ("b", "\n")], "g string, text string")
    whole = reports.line_profile(df).first()
    assert (whole["line_count"], whole["vocabulary_size"]) == (4, 3)
    assert whole["duplicated_line_ratio"] == 0.5 and whole["empty_line_ratio"] == 3 / 7
    assert whole["malformed_line_ratio"] == 0.25
    assert [r["g"] for r in reports.line_profile(df, ["g"]).collect()] == ["a"]


def test_histogram_edges(spark):
    h = {r["bin"]: r["n"] for r in reports.histogram(spark.createDataFrame([(0,), (10,), (5,)], "x int"), "x", 2).collect()}
    assert h == {0: 1, 1: 2}
    flat = reports.histogram(spark.createDataFrame([(3,), (3,)], "x int"), "x", 4).collect()
    assert sum(r["n"] for r in flat) == 2


def test_evaluate_clips(spark):
    p = spark.createDataFrame([([0.0, 1.0], 0), ([0.5, 0.5], 0), ([1.0, 0.0], 0)], "probabilities array<double>, label_idx int")
    e = m.evaluate(p).first()
    assert e["n"] == 3 and abs(e["accuracy"] - 2 / 3) < 1e-12
    assert abs(e["loss"] - (-math.log(1e-15) - math.log(0.5) - math.log(1 - 1e-15)) / 3) < 1e-9


def test_pseudo_labels(spark):
    many = spark.createDataFrame(
        [(i, "apple banana cherry" if i % 2 else "engine wheel brake") for i in range(40)], "id long, text string")
    labels = {r["id"]: r["label"] for r in m.pseudo_labels(many).collect()}
    assert len({labels[i] for i in range(0, 40, 2)}) == len({labels[i] for i in range(1, 40, 2)}) == 1
    assert labels[0] != labels[1]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_wise_plans_have_no_shuffle_and_no_python(spark, sf):
    from lexmill.functions.cleaning import with_clean_text
    from lexmill.functions.quality import with_quality
    from lexmill.operators.extraction import pages_to_documents
    from lexmill.operators.filters import keep_good_quality

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    for df in (
        with_quality(docs), with_clean_text(docs, deep=True), keep_good_quality(docs),
        keep_good_quality(pages_to_documents(pages, content="html", content_type=None)), with_pattern_filter(docs),
    ):
        plan = plan_of(df)
        assert "Exchange" not in plan and "Python" not in plan and "Cartesian" not in plan


def test_filter_does_not_repeat_the_text_work(spark, sf):
    from lexmill.operators.filters import keep_good_quality

    plan = plan_of(keep_good_quality(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")))
    assert plan.count("all\\s+rights") + plan.count("copyright") <= 2
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_split_shuffles_no_text(spark, sf):
    split = sp.ratio_split(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), "doc_id")
    main = plan_of(split).split("Subqueries")[0]
    assert "Window" not in main.split("Subquery")[0]


def test_saved_parts_come_back(spark, tmp_path):
    from lexmill.plans.jobs import corpus_quality_report
    from lexmill.functions.quality import with_quality
    from lexmill.sources.sinks import write_clean_corpus, write_dataset
    from lexmill.sources.text import read_dataset

    docs = spark.createDataFrame(
        [(i, "spam offer win money now" if i % 2 else "meeting agenda for monday", i % 2) for i in range(20)],
        "id long, text string, label_idx int")
    vocab = v.build_vocabulary(docs)
    v.write_vocabulary(vocab, str(tmp_path / "vocab"))
    assert sorted(map(str, v.read_vocabulary(spark, str(tmp_path / "vocab")).collect())) == sorted(map(str, vocab.collect()))
    model = m.train_text_classifier(docs, 2, features=64, max_iter=20)
    m.save_model(model, str(tmp_path / "model"))
    scored = m.predict(m.load_model(str(tmp_path / "model")), docs)
    assert m.evaluate(scored).first()["accuracy"] == 1.0
    write_dataset(sp.ratio_split(docs), str(tmp_path / "ds"), text="text")
    assert read_dataset(spark, str(tmp_path / "ds/data")).where("split = 'train'").count() == 16
    write_clean_corpus(docs.withColumn("source", F.lit("s")), str(tmp_path / "clean"), "source", "text")
    assert spark.read.text(str(tmp_path / "clean/source=s")).count() == 20
    report = {r["category"]: r["n"] for r in corpus_quality_report(docs).collect()}
    assert report["all"] == 20
    line = reports.file_report(with_quality(docs.withColumn("filename", F.lit("f")))).first()
    assert line["filename"] == "f" and line["length"] > 0


def test_tfidf_without_terms(spark):
    assert v.tfidf(spark.createDataFrame([(1, "a b the")], "id int, text string")).count() == 0


def _gated(spark, texts, **kw):
    from lexmill.operators.gates import clean_by_quality

    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return clean_by_quality(df, **kw).orderBy("id").collect()


def test_language_is_only_identified_where_it_decides(spark, monkeypatch):
    """Identifying fails here; plain Latin texts do not need it, those that meet a rule of one language do."""
    from lexmill.functions import cleaning, quality

    def never(*_):
        return F.struct(F.raise_error(F.lit("identified")).cast("string").alias("language"))

    plain = "Only an ordinary line of words, é and ß included, that goes on and on for over a hundred characters; all of it is text. "
    monkeypatch.setattr(quality, "detect_language", never)
    monkeypatch.setattr(cleaning, "detect_language", never)
    assert [x.cleaning_applied for x in _gated(spark, [plain, plain * 3, plain + "Share this *** newsletter", "short"])] == ["deep"] * 4
    for text in (plain + "contraseña", plain + "пароль", plain + "的", plain + "\nPregunta 5"):
        with pytest.raises(Exception, match="identified"):
            _gated(spark, [text])


@pytest.mark.parametrize("mode", ["document", "lines"])
def test_gate_scores_what_it_returns(spark, values, mode):
    """The score after cleaning is that of the cleaned text, whether its words are counted again or not."""
    plain = "The words of this line come again, and the words of that line  come\tagain ***  too!!! "
    marks = ["", "a.b@c.de x@y", "http://the.words/of", "www.words.of of", "the&amp;the", "ΑΣ·Β ΑΣ Β ας", "İ ı ſhare this pAſſword", "share*this",
             "的一是不了在" * 40, "的", "contraseña acerca de", "пароль " * 30, "\n5. words\n"]
    texts = [plain * 3 + m + " " + plain for m in marks] + [plain * 2 + m + m for m in marks] + [m * 3 for m in marks] + ["WORDS IN CAPITALS", None]
    got = _gated(spark, texts, mode=mode)
    after = values(lambda t: quality(t)["quality_score"], [x.clean_text for x in got])
    before = values(lambda t: quality(t)["quality_score"], texts)
    assert [(x.quality_before, x.quality_after) for x in got] == list(zip(before, after))
