"""Scoring, evaluation, clustering, classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query, r6, table, texts, vectors
from lexmill.operators import models as m
from lexmill.operators import reports, sampling
from lexmill.operators.scratch import materialized, new_folder
from lexmill.operators.vocabulary import build_vocabulary
from lexmill.plans import jobs

_HIDDEN, _OUT, _IN = 16, 4, 64


def _grid(spark: SparkSession, layer: int, outs: int, ins: int) -> DataFrame:
    """Fixed weights ((7 * out + 3 * in + layer) mod 11 - 5) / 16 of one layer."""
    cells = spark.range(outs * ins).select(
        F.floor(F.col("id") / ins).cast("int").alias("out_i"), (F.col("id") % ins).cast("int").alias("in_i"))
    value = ((F.col("out_i") * 7 + F.col("in_i") * 3 + layer) % 11 - 5) / 16
    return cells.select(F.lit(layer).alias("layer"), "out_i", "in_i", value.alias("w"))


def _network(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    weights = _grid(spark, 0, _HIDDEN, _IN).unionByName(_grid(spark, 1, _OUT, _HIDDEN))
    biases = weights.groupBy("layer", "out_i").agg(F.lit(None).alias("x")).select(
        "layer", "out_i", ((F.col("out_i") % 3 - 1) / 8).alias("b"))
    return weights, biases


_NET = f"""WITH v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
h AS (SELECT vec_id, o, greatest(0.0, sum(x * ((o * 7 + i * 3) % 11 - 5) / 16.0::DOUBLE) + (o % 3 - 1) / 8.0::DOUBLE) AS x
      FROM v CROSS JOIN range({_HIDDEN}) AS r(o) GROUP BY vec_id, o),
z AS (SELECT vec_id, r.o, sum(x * ((r.o * 7 + h.o * 3 + 1) % 11 - 5) / 16.0::DOUBLE) + (r.o % 3 - 1) / 8.0::DOUBLE AS z
      FROM h CROSS JOIN range({_OUT}) AS r(o) GROUP BY vec_id, r.o),
p AS (SELECT vec_id, o, exp(z - max(z) OVER w) / sum(exp(z)) OVER w * exp(max(z) OVER w) AS p FROM z WINDOW w AS (PARTITION BY vec_id)),
best AS (SELECT vec_id, arg_max(o, struct_pack(p := p, o := -o)) AS class_index, max(p) AS confidence FROM p GROUP BY vec_id)"""


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return m.dense_scores(
        vectors(spark, sf), *_network(spark), ["relu", "softmax"], "embedding", out="probabilities")


@query(f"{_NET} SELECT vec_id, o AS out_i, round(p, 6) AS value FROM p")
def dense_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scored(spark, sf).select("vec_id", F.posexplode("probabilities").alias("out_i", "value"))
    return scored.select("vec_id", F.col("out_i").cast("long").alias("out_i"), r6("value"))


# The same layers in blocks of 8 places.
@query(f"{_NET} SELECT vec_id, o AS out_i, round(p, 6) AS value FROM p")
def dense_scores_blocked(spark: SparkSession, sf: str) -> DataFrame:
    scored = m.dense_scores_blocked(
        vectors(spark, sf), *_network(spark), ["relu", "softmax"], "embedding", "vec_id", block=8, salts=4)
    values = scored.select("vec_id", F.posexplode("scores").alias("out_i", "value"))
    return values.select("vec_id", F.col("out_i").cast("long").alias("out_i"), r6("value"))


@query(f"{_NET} SELECT vec_id, class_index, round(confidence, 6) AS confidence FROM best")
def predict_argmax(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select("vec_id", *m.argmax_prediction("probabilities")).select(
        "vec_id", "class_index", r6("confidence"))


@query(f"""{_NET} SELECT count(*) AS n, round(avg(-ln(least(greatest(coalesce(p, 0.0), 1e-15), 1 - 1e-15))), 6) AS loss,
 round(avg((class_index = label % {_OUT})::INT), 6) AS accuracy
FROM embeddings e JOIN best ON best.vec_id = e.vec_id JOIN p ON p.vec_id = e.vec_id AND p.o = label % {_OUT}""")
def evaluation(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scored(spark, sf).withColumn("label_idx", F.col("label") % _OUT)
    return m.evaluate(scored).select("n", r6("loss"), r6("accuracy"))


@query("""SELECT vec_id, round(1 / (1 + exp(-greatest(-15.0, least(15.0, z)))), 6) AS value FROM (
  SELECT vec_id, sum(x * (i * 3 % 11 - 5) / 16.0::DOUBLE) - 0.125 AS z FROM (
    SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) GROUP BY vec_id)""")
def sigmoid_scores(spark: SparkSession, sf: str) -> DataFrame:
    weights = _grid(spark, 0, 1, _IN)
    biases = spark.range(1).select(F.lit(0).alias("layer"), F.lit(0).alias("out_i"), F.lit(-0.125).alias("b"))
    scored = m.dense_scores(vectors(spark, sf), weights, biases, ["sigmoid"], "embedding")
    return scored.select("vec_id", r6(F.col("scores")[0], "value"))


@query("""WITH t AS (SELECT count(*) AS n, count(DISTINCT quality) AS k FROM labels),
v AS (SELECT least(count(DISTINCT w) + 2, 10000) AS size FROM (SELECT unnest(regexp_extract_all(lower(text), '[^\\s\\x0B\\x1C-\\x1F\\x{85}\\p{Z}]+')) AS w FROM documents))
SELECT n AS n_train, k AS n_labels, size AS vocabulary_size, least(CASE WHEN n > 100000 THEN 64 ELSE 32 END, n) AS batch_size,
 CASE WHEN n < 10 THEN 0.001 WHEN n > 100000 THEN 0.005 ELSE 0.01 END::DOUBLE AS learning_rate, 10 AS epochs FROM t, v""")
def training_profile(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels")
    profile = reports.training_profile(labels, build_vocabulary(texts(spark, sf)), "quality")
    return profile.withColumn("learning_rate", F.col("learning_rate").cast("double"))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return texts(spark, sf).join(labels, "doc_id")


# Iterative estimators: the results state what SQL can check, whatever the solver finds.


def _assigned(labelled: DataFrame, k: int) -> DataFrame:
    """One row: rows, rows with a label in 0..k-1, whether several labels occur."""
    return labelled.agg(
        F.count("*").alias("n"), F.count_if(F.col("label").between(0, k - 1)).alias("assigned"),
        (F.count_distinct("label") > 1).alias("several"))


@query("SELECT count(*) AS n, count(*) AS assigned, true AS several, true AS best_of_all, true AS near_own_centre FROM embeddings")
def kmeans_profile(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    points = materialized(vectors(spark, sf).select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x")).withColumn("features", array_to_vector("x")))
    chosen = materialized(m.cluster_labels(points))
    # The silhouette of the chosen number of clusters is not below that of any other number.
    judge = ClusteringEvaluator(featuresCol="features", predictionCol="label", distanceMeasure="squaredEuclidean")
    others = [KMeans(k=k, seed=42, featuresCol="features", predictionCol="label").fit(points).transform(points) for k in range(2, 6)]
    best = judge.evaluate(chosen) >= max(judge.evaluate(o) for o in others) - 1e-9
    # Points are nearer to the mean of their own cluster than to the mean of any other.
    places = chosen.select("label", F.posexplode("x").alias("i", "v")).groupBy("label", "i").agg(F.avg("v").alias("m"))
    means = places.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda e: e["m"]).alias("m"))
    centres = means.agg(F.collect_list(F.struct("label", "m")).alias("c")).scalar()
    apart = lambda m_: F.aggregate(F.zip_with("x", m_, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s_, d: s_ + d)
    nearest = F.array_min(F.transform("c", lambda c: F.struct(apart(c["m"]).alias("d"), c["label"].alias("label"))))["label"]
    near = chosen.withColumn("c", centres).agg((F.avg((nearest == F.col("label")).cast("int")) > 0.9).alias("b")).select("b").scalar()
    return _assigned(chosen, 5).withColumn("best_of_all", F.lit(best)).withColumn("near_own_centre", near)


# Texts of one cluster share more words with their own centre than with the centre of all: a label dealt out
# by chance would not tell them apart.
@query("SELECT count(*) AS n, count(*) AS assigned, true AS several, true AS apart FROM documents")
def text_pseudo_labels(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    from lexmill.operators.vocabulary import tfidf_vectors

    docs = texts(spark, sf)
    labelled = materialized(m.pseudo_labels(docs, "doc_id").select("doc_id", "label"))
    points = tfidf_vectors(docs, "doc_id").join(labelled, "doc_id")
    # Variance inside the clusters against variance of all, added up over the terms; vectors stay sparse.
    sums = materialized(points.groupBy("label").agg(F.count("*").alias("n"), Summarizer.metrics("sum", "normL2").summary(F.col("features")).alias("s")).select(
        "label", "n", vector_to_array("s.sum").alias("s"), vector_to_array("s.normL2").alias("q")))
    cells = sums.select("n", F.posexplode(F.arrays_zip("s", "q")).alias("i", "c")).select("i", "n", "c.s", (F.col("c.q") * F.col("c.q")).alias("q"))
    around = lambda s_, n: F.sum("q") - F.sum(s_ * s_ / n)
    inside = cells.agg(around(F.col("s"), F.col("n")).alias("v")).select("v").scalar()
    whole = cells.groupBy("i").agg(F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum("n").alias("n"))
    total = whole.agg(around(F.col("s"), F.col("n")).alias("v")).select("v").scalar()
    return _assigned(labelled, 5).withColumn("apart", inside < 0.99 * total)


# Projected values are centred, and the first component varies most.
@query("""SELECT count(*) AS n, true AS centred, true AS in_order FROM embeddings
WHERE vec_id IN (SELECT doc_id FROM labels)""")
def embedding_projection(spark: SparkSession, sf: str) -> DataFrame:
    doubles = vectors(spark, sf).select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    wanted = table(spark, sf, "labels").select(F.col("doc_id").alias("vec_id"))
    projected = m.embedding_projection(doubles, wanted, "vec_id", "embedding")
    first, second = F.col("projection")[0], F.col("projection")[1]
    return projected.agg(
        F.count("*").alias("n"), (F.greatest(F.abs(F.avg(first)), F.abs(F.avg(second))) < 1e-9).alias("centred"),
        (F.var_pop(first) >= F.var_pop(second)).alias("in_order"))


def _judged(scored: DataFrame, classes: int) -> DataFrame:
    """One row: rows, rows whose probabilities sum to 1 and whose class is the largest, whether the scores are in range."""
    total = F.aggregate("probabilities", F.lit(0.0), lambda s, p: s + p)
    sound = (F.abs(total - 1) < 1e-6) & F.col("class_index").between(0, classes - 1) & (
        F.col("confidence") == F.array_max("probabilities"))
    result = m.evaluate(scored).select(((F.col("accuracy").between(0, 1)) & (F.col("loss") >= 0)).alias("ok"))
    # A constant answer would be right for the share of the commonest label.
    accuracy = m.evaluate(scored).select("accuracy").scalar()
    better = _majority(scored).select((accuracy > F.col("majority")).alias("b")).select("b").scalar()
    return scored.agg(F.count("*").alias("n"), F.count_if(sound).alias("sound")).withColumn("in_range", result.scalar()).withColumn("better", better)


_LABELLED = "SELECT quality FROM labels JOIN documents USING (doc_id)"
_HELD_OUT = f"SELECT ceil(count(*) * 0.2)::BIGINT AS n, ceil(count(*) * 0.2)::BIGINT AS sound, true AS in_range, true AS better FROM ({_LABELLED})"


def _split_by_label(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    split = materialized(sampling.stratified_split(_labelled(spark, sf), "label", "doc_id"))
    train, test = (split.where(F.col("split") == side) for side in ("train", "test"))
    return train, test, materialized(sampling.label_index(train))


@query(_HELD_OUT)
def classifier_eval(spark: SparkSession, sf: str) -> DataFrame:
    train, test, index = _split_by_label(spark, sf)
    model = m.train_text_classifier(sampling.encode_labels(train, index), 2, features=256, max_iter=15)
    return _judged(m.predict(model, sampling.encode_labels(test, index, unseen="skip")), 2)


# Chosen on a validation part of the training rows, judged on rows held out from both.
@query(_HELD_OUT)
def classifier_selection(spark: SparkSession, sf: str) -> DataFrame:
    train, test, index = _split_by_label(spark, sf)
    best = m.select_text_classifier(
        sampling.encode_labels(train, index), 2, iterations=(2, 8), features=256, kind="logistic")
    return _judged(m.predict(best.bestModel, sampling.encode_labels(test, index, unseen="skip")), 2)


# From saved model, label table and texts to classes with their probabilities.
@query("SELECT count(*) AS n, count(*) AS sound, count(*) AS named, true AS better FROM documents")
def predict_texts(spark: SparkSession, sf: str) -> DataFrame:
    train, _, index = _split_by_label(spark, sf)
    folder = new_folder(spark)
    model = m.train_text_classifier(sampling.encode_labels(train, index), 2, features=256, max_iter=8, kind="logistic")
    m.save_model(model, f"{folder}/model")
    index.write.parquet(f"{folder}/labels")
    found = materialized(jobs.predict_texts(texts(spark, sf), f"{folder}/model", f"{folder}/labels"))
    # Classes of the labelled texts are right more often than the commonest label.
    known = found.join(table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("q")), "doc_id")
    right = known.agg(F.avg((F.col("class") == F.col("q")).cast("int")).alias("a")).select("a").scalar()
    commonest = known.groupBy("q").agg(F.count("*").alias("c")).agg((F.max("c") / F.sum("c")).alias("s")).select("s").scalar()
    total = F.aggregate("probabilities", F.lit(0.0), lambda s, p: s + p)
    return found.agg(
        F.count("*").alias("n"), F.count_if((F.abs(total - 1) < 1e-6) & (F.col("confidence") >= 0.5)).alias("sound"),
        F.count_if(F.col("class").isin("0", "1")).alias("named")).withColumn("better", right > commonest)


# Languages told by learned embeddings and dense layers, trained epoch by epoch.  A constant answer would
# reach the share of the commonest language among the rows held out, and be no better.
_LANGUAGES = """WITH sp AS (SELECT lang, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) > floor(count(*) OVER () * 0.8) AS test FROM documents),
h AS (SELECT lang, count(*) AS n FROM sp WHERE test GROUP BY lang)
SELECT sum(n)::BIGINT AS n, round(max(n) / sum(n), 6)::DOUBLE AS majority, true AS better"""


def _by_language(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf, "documents").select("doc_id", "text", F.col("lang").alias("label"))
    split = materialized(sampling.ratio_split(docs, "doc_id"))
    train, test = (split.where(F.col("split") == side) for side in ("train", "test"))
    index = materialized(sampling.label_index(train))
    return sampling.encode_labels(train, index), sampling.encode_labels(test, index, unseen="skip")


def _majority(test: DataFrame) -> DataFrame:
    """One row: rows and share of the commonest label."""
    counts = test.groupBy("label_idx").agg(F.count("*").alias("c"))
    return counts.agg(F.sum("c").alias("n"), (F.max("c") / F.sum("c")).alias("majority"))


def _better(test: DataFrame, scored: DataFrame) -> DataFrame:
    accuracy = m.evaluate(scored).select("accuracy").scalar()
    return _majority(test).select("n", r6("majority"), (accuracy > F.col("majority")).alias("better"))


@query(f"{_LANGUAGES} FROM h")
def embedding_classifier(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _by_language(spark, sf)
    model = m.train_text_classifier(train, 4, embedding=24, max_iter=40)
    return _better(test, materialized(m.predict(model, test)))


# The chosen epoch is the first of those with the best validation accuracy, and the last ones brought nothing.
@query(f"{_LANGUAGES}, 1::BIGINT AS n_chosen, true AS first_best, true AS in_time FROM h")
def classifier_epochs(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _by_language(spark, sf)
    trained = m.train_in_epochs(train, 4, epochs=8, patience=2, steps=8, embedding=24)
    best = F.max_by("epoch", F.struct("val_accuracy", (-F.col("epoch")).alias("e")))
    told = trained.history.agg(F.struct(
        F.count_if("chosen").alias("n_chosen"), (F.max(F.when(F.col("chosen"), F.col("epoch"))) == best).alias("first_best"),
        ((F.max("epoch") == 8) | (F.max("epoch") - best == 2)).alias("in_time")).alias("t"))
    judged = _better(test, materialized(m.predict(trained.model, test)))
    return judged.withColumn("t", told.scalar()).select("n", "majority", "better", "t.*")
