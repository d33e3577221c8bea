"""Text classification, clustering and scoring on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, PCA, HashingTF, RegexTokenizer, SQLTransformer, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import patterns as rx
from lexmill.operators.ranking import join_on
from lexmill.operators.scratch import materialized
from lexmill.operators.vocabulary import tfidf_vectors

HIDDEN_UNITS = 64
#: Places for learned vectors; words share one by their hash, so a model does not grow with the texts.
EMBEDDED_WORDS = 1 << 15


def text_features(
    text: str = "text", features: int = 1024, embedding: int | None = None, min_count: int = 2, seed: int = 42, partitions: int = 1,
) -> list:
    """Stages from a text to the column ``features``.

    Words become TF-IDF values of ``features`` hashed places, or with ``embedding`` the mean of
    vectors of that size that are learned from the training texts for ``EMBEDDED_WORDS`` hashed
    places (those met less than ``min_count`` times have none), by ``partitions`` tasks whose results are put together after each pass.
    """
    words = RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=rx.SPACE + "+", toLowercase=True)
    if embedding:
        places = SQLTransformer(statement=f"SELECT *, transform(_tokens, x -> cast(pmod(xxhash64(x), {EMBEDDED_WORDS}) AS string)) AS _places FROM __THIS__")
        learned = Word2Vec(
            inputCol="_places", outputCol="features", vectorSize=embedding, minCount=min_count, seed=seed, maxIter=5, numPartitions=partitions)
        return [words, places, learned]
    return [words, HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features), IDF(inputCol="_tf", outputCol="features")]


def text_classifier(
    num_classes: int, text: str = "text", label: str = "label_idx", features: int = 1024, kind: str = "mlp",
    max_iter: int = 50, seed: int = 42, embedding: int | None = None, partitions: int = 1,
) -> Pipeline:
    """Tokens -> TF-IDF or learned embeddings -> classifier; ``kind`` is ``mlp`` or ``logistic``."""
    stages = text_features(text, features, embedding, seed=seed, partitions=partitions)
    if kind == "mlp":
        stages.append(MultilayerPerceptronClassifier(
            labelCol=label, layers=[embedding or features, HIDDEN_UNITS, max(2, num_classes)], maxIter=max_iter, seed=seed))
    elif kind == "logistic":
        stages.append(LogisticRegression(labelCol=label, maxIter=max_iter))
    else:
        raise ValueError(f"kind must be 'mlp' or 'logistic', not {kind!r}")
    return Pipeline(stages=stages)


#: Characters of training text for a task that learns embeddings; less text has one task, as short parts teach little.
EMBEDDING_CHARS = 4 << 20


def embedding_partitions(train: DataFrame, text: str = "text") -> int:
    """Tasks that learn embeddings together, no more than run at once: each sends its whole model after a pass."""
    chars = train.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    return max(1, min(train.sparkSession.sparkContext.defaultParallelism, -(-chars // EMBEDDING_CHARS)))


def _fit_in_steps(stages: list, train: DataFrame, label: str) -> PipelineModel:
    """Fit stage by stage; what a stage learns from is written once for its passes."""
    fitted, rows = [], train
    for stage in stages:
        if hasattr(stage, "fit"):
            takes = stage.getFeaturesCol() if stage.hasParam("featuresCol") else stage.getInputCol()
            rows = materialized(rows.select(label, takes)) if fitted else rows
            stage = stage.fit(rows)
        fitted.append(stage)
        rows = stage.transform(rows)
    return PipelineModel(stages=fitted)


def train_text_classifier(train: DataFrame, num_classes: int, **options) -> PipelineModel:
    text, label = options.get("text", "text"), options.get("label", "label_idx")
    if options.get("embedding"):
        options = {"partitions": embedding_partitions(train, text), **options}
    return _fit_in_steps(text_classifier(num_classes, **options).getStages(), train, label)


def select_text_classifier(
    train: DataFrame, num_classes: int, iterations: Sequence[int] = (10, 50), validation_share: float = 0.2,
    label: str = "label_idx", seed: int = 42, **options,
) -> TrainValidationSplitModel:
    """Best number of training iterations by validation accuracy.

    Words are found and counted once; only what learns from the rows is fitted again for each number.
    """
    if options.get("embedding"):
        options = {"partitions": embedding_partitions(train, options.get("text", "text")), **options}
    stages = text_classifier(num_classes, label=label, seed=seed, **options).getStages()
    learned = next(i for i, stage in enumerate(stages) if hasattr(stage, "fit"))
    given, takes = stages[:learned], stages[learned].getInputCol()
    rows = materialized(PipelineModel(stages=given).transform(train).select(label, takes))
    grid = ParamGridBuilder().addGrid(stages[-1].maxIter, list(iterations)).build()
    accuracy = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    found = TrainValidationSplit(
        estimator=Pipeline(stages=stages[learned:]), estimatorParamMaps=grid, evaluator=accuracy, trainRatio=1 - validation_share, seed=seed,
    ).fit(rows)
    return TrainValidationSplitModel(PipelineModel(stages=[*given, *found.bestModel.stages]), found.validationMetrics)


@dataclass
class EpochTraining:
    """The best model, and one row per epoch: epoch, loss, accuracy, val_loss, val_accuracy, chosen."""

    model: PipelineModel
    history: DataFrame


def train_in_epochs(
    train: DataFrame, num_classes: int, epochs: int = 20, patience: int | None = 3, steps: int = 5, validation_share: float = 0.2,
    text: str = "text", label: str = "label_idx", features: int = 1024, embedding: int | None = None, hidden: Sequence[int] = (HIDDEN_UNITS,),
    seed: int = 42,
) -> EpochTraining:
    """Dense layers trained epoch by epoch; the epoch with the best validation accuracy is kept.

    Each epoch goes on from the weights of the one before with ``steps`` passes of the solver.
    Training ends after ``patience`` epochs in a row without a better validation accuracy, or
    after ``epochs``; of equally good epochs the first is kept.  The validation part is
    chosen by a hash of the text, so copies of a text are on one side.  Texts become
    vectors once; only weights and a few figures of each epoch come to the driver.
    """
    partitions = embedding_partitions(train, text) if embedding else 1
    shaped = _fit_in_steps(text_features(text, features, embedding, seed=seed, partitions=partitions), train, label)
    held_out = F.pmod(F.xxhash64(text, F.lit(seed)), F.lit(10_000)) < round(validation_share * 10_000)
    rows = materialized(shaped.transform(train).select(F.col(label).alias("label_idx"), "features", held_out.alias("_held_out")))
    parts = {name: rows.where(F.col("_held_out") == side) for name, side in (("", False), ("val_", True))}
    layers, weights, history, best, worse = [embedding or features, *hidden, max(2, num_classes)], None, [], None, 0
    for epoch in range(1, epochs + 1):
        solver = MultilayerPerceptronClassifier(labelCol="label_idx", layers=layers, maxIter=steps, seed=seed)
        if weights is not None:
            solver = solver.setInitialWeights(weights)
        model = solver.fit(parts[""])
        weights, row = model.weights, {"epoch": epoch}
        for name, part in parts.items():
            scored = model.transform(part).withColumn("probabilities", vector_to_array("probability"))
            found = evaluate(scored).first()
            row |= {f"{name}loss": found["loss"], f"{name}accuracy": found["accuracy"]}
        history.append(row)
        if best is None or (row["val_accuracy"] or 0) > (best[0]["val_accuracy"] or 0):
            best, worse = (row, model), 0
        else:
            worse += 1
        if patience and worse >= patience:
            break
    table = train.sparkSession.createDataFrame(
        [(*r.values(), r is best[0]) for r in history],
        "epoch int, loss double, accuracy double, val_loss double, val_accuracy double, chosen boolean")
    return EpochTraining(PipelineModel(stages=[*shaped.stages, best[1]]), table)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def argmax_prediction(probabilities: Column | str) -> list[Column]:
    """class_index (first of the largest) and confidence of an array of probabilities."""
    p = rx.as_col(probabilities)
    best = F.array_max(p)
    return [(F.array_position(p, best) - 1).alias("class_index"), best.alias("confidence")]


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add probabilities, class_index and confidence."""
    scored = model.transform(df)
    with_p = scored.withColumn("probabilities", vector_to_array("probability"))
    return with_p.select(*df.columns, "probabilities", *argmax_prediction("probabilities"))


def evaluate(predictions: DataFrame, probabilities: str = "probabilities", label: str = "label_idx") -> DataFrame:
    """One row: n, categorical cross-entropy (probabilities clipped at 1e-15) and accuracy."""
    p = F.get(F.col(probabilities), F.col(label).cast("int"))
    clipped = F.least(F.greatest(F.coalesce(p, F.lit(0.0)), F.lit(1e-15)), F.lit(1 - 1e-15))
    best = F.array_position(probabilities, F.array_max(probabilities)) - 1
    return predictions.agg(
        F.count("*").alias("n"),
        F.avg(-F.log(clipped)).alias("loss"),
        F.avg((best == F.col(label)).cast("double")).alias("accuracy"),
    )


# --- feed-forward scoring over a table of vectors ----------------------------

def activation(kind: str, z: Column) -> Column:
    """relu, sigmoid (input clipped at ±15), softmax or identity of an array."""
    if kind == "relu":
        return F.transform(z, lambda v: F.greatest(F.lit(0.0), v))
    if kind == "sigmoid":
        return F.transform(z, lambda v: 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-15.0), F.least(F.lit(15.0), v)))))
    if kind == "softmax":
        shifted = rx.let(F.array_max(z), lambda top: F.transform(z, lambda v: F.exp(v - top)))
        return rx.let(shifted, lambda e: rx.let(
            F.aggregate(e, F.lit(0.0), lambda a, v: a + v), lambda total: F.transform(e, lambda v: v / total)))
    if kind == "identity":
        return z
    raise ValueError(f"unknown activation {kind!r}")


def layer_matrix(weights: DataFrame, biases: DataFrame, layer: int) -> DataFrame:
    """One row: rows of the weight matrix and the biases of a layer, in index order."""
    rows = (
        weights.where(F.col("layer") == layer).groupBy("out_i")
        .agg(F.sort_array(F.collect_list(F.struct("in_i", F.col("w").cast("double").alias("w")))).alias("r"))
    )
    bias = biases.where(F.col("layer") == layer).select("out_i", F.col("b").cast("double").alias("b"))
    joined = rows.join(bias, "out_i", "left").select(
        "out_i", F.transform("r", lambda e: e["w"]).alias("w"), F.coalesce("b", F.lit(0.0)).alias("b"))
    return joined.agg(F.sort_array(F.collect_list(F.struct("out_i", "w", "b"))).alias("units"))


def dense_scores(
    df: DataFrame, weights: DataFrame, biases: DataFrame, activations: Sequence[str], features: str,
    out: str = "scores",
) -> DataFrame:
    """Apply dense layers to vectors; adds the output array ``out``.

    ``weights``: (layer, out_i, in_i, w), complete; ``biases``: (layer, out_i, b);
    layers count from 0.  The model, whose size does not depend on the data,
    reaches the tasks as one scalar per layer, so vectors are scored where they
    are: no shuffle and no Python.
    """
    models = {f"_layer{i}": layer_matrix(weights, biases, i).scalar() for i in range(len(activations))}
    df = df.withColumns(models)

    def dense(x: Column, units: Column) -> Column:
        return F.transform(units, lambda u: F.aggregate(
            F.zip_with(u["w"], x, lambda w, v: w * v), F.lit(0.0), lambda a, v: a + v) + u["b"])

    def from_layer(i: int, s: Column) -> Column:
        if i == len(activations):
            return s["x"]
        rest = {f"_layer{j}": s[f"_layer{j}"] for j in range(i + 1, len(activations))}
        z = dense(s["x"], s[f"_layer{i}"])
        return rx.let(z, lambda v: rx.bind({"x": activation(activations[i], v), **rest}, lambda t: from_layer(i + 1, t)))

    # Every layer's input is bound once, not evaluated again per unit.
    start = {"x": F.transform(F.col(features), lambda v: v.cast("double")), **{m: F.col(m) for m in models}}
    return df.withColumn(out, rx.bind(start, lambda s: from_layer(0, s))).drop(*models)


#: Number of the block that stands for the biases: its only input is 1.
_BIAS = -1


def _vector_blocks(values: Column, block: int) -> Column:
    """(number, values) of the pieces of ``block`` values of an array, and the input of the biases."""
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int")), lambda b: F.struct(
        b.alias("b"), F.slice(values, b * block + 1, F.lit(block)).alias("x")))
    one = F.array(F.struct(F.lit(_BIAS).alias("b"), F.array(F.lit(1.0)).alias("x")))
    return F.when(F.size(values) > 0, F.concat(pieces, one)).otherwise(one)


def weight_blocks(weights: DataFrame, biases: DataFrame, layer: int, block: int) -> DataFrame:
    """(b, out_b, rows): a layer's matrix in square blocks; ``rows`` has the weights of each output, in order.

    The biases are the block of one more input, 0 for outputs that have none.
    """
    part = lambda c: F.floor(F.col(c) / block).cast("int")
    own = weights.where(F.col("layer") == layer)
    cells = own.select(part("in_i").alias("b"), part("out_i").alias("out_b"), "in_i", "out_i", F.col("w").cast("double").alias("w"))
    bias = biases.where(F.col("layer") == layer).select("out_i", F.col("b").cast("double").alias("w"))
    offsets = own.select("out_i").distinct().join(bias, "out_i", "left").select(
        F.lit(_BIAS).alias("b"), part("out_i").alias("out_b"), F.lit(0).alias("in_i"), "out_i", F.coalesce("w", F.lit(0.0)).alias("w"))
    rows = cells.unionByName(offsets).groupBy("b", "out_b", "out_i").agg(F.sort_array(F.collect_list(F.struct("in_i", "w"))).alias("r"))
    blocks = rows.groupBy("b", "out_b").agg(F.sort_array(F.collect_list(F.struct("out_i", "r"))).alias("m"))
    return blocks.select("b", "out_b", F.transform("m", lambda u: F.transform(u["r"], lambda e: e["w"])).alias("rows"))


def dense_scores_blocked(
    df: DataFrame, weights: DataFrame, biases: DataFrame, activations: Sequence[str], features: str, key: str,
    out: str = "scores", block: int = 256, salts: int = 16,
) -> DataFrame:
    """(key, out): the same as ``dense_scores``, for layers that no task can hold.

    Vectors and matrices are cut into blocks of ``block`` places; a block of a vector meets those of
    the matrix that it is multiplied with, and the products are added up per vector and
    block.  So a task holds one block of weights at a time.  There are few blocks and many
    vectors, so each weight block is repeated for ``salts`` groups of vectors.  Softmax looks at
    the blocks of a vector together, and the result puts them in a row again.  ``key``
    identifies the vectors.
    """
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    x = F.transform(F.col(features), lambda v: v.cast("double"))
    parts = df.select(F.col(key).alias("key"), F.explode(_vector_blocks(x, block)).alias("p")).select("key", "p.b", "p.x")
    each = Window.partitionBy("key")
    for layer, kind in enumerate(activations):
        if layer:
            one = parts.select("key").distinct().select("key", F.lit(_BIAS).alias("b"), F.array(F.lit(1.0)).alias("x"))
            parts = parts.unionByName(one)
        matrix = weight_blocks(weights, biases, layer, block).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = parts.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")).join(matrix, ["b", "salt"])
        product = F.transform("rows", lambda w: F.aggregate(
            F.zip_with(w, F.col("x"), lambda u, v: F.coalesce(u * v, F.lit(0.0))), F.lit(0.0), lambda s, v: s + v))
        # As many products for a vector and block as the layer has blocks of inputs.
        sums = met.select("key", "out_b", product.alias("z")).groupBy("key", "out_b").agg(F.collect_list("z").alias("zs"))
        z = sums.select("key", F.col("out_b").alias("b"), F.aggregate(F.slice("zs", 2, F.size("zs")), F.col("zs")[0], add).alias("z"))
        if kind == "softmax":
            shifted = z.withColumn("top", F.max(F.array_max("z")).over(each)).withColumn(
                "e", F.transform("z", lambda v: F.exp(v - F.col("top"))))
            whole = F.sum(F.aggregate("e", F.lit(0.0), lambda s, v: s + v)).over(each)
            parts = shifted.withColumn("all", whole).select("key", "b", F.transform("e", lambda v: v / F.col("all")).alias("x"))
        else:
            parts = z.select("key", "b", activation(kind, F.col("z")).alias("x"))
    rows = parts.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("b", "x"))).alias("blocks"))
    return rows.select(F.col("key").alias(key), F.flatten(F.transform("blocks", lambda e: e["x"])).alias(out))


# --- embeddings --------------------------------------------------------------

def embedding_projection(
    embeddings: DataFrame, wanted: DataFrame, key: str, features: str, components: int = 2,
) -> DataFrame:
    """Principal components of the wanted vectors: (key, projection); unknown keys are left out."""
    found = embeddings.join(wanted, key, "left_semi").select(key, array_to_vector(features).alias("_v"))
    # fit centres for the components only, so centre the projected values too.
    projected = PCA(k=components, inputCol="_v", outputCol="_p").fit(found).transform(found)
    values = projected.select(key, vector_to_array("_p").alias("_p"))
    means = values.select(*[F.avg(F.col("_p")[i]).alias(f"m{i}") for i in range(components)])
    centre = means.select(F.array(*means.columns).alias("m")).scalar()
    centred = F.zip_with("_p", "_m", lambda p, m: p - m)
    return values.withColumn("_m", centre).select(key, centred.alias("projection"))


# --- pseudo labels -----------------------------------------------------------

def cluster_labels(
    df: DataFrame, features: str = "features", max_clusters: int = 5, seed: int = 42, out: str = "label",
) -> DataFrame:
    """KMeans labels with the number of clusters (2..max) of the best silhouette.

    Fits on all rows, which are written once for the repeated passes.
    """
    df = materialized(df)
    evaluator = ClusteringEvaluator(featuresCol=features, predictionCol=out, distanceMeasure="squaredEuclidean")
    best, best_score = None, -1.0
    for k in range(2, max_clusters + 1):
        model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol=out).fit(df)
        assigned = model.transform(df)
        if assigned.select(out).distinct().limit(2).count() < 2:
            continue
        score = evaluator.evaluate(assigned)
        if best is None or score > best_score:
            best, best_score = model, score
    if best is None:
        return df.withColumn(out, F.lit(0))
    return best.transform(df)


def pseudo_labels(
    df: DataFrame, key: str = "id", text: str = "text", max_clusters: int = 5, seed: int = 42, out: str = "label",
) -> DataFrame:
    """Labels for unlabelled texts: clusters of the TF-IDF vectors of all whole texts.

    The number of clusters is the best of 2..``max_clusters`` by silhouette.
    """
    labels = cluster_labels(tfidf_vectors(df, key, text), max_clusters=max_clusters, seed=seed, out=out).select(key, out)
    # Every text has a vector, if only of zeros.
    return join_on(df, labels, [key])
