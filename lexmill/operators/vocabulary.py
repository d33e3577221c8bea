"""Vocabulary, index sequences and TF-IDF."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import lexicon as lx
from lexmill.functions import patterns as rx
from lexmill.functions import tokens
from lexmill.functions.stopwords import STOP_WORDS
from lexmill.operators.ranking import ordered_ranks
from lexmill.operators.scratch import materialized

# A vocabulary travels as so many small maps, each searched in a few steps.
BUCKETS = 1024
#: A larger vocabulary is joined instead; then only so many of the commonest words travel.
INLINE_WORDS = 200_000
HEAVY_WORDS = 20_000


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over lower-cased white-space tokens; frequent words combine map-side."""
    return df.select(F.explode(tokens.whitespace_tokens(text)).alias("word")).groupBy("word").agg(
        F.count("*").alias("n"))


def build_vocabulary(df: DataFrame, text: str = "text", max_size: int = lx.MAX_VOCABULARY) -> DataFrame:
    """(word, idx, n): padding 0, unknown 1, then words by falling frequency.

    Equal counts are ordered by word.  The two reserved entries count towards
    ``max_size``.
    """
    top = word_counts(df, text).orderBy(F.col("n").desc(), "word").limit(max_size - 2)
    # At most max_size rows from here on.
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc(), "word"))
    ranked = top.select("word", (rank + 1).cast("long").alias("idx"), "n")
    reserved = df.sparkSession.createDataFrame([(lx.PAD, 0, None), (lx.UNK, 1, None)], "word string, idx long, n long")
    # A corpus word spelled like a reserved entry takes over its row's name only.
    return reserved.unionByName(ranked)


def build_large_vocabulary(df: DataFrame, text: str = "text", max_size: int | None = None) -> DataFrame:
    """The same as ``build_vocabulary`` for any size, all words by default: ranked by a distributed sort."""
    counts = materialized(word_counts(df, text).withColumn("order", -F.col("n")))
    if max_size is not None:
        counts = materialized(counts.orderBy("order", "word").limit(max_size - 2))
    ranks = ordered_ranks(counts, ["order", "word"], "rank")
    ranked = ranks.select("word", (F.col("rank") + 1).cast("long").alias("idx"), (-F.col("order")).alias("n"))
    reserved = df.sparkSession.createDataFrame([(lx.PAD, 0, None), (lx.UNK, 1, None)], "word string, idx long, n long")
    return reserved.unionByName(ranked)


def write_vocabulary(vocabulary: DataFrame, path: str) -> None:
    vocabulary.write.parquet(path)


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def pad(sequence: Column, length: int = lx.MAX_SEQUENCE) -> Column:
    """Cut or right-pad with 0 to a fixed length."""
    return F.slice(F.concat(sequence, F.array_repeat(F.lit(0).cast("long"), length)), 1, length)


def first_tokens(text: Column | str, length: int) -> Column:
    """The first ``length`` white-space tokens; splitting stops there."""
    low = rx.strip(F.lower(rx.as_col(text)))
    parts = F.slice(F.split(low, rx.SPACE + "+", length + 1), 1, length)
    return F.array_remove(parts, "")


def texts_to_sequences(
    df: DataFrame, vocabulary: DataFrame, key: str = "id", text: str = "text", length: int | None = lx.MAX_SEQUENCE,
) -> DataFrame:
    """(key, sequence): word indices, 1 for unknown words, padded to ``length``; a row per text.

    ``length=None`` keeps all tokens unpadded; null texts have none.  The vocabulary,
    whose size is a parameter and does not grow with the texts, reaches the tasks as
    one scalar value, so texts are turned into sequences where they are: no shuffle.
    For more than ``INLINE_WORDS`` words use ``texts_to_sequences_joined``.
    """
    words = tokens.whitespace_tokens(text) if length is None else first_tokens(text, length)
    known = vocabulary.where(F.col("idx") > 1)
    df = df.withColumn("_maps", bucket_maps(known, "word", "idx").scalar())
    unknown = F.lit(1).cast("long")
    sequence = rx.bind({"w": F.coalesce(words, F.array().cast("array<string>")), "maps": F.col("_maps")}, lambda s: F.transform(
        s["w"], lambda x: F.coalesce(look_up(s["maps"], x), unknown)))
    return df.select(key, (sequence if length is None else pad(sequence, length)).alias("sequence"))


def texts_to_sequences_joined(
    df: DataFrame, vocabulary: DataFrame, key: str = "id", text: str = "text", length: int | None = lx.MAX_SEQUENCE,
    heavy_words: int = HEAVY_WORDS,
) -> DataFrame:
    """The same sequences for a vocabulary of any size.

    The ``heavy_words`` commonest words of these texts, known or not, are looked up in place;
    of the others each text sends its distinct ones to meet the vocabulary, so no task
    gets the rows of a common word.  What they find comes back to the text as one small list.
    Rows are written once with a number and matched by it: null and repeated keys are safe.
    """
    words = F.coalesce(tokens.whitespace_tokens(text) if length is None else first_tokens(text, length), F.array().cast("array<string>"))
    rows = materialized(df.select(F.col(key).alias("_key"), F.monotonically_increasing_id().alias("_row"), words.alias("_words")))
    known = materialized(vocabulary.where(F.col("idx") > 1).select("word", "idx"))
    unknown = F.lit(1).cast("long")
    counts = rows.select(F.explode("_words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    # A bounded table of the commonest words, with their places in the vocabulary if they have one.
    common = counts.orderBy(F.col("n").desc(), "word").limit(heavy_words).join(known, "word", "left")
    heavy = bucket_maps(materialized(common.select("word", F.coalesce("idx", unknown).alias("idx"))), "word", "idx").scalar()
    rows = rows.withColumn("_heavy", heavy)
    rare = rows.select("_row", F.explode(rx.bind({"w": F.array_distinct("_words"), "h": F.col("_heavy")}, lambda s: F.filter(
        s["w"], lambda x: look_up(s["h"], x).isNull()))).alias("word"))
    found = rare.join(known, "word").groupBy("_row").agg(F.collect_list(F.struct("word", "idx")).alias("_found"))
    joined = rows.join(found, "_row", "left")
    listed = F.map_from_entries(F.coalesce("_found", F.array().cast("array<struct<word:string,idx:bigint>>")))
    sequence = rx.bind({"w": F.col("_words"), "h": F.col("_heavy"), "f": listed}, lambda s: F.transform(
        s["w"], lambda x: F.coalesce(look_up(s["h"], x), F.try_element_at(s["f"], x), unknown)))
    return joined.select(F.col("_key").alias(key), (sequence if length is None else pad(sequence, length)).alias("sequence"))


def bucket_maps(table: DataFrame, key: str, value: str) -> DataFrame:
    """One row: an array of BUCKETS maps key -> value, a key in the map of its hash."""
    entries = table.groupBy(F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket")).agg(
        F.map_from_entries(F.collect_list(F.struct(key, value))).alias("m"))
    filled = entries.agg(F.map_from_entries(F.collect_list(F.struct("bucket", "m"))).alias("all"))
    return filled.select(F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.try_element_at("all", b)).alias("maps"))


def look_up(maps: Column, key: Column) -> Column:
    """Value of a key in ``bucket_maps``, null if it has none."""
    return F.try_element_at(F.get(maps, F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")), key)


def unknown_rate(df: DataFrame, vocabulary: DataFrame, text: str = "text") -> DataFrame:
    """One row: tokens, unknown tokens and their share."""
    counts = word_counts(df, text)
    known = vocabulary.where(F.col("idx") > 1).select("word", "idx")
    joined = counts.join(known, "word", "left")
    return joined.agg(
        F.sum("n").alias("tokens"),
        F.coalesce(F.sum(F.when(F.col("idx").isNull(), F.col("n"))), F.lit(0)).alias("unknown"),
    ).withColumn("unknown_share", F.col("unknown") / F.col("tokens"))


def tfidf_tokens(text: Column | str, stop_words: list[str] | None = None) -> Column:
    """Words of two or more characters, lower-cased, without stop words."""
    listed = STOP_WORDS["english"] if stop_words is None else stop_words
    members = ", ".join(rx.sql_text(w) for w in listed)
    kept = "length(x) >= 2" + (f" AND x NOT IN ({members})" if members else "")
    return F.call_function("filter", tokens.words(F.lower(rx.as_col(text))), F.expr(f"x -> {kept}"))


def tfidf_features(
    df: DataFrame, text: str = "text", max_features: int = 1000, stop_words: list[str] | None = None,
) -> DataFrame:
    """(term, idf) of the most frequent terms; equal counts in alphabetical order.

    idf = ln((1 + n) / (1 + df)) + 1.  A text gives one row per distinct term; only
    per-term sums are shuffled.
    """
    entries = df.select(F.inline(tokens.counted(tfidf_tokens(text, stop_words))))
    stats = entries.groupBy(F.col("value").alias("term")).agg(F.sum("n").alias("total"), F.count("*").alias("df"))
    top = stats.orderBy(F.col("total").desc(), "term").limit(max_features)
    n = df.agg(F.count("*").alias("n")).scalar()
    return top.select("term", (F.log((n + F.lit(1)) / (F.col("df") + F.lit(1))) + F.lit(1.0)).alias("idf"))


def tfidf(
    df: DataFrame, key: str = "id", text: str = "text", max_features: int = 1000, stop_words: list[str] | None = None,
    fit: DataFrame | None = None,
) -> DataFrame:
    """(key, term, weight): tf * idf, scaled to unit length per text.

    Terms and idf come from ``fit`` if given, else from ``df``; at most
    ``max_features`` terms reach the tasks as one scalar value, and the weights of a
    text are computed where it is.
    """
    idf = bucket_maps(tfidf_features(df if fit is None else fit, text, max_features, stop_words), "term", "idf").scalar()
    df = df.withColumn("_idf", idf)

    def weights(s: Column) -> Column:
        raw = F.transform(s["terms"], lambda e: F.struct(
            e["value"].alias("term"), (e["n"] * look_up(s["idf"], e["value"])).alias("weight")))
        return rx.let(F.filter(raw, lambda e: e["weight"].isNotNull()), scaled)

    def scaled(found: Column) -> Column:
        norm = F.sqrt(F.aggregate(found, F.lit(0.0), lambda a, e: a + e["weight"] * e["weight"]))
        return rx.let(norm, lambda n: F.transform(found, lambda e: F.struct(e["term"].alias("term"), (e["weight"] / n).alias("weight"))))

    entries = rx.bind({"terms": tokens.counted(tfidf_tokens(text, stop_words)), "idf": F.col("_idf")}, weights)
    return df.select(key, F.inline(entries))


def _chosen_terms(
    fit: DataFrame, text: str, max_features: int, stop_words: list[str] | None,
) -> list[tuple[str, float]]:
    """The (at most ``max_features``) terms with their idf, in alphabetical order."""
    return sorted((r["term"], r["idf"]) for r in tfidf_features(fit, text, max_features, stop_words).collect())


def _vectors(
    df: DataFrame, key: str, text: str, stop_words: list[str] | None, chosen: list[tuple[str, float]], out: str,
) -> DataFrame:
    counted = CountVectorizerModel.from_vocabulary(
        [t for t, _ in chosen], inputCol="_tokens", outputCol="_tf",
    ).transform(df.select(key, tfidf_tokens(text, stop_words).alias("_tokens")))
    weighted = ElementwiseProduct(
        scalingVec=Vectors.dense([idf for _, idf in chosen]), inputCol="_tf", outputCol="_raw").transform(counted)
    return Normalizer(p=2.0, inputCol="_raw", outputCol=out).transform(weighted).select(key, out)


def tfidf_vectors(
    df: DataFrame, key: str = "id", text: str = "text", max_features: int = 1000, stop_words: list[str] | None = None,
    fit: DataFrame | None = None, out: str = "features",
) -> DataFrame:
    """(key, out): the same weights as sparse vectors, terms in alphabetical order.

    Row-wise once the (at most ``max_features``) terms are known.
    """
    chosen = _chosen_terms(df if fit is None else fit, text, max_features, stop_words)
    if not chosen:
        raise ValueError("no term left to build vectors from")
    return _vectors(df, key, text, stop_words, chosen, out)
