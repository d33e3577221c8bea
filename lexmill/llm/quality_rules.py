"""Quality rules with cross-document line frequency, in native Spark operations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.patterns import add_once
from lexmill.llm.words import BLANK, ROW, column, let, whole_rows, words
from lexmill.operators.scratch import materialized

WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 8


@dataclass(frozen=True)
class Limits:
    """Limits of the registered query; shares are (part, whole)."""

    min_words: int = 20
    repeat_share: tuple[int, int] = (30, 100)
    #: A line is boilerplate of a host if more than this share of its distinct documents has it, and at least so many.
    line_share: tuple[int, int] = (5, 100)
    line_documents: int = 20
    #: So many distinct documents are enough on any host, however small their share; none by default.
    line_documents_enough: int | None = None
    #: A document is depleted if boilerplate lines hold more than this share of its words, or leave under ``min_words``.
    depleted_share: tuple[int, int] = (50, 100)


def _filled_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))


def _repeated_words(w: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the text."""

    def starts(h: Column) -> Column:
        """Numbers of the windows that have an equal one, in order: equal hashes are neighbours once sorted."""
        ranked = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def doubled(s: Column) -> Column:
            same = lambda e, j: F.coalesce(F.get(s, j)["h"] == e["h"], F.lit(False))
            return F.filter(s, lambda e, j: same(e, j - 1) | same(e, j + 1))

        return F.array_sort(F.transform(let(ranked, doubled), lambda e: e["i"]))

    def covered(h: Column) -> Column:
        step = lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).cast("long").alias("n"))
        zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
        # Most texts repeat nothing, which a hash set tells without sorting.
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            F.aggregate(starts(h), zero, step, lambda acc: acc["n"]))

    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
    return F.when(F.size(w) < 2 * WINDOW - WINDOW + 1, F.lit(0).cast("long")).otherwise(let(hashes, covered))


def text_measures(text: Column | str, limits: Limits = Limits()) -> Column:
    """struct(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed) of the whole text."""
    t = F.coalesce(column(text), F.lit(""))
    lines = _filled_lines(t)
    part, whole = limits.repeat_share

    def judged(m: Column) -> Column:
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        failed = (m["n_words"] < limits.min_words) | (whole * m["n_repeat_words"] > part * m["n_words"])
        return F.struct(*[m[n].alias(n) for n in names], failed.alias("base_failed"))

    measured = let(words(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _repeated_words(w).alias("n_repeat_words"),
        F.length(F.regexp_replace(t, BLANK + "+", "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return let(measured, judged)


def _row_key(host: Column, key: Column, text: Column) -> list[Column]:
    """Identity of a row by its content, in 128 bits; equal rows share it."""
    return [F.xxhash64(host, key, text).alias("_k1"), F.xxhash64(text, F.lit(1), key, host).alias("_k2")]


def _line_entries(docs: DataFrame, key: str, host: str, text: str) -> DataFrame:
    """A row per filled line: host, document identity, text identity, place, hash of the normalised line, words."""
    t = F.coalesce(F.col(text), F.lit(""))
    normal = lambda x: F.xxhash64(F.lower(F.btrim(F.regexp_replace(x, BLANK + "+", " "))))
    entries = F.transform(F.split(t, "\n"), lambda x, i: F.struct(
        i.alias("at"), normal(x).alias("line"), F.regexp_count(x, F.lit(WORD + "+")).alias("n")))
    return docs.select(
        F.col(host).alias("_host"), *_row_key(F.col(host), F.col(key), F.col(text)),
        F.xxhash64(t).alias("_text"), F.inline(F.filter(entries, lambda e: e["n"] > 0)))


def frequent_lines(docs: DataFrame, host: str, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """(host, line, documents): normalised lines in more distinct documents of a host than the limits allow.

    Copies of one text are one document, so a copied page does not turn its own lines
    into boilerplate.
    """
    entries = _line_entries(docs, text, host, text).select("_host", "line", "_text")
    counts = entries.groupBy("_host", "line").agg(F.count_distinct("_text").alias("documents"))
    counts = counts.where(F.col("documents") >= limits.line_documents)
    texts = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    sizes = docs.groupBy(F.col(host).alias("_in")).agg(F.count_distinct(texts).alias("_all"))
    part, whole = limits.line_share
    often = whole * F.col("documents") > part * F.col("_all")
    if limits.line_documents_enough is not None:
        often = often | (F.col("documents") >= limits.line_documents_enough)
    return counts.join(sizes, F.col("_host").eqNullSafe(F.col("_in"))).where(often).select("_host", "line", "documents")


def boilerplate(docs: DataFrame, key: str, host: str, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """(_k1, _k2, places, n_removed): frequent lines of each document that has some, and the words in them."""
    frequent = frequent_lines(docs, host, text, limits).select(F.col("_host").alias("_in"), F.col("line").alias("_line"))
    hits = _line_entries(docs, key, host, text).join(
        frequent, (F.col("line") == F.col("_line")) & F.col("_host").eqNullSafe(F.col("_in")))
    # A set, since equal rows bring the same places twice.
    places = hits.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("at", "n")).alias("places"))
    removed = F.aggregate("places", F.lit(0).cast("long"), lambda s, p: s + p["n"])
    return places.select("_k1", "_k2", "places", removed.alias("n_removed"))


def _depleted(n_words: Column, n_removed: Column, limits: Limits) -> Column:
    part, whole = limits.depleted_share
    return (n_removed > 0) & ((whole * n_removed > part * n_words) | (n_words - n_removed < limits.min_words))


def quality_verdicts(
    docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text", limits: Limits = Limits(),
) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed, kept) per row.

    A row fails with fewer than ``min_words`` words, with too many words in repeated
    windows, or if it is depleted: lines that too many distinct documents of its host
    share are removed, and what is left is too little.

    Null and blank texts have no words and fail; a null host is a host of its own; a
    null key and repeated rows are judged like any other; an empty table gives no rows.
    Other columns are ignored.  Texts are never moved: hashes of lines are counted per
    host, combined before the shuffle, and the few frequent ones are joined back.
    """
    measures = docs.select(
        F.col(key).alias("_key"), *_row_key(F.col(host), F.col(key), F.col(text)), text_measures(text, limits).alias("m"))
    rows = measures.select("_key", "_k1", "_k2", "m.*")
    lost = boilerplate(docs, key, host, text, limits).select("_k1", "_k2", "n_removed")
    joined = rows.join(lost, ["_k1", "_k2"], "left").withColumn("n_removed", F.coalesce("n_removed", F.lit(0).cast("long")))
    kept = ~F.col("base_failed") & ~_depleted(F.col("n_words"), F.col("n_removed"), limits)
    return joined.select(
        F.col("_key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "n_removed", kept.alias("kept"))


def keep_good(
    docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text", limits: Limits = Limits(),
    remove_lines: bool = False,
) -> DataFrame:
    """The documents that pass, columns as they are; with ``remove_lines`` without their boilerplate lines.

    Judged as in ``quality_verdicts``: null, empty and blank texts fail, whole texts are
    read, repeated rows and null keys or hosts are judged like any other, an empty table gives
    no rows, and other columns may have any names.
    """
    identity = _row_key(F.col(host), F.col(key), F.col(text))
    names = ["_k1", "_k2"]
    # A predicate on an ordinary column would be pushed down by copying its whole expression.
    measured = add_once(whole_rows(docs, *identity), {"_m": text_measures(F.col(ROW)[text], limits)})
    passing = measured.where(~F.col("_m.base_failed")).select(ROW, *names, F.col("_m.n_words").alias("_n"))
    lost = boilerplate(docs, key, host, text, limits)
    if not remove_lines:
        counts = docs.select(*identity, F.size(words(text)).cast("long").alias("_n")).join(lost, names)
        # Written first: their size is then known, and if it is small the texts need not move to meet them.
        depleted = materialized(counts.where(_depleted(F.col("_n"), F.col("n_removed"), limits)).select(*names).distinct())
        return passing.join(depleted, names, "left_anti").select(f"{ROW}.*")
    joined = passing.join(lost, names, "left").where(
        F.col("n_removed").isNull() | ~_depleted(F.col("_n"), F.col("n_removed"), limits))
    gone = F.map_from_arrays(F.transform("places", lambda p: p["at"]), F.transform("places", lambda p: F.lit(True)))
    body = F.col(ROW)[text]
    left = F.array_join(F.filter(F.split(body, "\n"), lambda x, i: ~F.map_contains_key(gone, i)), "\n")
    cleaned = F.when(F.col("places").isNull(), body).otherwise(left)
    return joined.select(F.col(ROW).withField(text, cleaned).alias(ROW)).select(f"{ROW}.*")
