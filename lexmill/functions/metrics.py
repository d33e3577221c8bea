"""Readability metrics and the sampled noise analysis (row-wise)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import lexicon as lx
from lexmill.functions import patterns as rx
from lexmill.functions import tokens
from lexmill.functions.cleaning import clean_text
from lexmill.functions.stopwords import STOP_WORDS

TEXT_METRICS = [
    "length", "avg_word_length", "avg_sentence_length", "vocab_richness", "readability", "stopword_ratio",
]
NOISE_METRICS = [
    "text_length", "sample_length", "has_html", "html_ratio", "noise_ratio", "sentence_count",
    "avg_sentence_length", "regular_reduction", "deep_reduction", "additional_reduction",
]


def syllables(words: Column) -> Column:
    """Vowel groups per word, at least one each, summed over the words."""
    return tokens.array_sum(
        F.transform(words, lambda w: F.greatest(F.lit(1), F.regexp_count(w, F.lit("[aeiouy]+"))))
    )


def text_metrics(text: Column | str, language: Column | str) -> Column:
    """Struct of length, word and sentence shape, readability and stop-word share.

    English readability is the Flesch reading ease with vowel groups as
    syllables; other languages use a formula without syllables.  Blank texts
    get zeros.
    """
    zeros = F.struct(*[F.lit(0 if m == "length" else 0.0).alias(m) for m in TEXT_METRICS])

    def stats(s: Column) -> Column:
        w, n, sentences, lang = s["w"], F.size(s["w"]), s["sentences"], s["lang"]
        per_word = lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0))
        stop_count = None
        for code, name in lx.STOP_WORD_LANGUAGES.items():
            hits = rx.count_members(w, STOP_WORDS[name])
            stop_count = F.when(lang == code, hits) if stop_count is None else stop_count.when(lang == code, hits)
        flesch = F.when(
            n > 0, 206.835 - 1.015 * (n / F.greatest(F.lit(1), sentences)) - 84.6 * (syllables(w) / n),
        ).otherwise(F.lit(0.0))
        shape = {
            "word": per_word(F.length(F.array_join(w, ""))),
            # Every word lies in exactly one sentence, so their counts add up to all words.
            "sentence": F.when(sentences > 0, n / sentences).otherwise(F.lit(0.0)),
        }
        return rx.bind(shape, lambda a: F.struct(
            F.length(s["t"]).alias("length"),
            a["word"].alias("avg_word_length"),
            a["sentence"].alias("avg_sentence_length"),
            per_word(F.size(F.array_distinct(w))).alias("vocab_richness"),
            F.when(lang == "en", flesch).otherwise(
                100 - F.least(F.lit(100.0), 4.71 * a["word"] + 0.5 * a["sentence"])).alias("readability"),
            per_word(F.coalesce(stop_count, F.lit(0))).alias("stopword_ratio"),
        ))

    def start(s: Column) -> Column:
        values = {
            "t": s["t"], "lang": s["lang"], "w": tokens.words(F.lower(s["t"])),
            "sentences": F.size(F.filter(F.split(s["t"], "[.!?]+"), lambda x: rx.strip(x) != "")),
        }
        return F.when(rx.strip(s["t"]) != "", rx.bind(values, stats)).otherwise(zeros)

    return rx.bind({"t": rx.as_col(text), "lang": rx.as_col(language)}, start)


def with_text_metrics(df: DataFrame, text: str = "text", language: Column | str = "language") -> DataFrame:
    """Add the text metrics, evaluated once per row."""
    made = rx.add_once(df, {"_metrics": text_metrics(text, language)})
    kept = [c for c in df.columns if c not in TEXT_METRICS]
    return made.select(*[F.col(f"`{c}`") for c in kept], "_metrics.*")


def noise_sample(text: Column | str) -> Column:
    """The text, or its head, middle and tail if it has over 10,000 characters."""
    t = rx.as_col(text)
    n = F.length(t)
    middle = F.substring(t, F.floor(n / 2).cast("int") - 1666 + 1, F.lit(3333))
    return F.when(n <= 10_000, t).otherwise(F.concat(F.substring(t, 1, 3333), middle, F.right(t, F.lit(3334))))


def big_text_sample(text: Column | str, small: int = 500_000, head: int = 100_000, window: int = 50_000) -> Column:
    """The first ``head`` characters of a text below ``small``, else three windows.

    The windows start at the beginning, the middle and near the end; the later
    two skip to the next line.
    """
    t = rx.as_col(text)
    n = F.length(t)
    size = F.least(F.lit(window), F.floor(n / 20).cast("int"))

    def from_next_line(start: Column) -> Column:
        tail = F.substring(t, start + 1, n)
        return rx.let(
            F.struct(tail.alias("tail"), F.instr(tail, "\n").alias("at")),
            lambda x: F.when(x["at"] > 0, F.substring(x["tail"], x["at"] + 1, size)).otherwise(F.lit("")),
        )

    middle = F.floor(n / 2).cast("int") - F.floor(size / 2).cast("int")
    windows = F.concat(
        F.substring(t, F.lit(1), size), from_next_line(middle), from_next_line(F.greatest(F.lit(0), n - size)))
    return F.when(n < small, F.substring(t, 1, head)).otherwise(windows)


def noise_analysis(
    text: Column | str, full: bool = False, mode: str = "document", sampled: bool = False,
    cleaned: tuple[Column | str, Column | str] | None = None,
) -> Column:
    """Struct of markup and noise ratios, sentence shape and expected cleaning effect.

    The quick form estimates the reductions from the ratios; the full form
    cleans the text both ways, unless ``cleaned`` has the results (basic, deep) already.  With ``sampled`` a long text is judged by its
    ``noise_sample``, of which the first 1000 characters are searched for tags and
    the first 2000 for symbols and by cleaning.
    """
    count_of = lambda s, ch: F.length(s) - F.length(F.replace(s, F.lit(ch), F.lit("")))

    def html_ratio(sample: Column, n: Column) -> Column:
        opened = count_of(sample, "<")

        def ratio(h: Column) -> Column:
            tags = F.when(h["tags"] > 0, F.floor(opened * (h["tags"] / h["opened"]))).otherwise(opened)
            return tags / n

        head = F.substring(sample, 1, 1000) if sampled else sample
        marked = sample.contains("<") & sample.contains(">")
        return F.when(marked, rx.bind(
            {"tags": rx.count_matches(head, r"<[^>]+>"), "opened": count_of(head, "<")}, ratio)).otherwise(F.lit(0.0))

    if cleaned is not None and sampled:
        raise ValueError("cleaned texts are whole ones, so they fit no sample")

    def reduced(head: Column, deep: bool) -> Column:
        result = clean_text(head, deep, mode) if cleaned is None else rx.as_col(cleaned[deep])
        return F.when(F.length(head) > 0, (1 - F.length(result) / F.length(head)) * 100).otherwise(F.lit(0.0))

    def reductions(s: Column) -> Column:
        if full:
            regular, deep = reduced(s["head"], False), (lambda r: reduced(s["head"], True))
        else:
            regular = F.least(F.lit(80.0), s["html"] * 100 + s["noise"] * 50)
            deep = lambda r: F.least(F.lit(90.0), r * 1.3)
        return rx.let(regular, lambda r: rx.let(deep(r), lambda d: F.struct(
            F.length(s["t"]).alias("text_length"),
            F.length(s["sample"]).alias("sample_length"),
            (s["sample"].contains("<") & s["sample"].contains(">")).alias("has_html"),
            s["html"].alias("html_ratio"),
            s["noise"].alias("noise_ratio"),
            s["sentences"].alias("sentence_count"),
            (rx.count_matches(s["sample"], r"\S+") / s["sentences"]).alias("avg_sentence_length"),
            r.alias("regular_reduction"),
            d.alias("deep_reduction"),
            (d - r).alias("additional_reduction"),
        )))

    def measure(s: Column) -> Column:
        n = F.length(s["sample"])
        head = F.substring(s["sample"], 1, 2000) if sampled else s["sample"]
        symbols = rx.count_symbols(head)
        return rx.bind({
            "t": s["t"], "sample": s["sample"], "head": head,
            "html": html_ratio(s["sample"], n),
            "noise": F.when(n > 0, symbols / (F.least(F.lit(2000), n) if sampled else n)).otherwise(F.lit(0.0)),
            "sentences": F.greatest(F.lit(1), rx.count_matches(s["sample"], r"[.!?]")),
        }, reductions)

    t = rx.as_col(text)
    # Null texts have no analysis.
    return rx.let(t, lambda x: F.when(x.isNotNull(), rx.bind({"t": x, "sample": noise_sample(x) if sampled else x}, measure)))


def with_noise_analysis(
    df: DataFrame, text: str = "text", full: bool = False, mode: str = "document", sampled: bool = False,
) -> DataFrame:
    """Add the noise analysis columns, evaluated once per row."""
    made = rx.add_once(df, {"_noise": noise_analysis(text, full, mode, sampled)})
    kept = [c for c in df.columns if c not in NOISE_METRICS]
    return made.select(*[F.col(f"`{c}`") for c in kept], "_noise.*")


def sentence_length_score(avg: Column | str) -> Column:
    a = rx.as_col(avg)
    return F.when(a < 50, F.least(F.lit(1.0), a / 20)).otherwise(1.0 - F.least(F.lit(1.0), (a - 50) / 100))


def composite_score(analysis: Column | None = None) -> Column:
    """Weighted score of a noise analysis, in [0, 1]; 0 without an analysis.

    ``analysis`` is the struct; without it the analysis columns are read.
    """
    value = F.col if analysis is None else (lambda name: analysis[name])
    one = F.lit(1.0)
    terms = {
        "text_length": F.least(one, value("text_length") / 10_000),
        "regular_reduction": F.least(one, value("regular_reduction") / 100),
        "deep_reduction": F.least(one, value("deep_reduction") / 100),
        "sentence_length": sentence_length_score(value("avg_sentence_length")),
        "html_cleanliness": 1.0 - F.least(one, value("html_ratio")),
        "noise_level": 1.0 - F.least(one, value("noise_ratio") * 10),
    }
    score = rx.total([terms[k] * w for k, w in lx.COMPOSITE_WEIGHTS.items()]) / sum(lx.COMPOSITE_WEIGHTS.values())
    return F.when(value("text_length").isNotNull(), score).otherwise(F.lit(0.0))


def needs_deep_cleaning(analysis: Column | None = None) -> Column:
    """False if regular cleaning already removes much and deep cleaning adds little."""
    value = F.col if analysis is None else (lambda name: analysis[name])
    enough = (value("deep_reduction") - value("regular_reduction") < 10) & (value("regular_reduction") > 30)
    return F.coalesce(~enough, F.lit(True))
