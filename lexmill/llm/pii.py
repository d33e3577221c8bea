"""Personal data: seed patterns and bootstrapped contexts, in native Spark operations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.spans import BEFORE, SPAN, joined, label, match_spans, no_spans, redact, running_starts
from lexmill.llm.words import column, let, words
from lexmill.operators.scratch import materialized

#: Seed patterns, written so that no text makes them slow: a run is entered at its start only.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"
#: Words with a digit: what contexts may reveal.
CANDIDATE = r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D0-9]*+[0-9])[^\x20\x09-\x0D]++"
LAST_WORD = r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$"
#: A blank and a whole word at the end of what stands before a match, and what separates identifiers of a list.
WHOLE_WORD = r"[\x20\x09-\x0D][^\x20\x09-\x0D]++[\x20\x09-\x0D]*+$"
SEPARATOR = r"[\x20\x09-\x0D,;/|&()\[\]]+$"
#: Punctuation around a word that is not part of it.
OPENING, CLOSING = r"^[(\[{<\"']+", r"[,;:.!?)\]}>\"']+$"
KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"
_LABELLED = "array<struct<start:int,nth:int,stop:int,kind:string>>"


@dataclass(frozen=True)
class Bootstrap:
    """How contexts earn trust; the values of the registered query."""

    rounds: int = 3
    #: Share of all uses of a context word that must precede trusted identifiers.
    confidence: float = 0.5
    #: Different trusted identifiers that a context must precede.
    support: int = 3
    #: Digits that an unseen identifier must have.
    digits: int = 5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    places = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substring(back, i, F.lit(1)).cast("int") * (2 - i % 2))
    return F.aggregate(places, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _card(value: Column) -> Column:
    return let(_digits(value), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(F.lit(False)))


def _with_words_before(spans: Column) -> Column:
    """All matches of a pattern in a text, ``before`` being its last BEFORE characters, earlier matches included.

    A gap that has no whole word is filled up from the matches before it; each has a
    character at least, so that BEFORE of them are enough.
    """

    def filled(x: Column) -> Column:
        ends = F.transform(x, lambda s: F.right(F.concat(s["before"], s["value"]), F.lit(BEFORE)))
        return let(ends, lambda e: F.transform(x, lambda s, i: F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value"),
            F.when((i == 0) | (F.length(s["before"]) >= BEFORE) | s["before"].rlike(WHOLE_WORD), s["before"]).otherwise(F.right(
                F.concat(F.array_join(F.slice(e, F.greatest(i - BEFORE + 1, F.lit(1)), F.least(i, F.lit(BEFORE))), ""), s["before"]),
                F.lit(BEFORE))).alias("before"))))

    return let(spans, filled)


def seed_spans(text: Column) -> list[Column]:
    """Spans of the four kinds in a text that is not null; failing matches are dropped."""
    checks = (
        (EMAIL, F.contains(text, F.lit("@")), None),
        (IP, text.rlike(r"[0-9]\.[0-9]"), lambda s: s["value"].rlike(IP_PARTS)),
        (CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), lambda s: _card(s["value"])),
        (PHONE, text.rlike(r"\+[0-9]"), lambda s: F.length(_digits(s["value"])).between(8, 15)),
    )
    found = []
    for pattern, guard, good in checks:
        spans = _with_words_before(match_spans(text, pattern))
        found.append(F.when(guard, F.filter(spans, good) if good else spans).otherwise(no_spans().cast(SPAN)))
    return found


def _shape(word: Column) -> Column:
    """A context word without regard to case and digits."""
    return F.regexp_replace(F.lower(word), "[0-9]", "0")


def _context(span: Column) -> Column:
    return _shape(F.regexp_extract(span["before"], LAST_WORD, 1))


def _trimmed(span: Column) -> Column:
    """The span without the punctuation around its word."""
    lead = F.length(F.regexp_extract(span["value"], OPENING, 0))
    inner = F.regexp_replace(F.regexp_replace(span["value"], OPENING, ""), CLOSING, "")
    return F.struct(
        (span["start"] + lead).alias("start"), (span["start"] + lead + F.length(inner)).alias("stop"), inner.alias("value"),
        span["before"].alias("before"))


def _alike(a: Column, b: Column) -> Column:
    """Whether ``b`` can continue a list with ``a``: digits at the same places, or behind a seed as many, and not in one run."""
    like_seed = a["seed"] & (F.length(_digits(a["instance"])) == F.length(_digits(b["instance"]))) & b["instance"].rlike("[0-9][^0-9]+[0-9]")
    return (_shape(a["instance"]) == _shape(b["instance"])) | like_seed


def _uses(seeds: Column, candidates: Column) -> Column:
    """Uses of contexts; an identifier that follows another one of its shape in a list has the context of the first."""
    use = lambda seed: lambda s: F.struct(
        s["stop"].alias("stop"), s["start"].alias("start"), _context(s).alias("pattern"), F.lower(s["value"]).alias("instance"),
        F.lit(seed).alias("seed"), (s["start"] - F.length(F.regexp_extract(s["before"], SEPARATOR, 0))).alias("apart"))

    def inherited(x: Column) -> Column:
        follows = lambda s, i: (i > 0) & F.coalesce(
            F.get(x, i - 1)["stop"].between(s["apart"], s["start"]) & _alike(F.get(x, i - 1), s), F.lit(False))
        first = F.transform(x, lambda s, i: F.when(follows(s, i), 0).otherwise(1))

        def named(f: Column) -> Column:
            leaders = F.transform(F.filter(x, lambda s, i: F.get(f, i) == 1), lambda s: s["pattern"])
            return let(leaders, lambda p: let(running_starts(f), lambda r: F.transform(x, lambda s, i: F.struct(
                F.get(p, F.get(r, i) + F.get(f, i) - 1).alias("pattern"), s["instance"].alias("instance"), s["seed"].alias("seed"),
                (F.get(f, i) == 1).alias("direct"), s["start"].alias("start"), s["stop"].alias("stop")))))

        return let(first, named)

    return let(F.array_sort(F.concat(F.transform(seeds, use(True)), F.transform(candidates, use(False)))), inherited)


def _observe(docs: DataFrame, key: str, text: str, settings: Bootstrap) -> DataFrame:
    """Per row: seed spans by kind and the uses of contexts, written once without the texts."""
    body = F.coalesce(F.col(text), F.lit(""))
    identity = [F.xxhash64(F.col(key), F.col(text)).alias("_k1"), F.xxhash64(F.col(text), F.lit(1), F.col(key)).alias("_k2")]
    seeds = docs.select(F.col(key).alias("_key"), *identity, body.alias("_t"), F.array(*seed_spans(body)).alias("_kinds"))

    def unseen(all_seeds: Column) -> Column:
        """Identifier-like words that no seed overlaps."""
        tokens = F.when(F.col("_t").rlike("[0-9]"), _with_words_before(match_spans(F.col("_t"), CANDIDATE))).otherwise(no_spans().cast(SPAN))
        long_enough = F.transform(F.filter(tokens, lambda s: F.length(_digits(s["value"])) >= settings.digits), _trimmed)
        return F.filter(long_enough, lambda s: ~F.exists(
            all_seeds, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))

    uses = let(F.flatten("_kinds"), lambda s: _uses(s, unseen(s)))
    base = F.concat(*[label(F.col("_kinds")[n], kind, n) for n, kind in enumerate(KINDS)])
    return materialized(seeds.select("_key", "_k1", "_k2", base.alias("base"), uses.alias("uses")))


def _word_uses(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(pattern, uses): how often each wanted context word stands anywhere in the corpus."""
    counts = docs.select(F.explode(words(text)).alias("word")).groupBy("word").count()
    shaped = counts.groupBy(_shape(F.right("word", F.lit(64))).alias("pattern")).agg(F.sum("count").alias("uses"))
    return shaped.join(wanted, "pattern")


def trusted_contexts(observed: DataFrame, docs: DataFrame, text: str, settings: Bootstrap = Bootstrap()) -> DataFrame:
    """(pattern, confidence): contexts that mostly precede identifiers.

    Patterns and instances form a graph.  Seed instances are trusted.  A pattern's
    confidence is the share of all uses of its word that precede trusted instances;
    if it is high enough, with enough different instances, it makes its other
    instances trusted in the next round.
    """
    occurrences = observed.select(F.inline("uses")).where("pattern <> ''")
    edges = materialized(occurrences.groupBy("pattern", "instance").agg(
        F.count_if("direct").alias("n"), F.max("seed").alias("seed")))
    own = edges.groupBy("pattern").agg(F.sum("n").alias("own"), F.count_if(F.col("n") > 0).alias("instances"))
    promising = own.where(F.col("instances") >= settings.support)
    totals = _word_uses(docs, text, promising.select("pattern"))
    patterns = materialized(promising.join(totals, "pattern", "left").select(
        "pattern", F.greatest("own", F.coalesce("uses", F.lit(0))).alias("uses")))
    live = materialized(edges.join(patterns, "pattern"))
    trusted = live.where("seed").select("instance").distinct()
    for _ in range(settings.rounds):
        scores = live.join(trusted, "instance").groupBy("pattern").agg(
            (F.sum("n") / F.first("uses")).alias("confidence"), F.count_if(F.col("n") > 0).alias("support"))
        good = materialized(scores.where(
            (F.col("confidence") >= settings.confidence) & (F.col("support") >= settings.support)).select("pattern", "confidence"))
        trusted = live.where("seed").select("instance").union(live.join(good, "pattern").select("instance")).distinct()
    return good


def find_personal_data(
    docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Bootstrap = Bootstrap(),
) -> DataFrame:
    """(key, base, spans) per row: arrays of struct(start, nth, stop, kind) in code points, the end exclusive.

    ``base``: e-mail and IP addresses, card and phone numbers by pattern, by kind and
    start.  ``spans`` adds words of kind ``context``: identifiers that no pattern
    covers but that stand behind a context word which elsewhere precedes the others, or go on
    a list of identifiers of their shape; punctuation around them is not part of them.

    Null and empty texts have no spans; a null key is kept; repeated rows get the same
    spans; an empty table gives no rows; other columns are ignored.
    """
    named = docs.select(F.col(key).alias("_id"), F.col(text).alias("_body"))
    observed = _observe(named, "_id", "_body", settings)
    good = trusted_contexts(observed, named, "_body", settings)
    hits = observed.select("_k1", "_k2", F.inline("uses")).where("not seed").join(good.select("pattern"), "pattern")
    # A set, since equal rows bring the same places twice.
    added = hits.groupBy("_k1", "_k2").agg(F.array_sort(F.collect_set(F.struct(
        F.col("start"), F.lit(len(KINDS)).alias("nth"), F.col("stop"), F.lit(CONTEXT).alias("kind")))).alias("added"))
    both = F.concat("base", F.coalesce("added", F.array().cast(_LABELLED)))
    return observed.join(added, ["_k1", "_k2"], "left").select(F.col("_key").alias(key), "base", both.alias("spans"))


def pii_digests(base: Column | str, spans: Column | str) -> list[Column]:
    """n_<kind>, base_sha256 and spans."""
    found = column(base)
    return [*[_count(found, n).alias(f"n_{k}") for n, k in enumerate(KINDS)],
            F.sha2(joined(found), 256).alias("base_sha256"), joined(column(spans)).alias("spans")]


def _count(spans: Column, nth: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["nth"] == nth)).cast("long")


def redact_personal_data(text: Column | str, spans: Column | str) -> Column:
    """The text with each span replaced by ``[kind]``."""
    return redact(column(text), column(spans), lambda kind: F.concat(F.lit("["), kind, F.lit("]")))
