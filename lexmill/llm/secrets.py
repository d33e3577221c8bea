"""Secret scan over a trigram inverted index, in native Spark operations."""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.spans import SPAN, joined, label, match_spans, no_spans, redact
from lexmill.llm.words import ROW, column, whole_rows
from lexmill.operators.scratch import materialized

#: Alternatives that a query may have, strings that a set may hold and trigrams of one alternative; more are
#: given up, which makes the query weaker but never wrong.
MAX_ALTERNATIVES, MAX_STRINGS, MAX_TRIGRAMS = 64, 64, 60


@dataclass(frozen=True)
class SecretRule:
    """``group`` holds the secret, of ``min_length`` characters or more; ``base`` rules are the contract's."""

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 1
    base: bool = True


#: Rules of the registered query: fixed patterns.
PRODUCTION_RULES = (
    SecretRule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    SecretRule("hex", r"[0-9a-f]+", 0, 24),
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40, base=False),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15, base=False),
)

Query = list[frozenset[str]] | None
"""Alternatives of trigrams that must all occur; None: nothing is known."""


def _trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _of_strings(strings: Iterable[str]) -> Query:
    alternatives = [_trigrams(s) for s in strings]
    return None if any(not a for a in alternatives) else _reduced(alternatives)


def _reduced(alternatives: Iterable[frozenset[str]]) -> Query:
    kept: list[frozenset[str]] = []
    for a in sorted(set(alternatives), key=lambda a: (len(a), sorted(a))):
        if not any(k <= a for k in kept):
            kept.append(a)
    return kept


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    combined = _reduced(x | y for x, y in product(a, b))
    return combined if len(combined) <= MAX_ALTERNATIVES else min(a, b, key=len)


def _either(queries: Sequence[Query]) -> Query:
    if any(q is None for q in queries):
        return None
    combined = _reduced(x for q in queries for x in q)
    return combined if len(combined) <= MAX_ALTERNATIVES else None


def trigram_query(pattern: str) -> Query:
    """What every match must contain, in lower case: alternatives of trigram sets, or None if nothing is mandatory.

    Walks the syntax tree: strings that a part can be exactly are multiplied out along
    a sequence; a part with other matches ends them and their trigrams become mandatory.
    """
    from re import _parser as parser  # the syntax tree of the standard library

    def classes(items) -> set[str] | None:
        found: set[str] = set()
        for op, value in items:
            if str(op) == "LITERAL":
                found.add(chr(value).lower())
            elif str(op) == "RANGE" and value[1] - value[0] < MAX_STRINGS:
                found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return found if len(found) <= MAX_STRINGS else None

    def sequence(tree) -> tuple[set[str] | None, Query]:
        """Exact strings of the whole if they are known, and the query of what was given up."""
        exact: set[str] | None = {""}
        whole, query = True, None
        for op, value in tree:
            part, mandatory = node(str(op), value)
            query = _both(query, mandatory)
            if part is not None and exact is not None and len(exact) * len(part) <= MAX_STRINGS:
                exact = {a + b for a, b in product(exact, part)}
                continue
            query = _both(query, _of_strings(exact))
            whole, exact = False, part if part is not None else {""}
        if whole:
            return exact, query
        return None, _both(query, _of_strings(exact))

    def node(op: str, value) -> tuple[set[str] | None, Query]:
        if op == "LITERAL":
            return {chr(value).lower()}, None
        if op == "IN":
            return classes(value), None
        if op == "SUBPATTERN":
            return sequence(value[3])
        if op == "BRANCH":
            parts = [sequence(t) for t in value[1]]
            if all(p[0] is not None and p[1] is None for p in parts) and len(set().union(*[p[0] for p in parts])) <= MAX_STRINGS:
                return set().union(*[p[0] for p in parts]), None
            return None, _either([_both(q, _of_strings(e) if e is not None else None) for e, q in parts])
        if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, tree = value
            exact, query = sequence(tree)
            if (low, high) == (0, 1) and exact is not None and query is None:
                return exact | {""}, None
            if low == 0:
                return None, None
            return None, _both(query, _of_strings(exact) if exact is not None else None)
        if op == "AT":
            return {""}, None
        return None, None

    exact, query = sequence(parser.parse(pattern))
    found = _both(query, _of_strings(exact) if exact is not None else None)
    return None if found is None else [frozenset(sorted(a)[:MAX_TRIGRAMS]) for a in found]


def _lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def candidates(docs: DataFrame, text: str, rules: Sequence[SecretRule]) -> DataFrame:
    """(_text_key, _rules): texts that may match, with a bit for each rule, from the postings of the rules' trigrams.

    The index posts those trigrams that some rule needs.  Postings meet the queries by
    trigram and are intersected per text and alternative; equal texts are one.
    """
    queries = [(n, q) for n, q in enumerate(trigram_query(r.pattern) for r in rules) if q is not None]
    needs = [
        (g, 1 << n, a, 1 << bit, (1 << len(grams)) - 1)
        for n, q in queries for a, grams in enumerate(q) for bit, g in enumerate(sorted(grams))]
    spark = docs.sparkSession
    schema = "trigram string, rule_bit long, alternative int, bit long, need long"
    grams = sorted({x[0] for x in needs})
    posted = F.filter(F.array(*[F.lit(g) for g in grams]), lambda g: F.contains(F.col("_lower"), g))
    texts = docs.select(F.xxhash64(text).alias("_text_key"), _lowered(F.col(text)).alias("_lower"))
    postings = texts.select("_text_key", F.explode(posted).alias("trigram"))
    # As many rows as the rules have trigrams: a fixed table.
    plan = F.broadcast(spark.createDataFrame(needs, schema))
    met = postings.join(plan, "trigram").groupBy("_text_key", "rule_bit", "alternative", "need").agg(F.bit_or("bit").alias("met"))
    hits = met.where("met = need").groupBy("_text_key")
    return hits.agg(F.bit_or("rule_bit").alias("_rules"))


def _rule_spans(text: Column, rule: SecretRule) -> Column:
    found = match_spans(text, rule.pattern, rule.group or None)
    return F.filter(found, lambda s: F.length(s["value"]) >= rule.min_length)


def _scan_pattern(rule: SecretRule) -> str:
    """A quick test for a match that is long enough, for rules that read everything."""
    return rule.pattern.removesuffix("+") + f"{{{rule.min_length},}}" if re.fullmatch(r"\[[^\]]*\]\+", rule.pattern) else rule.pattern


def find_secrets(
    docs: DataFrame, text: str = "text", rules: Sequence[SecretRule] = PRODUCTION_RULES, out: str = "secrets",
) -> DataFrame:
    """Add the array ``out`` of struct(start, nth, stop, kind), sorted by start and rule.

    Places are code points, the end exclusive.  Each rule's matches are leftmost and do
    not overlap; those whose secret is too short are dropped.  A rule with mandatory
    trigrams verifies only the texts that the index names; a rule without reads all.

    Null and empty texts have no secrets; repeated rows get the same; an empty table
    gives no rows; other columns stay, an existing column ``out`` is replaced.
    """
    if len(rules) > 60:
        raise ValueError("at most 60 rules")
    named = whole_rows(docs.drop(out), F.xxhash64(text).alias("_text_key"))
    # Written first: their size is then known, and if it is small the texts need not move to meet them.
    listed = materialized(candidates(docs, text, rules))
    joined_docs = named.join(listed, "_text_key", "left")
    body = F.coalesce(F.col(ROW)[text], F.lit(""))
    parts = []
    for n, rule in enumerate(rules):
        if trigram_query(rule.pattern) is None:
            chosen = body.rlike(_scan_pattern(rule))
        else:
            chosen = F.coalesce(F.col("_rules"), F.lit(0)).bitwiseAND(F.lit(1 << n)) != 0
        parts.append(label(F.when(chosen, _rule_spans(body, rule)).otherwise(no_spans().cast(SPAN)), rule.kind, n))
    return joined_docs.select(ROW, F.array_sort(F.concat(*parts)).alias(out)).select(f"{ROW}.*", out)


def secret_digests(spans: Column | str, rules: Sequence[SecretRule] = PRODUCTION_RULES) -> list[Column]:
    """n_<kind> of the base rules, base_sha256 and spans."""
    found = column(spans)
    base = [n for n, r in enumerate(rules) if r.base]
    counts = [_count(found, n).alias(f"n_{rules[n].kind}") for n in base]
    in_base = F.filter(found, lambda s: s["nth"].isin(base))
    return [*counts, F.sha2(joined(in_base), 256).alias("base_sha256"), joined(found).alias("spans")]


def _count(spans: Column, nth: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["nth"] == nth)).cast("long")


def redact_secrets(
    docs: DataFrame, text: str = "text", rules: Sequence[SecretRule] = PRODUCTION_RULES, length: str | None = None,
) -> DataFrame:
    """The documents with every secret replaced by ``[kind]``; columns stay as they are, whatever their names.

    A column ``length`` is set anew where the text changed.  Null and empty texts stay as
    they are, texts of any length are read whole, repeated rows are treated alike, null keys are no
    different and an empty table gives no rows.  Of secrets that overlap the first by start and rule is replaced.
    """
    name = "_secrets"
    while name in docs.columns:
        name += "_"
    found = find_secrets(docs, text, rules, name)
    body = F.col(f"`{text}`")
    done = found.withColumn(text, redact(body, F.col(name), lambda kind: F.concat(F.lit("["), kind, F.lit("]"))))
    if length is not None:
        kind = docs.schema[length].dataType
        done = done.withColumn(length, F.when(F.size(name) > 0, F.length(body).cast(kind)).otherwise(F.col(f"`{length}`")))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])
