"""URL filter: block decisions travel along redirects and canonical links."""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.components import connected_components

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    """``text`` is host and path prefix in one, such as ``example.net/en/``."""

    action: str
    text: str


#: Rules of the registered query.
PRODUCTION_RULES = (
    Rule(BLOCK, "net/"), Rule(ALLOW, "example.net/en/"), Rule(BLOCK, "example.com/de/"), Rule(ALLOW, "org/fr/"),
)
#: Rules up to this many become part of the expression; more are joined by host.
INLINE_RULES = 200


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def url_host(url: Column | str) -> Column:
    """From the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case; null or no ``://``: empty."""
    host = F.regexp_extract(_after_scheme(_col(url)), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column | str) -> Column:
    """From the end of the host up to ``? #`` or the end; null or no ``://``: empty."""
    return F.regexp_extract(_after_scheme(_col(url)), r"^[^/?#]*([^?#]*)", 1)


def url_node(url: Column | str) -> Column:
    """Identity of an address in the alias graph: no scheme, no fragment, host in lower case."""
    rest = F.regexp_extract(_after_scheme(_col(url)), r"^[^/?#]*([^#]*)", 1)
    host = url_host(url)
    return F.when(host != "", F.concat(host, rest))


def _split(text: str) -> tuple[str, str]:
    host, _, path = text.partition("/")
    return host, "/" + path


def _ranked(rules: Sequence[Rule]) -> list[Rule]:
    """The rules, those that win first: longer ones, then those that allow, then by text."""
    return sorted(set(rules), key=lambda r: (-len(r.text), r.action != ALLOW, r.text))


def _inline_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, action) of the first rule in rank that fits, else null."""
    chosen = None
    for rule in _ranked(rules):
        rule_host, rule_path = _split(rule.text)
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.action).alias("action"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return F.lit(None).cast("struct<rule:string,action:string>") if chosen is None else chosen


def _joined_rule(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(host, path, _rule) for each distinct host and path of ``df`` that a rule fits."""
    spark = df.sparkSession
    rows = [(n, r.action, r.text, *_split(r.text)) for n, r in enumerate(_ranked(rules))]
    table = spark.createDataFrame(rows, "rank int, action string, rule string, _rule_host string, _rule_path string")
    places = df.select("host", "path").distinct()
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    hits = places.withColumn("_rule_host", F.explode(suffixes)).join(table, "_rule_host")
    best = F.min(F.struct("rank", "rule", "action"))
    return (
        hits.where(F.col("path").startswith(F.col("_rule_path"))).groupBy("host", "path").agg(best.alias("b"))
        .select("host", "path", F.struct("b.rule", "b.action").alias("_rule")))


def with_rule(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``_rule``: struct(rule, action) of the longest rule for the columns host and path."""
    if len(rules) <= INLINE_RULES:
        return df.withColumn("_rule", _inline_rule(F.col("host"), F.col("path"), rules))
    return df.join(_joined_rule(df, rules), ["host", "path"], "left")


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, in double, single or no quotes."""
    found = [F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*{form}", 1) for form in (r'"([^"]*)"', r"'([^']*)'", r"([^\s\"'>]+)")]
    return F.trim(F.replace(F.coalesce(*[F.nullif(x, F.lit("")) for x in found]), F.lit("&amp;"), F.lit("&")))


def _absolute(url: Column, target: Column) -> Column:
    """Resolve a link of a page: absolute, scheme-relative, host-relative or relative to the page's folder."""
    scheme = F.substring_index(url, "://", 1)
    base = F.concat(scheme, F.lit("://"), url_host(url))
    folder = F.regexp_extract(url_path(url), r"^(.*/)?", 0)
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(base, target))
        .when(target != "", F.concat(base, F.when(folder == "", F.lit("/")).otherwise(folder), target)))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst) nodes: the canonical link and the refresh target that a page names, if any."""
    page, address = F.col(html), F.col(url)
    canonical = F.regexp_extract(page, r"(?is)<link\s(?=[^>]*?\brel\s*=\s*[\"']?canonical\b)[^>]*>", 0)
    refresh = F.regexp_extract(page, r"(?is)<meta\s(?=[^>]*?\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*>", 0)
    goal = F.regexp_extract(_attribute(refresh, "content"), r"(?is)url\s*=\s*[\"']?([^\"'\s]+)", 1)
    targets = F.array(_absolute(address, _attribute(canonical, "href")), _absolute(address, goal))
    found = pages.where(page.rlike("(?i)canonical|refresh")).select(
        url_node(address).alias("src"), F.explode(F.transform(targets, url_node)).alias("dst"))
    return found.where("src is not null and dst is not null and src <> dst")


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
    html: str | None = "html",
    links: DataFrame | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Judge every address: columns ``keep``, host, path, rule, verdict, decided_by, node.

    The longest rule that fits decides; of equally long ones an allow rule, then the one
    first in text order, whatever the number and order of rules.  Other addresses inherit from their alias
    component: addresses joined by canonical links and refresh redirects of the
    pages, and by the rows (src, dst: addresses) of ``links``, which redirect logs
    supply.  An allow rule anywhere in the component takes precedence over block
    rules; without a rule in it the address is allowed.  ``decided_by`` is
    ``rule``, ``alias`` or ``default``.

    Null addresses and those without ``://`` have an empty host and path, no node,
    and are allowed; repeated rows are judged alike; an empty table gives no rows;
    pages with null html have no links; addresses of any length are read whole.  Other
    columns of ``pages`` are ignored; a kept column must not be named like one of the results.
    """
    taken = {"host", "path", "rule", "verdict", "decided_by", "node"} & set(keep)
    if taken:
        raise ValueError(f"columns to keep are named like results: {sorted(taken)}")
    parts = [page_links(pages, url, html)] if html else []
    if links is not None:
        parts.append(links.select(url_node(links.src).alias("src"), url_node(links.dst).alias("dst")))
    judged = with_rule(
        pages.select(
            *[F.col(f"`{c}`").alias(f"_keep_{i}") for i, c in enumerate(keep)],
            url_host(url).alias("host"), url_path(url).alias("path"), url_node(url).alias("node")), rules)
    kept = [F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)]
    if parts:
        edges = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        members = connected_components(edges.select("src", "dst"))
        address = F.concat(F.lit("x://"), F.col("node"))
        ruled = with_rule(members.withColumns({"host": url_host(address), "path": url_path(address)}), rules)
        inherited = ruled.groupBy("component").agg(
            F.max(F.col("_rule.action") == ALLOW).alias("_allow"), F.max(F.col("_rule.action") == BLOCK).alias("_block"))
        alias = F.when(F.col("_allow"), F.lit(ALLOW)).when(F.col("_block"), F.lit(BLOCK))
        by_node = members.join(inherited, "component").select("node", alias.alias("_alias")).where("_alias is not null")
        judged = judged.join(by_node, "node", "left")
    else:
        judged = judged.withColumn("_alias", F.lit(None).cast("string"))
    return judged.select(
        *kept, "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.action", "_alias", F.lit(ALLOW)).alias("verdict"),
        F.when(F.col("_rule.rule").isNotNull(), F.lit("rule")).when(F.col("_alias").isNotNull(), F.lit("alias"))
        .otherwise(F.lit("default")).alias("decided_by"), "node")
