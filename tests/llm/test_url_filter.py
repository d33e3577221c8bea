"""URL rules, aliases and odd rows."""

import pytest

from lexmill.llm.components import connected_components
from lexmill.llm.url_filter import PRODUCTION_RULES, Rule, filter_urls

SCHEMA = "page_id long, url string, html string, host string, verdict string"


def judged(spark, rows, rules=PRODUCTION_RULES, **options):
    df = spark.createDataFrame([(i, u, h, "x", "y") for i, (u, h) in enumerate(rows)], SCHEMA)
    return {r.page_id: r for r in filter_urls(df, rules, keep=["page_id"], **options).collect()}


def test_rules_hosts_and_paths(spark):
    got = judged(spark, [
        ("http://A.Example.NET/en/1?q#f", ""), ("https://example.net/de/", ""), ("http://example.com/de/x", ""),
        ("http://x.org/fr/y", ""), ("http://xexample.com/de/", ""), ("http://example.net", ""), (None, None), ("no scheme", ""),
        ("http://Ünï.org/fr/", None), ("http://example.com?a=/de/", ""),
    ])
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(10)] == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"), ("example.net", "/de/", "net/", "block"),
        ("example.com", "/de/x", "example.com/de/", "block"), ("x.org", "/fr/y", "org/fr/", "allow"),
        ("xexample.com", "/de/", None, "allow"), ("example.net", "", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("Ünï.org", "/fr/", "org/fr/", "allow"), ("example.com", "", None, "allow")]


def test_block_reaches_aliases_and_allow_wins(spark):
    link = '<html><head><link rel="canonical" href="%s"></head></html>'
    move = "<meta http-equiv='refresh' content='0; url=%s'>"
    got = judged(spark, [
        ("http://one.org/a", link % "http://spam.net/"),          # blocked through its target
        ("http://two.org/b", move % "http://one.org/a"),          # blocked through a chain
        ("http://three.org/c", link % "http://two.org/fr/ok"),    # allowed target
        ("http://four.org/d", link % "//three.org/c"),
        ("http://four.org/d#part", link % "http://bad.net/x"),    # same address: allow wins over block
        ("http://alone.org/", "<link rel=stylesheet href=x>"),
        ("http://spam.net/en/", "<p>x</p>"),
        ("http://five.org/dir/p", link % "../no"), ("http://four.org/d", link % "http://bad.net/x"),
    ])
    assert [(got[i].verdict, got[i].decided_by) for i in range(7)] == [
        ("block", "alias"), ("block", "alias"), ("allow", "alias"), ("allow", "alias"), ("allow", "alias"),
        ("allow", "default"), ("block", "rule")]
    assert got[8].verdict == "allow" and got[7].decided_by == "default"


def test_many_rules_are_joined_and_links_table(spark):
    rules = [*PRODUCTION_RULES, *[Rule("block", f"h{i}.io/p/") for i in range(300)]]
    rows = [("http://h7.io/p/1", ""), ("http://a.h8.io/q", ""), ("http://x.net/", ""), ("http://e.io/", "")]
    links = spark.createDataFrame([("http://e.io/", "http://h9.io/p/x"), (None, "http://a/")], "src string, dst string")
    got = judged(spark, rows, rules, links=links)
    assert [(got[i].rule, got[i].verdict) for i in range(4)] == [
        ("h7.io/p/", "block"), (None, "allow"), ("net/", "block"), (None, "block")]
    assert filter_urls(spark.createDataFrame([], SCHEMA), rules, keep=["page_id"]).count() == 0


def test_components_match_union_find(spark):
    import random

    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(80)] + [(None, 3), (7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "p long, q long")).collect()}
    assert got == {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("more", [0, 300])
def test_rules_of_one_length(spark, more):
    others = [Rule("block", f"h{i}.org/") for i in range(more)]
    rules = [Rule("block", "a.b.com/"), Rule("allow", "b.com/xx"), Rule("block", "same.net/"), Rule("allow", "same.net/"), *others]
    pages = spark.createDataFrame([(1, "http://a.b.com/xx/1"), (2, "http://same.net/")], "`page.id` int, url string")
    for order in (rules, rules[::-1]):
        got = {x["page.id"]: (x.rule, x.verdict) for x in filter_urls(pages, order, html=None, keep=["page.id"]).collect()}
        assert got == {1: ("b.com/xx", "allow"), 2: ("same.net/", "allow")}


def test_names_of_results_cannot_be_kept(spark):
    pages = spark.createDataFrame([("h", "http://a.org/")], "host string, url string")
    with pytest.raises(ValueError):
        filter_urls(pages, [], html=None, keep=["host"])
