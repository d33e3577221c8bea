"""Main-text extraction with wrappers inferred from the pages of a host."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.html_blocks import DROPPED, PLAIN, REGION, Block, page_blocks
from lexmill.llm.url_filter import url_host
from lexmill.operators.scratch import materialized

#: Longest group of blocks that is tried as a repetition.
GROUP = 6
#: Hosts whose wrappers a task holds before it passes them on.
HELD_HOSTS = 500
#: Different pages on which a text must be the same to be the template's, and their share of the host's: outside any
#: article, and inside one, where headings are never template.
TEMPLATE_PAGES, TEMPLATE_SHARE = 3, (1, 2)
ARTICLE_PAGES, ARTICLE_SHARE = 4, (2, 3)
#: An optional part that fewer than one in so many pages have is forgotten: it decides nothing, and wrappers stay small.
RARE = 20
#: A block with at least this share of its text in links is a menu.
LINK_SHARE = 0.6


_HEADING = re.compile(r"/h[1-6](?:\.[^/]*)?$")


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


@dataclass
class Item:
    """A part of a wrapper: a block or a repeated group, present or optional, its text constant or a slot."""

    key: str
    constant: int | None = None
    optional: bool = False
    repeated: bool = False
    pages: int = 1


@dataclass
class Wrapper:
    """Union-free expression over the blocks of a host's pages."""

    items: list[Item] = field(default_factory=list)
    pages: int = 0

    def to_json(self) -> str:
        return json.dumps([self.pages, [[i.key, i.constant, i.optional, i.repeated, i.pages] for i in self.items]], ensure_ascii=False)

    @classmethod
    def from_json(cls, text: str) -> Wrapper:
        pages, items = json.loads(text)
        return cls([Item(*i) for i in items], pages)

    def shape(self) -> tuple[str, ...]:
        return tuple(i.key for i in self.items)


def _folded(items: list[Item]) -> list[Item]:
    """Groups of blocks that follow themselves become one repeated item, shorter groups first."""
    for width in range(1, GROUP + 1):
        out: list[Item] = []
        i = 0
        while i < len(items):
            run = [x.key for x in items[i:i + width]]
            j = i + width
            while len(run) == width and [x.key for x in items[j:j + width]] == run:
                j += width
            if j > i + width:
                if width == 1:
                    out.append(Item(run[0], None, items[i].optional, True, items[i].pages))
                else:
                    out.append(Item("(" + " ".join(run) + ")", None, False, True, items[i].pages))
                i = j
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def page_wrapper(blocks: Sequence[Block]) -> Wrapper:
    """The wrapper of one page: all its texts are constants, its repetitions are folded."""
    return Wrapper(_folded([Item(f"{b.role}{b.path}", _digest(b.text)) for b in blocks]), 1)


def token_wrapper(kinds: Sequence[str], texts: Sequence[int], strings: set[int]) -> Wrapper:
    """The wrapper of one page whose texts are slots, but for those in ``strings``, which are tokens of their own.

    So a string that many pages share is aligned with itself wherever it stands, and ends a repetition.
    """
    return Wrapper(_folded([Item(f"{k}={t}", t) if t in strings else Item(k) for k, t in zip(kinds, texts, strict=True)]), 1)


def _same(a: Item, b: Item) -> Item:
    constant = a.constant if a.constant == b.constant else None
    return Item(a.key, constant, a.optional or b.optional, a.repeated or b.repeated, a.pages + b.pages)


def _skipped(items: Iterable[Item]) -> list[Item]:
    return [Item(i.key, i.constant, True, i.repeated, i.pages) for i in items]


def _repeats_neighbour(extra: list[Item], before: list[Item]) -> bool:
    """Whether the surplus continues a repetition that ends just before it."""
    return len(extra) <= len(before) and [i.key for i in extra] == [i.key for i in before[-len(extra):]]


def align(a: Wrapper, b: Wrapper) -> Wrapper:
    """The most specific expression for the pages of both.

    Blocks that match in order stay; texts that differ become slots.  A mismatch is
    resolved as a repetition if it goes on with what stands before it, else its blocks
    become optional.
    """
    if not a.pages or not b.pages:
        return a if a.pages else b
    if a.shape() == b.shape():
        return Wrapper([_same(x, y) for x, y in zip(a.items, b.items, strict=True)], a.pages + b.pages)
    out: list[Item] = []
    for op, i1, i2, j1, j2 in SequenceMatcher(None, a.shape(), b.shape(), autojunk=False).get_opcodes():
        if op == "equal":
            out += [_same(x, y) for x, y in zip(a.items[i1:i2], b.items[j1:j2], strict=True)]
            continue
        for extra in (a.items[i1:i2], b.items[j1:j2]):
            if extra and _repeats_neighbour(extra, out):
                n = len(extra)
                tail = out[-n:]
                joined = tail[0].key if n == 1 else "(" + " ".join(i.key for i in tail) + ")"
                out[-n:] = [Item(joined, None, any(i.optional for i in tail), True, max(i.pages for i in tail))]
            else:
                out += _skipped(extra)
    pages = a.pages + b.pages
    return Wrapper([i for i in _folded(out) if not i.optional or RARE * i.pages >= pages], pages)


def _infer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A wrapper for each host of the rows of a task, passed on in portions of HELD_HOSTS hosts."""
    held: dict[str, Wrapper] = {}

    def out() -> pd.DataFrame:
        frame = pd.DataFrame({"host": list(held), "wrapper": [w.to_json() for w in held.values()]}, columns=["host", "wrapper"])
        held.clear()
        return frame

    for batch in batches:
        for host, kinds, texts, strings in zip(batch["host"], batch["kinds"], batch["texts"], batch["strings"], strict=True):
            known = set() if strings is None else set(strings.tolist())
            held[host] = align(held.get(host, Wrapper()), token_wrapper(kinds.tolist(), texts.tolist(), known))
            if len(held) > HELD_HOSTS:
                yield out()
    if held:
        yield out()


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by host: one wrapper for each, aligned as they come."""
    host, wrapper = None, Wrapper()
    done: list[tuple[str, str]] = []
    for batch in batches:
        for h, text in zip(batch["host"], batch["wrapper"], strict=True):
            if h != host:
                if wrapper.pages:
                    done.append((host, wrapper.to_json()))
                host, wrapper = h, Wrapper()
            wrapper = align(wrapper, Wrapper.from_json(text))
        if done:
            yield pd.DataFrame(done, columns=["host", "wrapper"])
            done = []
    if wrapper.pages:
        yield pd.DataFrame([(host, wrapper.to_json())], columns=["host", "wrapper"])


_PARSED = "key {}, url string, host string, page long, kinds array<string>, lines array<string>, texts array<long>, linked array<int>"


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = batch[["key", "url", "host", "page"]].copy()
        # Dropped parts are neither text nor template.
        parsed = [[b for b in page_blocks(html) if b.role != DROPPED] for html in batch["html"]]
        out["kinds"] = [[f"{b.role}{b.path}" for b in blocks] for blocks in parsed]
        out["lines"] = [[b.text for b in blocks] for blocks in parsed]
        out["texts"] = [[_digest(b.text) for b in blocks] for blocks in parsed]
        out["linked"] = [[b.linked for b in blocks] for blocks in parsed]
        yield out


def parse_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, host, page, kinds, lines, texts, linked): the blocks of each page outside dropped parts, written once.

    ``page`` is a hash of the html, by which copies are known; ``texts`` are hashes of the lines.
    """
    named = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), url_host(url).alias("host"), F.xxhash64(html).alias("page"), F.col(html).alias("html"))
    return materialized(named.mapInPandas(_parse, _PARSED.format(dict(named.dtypes)["key"])))


def shared_strings(distinct: DataFrame) -> DataFrame:
    """(host, strings): texts that enough different pages of a host have to be its template, if the alignment agrees."""
    sizes = distinct.groupBy("host").agg(F.count("*").alias("pages"))
    counts = distinct.select("host", F.explode(F.array_distinct("texts")).alias("text")).groupBy("host", "text").agg(F.count("*").alias("n"))
    part, whole = TEMPLATE_SHARE
    often = counts.where(F.col("n") >= TEMPLATE_PAGES).join(sizes, "host").where(F.col("n") * whole > F.col("pages") * part)
    # Over half of the pages have each, so a host has no more than twice the blocks of a page.
    return often.groupBy("host").agg(F.collect_set("text").alias("strings"))


def infer_wrappers(parsed: DataFrame) -> DataFrame:
    """(host, wrapper): a union-free expression per host, over all its different pages (see ``parse_pages``).

    Tasks align token streams of pages, host by host; the partial wrappers meet in a
    second step, one row per host and task, so a host with most of the pages is no hot
    task.  Both steps hold expressions, not pages, and only hashes of texts move.
    """
    distinct = materialized(parsed.groupBy("host", "page").agg(F.first("kinds").alias("kinds"), F.first("texts").alias("texts")))
    strings = materialized(shared_strings(distinct))
    streams = distinct.join(strings, "host", "left").sortWithinPartitions("host", "page")
    parts = streams.select("host", "kinds", "texts", "strings").mapInPandas(_infer, "host string, wrapper string")
    return parts.repartition("host").sortWithinPartitions("host", "wrapper").mapInPandas(_merge, "host string, wrapper string")


class Extractor:
    """What of a host's pages is template, by its wrapper."""

    def __init__(self, wrapper: Wrapper) -> None:
        counts: dict[int, int] = {}
        headings, inside = set(), set()
        for i in wrapper.items:
            if i.constant is not None and i.key[0] != DROPPED:
                counts[i.constant] = counts.get(i.constant, 0) + i.pages
                path = i.key.partition("=")[0]
                if path[0] == REGION:
                    inside.add(i.constant)
                    if _HEADING.search(path):
                        headings.add(i.constant)

        def often(text: int, least: int, share: tuple[int, int]) -> bool:
            return counts[text] >= least and counts[text] * share[1] > wrapper.pages * share[0]

        self.template = {t for t in counts if t not in inside and often(t, TEMPLATE_PAGES, TEMPLATE_SHARE)}
        self.article_template = {t for t in inside - headings if often(t, ARTICLE_PAGES, ARTICLE_SHARE)}
        # If every text of the pages is the same, nothing tells template from text.
        if not any(i.constant is None and i.key[0] in PLAIN + "(" for i in wrapper.items):
            self.template = set()
        if not any(i.constant is None and i.key[0] in REGION + "(" for i in wrapper.items):
            self.article_template = set()

    def text(self, blocks: Sequence[Block]) -> str:
        """Texts inside the article; without one, those outside dropped parts that are no menu; neither has the template."""
        article = [b.text for b in blocks if b.role == REGION and not (self.article_template and _digest(b.text) in self.article_template)]
        if any(b.role == REGION for b in blocks):
            return "\n".join(article)
        plain = [b for b in blocks if b.role == PLAIN and b.linked < LINK_SHARE * len(b.text)]
        return "\n".join(b.text for b in plain if not self.template or _digest(b.text) not in self.template)


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, Extractor] = {}
    for batch in batches:
        if not len(batch):
            continue
        out = []
        for kinds, lines, linked, wrapper in zip(batch["kinds"], batch["lines"], batch["linked"], batch["wrapper"], strict=True):
            reader = known.get(wrapper)
            if reader is None:
                if len(known) > HELD_HOSTS:
                    known.clear()
                reader = known[wrapper] = Extractor(Wrapper.from_json(wrapper) if wrapper else Wrapper())
            out.append(reader.text([Block(k[0], k[1:], t, n) for k, t, n in zip(kinds, lines, linked, strict=True)]))
        yield pd.DataFrame({"key": batch["key"], "url": batch["url"], "text": out, "n_chars": [len(t) for t in out]})


def extract_articles(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) per row: the main text of each page.

    The text is what the slots of the host's wrapper hold: blocks of the article, in page
    order, one per line, with references decoded and white space collapsed.  Parts
    that never belong to an article (menus, headers, footers, side bars, notices,
    adverts, forms, scripts, styles, comments) are no slots.  Inside an article such a part is an
    element of that kind, or a container with a whole name that says so; what the wrapper
    finds to be the same text on most different pages of the host (no heading) is template
    there too.  A page without an article element gives its other blocks, but for those that
    are the template of its host and those that are mostly links.

    Pages are parsed once.  Null and empty html give an empty text; html of any length is read
    whole; null addresses share the empty host; a null key is kept; copies count as one page for the
    template; repeated rows are extracted alike; an empty table gives no rows; other columns are
    ignored.
    """
    parsed = parse_pages(pages, key, url, html)
    # Written first: their size is then known, and if it is small the pages need not move to meet them.
    wrappers = materialized(infer_wrappers(parsed))
    joined = parsed.join(wrappers, "host", "left").select("key", "url", "kinds", "lines", "linked", "wrapper")
    kind = dict(joined.dtypes)["key"]
    done = joined.mapInPandas(_extract, f"key {kind}, url string, text string, n_chars long")
    return done.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
