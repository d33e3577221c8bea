"""Block texts of a page with the tags around them."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

#: Fixed sets: elements that start a block, that never have content, whose content is no markup.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript object ol option p pre section select summary svg "
    "table tbody td template textarea tfoot th thead title tr ul video audio canvas button".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
#: Elements and roles that never hold the article.
DROPPED_TAGS = frozenset(
    "head nav footer aside form script style textarea title noscript iframe template button select option svg object canvas audio video "
    "dialog menu fieldset legend xmp noembed noframes".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words in a class or id that name such parts.
DROPPED_WORDS = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar sidebars widget widgets footer masthead topbar toolbar cookie cookies consent gdpr notice notices "
    "alert modal popup overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "comment comments commentlist disqus replies reply pagination pager copyright disclaimer search searchbox outbrain taboola skip skiplink teaser teasers trending feedback signin".split())
#: Words that go with those in the name of a part: inside an article only names made of nothing else drop an element.
PART_WORDS = frozenset(
    "area bar block box button buttons container content field footer form group icons inner items label link links list module "
    "panel post posts section slot stories thread tools unit wrap wrapper".split())
#: Elements that may hold such a part of an article; its headings and paragraphs are text whatever their names.
PART_TAGS = frozenset("div section ul ol dl table center address details".split())
#: A header is the page's unless it is part of the article.
HEADER_WORDS = frozenset("header head".split())
ARTICLE_WORDS = frozenset("article entry post content main story".split())
REGION_TAGS = frozenset(("article", "main"))
ROOT_TAGS = frozenset(("html", "body", "main"))
CLOSED_BY = {
    "p": BLOCK_TAGS - {"html", "body"}, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "option": frozenset(("option",))}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/<>]*+)((?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+)>|<[!?/][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"(?<![a-zA-Z_:-])([a-zA-Z_:-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW_TAGS}
#: White space of HTML and the no-break space that references give.
_BLANKS = re.compile(r"\s+")

#: Innermost block elements that a path names.
PATH_TAGS = 8

REGION, DROPPED, PLAIN = "R", "X", "-"


class Block(NamedTuple):
    """``role``: inside the article, inside a dropped part, or neither; ``path``: the block elements around it."""

    role: str
    path: str
    text: str
    linked: int


class _Open:
    """``soft``: number of the innermost element around that a word drops; ``root``: that of the article or main element."""

    __slots__ = ("tag", "path", "dropped", "region", "link", "soft", "root")

    def __init__(self, tag: str, path: str, dropped: bool, region: bool, link: bool, soft: int = 0, root: int = 0) -> None:
        self.tag, self.path, self.dropped, self.region, self.link, self.soft, self.root = tag, path, dropped, region, link, soft, root


def _words(value: str) -> set[str]:
    return {w.lower() for w in _WORD.findall(value)} | {w for w in re.split(r"[^a-z0-9]+", value.lower()) if w}


def _names_part(value: str) -> bool:
    """Whether a class or id has a whole name, such as ``ad`` or ``related-posts``, that says what is no article."""
    for name in value.split():
        parts = {w.lower() for w in _WORD.findall(name)}
        if name.lower() in DROPPED_WORDS or parts & DROPPED_WORDS and parts <= DROPPED_WORDS | PART_WORDS:
            return True
    return False


def _is_dropped(tag: str, words: set[str], attributes: dict[str, str], in_region: bool) -> bool:
    if tag in DROPPED_TAGS or attributes.get("role", "").lower() in DROPPED_ROLES:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if tag == "header" or words & HEADER_WORDS:
        return not in_region and not words & ARTICLE_WORDS and tag not in ROOT_TAGS
    return False


class _Root(NamedTuple):
    """An article or main element: what words drop around it and with it, and whether its class says article."""

    around: int
    own: int
    named: bool


def _roles(found: list[tuple[_Open, Block]], roots: list[_Root]) -> list[Block]:
    """Blocks with their roles once the page is known.

    The main article is the article or main element with the most text, if that is more
    than all plain text of the page.  Words of layout on it or around it drop neither
    it nor the articles beside it.
    """
    if not any(r.own for r in roots):
        return [b for _, b in found]
    sizes = [0] * len(roots)
    plain = 0
    for x, b in found:
        if not x.dropped and x.region and x.root and x.soft == roots[x.root].own:
            sizes[x.root] += len(b.text)
        elif b.role == PLAIN:
            plain += len(b.text)
    main = max(range(len(roots)), key=sizes.__getitem__)
    if sizes[main] <= plain:
        return [b for _, b in found]
    near = {roots[main].around, roots[main].own}
    free = [i == main or (r.around in near and (r.own == r.around or r.named)) for i, r in enumerate(roots)]
    return [b._replace(role=REGION) if x.root and free[x.root] and x.soft == roots[x.root].own and not x.dropped else b for x, b in found]


def page_blocks(html: str | None) -> list[Block]:
    """Blocks with text in page order; references are decoded and white space inside a block is one blank.

    Unclosed elements end where the next one of their kind starts or where a closed one
    around them ends.
    """
    found: list[tuple[_Open, Block]] = []
    if not html:
        return []
    roots = [_Root(0, 0, False)]
    n_soft = 0
    stack = [_Open("", "", False, False, False)]
    parts: list[str] = []
    opened: dict[str, int] = {}
    linked, at, end = 0, 0, len(html)

    def close(depth: int) -> None:
        for x in stack[depth:]:
            opened[x.tag] -= 1
        del stack[depth:]

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _BLANKS.sub(" ", unescape("".join(parts))).strip()
            if text:
                top = stack[-1]
                role = DROPPED if top.dropped or top.soft else REGION if top.region else PLAIN
                found.append((top, Block(role, top.path, text, min(linked, len(text)))))
            parts.clear()
        linked = 0

    while at < end:
        m = _TOKEN.search(html, at)
        if m is None:
            parts.append(html[at:])
            break
        if m.start() > at:
            piece = html[at:m.start()]
            parts.append(piece)
            if stack[-1].link:
                linked += len(piece)
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if not opened.get(tag):
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    if tag in BLOCK_TAGS:
                        flush()
                    close(depth)
                    break
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = stack[depth].tag
                if tag in CLOSED_BY.get(open_tag, ()):
                    close(depth)
                    break
                if open_tag in BLOCK_TAGS:
                    break
        if tag in RAW_TAGS:
            stop = _RAW_END[tag].search(html, at)
            at = stop.end() if stop else end
            continue
        if tag in VOID_TAGS:
            continue
        top = stack[-1]
        attributes = {a.lower(): x or y or z for a, x, y, z in _ATTRIBUTE.findall(m[3])} if m[3] else {}
        if m[3] and " hidden" in m[3] and re.search(r"\shidden(?=[\s/>]|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", m[3])):
            attributes["hidden"] = ""
        words = _words(attributes.get("class", "") + " " + attributes.get("id", "")) if attributes else set()
        region = top.region or tag in REGION_TAGS or attributes.get("role") == "main" or attributes.get("itemprop") == "articleBody"
        dropped = top.dropped or _is_dropped(tag, words, attributes, top.region)
        path = top.path
        if tag in BLOCK_TAGS:
            path = f"{path}/{tag}" + (f".{'.'.join(sorted(words))}" if words else "")
            if path.count("/") > PATH_TAGS:
                path = path[path.index("/", 1):]
        opened[tag] = opened.get(tag, 0) + 1
        soft, root = top.soft, top.root
        if top.region:
            named = tag in PART_TAGS and words & DROPPED_WORDS and _names_part(attributes.get("class", "") + " " + attributes.get("id", ""))
        else:
            named = tag not in ROOT_TAGS and not (tag == "header" or words & HEADER_WORDS) and words & DROPPED_WORDS
        if named:
            n_soft += 1
            soft = n_soft
        if tag in REGION_TAGS or attributes.get("role") == "main" or attributes.get("itemprop") == "articleBody":
            root = len(roots)
            roots.append(_Root(top.soft, soft, bool(words & ARTICLE_WORDS)))
        stack.append(_Open(tag, path, dropped, region, top.link or tag == "a", soft, root))
    flush()
    return _roles(found, roots)
