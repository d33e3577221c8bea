"""Page to document: recognition, extraction and topic matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions import lexicon as lx
from lexmill.functions import patterns as rx


def is_probably_html(content: Column | str) -> Column:
    """True when any usual HTML marker occurs."""
    return F.coalesce(rx.matches(content, "|".join(lx.HTML_MARKERS), ignore_case=True), F.lit(False))


def is_text_media_type(content_type: Column | str) -> Column:
    c = rx.as_col(content_type)
    return rx.any_of([c.contains(t) for t in lx.TEXT_MEDIA_TYPES])


def strip_control_chars(text: Column | str) -> Column:
    """Drop control characters except tab and line feed."""
    return rx.replace_all(text, r"[\x00-\x08\x0B-\x1F]")


def html_to_text(html: Column | str) -> Column:
    """Visible text of a page.

    Uses the closed body if there is one, drops blocks without content, then
    tags.  Entities stay as they are; cleaning deals with them.
    """
    tags = "|".join(lx.NON_CONTENT_TAGS)
    # A lazy head and a greedy tail around the body leave just the body; a
    # page without a closed body does not match and stays whole.
    body = rx.replace_all(html, r"^.*?<body[^>]*>(.*?)</body>.*$", "$1", ignore_case=True, dotall=True)
    no_blocks = rx.replace_all(body, rf"<({tags})[^>]*>.*?</\1>", " ", ignore_case=True, dotall=True)
    no_tags = rx.replace_all(no_blocks, r"<[^>]+>", " ")
    return strip_control_chars(F.trim(rx.collapse_spaces(no_tags)))


def has_document_length(text: Column | str, max_chars: int | None = None) -> Column:
    """More than ten characters; with ``max_chars`` no more than that."""
    n = F.length(rx.strip(text))
    long_enough = n >= lx.MIN_TEXT_CHARS
    return long_enough if max_chars is None else long_enough & (n <= max_chars)


def matches_topics(
    text: Column | str,
    url: Column | str,
    topics: list[str] | None = None,
    domains: list[str] | None = None,
) -> Column:
    """True without filters, or if a domain is in the URL or a topic in the text."""
    if not topics and not domains:
        return F.lit(True)
    url_low = F.lower(F.coalesce(rx.as_col(url), F.lit("")))
    text_low = F.lower(F.coalesce(rx.as_col(text), F.lit("")))
    # Domains first: the URL is short and the OR stops at the first hit.
    tests = [url_low.contains(d.lower()) for d in domains or []]
    tests += [text_low.contains(t.lower()) for t in topics or []]
    return rx.any_of(tests)
