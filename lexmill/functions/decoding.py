"""Bytes to text: declared charset and best-effort decoding."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lexmill.functions import lexicon as lx
from lexmill.functions import patterns as rx


def declared_charset(content_type: Column | str, content: Column | str) -> Column:
    """Charset of the header, else of a ``<meta … charset=…>`` tag, else null."""
    from_header = F.regexp_extract(rx.as_col(content_type), rx.expand(r"charset=([^\s;]+)"), 1)
    from_header = F.trim(from_header, F.lit("\"'"))
    # Latin-1 maps every byte to one character, so the tag can be searched in any encoding.
    as_latin1 = F.decode(rx.as_col(content), "ISO-8859-1")
    from_meta = F.regexp_extract(as_latin1, r"(?i)<meta[^>]+charset=([\"']?)([^\"'>]+)\1", 2)
    from_meta = F.regexp_replace(from_meta, r"[^\x00-\x7F]", "")
    return F.when(from_header != "", from_header).when(from_meta != "", from_meta)


def _decoder(encodings: list[str], good_ratio: float):
    """Arrow UDF (content, charset) -> text; null in, null out."""

    def best_text(raw: bytes, charset: str | None) -> str | None:
        best, best_ratio = None, 1.0
        for name in dict.fromkeys(([charset] if charset else []) + encodings):
            try:
                text = raw.decode(name, errors="replace")
            except (UnicodeDecodeError, LookupError):
                continue
            except ValueError:
                return None
            ratio = text.count("\ufffd") / len(text) if text else 1.0
            if ratio < best_ratio:
                best, best_ratio = text, ratio
                if ratio < good_ratio:
                    break
        return raw.decode("utf-8", errors="replace") if best is None else best

    def decode_batches(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for contents, charsets in batches:
            yield pd.Series(
                [None if raw is None else best_text(bytes(raw), cs) for raw, cs in zip(contents, charsets)],
                dtype=object,
            )

    decode_batches.__annotations__ = {
        "batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series],
    }
    return F.pandas_udf(decode_batches, StringType())


def decode_best_effort(content: Column | str, charset: Column | str) -> Column:
    """Decode with the declared charset, then the usual encodings in order.

    The first text with few replacement characters wins, else the one with the
    fewest.  Valid UTF-8 is decoded by Spark itself; only other payloads reach
    the Python workers (the UDF gets null for the rest).
    """
    raw, cs = rx.as_col(content), rx.as_col(charset)
    as_utf8 = raw.cast("string")
    plain = (
        (cs.isNull() | F.lower(cs).isin("utf-8", "utf8"))
        & F.is_valid_utf8(as_utf8)
        & (F.octet_length(raw) > 0)
        & ~F.coalesce(as_utf8.contains("\ufffd"), F.lit(False))
    )
    rest = _decoder(list(lx.ENCODINGS), lx.GOOD_DECODE_RATIO)(F.when(~plain, raw), cs)
    return F.when(plain, as_utf8).otherwise(rest)
