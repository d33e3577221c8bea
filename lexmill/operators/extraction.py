"""Pages to documents with reject accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import html as h
from lexmill.functions import lexicon as lx
from lexmill.functions import patterns as rx
from lexmill.functions.decoding import declared_charset, decode_best_effort


def with_extracted_text(
    df: DataFrame,
    content: str = "content",
    url: str = "url",
    content_type: str | None = "content_type",
    topics: list[str] | None = None,
    domains: list[str] | None = None,
    out: str = "text",
    max_chars: int | None = None,
) -> DataFrame:
    """Add ``out`` and ``reject_reason``; the text is null where a page is rejected.

    ``max_chars`` rejects longer texts; by default none is too long.

    ``content`` is binary (web records, decoded here) or already text.  Cheap
    tests null out a payload before it reaches decoding and extraction.
    """
    binary = df.schema[content].dataType.typeName() == "binary"
    raw = F.col(content)
    early = F.lit(None).cast("string")
    if content_type is not None:
        early = F.when(~h.is_text_media_type(F.coalesce(F.col(content_type), F.lit(""))), "media_type")
    too_small = F.coalesce(F.octet_length(raw) < lx.MIN_PAYLOAD_BYTES, F.lit(True))
    # Undecodable bytes are skipped when looking for markers.
    sniffed = F.translate(F.make_valid_utf8(raw.cast("string")), "\ufffd", "") if binary else raw
    early = F.coalesce(early, F.when(too_small, "too_small"), F.when(~h.is_probably_html(sniffed), "not_html"))

    df = rx.add_once(df, {"_early": early})
    accepted = F.when(F.col("_early").isNull(), raw)
    if binary:
        header = F.col(content_type) if content_type is not None else F.lit("")
        charset = declared_charset(F.coalesce(header, F.lit("")), accepted)
        df = rx.add_once(df, {"_charset": charset})
        page = decode_best_effort(accepted, F.col("_charset"))
    else:
        page = accepted
    df = rx.add_once(df, {"_text": h.html_to_text(page)})
    reason = F.coalesce(
        F.col("_early"),
        F.when(F.col("_text").isNull(), "not_decodable"),
        F.when(~h.has_document_length("_text", max_chars), "length"),
        F.when(~h.matches_topics("_text", url, topics, domains), "off_topic"),
    )
    df = rx.add_once(df, {"reject_reason": reason})
    df = df.withColumn(out, F.when(F.col("reject_reason").isNull(), F.col("_text")))
    return df.drop("_early", "_charset", "_text")


def pages_to_documents(df: DataFrame, **options) -> DataFrame:
    """Accepted pages with their text; same options as :func:`with_extracted_text`."""
    content = options.get("content", "content")
    done = with_extracted_text(df, **options)
    return done.where(F.col("reject_reason").isNull()).drop("reject_reason", content)


def extraction_report(extracted: DataFrame) -> DataFrame:
    """Pages per outcome: (outcome, n)."""
    return extracted.groupBy(F.coalesce("reject_reason", F.lit("extracted")).alias("outcome")).agg(
        F.count("*").alias("n"))


def observe_extraction(extracted: DataFrame, name: str = "extraction") -> DataFrame:
    """Count processed, extracted and rejected pages while the job runs."""
    return extracted.observe(
        name,
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("reject_reason").isNull()).alias("extracted"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
    )
