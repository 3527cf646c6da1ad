"""Landed payloads: what a fetch brought, one row per response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: marks of a challenge page; ordinary pages behind the same provider do not carry them
CHALLENGE_MARKS = ("cf-browser-verification", "cf_chl_opt", "<title>just a moment", "attention required! | cloudflare")
FEED_ROOTS = ("<rss", "<feed", "<rdf:rdf", "<channel")
HEAD_CHARS = 6000  # the verdict is about the head of a response


def payload_kind(body: Column, content_type: Column | None = None) -> Column:
    """'cloudflare', 'html_instead_of_feed' or 'ok'."""
    head = F.lower(F.regexp_replace(F.substring(body, 1, HEAD_CHARS), r"^\s+", ""))
    declared = F.lower(F.coalesce(content_type, F.lit(""))) if content_type is not None else F.lit("")

    def any_of(marks):
        found = F.lit(False)
        for m in marks:
            found = found | F.contains(head, F.lit(m))
        return found

    html = F.startswith(head, F.lit("<!doctype html")) | F.startswith(head, F.lit("<html"))
    feed = any_of(FEED_ROOTS)
    claimed = F.contains(declared, F.lit("text/html")) & ~F.startswith(head, F.lit("<?xml"))
    return (F.when(any_of(CHALLENGE_MARKS), "cloudflare").when((html | claimed) & ~feed, "html_instead_of_feed")
            .otherwise("ok"))


def problems(parsed: DataFrame) -> DataFrame:
    """Payloads that gave no items because they could not be read, as rows for the health table."""
    return parsed.where("problem is not null").select("source_id", F.lit("parse_error").alias("status"),
                                                      F.col("problem").alias("detail"))
