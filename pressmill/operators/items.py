"""Item rows: building, merging and uniting them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions import text, urls
from pressmill.operators.common import top_per_group

MAX_AUTHORS = 12

ITEM_COLUMNS = ["id", "title", "url", "source_id", "source_name", "region", "source_type", "language",
                "published_at", "first_seen", "summary_raw", "authors", "doi", "topic_filter", "source_weight",
                "date_is_first_seen"]


def effective_date(published: str = "published_at", first_seen: str = "first_seen") -> Column:
    return F.coalesce(F.col(published), F.col(first_seen))


def build_items(raw: DataFrame, clean: bool = True) -> DataFrame:
    """Parsed entries joined with their source to items.

    ``raw`` needs the source columns (source_id, source_name, region, source_type, source_language, topic_filter,
    source_weight), the entry (title, url, published, summary, authors, doi, language) and ``now``; further columns
    such as the entry's position are kept. Entries without a title or an http address are rejected, future dates
    become ``now``.
    """
    title = text.clean_title(F.col("title")) if clean else F.trim(F.coalesce("title", F.lit("")))
    summary = text.clean_text(F.col("summary")) if clean else F.coalesce("summary", F.lit(""))
    named = F.filter(F.coalesce("authors", F.array().cast("array<string>")), lambda a: a.isNotNull() & (a != ""))
    rows = (raw.withColumn("url", F.trim("url")).withColumn("title", title)
            .where((F.col("title") != "") & F.startswith("url", F.lit("http"))))
    extra = [c for c in raw.columns if c not in {
        *ITEM_COLUMNS, "source_language", "published", "summary", "now"}]
    return rows.select(
        urls.make_id(F.col("url")).alias("id"), "title", "url", "source_id", "source_name", "region", "source_type",
        F.coalesce(F.nullif("language", F.lit("")), "source_language").alias("language"),
        F.when(F.col("published").isNotNull(), F.least("published", "now")).alias("published_at"), F.col("now").alias("first_seen"),
        summary.alias("summary_raw"), F.slice(named, 1, MAX_AUTHORS).alias("authors"),
        urls.normalize_doi(F.col("doi")).alias("doi"), "topic_filter", "source_weight",
        F.col("published").isNull().alias("date_is_first_seen"), *extra)


def with_source(entries: DataFrame, sources: DataFrame) -> DataFrame:
    """Attach the source columns ``build_items`` needs. The registry is a small table; Spark sizes the join itself."""
    src = sources.select(F.col("id").alias("source_id"), F.col("name").alias("source_name"), "region", "source_type",
                         F.col("language").alias("source_language"), "topic_filter",
                         F.col("weight").alias("source_weight"))
    return entries.join(src, "source_id")


def unite(*parts: DataFrame) -> DataFrame:
    """Items of all collectors."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def merge_with_stored(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """One row per id; a stored row wins and keeps its first sighting, so that a rerun sees the same input.

    Among fresh rows the first seen wins, then the place in the feed, the address and the title, however they are spread.
    """
    both = fresh.withColumn("_stored", F.lit(0)).unionByName(stored.withColumn("_stored", F.lit(1)), allowMissingColumns=True)
    order = [F.asc_nulls_last(c) for c in ("first_seen", "feed_pos", "url", "title", "source_id") if c in both.columns]
    return top_per_group(both, ["id"], [F.desc("_stored"), *order], 1).drop("_stored")


def news_only(items: DataFrame) -> DataFrame:
    """Calls from funding portals are not news."""
    return items.where("source_type <> 'funding'")


def items_per_source(items: DataFrame) -> DataFrame:
    return items.groupBy("source_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source_id")
