"""The week's window, the memory of earlier weeks and caps per source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill import config
from pressmill.functions import text
from pressmill.functions.dates import shift_week, stamp_literal, week_bounds
from pressmill.functions.keywords import Keywords, default_keywords
from pressmill.operators.common import running_sums, top_per_group


def in_window(start: dt.datetime, end: dt.datetime, grace_days: int = config.Selection.grace_days) -> Column:
    """Dated items inside the week; undated ones by first sighting, with some days of grace."""
    lo, hi = stamp_literal(start), stamp_literal(end)
    late = stamp_literal(end + dt.timedelta(days=grace_days))
    return F.when(F.col("published_at").isNotNull(), F.col("published_at").between(lo, hi)).otherwise(
        F.col("first_seen").between(lo, late))


def with_memory(items: DataFrame, seen: DataFrame) -> DataFrame:
    """Adds seen_item, seen_doi (weeks) and known_source from the memory table (kind, key, week)."""
    ids = seen.where("kind = 'item'").select(F.col("key").alias("id"), F.col("week").alias("seen_item"))
    dois = seen.where("kind = 'doi'").select(F.col("key").alias("doi"), F.col("week").alias("seen_doi"))
    sources = seen.where("kind = 'source'").select(F.col("key").alias("source_id"), F.lit(True).alias("known_source"))
    return (items.join(ids, "id", "left").join(dois, "doi", "left").join(sources, "source_id", "left")
            .withColumn("known_source", F.coalesce("known_source", F.lit(False))))


def not_seen_earlier(week: str) -> Column:
    """Not placed in an earlier week: the id decides, the DOI only where the id is unknown."""
    placed = F.coalesce("seen_item", "seen_doi")
    return placed.isNull() | (placed >= week)


def select_window(items: DataFrame, seen: DataFrame, week: str,
                  cap: int = config.Selection.undated_first_run_cap) -> DataFrame:
    """Items with ``placement`` 'window' or 'suppressed'; all others are left out.

    Undated items of a source that was never fetched before are mostly an old archive: only the first ``cap`` in
    arrival order (column ``arrival``) may enter, the rest is suppressed for good. The cap counts before the week
    test. Only the cap-th position per source is computed and joined back; no source is sorted as a whole.
    """
    start, end = week_bounds(week)
    rows = (with_memory(items, seen)
            .where(F.coalesce("seen_item", F.lit("")) != config.SUPPRESSED_WEEK).where(not_seen_earlier(week))
            .withColumn("_first_run", F.col("published_at").isNull() & ~F.col("known_source")
                        & (F.col("seen_item").isNull() | (F.col("seen_item") != week)))
            .withColumn("_at", F.struct("arrival", "id")))
    last = (top_per_group(rows.where("_first_run").select("source_id", "_at"), ["source_id"], [F.col("_at")], cap, "_n")
            .where(F.col("_n") == cap).select("source_id", F.col("_at").alias("_last")))
    rows = rows.join(last, "source_id", "left")
    over = F.col("_first_run") & F.col("_last").isNotNull() & (F.col("_at") > F.col("_last"))
    placement = F.when(over, "suppressed").when(in_window(start, end), "window")
    return (rows.withColumn("placement", placement).where("placement is not null")
            .drop("_first_run", "_at", "_last", "seen_item", "seen_doi", "known_source"))


def cap_per_source(items: DataFrame, keywords: Keywords | None = None) -> DataFrame:
    """At most ``cap`` items per source in feed order (columns ``cap``, ``feed_pos``).

    A topic-filtered source with more items than its cap is filtered by keywords before the cut.
    """
    kw = keywords or default_keywords()
    sizes = items.groupBy("source_id").agg(F.count("*").alias("_size"))
    relevant = text.matches(text.match_text(text.item_text(F.col("title"), F.col("summary_raw"))), kw)
    rows = items.join(sizes, "source_id").where(~(F.col("topic_filter") & (F.col("_size") > F.col("cap"))) | relevant)
    return top_per_group(rows, ["source_id"], [F.col("feed_pos"), F.col("id")], F.col("cap"), salt_by="id").drop("_size")


def source_cap(fetch: config.Fetch = config.Fetch()) -> Column:
    """The cap of a source: its own, a high one for monitored media, else the default."""
    return F.coalesce(F.nullif("max_items", F.lit(0)), F.when(F.col("media_monitor"), fetch.max_items_monitored).otherwise(
        fetch.max_items_per_source))


# -- memory --------------------------------------------------------------------------------------------------------

def mark_seen(seen: DataFrame, new: DataFrame) -> DataFrame:
    """Add keys that are not known yet; an earlier mark stays."""
    fresh = new.groupBy("kind", "key").agg(F.min("week").alias("week"))
    return seen.select("kind", "key", "week").unionByName(fresh.join(seen, ["kind", "key"], "left_anti")
                                                          .select("kind", "key", "week"))


def week_marks(placed: DataFrame, fetched: DataFrame, week: str) -> DataFrame:
    """Memory rows of one run: placed items and DOIs, suppressed items, fetched sources."""
    def rows(df, kind, key, value):
        return df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), F.lit(value).alias("week"))

    window, suppressed = placed.where("placement = 'window'"), placed.where("placement = 'suppressed'")
    return (rows(window, "item", "id", week).unionByName(rows(window.where("doi is not null"), "doi", "doi", week))
            .unionByName(rows(suppressed, "item", "id", config.SUPPRESSED_WEEK))
            .unionByName(rows(fetched.select("source_id").distinct(), "source", "source_id", week)))


def prune_seen(seen: DataFrame, week: str, keep_weeks: int = config.Selection.seen_retention_weeks) -> DataFrame:
    """Forget items and DOIs after some weeks; suppressed items, sources and calls are never forgotten."""
    cutoff = shift_week(week, -keep_weeks)
    recent = F.col("week") >= cutoff
    return seen.where(F.when(F.col("kind") == "item", recent | (F.col("week") == config.SUPPRESSED_WEEK))
                      .when(F.col("kind") == "doi", recent).otherwise(True))


def last_weeks(table: DataFrame, n: int, week: str = "week") -> DataFrame:
    """Rows of the ``n`` latest recorded weeks. Weeks are counted on the distinct list, not on the rows."""
    recent = table.select(week).distinct().orderBy(F.desc(week)).limit(n)
    return table.join(recent, week, "left_semi")


def batch_numbers(ranked: DataFrame, order: list[Column], size: int, scope: str) -> DataFrame:
    """Batch number of each row of a ranked queue, per scope."""
    placed = running_sums(ranked, scope, order, {"_place": F.lit(1).cast("long")})
    return placed.withColumn("batch_no", F.floor((F.col("_place") - 1) / size).cast("int")).drop("_place")
