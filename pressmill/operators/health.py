"""Source health: state of a fetch, last known states, share of healthy sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill import config
from pressmill.functions.dates import stamp_literal
from pressmill.operators.common import top_per_group

UNDATED = "bez dat (použije se datum prvního spatření)"


def source_health(sources: DataFrame, items: DataFrame, now: dt.datetime, problems: DataFrame | None = None,
                  fetch: config.Fetch = config.Fetch()) -> DataFrame:
    """One row per source: count, newest date and status. ``problems`` (source_id, status, detail) are failed payloads."""
    stats = items.groupBy("source_id").agg(F.count("*").alias("count"), F.max("published_at").alias("newest"),
                                           F.count("published_at").alias("dated"))
    rows = sources.join(stats, "source_id", "left").fillna(0, ["count", "dated"])
    if problems is not None:
        failed = problems.groupBy("source_id").agg(F.min(F.struct("status", "detail")).alias("_p"))
        rows = rows.join(failed, "source_id", "left")
    else:
        rows = rows.withColumn("_p", F.lit(None).cast("struct<status:string,detail:string>"))
    stale = stamp_literal(now - dt.timedelta(days=fetch.stale_days))
    status = (F.when(F.col("_p").isNotNull(), F.col("_p.status")).when(F.col("count") == 0, "empty")
              .when(F.col("newest") < stale, "stale").otherwise("ok"))
    detail = (F.when(F.col("_p").isNotNull(), F.col("_p.detail")).when(F.col("count") == 0, "")
              .when(F.col("newest") < stale, f"nejnovější položka je starší než {fetch.stale_days} dní")
              .when(F.col("dated") == 0, UNDATED).otherwise(""))
    return (rows.withColumn("status", status).withColumn("detail", detail).withColumn("checked_at", stamp_literal(now))
            .drop("_p", "dated"))


def healthy_share(health: DataFrame) -> DataFrame:
    return health.where("enabled").agg(
        F.count_if(F.col("status") == "ok").alias("n_ok"), F.count("*").alias("n"),
        F.bround(F.count_if(F.col("status") == "ok") / F.count("*"), 4).alias("share"))


def merge_health(previous: DataFrame, current: DataFrame, sources: DataFrame) -> DataFrame:
    """Last known state per source; rows of unknown sources leave, API rows stay."""
    both = previous.withColumn("_new", F.lit(0)).unionByName(current.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    last = top_per_group(both, ["source_id"], [F.desc("_new"), F.desc("checked_at")], 1).drop("_new")
    known = sources.select(F.col("id").alias("source_id")).distinct().withColumn("_k", F.lit(True))
    return (last.join(known, "source_id", "left")
            .where(F.col("_k") | F.startswith("source_id", F.lit("api-"))).drop("_k"))


def disabled_rows(sources: DataFrame, now: dt.datetime) -> DataFrame:
    return sources.where("not enabled").select(
        F.col("id").alias("source_id"), "name", "type", "url", "region", "enabled", F.lit("disabled").alias("status"),
        F.col("notes").alias("detail"), F.lit(0).cast("long").alias("count"),
        F.lit(None).cast("timestamp").alias("newest"), stamp_literal(now).alias("checked_at"))
