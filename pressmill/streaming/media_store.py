"""Incremental collection of monitored media into a weekly store.

Landed items arrive as files. Each micro-batch is written as new rows of the store, once per article: an article that
is already stored keeps its first sighting. Batches are written under their number, so a repeated batch replaces
itself and nothing is counted twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.functions.dates import shift_week, week_of
from pressmill.operators.common import top_per_group
from pressmill.operators.items import effective_date
from pressmill.schemas import ITEM
from pressmill.sources.store import path_exists

WEEKS_BACK = 1
WATERMARK = "14 days"

STORE = ITEM + ", week string, batch long"
META = "week string, added long, at timestamp, batch long"


def accepted_weeks(now: dt.datetime) -> list[str]:
    """The current and the previous ISO week of processing time."""
    iso = now.isocalendar()
    current = f"{iso[0]}-W{iso[1]:02d}"
    return [shift_week(current, -k) for k in range(WEEKS_BACK + 1)]


def accept(items: DataFrame, now: dt.datetime) -> DataFrame:
    """Items of the accepted weeks, with their week. ``now`` is a parameter so that a replay gives the same rows."""
    return items.withColumn("week", week_of(effective_date())).where(F.col("week").isin(accepted_weeks(now)))


def weekly_window(stamp: Column) -> Column:
    """Monday-to-Monday tumbling window (the epoch was a Thursday)."""
    return F.window(stamp, "7 days", "7 days", "4 days")


def first_sightings(items: DataFrame) -> DataFrame:
    """One row per id, the first seen."""
    return top_per_group(items, ["id"], [F.col("first_seen"), F.col("url")], 1)


def read_store(spark: SparkSession, path: str, *weeks: str) -> DataFrame:
    schema = spark.createDataFrame([], STORE).schema
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(path)
    return df.where(F.col("week").isin(*weeks)) if weeks else df


def read_collections(spark: SparkSession, path: str) -> DataFrame:
    """Per week: first and last collection, number of collections, articles added."""
    if not path_exists(spark, path):
        rows = spark.createDataFrame([], META)
    else:
        rows = spark.read.schema(META).parquet(path)
    return rows.groupBy("week").agg(F.min("at").alias("first_collection"), F.max("at").alias("last_collection"),
                                    F.count("*").alias("collections"), F.sum("added").alias("n_articles"))


def add_batch(batch: DataFrame, batch_id: int, store: str, meta: str, now: dt.datetime) -> None:
    """Insert the new articles of one micro-batch; only the partitions of accepted weeks are read."""
    spark = batch.sparkSession
    weeks = accepted_weeks(now)
    fresh = first_sightings(accept(batch, now))
    # rows of an earlier attempt at this batch do not count as stored
    known = read_store(spark, store, *weeks).where(F.col("batch") != batch_id).select("id")
    new = fresh.join(known, "id", "left_anti").withColumn("batch", F.lit(batch_id).cast("long"))
    columns = [f.name for f in spark.createDataFrame([], STORE).schema]
    (new.select(*columns).sortWithinPartitions("week", effective_date(), "id").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("week", "batch").parquet(store))
    written = read_store(spark, store, *weeks).where(F.col("batch") == batch_id).groupBy("week").agg(
        F.count("*").alias("added"))
    seen = fresh.select("week").distinct()
    (seen.join(written, "week", "left").fillna(0, ["added"])
     .withColumn("at", F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp"))
     .withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(meta))


def collect(spark: SparkSession, landed: str, store: str, meta: str, checkpoint: str, now: dt.datetime,
            max_files: int | None = None):
    """Process everything that has landed since the last call, then stop (the hourly run)."""
    reader = spark.readStream.schema(ITEM)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # the weeks follow processing time alone, and the store keeps ids apart: no watermark, no state in the stream
    query = (reader.parquet(landed).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
             .foreachBatch(lambda df, batch_id: add_batch(df, batch_id, store, meta, now)).start())
    query.awaitTermination()
    return query


def weekly_counts(articles: DataFrame, stamp: str = "effective_date", by: str = "outlet") -> DataFrame:
    """Articles per week and outlet; on a stream the watermark closes a week."""
    rows = articles.withWatermark(stamp, WATERMARK) if articles.isStreaming else articles
    return rows.groupBy(weekly_window(F.col(stamp)).alias("w"), by).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("week_start"), by, "n")
