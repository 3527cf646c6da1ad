"""Weighted sentiment of a week, in total and by region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill import config
from pressmill.operators.common import region_rank
from pressmill.operators.score import rank_key

# fixed values: upper bounds and labels of the index bands
BANDS = [(-40, "spíše nepříznivá"), (-10, "mírně nepříznivá"), (10, "přibližně vyrovnaná"), (40, "mírně příznivá")]
TOP_BAND = "spíše příznivá"


def index_label(index: Column) -> Column:
    (a, la), (b, lb), (c, lc), (d, ld) = BANDS
    return (F.when(index <= a, la).when(index <= b, lb).when(index < c, lc).when(index < d, ld).otherwise(TOP_BAND))


def rated(scored: DataFrame, min_relevance: int = config.Selection.min_relevance) -> DataFrame:
    """Externally scored, relevant rows."""
    return scored.where((F.col("scored_by") == "llm") & (F.col("relevance") >= min_relevance))


def sentiment(rows: DataFrame, scope: str = "week", min_rows: int = config.SENTIMENT_MIN_ROWS) -> DataFrame:
    """One row per week (region null) and per week and region: n, index, negative, neutral, positive, label.

    ``rows``: week, id, final_score, sentiment, geo_focus. Weeks with fewer rows than ``min_rows`` give nothing.
    Both levels come from one pass of grouping sets.
    """
    rows = rows.withColumn("_w", F.greatest(F.col("final_score"), F.lit(config.SENTIMENT_WEIGHT_FLOOR)))
    total, v = F.sum("_w"), F.col("sentiment")
    neg = F.sum(F.when(v < 0, F.col("_w")).otherwise(0.0)) / total
    pos = F.sum(F.when(v > 0, F.col("_w")).otherwise(0.0)) / total
    levels = (rows.groupingSets([[F.col(scope)], [F.col(scope), F.col("geo_focus")]], F.col(scope), F.col("geo_focus"))
              .agg(F.grouping("geo_focus").alias("_whole"), F.count("*").alias("n"),
                   F.bround(F.sum(F.col("_w") * v) / total / 2 * 100, 0).cast("int").alias("index"),
                   F.bround(neg, 3).alias("negative"), F.bround(1 - neg - pos, 3).alias("neutral"),
                   F.bround(pos, 3).alias("positive")))
    enough = levels.where((F.col("_whole") == 1) & (F.col("n") >= min_rows)).select(scope)
    return (levels.join(enough, scope, "left_semi")
            .select(scope, F.when(F.col("_whole") == 0, F.col("geo_focus")).alias("region"), "n", "index", "negative",
                    "neutral", "positive", index_label(F.col("index")).alias("label"),
                    F.when(F.col("_whole") == 1, -1).otherwise(region_rank(F.col("geo_focus"))).alias("position")))


def extremes(rows: DataFrame, scope: str = "week") -> DataFrame:
    """Most positive and most negative pickable item per week: strongest value, then the order of ranks."""
    v, first = F.col("sentiment"), rank_key().alias("rank")
    best, worst = F.struct((-v).alias("v"), first, F.col("id")), F.struct(v.alias("v"), first, F.col("id"))
    return rows.groupBy(scope).agg(
        F.min(F.when(v > 0, best))["id"].alias("most_positive_id"),
        F.min(F.when(v < 0, worst))["id"].alias("most_negative_id"))


def summary(rows: DataFrame, pickable: DataFrame, scope: str = "week") -> DataFrame:
    """One row per week: total, regions in fixed order, extreme items among the ``pickable`` ids."""
    levels = sentiment(rows, scope)
    regions = levels.where("region is not null").groupBy(scope).agg(F.array_sort(F.collect_list(
        F.struct("position", "region", "n", "index", "negative", "neutral", "positive"))).alias("by_region"))
    picks = extremes(rows.join(pickable.select("id").distinct(), "id", "left_semi"), scope)
    return (levels.where("region is null").drop("region", "position").join(regions, scope, "left")
            .join(picks, scope, "left"))


def domestic_points(levels: DataFrame, topics: DataFrame, scope: str = "week", min_rows: int = 3) -> DataFrame:
    """The domestic row of each week with the week's top topic."""
    rows = levels.where((F.col("region") == "CZ") & (F.col("n") >= min_rows))
    return rows.join(topics.select(scope, "topic"), scope, "left").select(scope, "index", "n", "negative", "neutral", "positive", "topic")


def trend(points: DataFrame, value: str, length: int, scope: str = "week") -> DataFrame:
    """Per week: the previous value and the last ``length`` values up to it. One row per week goes through here."""
    from pyspark.sql.window import Window

    w = Window.partitionBy(F.lit(1)).orderBy(scope)  # a week list, a few hundred rows
    return points.select(
        scope, value, F.lag(value).over(w).alias("previous"),
        F.collect_list(F.struct(scope, value)).over(w.rowsBetween(-(length - 1), 0)).alias("trend"))
