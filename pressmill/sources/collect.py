"""Collectors: functions from the registry and the time of the run to the items found and the health of every source asked."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill import schemas
from pressmill.operators.health import disabled_rows, source_health
from pressmill.operators.items import unite
from pressmill.sources import feeds

#: (sources, now) -> (items, healths); ``healths`` has the columns of ``schemas.HEALTH``
Collector = Callable[[DataFrame, dt.datetime], tuple[DataFrame, DataFrame]]

FEED_TYPES = ("rss", "wp_json")


def from_payloads(payloads: DataFrame) -> Collector:
    """Reads the landed payloads of feed and WordPress sources, each once; items and healths come from the same parse.

    Disabled sources give no items and a row that says so. Sources of other types are left to other collectors.
    """
    def collect(sources: DataFrame, now: dt.datetime) -> tuple[DataFrame, DataFrame]:
        mine = sources.where(F.col("type").isin(*FEED_TYPES))
        asked = mine.where("enabled")
        items, problems = feeds.feed_items(payloads, asked)
        found = source_health(asked.withColumnRenamed("id", "source_id"), items, now, problems)
        columns = items.sparkSession.createDataFrame([], schemas.HEALTH).columns
        return items.drop("payload_id"), found.select(columns).unionByName(disabled_rows(mine, now).select(columns))

    return collect


def together(*collectors: Collector) -> Collector:
    """Several collectors as one."""
    def collect(sources: DataFrame, now: dt.datetime) -> tuple[DataFrame, DataFrame]:
        found = [c(sources, now) for c in collectors]
        return unite(*(items for items, _ in found)), reduce(DataFrame.unionByName, (healths for _, healths in found))

    return collect
