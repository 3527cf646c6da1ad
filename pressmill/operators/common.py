"""Small building blocks used by many operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressmill.session import cut_lineage

# Spark keeps a literal "row_number() <= n" within each input partition, before the shuffle, up to this n
PUSHED_LIMIT = 1000
SALTS = 64


def top_per_group(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int | Column,
                  rank_name: str | None = None, salt_by: str | None = None) -> DataFrame:
    """The first ``n`` rows per group.

    A small literal ``n`` is cut inside each input partition before the shuffle. A larger one, or one that differs by
    row, is first cut inside salted sub-groups, so a group with a third of all rows is not sorted by one task.
    """
    name = rank_name or "_n"
    literal = isinstance(n, int) and n <= PUSHED_LIMIT
    if not literal and salt_by:
        salted = Window.partitionBy(*keys, F.pmod(F.xxhash64(salt_by), F.lit(SALTS))).orderBy(*order)
        df = df.withColumn(name, F.row_number().over(salted)).where(F.col(name) <= n)
    w = Window.partitionBy(*keys).orderBy(*order)
    df = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return df if rank_name else df.drop(name)


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is evaluated once a row: conditions on it don't go below it, each with a copy of its expression."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def running_sums(df: DataFrame, scope: str, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds, for each of ``sums``, its total over the rows of the scope up to this one; ``order`` is a total order.

    Two passes: rows are dealt out by ranges of scope and order, and each task's part is summed on its own; the totals of the
    parts (one short row per part and scope) are added up and joined back. So a scope of any size is no single task.
    """
    rows = cut_lineage(df.withColumns({f"_v_{n}": c for n, c in sums.items()}))  # the ranges are found by sampling: not over the whole plan
    keys = [F.asc(scope), *order]
    parts = cut_lineage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
                        .withColumn("_part", F.shiftright("_row", 33)))
    here = Window.partitionBy(scope, "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("_of").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy(F.col(scope).alias("_of"), F.col("_part").alias("_in")).agg(*(F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums))
    totals = totals.select("_of", "_in", *(F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums))
    joined = parts.withColumns({f"_h_{n}": F.sum(f"_v_{n}").over(here) for n in sums}).join(
        totals, F.col(scope).eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_in")))
    return joined.select(*df.columns, *((F.col(f"_h_{n}") + F.col(f"_b_{n}")).alias(n) for n in sums))


def region_rank(region: Column) -> Column:
    return (F.when(region == "CZ", 0).when(region == "EU", 1).when(region == "US", 2)
            .when(region == "GLOBAL", 3).otherwise(9))


def lookup(table: dict, key: Column, default) -> Column:
    """A small literal map as an expression."""
    expr = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(expr, key), F.lit(default))


def clamp(value: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def distinct_first(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per key, the first in ``order`` (dropDuplicates has no order)."""
    return top_per_group(df, [key], order, 1)
