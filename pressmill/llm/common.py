"""Helpers of the operators in this folder: inputs, connected components, block results."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.session import cut_lineage


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder; the shuffle files of what led to it are gone afterwards."""
    return cut_lineage(df)


def pieces(rows: float, per_piece: float, least: int = 1) -> int:
    """How many pieces of about ``per_piece`` rows there are in ``rows``; grows in proportion to the rows."""
    return max(least, math.ceil(rows / per_piece))


def words(text: Column) -> Column:
    """White-space separated words (ASCII white space), without empty ones."""
    return F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node reachable over the links (left[k], right[k])."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label, new)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) of every id named in ``links(a, b)``; component_id is the smallest id of the component.

    Alternates two star contractions: each id sends its larger neighbours to the smallest neighbour, then its smaller
    ones. The number of rounds grows with the logarithm of the longest path. A hub is aggregated before the shuffle, and
    its join is a sort-merge join that AQE may split. Null ends and loops are ignored; no links give no rows.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("u <> v").distinct())
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state or now[0] == 0:
            break
        state = tuple(now)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = written(small.where("u <> v").distinct())
    roots = edges.groupBy("v").agg(F.min("v").alias("component_id")).select(F.col("v").alias("id"), "component_id")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(roots)


def dealt(buckets: np.ndarray, n: int, arrays: list[np.ndarray]):
    """Entries dealt out to their buckets: (bucket, bytes of each array's part), in the order they came."""
    order = np.argsort(buckets, kind="stable")
    ends = np.searchsorted(buckets[order], np.arange(n + 1))
    parts = [a[order] for a in arrays]
    for b in np.flatnonzero(ends[1:] > ends[:-1]):
        yield int(b), [p[ends[b]:ends[b + 1]].tobytes() for p in parts]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: neighbouring or related numbers get unrelated bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
