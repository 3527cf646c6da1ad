"""Cost of scorer calls: price lookup by name or prefix, totals, token estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill import config

CHARS_PER_TOKEN = 3.2


def estimate_tokens(text: Column) -> Column:
    return (F.length(F.coalesce(text, F.lit(""))) / CHARS_PER_TOKEN).cast("int") + 1


def priced_models(models: DataFrame, prices: DataFrame) -> DataFrame:
    """Each distinct model name with its price: exact name, else the first listed name it begins with, else the dearest.

    ``prices``: position, name, input, output, cache_write, cache_read. A model meets a price by equality with one of its
    own beginnings, so a long price list is an ordinary join.
    """
    value = F.struct("input", "output", "cache_write", "cache_read")
    distinct = models.select("model").distinct()
    beginnings = distinct.withColumn("name", F.explode(F.transform(F.sequence(F.lit(0), F.length("model")), lambda n: F.left("model", n))))
    fits = beginnings.join(prices, "name")
    best = fits.groupBy("model").agg(F.min_by(value, F.struct(F.col("model") != F.col("name"), "position")).alias("_p"))
    dearest = prices.agg(F.max_by(value, F.struct("output", -F.col("position"))).alias("_d")).withColumn("_one", F.lit(1))
    rows = distinct.join(best, "model", "left").withColumn("_one", F.lit(1)).join(F.broadcast(dearest), "_one", "left")
    return rows.select("model", F.coalesce("_p", "_d").alias("price")).select("model", "price.*")


def call_costs(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """Calls with cost_usd. ``calls``: model, input_tokens, output_tokens, cache_write_tokens, cache_read_tokens."""
    rows = calls.join(priced_models(calls, prices), "model", "left")
    write = F.coalesce("cache_write", F.col("input") * config.CACHE_WRITE_FACTOR)
    read = F.coalesce("cache_read", F.col("input") * config.CACHE_READ_FACTOR)
    cost = (F.col("input_tokens") * F.col("input") + F.col("output_tokens") * F.col("output")
            + F.col("cache_write_tokens") * write + F.col("cache_read_tokens") * read) / 1_000_000
    return rows.withColumn("cost_usd", F.coalesce(cost, F.lit(0.0))).drop("input", "output", "cache_write", "cache_read")


def usage_totals(costed: DataFrame) -> DataFrame:
    """Totals (model null) and per model in one pass."""
    tokens_in = F.sum("input_tokens")
    whole = F.grouping("model") == 1
    return (costed.rollup("model").agg(
        F.grouping("model").alias("is_total"), F.count("*").alias("calls"),
        F.when(whole, tokens_in).otherwise(tokens_in + F.sum("cache_write_tokens") + F.sum("cache_read_tokens")).alias(
            "input_tokens"),
        F.sum("output_tokens").alias("output_tokens"), F.bround(F.sum("cost_usd"), 6).alias("cost_usd")))
