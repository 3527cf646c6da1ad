"""Checking scores against human coders: a stratified sample, and Cohen's kappa."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill import config


def sample_order(seed: int, purpose: str) -> Column:
    """A reproducible random order: the hash of id, seed and purpose; ties by id."""
    return F.md5(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(seed)), F.lit(purpose)))


def stratified_sample(scored: DataFrame, n: int, seed: int = config.VALIDATION_SEED) -> DataFrame:
    """Half selected, half other candidates (more of the latter if the former run out), with a shuffled position.

    Each half is a top-k by hash, so no task sorts the whole table. Members differ from other generators' draws.
    """
    from pyspark.sql.window import Window

    rows = scored.withColumn("_draw", sample_order(seed, "draw"))
    chosen = rows.where("selected").orderBy("_draw", "id").limit(n // 2)
    # the second half fills up to n; the size of the first is one number
    k = chosen.agg(F.count("*").alias("k"))
    rest = rows.where("not selected").orderBy("_draw", "id").limit(n)
    rest = (rest.withColumn("_n", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("_draw", "id")))
            .join(F.broadcast(k), F.col("_n") <= F.lit(n) - F.col("k")).drop("_n", "k"))
    both = chosen.unionByName(rest).withColumn("_draw", sample_order(seed, "shuffle"))  # at most n rows
    return both.withColumn("position", F.row_number().over(
        Window.partitionBy(F.lit(1)).orderBy("_draw", "id"))).drop("_draw")


def coder_sheet(sample: DataFrame) -> DataFrame:
    """What coders see: no model score, empty answer columns."""
    empty = F.lit("")
    return sample.orderBy("position").select(
        "id", F.col("title").alias("titulek"), F.col("source_id").alias("zdroj"), F.col("url").alias("odkaz"),
        F.substring(F.coalesce("summary_raw", empty), 1, 500).alias("vytah"), empty.alias("A_relevantni"),
        empty.alias("A_geo"), empty.alias("B_relevantni"), empty.alias("B_geo"))


def score_sheet(sample: DataFrame) -> DataFrame:
    return sample.orderBy("position").select("id", "relevance", F.col("geo_focus").alias("geo"),
                                             F.col("selected").cast("int").alias("vybrano"))


def yes_no(value: Column) -> Column:
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return F.when(v.isin("ano", "a", "1", "yes"), "1").when(v.isin("ne", "n", "0", "no"), "0").otherwise("")


def kappa(pairs: DataFrame, group: str = "pair") -> DataFrame:
    """Cohen's kappa per group of answer pairs (columns a, b); blanks are left out.

    The confusion matrix is built first (combined before the shuffle); everything else works on its few cells.
    """
    cells = (pairs.where("a <> '' and b <> ''").groupBy(group, "a", "b").agg(F.count("*").alias("n")))
    total = cells.groupBy(group).agg(F.sum("n").alias("total"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n"))
                                                                      .otherwise(0)).alias("same"))
    side_a = cells.groupBy(group, F.col("a").alias("v")).agg(F.sum("n").alias("na"))
    side_b = cells.groupBy(group, F.col("b").alias("v")).agg(F.sum("n").alias("nb"))
    chance = side_a.join(side_b, [group, "v"]).groupBy(group).agg(F.sum(F.col("na") * F.col("nb")).alias("chance"))
    rows = total.join(chance, group, "left").fillna(0, ["chance"])
    n2 = F.col("total") * F.col("total")
    po, pe = F.col("same") / F.col("total"), F.col("chance") / n2
    value = (F.when(F.col("chance") >= n2, F.when(F.col("same") == F.col("total"), 1.0))
             .otherwise(F.bround((po - pe) / (1 - pe), 3)))
    listed = pairs.select(group).distinct()
    return listed.join(rows.select(group, F.col("total").alias("n"), value.alias("kappa")), group, "left")


def agreement(sheet: DataFrame, scores: DataFrame) -> DataFrame:
    """The six agreements between coders A and B and the model, one row per pair. Items without a score stay blank."""
    model = scores.select("id", F.when(F.col("relevance").cast("int") >= config.VALIDATION_RELEVANT_FROM, "1").otherwise(
        "0").alias("m_rel"), F.coalesce("geo", F.lit("")).alias("m_geo"))
    upper = lambda c: F.upper(F.trim(F.coalesce(c, F.lit(""))))
    rows = (sheet.join(model, "id", "left").select(
        yes_no(F.col("A_relevantni")).alias("ra"), yes_no(F.col("B_relevantni")).alias("rb"),
        upper("A_geo").alias("ga"), upper("B_geo").alias("gb"), F.coalesce("m_rel", F.lit("")).alias("rm"),
        F.coalesce("m_geo", F.lit("")).alias("gm")))
    pairs = rows.selectExpr("""stack(6, 'relevance A-B', ra, rb, 'geo A-B', ga, gb, 'relevance A-model', ra, rm,
        'relevance B-model', rb, rm, 'geo A-model', ga, gm, 'geo B-model', gb, gm) as (pair, a, b)""")
    return kappa(pairs)
