"""Monitored media: weekly statistics from classified articles, and articles passed on to the main selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill import config
from pressmill.functions import text, urls
from pressmill.functions.keywords import Keywords, media_keywords
from pressmill.operators.common import clamp, lookup, top_per_group
from pressmill.operators.items import effective_date

GENRE_RANK = {"analyza": 0, "komentar": 1, "rozhovor": 2, "zprava": 3, "jine": 4}
# fixed values: media topic to topic of the main report (others: decarbonization_policy)
MAIN_TOPIC = {"ceny_energii": "energy_markets", "energeticka_bezpecnost": "energy_markets",
              "obnovitelne_zdroje": "technology", "jadro": "technology", "teplo_a_budovy": "decarbonization_policy"}


def candidates(articles: DataFrame, keywords: Keywords | None = None, max_classify: int = config.Media.max_classify,
               scope: str = "week") -> DataFrame:
    """Articles the wide keyword set finds, newest first up to the classification limit per week."""
    kw = keywords or media_keywords()
    found = (articles.where(~text.is_excluded(text.match_text(F.col("title")), kw))
             .where(text.matches(text.match_text(text.item_text(F.col("title"), F.col("summary_raw"))), kw)))
    return top_per_group(found, [scope], [F.desc(effective_date()), F.asc("id")], max_classify)


def clean_classes(found: DataFrame, classes: DataFrame | None) -> DataFrame:
    """Classes of ids that were asked for, tone in range; without a classifier every candidate gets a neutral class."""
    if classes is None:
        return found.select(F.col("id").alias("item_id"), F.lit(True).alias("relevant"), F.lit("jine").alias("topic"),
                            F.lit("neutralni_informovani").alias("frame"), F.lit("zprava").alias("genre"),
                            F.lit(0).alias("tone"))
    asked = found.select(F.col("id").alias("item_id")).distinct()
    return (classes.join(asked, "item_id", "left_semi")
            .withColumn("tone", clamp(F.col("tone").cast("int"), -2, 2)))


def unclassified(found: DataFrame, classes: DataFrame) -> DataFrame:
    return found.join(classes.select(F.col("item_id").alias("id")), "id", "left_anti")


def relevant_articles(found: DataFrame, classes: DataFrame) -> DataFrame:
    return found.join(classes.where("relevant").withColumnRenamed("item_id", "id").drop("relevant"), "id")


def outlet_stats(articles: DataFrame, scope: str = "week", outlet: str = "outlet") -> DataFrame:
    """Collected and relevant articles per outlet; column ``relevant`` marks the classified relevant ones."""
    return articles.groupBy(scope, outlet).agg(F.count("*").alias("collected"),
                                               F.count_if("relevant").alias("n_relevant"))


def distributions(relevant: DataFrame, scope: str = "week") -> DataFrame:
    """Counts by topic, by frame and by genre in one pass: week, dimension, value, n."""
    dims = ["topic", "frame", "genre"]
    sets = [[F.col(scope), F.col(d)] for d in dims]
    level = F.when(F.grouping("topic") == 0, "topic").when(F.grouping("frame") == 0, "frame").otherwise("genre")
    return (relevant.groupingSets(sets, F.col(scope), *[F.col(d) for d in dims])
            .agg(level.alias("dimension"), F.count("*").alias("n"))
            .select(scope, "dimension", F.coalesce(*dims).alias("value"), "n"))


def tone_index(relevant: DataFrame, scope: str = "week") -> DataFrame:
    mean = F.sum("tone") / F.count("*") * 50
    return relevant.groupBy(scope).agg(F.coalesce(F.bround(mean, 0).cast("int"), F.lit(0)).alias("tone_index"),
                                       F.count("*").alias("n_relevant"))


def top_values(dist: DataFrame, dimension: str, n: int, scope: str = "week") -> DataFrame:
    """Most frequent values; ties by name."""
    return top_per_group(dist.where(F.col("dimension") == dimension), [scope], [F.desc("n"), F.asc("value")], n, "place")


def context(relevant: DataFrame, scope: str = "week", outlet: str = "outlet") -> DataFrame:
    """Relevant articles, outlets with any, the three leading topics and the leading frame."""
    dist = distributions(relevant, scope)
    totals = (relevant.groupBy(scope, outlet).agg(F.count("*").alias("_n"))
              .groupBy(scope).agg(F.sum("_n").alias("n_relevant"), F.count("*").alias("n_outlets")))
    topics = top_values(dist, "topic", 3, scope).groupBy(scope).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda t: t["value"]).alias("top_topics"))
    frame = top_values(dist, "frame", 1, scope).select(scope, F.col("value").alias("leading_frame"))
    return totals.join(topics, scope, "left").join(frame, scope, "left")


def report(articles: DataFrame, relevant: DataFrame, n_candidates: DataFrame, scope: str = "week") -> DataFrame:
    """One row per week: the counts and the three distributions as maps."""
    dist = distributions(relevant, scope)

    def as_map(dimension: str):
        return F.map_from_entries(F.transform(
            F.array_sort(F.collect_list(F.when(F.col("dimension") == dimension, F.struct(
                (-F.col("n")).alias("o"), F.col("value"), F.col("n"))))), lambda e: F.struct(e["value"], e["n"])))

    maps = dist.groupBy(scope).agg(as_map("topic").alias("topics"), as_map("frame").alias("frames"),
                                   as_map("genre").alias("genres"))
    collected = articles.groupBy(scope).agg(F.count("*").alias("n_collected"))
    return (collected.join(n_candidates, scope, "left").join(tone_index(relevant, scope), scope, "left")
            .join(maps, scope, "left").fillna(0, ["n_candidates", "n_relevant", "tone_index"]))


def reading_list(relevant: DataFrame, n: int = config.Media.max_articles, scope: str = "week") -> DataFrame:
    """Comments, analyses and interviews before plain news, then newest first."""
    return top_per_group(relevant, [scope], [F.col("genre") == "zprava", F.desc(effective_date()), F.asc("id")], n,
                         "place")


def one_per_outlet(relevant: DataFrame, selected: DataFrame, n: int = config.Selection.media_items,
                   scope: str = "week", outlet: str = "outlet") -> DataFrame:
    """At most one article per outlet for the main selection: leading topics first, analyses before news, newest.

    Rows the walk would skip (address already selected, no summary) leave first, so the first row per outlet is final.
    """
    top = top_values(distributions(relevant, scope), "topic", 3, scope).select(
        scope, F.col("value").alias("topic"), (F.col("place") - 1).alias("_topic"))
    taken = selected.select(F.col(scope), urls.normalize_url(F.col("url")).alias("_url")).distinct()
    rows = (relevant.withColumn("_url", urls.normalize_url(F.col("url"))).join(taken, [scope, "_url"], "left_anti")
            .where(F.trim(F.coalesce("summary_raw", F.lit(""))) != "").join(top, [scope, "topic"], "left"))
    order = [F.coalesce("_topic", F.lit(9)), lookup(GENRE_RANK, F.col("genre"), 9), F.desc(effective_date()), F.asc("id")]
    first = top_per_group(rows, [scope, outlet], order, 1)
    return top_per_group(first, [scope], order, n).drop("_url", "_topic")


def as_scored(picked: DataFrame, weights: config.ScoreWeights = config.ScoreWeights()) -> DataFrame:
    """Media articles with the fixed score they enter the main selection with."""
    from pressmill.operators.score import final_score

    rows = picked.withColumns({
        "relevance": F.lit(6), "topics": F.array(lookup(MAIN_TOPIC, F.col("topic"), "decarbonization_policy")),
        "geo_focus": F.lit("CZ"), "is_public_attitudes_or_communication": F.lit(False),
        "is_original_research": F.lit(False), "relevant_to_cz_eu": F.lit(True), "cz_impact": F.lit(3),
        "eu_impact": F.lit(1), "is_opinion": F.col("genre") == "komentar", "is_event": F.lit(False),
        "title_cs": F.lit(""), "one_line_cs": F.substring("summary_raw", 1, 180), "sentiment": F.col("tone")})
    return rows.withColumn("final_score", final_score(weights))
