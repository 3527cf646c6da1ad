"""Prefilter, heuristic score, additive final score and ranking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill import config
from pressmill.functions import text
from pressmill.functions.keywords import Keywords, default_keywords
from pressmill.operators.common import clamp, lookup, running_sums, top_per_group
from pressmill.operators.items import effective_date

MAX_TOPICS = 4
DEFAULT_TOPIC = "decarbonization_policy"
SHORT_SUMMARY = 180
MATCH_TEXT = "match_text"
RESEARCH_TYPES = ("research", "polling", "journal")

SCORE_COLUMNS = ["relevance", "topics", "geo_focus", "is_public_attitudes_or_communication", "is_original_research",
                 "relevant_to_cz_eu", "cz_impact", "eu_impact", "is_opinion", "is_event", "title_cs", "one_line_cs",
                 "sentiment"]


def with_match_text(items: DataFrame) -> DataFrame:
    """Adds ``match_text``, title and summary as keywords are looked up in them, if the items don't have it.

    It is the element of a one-element array: conditions on it then stay above, so that the text is folded once a row.
    """
    if MATCH_TEXT in items.columns:
        return items
    norm = text.match_text(text.item_text(F.col("title"), F.col("summary_raw")))
    return items.select("*", F.explode(F.array(norm)).alias(MATCH_TEXT))


def prefilter(items: DataFrame, keywords: Keywords | None = None) -> DataFrame:
    """Drop advertisements; keep unfiltered sources, and others when title or summary holds a keyword."""
    kw = keywords or default_keywords()
    excluded = text.is_excluded(text.match_text(F.col("title")), kw)
    rows = with_match_text(items.where(~excluded))
    return rows.where(~F.col("topic_filter") | text.matches(F.col(MATCH_TEXT), kw)).select(*items.columns)


def heuristic_score(items: DataFrame, keywords: Keywords | None = None) -> DataFrame:
    """Adds the score columns from keyword hits, categories, source type and domestic markers."""
    kw = keywords or default_keywords()
    norm, windows = F.col(MATCH_TEXT), F.col("_windows")
    rows = with_match_text(items).select("*", F.explode(F.array(text.keyword_windows(norm, kw))).alias("_windows"))
    rows = (rows.withColumn("_hits", text.hit_count(norm, kw, windows)).withColumn("_cats", text.categories(norm, kw, windows))
            .withColumn("is_event", text.looks_like_event(F.col("title"))))
    topics = F.when(F.size("_cats") == 0, F.array(F.lit(DEFAULT_TOPIC))).otherwise(F.col("_cats"))
    attitudes = F.array_contains(topics, "public_attitudes") | F.array_contains(topics, "communication")
    base = (F.lit(2) + F.least(F.col("_hits"), F.lit(5)) + F.when(attitudes, 2).otherwise(0)
            + F.when(F.col("source_type").isin("research", "polling"), 1).otherwise(0)
            + F.when(F.col("topic_filter"), 0).otherwise(1))
    geo = F.when((F.col("region") != "CZ") & text.has_domestic_marker(norm, kw), F.lit("CZ")).otherwise(F.col("region"))
    summary = F.coalesce("summary_raw", F.lit(""))
    line = (F.when(F.length(summary) > SHORT_SUMMARY, F.concat(F.substring(summary, 1, SHORT_SUMMARY), F.lit("…")))
            .when(summary != "", summary).otherwise(F.col("title")))
    return rows.select(
        *[c for c in items.columns if c != MATCH_TEXT], clamp(base, 0, 10).alias("relevance"),
        F.slice(F.array_distinct(topics), 1, MAX_TOPICS).alias("topics"), geo.alias("geo_focus"),
        (attitudes & ~F.col("is_event")).alias("is_public_attitudes_or_communication"),
        (F.col("source_type").isin(*RESEARCH_TYPES) & ~F.col("is_event")).alias("is_original_research"),
        F.col("region").isin("CZ", "EU").alias("relevant_to_cz_eu"),
        F.when(geo == "CZ", 2).otherwise(0).alias("cz_impact"),
        F.when(geo.isin("CZ", "EU"), 2).otherwise(0).alias("eu_impact"),
        F.lit(False).alias("is_opinion"), "is_event", F.lit("").alias("title_cs"), line.alias("one_line_cs"),
        F.lit(0).alias("sentiment"))


def _sanitized(given: Callable[[str], Column]) -> dict[str, Column]:
    event = F.coalesce(given("is_event"), F.lit(False)) | text.looks_like_event(F.col("title"))
    topics = F.coalesce(given("topics"), F.array().cast("array<string>"))
    return {
        "relevance": clamp(given("relevance").cast("int"), 0, 10),
        "sentiment": clamp(given("sentiment").cast("int"), -2, 2),
        "cz_impact": clamp(given("cz_impact").cast("int"), 0, 3),
        "eu_impact": clamp(given("eu_impact").cast("int"), 0, 3),
        "topics": F.when(F.size(topics) == 0, F.array(F.lit(DEFAULT_TOPIC))).otherwise(F.array_distinct(topics)),
        "title_cs": F.when(F.col("language") == "cs", "").otherwise(given("title_cs")),
        "is_event": event,
        "is_public_attitudes_or_communication": given("is_public_attitudes_or_communication") & ~event,
        "is_original_research": given("is_original_research") & ~event,
    }


def sanitize(scored: DataFrame) -> DataFrame:
    """Bring supplied scores into their ranges; events lose two flags, domestic rows need no translation."""
    return scored.withColumns(_sanitized(F.col))


def final_score(weights: config.ScoreWeights = config.ScoreWeights()) -> Column:
    """Relevance plus points for impact, region, source type and source weight, plus bonuses; events get none."""
    value = (F.col("relevance").cast("double") + F.lit(weights.domestic_impact) * F.col("cz_impact")
             + F.lit(weights.eu_impact) * F.col("eu_impact") + lookup(weights.geo, F.col("geo_focus"), 0.0)
             + lookup(weights.source_type, F.col("source_type"), 0.0)
             + F.lit(weights.source_weight) * (F.col("source_weight") - F.lit(1.0)))
    bonus = (value
             + F.when(F.col("is_public_attitudes_or_communication"), weights.attitudes).otherwise(0.0)
             + F.when(F.col("is_original_research"), weights.research).otherwise(0.0)
             + F.when(F.col("is_opinion"), weights.opinion).otherwise(0.0))
    return F.bround(F.when(F.col("is_event"), value + F.lit(weights.event)).otherwise(bonus), 4)


def is_domestic() -> Column:
    return (F.col("geo_focus") == "CZ") | (F.col("cz_impact") >= 2)


def rank_columns() -> list[Column]:
    """Score, domestic impact, newer first, id: a total order."""
    return [F.desc("final_score"), F.desc("cz_impact"), F.desc(effective_date()), F.asc("id")]


def rank_key() -> Column:
    """The same order as one text (scores have four digits)."""
    score = (F.lit(10 ** 9) - F.round(F.col("final_score") * 10000)).cast("long")
    stamp = F.lit(10 ** 17) - F.unix_micros(effective_date().cast("timestamp"))
    return F.concat(F.lpad(score.cast("string"), 12, "0"), (9 - F.col("cz_impact")).cast("string"),
                    F.lpad(stamp.cast("string"), 18, "0"), F.lit(" "), F.col("id").cast("string"))


def score_items(items: DataFrame, supplied: DataFrame | None = None, keywords: Keywords | None = None,
                max_supplied: int | None = None, weights: config.ScoreWeights = config.ScoreWeights()) -> DataFrame:
    """Items with score columns, final_score and scored_by.

    ``supplied`` holds scores from outside (item_id and score columns, for instance a user's Pandas UDF); items
    without one, and with ``max_supplied`` those ranked below it by the heuristic, get the heuristic score.
    """
    heuristic = heuristic_score(items, keywords).withColumn("final_score", final_score(weights))
    if supplied is None:
        return heuristic.withColumn("scored_by", F.lit("heuristic"))
    given = supplied.select("item_id", F.struct(*SCORE_COLUMNS).alias("_given"))
    rows = heuristic.join(given, heuristic["id"] == given["item_id"], "left").drop("item_id")
    if max_supplied is not None:
        sent = queue(heuristic, max_supplied).select("id").withColumn("_sent", F.lit(True))
        rows = rows.join(sent, "id", "left").withColumn("_given", F.when("_sent", F.col("_given"))).drop("_sent")
    def given_score(name: str) -> Column:
        return F.col("_given")[name]

    # the choice is made by row: two filtered branches would read the items and match their words twice
    supplied_here, clean = F.col("_given").isNotNull(), _sanitized(given_score)
    chosen = rows.withColumns({c: F.when(supplied_here, clean.get(c, given_score(c))).otherwise(F.col(c)) for c in SCORE_COLUMNS}
                              | {"scored_by": F.when(supplied_here, "llm").otherwise("heuristic")})
    return chosen.withColumn("final_score", final_score(weights)).drop("_given")


def queue(heuristic: DataFrame, n: int) -> DataFrame:
    """The best ``n`` by heuristic score, for an expensive scorer."""
    return heuristic.orderBy(F.desc("final_score"), "id").limit(n)


def top_per_source(scored: DataFrame, n: int) -> DataFrame:
    return top_per_group(scored, ["source_id"], rank_columns(), n, "rank_in_source")


def quota_counts(selected: DataFrame) -> DataFrame:
    return selected.agg(F.count("*").alias("n_selected"), F.count_if(is_domestic()).alias("n_domestic"),
                        F.count_if("is_public_attitudes_or_communication").alias("n_attitudes"))


def budget_prefix(batches: DataFrame, spent: str, budget: float, scope: str) -> DataFrame:
    """Batches before the first one whose running estimate would pass the budget; one row per batch."""
    return running_sums(batches, scope, [F.asc("batch_no")], {"running": F.col(spent)}).where(F.col("running") <= budget)


def saved_scores(scored: DataFrame, selected: DataFrame) -> DataFrame:
    """Every candidate with its score and whether it was selected."""
    mark = selected.select("id").distinct().withColumn("_sel", F.lit(True))
    return (scored.join(mark, "id", "left").withColumn("selected", F.coalesce("_sel", F.lit(False)))
            .withColumn("has_summary", F.trim(F.coalesce("summary_raw", F.lit(""))) != "").drop("_sel"))
