"""The weekly run: items in, selection, statistics and new state out."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill import config, schemas
from pressmill.functions.dates import deadline_window, week_bounds
from pressmill.functions.keywords import Keywords
from pressmill.operators import calls, dedup, health, media, report, review, score, select, sentiment, window
from pressmill.operators.items import ITEM_COLUMNS, merge_with_stored, news_only
from pressmill.session import cut_lineage
from pressmill.sources import store
from pressmill.sources.collect import Collector


@dataclass
class Week:
    """Tables of one run."""

    windowed: DataFrame
    candidates: DataFrame
    scored: DataFrame
    selected: DataFrame
    placed: DataFrame


def prepare(fresh: DataFrame, stored: DataFrame, seen: DataFrame, sources: DataFrame, week: str,
            supplied: DataFrame | None = None, keywords: Keywords | None = None,
            sel: config.Selection = config.Selection()) -> Week:
    """Merge, window, de-duplicate, prefilter, score and select. ``supplied`` are scores from outside."""
    items = news_only(merge_with_stored(fresh, stored))
    if "arrival" not in items.columns:
        # the place in the feed decides among items of one fetch; stored rows, without one, come first
        place = F.col("feed_pos").cast("long") if "feed_pos" in items.columns else F.lit(None).cast("long")
        items = items.withColumn("arrival", F.struct(F.col("first_seen").alias("seen"), place.alias("place")))
    placed = cut_lineage(window.select_window(items, seen, week, sel.undated_first_run_cap).withColumn("week", F.lit(week)))
    windowed = cut_lineage(dedup.deduplicate(placed.where("placement = 'window'"), sel.title_threshold))
    candidates = score.prefilter(windowed, keywords)
    scored = cut_lineage(select.with_organisation(
        score.score_items(candidates, supplied, keywords), sources))
    selected = select.select_balanced(scored, sel)
    kept = windowed.select("id").withColumn("_k", F.lit(True))
    # copies dropped as duplicates leave no mark
    marked = placed.join(kept, "id", "left").where("placement = 'suppressed' or _k").drop("_k")
    return Week(windowed, candidates, scored, selected, marked)


def call_section(fresh: DataFrame, sources: DataFrame, seen: DataFrame, drafts: DataFrame | None, now: dt.datetime, week: str,
                 settings: config.Calls = config.Calls()) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """The pool of calls, the drafts checked against it, and the memory of the week's calls.

    ``drafts`` (pos, item_id, funder, deadline) are written from the pool by whoever writes the report. Only drafts that the
    report shows are remembered; without drafts nothing is shown, and the pool comes back whole.
    """
    ref = week_bounds(week)[1]
    shown = seen.where("kind = 'opportunity'").select("key", "week")
    pool = calls.call_pool(fresh, sources, shown, now, week, ref, settings)
    if drafts is None:
        return pool, None, seen.limit(0)
    checked = cut_lineage(calls.check_drafts(drafts, pool, *deadline_window(ref, settings.max_months), settings))
    marks = checked.where("outcome = 'shown'").select(F.lit("opportunity").alias("kind"), F.col("item_id").alias("key"), F.lit(week).alias("week"))
    return pool, checked, marks


def collected(spark: SparkSession, base: str, collector: Collector, sources: DataFrame, now: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """The collector's items, and its healths merged into the last known ones."""
    items, healths = collector(sources, now)
    known = store.load_state(spark, f"{base}/health", schemas.HEALTH)
    return cut_lineage(items), cut_lineage(health.merge_health(known, healths, sources))


def run_week(spark: SparkSession, base: str, fresh: DataFrame | Collector, sources: DataFrame, week: str, now: dt.datetime,
             supplied: DataFrame | None = None, media_articles: DataFrame | None = None,
             media_classes: DataFrame | None = None, keywords: Keywords | None = None, dry_run: bool = False,
             sel: config.Selection = config.Selection(), drafts: DataFrame | None = None,
             sections: DataFrame | None = None) -> dict[str, DataFrame]:
    """One run with its tables under ``base``. A dry run writes the week's tables but no state between weeks.

    ``fresh`` are the items found, or a collector that finds them (see ``sources.collect``); its healths are kept as state.
    ``drafts`` are drafted calls (see ``call_section``); those that are shown come back later only as reminders.
    ``sections`` (section, pos, text, geo, dated, evidence_ids) is the report drafted from the selected items; it comes back
    checked (see ``report.checked_report``), or without rows if it is rejected: then ``fallback`` is what is shown.

    A second run of the same week reads the same items (stored rows win) and gives the same result.
    """
    out: dict[str, DataFrame] = {}
    if not isinstance(fresh, DataFrame):
        fresh, out["health"] = collected(spark, base, fresh, sources, now)
        if not dry_run:
            store.save_state(out["health"], f"{base}/health")
    seen = store.load_state(spark, f"{base}/seen", schemas.SEEN)
    stored = store.read_weeks(spark, f"{base}/items", schemas.ITEM, week).drop("week")
    data = prepare(fresh, stored, seen, sources, week, supplied, keywords, sel)
    store.write_week(data.windowed.select(*ITEM_COLUMNS, "week"), f"{base}/items", week)

    selected = data.selected
    out["scored"] = data.scored
    if media_articles is not None:
        found = media.candidates(media_articles, max_classify=config.Media.max_classify)
        relevant = media.relevant_articles(found, media.clean_classes(found, media_classes))
        counts = found.groupBy("week").agg(F.count("*").alias("n_candidates"))
        out["media"] = media.report(media_articles, relevant, counts)
        extra = media.as_scored(media.one_per_outlet(relevant, selected))
        selected = selected.unionByName(extra.withColumn("scored_by", F.lit("llm")).withColumn("org", F.col("source_id")),
                                        allowMissingColumns=True)
    selected = cut_lineage(selected)
    scores = score.saved_scores(data.scored, selected)
    store.write_week(scores, f"{base}/scores", week)
    rated = sentiment.rated(data.scored).select("week", "id", "final_score", "sentiment", "geo_focus", "cz_impact",
                                                 "published_at", "first_seen")
    out["selected"] = select.presentation_order(selected)
    out["scores"] = scores
    out["sentiment"] = sentiment.summary(rated, selected)
    out["fallback"] = report.fallback_list(selected)
    if sections is not None:
        this = spark.createDataFrame([(week,)], "week string")
        checked, _ = report.checked_report(sections.withColumn("week", F.lit(week)), selected.withColumn("week", F.lit(week)), this)
        out["sections"] = cut_lineage(checked)
    out["call_pool"], checked, call_marks = call_section(fresh, sources, seen, drafts, now, week)
    if checked is not None:
        out["calls"] = checked
    if dry_run:
        return out

    week_items = data.windowed.withColumn("week", F.lit(week))
    perf = review.performance(week_items, selected.withColumn("week", F.lit(week)),
                              data.candidates.withColumn("week", F.lit(week)),
                              fresh.select(F.lit(week).alias("week"), "source_id"))
    earlier = store.load_state(spark, f"{base}/performance", schemas.PERFORMANCE).where(F.col("week") != week)
    perf = cut_lineage(window.last_weeks(earlier.unionByName(perf.select(*earlier.columns)), config.Rotation.history_weeks))
    store.save_state(perf, f"{base}/performance")
    status = store.load_state(spark, f"{base}/rotation", review.STATUS_SCHEMA)
    store.save_state(review.rotate(perf, sources, status, week), f"{base}/rotation")
    # a repeated run of the week keeps its calls (the earlier mark stays)
    marks = window.week_marks(data.placed, fresh, week).unionByName(call_marks.select("kind", "key", "week"))
    store.save_state(window.prune_seen(window.mark_seen(seen, marks), week, sel.seen_retention_weeks), f"{base}/seen")
    out["performance"] = perf
    return out
