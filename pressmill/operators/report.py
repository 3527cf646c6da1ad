"""Report sections as flat tables: evidence checks, one place per item, events, findings, weekly topics.

Sections are rows (week, section, pos, text, geo, dated, evidence_ids).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressmill.operators.common import region_rank, running_sums, top_per_group
from pressmill.session import cut_lineage

SWOT = ("strengths", "weaknesses", "opportunities", "threats")
NEWS = ("cz_items", "world_items")
MAIN_PART = ("cz_items", "world_items", "surveys", "recommendations")
# fixed values: how many points a section may hold
SECTION_CAPS = {"key_findings": 3, "strengths": 6, "weaknesses": 6, "opportunities": 6, "threats": 6, "cz_items": 7,
                "world_items": 6, "watchlist": 10}
SINGLE_ITEM = ("key_findings", *NEWS)
MIN_NEWS = 3
KEYS = ["week", "section", "pos"]


def _links(sections: DataFrame) -> DataFrame:
    """One row per reference, with its position inside the point."""
    return sections.select(*KEYS, F.posexplode("evidence_ids").alias("id_pos", "raw_id")).select(
        *KEYS, "id_pos", F.trim("raw_id").alias("item_id"))


def _relink(sections: DataFrame, links: DataFrame) -> DataFrame:
    """Points with the references that are left; points without any are dropped."""
    ids = links.groupBy(*KEYS).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("id_pos", "item_id"))), lambda e: e["item_id"]).alias("evidence_ids"))
    return sections.drop("evidence_ids").join(ids, KEYS)


def valid_evidence(sections: DataFrame, items: DataFrame) -> DataFrame:
    """Keep references to existing items of the week, once each, in order; drop points with none left."""
    known = items.select("week", F.col("id").alias("item_id")).distinct()
    links = _links(sections).join(known, ["week", "item_id"], "left_semi")
    first = links.groupBy(*KEYS, "item_id").agg(F.min("id_pos").alias("id_pos"))
    return _relink(sections, first)


def capped_sections(sections: DataFrame) -> DataFrame:
    """First point per item in news and findings; SWOT by region; then the caps of the sections."""
    caps = F.create_map(*[F.lit(x) for p in SECTION_CAPS.items() for x in p])
    single = sections.where(F.col("section").isin(*SINGLE_ITEM)).withColumn("_id", F.col("evidence_ids")[0])
    single = top_per_group(single, ["week", "section", "_id"], [F.col("pos")], 1).drop("_id")
    others = [s for s in SECTION_CAPS if s not in SINGLE_ITEM]
    rows = single.unionByName(sections.where(F.col("section").isin(*others)))
    swot_order = F.when(F.col("section").isin(*SWOT), region_rank(F.col("geo"))).otherwise(0)
    # the largest cap cuts inside each input partition, before the shuffle
    capped = top_per_group(rows, ["week", "section"], [swot_order, F.col("pos")], max(SECTION_CAPS.values()), "place")
    free = sections.where(~F.col("section").isin(*SECTION_CAPS)).withColumn(
        "place", F.row_number().over(Window.partitionBy("week", "section").orderBy("pos")))
    return capped.where(F.col("place") <= F.try_element_at(caps, F.col("section"))).unionByName(free)


def unusable_weeks(capped: DataFrame, weeks: DataFrame) -> DataFrame:
    """Weeks whose draft must be rejected: too little news, or no finding."""
    counts = capped.groupBy("week").agg(F.count_if(F.col("section").isin(*NEWS)).alias("n_news"),
                                        F.count_if(F.col("section") == "key_findings").alias("n_findings"))
    return (weeks.select("week").distinct().join(counts, "week", "left").fillna(0)
            .where((F.col("n_news") < MIN_NEWS) | (F.col("n_findings") == 0)))


def _section_rank() -> Column:
    rank = F.lit(len(MAIN_PART))
    for i, name in enumerate(MAIN_PART):
        rank = F.when(F.col("section") == name, i).otherwise(rank)
    return rank


def single_place(sections: DataFrame) -> DataFrame:
    """An item belongs to the first section of the main part that uses it; other sections stay as they are."""
    main = sections.where(F.col("section").isin(*MAIN_PART))
    links = _links(main).withColumn("_rank", _section_rank())
    first = top_per_group(links, ["week", "item_id"], [F.col("_rank"), F.col("pos"), F.col("id_pos")], 1).drop("_rank")
    return _relink(main, first).unionByName(sections.where(~F.col("section").isin(*MAIN_PART)), allowMissingColumns=True)


def move_events(sections: DataFrame, items: DataFrame) -> DataFrame:
    """References to events leave findings, news, SWOT and attitudes; missing ones are added to the watch list."""
    events = items.where("is_event").select("week", F.col("id").alias("item_id"), F.col("title").alias("event_title"))
    target = sections.where("section = 'watchlist'")
    links = _links(sections.where("section <> 'watchlist'"))
    kept = links.join(events, ["week", "item_id"], "left_anti")
    order = {s: i for i, s in enumerate(("key_findings", *NEWS, *SWOT, "surveys", "recommendations"))}
    rank = F.lit(len(order))
    for name, i in order.items():
        rank = F.when(F.col("section") == name, i).otherwise(rank)
    moved = links.join(events, ["week", "item_id"]).withColumn("_rank", rank)
    moved = top_per_group(moved, ["week", "item_id"], [F.col("_rank"), F.col("pos"), F.col("id_pos")], 1)
    missing = moved.join(_links(target).select("week", "item_id").distinct(), ["week", "item_id"], "left_anti")
    last = target.groupBy("week").agg(F.max("pos").alias("_last"))
    # the list's own cap bounds what can be added
    missing = top_per_group(missing, ["week"], [F.col(c) for c in ("_rank", "pos", "id_pos", "item_id")],
                            SECTION_CAPS["watchlist"], "_n")
    added = (missing.join(last, "week", "left")
             .select("week", F.lit("watchlist").alias("section"),
                     (F.coalesce("_last", F.lit(-1)) + F.col("_n")).cast("int").alias("pos"),
                     F.col("event_title").alias("text"), F.lit(None).cast("string").alias("geo"),
                     F.lit(False).alias("dated"), F.array("item_id").alias("evidence_ids")))
    watch = top_per_group(target.select("week", "section", "pos", "text", "geo", "dated", "evidence_ids").unionByName(added),
                          ["week"], [F.col("pos")], SECTION_CAPS["watchlist"])
    rest = _relink(sections.where("section <> 'watchlist'"), kept)
    return rest.select(*watch.columns).unionByName(watch)


def with_summary(items: DataFrame) -> DataFrame:
    """Items a finding may rest on: with a summary, no event."""
    return items.where((F.trim(F.coalesce("summary_raw", F.lit(""))) != "") & ~F.col("is_event"))


def fill_findings(sections: DataFrame, items: DataFrame, n: int = 3) -> DataFrame:
    """Findings resting on items with a summary, filled up to ``n`` per week from domestic, then foreign news."""
    has_text = items.where(F.trim(F.coalesce("summary_raw", F.lit(""))) != "").select("week", "id")
    usable = with_summary(items).select("week", "id")
    rows = sections.where(F.col("section").isin("key_findings", *NEWS)).withColumn("id", F.col("evidence_ids")[0])
    own = rows.where("section = 'key_findings'").join(has_text, ["week", "id"], "left_semi").withColumn("_p", F.lit(0))
    news = (rows.where("section <> 'key_findings'").join(usable, ["week", "id"], "left_semi")
            .withColumn("_p", F.when(F.col("section") == "cz_items", 1).otherwise(2)))
    order = [F.col("_p"), F.col("pos")]
    once = top_per_group(own.unionByName(news), ["week", "id"], order, 1)
    return top_per_group(once, ["week"], order, n, "place").select("week", "place", "id", "text")


def checked_report(sections: DataFrame, items: DataFrame, weeks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sections of drafted reports as they are shown, and the weeks of ``weeks`` (week) whose draft is rejected.

    In order: references are checked (a news item or finding rests on its first one alone), points are cut to the caps of
    their sections and numbered anew, events go to the watch list, an item keeps the first section of the main part that
    uses it, findings without a summary go, and findings are filled up from the news. A week without enough news or
    without any finding is rejected whole, also one without any row.
    """
    lead = F.when(F.col("section").isin(*SINGLE_ITEM), F.slice("evidence_ids", 1, 1)).otherwise(F.col("evidence_ids"))
    valid = valid_evidence(sections.withColumn("evidence_ids", lead), items)
    capped = cut_lineage(capped_sections(valid).withColumn("pos", F.col("place")).drop("place"))
    rejected = unusable_weeks(capped, weeks).select("week")
    moved = move_events(capped.join(rejected, "week", "left_anti"), items)
    placed = cut_lineage(single_place(moved))
    found = fill_findings(placed, items).select(
        "week", F.lit("key_findings").alias("section"), F.col("place").alias("pos"), "text", F.lit(None).cast("string").alias("geo"),
        F.lit(False).alias("dated"), F.array("id").alias("evidence_ids"))
    return placed.where("section <> 'key_findings'").select(*found.columns).unionByName(found), rejected


def fallback_list(scored: DataFrame, n: int = 15, scope: str = "week") -> DataFrame:
    """The ranked list shown without a synthesis: domestic first, then score; split into two capped sections."""
    order = [F.when(F.col("geo_focus") == "CZ", 0).otherwise(1), F.desc("final_score"), F.asc("id")]
    top = top_per_group(scored, [scope], order, n, "place")
    section = F.when(F.col("geo_focus") == "CZ", "cz_items").otherwise("world_items")
    rows = top.withColumn("section", section)
    pos = F.row_number().over(Window.partitionBy(scope, "section").orderBy("place"))
    cap = F.when(F.col("section") == "cz_items", SECTION_CAPS["cz_items"]).otherwise(SECTION_CAPS["world_items"])
    return rows.withColumn("pos", pos).withColumn("shown", F.col("pos") <= cap)


def fit_budget(selected: DataFrame, budget: float, floor: int = 15, scope: str = "week") -> DataFrame:
    """Leave out the weakest non-domestic rows until the estimated cost fits, down to ``floor`` rows."""
    order = [F.when(F.col("geo_focus") == "CZ", 0).otherwise(1).asc(), F.desc("final_score"), F.asc("id")]
    placed = running_sums(selected, scope, order, {"running": F.col("cost"), "place": F.lit(1).cast("long")})
    return placed.withColumn("place", F.col("place").cast("int")).where((F.col("running") <= budget) | (F.col("place") <= floor))


def item_references(selected: DataFrame, media_ids: DataFrame) -> DataFrame:
    """The row a report keeps of a selected item."""
    media = media_ids.select("id").distinct().withColumn("_m", F.lit(True))
    return (selected.join(media, "id", "left").withColumn("from_media", F.coalesce("_m", F.lit(False)))
            .withColumn("has_summary", F.trim(F.coalesce("summary_raw", F.lit(""))) != "").drop("_m"))


def top_topic(items: DataFrame, media_topics: DataFrame | None = None) -> DataFrame:
    """Per week: the most frequent media topic, else the most frequent first topic of its items. Ties by name."""
    own = items.where(F.size("topics") > 0).groupBy("week", F.col("topics")[0].alias("topic")).agg(F.count("*").alias("n"))
    counts = own.withColumn("_p", F.lit(1))
    if media_topics is not None:
        counts = counts.unionByName(media_topics.select("week", "topic", "n").withColumn("_p", F.lit(0)))
    return top_per_group(counts, ["week"], [F.col("_p"), F.desc("n"), F.asc("topic")], 1).select("week", "topic", "n")


def latest_weeks(reports: DataFrame, n: int) -> DataFrame:
    return reports.orderBy(F.desc("week")).limit(n)


# -- digest --------------------------------------------------------------------------------------------------------

def digest_candidates(sections: DataFrame) -> DataFrame:
    """Findings, then domestic, then foreign news, then the list older reports have, in one order."""
    priority = (F.when(F.col("section") == "key_findings", 0).when(F.col("section") == "cz_items", 1)
                .when(F.col("section") == "world_items", 2).when(F.col("section") == "top_items", 3))
    return (sections.withColumn("priority", priority).where("priority is not null")
            .select("week", "priority", "pos", F.col("evidence_ids")[0].alias("id"), "text"))


def digest_default(candidates: DataFrame, items: DataFrame, n: int = 3) -> DataFrame:
    """Three findings without a model: first domestic, first foreign, then the next best."""
    usable = items.where(F.col("has_summary") & ~F.col("is_event")).select("week", "id", "geo_focus")
    rows = top_per_group(candidates.join(usable, ["week", "id"]), ["week", "id"], [F.col("priority"), F.col("pos")], 1)
    domestic = F.col("geo_focus") == "CZ"
    # no row beyond the n-th of its own group gets a place
    rows = top_per_group(rows, ["week", domestic], [F.col("priority"), F.col("pos")], n, "_n")
    rows = rows.withColumn("_g", F.when(F.col("_n") > 1, 2).when(domestic, 0).otherwise(1))
    return top_per_group(rows, ["week"], [F.col("_g"), F.col("priority"), F.col("pos")], n, "place").drop("_n", "_g")


def mixed_findings(found: DataFrame, candidates: DataFrame, items: DataFrame) -> DataFrame:
    """Three valid findings with at least one domestic and one foreign where the candidates have both; domestic first.

    ``found``: week, pos, id. All rows of a week get a place in one line and the first three stay: the findings take the
    places 2, 4, 6; the best candidate of a group without a finding takes 5, ahead of the third finding; candidates that
    fill up come last. A week with more than three findings keeps its first three.
    """
    valid = items.where(F.col("has_summary") & ~F.col("is_event")).select(
        "week", "id", "geo_focus", F.coalesce(F.col("geo_focus") == "CZ", F.lit(False)).alias("_cz"))
    once = top_per_group(found.join(valid, ["week", "id"]), ["week", "id"], [F.col("pos")], 1)
    own = top_per_group(once, ["week"], [F.col("pos"), F.col("id")], 3, "_k").withColumn("_line", 2 * F.col("_k"))
    present = once.groupBy("week").agg(F.max("_cz").alias("_has_cz"), F.max(~F.col("_cz")).alias("_has_other"),
                                       F.count("*").alias("_found"))
    spare = (digest_default(candidates, items, 3).select("week", "id", "geo_focus", F.col("place").alias("_k"))
             .join(valid.select("week", "id", "_cz"), ["week", "id"]).join(once.select("week", "id"), ["week", "id"], "left_anti")
             .join(present, "week", "left"))
    best = F.row_number().over(Window.partitionBy("week", "_cz").orderBy("_k")) == 1  # three candidates a week
    lacks = ~F.coalesce(F.when(F.col("_cz"), F.col("_has_cz")).otherwise(F.col("_has_other")), F.lit(False))
    ahead = best & lacks & (F.coalesce("_found", F.lit(0)) <= 3)
    line = ["week", "id", "geo_focus", "_cz", "_line", "_k"]
    rows = own.select(*line).unionByName(spare.withColumn("_line", F.when(ahead, 5).otherwise(10)).select(*line))
    three = top_per_group(rows, ["week"], [F.col("_line"), F.col("_k")], 3, "_n")
    place = F.row_number().over(Window.partitionBy("week").orderBy(F.desc("_cz"), "_n"))
    return three.select("week", place.alias("place"), "id", "geo_focus")


def digest_rows(findings: DataFrame, items: DataFrame) -> DataFrame:
    """Findings with title, address and source copied from the report's items."""
    return findings.drop("geo_focus").join(items.select("week", "id", "title", "url", "source_name", "geo_focus"), ["week", "id"])
