"""Search results of the EU funding portal to call items: JSON with a JSON document inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions.text import clean_text
from pressmill.operators.common import distinct_first
from pressmill.operators.items import build_items, with_source

# fixed values
STATUS_OPEN = "31094502"
TOPIC = (r"(?iU)\b(climate|energy|decarboni|green transition|energy transition|just transition|net.zero|emission|"
         r"carbon|renewable|fossil|heating|fuel poverty|energy poverty|electrif)")
SOCIETY = (r"(?iU)\b(public opinion|attitude|citizen|civil society|democra|polari[sz]|social cohesion|inequalit|"
           r"behaviou?r|survey|engagement|participat|trust|disinformation|misinformation|social innovation|"
           r"vulnerable|poverty|welfare|co.creat|living lab|stakeholder|acceptance|acceptability)")
# queries in order of precedence: text, restricted to the SSH label
QUERIES = [("***", True), ("energy poverty", False), ("just transition", False), ("energy transition", False),
           ("climate citizens", False), ("public acceptance", False), ("climate policy", False),
           ("energy communities", False), ("climate neutral cities", False)]
DESCRIPTION_LIMIT, FACTS_LIMIT = 900, 1500

RESULTS = "results array<struct<url:string,title:string,metadata:map<string,string>>>"
BUDGET = """budgetTopicActionMap map<string,array<struct<action:string, expectedGrants:int, minContribution:double,
    maxContribution:double, budgetYearMap:map<string,string>>>>"""


def values_of(metadata: Column, key: str) -> Column:
    """A field's values as an array, whether it is a list or a scalar."""
    raw = F.try_element_at(metadata, F.lit(key))
    return F.when(F.startswith(F.ltrim(raw), F.lit("[")), F.from_json(raw, "array<string>")).when(
        raw.isNotNull(), F.array(raw)).otherwise(F.array().cast("array<string>"))


def first_of(metadata: Column, key: str) -> Column:
    return F.coalesce(F.try_element_at(values_of(metadata, key), F.lit(1)), F.lit(""))


def matching_actions(overview: Column, identifier: Column) -> Column:
    actions = F.flatten(F.map_values(F.from_json(overview, BUDGET)["budgetTopicActionMap"]))
    return F.filter(actions, lambda a: F.startswith(F.coalesce(a["action"], F.lit("")), identifier))


def grant_facts(actions: Column) -> dict[str, Column]:
    """Smallest and largest contribution, total budget and number of grants over the matching actions."""
    def known(field):
        return F.filter(F.transform(actions, lambda a: a[field]), lambda v: v.isNotNull() & (v != 0))

    years = F.flatten(F.transform(actions, lambda a: F.map_values(F.coalesce(
        a["budgetYearMap"], F.create_map().cast("map<string,string>")))))
    total = F.aggregate(years, F.lit(0.0), lambda s, v: s + F.coalesce(v.try_cast("double"), F.lit(0.0)))
    grants = F.aggregate(actions, F.lit(0), lambda s, a: s + F.coalesce(a["expectedGrants"], F.lit(0)))
    return {"contribution_min": F.array_min(known("minContribution")),
            "contribution_max": F.array_max(known("maxContribution")),
            "budget_total": F.nullif(total, F.lit(0.0)), "grants": F.nullif(grants, F.lit(0))}


def next_deadline(stamps: Column, now: Column) -> Column:
    return F.array_min(F.filter(stamps, lambda d: d.isNotNull() & (d >= now)))


def _stamps(texts: Column) -> Column:
    """Portal dates are ISO stamps with an offset."""
    return F.transform(texts, lambda t: F.regexp_replace(t, r"([+\-]\d{2})(\d{2})$", "$1:$2").try_cast("timestamp"))


def _day(stamp: Column) -> Column:
    return F.coalesce(F.date_format(stamp, "d. M. yyyy"), F.lit("neuvedeno"))


def _euro(value: Column) -> Column:
    return F.concat(F.translate(F.format_number(value, 0), ",", " "), F.lit(" EUR"))


def parse_calls(payloads: DataFrame, require_topic: bool = True) -> DataFrame:
    """Calls with typed facts and the facts as text. ``payloads`` also holds query_no and ssh_query."""
    md = F.col("r.metadata")
    results = (payloads.withColumn("results", F.from_json("body", RESULTS)["results"])
               .select("payload_id", "source_id", "query_no", "ssh_query", F.col("fetched_at").alias("now"),
                       F.posexplode("results").alias("feed_pos", "r")))
    # what the conditions below ask for is read once a row, however often they name it
    asked = F.struct(first_of(md, "identifier").alias("identifier"), first_of(md, "title").alias("own_title"),
                     first_of(md, "callTitle").alias("call_title"), first_of(md, "descriptionByte").alias("markup"),
                     _stamps(values_of(md, "deadlineDate")).alias("deadlines"),
                     F.array_contains(values_of(md, "crossCuttingPriorities"), "SSH").alias("labelled"))
    rows = (results.select("*", F.inline(F.array(asked)))
            .select("payload_id", "source_id", "query_no", "ssh_query", "now", "feed_pos", "identifier",
                    F.coalesce(F.nullif("own_title", F.lit("")), "r.title", F.lit("")).alias("name"),
                    "call_title", first_of(md, "programmePeriod").alias("period"),
                    clean_text(F.col("markup"), DESCRIPTION_LIMIT).alias("description"),
                    first_of(md, "budgetOverview").alias("overview"), "deadlines", "labelled",
                    F.array_contains(values_of(md, "status"), STATUS_OPEN).alias("is_open"),
                    F.element_at(_stamps(F.array(first_of(md, "startDate"))), 1).alias("opens"),
                    values_of(md, "typesOfAction").alias("action_types"),
                    F.coalesce(F.nullif(first_of(md, "url"), F.lit("")), "r.url", F.lit("")).alias("url")))
    text = F.concat_ws(" ", "name", "call_title", "description")
    ssh = F.col("labelled") | F.col("ssh_query")
    if require_topic:
        rows = rows.where(text.rlike(TOPIC)).where(
            ssh | text.rlike(SOCIETY) | ~F.startswith("identifier", F.lit("HORIZON")))
    rows = (rows.withColumn("deadline", next_deadline(F.col("deadlines"), F.col("now")))
            .where((F.size("deadlines") == 0) | F.col("deadline").isNotNull()))
    rows = rows.withColumn("_actions", matching_actions(F.col("overview"), F.col("identifier")))
    rows = rows.withColumns(grant_facts(F.col("_actions")))
    unknown = F.lit("neuvedeno")
    low, high = F.coalesce(_euro(F.col("contribution_min")), unknown), F.coalesce(_euro(F.col("contribution_max")), unknown)
    facts = F.concat_ws(
        " | ", F.concat(F.lit("Výzva EU Funding & Tenders: "), "identifier"),
        F.concat(F.lit("Program: "), "call_title", F.lit(" ("), "period", F.lit(")")),
        F.concat(F.lit("Stav: "), F.when(F.col("is_open"), "otevřená").otherwise("ohlášená (zatím neotevřená)")),
        F.concat(F.lit("Otevření: "), _day(F.col("opens"))),
        F.concat(F.lit("Uzávěrka: "), _day(F.col("deadline"))),
        F.when(ssh, "Štítek SSH (společenské a humanitní vědy)"),
        F.when(F.col("contribution_min").isNotNull() | F.col("contribution_max").isNotNull(),
               F.concat(F.lit("Příspěvek EU na projekt: min. "), low, F.lit(", max. "), high)),
        F.when(F.col("budget_total").isNotNull(), F.concat(
            F.lit("Rozpočet tématu: "), _euro(F.col("budget_total")),
            F.coalesce(F.concat(F.lit(", očekávaný počet grantů: "), F.col("grants").cast("string")), F.lit("")))),
        F.when(F.size("action_types") > 0, F.concat(F.lit("Typ akce: "), F.array_join("action_types", ", "))),
        F.concat(F.lit("Popis: "), "description"))
    named = F.when(F.col("identifier") != "", F.concat("name", F.lit(" ("), "identifier", F.lit(")"))).otherwise(F.col("name"))
    return (rows.withColumn("title", named).withColumn("published", F.coalesce("opens", "now"))
            .withColumn("summary", F.substring(facts, 1, FACTS_LIMIT))
            .withColumn("authors", F.array().cast("array<string>")).withColumn("doi", F.lit(None).cast("string"))
            .withColumn("language", F.lit(None).cast("string")).drop("_actions", "overview", "deadlines", "name"))


def call_items(payloads: DataFrame, sources: DataFrame, require_topic: bool = True) -> DataFrame:
    """Items of all queries, one per address; the earlier query wins. Failed queries simply bring no payload."""
    calls = parse_calls(payloads, require_topic)
    items = build_items(with_source(calls, sources), clean=False)
    return distinct_first(items, "id", F.col("query_no"), F.col("feed_pos"))


def all_queries_failed(payloads: DataFrame) -> DataFrame:
    """One row telling whether no query brought a readable result list."""
    ok = F.from_json("body", RESULTS)["results"].isNotNull()
    return payloads.agg((F.count_if(ok) == 0).alias("failed"))
