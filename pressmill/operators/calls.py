"""Calls and grants: the pool of candidates, drafted calls checked against it, programmes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill import config
from pressmill.functions.dates import deadline_window, parse_deadline, stamp_literal
from pressmill.functions.text import strip_accents
from pressmill.operators.common import distinct_first, top_per_group, with_once
from pressmill.operators.items import effective_date
from pressmill.session import cut_lineage

# fixed values: patterns on accent-free text
CALL_TITLE = (r"(?iU)\b(vyzv|soutez|grant|dotac|call for (proposals|applications|projects)|funding (call|opportunit)|"
              r"open call|joint call|calls? (is |are )?(now )?open|tender)")
CLIMATE = (r"(?i)(klima|energ|dekarboni|decarboni|transformac|transition|emis|uhl|coal|obnoviteln|renewable|vytapen|"
           r"heating|climate|carbon|uhlik|fosil|fossil|ets ?2|zelen|green|udrzitel|sustainab|adaptac|adaptation)")
DEADLINE_FACT = r"Uzávěrka:\s*([^|]+)"
SSH_FACT = "Štítek SSH"
PROGRAMME_SUFFIX = r"\(([A-Z0-9]+)-[A-Z0-9-]+\)\s*$"
CLIMATE_CHARS = 600

# fixed values: call identifier prefix to programme name
PROGRAMMES = {
    "HORIZON": "Horizon Europe", "LIFE": "LIFE", "CERV": "CERV", "ERASMUS": "Erasmus+", "DIGITAL": "Digital Europe",
    "CEF": "CEF", "EU4H": "EU4Health", "SMP": "Single Market Programme", "INTERREG": "Interreg", "EMFAF": "EMFAF",
    "CREA": "Kreativní Evropa", "AGRIP": "AGRIP", "JUST": "Justice", "SOCPL": "Sociální politika", "ESF": "ESF+",
    "I3": "I3 – meziregionální inovace", "EUAF": "EU Anti-Fraud", "RFCS": "Výzkumný fond pro uhlí a ocel",
}
LAST_PROGRAMME = "Horizon Europe"
NO_DEADLINE = "9999-12-31"


def announces_call(title: Column) -> Column:
    return strip_accents(F.coalesce(title, F.lit(""))).rlike(CALL_TITLE)


def is_climate(title: Column, summary: Column) -> Column:
    """Title and the head of the summary, where calls name their subject."""
    head = F.substring(F.coalesce(summary, F.lit("")), 1, CLIMATE_CHARS)
    return strip_accents(F.concat(title, F.lit(" "), head)).rlike(CLIMATE)


def item_deadline(summary: Column) -> Column:
    return parse_deadline(F.nullif(F.regexp_extract(F.coalesce(summary, F.lit("")), DEADLINE_FACT, 1), F.lit("")))


def call_pool(items: DataFrame, sources: DataFrame, shown: DataFrame, now: dt.datetime, week: str, ref: dt.datetime,
              calls: config.Calls = config.Calls()) -> DataFrame:
    """Candidates: items of funding sources and news that announce a call, best ``pool_max`` first; all, in no order, if that is None.

    ``shown`` (key, week) lists calls of earlier reports: they come back only as a reminder shortly before their
    deadline. Deadlines outside the window and old news leave.
    """
    lo, hi = deadline_window(ref, calls.max_months)
    low, high = F.lit(lo.isoformat()).cast("date"), F.lit(hi.isoformat()).cast("date")
    funding = sources.where(F.coalesce("funding", F.lit(False))).select(
        F.col("id").alias("source_id"), F.lit(True).alias("_funding"))
    shown_in = shown.groupBy(F.col("key").alias("id")).agg(F.min("week").alias("_shown"))
    rows = (items.join(funding, "source_id", "left")
            .where((F.col("source_type") == "funding")
                   | (effective_date() >= stamp_literal(now - dt.timedelta(days=calls.lookback_days))))
            .where(F.coalesce("_funding", F.lit(False)) | (F.col("source_type") == "funding")
                   | announces_call(F.col("title"))))
    rows = (with_once(rows, "deadline", item_deadline(F.col("summary_raw")))
            .where(F.col("deadline").isNull() | F.col("deadline").between(low, high))
            .join(shown_in, "id", "left")
            .where(F.col("_shown").isNull() | (F.col("_shown") == week)
                   | F.coalesce(F.col("deadline") <= F.date_add(low, calls.reminder_days), F.lit(False))))
    rows = distinct_first(rows, "id", F.col("arrival") if "arrival" in items.columns else effective_date())
    if calls.pool_max is None:
        return rows.drop("_funding", "_shown")
    # sort keys are columns: an expression in a sort is evaluated at every comparison
    order = {f"_o{i}": c for i, c in enumerate(pool_order())}
    keys = [F.col(n) for n in order]
    return (rows.withColumns(order).orderBy(*keys[:-1], F.desc(effective_date()), keys[-1]).limit(calls.pool_max)
            .drop("_funding", "_shown", *order))


def pool_order() -> list[Column]:
    """Climate first, then domestic, SSH-labelled funding, nearest deadline, (newest,) id."""
    funding = F.col("source_type") == "funding"
    labelled = F.contains(F.coalesce("summary_raw", F.lit("")), F.lit(SSH_FACT))
    return [~is_climate(F.col("title"), F.col("summary_raw")), F.col("region") != "CZ", funding & ~labelled, funding,
            F.coalesce("deadline", F.lit(NO_DEADLINE).cast("date")), F.col("id")]


def programme(title: Column, source_name: Column, funder: Column) -> Column:
    """For the cap: identifier prefix of the call, else source, else funder."""
    empty = F.lit("")
    return F.coalesce(F.nullif(F.regexp_extract(F.coalesce(title, empty), PROGRAMME_SUFFIX, 1), empty),
                      F.nullif(source_name, empty), F.nullif(funder, empty), F.lit("?"))


def programme_name(title: Column, source_name: Column, funder: Column) -> Column:
    """For display groups: the programme's name."""
    prefix = F.regexp_extract(F.coalesce(title, F.lit("")), PROGRAMME_SUFFIX, 1)
    other = F.coalesce(F.nullif(source_name, F.lit("")), F.nullif(funder, F.lit("")), F.lit("Ostatní"))
    return F.when(prefix == "", other).otherwise(F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for p in PROGRAMMES.items() for x in p]), prefix), prefix))


def check_drafts(drafts: DataFrame, pool: DataFrame, lo: dt.date, hi: dt.date,
                 calls: config.Calls = config.Calls()) -> DataFrame:
    """Drafted calls with ``outcome``: 'shown', 'unknown id', 'repeated', 'outside window', 'programme full', 'over limit'.

    ``drafts``: pos, item_id, funder, deadline (text). The cap per programme and the limit count in draft order.
    """
    by_id = pool.select(F.col("id").alias("item_id"), "title", "url", "source_name", "summary_raw")
    rows = drafts.withColumn("item_id", F.trim("item_id")).join(by_id, "item_id", "left")
    rows = (with_once(rows, "deadline_date", F.coalesce(parse_deadline(F.col("deadline")), item_deadline(F.col("summary_raw"))))
            .withColumn("programme", programme(F.col("title"), F.col("source_name"), F.col("funder"))))
    outside = ~F.coalesce(F.col("deadline_date").between(F.lit(lo.isoformat()).cast("date"),
                                                         F.lit(hi.isoformat()).cast("date")), F.lit(True))
    # the pool and the drafts' texts are gone through once; what follows reads short rows several times
    rows = cut_lineage(rows.withColumn("outcome", F.when(F.col("title").isNull(), "unknown id").when(outside, "outside window"))
                       .drop("summary_raw"))
    from pyspark.sql.window import Window

    valid = rows.where("outcome is null")
    firsts = valid.groupBy("item_id").agg(F.min("pos").alias("_first"))
    valid = valid.join(firsts, "item_id")
    repeated = valid.where("pos > _first").withColumn("outcome", F.lit("repeated")).drop("_first")
    once = valid.where("pos = _first").drop("_first")
    # only the last place of each programme is looked for; no programme is sorted as a whole
    last = (top_per_group(once.select("programme", "pos"), ["programme"], [F.col("pos")], calls.max_per_programme, "_n")
            .groupBy(F.col("programme").alias("_programme")).agg(F.max("pos").alias("_last")))
    counted = once.join(last, F.col("programme").eqNullSafe(F.col("_programme"))).drop("_programme")
    full = counted.where("pos > _last").withColumn("outcome", F.lit("programme full")).drop("_last")
    # a few drafts of each programme are left
    kept = counted.where("pos <= _last").drop("_last").withColumn(
        "_n", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("pos")))
    kept = kept.withColumn("outcome", F.when(F.col("_n") <= calls.max_items, "shown").otherwise("over limit")).drop("_n")
    return rows.where("outcome is not null").unionByName(repeated).unionByName(full).unionByName(kept)


def by_programme(calls: DataFrame) -> DataFrame:
    """Calls grouped by programme name; the programme with the most calls is listed last."""
    named = calls.withColumn("programme", programme_name(F.col("title"), F.col("source_name"), F.col("funder")))
    grouped = named.groupBy("programme").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "item_id", "title"))).alias("calls"))
    return grouped.orderBy((F.col("programme") == LAST_PROGRAMME).cast("int"), "programme")
