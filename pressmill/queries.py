"""The registered queries: every operator over the given tables, with the equal SQL where SQL can say it.

The tables stand in for the records of the domain: documents for items (first line = title, text = summary), events for
media articles, pages for listings and payloads, labels for two coders, orders and customers for a call ledger. The
view texts below run unchanged in Spark and in DuckDB; attributes the tables lack are derived from other columns.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill import config, schemas
from pressmill.functions import dates, text, urls
from pressmill.functions.keywords import Keywords
from pressmill.operators import (calls, cluster, dedup, health, media, report, review, score, select, sentiment, usage,
                                 validation, window)
from pressmill.operators.common import distinct_first, top_per_group
from pressmill.operators.items import build_items, effective_date, items_per_source, merge_with_stored, news_only, unite
from pressmill.plans import weekly
from pressmill.session import checkpoint_dir
from pressmill.sources import academic, collect, feeds, funding, listing, payloads, registry, store
from pressmill.streaming import media_store

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

WEEK = "2026-W39"
WEEKS = ("2026-W38", "2026-W39", "2026-W40", "2026-W41", "2026-W42")
NOW = dt.datetime(2026, 10, 12, 6)

# the texts are invented words, so the dictionary for these queries is too
KEYWORDS = Keywords(
    stems=["enung", "gelich", "thand", "ertion", "ander of", "the on", "ment la", "ción de"],
    exact=["from", "was", "der", "avec"],
    categories={"public_attitudes": ["onthe", "was"], "communication": ["ingand", "und der"], "forecast": ["thess"],
                "just_transition": ["erand", "que la"], "energy_markets": ["ofth", "les"], "technology": ["ndth"],
                "decarbonization_policy": ["tionth", "con"], "study": ["reand", "ist"]},
    exclude=["ertion in", "von der", "osr"], markers=("thess", " le la", "schich", "ndand"))
MEDIA_KEYWORDS = Keywords(stems=KEYWORDS.stems + ["eux", "ungen", "stan", "ando"], exact=KEYWORDS.exact,
                          exclude=KEYWORDS.exclude)

# -- views ---------------------------------------------------------------------------------------------------------

ITEMS = """
SELECT CAST(doc_id AS STRING) AS id, doc_id, n_chars, trim(split_part(text, chr(10), 1)) AS title, text AS summary_raw,
 'http://' || source || '.Example.org/' || lang || '/' || CAST(doc_id AS STRING) || '/?utm_source=feed&page='
   || CAST(n_chars % 7 AS STRING) AS url,
 source AS source_id, upper(source) AS source_name, lang AS language, CAST(substr(source, 4) AS INT) AS source_no,
 CASE lang WHEN 'en' THEN 'CZ' WHEN 'fr' THEN 'EU' WHEN 'de' THEN 'US' ELSE 'GLOBAL' END AS region,
 CASE CAST(substr(source, 4) AS INT) % 9 WHEN 0 THEN 'research' WHEN 1 THEN 'polling' WHEN 2 THEN 'think_tank'
   WHEN 3 THEN 'journal' WHEN 4 THEN 'government' WHEN 5 THEN 'ngo' WHEN 6 THEN 'industry' WHEN 7 THEN 'media'
   ELSE 'funding' END AS source_type,
 CASE WHEN n_chars % 11 = 0 THEN NULL
   ELSE TIMESTAMP '2026-09-14 00:00:00' + INTERVAL '1' HOUR * CAST(doc_id % 672 AS INT) END AS published_at,
 TIMESTAMP '2026-09-21 06:00:00' + INTERVAL '7' DAY * CAST(doc_id % 4 AS INT) AS first_seen,
 CASE WHEN n_chars % 3 = 0 THEN NULL ELSE '10.1/' || lang || CAST(n_chars AS STRING) END AS doi,
 CAST(substr(source, 4) AS INT) % 5 <> 0 AS topic_filter,
 CAST(0.8 AS DOUBLE) + CAST(0.1 AS DOUBLE) * (CAST(substr(source, 4) AS INT) % 5) AS source_weight
FROM {documents}
"""

# items with scores as an outside scorer would supply them
SCORES = """
SELECT CAST(doc_id AS STRING) AS item_id, CAST(n_chars % 13 AS INT) - 1 AS relevance,
 CASE CAST(n_chars % 5 AS INT) WHEN 0 THEN 'CZ' WHEN 1 THEN 'EU' WHEN 2 THEN 'CZ' WHEN 3 THEN 'US' ELSE 'GLOBAL' END
   AS geo_focus,
 CASE CAST(n_chars % 6 AS INT) WHEN 0 THEN 'study' WHEN 1 THEN 'forecast' WHEN 2 THEN 'technology' WHEN 3 THEN 'study'
   WHEN 4 THEN 'communication' ELSE 'energy_markets' END AS topic,
 CAST((doc_id + n_chars) % 5 AS INT) - 1 AS cz_impact, CAST((doc_id + 2 * n_chars) % 5 AS INT) AS eu_impact,
 n_chars % 4 = 1 AS attitudes, (n_chars + doc_id) % 4 = 2 AS research, n_chars % 7 = 2 AS opinion,
 (n_chars + doc_id) % 9 = 4 AS event, CAST((n_chars + doc_id) % 7 AS INT) - 3 AS sentiment
FROM {documents}
"""

ARTICLES = """
SELECT CAST(event_id AS STRING) AS id, event_type AS outlet, CAST(ts AS TIMESTAMP) AS published_at,
 CAST(ts AS TIMESTAMP) AS first_seen, 'https://' || event_type || '.example.org/' || CAST(event_id AS STRING) AS url,
 props AS summary_raw, event_type || ' ' || props AS title, value > 10 AS relevant,
 CASE CAST(user_id % 12 AS INT) WHEN 0 THEN 'ceny_energii' WHEN 1 THEN 'obnovitelne_zdroje' WHEN 2 THEN 'jadro'
  WHEN 3 THEN 'uhli' WHEN 4 THEN 'teplo_a_budovy' WHEN 5 THEN 'ets2_a_povolenky' WHEN 6 THEN 'klimaticka_politika'
  WHEN 7 THEN 'pocasi_a_adaptace' WHEN 8 THEN 'doprava' WHEN 9 THEN 'energeticka_bezpecnost' WHEN 10 THEN 'veda_o_klimatu'
  ELSE 'jine' END AS topic,
 CASE CAST(user_id % 4 AS INT) WHEN 0 THEN 'naklady_a_zatez' WHEN 1 THEN 'politicky_konflikt'
  WHEN 2 THEN 'skepse_a_odmitani' ELSE 'neutralni_informovani' END AS frame,
 CASE CAST(user_id % 5 AS INT) WHEN 0 THEN 'zprava' WHEN 1 THEN 'komentar' WHEN 2 THEN 'rozhovor' WHEN 3 THEN 'analyza'
  ELSE 'jine' END AS genre,
 CAST(user_id % 7 AS INT) - 3 AS tone
FROM {events}
"""

# points of report sections; evidence comes from the same week's items, some of it unknown or repeated
SECTIONS = """
SELECT CASE CAST(c.conv_id % 4 AS INT) WHEN 0 THEN '2026-W38' WHEN 1 THEN '2026-W39' WHEN 2 THEN '2026-W40'
   ELSE '2026-W41' END AS week,
 CASE CAST(c.turn % 8 AS INT) WHEN 0 THEN 'key_findings' WHEN 1 THEN 'cz_items' WHEN 2 THEN 'world_items'
   WHEN 3 THEN 'surveys' WHEN 4 THEN 'recommendations' WHEN 5 THEN 'watchlist' WHEN 6 THEN 'strengths' ELSE 'threats' END
   AS section,
 CAST(c.conv_id AS INT) AS pos, c.text AS text, CASE c.role WHEN 'user' THEN 'US' WHEN 'assistant' THEN 'EU' ELSE 'CZ' END
   AS geo, false AS dated, CAST(c.conv_id AS STRING) AS e1, CAST(c.conv_id % 7 + c.turn AS STRING) AS e2,
 CAST(c.conv_id AS STRING) AS e3, CAST(length(c.text) AS STRING) AS e4
FROM {conversations} c
"""

# items a report keeps, for the sections above
REPORT_ITEMS = """
SELECT CASE CAST(d.doc_id % 4 AS INT) WHEN 0 THEN '2026-W38' WHEN 1 THEN '2026-W39' WHEN 2 THEN '2026-W40'
   ELSE '2026-W41' END AS week, CAST(d.doc_id AS STRING) AS id, d.source AS source_id, d.source AS source_name,
 trim(split_part(d.text, chr(10), 1)) AS title, 'https://example.org/' || CAST(d.doc_id AS STRING) AS url,
 CASE WHEN d.n_chars % 3 = 0 THEN '' ELSE d.text END AS summary_raw, d.n_chars % 3 <> 0 AS has_summary,
 d.n_chars % 5 = 1 AS is_event, CASE WHEN d.n_chars % 2 = 0 THEN 'CZ' ELSE 'EU' END AS geo_focus
FROM {documents} d
"""

# the registry: one source per distinct source of the documents
SOURCES = """
SELECT source AS id, source AS name, CAST(substr(source, 4) AS INT) AS position,
 CASE CAST(substr(source, 4) AS INT) % 3 WHEN 0 THEN 'CZ' WHEN 1 THEN 'EU' ELSE 'US' END AS region,
 CASE CAST(substr(source, 4) AS INT) % 9 WHEN 0 THEN 'research' WHEN 1 THEN 'polling' WHEN 2 THEN 'think_tank'
   WHEN 3 THEN 'journal' WHEN 4 THEN 'government' WHEN 5 THEN 'ngo' WHEN 6 THEN 'industry' WHEN 7 THEN 'media'
   ELSE 'funding' END AS source_type,
 CASE WHEN CAST(substr(source, 4) AS INT) % 4 = 0 THEN 'org' || CAST(CAST(substr(source, 4) AS INT) % 8 AS STRING) ELSE ''
   END AS organization,
 CAST(0.8 AS DOUBLE) + CAST(0.1 AS DOUBLE) * (CAST(substr(source, 4) AS INT) % 7) AS weight,
 CAST(substr(source, 4) AS INT) % 10 <> 9 AS enabled, CAST(substr(source, 4) AS INT) % 6 = 5 AS reserve,
 CAST(substr(source, 4) AS INT) % 11 = 10 AS media_only, CAST(substr(source, 4) AS INT) % 8 = 3 AS funding,
 CASE WHEN CAST(substr(source, 4) AS INT) % 7 = 3 THEN true WHEN CAST(substr(source, 4) AS INT) % 7 = 5 THEN false END
   AS protected,
 'en' AS language, 'rss' AS type, 'https://' || source || '.example.org/feed' AS url, '' AS notes, true AS topic_filter,
 CASE WHEN CAST(substr(source, 4) AS INT) % 5 = 0 THEN 20 END AS max_items, CAST(substr(source, 4) AS INT) % 9 = 7
   AS media_monitor
FROM {documents} GROUP BY source
"""

# weekly counts per source, as a ledger of orders (week, customer) would give them
PERFORMANCE = """
SELECT week, source_id, count(*) AS n_window, sum(CASE WHEN o_totalprice > 400000 THEN 1 ELSE 0 END) AS n_selected,
 CASE WHEN max(o_custkey) % 97 = 0 THEN NULL ELSE sum(CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END) END AS n_passed
FROM (SELECT {week_of_order} AS week, 'src' || CAST(o_custkey % 600 AS STRING) AS source_id, o_totalprice, o_custkey
      FROM {orders}) o GROUP BY week, source_id
"""

STATUS = """
SELECT CASE CAST(substr(source, 4) AS INT) % 4 WHEN 0 THEN 'paused' WHEN 1 THEN 'activated' ELSE 'flagged' END AS kind,
 source AS source_id, '2026-W38' AS since,
 CASE CAST(substr(source, 4) AS INT) % 8 WHEN 0 THEN '2026-W39' WHEN 4 THEN '2026-W44' END AS until,
 CAST(NULL AS STRING) AS partner
FROM {documents} WHERE source LIKE '%1' OR source LIKE '%2' OR source LIKE '%4' OR source LIKE '%8' GROUP BY source
"""

# what earlier runs remember
SEEN = """
SELECT 'item' AS kind, CAST(doc_id AS STRING) AS key, CASE quality + 2 * toxic WHEN 0 THEN '2026-W38' WHEN 1 THEN '2026-W39'
  WHEN 2 THEN '0000-W00' ELSE '2026-W01' END AS week FROM {labels}
UNION ALL
SELECT 'doi', doi, min(week) FROM (SELECT '10.1/' || lang || CAST(n_chars AS STRING) AS doi,
  CASE WHEN n_chars % 2 = 0 THEN '2026-W37' ELSE '2026-W39' END AS week FROM {documents} WHERE n_chars % 5 = 1) d GROUP BY doi
UNION ALL
SELECT 'source', source, '2026-W30' FROM {documents} WHERE CAST(substr(source, 4) AS INT) % 2 = 0 GROUP BY source
"""

_WEEK_SPARK = "concat(extract(YEAROFWEEK FROM o_orderdate), '-W', lpad(cast(weekofyear(o_orderdate) as string), 2, '0'))"
_WEEK_DUCK = "strftime(o_orderdate, '%G-W%V')"
VIEWS = {"items": ITEMS, "scores": SCORES, "articles": ARTICLES, "sections": SECTIONS, "report_items": REPORT_ITEMS,
         "sources": SOURCES, "performance": PERFORMANCE, "status": STATUS, "seen": SEEN}


def with_views(sql: str, *names: str) -> str:
    """The SQL with the named views in front."""
    plain = {t: t for t in TABLES}
    parts = [f"{n} AS ({VIEWS[n].format(week_of_order=_WEEK_DUCK, **plain)})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n" + sql


class Data:
    """The tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        sql = VIEWS[name].replace("{week_of_order}", _WEEK_SPARK)
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in sql}
        return self.spark.sql(sql, **used)

    def items(self) -> DataFrame:
        return self.view("items").withColumn("arrival", F.col("doc_id"))

    def scored(self) -> DataFrame:
        """Items with the supplied scores, final score and week."""
        return score_columns(self.items(), self.view("scores"))

    def sections(self) -> DataFrame:
        return (self.view("sections").withColumn("evidence_ids", F.array("e1", "e2", "e3", "e4"))
                .drop("e1", "e2", "e3", "e4"))


def supplied(scores: DataFrame) -> DataFrame:
    return scores.select(
        "item_id", "relevance", F.array("topic", "topic").alias("topics"), "geo_focus",
        F.col("attitudes").alias("is_public_attitudes_or_communication"), F.col("research").alias("is_original_research"),
        F.lit(True).alias("relevant_to_cz_eu"), "cz_impact", "eu_impact", F.col("opinion").alias("is_opinion"),
        F.col("event").alias("is_event"), F.lit("t").alias("title_cs"), F.lit("").alias("one_line_cs"), "sentiment")


def score_columns(items: DataFrame, scores: DataFrame) -> DataFrame:
    rows = items.join(supplied(scores), items["id"] == F.col("item_id")).drop("item_id")
    return (score.sanitize(rows).withColumn("final_score", score.final_score())
            .withColumn("scored_by", F.lit("llm")).withColumn("week", dates.week_of(effective_date())))


# SQL twins of the score columns
_EVENT = "(s.event OR regexp_matches(i.title, '(?i)^\\s*(debata|workshop|event|conference|seminar)\\b'))"
SCORED_SQL = f"""
cleaned AS (SELECT i.*, strftime(coalesce(i.published_at, i.first_seen), '%G-W%V') AS week,
   greatest(0, least(10, s.relevance)) AS relevance, s.topic, s.geo_focus, greatest(0, least(3, s.cz_impact)) AS cz_impact,
   greatest(0, least(3, s.eu_impact)) AS eu_impact, s.attitudes AND NOT {_EVENT} AS attitudes,
   s.research AND NOT {_EVENT} AS research, s.opinion, {_EVENT} AS event, greatest(-2, least(2, s.sentiment)) AS sentiment
 FROM items i JOIN scores s ON i.id = s.item_id),
scored AS (SELECT *, round_even(CASE WHEN event THEN points + (-4.0)::DOUBLE ELSE points
    + CASE WHEN attitudes THEN 1.5::DOUBLE ELSE 0 END + CASE WHEN research THEN 0.8::DOUBLE ELSE 0 END
    + CASE WHEN opinion THEN (-0.8)::DOUBLE ELSE 0 END END, 4) AS final_score
  FROM (SELECT *, relevance::DOUBLE + 1.5::DOUBLE * cz_impact + 0.8::DOUBLE * eu_impact
     + CASE geo_focus WHEN 'CZ' THEN 1.0 WHEN 'EU' THEN 0.5 WHEN 'US' THEN -0.5 ELSE 0.0 END::DOUBLE
     + CASE source_type WHEN 'polling' THEN 0.6 WHEN 'research' THEN 0.5 WHEN 'think_tank' THEN 0.4 WHEN 'government' THEN 0.3
         WHEN 'journal' THEN 0.2 WHEN 'industry' THEN -0.3 WHEN 'funding' THEN -0.5 ELSE 0.0 END::DOUBLE
     + 2.0::DOUBLE * (source_weight - 1.0::DOUBLE) AS points FROM cleaned))
"""


def with_scored(sql: str, *more: str) -> str:
    head = with_views("", "items", "scores", *more).rstrip()
    return head + "," + SCORED_SQL + sql


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def norm_sql(value: str) -> str:
    return f"regexp_replace(lower(strip_accents({value})), '\\s+', ' ', 'g')"


def key_sql(value: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents({value})), '[^a-z0-9 ]+', ' ', 'g'))"


def hits_sql(norm: str, patterns: list[tuple[str, str]]) -> str:
    cases = ", ".join(f"CASE WHEN regexp_matches({norm}, {_q(p)}) THEN {_q(t)} END" for t, p in patterns)
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


def url_sql(value: str) -> str:
    u = f"regexp_replace(trim({value}), '#.*$', '')"
    pair = "regexp_matches(lower(split_part(p, '=', 1)), '^(utm_.*|" + "|".join(urls.TRACKING_PARAMETERS) + ")$')"
    query = (f"list_filter(string_split(regexp_extract({u}, '\\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT {pair})")
    query = f"array_to_string(list_transform({query}, lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END), '&')"
    return (f"('https://' || regexp_replace(lower(regexp_extract({u}, '^https?://([^/?]*)', 1)), ':(443|80)$', '')"
            f" || regexp_replace(regexp_extract({u}, '^https?://[^/?]*([^?]*)', 1), '/+$', '')"
            f" || CASE WHEN {query} = '' THEN '' ELSE '?' || {query} END)")


REGISTERED: dict[str, tuple] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the equal SQL if there is one."""

    def wrap(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Data(spark, folder))

        run.__doc__ = fn.__doc__
        REGISTERED[fn.__name__] = (run, sql)
        return fn

    return wrap


# == columns =======================================================================================================

@query(f"""SELECT page_id, {url_sql('url')} AS url_key, substr(sha1({url_sql('url')}), 1, 12) AS id FROM pages""")
def url_normalize_pages(d):
    key = urls.normalize_url(F.col("url"))
    return d.table("pages").select("page_id", key.alias("url_key"), urls.make_id(F.col("url")).alias("id"))


@query("""WITH links AS (SELECT url, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages)
SELECT absolute, count(*) AS n FROM (SELECT CASE WHEN link LIKE 'http%' THEN link
  WHEN link LIKE '//%' THEN regexp_extract(url, '^([a-z]+):', 1) || ':' || link
  WHEN link LIKE '/%' THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || link
  ELSE regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)
    || regexp_replace(regexp_extract(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*(.*)$', 1), '[^/]*$', '') || link END
  AS absolute FROM links) GROUP BY absolute""")
def absolute_links(d):
    links = d.table("pages").select("url", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("link"))
    return links.groupBy(urls.absolute_url(F.col("link"), F.col("url")).alias("absolute")).agg(F.count("*").alias("n"))


@query("""SELECT doc_id, nullif(regexp_replace(regexp_replace(lower(trim(raw)), '^(https?://)?(dx\\.)?doi\\.org/', ''),
  '^doi:', ''), '') AS doi FROM (SELECT doc_id, CASE n_chars % 4 WHEN 0 THEN ' HTTPS://DOI.ORG/10.1/X' || doc_id
  WHEN 1 THEN 'doi:10.2/' || upper(lang) || doc_id WHEN 2 THEN 'dx.doi.org/10.3/' || doc_id ELSE '' END AS raw FROM documents)""")
def doi_normalize(d):
    n, i = F.col("n_chars") % 4, F.col("doc_id").cast("string")
    raw = (F.when(n == 0, F.concat(F.lit(" HTTPS://DOI.ORG/10.1/X"), i))
           .when(n == 1, F.concat(F.lit("doi:10.2/"), F.upper("lang"), i))
           .when(n == 2, F.concat(F.lit("dx.doi.org/10.3/"), i)).otherwise(""))
    return d.table("documents").select("doc_id", urls.normalize_doi(raw).alias("doi"))


@query(f"""SELECT doc_id, md5({norm_sql('text')}) AS norm_md5, {key_sql("split_part(text, chr(10), 1)")} AS title_key
FROM documents""")
def matching_text(d):
    return d.table("documents").select("doc_id", F.md5(text.match_text(F.col("text"))).alias("norm_md5"),
                                       text.title_key(F.split_part("text", F.lit("\n"), F.lit(1))).alias("title_key"))


@query("""SELECT c_custkey, 'journal-' || trim(regexp_replace(lower(strip_accents(name)), '[^a-z0-9]+', '-', 'g'), '-') AS id
FROM (SELECT c_custkey, ' Žurnál ' || c_name || ' & ' || c_mktsegment || '!' AS name FROM customer)""")
def journal_ids(d):
    name = F.concat(F.lit(" Žurnál "), "c_name", F.lit(" & "), "c_mktsegment", F.lit("!"))
    return d.table("customer").select("c_custkey", urls.journal_slug(name).alias("id"))


@query("""SELECT strftime(o_orderdate, '%G-W%V') AS week, min(strftime(date_trunc('week', o_orderdate), '%Y-%m-%d')) AS monday,
 min(strftime(date_trunc('week', o_orderdate) - INTERVAL 7 DAY, '%G-W%V')) AS previous,
 min(strftime(date_trunc('week', o_orderdate) + INTERVAL 28 DAY, '%G-W%V')) AS in_four,
 min(strftime(date_trunc('week', o_orderdate) + INTERVAL 7 DAY - INTERVAL 1 MICROSECOND, '%Y-%m-%d %H:%M:%S')) AS last_second,
 count(*) AS n FROM orders GROUP BY 1""")
def iso_weeks(d):
    stamp = F.col("o_orderdate").cast("timestamp")
    weeks = d.table("orders").groupBy(dates.week_of(stamp).alias("week")).agg(F.count("*").alias("n"))
    monday = dates.week_monday(F.col("week"))
    end = monday.cast("timestamp") + F.expr("INTERVAL 7 DAYS") - F.expr("INTERVAL 1 MICROSECOND")
    return weeks.select("week", F.date_format(monday, "yyyy-MM-dd").alias("monday"),
                        dates.plus_weeks(F.col("week"), -1).alias("previous"), dates.plus_weeks(F.col("week"), 4).alias("in_four"),
                        F.date_format(end, "yyyy-MM-dd HH:mm:ss").alias("last_second"), "n")


@query("""WITH t AS (SELECT o_orderkey, o_orderdate AS d, o_orderkey % 6 AS k, CASE month(o_orderdate) WHEN 1 THEN 'ledna'
  WHEN 2 THEN 'února' WHEN 3 THEN 'března' WHEN 4 THEN 'dubna' WHEN 5 THEN 'května' WHEN 6 THEN 'června' WHEN 7 THEN 'července'
  WHEN 8 THEN 'srpna' WHEN 9 THEN 'září' WHEN 10 THEN 'října' WHEN 11 THEN 'listopadu' ELSE 'prosince' END AS m FROM orders)
SELECT o_orderkey, CASE k WHEN 3 THEN strftime(last_day(d), '%Y-%m-%d') WHEN 4 THEN NULL WHEN 5 THEN NULL
  ELSE strftime(d, '%Y-%m-%d') END AS deadline,
 CASE k WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE strftime(d, '%Y-%m-%d') END AS published FROM t""")
def date_spellings(d):
    """Deadlines and publication dates from prose, written in turn as ISO, dotted, Czech, month only, nonsense, none."""
    k, when = F.col("o_orderkey") % 6, F.col("o_orderdate").cast("timestamp")
    months = ["ledna", "února", "března", "dubna", "května", "června", "července", "srpna", "září", "října", "listopadu", "prosince"]
    name = F.element_at(F.array(*[F.lit(m) for m in months]), F.month(when))
    prose = (F.when(k == 0, F.date_format(when, "yyyy-MM-dd"))
             .when(k == 1, F.date_format(when, "d. M. yyyy"))
             .when(k == 2, F.concat(F.date_format(when, "d"), F.lit(". "), name, F.date_format(when, " yyyy")))
             .when(k == 3, F.concat(name, F.date_format(when, " yyyy"))).when(k == 4, F.lit("31. 2. 1999")).otherwise(""))
    published = F.when(k != 3, dates.parse_date(prose, F.lit("2026-01-01").cast("timestamp")))
    return d.table("orders").select("o_orderkey", F.date_format(dates.parse_deadline(prose), "yyyy-MM-dd").alias("deadline"),
                                    F.date_format(published, "yyyy-MM-dd").alias("published"))


@query("""SELECT doc_id, array_to_string(list_filter(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' '),
  lambda w: w <> ''), ' ') AS abstract FROM documents""")
def abstract_from_positions(d):
    """Texts turned into word -> positions maps, and back."""
    words = F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")
    index = d.table("documents").select("doc_id", academic.invert_abstract(words).alias("m"))
    return index.select("doc_id", F.when(F.col("m").isNotNull(), academic.reconstruct_abstract(F.col("m"))).alias("abstract"))


@query("""SELECT conv_id, turn, CAST(trunc(length(text) / 3.2::DOUBLE) AS INT) + 1 AS tokens FROM conversations""")
def token_estimate(d):
    return d.table("conversations").select("conv_id", "turn", usage.estimate_tokens(F.col("text")).alias("tokens"))


@query("""SELECT doc_id, CASE WHEN length(flat) > 1500 THEN regexp_replace(regexp_replace(substr(flat, 1, 1500), ' [^ ]*$', ''),
  '[,.;: ]+$', '') || '…' ELSE flat END AS summary FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS flat
  FROM documents)""")
def summaries(d):
    """Summaries as items carry them: single blanks, cut at a word with a mark."""
    return d.table("documents").select("doc_id", text.tidy(F.col("text"), text.SUMMARY_LIMIT).alias("summary"))


@query()
def page_text(d):
    """Pages to plain text."""
    return d.table("pages").select("page_id", text.clean_text(F.col("html"), 10 ** 9).alias("body"))


# == rows, filters =================================================================================================

@query(with_views(f"""
SELECT substr(sha1({url_sql('url')}), 1, 12) AS id, title, source_id, language, strftime(CASE WHEN published_at > TIMESTAMP
 '2026-10-01 00:00:00' THEN TIMESTAMP '2026-10-01 00:00:00' ELSE published_at END, '%Y-%m-%d %H') AS published, published_at IS NULL AS date_is_first_seen, length(summary_raw) AS n_summary,
 lower(doi) AS doi, array_to_string(list_filter(string_split(title, ' '), lambda a: a <> '')[1:12], '|') AS authors
FROM items WHERE title <> ''""", "items"))
def item_rows(d):
    raw = d.view("items").select(
        "source_id", "source_name", "region", "source_type", F.col("language").alias("source_language"), "topic_filter",
        "source_weight", "title", "url", F.col("published_at").alias("published"), F.col("summary_raw").alias("summary"),
        F.split("title", " ").alias("authors"), F.concat(F.lit("https://doi.org/"), F.upper("doi")).alias("doi"),
        F.lit("").alias("language"), F.lit("2026-10-01").cast("timestamp").alias("now"))
    return build_items(raw, clean=False).select(
        "id", "title", "source_id", "language", F.date_format("published_at", "yyyy-MM-dd HH").alias("published"),
        "date_is_first_seen", F.length("summary_raw").alias("n_summary"), "doi", F.array_join("authors", "|").alias("authors"))


_ANY = _q(KEYWORDS.any_pattern())
_EXCLUDED = _q(KEYWORDS.exclude_pattern())
_ITEM_NORM = norm_sql("title || ' ' || summary_raw")


@query(with_views(f"""SELECT id, regexp_matches({_ITEM_NORM}, {_ANY}) AS found,
 regexp_matches({norm_sql('title')}, {_EXCLUDED}) AS excluded FROM items""", "items"))
def keyword_match(d):
    norm = text.match_text(text.item_text(F.col("title"), F.col("summary_raw")))
    return d.items().select("id", text.matches(norm, KEYWORDS).alias("found"),
                            text.is_excluded(text.match_text(F.col("title")), KEYWORDS).alias("excluded"))


@query(with_views(f"""SELECT id, array_to_string({hits_sql('norm', KEYWORDS.term_patterns())}, '|') AS hits,
 len({hits_sql('norm', KEYWORDS.term_patterns())}) AS n_hits,
 array_to_string({hits_sql('norm', KEYWORDS.category_patterns())}, '|') AS categories
FROM (SELECT id, {_ITEM_NORM} AS norm FROM items)""", "items"))
def keyword_hits(d):
    norm, windows = F.col(score.MATCH_TEXT), F.col("windows")
    rows = score.with_match_text(d.items()).select(
        "id", norm, F.explode(F.array(text.keyword_windows(norm, KEYWORDS))).alias("windows"))
    return rows.select("id", F.array_join(text.hits(norm, KEYWORDS, windows), "|").alias("hits"),
                       text.hit_count(norm, KEYWORDS, windows).alias("n_hits"),
                       F.array_join(text.categories(norm, KEYWORDS, windows), "|").alias("categories"))


_PREFILTER = f"""NOT regexp_matches({norm_sql('title')}, {_EXCLUDED})
 AND (NOT topic_filter OR regexp_matches({_ITEM_NORM}, {_ANY}))"""


@query(with_views(f"SELECT id, source_id FROM items WHERE {_PREFILTER}", "items"))
def prefilter(d):
    return score.prefilter(d.items(), KEYWORDS).select("id", "source_id")


@query(with_views(f"""SELECT week, id FROM (SELECT id, strftime(coalesce(published_at, first_seen), '%G-W%V') AS week,
  row_number() OVER (PARTITION BY strftime(coalesce(published_at, first_seen), '%G-W%V')
    ORDER BY coalesce(published_at, first_seen) DESC, id) AS n FROM items
  WHERE NOT regexp_matches({norm_sql('title')}, {_EXCLUDED})
    AND regexp_matches({_ITEM_NORM}, {_q(MEDIA_KEYWORDS.any_pattern())})) WHERE n <= 900""", "items"))
def media_candidates(d):
    """The wide keyword set; newest first up to the classification limit of a week."""
    articles = d.items().withColumn("week", dates.week_of(effective_date()))
    return media.candidates(articles, MEDIA_KEYWORDS).select("week", "id")


@query(with_views("""SELECT id, regexp_matches(shown, '(?i)^\\s*(konference|webinář|webinar|debata|workshop|event|conference|seminar)($|[^\\pL\\pN_])') AS is_event
FROM (SELECT id, CASE source_no % 5 WHEN 0 THEN 'Konference: ' WHEN 1 THEN ' WEBINÁŘ ' WHEN 2 THEN 'Konferenceř '
  WHEN 3 THEN 'Nová debata ' ELSE '' END || title AS shown FROM items)""", "items"))
def event_titles(d):
    n = F.col("source_no") % 5
    shown = F.concat(F.when(n == 0, "Konference: ").when(n == 1, " WEBINÁŘ ").when(n == 2, "Konferenceř ")
                     .when(n == 3, "Nová debata ").otherwise(""), "title")
    return d.items().select("id", text.looks_like_event(shown).alias("is_event"))


@query(with_views(f"""SELECT id, regexp_matches(strip_accents(shown), {_q(calls.CALL_TITLE.replace('(?iU)', '(?i)'))}) AS is_call,
 regexp_matches(strip_accents(shown || ' ' || substr(summary_raw, 1, 600)), {_q(calls.CLIMATE)}) AS is_climate
FROM (SELECT id, summary_raw, CASE source_no % 5 WHEN 0 THEN 'Nová výzva: ' WHEN 1 THEN 'Calls are now open ' WHEN 2 THEN 'Uhlí a '
  WHEN 3 THEN 'ETS 2 tender ' ELSE '' END || title AS shown FROM items)""", "items"))
def call_predicates(d):
    n = F.col("source_no") % 5
    shown = F.concat(F.when(n == 0, "Nová výzva: ").when(n == 1, "Calls are now open ").when(n == 2, "Uhlí a ")
                     .when(n == 3, "ETS 2 tender ").otherwise(""), "title")
    return d.items().select("id", calls.announces_call(shown).alias("is_call"),
                            calls.is_climate(shown, F.col("summary_raw")).alias("is_climate"))


@query(with_views("SELECT source_id, count(*) AS n FROM items WHERE source_type <> 'funding' GROUP BY source_id", "items"))
def news_per_source(d):
    return items_per_source(news_only(d.items()))


@query("""SELECT page_id, CASE WHEN head LIKE '%cf-browser-verification%' OR head LIKE '%cf_chl_opt%' OR
  head LIKE '%<title>just a moment%' OR head LIKE '%attention required! | cloudflare%' THEN 'cloudflare'
 WHEN (head LIKE '<!doctype html%' OR head LIKE '<html%') AND NOT (contains(head, '<rss') OR contains(head, '<feed')
  OR contains(head, '<rdf:rdf') OR contains(head, '<channel')) THEN 'html_instead_of_feed' ELSE 'ok' END AS kind
FROM (SELECT page_id, lower(regexp_replace(substr(html, 1, 6000), '^\\s+', '')) AS head FROM pages)""")
def payload_kinds(d):
    return d.table("pages").select("page_id", payloads.payload_kind(F.col("html"), F.lit("")).alias("kind"))


# == window and memory =============================================================================================

@query(with_views("""SELECT id, placement FROM (
 SELECT id, CASE WHEN first_run AND n > 3 THEN 'suppressed'
   WHEN published_at IS NOT NULL AND published_at BETWEEN TIMESTAMP '2026-09-21 00:00:00' AND TIMESTAMP '2026-09-27 23:59:59.999999' THEN 'window'
   WHEN published_at IS NULL AND first_seen BETWEEN TIMESTAMP '2026-09-21 00:00:00' AND TIMESTAMP '2026-09-30 23:59:59.999999' THEN 'window'
   END AS placement
 FROM (SELECT *, row_number() OVER (PARTITION BY source_id, first_run ORDER BY doc_id, id) AS n FROM (
   SELECT i.*, i.published_at IS NULL AND s.key IS NULL AND (a.week IS NULL OR a.week <> '2026-W39') AS first_run
   FROM items i LEFT JOIN seen a ON a.kind = 'item' AND a.key = i.id LEFT JOIN seen b ON b.kind = 'doi' AND b.key = i.doi
   LEFT JOIN seen s ON s.kind = 'source' AND s.key = i.source_id
   WHERE coalesce(a.week, '') <> '0000-W00' AND (coalesce(a.week, b.week) IS NULL OR coalesce(a.week, b.week) >= '2026-W39'))))
WHERE placement IS NOT NULL""", "items", "seen"))
def week_window(d):
    return window.select_window(d.items(), d.view("seen"), WEEK).select("id", "placement")


@query(with_views("""SELECT id, i.source_id, s.key IS NULL AS first_run FROM items i
 LEFT JOIN seen s ON s.kind = 'source' AND s.key = i.source_id""", "items", "seen"))
def first_run_sources(d):
    return window.with_memory(d.items(), d.view("seen")).select("id", "source_id", (~F.col("known_source")).alias("first_run"))


@query(with_views("""SELECT kind, key, week FROM (SELECT kind, key, week FROM seen UNION ALL
 SELECT n.* FROM (SELECT 'item' AS kind, id AS key, '2026-W39' AS week FROM items) n
 LEFT JOIN seen s ON s.kind = 'item' AND s.key = n.key WHERE s.key IS NULL)
WHERE CASE kind WHEN 'item' THEN week >= '2026-W09' OR week = '0000-W00' WHEN 'doi' THEN week >= '2026-W09' ELSE true END""",
                  "items", "seen"))
def remember_and_prune(d):
    new = d.items().select(F.lit("item").alias("kind"), F.col("id").alias("key"), F.lit(WEEK).alias("week"))
    return window.prune_seen(window.mark_seen(d.view("seen"), new), WEEK)


@query("""WITH stored AS (SELECT d.doc_id, quality, toxic FROM documents d JOIN labels l USING (doc_id))
SELECT CAST(d.doc_id AS VARCHAR) AS id, CASE WHEN s.doc_id IS NULL THEN 'fresh' ELSE 'stored' END AS origin,
 coalesce(s.quality, -1) AS quality FROM documents d LEFT JOIN stored s ON s.doc_id = d.doc_id""")
def merge_stored_wins(d):
    fresh = d.table("documents").select(F.col("doc_id").cast("string").alias("id"), F.lit("fresh").alias("origin"),
                                        F.lit(-1).alias("quality"))
    stored = (d.table("documents").join(d.table("labels"), "doc_id")
              .select(F.col("doc_id").cast("string").alias("id"), F.lit("stored").alias("origin"), "quality"))
    return merge_with_stored(fresh, stored)


@query("""SELECT id, count(*) AS n FROM (SELECT 'd' || doc_id AS id, NULL AS url FROM documents
 UNION ALL SELECT 'p' || page_id, url FROM pages) GROUP BY id""")
def united_items(d):
    a = d.table("documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"))
    b = d.table("pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"), "url")
    return unite(a, b).groupBy("id").agg(F.count("*").alias("n"))


_CAP_SQL = f"""SELECT i.*, coalesce(s.max_items, CASE WHEN s.media_monitor THEN 5000 ELSE 60 END) AS cap,
  count(*) OVER (PARTITION BY i.source_id) AS size FROM items i JOIN sources s ON s.id = i.source_id"""


@query(with_views(f"""SELECT id, source_id FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY doc_id, id) AS n
 FROM ({_CAP_SQL}) WHERE NOT (topic_filter AND size > cap) OR regexp_matches({_ITEM_NORM}, {_ANY})) WHERE n <= cap""",
                  "items", "sources"))
def source_caps(d):
    caps = d.view("sources").select(F.col("id").alias("source_id"), window.source_cap().alias("cap"))
    return (window.cap_per_source(d.items().join(caps, "source_id").withColumn("feed_pos", F.col("doc_id")), KEYWORDS)
            .select("id", "source_id"))


@query(with_views("""SELECT id, source_id FROM (SELECT *, row_number() OVER (PARTITION BY url_key ORDER BY
  CASE source_type WHEN 'research' THEN 0 WHEN 'polling' THEN 0 WHEN 'think_tank' THEN 1 WHEN 'journal' THEN 1
    WHEN 'government' THEN 2 WHEN 'ngo' THEN 3 WHEN 'industry' THEN 4 WHEN 'media' THEN 5 ELSE 9 END,
  -length(summary_raw), published_at IS NULL, id) AS n FROM (SELECT *, md5(summary_raw) AS url_key FROM items)) WHERE n = 1""", "items"))
def exact_copies(d):
    """One row per identical text, by the order of preference."""
    return dedup.exact_copies(d.items(), F.md5("summary_raw")).select("id", "source_id")


# == fuzzy (no SQL equals the similarity) ==========================================================================

def _weekly(d):
    """Items by week, with titles as the item builder leaves them."""
    return d.items().withColumn("title", text.clean_title(F.col("title"))).withColumn("week", dates.week_of(effective_date()))


@query()
def similar_titles(d):
    return dedup.similar_titles(_weekly(d)).select("week", "id", "similar_id")


@query()
def deduplicated(d):
    return dedup.deduplicate(_weekly(d)).select("week", "id")


@query()
def topic_clusters(d):
    scored = d.scored().withColumn("title", text.clean_title(F.col("title"))).withColumn("title_cs", F.lit(""))
    return cluster.numbered(cluster.topic_clusters(scored)).select("week", "id", "cluster_no")


@query()
def balanced_selection(d):
    scored = d.scored().withColumn("title", text.clean_title(F.col("title"))).withColumn("title_cs", F.lit(""))
    scored = select.with_organisation(scored, d.view("sources"))
    return select.select_balanced(scored).select("week", "id", "source_id", "geo_focus", "final_score")


# == scores ========================================================================================================

_HEUR = f"""
h AS (SELECT *, {norm_sql("title || ' ' || summary_raw")} AS norm FROM items),
h2 AS (SELECT *, len({hits_sql('norm', KEYWORDS.term_patterns())}) AS n_hits,
  {hits_sql('norm', KEYWORDS.category_patterns())} AS cats,
  regexp_matches(title, '(?i)^\\s*(debata|workshop|event|conference|seminar)\\b') AS event,
  CASE WHEN region <> 'CZ' AND ({' OR '.join("contains(' ' || norm || ' ', " + _q(m) + ")" for m in KEYWORDS.markers)}) THEN 'CZ'
    ELSE region END AS geo FROM h),
h3 AS (SELECT *, CASE WHEN len(cats) = 0 THEN ['decarbonization_policy'] ELSE cats END AS topics FROM h2),
h4 AS (SELECT *, list_contains(topics, 'public_attitudes') OR list_contains(topics, 'communication') AS att FROM h3)
"""
_RELEVANCE = """greatest(0, least(10, 2 + least(n_hits, 5) + CASE WHEN att THEN 2 ELSE 0 END
   + CASE WHEN source_type IN ('research', 'polling') THEN 1 ELSE 0 END + CASE WHEN topic_filter THEN 0 ELSE 1 END))"""


@query(with_views("", "items").rstrip() + "," + _HEUR + f"""SELECT id, {_RELEVANCE} AS relevance,
 array_to_string(topics[1:4], '|') AS topics, geo AS geo_focus, att AND NOT event AS attitudes,
 source_type IN ('research', 'polling', 'journal') AND NOT event AS research, region IN ('CZ', 'EU') AS to_cz_eu,
 CASE WHEN geo = 'CZ' THEN 2 ELSE 0 END AS cz_impact, CASE WHEN geo IN ('CZ', 'EU') THEN 2 ELSE 0 END AS eu_impact,
 CASE WHEN length(summary_raw) > 180 THEN substr(summary_raw, 1, 180) || '…' WHEN summary_raw <> '' THEN summary_raw
   ELSE title END AS line FROM h4""")
def heuristic_score(d):
    return score.heuristic_score(d.items(), KEYWORDS).select(
        "id", "relevance", F.array_join("topics", "|").alias("topics"), "geo_focus",
        F.col("is_public_attitudes_or_communication").alias("attitudes"), F.col("is_original_research").alias("research"),
        F.col("relevant_to_cz_eu").alias("to_cz_eu"), "cz_impact", "eu_impact", F.col("one_line_cs").alias("line"))


@query(with_scored("""SELECT id, relevance, topic, geo_focus, cz_impact, eu_impact, attitudes, research, opinion, event,
 sentiment, final_score, geo_focus = 'CZ' OR cz_impact >= 2 AS domestic FROM scored"""))
def final_score(d):
    return d.scored().select(
        "id", "relevance", F.array_join("topics", "|").alias("topic"), "geo_focus", "cz_impact", "eu_impact",
        F.col("is_public_attitudes_or_communication").alias("attitudes"), F.col("is_original_research").alias("research"),
        F.col("is_opinion").alias("opinion"), F.col("is_event").alias("event"), "sentiment", "final_score",
        score.is_domestic().alias("domestic"))


_TOP3 = """SELECT source_id, id, final_score, n AS rank_in_source FROM (SELECT *, row_number() OVER (PARTITION BY source_id
 ORDER BY final_score DESC, cz_impact DESC, coalesce(published_at, first_seen) DESC, id) AS n FROM scored) WHERE n <= 3"""


@query(with_scored(_TOP3))
def top_per_source(d):
    return score.top_per_source(d.scored(), 3).select("source_id", "id", "final_score", "rank_in_source")


_FLAGSHIP = (with_views("", "items").rstrip() + "," + _HEUR + f""", f AS (SELECT *, {_RELEVANCE} AS relevance,
  CASE WHEN geo = 'CZ' THEN 2 ELSE 0 END AS cz, CASE WHEN geo IN ('CZ', 'EU') THEN 2 ELSE 0 END AS eu FROM h4 WHERE {_PREFILTER}),
g AS (SELECT *, relevance::DOUBLE + 1.5::DOUBLE * cz + 0.8::DOUBLE * eu
     + CASE geo WHEN 'CZ' THEN 1.0 WHEN 'EU' THEN 0.5 WHEN 'US' THEN -0.5 ELSE 0.0 END::DOUBLE
     + CASE source_type WHEN 'polling' THEN 0.6 WHEN 'research' THEN 0.5 WHEN 'think_tank' THEN 0.4 WHEN 'government' THEN 0.3
         WHEN 'journal' THEN 0.2 WHEN 'industry' THEN -0.3 WHEN 'funding' THEN -0.5 ELSE 0.0 END::DOUBLE
     + 2.0::DOUBLE * (source_weight - 1.0::DOUBLE) AS points FROM f),
s AS (SELECT *, round_even(CASE WHEN event THEN points + (-4.0)::DOUBLE ELSE points + CASE WHEN att THEN 1.5::DOUBLE ELSE 0 END
   + CASE WHEN source_type IN ('research', 'polling', 'journal') THEN 0.8::DOUBLE ELSE 0 END END, 4) AS final_score FROM g)
SELECT week, source_id, id, final_score, n AS place FROM (SELECT *, strftime(coalesce(published_at, first_seen), '%G-W%V') AS week,
 row_number() OVER (PARTITION BY strftime(coalesce(published_at, first_seen), '%G-W%V'), source_id
   ORDER BY final_score DESC, cz DESC, coalesce(published_at, first_seen) DESC, id) AS n FROM s) WHERE n <= 3""")


@query(_FLAGSHIP)
def weekly_top_items(d):
    """The flagship: items, ISO week, prefilter, heuristic score, best three per week and source."""
    items = score.with_match_text(d.items().withColumn("week", dates.week_of(effective_date())))
    scored = score.heuristic_score(score.prefilter(items, KEYWORDS), KEYWORDS).withColumn("final_score", score.final_score())
    top = top_per_group(scored, ["week", "source_id"], score.rank_columns(), 3, "place")
    return top.select("week", "source_id", "id", "final_score", "place")


@query(with_views("", "items", "scores").rstrip() + "," + _HEUR + f"""SELECT h4.id, CASE WHEN l.doc_id IS NULL THEN 'heuristic'
 ELSE 'llm' END AS scored_by, CASE WHEN l.doc_id IS NULL THEN {_RELEVANCE} ELSE greatest(0, least(10, s.relevance)) END AS relevance
FROM h4 JOIN scores s ON s.item_id = h4.id LEFT JOIN labels l ON CAST(l.doc_id AS VARCHAR) = h4.id""")
def scores_or_heuristic(d):
    """Supplied scores exist for the labelled documents; the others fall back to the heuristic."""
    labelled = d.table("labels").select(F.col("doc_id").cast("string").alias("item_id"))
    given = supplied(d.view("scores")).join(labelled, "item_id", "left_semi")
    return score.score_items(d.items(), given, KEYWORDS).select("id", "scored_by", "relevance")


@query(with_views("", "items").rstrip() + "," + _HEUR + f""", q AS (SELECT id, {_RELEVANCE} AS relevance FROM h4)
SELECT id, relevance FROM q ORDER BY relevance DESC, id LIMIT 320""")
def scorer_queue(d):
    rows = score.heuristic_score(d.items(), KEYWORDS).withColumn("final_score", F.col("relevance").cast("double"))
    return score.queue(rows, config.Scoring.max_items).select("id", "relevance")


@query(with_scored("""SELECT id, final_score, final_score > 12 AS selected, trim(summary_raw) <> '' AS has_summary FROM scored"""))
def saved_scores(d):
    scored = d.scored()
    return score.saved_scores(scored, scored.where("final_score > 12")).select("id", "final_score", "selected", "has_summary")


@query(with_scored("""SELECT count(*) AS n_selected, count(*) FILTER (geo_focus = 'CZ' OR cz_impact >= 2) AS n_domestic,
 count(*) FILTER (attitudes) AS n_attitudes FROM scored WHERE relevance >= 3"""))
def quota_counts(d):
    return score.quota_counts(d.scored().where("relevance >= 3"))


@query(with_scored("""SELECT week, batch_no, n, running FROM (SELECT week, batch_no, n, sum(est) OVER (PARTITION BY week ORDER BY batch_no)
 AS running FROM (SELECT week, batch_no, count(*) AS n, sum(CAST(trunc(length(summary_raw) / 3.2::DOUBLE) AS INT) + 1) AS est
  FROM (SELECT *, CAST(floor((row_number() OVER (PARTITION BY week ORDER BY final_score DESC, cz_impact DESC,
    coalesce(published_at, first_seen) DESC, id) - 1) / 25) AS INT) AS batch_no FROM scored) GROUP BY week, batch_no))
WHERE running <= 40000"""))
def batch_budget_cut(d):
    """Batches of 25 ranked items; those that fit a token budget per week."""
    rows = window.batch_numbers(d.scored(), score.rank_columns(), config.Scoring.batch_size, "week")
    batches = rows.groupBy("week", "batch_no").agg(F.count("*").alias("n"),
                                                   F.sum(usage.estimate_tokens(F.col("summary_raw"))).alias("est"))
    return score.budget_prefix(batches, "est", 40000, "week").select("week", "batch_no", "n", "running")


@query(with_scored("""SELECT week, section, pos, id FROM (SELECT *, row_number() OVER (PARTITION BY week, section ORDER BY place) AS pos
 FROM (SELECT *, CASE WHEN geo_focus = 'CZ' THEN 'cz_items' ELSE 'world_items' END AS section, row_number() OVER (PARTITION BY week
   ORDER BY geo_focus <> 'CZ', final_score DESC, id) AS place FROM scored) WHERE place <= 15)
WHERE pos <= CASE section WHEN 'cz_items' THEN 7 ELSE 6 END"""))
def fallback_list(d):
    return report.fallback_list(d.scored()).where("shown").select("week", "section", "pos", "id")


@query(with_scored("""SELECT week, id, place FROM (SELECT week, id, sum(cost) OVER w AS running, row_number() OVER w AS place FROM (
  SELECT *, CAST(trunc(length(summary_raw) / 3.2::DOUBLE) AS INT) + 1 AS cost FROM scored WHERE final_score > 14)
 WINDOW w AS (PARTITION BY week ORDER BY geo_focus <> 'CZ', final_score DESC, id)) WHERE running <= 8000 OR place <= 15"""))
def budget_fit(d):
    rows = d.scored().where("final_score > 14").withColumn("cost", usage.estimate_tokens(F.col("summary_raw")))
    return report.fit_budget(rows, 8000).select("week", "id", "place")


# == sentiment =====================================================================================================

_SENT = """rated AS (SELECT week, id, greatest(final_score, 0.1::DOUBLE) AS w, final_score, sentiment AS v, geo_focus, cz_impact, published_at, first_seen FROM scored
  WHERE relevance >= 3)"""


@query(with_scored("," + _SENT + """
SELECT week, region, n, idx AS "index", negative, neutral, positive, CASE WHEN idx <= -40 THEN 'spíše nepříznivá'
  WHEN idx <= -10 THEN 'mírně nepříznivá' WHEN idx < 10 THEN 'přibližně vyrovnaná' WHEN idx < 40 THEN 'mírně příznivá'
  ELSE 'spíše příznivá' END AS label
FROM (SELECT week, geo_focus AS region, count(*) AS n, CAST(round_even(sum(w * v) / sum(w) / 2 * 100, 0) AS INT) AS idx,
  round_even(sum(CASE WHEN v < 0 THEN w ELSE 0 END) / sum(w), 3) AS negative,
  round_even(1 - sum(CASE WHEN v < 0 THEN w ELSE 0 END) / sum(w) - sum(CASE WHEN v > 0 THEN w ELSE 0 END) / sum(w), 3) AS neutral,
  round_even(sum(CASE WHEN v > 0 THEN w ELSE 0 END) / sum(w), 3) AS positive
 FROM rated GROUP BY GROUPING SETS ((week), (week, geo_focus)))
WHERE week IN (SELECT week FROM rated GROUP BY week HAVING count(*) >= 8)"""))
def sentiment_levels(d):
    rows = sentiment.rated(d.scored()).select("week", "id", "final_score", "sentiment", "geo_focus")
    return sentiment.sentiment(rows).drop("position")


@query(with_scored("," + _SENT + """
SELECT week, max(CASE WHEN v > 0 AND p = 1 THEN id END) AS most_positive_id, max(CASE WHEN v < 0 AND m = 1 THEN id END) AS most_negative_id
FROM (SELECT *, row_number() OVER (PARTITION BY week ORDER BY v DESC, final_score DESC, cz_impact DESC, coalesce(published_at, first_seen) DESC, id) AS p,
  row_number() OVER (PARTITION BY week ORDER BY v, final_score DESC, cz_impact DESC, coalesce(published_at, first_seen) DESC, id) AS m FROM rated) GROUP BY week"""))
def sentiment_extremes(d):
    return sentiment.extremes(sentiment.rated(d.scored()))


_POINTS = ("," + _SENT + """, pts AS (SELECT week, CAST(round_even(sum(w * v) / sum(w) / 2 * 100, 0) AS INT) AS idx, count(*) AS n
 FROM rated WHERE geo_focus = 'CZ' GROUP BY week HAVING count(*) >= 3)""")


@query(with_scored(_POINTS + """ SELECT week, idx AS "index", lag(idx) OVER (ORDER BY week) AS previous,
 array_to_string(list(idx) OVER (ORDER BY week ROWS BETWEEN 7 PRECEDING AND CURRENT ROW), ',') AS trend FROM pts"""))
def mood_trend(d):
    rows = sentiment.rated(d.scored()).select("week", "id", "final_score", "sentiment", "geo_focus")
    points = sentiment.sentiment(rows).where("region = 'CZ' and n >= 3").select("week", "index")
    return sentiment.trend(points, "index", 8).select(
        "week", "index", "previous", F.array_join(F.transform("trend", lambda t: t["index"].cast("string")), ",").alias("trend"))


_TOPICS = """, tops AS (SELECT week, topic, n FROM (SELECT week, topic, count(*) AS n, row_number() OVER (PARTITION BY week
 ORDER BY count(*) DESC, topic) AS p FROM scored GROUP BY week, topic) WHERE p = 1)"""


@query(with_scored(_TOPICS + " SELECT week, topic, n FROM tops"))
def top_topics(d):
    return report.top_topic(d.scored().select("week", "topics"))


@query(with_scored(_POINTS + _TOPICS + """ SELECT week, idx AS "index", pts.n, topic FROM pts LEFT JOIN tops USING (week)"""))
def mood_points(d):
    scored = d.scored()
    rows = sentiment.rated(scored).select("week", "id", "final_score", "sentiment", "geo_focus")
    points = sentiment.domestic_points(sentiment.sentiment(rows), report.top_topic(scored.select("week", "topics")))
    return points.select("week", "index", "n", "topic")


# == media =========================================================================================================

def _articles(d):
    return d.view("articles").withColumn("week", dates.week_of(effective_date()))


_ART = "art AS (SELECT *, strftime(published_at, '%G-W%V') AS week FROM articles)"


def with_articles(sql: str) -> str:
    return with_views("", "articles").rstrip() + ", " + _ART + sql


@query(with_articles(" SELECT week, outlet, count(*) AS collected, count(*) FILTER (relevant) AS n_relevant FROM art GROUP BY week, outlet"))
def media_outlet_stats(d):
    return media.outlet_stats(_articles(d))


@query(with_articles(""" SELECT week, 'topic' AS dimension, topic AS value, count(*) AS n FROM art WHERE relevant GROUP BY week, topic
UNION ALL SELECT week, 'frame', frame, count(*) FROM art WHERE relevant GROUP BY week, frame
UNION ALL SELECT week, 'genre', genre, count(*) FROM art WHERE relevant GROUP BY week, genre"""))
def media_distributions(d):
    return media.distributions(_articles(d).where("relevant"))


@query(with_articles(""" SELECT week, CAST(round_even(sum(greatest(-2, least(2, tone))) / count(*) * 50, 0) AS INT) AS tone_index,
 count(*) AS n_relevant FROM art WHERE relevant GROUP BY week"""))
def tone_index(d):
    articles = _articles(d)
    classes = media.clean_classes(articles, articles.withColumnRenamed("id", "item_id"))
    found = articles.select("week", "id")
    return media.tone_index(media.relevant_articles(found, classes.drop("week")))


@query(with_articles(""" , tn AS (SELECT week, topic, row_number() OVER (PARTITION BY week ORDER BY count(*) DESC, topic) AS p FROM art
  WHERE relevant GROUP BY week, topic), fn AS (SELECT week, frame, row_number() OVER (PARTITION BY week ORDER BY count(*) DESC, frame)
  AS p FROM art WHERE relevant GROUP BY week, frame)
SELECT a.week, a.n_relevant, a.n_outlets, t.top_topics, fn.frame AS leading_frame
FROM (SELECT week, count(*) AS n_relevant, count(DISTINCT outlet) AS n_outlets FROM art WHERE relevant GROUP BY week) a
JOIN (SELECT week, string_agg(topic, '|' ORDER BY p) AS top_topics FROM tn WHERE p <= 3 GROUP BY week) t USING (week)
JOIN fn ON fn.week = a.week AND fn.p = 1"""))
def media_context(d):
    rows = media.context(_articles(d).where("relevant"))
    return rows.withColumn("top_topics", F.array_join("top_topics", "|"))


@query(with_articles(""" SELECT week, id, place FROM (SELECT week, id, row_number() OVER (PARTITION BY week ORDER BY genre = 'zprava',
 published_at DESC, id) AS place FROM art WHERE relevant) WHERE place <= 160"""))
def media_reading_list(d):
    return media.reading_list(_articles(d).where("relevant")).select("week", "id", "place")


@query(with_articles(""" , tn AS (SELECT week, topic, row_number() OVER (PARTITION BY week ORDER BY count(*) DESC, topic) AS p FROM art
  WHERE relevant GROUP BY week, topic),
r AS (SELECT a.*, CASE WHEN p <= 3 THEN p - 1 ELSE 9 END AS o, CASE genre WHEN 'analyza' THEN 0 WHEN 'komentar' THEN 1 WHEN 'rozhovor'
  THEN 2 WHEN 'zprava' THEN 3 ELSE 4 END AS g FROM art a JOIN tn USING (week, topic) WHERE relevant AND tone <> 0 AND trim(summary_raw) <> ''),
f AS (SELECT *, row_number() OVER (PARTITION BY week, outlet ORDER BY o, g, published_at DESC, id) AS n FROM r)
SELECT week, outlet, id FROM (SELECT *, row_number() OVER (PARTITION BY week ORDER BY o, g, published_at DESC, id) AS m FROM f WHERE n = 1)
WHERE m <= 6"""))
def one_per_outlet(d):
    """Articles of neutral tone count as already selected."""
    relevant = _articles(d).where("relevant")
    taken = _articles(d).where("tone = 0").select("week", F.concat("url", F.lit("/?utm_source=x#top")).alias("url"))
    return media.one_per_outlet(relevant, taken).select("week", "outlet", "id")


@query("""SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_start, event_type AS outlet, count(*) AS n FROM events
GROUP BY 1, 2""")
def weekly_tumbling_window(d):
    rows = d.table("events").select(F.col("ts").cast("timestamp").alias("effective_date"), F.col("event_type").alias("outlet"))
    return media_store.weekly_counts(rows).withColumn("week_start", F.date_format("week_start", "yyyy-MM-dd"))


@query("""SELECT strftime(ts, '%G-W%V') AS week, event_type AS source_id, count(*) AS n,
 strftime(min(CASE WHEN event_id % 5 = 0 AND ts < TIMESTAMP '2024-01-20' THEN ts - INTERVAL 1 HOUR ELSE ts END), '%Y-%m-%d %H:%M:%S') AS first_sighting FROM events
WHERE strftime(ts, '%G-W%V') IN ('2024-W04', '2024-W03') GROUP BY 1, 2""")
def media_collection(d):
    """Two streaming runs over landed articles. The first holds an article dated far ahead and, in the same batch, earlier
    and later sightings of some articles; the second repeats all: the store holds each article once, as first seen."""
    base = f"{checkpoint_dir(d.spark)}/collection-{uuid.uuid4().hex}"
    none = F.lit(None).cast("string")
    ts = F.col("ts").cast("timestamp")
    url = F.concat(F.lit("https://example.org/"), F.col("event_id").cast("string"))
    landed = d.table("events").select(
        F.col("event_id").cast("string").alias("id"), F.col("props").alias("title"), url.alias("url"),
        F.col("event_type").alias("source_id"), F.col("event_type").alias("source_name"), F.lit("CZ").alias("region"),
        F.lit("media").alias("source_type"), F.lit("cs").alias("language"), ts.alias("published_at"), ts.alias("first_seen"),
        F.lit("").alias("summary_raw"), F.array().cast("array<string>").alias("authors"), none.alias("doi"),
        F.lit(True).alias("topic_filter"), F.lit(1.0).alias("source_weight"), F.lit(False).alias("date_is_first_seen"))
    now = dt.datetime(2024, 1, 28, 12)
    early = landed.where(F.col("published_at") < "2024-01-20")
    ahead = landed.withColumn("id", F.concat(F.lit("ahead-"), "id")).withColumn("published_at", F.col("published_at") + F.expr("INTERVAL 8 WEEKS"))
    again = early.where(F.col("id").cast("long") % 5 == 0)
    (early.unionByName(ahead).unionByName(again.withColumn("first_seen", F.col("first_seen") - F.expr("INTERVAL 1 HOUR")))
     .unionByName(again.withColumn("first_seen", F.col("first_seen") + F.expr("INTERVAL 2 HOURS"))).write.parquet(f"{base}/landed/a"))
    run = (d.spark, f"{base}/landed/*", f"{base}/store", f"{base}/meta", f"{base}/checkpoint", now)
    media_store.collect(*run)
    landed.write.parquet(f"{base}/landed/b")
    media_store.collect(*run)
    return media_store.read_store(d.spark, f"{base}/store").groupBy("week", "source_id").agg(
        F.count("*").alias("n"), F.date_format(F.min("first_seen"), "yyyy-MM-dd HH:mm:ss").alias("first_sighting"))


# == sources and rotation ==========================================================================================

@query(with_views("""SELECT s.id FROM sources s LEFT JOIN status p ON p.kind = 'paused' AND p.source_id = s.id
 LEFT JOIN status a ON a.kind = 'activated' AND a.source_id = s.id
 WHERE s.enabled AND NOT s.media_only AND p.source_id IS NULL AND (NOT s.reserve OR a.source_id IS NOT NULL)""", "sources", "status"))
def active_sources(d):
    return review.active_sources(d.view("sources"), d.view("status")).select("id")


@query(with_views("""SELECT id, coalesce(protected, weight >= 1.3::DOUBLE OR source_type IN ('polling', 'funding') OR funding) AS protected
FROM sources""", "sources"))
def protected_sources(d):
    return d.view("sources").select("id", review.is_protected().alias("protected"))


@query(with_scored(f"""SELECT f.week, f.source_id, coalesce(n_window, 0) AS n_window, coalesce(n_selected, 0) AS n_selected,
 coalesce(n_passed, 0) AS n_passed FROM (SELECT w.week, s.id AS source_id FROM sources s JOIN (SELECT DISTINCT week FROM scored) w
   ON s.enabled UNION SELECT week, source_id FROM scored) f
LEFT JOIN (SELECT week, source_id, count(*) AS n_window, count(*) FILTER (final_score > 14) AS n_selected,
  count(*) FILTER ({_PREFILTER}) AS n_passed FROM scored GROUP BY week, source_id) c USING (week, source_id)""", "sources"))
def source_performance(d):
    scored = d.scored()
    weeks = scored.select("week").distinct()
    fetched = weeks.join(d.view("sources").select(F.col("id").alias("source_id"), "enabled"), F.col("enabled"))
    return review.performance(scored, scored.where("final_score > 14"), score.prefilter(scored, KEYWORDS), fetched)


@query(with_views("""SELECT source_id, sum(n_window) AS "window", sum(n_selected) AS selected, count(*) AS weeks FROM performance
WHERE week IN (SELECT DISTINCT week FROM performance ORDER BY week DESC LIMIT 4) GROUP BY source_id""", "performance"))
def recent_performance(d):
    return review.recent_performance(d.view("performance"))


@query(with_views("""SELECT week, source_id, published FROM (SELECT week, source_id, sum(n_window) OVER w AS published,
  count(n_passed) OVER w AS known, max(n_passed) OVER w AS passed, monday - lag(monday, 3) OVER (PARTITION BY source_id ORDER BY monday) AS gap
 FROM (SELECT *, CAST(date_trunc('week', strptime(substr(week, 1, 4) || '-01-04', '%Y-%m-%d')) + INTERVAL 7 DAY
    * (CAST(substr(week, 7, 2) AS INT) - 1) AS DATE) AS monday FROM performance)
 WINDOW w AS (PARTITION BY source_id ORDER BY monday ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
WHERE known = 4 AND passed = 0 AND gap = 21""", "performance"))
def weak_sources(d):
    return review.weak_stretches(d.view("performance"))


@query(with_views("""SELECT DISTINCT week, source_id FROM performance WHERE week IN (SELECT DISTINCT week FROM performance
 ORDER BY week DESC LIMIT 16)""", "performance"))
def kept_history(d):
    return window.last_weeks(d.view("performance"), config.Rotation.history_weeks).select("week", "source_id").distinct()


@query()
def rotation(d):
    """One rotation over the whole registry, in the last recorded week of a ledger with many weak sources."""
    sources = d.view("sources").withColumn("reserve", F.col("reserve") & F.col("enabled"))
    ledger = (d.items().withColumn("week", dates.week_of(F.col("published_at"))).where("published_at is not null")
              .groupBy("week", "source_id").agg(F.count("*").alias("n_window"), F.count_if(F.col("n_chars") < 0).alias("n_selected"),
                                                F.count_if((F.col("source_no") % 2 == 0) & F.col("topic_filter")).alias("n_passed")))
    return review.rotate(ledger, sources, d.view("status"), "2026-W41")


_HEALTH = """health AS (SELECT s.id AS source_id, s.enabled, count(i.id) AS "count", max(i.published_at) AS newest,
 CASE WHEN count(i.id) = 0 THEN 'empty' WHEN max(i.published_at) < TIMESTAMP '2026-10-12 06:00:00' - INTERVAL 14 DAY THEN 'stale'
  ELSE 'ok' END AS status, CASE WHEN count(i.id) > 0 AND count(i.published_at) = 0 THEN 'undated' ELSE '' END AS detail
 FROM sources s LEFT JOIN items i ON i.source_id = s.id GROUP BY s.id, s.enabled)"""


@query(with_views("", "items", "sources").rstrip() + ", " + _HEALTH + """
SELECT source_id, "count", strftime(newest, '%Y-%m-%d') AS newest, status FROM health""")
def health_status(d):
    sources = d.view("sources").withColumnRenamed("id", "source_id")
    rows = health.source_health(sources, d.items(), NOW, fetch=config.Fetch(stale_days=14))
    return rows.select("source_id", "count", F.date_format("newest", "yyyy-MM-dd").alias("newest"), "status")


@query(with_views("", "items", "sources").rstrip() + ", " + _HEALTH + """
SELECT count(*) FILTER (status = 'ok') AS n_ok, count(*) AS n, round_even(count(*) FILTER (status = 'ok') / count(*), 4) AS share
FROM health WHERE enabled""")
def health_share(d):
    sources = d.view("sources").withColumnRenamed("id", "source_id")
    return health.healthy_share(health.source_health(sources, d.items(), NOW, fetch=config.Fetch(stale_days=14)))


@query("""SELECT source_id, status FROM (SELECT * , row_number() OVER (PARTITION BY source_id ORDER BY new DESC, checked DESC) AS n FROM (
 SELECT 'Supplier' || s_nationkey AS source_id, 'old' || s_suppkey AS status, 0 AS new, s_suppkey AS checked FROM supplier
 UNION ALL SELECT 'Supplier' || n_nationkey, 'new', 1, n_nationkey FROM nation WHERE n_regionkey < 3
 UNION ALL SELECT 'api-' || r_name, 'kept', 0, 0 FROM region UNION ALL SELECT 'gone' || r_regionkey, 'lost', 0, 0 FROM region))
WHERE n = 1 AND source_id NOT LIKE 'gone%'""")
def health_merge(d):
    stamp = lambda c: F.timestamp_seconds(c)
    old = (d.table("supplier").select(F.concat(F.lit("Supplier"), F.col("s_nationkey").cast("string")).alias("source_id"),
                                      F.concat(F.lit("old"), F.col("s_suppkey").cast("string")).alias("status"),
                                      stamp("s_suppkey").alias("checked_at"))
           .unionByName(d.table("region").select(F.concat(F.lit("api-"), "r_name").alias("source_id"), F.lit("kept").alias("status"),
                                                 stamp(F.lit(0)).alias("checked_at")))
           .unionByName(d.table("region").select(F.concat(F.lit("gone"), F.col("r_regionkey").cast("string")).alias("source_id"),
                                                 F.lit("lost").alias("status"), stamp(F.lit(0)).alias("checked_at"))))
    nation = d.table("nation")
    name = F.concat(F.lit("Supplier"), F.col("n_nationkey").cast("string"))
    new = nation.where("n_regionkey < 3").select(name.alias("source_id"), F.lit("new").alias("status"),
                                                 stamp(F.col("n_nationkey")).alias("checked_at"))
    return health.merge_health(old, new, nation.select(name.alias("id"))).select("source_id", "status")


@query(with_views("", "items", "sources", "status", "performance").rstrip() + ", " + _HEALTH + """,
recent AS (SELECT source_id, sum(n_window) AS "window", count(*) AS weeks FROM performance
 WHERE week IN (SELECT DISTINCT week FROM performance ORDER BY week DESC LIMIT 4) GROUP BY source_id)
SELECT s.id AS source_id, h.status, h."count", r."window", r.weeks, CASE WHEN t.kind = 'paused' THEN 'paused'
  WHEN s.reserve AND coalesce(t.kind, '') <> 'activated' THEN 'reserve' WHEN t.kind = 'activated' THEN 'activated' ELSE '' END AS rotation
FROM sources s LEFT JOIN health h ON h.source_id = s.id LEFT JOIN recent r ON r.source_id = s.id
LEFT JOIN status t ON t.source_id = s.id AND t.kind <> 'flagged'""")
def source_overview(d):
    sources = d.view("sources")
    rows = health.source_health(sources.withColumnRenamed("id", "source_id"), d.items(), NOW, fetch=config.Fetch(stale_days=14))
    return review.overview(sources, rows, d.view("performance"), d.view("status")).select(
        "source_id", "status", "count", "window", "weeks", "rotation")


@query(with_scored("""SELECT id, coalesce(nullif(organization, ''), scored.source_id) AS org FROM scored
LEFT JOIN (SELECT id AS sid, organization FROM sources) s ON s.sid = scored.source_id""", "sources"))
def organisations(d):
    return select.with_organisation(d.scored(), d.view("sources")).select("id", "org")


# == calls =========================================================================================================

_CALL_SQL = """calls AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS id, CASE o_orderkey % 4 WHEN 0 THEN 'Energy call ' WHEN 1 THEN 'Nová výzva '
   WHEN 2 THEN 'Uhlí: výzva ' ELSE 'Zpráva ' END || o_orderkey || CASE o_orderkey % 5 WHEN 0 THEN ' (HORIZON-CL5-' || (o_orderkey % 9) || ')'
   WHEN 1 THEN ' (LIFE-2027-' || (o_orderkey % 9) || ')' ELSE '' END AS title,
  'Výzva | Uzávěrka: ' || CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate + INTERVAL 30 YEAR, '%Y-%m-%d') ELSE 'neuvedeno' END ||
   CASE WHEN o_orderkey % 2 = 0 THEN ' | Štítek SSH' ELSE '' END AS summary_raw,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate + INTERVAL 30 YEAR AS DATE) END AS deadline,
  'src' || (o_custkey % 20) AS source_id, CASE WHEN o_orderkey % 6 = 0 THEN 'CZ' ELSE 'EU' END AS region,
  CASE WHEN o_orderkey % 7 = 0 THEN 'funding' ELSE 'ngo' END AS source_type, o_orderdate + INTERVAL 30 YEAR AS published_at,
  'Source ' || (o_custkey % 20) AS source_name FROM orders)"""


def _calls(d):
    """Orders as announcements of calls."""
    k = F.col("o_orderkey")
    later = (F.col("o_orderdate") + F.expr("INTERVAL 30 YEARS")).cast("timestamp")
    s = lambda c: c.cast("string")
    title = F.concat(F.when(k % 4 == 0, "Energy call ").when(k % 4 == 1, "Nová výzva ").when(k % 4 == 2, "Uhlí: výzva ").otherwise("Zpráva "),
                     s(k), F.when(k % 5 == 0, F.concat(F.lit(" (HORIZON-CL5-"), s(k % 9), F.lit(")")))
                     .when(k % 5 == 1, F.concat(F.lit(" (LIFE-2027-"), s(k % 9), F.lit(")"))).otherwise(""))
    summary = F.concat(F.lit("Výzva | Uzávěrka: "), F.when(k % 3 == 0, F.date_format(later, "yyyy-MM-dd")).otherwise("neuvedeno"),
                       F.when(k % 2 == 0, " | Štítek SSH").otherwise(""))
    return d.table("orders").select(
        "o_orderkey", s(k).alias("id"), title.alias("title"), summary.alias("summary_raw"),
        F.concat(F.lit("src"), s(F.col("o_custkey") % 20)).alias("source_id"),
        F.concat(F.lit("Source "), s(F.col("o_custkey") % 20)).alias("source_name"),
        F.when(k % 6 == 0, "CZ").otherwise("EU").alias("region"), F.when(k % 7 == 0, "funding").otherwise("ngo").alias("source_type"),
        later.alias("published_at"), later.alias("first_seen"), k.alias("arrival"), F.concat(F.lit("https://x.org/"), s(k)).alias("url"))


_POOL_SQL = with_views("", "sources").rstrip() + ", " + _CALL_SQL + """, pool AS (SELECT c.* FROM calls c LEFT JOIN sources s ON s.id = c.source_id
 LEFT JOIN (SELECT CAST(l_orderkey AS VARCHAR) AS key, CASE WHEN min(l_linenumber) = 1 THEN '2026-W37' ELSE '2026-W40' END AS week
   FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) h ON h.key = c.id
 WHERE (coalesce(s.funding, false) OR c.source_type = 'funding' OR regexp_matches(c.title, '(?i)(výzva|call for (proposals|applications|projects))'))
  AND (deadline IS NULL OR deadline BETWEEN DATE '2026-10-04' AND DATE '2027-04-05')
  AND (h.week IS NULL OR h.week = '2026-W40' OR coalesce(deadline <= DATE '2026-11-18', false))
  AND (c.source_type = 'funding' OR c.published_at >= TIMESTAMP '2026-10-12 06:00:00' - INTERVAL 30 DAY))"""


def _shown(d):
    return (d.table("lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").cast("string").alias("key"))
            .agg(F.when(F.min("l_linenumber") == 1, "2026-W37").otherwise("2026-W40").alias("week")))


def _pool(d, pool_max):
    ref = dates.week_bounds("2026-W40")[1]
    return calls.call_pool(_calls(d), d.view("sources"), _shown(d), NOW, "2026-W40", ref, config.Calls(pool_max=pool_max))


@query(_POOL_SQL + """ SELECT id, strftime(deadline, '%Y-%m-%d') AS deadline FROM pool ORDER BY
 NOT regexp_matches(strip_accents(title || ' ' || substr(summary_raw, 1, 600)), '(?i)(energ|uhl)'), region <> 'CZ',
 source_type = 'funding' AND NOT contains(summary_raw, 'Štítek SSH'), source_type = 'funding', coalesce(deadline, DATE '9999-12-31'),
 published_at DESC, id LIMIT 70""")
def call_pool(d):
    return _pool(d, config.Calls.pool_max).select("id", F.date_format("deadline", "yyyy-MM-dd").alias("deadline"))


@query(_POOL_SQL + """, drafts AS (SELECT o_orderkey AS pos, id, CASE WHEN o_orderkey % 8 = 0 THEN DATE '2027-11-30' END AS d FROM calls),
j AS (SELECT x.pos, x.id, p.title, coalesce(x.d, p.deadline) AS dl, coalesce(nullif(regexp_extract(p.title, '\\(([A-Z0-9]+)-[A-Z0-9-]+\\)\\s*$', 1), ''),
  p.source_name) AS prog FROM drafts x LEFT JOIN pool p ON p.id = x.id),
o AS (SELECT *, CASE WHEN title IS NULL THEN 'unknown id' WHEN dl NOT BETWEEN DATE '2026-10-04' AND DATE '2027-04-05' THEN 'outside window' END AS r FROM j),
k AS (SELECT *, row_number() OVER (PARTITION BY prog, r ORDER BY pos) AS n FROM o),
m AS (SELECT *, row_number() OVER (PARTITION BY r IS NULL AND n <= 3 ORDER BY pos) AS q FROM k)
SELECT id AS item_id, CASE WHEN r IS NOT NULL THEN r WHEN n > 3 THEN 'programme full' WHEN q > 6 THEN 'over limit' ELSE 'shown' END AS outcome FROM m""")
def call_drafts(d):
    """Drafts for all calls, checked against the pool."""
    k = F.col("o_orderkey")
    drafts = d.table("orders").select(k.alias("pos"), k.cast("string").alias("item_id"), F.lit("").alias("funder"),
                                      F.when(k % 8 == 0, "30. 11. 2027").otherwise("neuvedeno").alias("deadline"))
    lo, hi = dates.deadline_window(dates.week_bounds("2026-W40")[1], 6)
    return calls.check_drafts(drafts, _pool(d, None), lo, hi).select("item_id", "outcome")


def _runs_sql() -> str:
    """The calls of three runs, each with the memory of those before."""
    parts, shown = [], "SELECT CAST(NULL AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS week WHERE false"
    for n, (week, now, low, high, near) in enumerate((
            ("2026-W40", "2026-10-12 06:00:00", "2026-10-04", "2027-04-05", "2026-11-18"),
            ("2026-W40", "2026-10-12 06:00:00", "2026-10-04", "2027-04-05", "2026-11-18"),
            ("2026-W41", "2026-10-19 06:00:00", "2026-10-11", "2027-04-12", "2026-11-25"))):
        parts.append(f"""shown{n} AS (SELECT id, min(week) AS week FROM ({shown}) GROUP BY id),
pool{n} AS (SELECT c.* FROM calls c LEFT JOIN sources s ON s.id = c.source_id LEFT JOIN shown{n} h ON h.id = c.id
 WHERE (coalesce(s.funding, false) OR c.source_type = 'funding' OR regexp_matches(c.title, '(?i)(výzva|call for (proposals|applications|projects))'))
  AND (deadline IS NULL OR deadline BETWEEN DATE '{low}' AND DATE '{high}')
  AND (h.week IS NULL OR h.week = '{week}' OR coalesce(deadline <= DATE '{near}', false))
  AND (c.source_type = 'funding' OR c.published_at >= TIMESTAMP '{now}' - INTERVAL 30 DAY)),
j{n} AS (SELECT x.o_orderkey AS pos, x.id, coalesce(CASE WHEN x.o_orderkey % 8 = 0 THEN DATE '2027-11-30' END, p.deadline) AS dl,
 coalesce(nullif(regexp_extract(p.title, '\\(([A-Z0-9]+)-[A-Z0-9-]+\\)\\s*$', 1), ''), p.source_name) AS prog FROM calls x JOIN pool{n} p ON p.id = x.id),
o{n} AS (SELECT *, coalesce(dl NOT BETWEEN DATE '{low}' AND DATE '{high}', false) AS outside FROM j{n}),
k{n} AS (SELECT *, row_number() OVER (PARTITION BY prog, outside ORDER BY pos) AS n FROM o{n}),
m{n} AS (SELECT *, row_number() OVER (PARTITION BY NOT outside AND n <= 3 ORDER BY pos) AS q FROM k{n}),
run{n} AS (SELECT {n + 1} AS run, id, CASE WHEN outside THEN 'outside window' WHEN n > 3 THEN 'programme full' WHEN q > 6 THEN 'over limit'
  ELSE 'shown' END AS outcome FROM m{n})""")
        shown = f"SELECT id, week FROM shown{n} UNION ALL SELECT id, '{week}' FROM run{n} WHERE outcome = 'shown'"
    rows = " UNION ALL ".join(f"SELECT CAST(run AS INTEGER) AS run, id AS item_id, outcome FROM run{n}" for n in range(3))
    return with_views("", "sources").rstrip() + ", " + _CALL_SQL + ", " + ",\n".join(parts) + "\n" + rows


@query(_runs_sql())
def calls_across_runs(d):
    """Drafted calls of a week, of its repetition and of the next week: the state tables lie between the runs."""
    state, found = f"{checkpoint_dir(d.spark)}/calls-{uuid.uuid4().hex}", None
    announced, k = _calls(d), F.col("o_orderkey")
    drafts = announced.select(k.alias("pos"), F.col("id").alias("item_id"), F.lit("").alias("funder"),
                              F.when(k % 8 == 0, "30. 11. 2027").otherwise("neuvedeno").alias("deadline"))
    for run, (week, now) in enumerate((("2026-W40", NOW), ("2026-W40", NOW), ("2026-W41", NOW + dt.timedelta(days=7)))):
        seen = store.load_state(d.spark, state, schemas.SEEN)
        _, checked, marks = weekly.call_section(announced, d.view("sources"), seen, drafts, now, week, config.Calls(pool_max=None))
        store.save_state(window.prune_seen(window.mark_seen(seen, marks), week), state)
        rows = checked.where("outcome <> 'unknown id'").select(F.lit(run + 1).alias("run"), "item_id", "outcome")
        found = rows if found is None else found.unionByName(rows)
    return found


@query("WITH " + _CALL_SQL + """ SELECT programme, count(*) AS n FROM (SELECT CASE regexp_extract(title, '\\(([A-Z0-9]+)-[A-Z0-9-]+\\)\\s*$', 1)
  WHEN 'HORIZON' THEN 'Horizon Europe' WHEN 'LIFE' THEN 'LIFE' ELSE source_name END AS programme FROM calls) GROUP BY programme""")
def calls_by_programme(d):
    named = calls.programme_name(F.col("title"), F.col("source_name"), F.lit(""))
    return _calls(d).groupBy(named.alias("programme")).agg(F.count("*").alias("n"))


# == validation ====================================================================================================

@query(f"""WITH s AS (SELECT l.doc_id, quality = 1 AS selected, md5(l.doc_id || ':42:draw') AS h FROM labels l),
a AS (SELECT * FROM s WHERE selected ORDER BY h, CAST(doc_id AS VARCHAR) LIMIT 50),
b AS (SELECT * FROM s WHERE NOT selected ORDER BY h, CAST(doc_id AS VARCHAR) LIMIT (100 - (SELECT count(*) FROM a)))
SELECT CAST(doc_id AS VARCHAR) AS id, selected, row_number() OVER (ORDER BY md5(doc_id || ':42:shuffle'), CAST(doc_id AS VARCHAR)) AS position
FROM (SELECT * FROM a UNION ALL SELECT * FROM b)""")
def stratified_sample(d):
    rows = d.table("labels").select(F.col("doc_id").cast("string").alias("id"), (F.col("quality") == 1).alias("selected"))
    return validation.stratified_sample(rows, 100)


_KAPPA = """, n AS (SELECT pair, count(*) AS n, sum(CASE WHEN a = b THEN 1 ELSE 0 END) AS same FROM pairs WHERE a <> '' AND b <> '' GROUP BY pair),
ca AS (SELECT pair, a AS v, count(*) AS k FROM pairs WHERE a <> '' AND b <> '' GROUP BY pair, a),
cb AS (SELECT pair, b AS v, count(*) AS k FROM pairs WHERE a <> '' AND b <> '' GROUP BY pair, b),
pe AS (SELECT ca.pair, sum(ca.k * cb.k) AS e FROM ca JOIN cb ON ca.pair = cb.pair AND ca.v = cb.v GROUP BY ca.pair)
SELECT n.pair, n.n, CASE WHEN coalesce(e, 0) >= n.n * n.n THEN CASE WHEN same = n.n THEN 1.0 END
 ELSE round_even((same / n.n - coalesce(e, 0) / (n.n * n.n)) / (1 - coalesce(e, 0) / (n.n * n.n)), 3) END AS kappa
FROM n LEFT JOIN pe USING (pair)"""


@query("WITH pairs AS (SELECT 'quality-toxic' AS pair, CAST(quality AS VARCHAR) AS a, CAST(toxic AS VARCHAR) AS b FROM labels)" + _KAPPA)
def kappa_labels(d):
    return validation.kappa(d.table("labels").select(F.lit("quality-toxic").alias("pair"), F.col("quality").cast("string").alias("a"),
                                                     F.col("toxic").cast("string").alias("b")))


@query(with_views("", "scores").rstrip() + """, sheet AS (SELECT CAST(d.doc_id AS VARCHAR) AS id, CASE quality WHEN 1 THEN 'Ano ' WHEN 0 THEN 'ne' ELSE '' END AS ra,
  CASE toxic WHEN 1 THEN 'yes' WHEN 0 THEN '0' ELSE '?' END AS rb, upper(CASE lang WHEN 'en' THEN 'cz' WHEN 'fr' THEN ' eu' ELSE lang END) AS ga,
  CASE WHEN n_chars % 3 = 0 THEN '' WHEN n_chars % 2 = 0 THEN 'CZ' ELSE 'EU' END AS gb, lang FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
j AS (SELECT CASE trim(lower(ra)) WHEN 'ano' THEN '1' WHEN 'ne' THEN '0' ELSE '' END AS ra, CASE rb WHEN 'yes' THEN '1' WHEN '0' THEN '0' ELSE '' END AS rb,
  trim(ga) AS ga, gb, CASE WHEN s.item_id IS NULL OR lang = 'es' THEN '' WHEN relevance >= 5 THEN '1' ELSE '0' END AS rm,
  CASE WHEN s.item_id IS NULL OR lang = 'es' THEN '' ELSE geo_focus END AS gm FROM sheet LEFT JOIN scores s ON s.item_id = sheet.id),
pairs AS (SELECT 'relevance A-B' AS pair, ra AS a, rb AS b FROM j UNION ALL SELECT 'geo A-B', ga, gb FROM j UNION ALL SELECT 'relevance A-model', ra, rm FROM j
 UNION ALL SELECT 'relevance B-model', rb, rm FROM j UNION ALL SELECT 'geo A-model', ga, gm FROM j UNION ALL SELECT 'geo B-model', gb, gm FROM j)""" + _KAPPA)
def coder_agreement(d):
    """Both coders and the model, which has no scores for one of the languages."""
    docs = d.table("documents").join(d.table("labels"), "doc_id", "left")
    n = F.col("n_chars")
    sheet = docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.when(F.col("quality") == 1, "Ano ").when(F.col("quality") == 0, "ne").otherwise("").alias("A_relevantni"),
        F.when(F.col("toxic") == 1, "yes").when(F.col("toxic") == 0, "0").otherwise("?").alias("B_relevantni"),
        F.when(F.col("lang") == "en", "cz").when(F.col("lang") == "fr", " eu").otherwise(F.col("lang")).alias("A_geo"),
        F.when(n % 3 == 0, "").when(n % 2 == 0, "CZ").otherwise("EU").alias("B_geo"))
    known = d.table("documents").where("lang <> 'es'").select(F.col("doc_id").cast("string").alias("item_id"))
    scores = d.view("scores").join(known, "item_id", "left_semi").select(
        F.col("item_id").alias("id"), F.col("relevance").cast("string").alias("relevance"), F.col("geo_focus").alias("geo"))
    return validation.agreement(sheet, scores)


# == report ========================================================================================================

_LINKS = """links AS (SELECT week, section, pos, geo, text, unnest([1, 2, 3, 4]) AS id_pos, unnest([e1, e2, e3, e4]) AS item_id FROM sections),
valid AS (SELECT l.week, l.section, l.pos, any_value(l.geo) AS geo, any_value(l.text) AS text, l.item_id, min(id_pos) AS id_pos FROM links l
  JOIN report_items r ON r.week = l.week AND r.id = l.item_id GROUP BY l.week, l.section, l.pos, l.item_id)"""


def _report(d):
    sections = d.sections()
    return sections, d.view("report_items")


def _flat(sections: DataFrame) -> DataFrame:
    return sections.select("week", "section", "pos", F.array_join("evidence_ids", "|").alias("ids"))


@query(with_views("", "sections", "report_items").rstrip() + ", " + _LINKS + """
SELECT week, section, pos, string_agg(item_id, '|' ORDER BY id_pos) AS ids FROM valid GROUP BY week, section, pos""")
def evidence_integrity(d):
    return _flat(report.valid_evidence(*_report(d)))


_PLACE = """, ranked AS (SELECT *, CASE section WHEN 'cz_items' THEN 0 WHEN 'world_items' THEN 1 WHEN 'surveys' THEN 2 WHEN 'recommendations' THEN 3 END AS r FROM valid),
single AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY week, item_id, r IS NULL ORDER BY r, pos, id_pos) AS n FROM ranked) WHERE r IS NULL OR n = 1)"""


@query(with_views("", "sections", "report_items").rstrip() + ", " + _LINKS + _PLACE + """
SELECT week, section, pos, string_agg(item_id, '|' ORDER BY id_pos) AS ids FROM single GROUP BY week, section, pos""")
def single_place(d):
    sections, items = _report(d)
    return _flat(report.single_place(report.valid_evidence(sections, items)))


@query(with_views("", "sections", "report_items").rstrip() + ", " + _LINKS + """,
firsts AS (SELECT *, row_number() OVER (PARTITION BY week, section, pos ORDER BY id_pos) AS f FROM valid),
points AS (SELECT week, section, pos, geo, item_id AS lead FROM firsts WHERE f = 1),
uniq AS (SELECT *, CASE WHEN section IN ('key_findings', 'cz_items', 'world_items') THEN row_number() OVER (PARTITION BY week, section, lead ORDER BY pos) ELSE 1 END AS u FROM points),
placed AS (SELECT *, row_number() OVER (PARTITION BY week, section ORDER BY CASE WHEN section IN ('strengths', 'threats') THEN CASE geo WHEN 'CZ' THEN 0
  WHEN 'EU' THEN 1 WHEN 'US' THEN 2 ELSE 3 END ELSE 0 END, pos) AS place FROM uniq WHERE u = 1)
SELECT week, section, pos, place FROM placed WHERE place <= CASE section WHEN 'key_findings' THEN 3 WHEN 'strengths' THEN 6 WHEN 'threats' THEN 6
 WHEN 'cz_items' THEN 7 WHEN 'world_items' THEN 6 WHEN 'watchlist' THEN 10 ELSE 2147483647 END""")
def section_caps(d):
    return report.capped_sections(report.valid_evidence(*_report(d))).select("week", "section", "pos", "place")


@query(with_views("", "sections", "report_items").rstrip() + ", " + _LINKS + """, ev AS (SELECT v.*, r.is_event, r.title FROM valid v JOIN report_items r ON r.week = v.week AND r.id = v.item_id),
kept AS (SELECT week, section, pos, item_id, id_pos FROM ev WHERE section <> 'watchlist' AND NOT is_event),
moved AS (SELECT *, row_number() OVER (PARTITION BY week, item_id ORDER BY o, pos, id_pos) AS n FROM (SELECT *, CASE section WHEN 'key_findings' THEN 0 WHEN 'cz_items' THEN 1
  WHEN 'world_items' THEN 2 WHEN 'strengths' THEN 3 WHEN 'threats' THEN 6 WHEN 'surveys' THEN 7 ELSE 8 END AS o FROM ev WHERE section <> 'watchlist' AND is_event)),
missing AS (SELECT m.* FROM moved m WHERE n = 1 AND NOT EXISTS (SELECT 1 FROM valid w WHERE w.section = 'watchlist' AND w.week = m.week AND w.item_id = m.item_id)),
last AS (SELECT week, max(pos) AS last FROM valid WHERE section = 'watchlist' GROUP BY week),
added AS (SELECT m.week, 'watchlist' AS section, coalesce(last, -1) + row_number() OVER (PARTITION BY m.week ORDER BY o, pos, id_pos, item_id) AS pos, item_id AS ids
  FROM missing m LEFT JOIN last USING (week)),
watch AS (SELECT week, section, pos, string_agg(item_id, '|' ORDER BY id_pos) AS ids FROM valid WHERE section = 'watchlist' GROUP BY week, section, pos
  UNION ALL SELECT * FROM added)
SELECT week, section, pos, ids FROM (SELECT *, row_number() OVER (PARTITION BY week ORDER BY pos) AS n FROM watch) WHERE n <= 10
UNION ALL SELECT week, section, pos, string_agg(item_id, '|' ORDER BY id_pos) FROM kept GROUP BY week, section, pos""")
def events_to_watchlist(d):
    sections, items = _report(d)
    return _flat(report.move_events(report.valid_evidence(sections, items), items))


_LEADS = """, leads AS (SELECT v.week, v.section, v.pos, v.text, v.item_id AS id, r.has_summary, r.is_event, r.geo_focus FROM (SELECT *, row_number() OVER (PARTITION BY week, section, pos
  ORDER BY id_pos) AS f FROM valid) v JOIN report_items r ON r.week = v.week AND r.id = v.item_id WHERE f = 1 AND section IN ('key_findings', 'cz_items', 'world_items')),
ranked AS (SELECT *, CASE section WHEN 'key_findings' THEN 0 WHEN 'cz_items' THEN 1 ELSE 2 END AS p FROM leads)"""


@query(with_views("", "sections", "report_items").rstrip() + ", " + _LINKS + _LEADS + """,
once AS (SELECT *, row_number() OVER (PARTITION BY week, id ORDER BY p, pos) AS n FROM ranked WHERE has_summary AND (p = 0 OR NOT is_event))
SELECT week, place, id FROM (SELECT *, row_number() OVER (PARTITION BY week ORDER BY p, pos) AS place FROM once WHERE n = 1) WHERE place <= 3""")
def filled_findings(d):
    sections, items = _report(d)
    return report.fill_findings(report.valid_evidence(sections, items), items).select("week", "place", "id")


_CHECKED = """own AS (SELECT * FROM (SELECT week, section, pos, geo, unnest([1, 2, 3, 4]) AS id_pos, unnest([e1, e2, e3, e4]) AS item_id FROM sections)
  WHERE id_pos = 1 OR section NOT IN ('key_findings', 'cz_items', 'world_items')),
valid AS (SELECT o.week, section, pos, any_value(o.geo) AS geo, item_id, min(id_pos) AS id_pos FROM own o JOIN report_items r ON r.week = o.week AND r.id = item_id
  GROUP BY o.week, section, pos, item_id),
points AS (SELECT week, section, pos, any_value(geo) AS geo, arg_min(item_id, id_pos) AS lead FROM valid GROUP BY ALL),
uniq AS (SELECT *, CASE WHEN section IN ('key_findings', 'cz_items', 'world_items') THEN row_number() OVER (PARTITION BY week, section, lead ORDER BY pos) ELSE 1 END AS u FROM points),
numbered AS (SELECT *, row_number() OVER (PARTITION BY week, section ORDER BY CASE WHEN section IN ('strengths', 'threats') THEN CASE geo WHEN 'CZ' THEN 0
  WHEN 'EU' THEN 1 WHEN 'US' THEN 2 ELSE 3 END ELSE 0 END, pos) AS place FROM uniq WHERE u = 1),
capped AS (SELECT * FROM numbered WHERE place <= CASE section WHEN 'key_findings' THEN 3 WHEN 'strengths' THEN 6 WHEN 'threats' THEN 6
  WHEN 'cz_items' THEN 7 WHEN 'world_items' THEN 6 WHEN 'watchlist' THEN 10 ELSE 2147483647 END),
good AS (SELECT week FROM capped GROUP BY week HAVING count_if(section IN ('cz_items', 'world_items')) >= 3 AND count_if(section = 'key_findings') > 0),
ev AS (SELECT v.week, v.section, c.place AS pos, v.item_id, v.id_pos, r.is_event, r.has_summary FROM valid v JOIN capped c USING (week, section, pos)
  JOIN good USING (week) JOIN report_items r ON r.week = v.week AND r.id = v.item_id),
moved AS (SELECT *, row_number() OVER (PARTITION BY week, item_id ORDER BY o, pos, id_pos) AS n FROM (SELECT *, CASE section WHEN 'key_findings' THEN 0 WHEN 'cz_items' THEN 1
  WHEN 'world_items' THEN 2 WHEN 'strengths' THEN 3 WHEN 'threats' THEN 6 WHEN 'surveys' THEN 7 ELSE 8 END AS o FROM ev WHERE section <> 'watchlist' AND is_event)),
missing AS (SELECT * FROM moved m WHERE n = 1 AND NOT EXISTS (SELECT 1 FROM ev w WHERE w.section = 'watchlist' AND w.week = m.week AND w.item_id = m.item_id)),
last AS (SELECT week, max(pos) AS last FROM ev WHERE section = 'watchlist' GROUP BY week),
watch AS (SELECT week, pos, string_agg(item_id, '|' ORDER BY id_pos) AS ids FROM ev WHERE section = 'watchlist' GROUP BY week, pos
  UNION ALL SELECT m.week, coalesce(last, -1) + row_number() OVER (PARTITION BY m.week ORDER BY o, pos, id_pos, item_id), item_id FROM missing m LEFT JOIN last USING (week)),
body AS (SELECT *, CASE section WHEN 'cz_items' THEN 0 WHEN 'world_items' THEN 1 WHEN 'surveys' THEN 2 WHEN 'recommendations' THEN 3 END AS r FROM ev
  WHERE section <> 'watchlist' AND NOT is_event),
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY week, item_id, r IS NULL ORDER BY r, pos, id_pos) AS n FROM body) WHERE r IS NULL OR n = 1),
finding AS (SELECT week, item_id, p, pos, row_number() OVER (PARTITION BY week, item_id ORDER BY p, pos) AS n FROM (
  SELECT *, CASE section WHEN 'key_findings' THEN 0 WHEN 'cz_items' THEN 1 ELSE 2 END AS p FROM once WHERE section IN ('key_findings', 'cz_items', 'world_items') AND has_summary))
SELECT week, section, pos, string_agg(item_id, '|' ORDER BY id_pos) AS ids FROM once WHERE section <> 'key_findings' GROUP BY week, section, pos
UNION ALL SELECT week, 'watchlist', pos, ids FROM (SELECT *, row_number() OVER (PARTITION BY week ORDER BY pos) AS n FROM watch) WHERE n <= 10
UNION ALL SELECT week, 'key_findings', place, item_id FROM (SELECT *, row_number() OVER (PARTITION BY week ORDER BY p, pos) AS place FROM finding WHERE n = 1) WHERE place <= 3"""


@query(with_views("", "sections", "report_items").rstrip() + ", " + _CHECKED)
def checked_report(d):
    """All checks of a drafted report, one after the other, as the weekly run applies them."""
    sections, items = _report(d)
    return _flat(report.checked_report(sections, items, sections.select("week"))[0])


_DIGEST = _LEADS + """, usable AS (SELECT *, row_number() OVER (PARTITION BY week, id ORDER BY p, pos) AS n FROM ranked WHERE has_summary AND NOT is_event),
grouped AS (SELECT *, row_number() OVER (PARTITION BY week, geo_focus = 'CZ' ORDER BY p, pos) AS k FROM usable WHERE n = 1),
digest AS (SELECT *, row_number() OVER (PARTITION BY week ORDER BY CASE WHEN k > 1 THEN 2 WHEN geo_focus = 'CZ' THEN 0 ELSE 1 END, p, pos) AS place FROM grouped)"""


@query(with_views("", "sections", "report_items").rstrip() + ", " + _LINKS + _DIGEST + """
SELECT d.week, d.place, d.id, r.title, r.url, r.geo_focus FROM digest d JOIN report_items r ON r.week = d.week AND r.id = d.id WHERE place <= 3""")
def digest_default(d):
    """First domestic, first foreign, next best finding, with title and address from the report."""
    sections, items = _report(d)
    candidates = report.digest_candidates(report.valid_evidence(sections, items))
    return report.digest_rows(report.digest_default(candidates, items), items).select("week", "place", "id", "title", "url", "geo_focus")


@query(with_views("", "sections", "report_items").rstrip() + ", " + _LINKS + _DIGEST + """,
points AS (SELECT week, pos, item_id AS id FROM valid v WHERE section = 'key_findings' AND id_pos = (SELECT min(id_pos) FROM valid w
  WHERE w.week = v.week AND w.section = v.section AND w.pos = v.pos)),
uniq AS (SELECT week, id, min(pos) AS pos FROM points GROUP BY week, id),
capped AS (SELECT *, row_number() OVER (PARTITION BY week ORDER BY pos) AS c FROM uniq),
found AS (SELECT f.week, f.id, r.geo_focus, row_number() OVER (PARTITION BY f.week ORDER BY f.pos) AS k FROM capped f
  JOIN report_items r ON r.week = f.week AND r.id = f.id WHERE c <= 3 AND r.has_summary AND NOT r.is_event),
spare AS (SELECT week, id, geo_focus, place AS k, row_number() OVER (PARTITION BY week, geo_focus = 'CZ' ORDER BY place) AS g FROM digest d
  WHERE place <= 3 AND NOT EXISTS (SELECT 1 FROM found f WHERE f.week = d.week AND f.id = d.id)),
line AS (SELECT week, id, geo_focus, k, 2 * k AS o FROM found UNION ALL SELECT week, id, geo_focus, k, CASE WHEN g = 1 AND NOT EXISTS (
  SELECT 1 FROM found f WHERE f.week = s.week AND (f.geo_focus = 'CZ') = (s.geo_focus = 'CZ')) THEN 5 ELSE 10 END FROM spare s),
cut AS (SELECT *, row_number() OVER (PARTITION BY week ORDER BY o, k) AS n FROM line)
SELECT week, row_number() OVER (PARTITION BY week ORDER BY geo_focus = 'CZ' DESC, n) AS place, id, geo_focus FROM cut WHERE n <= 3""")
def digest_mixed(d):
    """Findings of the report, completed to a domestic and foreign mix."""
    sections, items = _report(d)
    sections = report.valid_evidence(sections, items)
    candidates = report.digest_candidates(sections)
    found = report.capped_sections(sections).where("section = 'key_findings'").select(
        "week", "pos", F.col("evidence_ids")[0].alias("id"))
    return report.mixed_findings(found, candidates, items)


@query(with_views("", "report_items", "sections").rstrip() + """
SELECT r.week, r.id, r.geo_focus, trim(r.summary_raw) <> '' AS has_summary, l.doc_id IS NOT NULL AS from_media FROM report_items r
LEFT JOIN labels l ON CAST(l.doc_id AS VARCHAR) = r.id""")
def report_references(d):
    media_ids = d.table("labels").select(F.col("doc_id").cast("string").alias("id"))
    return report.item_references(d.view("report_items").drop("has_summary"), media_ids).select(
        "week", "id", "geo_focus", "has_summary", "from_media")


@query("""SELECT strftime(o_orderdate, '%G-W%V') AS week, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 20""")
def latest_weeks(d):
    weeks = d.table("orders").groupBy(dates.week_of(F.col("o_orderdate").cast("timestamp")).alias("week")).agg(F.count("*").alias("n"))
    return report.latest_weeks(weeks, 20)


@query("""SELECT doc_id, array_to_string(list_filter(a, lambda x: NOT list_contains(b, x)), '|') AS missing,
 array_to_string(list_filter(a, lambda x: list_contains(b, x)), '|') AS both_ids FROM (SELECT doc_id, [doc_id % 5, n_chars % 5, (doc_id + 1) % 5] AS a0,
 [n_chars % 5, 3] AS b, CASE WHEN doc_id % 5 = n_chars % 5 THEN [doc_id % 5, (doc_id + 1) % 5] WHEN n_chars % 5 = (doc_id + 1) % 5 THEN [doc_id % 5, n_chars % 5]
  ELSE [doc_id % 5, n_chars % 5, (doc_id + 1) % 5] END AS a FROM documents)""")
def id_sets(d):
    """Distinct ids in order, those missing from and those shared with another list."""
    i, n = F.col("doc_id"), F.col("n_chars")
    a, b = F.array_distinct(F.array(i % 5, n % 5, (i + 1) % 5)), F.array(n % 5, F.lit(3).cast("long"))
    return d.table("documents").select("doc_id", F.array_join(F.array_except(a, b), "|").alias("missing"),
                                       F.array_join(F.array_intersect(a, b), "|").alias("both_ids"))


# == usage =========================================================================================================

PRICES = [("model-a", 1.0, 5.0, 1.25, 0.1), ("model-a-long", 2.0, 10.0, None, None), ("model-b", 4.0, 20.0, 5.0, 0.2)]
_PRICE_SQL = """prices AS (SELECT * FROM (VALUES (0, 'model-a', 1.0::DOUBLE, 5.0::DOUBLE, 1.25::DOUBLE, 0.1::DOUBLE),
 (1, 'model-a-long', 2.0, 10.0, 2.5, 0.2), (2, 'model-b', 4.0, 20.0, 5.0, 0.2)) t(position, name, i, o, cw, cr)),
ledger AS (SELECT CASE o_orderkey % 5 WHEN 0 THEN 'model-a' WHEN 1 THEN 'model-a-long' WHEN 2 THEN 'model-b-2026' WHEN 3 THEN 'model-a-short' ELSE 'other' END AS model,
 o_orderkey % 1000 AS ti, o_custkey % 500 AS t_o, o_orderkey % 10 AS tw, o_custkey % 20 AS tr FROM orders),
priced AS (SELECT m.model, coalesce(e.name, (SELECT name FROM prices p WHERE starts_with(m.model, p.name) ORDER BY position LIMIT 1), 'model-b') AS name
 FROM (SELECT DISTINCT model FROM ledger) m LEFT JOIN prices e ON e.name = m.model),
costed AS (SELECT l.*, (ti * i + t_o * o + tw * cw + tr * cr) / 1000000 AS cost FROM ledger l JOIN priced USING (model) JOIN prices p ON p.name = priced.name)"""


@query("WITH " + _PRICE_SQL + """ SELECT model, count(*) AS calls, CASE WHEN grouping(model) = 1 THEN sum(ti) ELSE sum(ti + tw + tr) END AS input_tokens,
 sum(t_o) AS output_tokens, round_even(sum(cost), 4) AS cost FROM costed GROUP BY ROLLUP (model)""")
def usage_totals(d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    model = (F.when(k % 5 == 0, "model-a").when(k % 5 == 1, "model-a-long").when(k % 5 == 2, "model-b-2026")
             .when(k % 5 == 3, "model-a-short").otherwise("other"))
    ledger = d.table("orders").select(model.alias("model"), (k % 1000).alias("input_tokens"), (c % 500).alias("output_tokens"),
                                      (k % 10).alias("cache_write_tokens"), (c % 20).alias("cache_read_tokens"))
    prices = d.spark.createDataFrame([(i, *p) for i, p in enumerate(PRICES)],
                                     "position int, name string, input double, output double, cache_write double, cache_read double")
    totals = usage.usage_totals(usage.call_costs(ledger, prices))
    return totals.select("model", "calls", "input_tokens", "output_tokens", F.bround("cost_usd", 4).alias("cost"))


# == source jobs on payloads built from the tables =================================================================

def _escape(c):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _payload_frame(rows: DataFrame) -> DataFrame:
    return rows.withColumn("content_type", F.lit("")).withColumn("fetched_at", F.lit("2026-10-12 06:00:00").cast("timestamp"))


_FLAT_TITLE = "trim(regexp_replace(split_part(text, chr(10), 1), '\\s+', ' ', 'g'))"


@query(f"""SELECT source AS source_id, 'https://example.org/' || doc_id AS url, {_FLAT_TITLE} AS title,
 strftime(TIMESTAMP '2026-01-01 00:00:00' + INTERVAL 1 HOUR * CAST(n_chars % 2000 AS INT), '%Y-%m-%d %H:%M') AS published, '10.1/' || doc_id AS doi,
 md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS body FROM documents WHERE {_FLAT_TITLE} <> ''""")
def feed_job(d):
    """RSS and Atom payloads, one per document (even and odd lengths), through the feed job."""
    docs = d.table("documents")
    title, body = _escape(F.split_part("text", F.lit("\n"), F.lit(1))), _escape(F.col("text"))
    when = F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("n_chars") % 2000)
    link = F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string"))
    doi = F.concat(F.lit("10.1/"), F.col("doc_id").cast("string"))
    rss = F.concat(F.lit("<?xml version='1.0'?><rss version='2.0'><channel><title>f</title><item><title>"), title, F.lit("</title><link>"), link,
                   F.lit("</link><pubDate>"), F.date_format(when, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0000</pubDate><description>"), body,
                   F.lit("</description><prism:doi>"), doi, F.lit("</prism:doi></item></channel></rss>"))
    atom = F.concat(F.lit("<feed><title>f</title><entry><title type='html'>"), title, F.lit("</title><link rel='alternate' href='"), link,
                    F.lit("'/><published>"), F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00</published><summary>"), body,
                    F.lit("</summary><prism:doi>"), doi, F.lit("</prism:doi></entry></feed>"))
    rows = _payload_frame(docs.select(F.col("doc_id").cast("string").alias("payload_id"), F.col("source").alias("source_id"), link.alias("url"),
                                      F.when(F.col("n_chars") % 2 == 0, rss).otherwise(atom).alias("body")))
    parsed = feeds.parse_feeds(rows).where("problem is null")
    flat = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    return parsed.where(flat("title") != "").select(
        "source_id", "url", flat("title").alias("title"), F.date_format("published", "yyyy-MM-dd HH:mm").alias("published"), "doi",
        F.md5(flat("summary")).alias("body"))


@query(f"""WITH docs AS (SELECT *, {_FLAT_TITLE} AS title, TIMESTAMP '2026-01-01 00:00:00' + INTERVAL 1 HOUR * CAST(n_chars % 2000 AS INT) AS posted
 FROM documents WHERE source IS NOT NULL),
found AS (SELECT source, count(*) FILTER (n_chars % 97 <> 0 AND title <> '') AS n, max(posted) FILTER (n_chars % 97 <> 0 AND title <> '') AS newest,
 count(*) FILTER (n_chars % 97 = 0) AS broken FROM docs GROUP BY source)
SELECT source AS source_id, CASE WHEN broken > 0 THEN 'parse_error' WHEN n = 0 THEN 'empty' WHEN newest < TIMESTAMP '2026-10-12 06:00:00' - INTERVAL 60 DAY THEN 'stale'
 ELSE 'ok' END AS status, n AS "count", strftime(newest, '%Y-%m-%d %H:%M') AS newest FROM found
UNION ALL SELECT 'off ' || source, 'disabled', 0, NULL FROM found UNION ALL SELECT 'silent ' || source, 'empty', 0, NULL FROM found""")
def collected_health(d):
    """Feed payloads, some of them pages instead of feeds, through a collector: what is known of each source after the run."""
    docs = d.table("documents").where("source is not null")
    when = F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("n_chars") % 2000)
    link = F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string"))
    rss = F.concat(F.lit("<rss version='2.0'><channel><item><title>"), _escape(F.split_part("text", F.lit("\n"), F.lit(1))), F.lit("</title><link>"), link,
                   F.lit("</link><pubDate>"), F.date_format(when, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0000</pubDate></item></channel></rss>"))
    payloads = _payload_frame(docs.select(
        F.col("doc_id").cast("string").alias("payload_id"), F.col("source").alias("source_id"), link.alias("url"),
        F.when(F.col("n_chars") % 97 == 0, F.lit("<!doctype html><html><body>Moved</body></html>")).otherwise(rss).alias("body")))
    lead = F.explode(F.array(F.lit(""), F.lit("off "), F.lit("silent ")))
    sources = docs.select("source").distinct().withColumn("lead", lead).select(
        F.concat("lead", "source").alias("id"), F.col("source").alias("name"), F.lit("rss").alias("type"), F.lit("").alias("url"), F.lit("EU").alias("region"),
        F.lit("ngo").alias("source_type"), F.lit("en").alias("language"), F.lit(True).alias("topic_filter"), F.lit(1.0).alias("weight"),
        (F.col("lead") != "off ").alias("enabled"), F.lit("").alias("notes"))
    _, healths = collect.from_payloads(payloads)(sources, NOW)
    known = health.merge_health(healths.limit(0), healths, sources)
    return known.select("source_id", "status", "count", F.date_format("newest", "yyyy-MM-dd HH:mm").alias("newest"))


@query(f"""SELECT source AS source_id, 'https://example.org/' || doc_id AS url, {_FLAT_TITLE} AS title,
 strftime(TIMESTAMP '2026-01-01 00:00:00' + INTERVAL 1 HOUR * CAST(n_chars % 2000 AS INT), '%Y-%m-%d %H:%M') AS published,
 md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS body FROM documents WHERE {_FLAT_TITLE} <> ''""")
def wordpress_job(d):
    """Posts in the standard and in the custom shape, one payload per document."""
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    when = F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("n_chars") % 2000)
    link = F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string"))
    standard = F.to_json(F.array(F.struct(F.struct(title.alias("rendered")).alias("title"), link.alias("link"),
                                          F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss").alias("date_gmt"),
                                          F.struct(F.col("text").alias("rendered")).alias("excerpt"), F.lit(7).alias("author"))))
    custom = F.to_json(F.array(F.struct(title.alias("title"), link.alias("url"), F.date_format(when, "yyyy-MM-dd HH:mm:ss").alias("pubDate"),
                                        F.col("text").alias("description"), F.lit("A. Author").alias("author"))))
    rows = _payload_frame(d.table("documents").select(
        F.col("doc_id").cast("string").alias("payload_id"), F.col("source").alias("source_id"), link.alias("url"),
        F.when(F.col("n_chars") % 2 == 0, standard).otherwise(custom).alias("body")))
    flat = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    return feeds.parse_wordpress(rows).where("problem is null").where(flat("title") != "").select(
        "source_id", "url", flat("title").alias("title"), F.date_format("published", "yyyy-MM-dd HH:mm").alias("published"),
        F.md5(flat("summary")).alias("body"))


@query("""WITH links AS (SELECT page_id, url, unnest(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), '<a href="([^"]*)">', 1)) AS href FROM pages)
SELECT page_id, absolute AS url FROM (SELECT DISTINCT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS absolute FROM links)""")
def listing_job(d):
    """The navigation of every page read as a listing."""
    pages = d.table("pages")
    rule = registry.source_table(d.spark, [{"id": "pages", "name": "pages", "type": "scrape", "url": "https://example.org",
                                            "scrape": {"item": "nav > ul > li", "title": "a"}}])
    rows = _payload_frame(pages.select(F.col("page_id").cast("string").alias("payload_id"), F.lit("pages").alias("source_id"), "url",
                                       F.col("html").alias("body")))
    return listing.parse_listings(rows, rule).where("problem is null").select(F.col("payload_id").cast("long").alias("page_id"), "url")


@query(f"""SELECT 'https://doi.org/10.9/' || doc_id AS url, {_FLAT_TITLE} AS title, strftime(DATE '2026-01-01' + CAST(n_chars % 300 AS INT), '%Y-%m-%d') AS published,
 CASE WHEN n_chars % 2 = 0 THEN 'journal-joule' ELSE 'journal-energy-policy' END AS source_id, 'Ann ' || lang || '|' || source AS authors
FROM documents WHERE n_chars % 9 <> 0""")
def crossref_job(d):
    """Crossref responses, one work each; every ninth is no article."""
    when = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("n_chars") % 300).cast("int"))
    doi = F.concat(F.lit("10.9/"), F.col("doc_id").cast("string"))
    work = F.struct(doi.alias("DOI"), F.when(F.col("n_chars") % 9 == 0, "book").otherwise("journal-article").alias("type"),
                    F.split(F.split_part("text", F.lit("\n"), F.lit(1)), " ").alias("title"),
                    F.array(F.struct(F.lit("Ann").alias("given"), F.col("lang").alias("family")), F.struct(F.lit("").alias("given"), F.col("source").alias("family"))).alias("author"),
                    F.struct(F.array(F.array(F.year(when), F.month(when), F.dayofmonth(when))).alias("date-parts")).alias("published-online"))
    body = F.to_json(F.struct(F.struct(F.array(work).alias("items")).alias("message")))
    rows = _payload_frame(d.table("documents").select(
        F.col("doc_id").cast("string").alias("payload_id"), F.when(F.col("n_chars") % 2 == 0, "2542-4351").otherwise("0301-4215").alias("source_id"),
        F.lit("").alias("url"), body.alias("body")))
    return academic.parse_crossref(rows, academic.journal_table(d.spark)).select(
        "url", F.trim(F.regexp_replace("title", r"\s+", " ")).alias("title"), F.date_format("published", "yyyy-MM-dd").alias("published"),
        "source_id", F.array_join("authors", "|").alias("authors"))


@query("""SELECT 'https://doi.org/10.8/' || doc_id AS url, CASE n_chars % 3 WHEN 0 THEN 'Joule' WHEN 1 THEN 'Energy Policy' ELSE 'Venue ' || lang END AS source_name,
 n_chars % 3 <> 3 AS topic_filter, array_to_string(list_filter(string_split(trim(regexp_replace(split_part(text, chr(10), 1), '\\s+', ' ', 'g')), ' '), lambda w: w <> ''), ' ') AS abstract
FROM documents""")
def openalex_job(d):
    """OpenAlex responses with the first line of each document as an inverted abstract."""
    k = F.col("n_chars") % 3
    words = F.split(F.trim(F.regexp_replace(F.split_part("text", F.lit("\n"), F.lit(1)), r"\s+", " ")), " ")
    index = academic.invert_abstract(F.filter(words, lambda w: w != ""))
    doi = F.concat(F.lit("https://doi.org/10.8/"), F.col("doc_id").cast("string"))
    issn = F.when(k == 0, F.array(F.lit("0000-0000"), F.lit("2542-4351"))).when(k == 1, F.array(F.lit("0301-4215"))).otherwise(F.array(F.lit("1111-1111")))
    work = F.struct(doi.alias("doi"), F.lit("T").alias("title"), F.lit("2026-09-22").alias("publication_date"), index.alias("abstract_inverted_index"),
                    F.struct(F.lit("https://x.org").alias("landing_page_url"),
                             F.struct(F.concat(F.lit("Venue "), "lang").alias("display_name"), issn.alias("issn")).alias("source")).alias("primary_location"))
    rows = _payload_frame(d.table("documents").select(F.col("doc_id").cast("string").alias("payload_id"), F.lit("openalex").alias("source_id"),
                                                      F.lit("").alias("url"), F.to_json(F.struct(F.array(work).alias("results"))).alias("body")))
    return academic.parse_openalex(rows, academic.journal_table(d.spark)).select("url", "source_name", "topic_filter", F.col("summary").alias("abstract"))


@query("""SELECT 'HORIZON-' || l_orderkey AS identifier, min(CASE WHEN l_quantity > 0 THEN l_quantity * 1000 END) AS contribution_min,
 max(l_quantity * 1000) AS contribution_max, sum(CAST(l_quantity AS BIGINT)) AS budget_total, CAST(count(*) AS INT) AS grants,
 strftime(min(CASE WHEN l_shipdate + INTERVAL 30 YEAR >= TIMESTAMP '2026-10-12 06:00:00' THEN l_shipdate + INTERVAL 30 YEAR END), '%Y-%m-%d') AS deadline
FROM lineitem GROUP BY l_orderkey HAVING max(l_shipdate + INTERVAL 30 YEAR) >= TIMESTAMP '2026-10-12 06:00:00'""")
def funding_job(d):
    """Portal results: orders as calls, their lines as actions of the nested budget document and as rounds."""
    k = F.col("l_orderkey").cast("string")
    identifier = F.concat(F.lit("HORIZON-"), k)
    # an order's lines are collected as numbers and spelled out afterwards
    grouped = d.table("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_quantity", "l_shipdate")).alias("lines"))
    actions = F.transform("lines", lambda x: F.struct(
        F.concat(F.lit("HORIZON-"), k, F.lit(" - Actions")).alias("action"), F.lit(1).alias("expectedGrants"),
        (x["l_quantity"] * 1000).alias("minContribution"), (x["l_quantity"] * 1000).alias("maxContribution"),
        F.create_map(F.lit("2027"), x["l_quantity"].cast("long").cast("string")).alias("budgetYearMap")))
    other = F.struct(F.lit("OTHER - Actions").alias("action"), F.lit(9).alias("expectedGrants"), F.lit(1.0).alias("minContribution"),
                     F.lit(1e9).alias("maxContribution"), F.create_map(F.lit("2027"), F.lit("5")).alias("budgetYearMap"))
    rounds = F.transform("lines", lambda x: F.concat(F.date_format(
        (x["l_shipdate"] + F.expr("INTERVAL 30 YEARS")).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0000")))
    overview = F.to_json(F.struct(F.create_map(F.lit("1"), actions, F.lit("2"), F.array(other)).alias("budgetTopicActionMap")))
    md = F.struct(F.array(identifier).alias("identifier"), F.array(F.lit("Energy transition")).alias("title"), rounds.alias("deadlineDate"),
                  F.array(overview).alias("budgetOverview"), F.array(F.lit("SSH")).alias("crossCuttingPriorities"))
    body = F.to_json(F.struct(F.array(F.struct(F.concat(F.lit("https://x.org/"), k).alias("url"), md.alias("metadata"))).alias("results")))
    rows = _payload_frame(grouped.select(k.alias("payload_id"), F.lit("eu").alias("source_id"), F.lit("").alias("url"), body.alias("body"))).withColumn(
        "query_no", F.lit(0)).withColumn("ssh_query", F.lit(False))
    return funding.parse_calls(rows).select("identifier", "contribution_min", "contribution_max", F.col("budget_total").cast("long").alias("budget_total"),
                                            "grants", F.date_format("deadline", "yyyy-MM-dd").alias("deadline"))


@query("""SELECT id, query_no FROM (SELECT l_partkey AS id, l_linenumber AS query_no, row_number() OVER (PARTITION BY l_partkey
 ORDER BY l_linenumber, l_orderkey) AS n FROM lineitem) WHERE n = 1""")
def first_query_wins(d):
    """Results of several queries, one row per id; the earlier query wins."""
    rows = d.table("lineitem").select(F.col("l_partkey").alias("id"), F.col("l_linenumber").alias("query_no"), "l_orderkey")
    return distinct_first(rows, "id", F.col("query_no"), F.col("l_orderkey")).select("id", "query_no")


def queries():
    return {name: run for name, (run, _) in REGISTERED.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in REGISTERED.items() if sql}
