"""Crossref and OpenAlex responses to entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill import config
from pressmill.functions.dates import parse_date
from pressmill.functions.text import bind
from pressmill.functions.urls import journal_slug

_PARTS = "struct<`date-parts`:array<array<int>>>"
CROSSREF = f"""message struct<items:array<struct<DOI:string, URL:string, type:string, title:array<string>,
    abstract:string, author:array<struct<given:string,family:string>>,
    created:struct<`date-time`:string>, `published-online`:{_PARTS}, `published-print`:{_PARTS},
    published:{_PARTS}, issued:{_PARTS}>>>"""
OPENALEX = """results array<struct<id:string, doi:string, title:string, display_name:string, publication_date:string,
    language:string, abstract_inverted_index:map<string,array<int>>,
    primary_location:struct<landing_page_url:string,source:struct<display_name:string,issn:array<string>>>,
    authorships:array<struct<author:struct<display_name:string>>>>>"""


def journal_table(spark, journals=None) -> DataFrame:
    """name, issn, topic_filter, position: a short configuration table."""
    rows = [(n, i, t, k) for k, (n, i, t) in enumerate(journals or config.JOURNALS)]
    return spark.createDataFrame(rows, "name string, issn string, topic_filter boolean, position int")


def invert_abstract(words: Column) -> Column:
    """Running text, as an array of words, to a map word -> positions. Null words are left out.

    The words are sorted once inside the row and cut into runs of equal ones, so the work grows with their number.
    """
    placed = F.filter(F.transform(words, lambda w, p: F.struct(w.alias("w"), p.alias("p"))), lambda x: x["w"].isNotNull())

    def runs(row: Column) -> Column:
        placed, starts = row["placed"], row["starts"]
        ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(F.size(placed)))
        return F.transform(F.arrays_zip(starts.alias("at"), ends.alias("upto")), lambda r: F.struct(
            F.get(placed, r["at"])["w"].alias("key"),
            F.transform(F.slice(placed, r["at"] + 1, r["upto"] - r["at"]), lambda x: x["p"]).alias("value")))

    def starts(placed: Column) -> Column:
        first = F.filter(F.transform(placed, lambda x, i: F.when((i == 0) | (F.get(placed, i - 1)["w"] != x["w"]), i)),
                         lambda i: i.isNotNull())
        return F.struct(placed.alias("placed"), first.alias("starts"))

    return bind(bind(F.sort_array(placed), starts), lambda row: F.when(
        F.size(row["placed"]) > 0, F.map_from_entries(runs(row))).when(
        row["placed"].isNotNull(), F.create_map().cast("map<string,array<int>>")))


def reconstruct_abstract(inverted: Column) -> Column:
    """A map word -> positions back to running text."""
    placed = F.flatten(F.transform(F.map_entries(inverted), lambda e: F.transform(
        F.coalesce(e["value"], F.array().cast("array<int>")), lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    text = F.array_join(F.transform(F.sort_array(F.filter(placed, lambda x: x["p"].isNotNull())), lambda x: x["w"]), " ")
    return F.coalesce(text, F.lit(""))


def full_names(authors: Column) -> Column:
    return F.filter(F.transform(authors, lambda a: F.concat_ws(" ", F.nullif(a["given"], F.lit("")),
                                                               F.nullif(a["family"], F.lit("")))), lambda n: n != "")


def strip_markup(abstract: Column) -> Column:
    return F.regexp_replace(F.coalesce(abstract, F.lit("")), "</?jats:[^>]+>", " ")


def _day_of(parts: Column) -> Column:
    """The first date of a date-parts list; month and day default to 1, impossible dates give null."""
    p = F.try_element_at(parts["date-parts"], F.lit(1))
    def part(i):
        return F.coalesce(F.nullif(F.try_element_at(p, F.lit(i)), F.lit(0)), F.lit(1))

    text = F.format_string("%04d-%02d-%02d", F.try_element_at(p, F.lit(1)), part(2), part(3))
    return F.try_to_date(F.when(F.try_element_at(p, F.lit(1)) > 0, text), "yyyy-MM-dd").cast("timestamp")


def _journal_columns(name: Column, topic_filter: Column) -> dict[str, Column]:
    return {"source_id": journal_slug(name), "source_name": name, "region": F.lit("GLOBAL"),
            "source_type": F.lit("journal"), "source_language": F.lit("en"), "topic_filter": topic_filter,
            "source_weight": F.lit(config.JOURNAL_WEIGHT)}


def parse_crossref(payloads: DataFrame, journals: DataFrame) -> DataFrame:
    """Journal articles with their journal as source. ``payloads.source_id`` is the ISSN asked for."""
    works = (payloads.withColumn("works", F.from_json("body", CROSSREF)["message"]["items"])
             .select("payload_id", F.col("source_id").alias("issn"), F.col("fetched_at").alias("now"),
                     F.posexplode("works").alias("feed_pos", "w"))
             .where(F.coalesce("w.type", F.lit("journal-article")) == "journal-article")
             .join(journals.select("issn", F.col("name").alias("_name"), F.col("topic_filter").alias("_filter")), "issn"))
    created = parse_date(F.col("w.created")["date-time"], F.col("now"))
    published = F.when(F.coalesce(F.col("w.created")["date-time"], F.lit("")) != "", created).otherwise(F.coalesce(*[
        _day_of(F.col("w")[k]) for k in ("published-online", "published-print", "published", "issued")]))
    doi = F.col("w.DOI")
    return works.select(
        "payload_id", "feed_pos", F.array_join(F.coalesce("w.title", F.array().cast("array<string>")), " ").alias("title"),
        F.coalesce(F.nullif("w.URL", F.lit("")), F.concat(F.lit("https://doi.org/"), doi), F.lit("")).alias("url"),
        published.alias("published"), strip_markup(F.col("w.abstract")).alias("summary"),
        full_names(F.coalesce("w.author", F.array().cast("array<struct<given:string,family:string>>"))).alias("authors"),
        doi.alias("doi"), F.lit(None).cast("string").alias("language"), "now",
        *[c.alias(n) for n, c in _journal_columns(F.col("_name"), F.col("_filter")).items()])


def parse_openalex(payloads: DataFrame, journals: DataFrame, default_topic_filter: bool = True) -> DataFrame:
    """Works with a followed journal (by any of their ISSNs) or their own venue as source."""
    works = (payloads.withColumn("works", F.from_json("body", OPENALEX)["results"])
             .select("payload_id", F.col("fetched_at").alias("now"), F.posexplode("works").alias("feed_pos", "w")))
    # the journals are a short configuration table: the first followed one is found inside the row
    issn = F.col("w.primary_location.source.issn")
    followed = [F.when(F.array_contains(issn, j["issn"]), F.struct(F.lit(j["name"]).alias("name"),
                                                                   F.lit(j["topic_filter"]).alias("topic_filter")))
                for j in journals.orderBy("position").collect()]
    nothing = F.lit(None).cast("struct<name:string,topic_filter:boolean>")
    rows = works.withColumn("j", F.coalesce(*followed, nothing))
    venue = F.coalesce(F.nullif("w.primary_location.source.display_name", F.lit("")), F.lit("OpenAlex"))
    name = F.coalesce("j.name", venue)
    doi = F.nullif("w.doi", F.lit(""))
    place = F.coalesce(F.nullif("w.primary_location.landing_page_url", F.lit("")), doi, "w.id", F.lit(""))
    url = (F.when(F.startswith(doi, F.lit("http")), doi)
           .when(doi.isNotNull() & ~F.startswith(place, F.lit("http")), F.concat(F.lit("https://doi.org/"), doi))
           .otherwise(place))
    return rows.select(
        "payload_id", "feed_pos", F.coalesce(F.nullif("w.title", F.lit("")), "w.display_name", F.lit("")).alias("title"),
        url.alias("url"), parse_date(F.col("w.publication_date"), F.col("now")).alias("published"),
        reconstruct_abstract(F.col("w.abstract_inverted_index")).alias("summary"),
        F.transform("w.authorships", lambda a: a["author"]["display_name"]).alias("authors"), doi.alias("doi"),
        F.coalesce(F.nullif("w.language", F.lit("")), F.lit("en")).alias("language"), "now",
        *[c.alias(n) for n, c in _journal_columns(name, F.coalesce("j.topic_filter", F.lit(default_topic_filter))).items()])
