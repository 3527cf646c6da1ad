"""Feed payloads (RSS 2.0, Atom, RSS 1.0/RDF) and WordPress JSON to entries, inside the JVM's XML and JSON readers.

Every job returns entries plus, through ``problem``, the payloads it could not read: a bad payload becomes a health
row and never fails the run. A payload is read once: all shapes become one array of entries, the problem is a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions.dates import parse_date
from pressmill.functions.urls import absolute_url
from pressmill.operators.items import build_items, with_source
from pressmill.session import cut_lineage
from pressmill.sources.payloads import payload_kind, problems

_ITEM = """struct<title:string, link:string, guid:string, pubDate:string, `dc:date`:string, date:string,
    description:string, `content:encoded`:string, author:string, `dc:creator`:array<string>,
    `dc:identifier`:string, `prism:doi`:string>"""
_ENTRY = """struct<title:string, link:array<struct<_href:string,_rel:string>>, published:string, updated:string,
    created:string, summary:string, content:array<string>, author:array<struct<name:string>>, `prism:doi`:string>"""
FEED = (f"channel struct<title:string, item:array<{_ITEM}>>, item array<{_ITEM}>, entry array<{_ENTRY}>, "
        "title string, _corrupt_record string")

_POST = """struct<title:string, link:string, url:string, excerpt:string, description:string, author:string,
    date_gmt:string, pubDate:string, date:string, modified_gmt:string, modified:string>"""
_RENDERED = "rendered string"


def _readable(body: Column) -> Column:
    """Escape ampersands that are no XML entity, as lenient readers do."""
    return F.regexp_replace(body, r"&(?!(amp|lt|gt|quot|apos|#\d+|#x[0-9a-fA-F]+);)", "&amp;")


def _first_date(now: Column, *values: Column) -> Column:
    """The first of several spellings that yields a date."""
    return F.coalesce(*[parse_date(v, now) for v in values])


def _blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


_ENTRY_FIELDS = ("title", "link", "dates", "summary", "authors", "doi", "identifier", "problem")
_FEED_DATES, _POST_DATES = 3, 5  # places where a date may stand


def _common(**fields: Column) -> Column:
    """One entry in the shape that all payloads share; ``link`` null means that there is no entry."""
    empty = {n: F.lit(None).cast("array<string>" if n in ("dates", "authors") else "string") for n in _ENTRY_FIELDS}
    return F.struct(*((empty | fields)[n].alias(n) for n in _ENTRY_FIELDS))


def _or_problem(problem: Column, entries: Column) -> Column:
    """The entries, or the problem as the only one: inside the array, a filter on it can't be pushed below the parse and repeat it."""
    return F.when(problem.isNotNull(), F.array(_common(problem=problem))).otherwise(entries)


def _feed_item(e: Column) -> Column:
    return _common(
        title=e["title"], link=F.coalesce(_blank_to_null(e["link"]), _blank_to_null(e["guid"])),
        dates=F.array(e["pubDate"], e["dc:date"], e["date"]),
        summary=F.coalesce(_blank_to_null(e["description"]), e["content:encoded"]),
        authors=F.when(F.size(e["dc:creator"]) > 0, e["dc:creator"]).otherwise(F.array(e["author"])),
        doi=e["prism:doi"], identifier=e["dc:identifier"])


def _feed_entry(e: Column) -> Column:
    main = F.filter(e["link"], lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    return _common(
        title=e["title"], link=F.coalesce(F.get(main, F.lit(0))["_href"], F.get(e["link"], F.lit(0))["_href"]),
        dates=F.array(e["published"], e["updated"], e["created"]),
        summary=F.coalesce(_blank_to_null(e["summary"]), F.get(e["content"], F.lit(0))),
        authors=F.transform(e["author"], lambda a: a["name"]), doi=e["prism:doi"])


def _read_feeds(payloads: DataFrame, mine: Column) -> DataFrame:
    """Adds ``entries``, or the problem as one, for the payloads that are ``mine``."""
    rows = payloads.withColumn("kind", payload_kind(F.col("body"), F.col("content_type")))
    rows = rows.withColumn("doc", F.from_xml(F.when(mine & (F.col("kind") == "ok"), _readable(F.col("body"))), FEED,
                                             {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    items = F.coalesce("doc.channel.item", "doc.item")
    unread = F.col("doc._corrupt_record").isNotNull() & items.isNull() & F.col("doc.entry").isNull()
    problem = F.when(mine, F.when(F.col("kind") != "ok", F.col("kind")).when(unread, "parse_error"))
    found = F.concat(*(F.coalesce(e, F.array()) for e in (F.transform(items, _feed_item), F.transform("doc.entry", _feed_entry))))
    return rows.withColumn("entries", _or_problem(problem, found)).drop("kind", "doc")


def _entry_rows(rows: DataFrame, linked: Column, n_dates: int) -> DataFrame:
    """One row per entry, and one per payload with a problem, from a single pass; addresses that are ``linked`` are made absolute."""
    rows = (rows.withColumn("linked", linked).withColumnsRenamed({"url": "_base", "fetched_at": "now"})
            .select("payload_id", "source_id", "_base", "now", "linked", F.posexplode_outer("entries").alias("feed_pos", "e"))
            .where("e.problem is not null or e.link is not null"))
    e = {n: F.col("e")[n] for n in _ENTRY_FIELDS}
    named_doi = F.when(F.contains(e["identifier"], F.lit("10.")) & F.contains(F.lower(e["identifier"]), F.lit("doi")), e["identifier"])
    url = F.when(F.col("linked"), absolute_url(F.replace(e["link"], F.lit("&amp;"), F.lit("&")), F.col("_base"))).otherwise(e["link"])
    return rows.select(
        "payload_id", "source_id", F.when(e["problem"].isNull(), F.col("feed_pos")).alias("feed_pos"), e["title"].alias("title"), url.alias("url"),
        _first_date(F.col("now"), *[F.get(e["dates"], F.lit(i)) for i in range(n_dates)]).alias("published"),
        e["summary"].alias("summary"), F.transform(e["authors"], lambda a: F.trim(a)).alias("authors"),
        F.coalesce(_blank_to_null(e["doi"]), named_doi).alias("doi"), F.lit(None).cast("string").alias("language"), "now", e["problem"].alias("problem"))


def parse_feeds(payloads: DataFrame) -> DataFrame:
    """payload_id, source_id, feed_pos, title, url, published, summary, authors, doi, language, now, problem."""
    return _entry_rows(_read_feeds(payloads, F.lit(True)), F.lit(True), _FEED_DATES)


def _rendered(value: Column) -> Column:
    """WordPress text: an object with ``rendered``, or a plain string."""
    return F.when(F.startswith(F.ltrim(value), F.lit("{")), F.from_json(value, _RENDERED)["rendered"]).otherwise(value)


def _post(p: Column) -> Column:
    gmt = p["date_gmt"]
    return _common(
        title=_rendered(p["title"]),
        link=F.when(p.isNotNull(), F.coalesce(_blank_to_null(p["link"]), _blank_to_null(p["url"]), F.lit(""))),
        dates=F.array(F.when(gmt != "", F.when(F.endswith(gmt, F.lit("Z")), gmt).otherwise(F.concat(gmt, F.lit("Z")))),
                      p["pubDate"], p["date"], p["modified_gmt"], p["modified"]),
        summary=F.coalesce(_blank_to_null(_rendered(p["excerpt"])), _rendered(p["description"])),
        # an author given by number is not a name
        authors=F.when(p["author"].isNotNull() & ~p["author"].rlike(r"^\d+$"), F.array(p["author"])))


def _read_posts(payloads: DataFrame, mine: Column) -> DataFrame:
    """As ``_read_feeds``, for lists of posts."""
    body = F.regexp_replace("body", "^\ufeff", "")
    rows = payloads.withColumn("posts", F.from_json(F.when(mine & F.startswith(F.ltrim(body), F.lit("[")), body), f"array<{_POST}>"))
    kind = payload_kind(body)
    problem = (F.when(kind != "ok", kind).when(F.get_json_object(body, "$.code").isNotNull(), "parse_error: API error")
               .when(F.col("posts").isNull(), "parse_error: no list"))
    return rows.withColumn("entries", _or_problem(F.when(mine, problem), F.transform("posts", _post))).drop("posts")


def parse_wordpress(payloads: DataFrame) -> DataFrame:
    """Standard posts and custom endpoints (``url``, ``description``, ``pubDate``) to entries, columns as ``parse_feeds``."""
    return _entry_rows(_read_posts(payloads, F.lit(True)), F.lit(False), _POST_DATES)


def feed_entries(payloads: DataFrame, sources: DataFrame) -> DataFrame:
    """Entries and problems of all feed and WordPress payloads; the source's type picks the job, each payload is read once."""
    types = sources.select(F.col("id").alias("source_id"), F.col("type").alias("_type"))
    typed = payloads.join(types.where(F.col("_type").isin("rss", "wp_json")), "source_id")
    feed = F.col("_type") == "rss"
    read = _read_posts(_read_feeds(typed, feed).withColumnRenamed("entries", "_entries"), ~feed)
    return _entry_rows(read.withColumn("entries", F.when(feed, F.col("_entries")).otherwise(F.col("entries"))), feed, _POST_DATES)


def feed_items(payloads: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, problems) of all feed and WordPress payloads, from one parse that is written once."""
    parsed = cut_lineage(feed_entries(payloads, sources))
    return build_items(with_source(parsed.where("problem is null").drop("problem"), sources)), problems(parsed)
