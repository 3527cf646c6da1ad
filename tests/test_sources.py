import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from pressmill import queries as registered
from pressmill.operators.items import build_items
from pressmill.schemas import PAYLOAD
from pressmill.sources import academic, feeds, funding, listing, registry, store

NOW = dt.datetime(2026, 9, 30, 12)

ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>f</title>
 <entry><title type="html">Emise a povolenky</title><link href="https://a.example/self" rel="self"/>
 <link href="https://a.example/emise" rel="alternate"/><published>2026-09-25T00:00:00+02:00</published>
 <author><name>A. B.</name></author><content type="html">&lt;p&gt;Více &lt;em&gt;informací&lt;/em&gt;.&lt;/p&gt;</content></entry></feed>"""
RDF = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:dc="http://purl.org/dc/elements/1.1/"
 xmlns="http://purl.org/rss/1.0/" xmlns:prism="p"><channel><title>J</title></channel><item><title><![CDATA[Paper]]></title>
 <link>https://j.example/p</link><dc:creator>X Y</dc:creator><dc:creator>Z W</dc:creator><dc:identifier>doi:10.1/AB</dc:identifier>
 <dc:date>2026-09-29</dc:date></item></rdf:RDF>"""
RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>x</title>
 <item><title>Vlak &amp; tramvaj</title><link>https://feed.test/a1</link><pubDate>Tue, 05 May 2026 07:15:00 GMT</pubDate></item>
 <item><title>Brno & okolí</title><link>https://feed.test/a2</link></item></channel></rss>"""
EMPTY = '<?xml version="1.0"?><rss version="2.0"><channel><title>x</title></channel></rss>'
WP = json.dumps([None,
                 {"title": {"rendered": "Weir &amp; lock", "protected": False}, "link": "", "url": "https://post.test/weir", "modified_gmt": "2026-07-14T04:05:06Z",
                  "excerpt": {"rendered": " "}, "description": "Plain words"},
                 {"title": {"rendered": ""}, "link": "https://post.test/blank", "date_gmt": "", "date": "soon", "modified": "2026-07-15 09:00:00", "author": "K. L."},
                 {"title": "Third", "link": "https://post.test/3", "date_gmt": "2026-07-16T22:00:00", "date": "2026-07-17T00:00:00", "author": 5,
                  "excerpt": {"rendered": "<ul><li>One</li><li>two</li></ul>"}}])
LISTING = """<html><body><div class="card x"><h3><a href="/a">První zpráva</a></h3><span class="date">1. 9. 2026</span><p class="d">Perex</p></div>
 <div class="card"><h3><a href="/a">Opakovaná</a></h3></div><div class="card"><h3><a href="mailto:x@y">Pošta</a></h3></div>
 <div class="card"><a href="/c"><h3>Bez odkazu v nadpisu</h3></a><time datetime="2026-09-02">včera</time></div></body></html>"""


def landed(spark, *rows):
    return spark.createDataFrame([(str(i), s, "https://a.example/list/", "", b, NOW) for i, (s, b) in enumerate(rows)], PAYLOAD)


def sources(spark):
    return registry.source_table(spark, [
        {"id": s, "name": s.upper(), "type": t, "url": "https://a.example/", "source_type": "ngo", "region": "CZ",
         **({"scrape": {"item": "div.card", "title": "h3 a, h3", "date": "span.date, time", "date_attr": "datetime",
                        "summary": "p.d"}} if t == "scrape" else {})}
        for s, t in (("atom", "rss"), ("rdf", "rss"), ("rss", "rss"), ("empty", "rss"), ("bad", "rss"), ("wp", "wp_json"),
                     ("wperr", "wp_json"), ("page", "scrape"), ("changed", "scrape"))])


def test_feeds_and_isolated_problems(spark):
    items, problems = feeds.feed_items(landed(spark, ("atom", ATOM), ("rdf", RDF), ("rss", RSS), ("empty", EMPTY),
                                              ("bad", "\x01 no xml {"), ("wp", WP), ("wperr", '{"code": "rest_no_route"}')), sources(spark))
    got = {(r.source_id, r.feed_pos): r for r in items.collect()}
    assert got["atom", 0].url == "https://a.example/emise" and got["atom", 0].summary_raw == "Více informací ."
    assert got["atom", 0].published_at == dt.datetime(2026, 9, 24, 22) and got["atom", 0].authors == ["A. B."]
    assert got["rdf", 0].doi == "10.1/ab" and got["rdf", 0].authors == ["X Y", "Z W"]
    assert got["rss", 0].title == "Vlak & tramvaj" and got["rss", 1].published_at is None and got["rss", 1].date_is_first_seen
    # an empty element and a post without a title are no items and keep their places; the first date that can be read counts
    one, three = got["wp", 1], got["wp", 3]
    assert (one.title, one.url, one.summary_raw) == ("Weir & lock", "https://post.test/weir", "Plain words")
    assert one.published_at == dt.datetime(2026, 7, 14, 4, 5, 6) and three.published_at == dt.datetime(2026, 7, 16, 22)
    assert three.summary_raw == "One two" and three.authors == []
    assert {k for k in got if k[0] == "wp"} == {("wp", 1), ("wp", 3)}
    assert {r.source_id for r in problems.collect()} == {"bad", "wperr"}


def test_listing(spark):
    rows = listing.parse_listings(landed(spark, ("page", LISTING), ("changed", "<html><p>Nic</p></html>")), sources(spark)).collect()
    good = {r.url: r for r in rows if r.problem is None}
    assert set(good) == {"https://a.example/a", "https://a.example/c"}
    assert good["https://a.example/a"].title == "První zpráva" and good["https://a.example/a"].summary == "Perex"
    assert good["https://a.example/a"].published == dt.datetime(2026, 9, 1)
    assert good["https://a.example/c"].published == dt.datetime(2026, 9, 2)
    assert [r.source_id for r in rows if r.problem] == ["changed"]


def test_academic(spark):
    journals = academic.journal_table(spark)
    cr = json.dumps({"message": {"items": [
        {"DOI": "10.1/X", "URL": "https://doi.org/10.1/x", "type": "journal-article", "title": ["A", "B"], "abstract": "<jats:p>Text</jats:p>",
         "author": [{"given": "P", "family": "Or"}, {"family": "Vrba"}], "created": {"date-time": "2026-08-11T10:00:01Z"}},
        {"DOI": "10.1/Y", "type": "book", "title": ["No"]},
        {"DOI": "10.1/Z", "title": ["C"], "issued": {"date-parts": [[2026, 11]]}}]}})
    got = {r.doi: r for r in build_items(academic.parse_crossref(landed(spark, ("0301-4215", cr)), journals)).collect()}
    assert set(got) == {"10.1/x", "10.1/z"} and got["10.1/x"].title == "A B" and got["10.1/x"].summary_raw == "Text"
    assert got["10.1/x"].authors == ["P Or", "Vrba"] and got["10.1/x"].source_id == "journal-energy-policy" and got["10.1/x"].topic_filter
    assert got["10.1/z"].published_at == NOW and got["10.1/z"].url == "https://doi.org/10.1/Z"
    followed = {r.issn: r for r in journals.collect()}
    issn, journal = next(iter(followed.items()))
    works = [
        {"title": "", "display_name": "Shown name", "doi": "10.88/BARE", "publication_date": "2026-02-30",
         "primary_location": {"source": {"display_name": "Other title", "issn": ["0000-0000", issn]}},
         "abstract_inverted_index": {"weir": [2, 0], "and": [1]}, "authorships": []},
        {"id": "https://openalex.org/W77", "title": "Own venue", "publication_date": "2026-07-01", "language": "cs",
         "primary_location": {"landing_page_url": "https://venue.test/77", "source": {"display_name": "River Letters", "issn": None}}}]
    got = {r.title: r for r in build_items(academic.parse_openalex(landed(spark, ("openalex", json.dumps({"results": works}))), journals)).collect()}
    one, two = got["Shown name"], got["Own venue"]
    assert one.source_name == journal.name and one.topic_filter == journal.topic_filter and one.url == "https://doi.org/10.88/BARE"
    assert one.doi == "10.88/bare" and one.summary_raw == "weir and weir" and one.date_is_first_seen
    assert (two.source_name, two.url, two.topic_filter) == ("River Letters", "https://venue.test/77", True) and two.summary_raw == ""


def test_inverted_abstracts(spark):
    words = [["b", "a", "b", None, "B", "a"], [], None, [""], ["é", "e", "é"]]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w array<string>")
    got = {r.i: r.m for r in rows.select("i", academic.invert_abstract(F.col("w")).alias("m")).collect()}
    assert got == {0: {"b": [0, 2], "a": [1, 5], "B": [4]}, 1: {}, 2: None, 3: {"": [0]}, 4: {"é": [0, 2], "e": [1]}}


def test_abstract_queries_stay_in_the_row(spark, tmp_path):
    """No shuffle of single words, and work in proportion to the words: the square of 60,000 different ones takes minutes."""
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, long, "en", "src1", len(long)), (2, "a  b\ta\nc", "en", "src1", 8), (3, "", "en", "src1", 0), (4, None, "en", "src1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(
        str(tmp_path / "documents.parquet"))
    plain = registered.queries()["abstract_from_positions"](spark, str(tmp_path))
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: r.abstract for r in plain.collect()} == {1: long, 2: "a b a c", 3: "", 4: None}
    start = time.monotonic()
    got = {r.url[-1]: r.abstract for r in registered.queries()["openalex_job"](spark, str(tmp_path)).collect()}
    assert got["1"] == long and got["2"] == "a b a" and got["3"] == ""
    assert time.monotonic() - start < 60


def test_funding(spark):
    overview = {"budgetTopicActionMap": {"1": [{"action": "LIFE-1 - x", "expectedGrants": 2, "minContribution": 1000, "maxContribution": 5000,
                                                "budgetYearMap": {"2027": "9000", "2028": "x"}}], "2": [{"action": "OTHER"}]}}
    def call(identifier, title, deadline, **more):
        return {"url": f"https://ec/{identifier}", "metadata": {
            "identifier": [identifier], "title": [title], "callTitle": ["C"], "deadlineDate": deadline,
            "budgetOverview": [json.dumps(overview)], "startDate": ["2026-09-01T00:00:00.000+0000"], "status": ["31094502"], **more}}
    body = json.dumps({"results": [
        call("LIFE-1", "Energy poverty", ["2026-01-01T00:00:00.000+0000", "2026-12-01T17:00:00.000+0100"]),
        call("LIFE-2", "Past energy", ["2026-01-01T00:00:00.000+0000"]), call("X-3", "Football", ["2027-01-01T00:00:00.000+0000"]),
        call("HORIZON-4", "Energy batteries", ["2027-01-01T00:00:00.000+0000"])]})
    rows = landed(spark, ("eu", body), ("eu", body)).withColumn("query_no", F.col("payload_id").cast("int")).withColumn("ssh_query", F.lit(False))
    src = registry.source_table(spark, [{"id": "eu", "name": "EU", "type": "eu_funding", "url": "https://ec", "source_type": "funding"}])
    got = funding.call_items(rows, src).collect()
    assert len(got) == 1
    r = got[0]
    assert r.title == "Energy poverty (LIFE-1)" and r.deadline == dt.datetime(2026, 12, 1, 16) and r.query_no == 0
    assert (r.contribution_min, r.contribution_max, r.budget_total, r.grants) == (1000, 5000, 9000, 2)
    assert "Uzávěrka: 1. 12. 2026" in r.summary_raw and "min. 1 000 EUR, max. 5 000 EUR" in r.summary_raw


def test_portal_deadlines_are_read_once(spark):
    rows = landed(spark, ("eu", "{}")).withColumn("query_no", F.lit(0)).withColumn("ssh_query", F.lit(False))
    one = funding.values_of(F.lit(None).cast("map<string,string>"), "deadlineDate")._jc.toString().count("deadlineDate")
    plan = funding.parse_calls(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("deadlineDate") == one


def test_registry_and_stores(spark, tmp_path):
    with pytest.raises(ValueError):
        registry.source_table(spark, [{"id": "a"}, {"id": "a"}])
    path = tmp_path / "sources.yaml"
    path.write_text("sources:\n  - {id: a, name: A, enabled: false}\n  - {id: b, name: B}\n", encoding="utf-8")
    assert [r.id for r in registry.read_sources(spark, str(path), include_disabled=False).collect()] == ["b"]

    base = str(tmp_path / "weeks")
    one = spark.createDataFrame([("x", "2026-W38"), ("y", "2026-W39")], "id string, week string")
    store.write_week(one, base)
    store.write_week(spark.createDataFrame([("z", "2026-W39")], "id string, week string"), base)
    assert sorted(r.id for r in store.read_weeks(spark, base, "id string").collect()) == ["x", "z"]
    assert store.read_weeks(spark, str(tmp_path / "none"), "id string").count() == 0

    state = str(tmp_path / "state")
    store.save_state(store.load_state(spark, state, "k string").unionByName(spark.createDataFrame([("a",)], "k string")), state)
    store.save_state(store.load_state(spark, state, "k string").unionByName(spark.createDataFrame([("b",)], "k string")), state)
    assert sorted(r.k for r in store.load_state(spark, state, "k string").collect()) == ["a", "b"]

    reports = tmp_path / "reports"
    reports.mkdir()
    for w in ("2026-W38", "2026-W39"):
        (reports / f"{w}.json").write_text(json.dumps({"week": w, "headline_cs": "h"}), encoding="utf-8")
    (reports / "broken.json").write_text("{not json", encoding="utf-8")
    good, bad = store.read_reports(spark, str(reports))
    assert [r.week for r in good.collect()] == ["2026-W39", "2026-W38"] and bad.count() == 1

    sheet = str(tmp_path / "sheet")
    store.write_sheet(spark.createDataFrame([("1", "Žluť; \"x\"", "")], "id string, titulek string, A_geo string"), sheet)
    back = store.read_sheet(spark, sheet)
    assert back.columns == ["id", "titulek", "A_geo"] and back.first().titulek == 'Žluť; "x"'
