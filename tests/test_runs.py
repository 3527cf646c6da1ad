"""Whole runs: the weekly plan, the streaming collection and the registered queries."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pressmill import queries, schemas
from pressmill.operators import report
from pressmill.plans import weekly
from pressmill.sources import collect, registry, store
from pressmill.streaming import media_store
from tests.test_operators import DAY, item

FEED = """<rss version="2.0"><channel><item><title>Carbon budgets of barges</title><link>https://weir.test/1</link><pubDate>Wed, 23 Sep 2026 08:00:00 GMT</pubDate></item>
<item><title>Climate change and anglers</title><link>https://weir.test/2</link><pubDate>Thu, 24 Sep 2026 08:00:00 GMT</pubDate></item></channel></rss>"""
SMALL = "/root/testdata/sf0.001"


def items(spark, rows):
    return spark.createDataFrame([{k: v for k, v in r.items() if k != "arrival"} for r in rows], schemas.ITEM)


def test_weekly_run_is_repeatable(spark, tmp_path):
    base = str(tmp_path / "data")
    src = registry.source_table(spark, [{"id": f"s{i}", "name": f"S{i}", "source_type": "ngo", "region": "CZ" if i % 2 else "EU"} for i in range(6)])
    names = ["alfa", "brno", "cukr", "drak", "emil", "fara", "gong", "hora", "ikar", "jaro", "kobra", "lampa"]
    rows = [item(i, title=f"{names[i]} {names[(i * 5 + 1) % 12]} {names[(i * 7 + 3) % 12]}", source_id=f"s{i % 6}", summary_raw="Klima a emise.", region="CZ" if i % 2 else "EU")
            for i in range(12)]
    rows.append(item(50, url="http://example.org/a/1?utm_source=x", title="Kopie adresy"))
    rows.append(item(51, published_at=dt.datetime(2026, 9, 1), title="Klima mimo okno"))
    rows.append(item(52, title="Fotbal", source_id="s1"))
    rows.append(item(53, title="Výzva energetika (LIFE-1-X)", source_type="funding", source_id="s2"))
    fresh, now = items(spark, rows), dt.datetime(2026, 9, 28, 6)

    dry = weekly.run_week(spark, str(tmp_path / "dry"), fresh, src, "2026-W39", now, dry_run=True)
    assert dry["selected"].count() == 12
    assert store.load_state(spark, str(tmp_path / "dry") + "/seen", schemas.SEEN).count() == 0

    first = weekly.run_week(spark, base, fresh, src, "2026-W39", now)
    picked = [r.id for r in first["selected"].select("id").collect()]
    assert len(picked) == 12 and "i050" not in picked and "i051" not in picked and "i052" not in picked
    assert [r.id for r in first["call_pool"].collect()] == ["i053"]
    perf = {r.source_id: (r.n_window, r.n_selected, r.n_passed) for r in first["performance"].collect()}
    assert perf["s1"] == (3, 2, 2) and perf["s2"] == (2, 2, 2)

    second = weekly.run_week(spark, base, fresh.withColumn("first_seen", F.lit("2026-09-29").cast("timestamp")), src, "2026-W39", now)
    assert sorted(r.id for r in second["selected"].select("id").collect()) == sorted(picked)
    kept = store.read_weeks(spark, f"{base}/items", schemas.ITEM, "2026-W39")
    assert {r.first_seen for r in kept.where("id = 'i001'").collect()} == {dt.datetime(2026, 9, 30, 12)}
    later = weekly.run_week(spark, base, fresh, src, "2026-W40", now + dt.timedelta(days=7))
    assert later["selected"].count() == 0


def test_collection_in_two_runs(spark, tmp_path):
    now = dt.datetime(2026, 9, 24, 12)
    run = (spark, str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "meta"), str(tmp_path / "check"), now)

    def land(*rows):
        items(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    land(item(1, first_seen=DAY), item(2), item(3, published_at=dt.datetime(2026, 9, 1)), item(4, published_at=dt.datetime(2026, 9, 16)))
    media_store.collect(*run)
    land(item(1, first_seen=DAY + dt.timedelta(hours=5), title="znovu"), item(5), item(6, published_at=dt.datetime(2026, 10, 3)))
    media_store.collect(*run)
    got = {r.id: r for r in media_store.read_store(spark, run[2]).collect()}
    assert set(got) == {"i001", "i002", "i004", "i005"}  # old and future weeks are dropped
    assert got["i001"].first_seen == DAY and got["i004"].week == "2026-W38"
    meta = {r.week: (r.collections, r.n_articles) for r in media_store.read_collections(spark, run[3]).collect()}
    assert meta == {"2026-W39": (2, 3), "2026-W38": (1, 1)}


def test_articles_dated_ahead_hide_nothing(spark, tmp_path):
    now = dt.datetime(2026, 9, 24, 12)
    run = (spark, str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "meta"), str(tmp_path / "check"), now)
    for rows in ([item(9, published_at=now + dt.timedelta(weeks=4)), item(1, first_seen=DAY + dt.timedelta(hours=3)), item(1, first_seen=DAY)],
                 [item(2), item(3, published_at=now - dt.timedelta(days=7))]):
        items(spark, rows).repartition(3).write.mode("append").parquet(run[1])
        media_store.collect(*run)
    got = {r.id: r.first_seen for r in media_store.read_store(spark, run[2]).collect()}
    assert set(got) == {"i001", "i002", "i003"} and got["i001"] == DAY


def test_empty_week_is_cleared(spark, tmp_path):
    base = str(tmp_path / "weeks")
    df = items(spark, [item(1), item(2)]).withColumn("week", F.when(F.col("id") == "i001", "2026-W39").otherwise("2026-W40"))
    store.write_week(df, base)
    store.write_week(df.where("id = 'none'"), base, "2026-W39")
    assert [r.id for r in store.read_weeks(spark, base, schemas.ITEM).collect()] == ["i002"]


def test_merge_does_not_depend_on_partitions(spark):
    from pressmill.operators.items import merge_with_stored

    rows = [item(1, title=f"t{k}", url=f"https://merge.test/{k}") for k in range(9)]
    none = items(spark, [])
    got = {merge_with_stored(items(spark, rows).repartition(n), none).first().title for n in (1, 3, 7)}
    assert got == {"t0"}


def test_only_shown_calls_are_remembered(spark, tmp_path):
    src = registry.source_table(spark, [{"id": "s2", "name": "S", "source_type": "funding", "region": "EU"}])
    fresh = items(spark, [item(n, title=f"Grant scheme {n} for heat (LIFE-9-Z{n})", source_type="funding", source_id="s2") for n in (5, 6)])
    now, base = dt.datetime(2026, 9, 28, 6), str(tmp_path / "d")
    drafts = spark.createDataFrame([(0, "i005", "", "neuvedeno"), (1, "none", "", ""), (2, "i006", "", "30. 11. 2029")],
                                   "pos int, item_id string, funder string, deadline string")
    remembered = lambda: sorted((r.key, r.week) for r in store.load_state(spark, f"{base}/seen", schemas.SEEN).where(
        "kind = 'opportunity'").collect())
    out = weekly.run_week(spark, base, fresh, src, "2026-W39", now)
    assert out["call_pool"].count() == 2 and "calls" not in out and remembered() == []
    for _ in range(2):  # a repeated run shows the same
        out = weekly.run_week(spark, base, fresh, src, "2026-W39", now, drafts=drafts)
        assert {r.item_id: r.outcome for r in out["calls"].collect()} == {"i005": "shown", "none": "unknown id", "i006": "outside window"}
        assert out["call_pool"].count() == 2 and remembered() == [("i005", "2026-W39")]
    later = weekly.run_week(spark, base, fresh, src, "2026-W40", now + dt.timedelta(days=7))
    assert [r.id for r in later["call_pool"].collect()] == ["i006"] and remembered() == [("i005", "2026-W39")]


def test_run_with_a_collector(spark, tmp_path):
    src = registry.source_table(spark, [{"id": i, "name": i, "type": t, "source_type": "ngo", "region": "EU", "url": "", "enabled": i != "shut"}
                                        for i, t in (("weir", "rss"), ("lock", "wp_json"), ("mute", "rss"), ("shut", "rss"), ("book", "journal"))])
    now, base = dt.datetime(2026, 9, 28, 6), str(tmp_path / "d")

    def landed(weir):
        bodies = {"weir": weir, "lock": '[{"title": "A survey of lock keepers", "url": "https://lock.test/1", "date": "2026-09-23"}]', "shut": FEED, "book": "[]"}
        rows = [(f"p-{i}", i, f"https://{i}.test/", "", b, now) for i, b in bodies.items()]
        return collect.from_payloads(spark.createDataFrame(rows, schemas.PAYLOAD))

    other = lambda sources, at: (items(spark, [item(70, title="CBAM in old books", source_id="book")]), spark.createDataFrame(
        [("book", "book", "journal", "", "EU", True, "ok", "", 1, None, at)], schemas.HEALTH))
    out = weekly.run_week(spark, base, collect.together(landed(FEED), other), src, "2026-W39", now)
    states = lambda o: {r.source_id: (r.status, r["count"]) for r in o["health"].collect()}
    assert states(out) == {"weir": ("ok", 2), "lock": ("ok", 1), "mute": ("empty", 0), "shut": ("disabled", 0), "book": ("ok", 1)}
    assert {r.title for r in out["selected"].collect()} == {"Carbon budgets of barges", "Climate change and anglers", "A survey of lock keepers", "CBAM in old books"}
    # what a run does not ask for stays as known; a dry run keeps nothing
    dry = weekly.run_week(spark, base, landed("<html>Moved</html>"), src, "2026-W39", now, dry_run=True)
    assert states(dry)["weir"] == ("parse_error", 0) and states(dry)["book"] == ("ok", 1)
    assert {r.status for r in store.load_state(spark, f"{base}/health", schemas.HEALTH).where("source_id = 'weir'").collect()} == {"ok"}


def test_drafted_sections_are_checked(spark, tmp_path):
    src = registry.source_table(spark, [{"id": "s1", "name": "S1", "source_type": "ngo", "region": "EU"}])
    titles = ["Coal ferries of the delta", "Solar roofs on canal houses", "Workshop: heat pumps in mills", "Hydrogen for tugs", "Carbon price of gravel"]
    rows = [item(n, title=t, source_id="s1", summary_raw="" if n == 4 else f"Emission story {n * 7919}.") for n, t in enumerate(titles)]
    point = lambda section, pos, *ids, geo="EU": (section, pos, f"{section} {pos}", geo, False, list(ids))
    drafted = [point("key_findings", 0, "i004"), point("key_findings", 1, " i003 "), point("key_findings", 2, "ghost"), point("key_findings", 3, "i002"),
               point("cz_items", 0, "i000", "i001"), point("cz_items", 1, "i000"), point("cz_items", 2, "i002"),
               point("world_items", 0, "i003"), point("world_items", 1, "i000"), point("world_items", 2, "i001"),
               point("surveys", 0, "i003", "i004"), point("surveys", 1, "i001", "ghost"), point("strengths", 0, "i003", geo="US"), point("strengths", 1, "i003", geo="CZ"),
               point("watchlist", 5, "i001")]
    table = lambda points: spark.createDataFrame(points, "section string, pos int, text string, geo string, dated boolean, evidence_ids array<string>")

    def shown(sections):
        found = {}
        for r in sections.orderBy("section", "pos").collect():
            found.setdefault(r.section, []).append((r.text, r.evidence_ids))
        return found

    out = weekly.run_week(spark, str(tmp_path / "d"), items(spark, rows), src, "2026-W39", dt.datetime(2026, 9, 28, 6), dry_run=True, sections=table(drafted))
    assert out["fallback"].count() == 5
    assert shown(out["sections"]) == {
        # the finding without a summary and the event go; news with a summary fill up
        "key_findings": [("key_findings 1", ["i003"]), ("cz_items 0", ["i000"]), ("world_items 2", ["i001"])],
        "cz_items": [("cz_items 0", ["i000"])], "world_items": [("world_items 0", ["i003"]), ("world_items 2", ["i001"])],
        "surveys": [("surveys 0", ["i004"])], "strengths": [("strengths 1", ["i003"]), ("strengths 0", ["i003"])],
        "watchlist": [("watchlist 5", ["i001"]), (titles[2], ["i002"])]}
    # too little news, no finding, nothing at all: rejected week by week
    drafts = {"2026-W39": drafted, "2026-W40": [p for p in drafted if p[0] != "world_items"], "2026-W41": [p for p in drafted if p[0] != "key_findings"], "2026-W42": []}
    weeks = spark.createDataFrame([(w,) for w in drafts], "week string")
    several = table([p for ps in drafts.values() for p in ps]).limit(0).withColumn("week", F.lit(""))
    for w, points in drafts.items():
        several = several.unionByName(table(points).withColumn("week", F.lit(w)))
    chosen = out["selected"].drop("week").crossJoin(weeks)
    checked, rejected = report.checked_report(several, chosen, weeks)
    assert {r.week for r in rejected.collect()} == {"2026-W40", "2026-W41", "2026-W42"} and {r.week for r in checked.collect()} == {"2026-W39"}
    assert shown(checked) == shown(out["sections"])


def test_repeated_batch_counts_once(spark, tmp_path):
    now, rows = dt.datetime(2026, 9, 24, 12), [item(1), item(2)]
    for _ in range(2):
        media_store.add_batch(items(spark, rows), 0, str(tmp_path / "s"), str(tmp_path / "m"), now)
    assert media_store.read_store(spark, str(tmp_path / "s")).count() == 2
    assert media_store.read_collections(spark, str(tmp_path / "m")).first().n_articles == 2


def test_contract():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 80


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def _plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", ["item_rows", "week_window", "final_score", "sentiment_levels", "sentiment_extremes", "media_collection", "media_context", "weak_sources",
                                  "coder_agreement", "collected_health", "events_to_watchlist", "checked_report", "usage_totals", "calls_across_runs", "batch_budget_cut", "budget_fit", "funding_job", "date_spellings"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in queries.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted([[_plain(v) for v in r] for r in cur.fetchall()], key=repr)
    got = sorted([[_plain(v) for v in r] for r in df.select(*[F.col(f"`{c}`") for c in names]).collect()], key=repr)
    assert got == want
