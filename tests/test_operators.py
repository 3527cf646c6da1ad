import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pressmill import config, schemas
from pressmill.functions.similarity import token_set_ratio
from pressmill.operators import calls, cluster, health, items, media, report, review, score, select, sentiment, usage, validation, window
from pressmill.sources import registry

NOW = dt.datetime(2026, 9, 30, 12)
DAY = dt.datetime(2026, 9, 23, 10)

ITEM = schemas.ITEM + ", arrival long"


def item(n, **kw):
    row = dict(id=f"i{n:03d}", title=f"Zápis {n} z úřadu: klima a doprava", url=f"https://notes.test/n/{n}", source_id="src",
               source_name="SRC", region="EU", source_type="think_tank", language="en", published_at=DAY, first_seen=NOW,
               summary_raw="", authors=[], doi=None, topic_filter=True, source_weight=1.0, date_is_first_seen=False, arrival=n)
    row.update(kw)
    return row


def table(spark, rows, schema=ITEM):
    return spark.createDataFrame(rows, schema)


def scored(spark, rows, **extra):
    base = dict(relevance=7, topics=["study"], geo_focus="EU", is_public_attitudes_or_communication=False, is_original_research=False,
                relevant_to_cz_eu=True, cz_impact=0, eu_impact=1, is_opinion=False, is_event=False, title_cs="", one_line_cs="",
                sentiment=0, final_score=7.0, scored_by="llm", week="2026-W39", org="")
    full = []
    for n, r in enumerate(rows):
        row = {**item(n), **base, **r}
        row["org"] = row["org"] or row["source_id"]
        full.append(row)
    schema = ITEM + (", relevance int, topics array<string>, geo_focus string, is_public_attitudes_or_communication boolean, "
                     "is_original_research boolean, relevant_to_cz_eu boolean, cz_impact int, eu_impact int, is_opinion boolean, "
                     "is_event boolean, title_cs string, one_line_cs string, sentiment int, final_score double, scored_by string, "
                     "week string, org string")
    return table(spark, full, schema)


def seen(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.SEEN)


def ids(df, col="id"):
    return sorted(r[0] for r in df.select(col).collect())


# -- window --------------------------------------------------------------------------------------------------------

def test_window_and_memory(spark):
    rows = table(spark, [item(1), item(2, published_at=dt.datetime(2026, 9, 20, 23, 59)), item(3, published_at=dt.datetime(2026, 9, 28, 0, 1)),
                         item(4), item(5), item(6, doi="10.1/x")])
    memory = seen(spark, ("item", "i004", "2026-W38"), ("item", "i005", "2026-W39"), ("doi", "10.1/x", "2026-W01"))
    assert ids(window.select_window(rows, memory, "2026-W39")) == ["i001", "i005"]


def test_first_run_cap_in_arrival_order(spark):
    late = dt.datetime(2026, 9, 28, 6)
    rows = table(spark, [item(i, published_at=None, first_seen=late, source_id="brezina", arrival=10 - i) for i in range(6)])
    placed = window.select_window(rows, seen(spark, ("source", "other", "2026-W01")), "2026-W39")
    assert ids(placed.where("placement = 'window'")) == ["i003", "i004", "i005"]
    assert ids(placed.where("placement = 'suppressed'")) == ["i000", "i001", "i002"]
    memory = window.mark_seen(seen(spark, ("item", "z", "2026-W20")), window.week_marks(placed, rows, "2026-W39"))
    assert window.select_window(rows, memory, "2026-W40").count() == 0


def test_prune_keeps_suppressed(spark):
    memory = seen(spark, ("item", "a", "2025-W01"), ("item", "b", "2026-W38"), ("item", "c", "0000-W00"), ("doi", "d", "0000-W00"),
                  ("opportunity", "e", "2020-W01"))
    assert ids(window.prune_seen(memory, "2026-W39"), "key") == ["b", "c", "e"]


def test_cap_filters_large_topic_sources_first(spark):
    rows = [item(i, source_id="big", title="Klima" if i in (3, 5, 6) else "Fotbal") for i in range(8)] + [
        item(10 + i, source_id="free", topic_filter=False, title="Fotbal") for i in range(4)]
    df = table(spark, rows).withColumn("cap", F.lit(2)).withColumn("feed_pos", F.col("arrival"))
    assert ids(window.cap_per_source(df)) == ["i003", "i005", "i010", "i011"]


def test_stored_rows_win(spark):
    fresh = table(spark, [item(1, title="new"), item(2)])
    stored = table(spark, [item(1, title="old", first_seen=DAY)])
    assert {r.id: r.title for r in items.merge_with_stored(fresh, stored).collect()}["i001"] == "old"


# -- scores --------------------------------------------------------------------------------------------------------

def test_prefilter_and_heuristic(spark):
    rows = table(spark, [item(1, title="Weekly roundup", topic_filter=False), item(2, title="Fotbalová liga pokračuje"),
                         item(3, title="Ceny elektřiny příští rok porostou"), item(4, title="Hledáme kolegyni do kampaně Klima", topic_filter=False)])
    assert ids(score.prefilter(rows)) == ["i001", "i003"]
    r = score.heuristic_score(table(spark, [item(1, title="Průzkum: Češi a postoje k emisním povolenkám")])).first()
    assert r.geo_focus == "CZ" and r.cz_impact == 2 and r.is_public_attitudes_or_communication and 0 <= r.relevance <= 10
    event = score.heuristic_score(table(spark, [item(1, title="Veřejná debata | Postoje ke klimatu")])).first()
    assert event.is_event and not event.is_public_attitudes_or_communication


def test_final_score(spark):
    df = scored(spark, [
        {"source_type": "polling", "relevance": 10, "geo_focus": "CZ", "cz_impact": 3, "eu_impact": 1,
         "is_public_attitudes_or_communication": True, "is_original_research": True},
        {"relevance": 6, "is_event": True, "is_public_attitudes_or_communication": True, "eu_impact": 0},
        {"source_type": "journal", "relevance": 7, "geo_focus": "GLOBAL", "cz_impact": 1, "eu_impact": 1, "source_weight": 1.2}])
    got = [r.s for r in df.select("id", score.final_score().alias("s")).orderBy("id").collect()]
    assert got == [round(10 + 4.5 + 0.8 + 1 + 0.6 + 1.5 + 0.8, 4), round(6 + 0.5 + 0.4 - 4, 4), 9.9]
    clean = score.sanitize(scored(spark, [{"relevance": 14, "sentiment": -5, "cz_impact": 9, "topics": ["a", "a"], "language": "cs",
                                           "title_cs": "x", "title": "Webinář: ETS2", "is_original_research": True}])).first()
    assert (clean.relevance, clean.sentiment, clean.cz_impact, clean.topics, clean.title_cs) == (10, -2, 3, ["a"], "")
    assert clean.is_event and not clean.is_original_research


def test_missing_scores_fall_back(spark):
    rows = table(spark, [item(1), item(2)])
    given = scored(spark, [{"relevance": 9}]).withColumn("item_id", F.lit("i001")).select("item_id", *score.SCORE_COLUMNS)
    got = {r.id: r.scored_by for r in score.score_items(rows, given).collect()}
    assert got == {"i001": "llm", "i002": "heuristic"}


# -- clusters and selection ------------------------------------------------------------------------------------------

def rank(r):
    return (-r["final_score"], -r["cz_impact"], -r["published_at"].timestamp(), r["id"])


def naive_clusters(rows, threshold=70):
    heads, out = [], {}
    for r in sorted(rows, key=rank):
        t = "".join(c if c.isalnum() or c == " " else " " for c in r["title"].lower()).strip()
        found = next((c for c, ot, d, u in heads if (r["doi"] and r["doi"] == d) or r["url"] == u
                      or (len(t) >= 15 and token_set_ratio(t, ot) >= threshold)), len(set(out.values())))
        heads.append((found, t, r["doi"], r["url"]))
        out[r["id"]] = found
    return out


def naive_selection(rows, sel):
    pool = sorted((r for r in rows if r["relevance"] >= 3), key=rank)
    clusters = naive_clusters(pool, sel.cluster_threshold)
    chosen, caps = [], sel.type_caps()

    def full(r):
        copy = any(c["url"] == r["url"] or (r["doi"] and c["doi"] == r["doi"]) for c in chosen)
        return copy or sum(clusters[c["id"]] == clusters[r["id"]] for c in chosen) >= sel.max_per_cluster

    def fits(r):
        cap = caps.get(r["source_type"], 10 ** 9)
        return (sum(c["org"] == r["org"] for c in chosen) < sel.max_per_org and not full(r)
                and sum(c["source_type"] == r["source_type"] for c in chosen) < cap)

    for test, n in ((lambda r: r["geo_focus"] == "CZ" or r["cz_impact"] >= 2, sel.min_domestic),
                    (lambda r: r["is_public_attitudes_or_communication"], sel.min_attitudes)):
        for capped in (True, False):
            for r in pool:
                if sum(map(test, chosen)) < n and test(r) and r not in chosen and not full(r) and (fits(r) or not capped):
                    chosen.append(r)
    for ok in (fits, lambda r: not full(r)):
        for r in pool:
            if len(chosen) < sel.max_items and r not in chosen and ok(r):
                chosen.append(r)
    return sorted(r["id"] for r in chosen[:max(sel.max_items, sel.min_domestic + sel.min_attitudes)])


def random_pool(rng, n):
    words = "climate anxiety survey young adults coal power plant target heat pump sales report energy price poll".split()
    out = []
    for i in range(n):
        title = " ".join(rng.choice(words) for _ in range(rng.randint(2, 7)))
        out.append({**item(i, title=title, source_id=f"s{rng.randint(0, 7)}", published_at=DAY + dt.timedelta(hours=rng.randint(0, 40)),
                           source_type=rng.choice(["media", "journal", "ngo", "research"])),
                    "geo_focus": rng.choice(["CZ", "EU", "US"]), "cz_impact": rng.randint(0, 3), "relevance": rng.randint(1, 9),
                    "is_public_attitudes_or_communication": rng.random() < 0.2, "final_score": float(rng.randint(0, 40)) / 2})
    for r in out:
        r["org"] = r["source_id"]
    return out


def test_clusters_equal_the_walk(spark):
    rows = random_pool(random.Random(5), 120)
    for k in range(0, 100, 9):
        rows[k]["doi"] = f"10.1/{k % 4}"
    got = {r.id: r.cluster_no for r in cluster.numbered(cluster.topic_clusters(scored(spark, rows))).collect()}
    want = naive_clusters(rows)
    pairs = {(got[i], want[i]) for i in want}
    assert len(got) == len(want) and len(pairs) == len(set(want.values())) == len(set(got.values()))


@pytest.mark.parametrize("seed,prefix", [(1, 1000), (2, 40)])
def test_selection_equals_the_walk(spark, seed, prefix):
    rows = random_pool(random.Random(seed), 150)
    for k in range(0, 150, 4):
        rows[k]["doi"] = f"10.7/{k % 9}"
    for k in range(1, 150, 7):
        rows[k]["url"] = f"https://pool.test/{k % 11}"
    sel = config.Selection(max_items=20, min_domestic=8, min_attitudes=4, max_per_org=3, max_per_cluster=2)
    got = ids(select.select_balanced(scored(spark, rows), sel, block=prefix))
    assert got == naive_selection(rows, sel)


def test_unreachable_quota_is_walked_in_blocks(spark, monkeypatch):
    rows = random_pool(random.Random(11), 150)
    for k, r in enumerate(rows):
        r["is_public_attitudes_or_communication"] = k in (3, 148)
    sel = config.Selection(max_items=12, min_domestic=3, min_attitudes=9, max_per_org=2, max_per_cluster=2)
    sizes, later = spark.sparkContext.accumulator(0), select._later_block

    def watched(goals, block):
        walk = later(goals, block)

        def run(pdf):
            sizes.add(10_000 if len(pdf) > block + 1 else 1)
            return walk(pdf)
        return run

    monkeypatch.setattr(select, "_later_block", watched)
    assert ids(select.select_balanced(scored(spark, rows), sel, block=10)) == naive_selection(rows, sel)
    # every step picks or ends, and no task holds more than a block
    assert 0 < sizes.value <= sel.max_items + sel.min_domestic + sel.min_attitudes + 6


def test_clusters_are_looked_for_as_rows_come_to_a_block(spark, monkeypatch):
    rows = random_pool(random.Random(11), 150)
    for k, r in enumerate(rows):
        r["is_public_attitudes_or_communication"] = k in (3, 148)
    sel = config.Selection(max_items=12, min_domestic=3, min_attitudes=9, max_per_org=2, max_per_cluster=2)
    looked, whole, some = [], select.topic_clusters, select.clusters_of
    monkeypatch.setattr(select, "topic_clusters", lambda part, *a, **b: looked.append(part.count()) or whole(part, *a, **b))
    monkeypatch.setattr(select, "clusters_of", lambda only, *a, **b: looked.append(only.count()) or some(only, *a, **b))
    assert ids(select.select_balanced(scored(spark, rows), sel, block=10)) == naive_selection(rows, sel)
    # the best block, then a block at a time: not the whole week
    assert looked[0] == 10 and max(looked) <= 11 and sum(looked) < 75


def test_copies_do_not_use_up_a_cluster(spark):
    rows = [{"title": "pumps replace boilers in towns", "doi": doi, "final_score": 9.0 - k, "org": "o"} for k, doi in enumerate(["10.7/a", "10.7/a", "10.7/b"])]
    got = ids(select.select_balanced(scored(spark, rows), config.Selection(max_per_cluster=2)))
    assert got == sorted(r["id"] for r in (item(0), item(2)))


def test_quota_conditions_are_an_argument(spark):
    rows = [{"title": f"{w} {w}ova", "geo_focus": "US", "final_score": 20.0 - k, "eu_impact": 3 if k > 5 else 0, "org": w}
            for k, w in enumerate("alfa brno cukr drak emil fara gong hora".split())]
    sel = config.Selection(max_items=3, min_domestic=0, min_attitudes=0)
    quota = [select.Quota("european", lambda: F.col("eu_impact") >= 3, 2)]
    got = ids(select.select_balanced(scored(spark, rows), sel, quotas=quota))
    assert got == sorted(item(k)["id"] for k in (0, 6, 7))


def test_quotas(spark):
    words = [f"{a} {b}" for a in ("alfa", "brno", "cukr", "drak", "emil", "fara", "gong", "hora", "ikar", "jaro") for b in (
        "kobra", "lampa", "mrkev", "nitka", "oliva", "pivo")]
    rows = [{"title": words[i], "geo_focus": "US", "source_id": f"us{i}", "final_score": 50.0 - i, "relevance": 9} for i in range(30)]
    rows += [{"title": words[30 + i], "geo_focus": "CZ", "cz_impact": 3, "source_id": f"cz{i}", "final_score": 5 - i * 0.1} for i in range(14)]
    rows += [{"title": words[44 + i], "source_id": f"a{i}", "is_public_attitudes_or_communication": True, "final_score": 4 - i * 0.1} for i in range(6)]
    got = select.presentation_order(select.select_balanced(
        scored(spark, rows), config.Selection(max_items=20, max_per_cluster=1000))).collect()
    assert sum(r.geo_focus == "CZ" for r in got) >= 12 and sum(r.is_public_attitudes_or_communication for r in got) >= 5
    first = next(i for i, r in enumerate(got) if r.geo_focus != "CZ")
    assert all(r.geo_focus != "CZ" for r in got[first:])


# -- statistics ----------------------------------------------------------------------------------------------------

def test_sentiment(spark):
    rows = [{"geo_focus": "CZ", "sentiment": -1, "final_score": 100.0 if i == 0 else 10.0} for i in range(6)] + [
        {"geo_focus": "EU", "sentiment": 1, "final_score": 10.0} for _ in range(2)]
    df = scored(spark, rows)
    r = sentiment.summary(sentiment.rated(df), df.where("id in ('i000', 'i007')")).first()
    assert r["index"] == -38 and r["label"] == "mírně nepříznivá" and [(x["region"], x["n"]) for x in r["by_region"]] == [("CZ", 6), ("EU", 2)]
    assert (r["most_negative_id"], r["most_positive_id"]) == ("i000", "i007")
    assert sentiment.summary(sentiment.rated(df.limit(3)), df).count() == 0
    assert sentiment.rated(df.withColumn("scored_by", F.lit("heuristic"))).count() == 0


def test_media_report(spark):
    rows = table(spark, [item(i, title=t, source_name=o, summary_raw="Perex.") for i, (t, o) in enumerate([
        ("Ceny elektřiny porostou", "N"), ("Vláda schválila podporu fotovoltaiky", "I"), ("Komentář: Zelené šílenství z Bruselu", "P"),
        ("Fotbal: Sparta vyhrála derby", "N"), ("Firemní klima a motivace zaměstnanců", "I")])]).withColumn(
        "week", F.lit("2026-W39")).withColumn("outlet", F.col("source_name"))
    found = media.candidates(rows)
    classes = spark.createDataFrame([("i000", True, "ceny_energii", "f1", "zprava", -1), ("i001", True, "obnovitelne_zdroje", "f2", "zprava", 1),
                                     ("i002", True, "klimaticka_politika", "f1", "komentar", -9), ("i004", False, "jine", "f3", "jine", 0),
                                     ("zzz", True, "jine", "f3", "jine", 2)], schemas.MEDIA_CLASS)
    relevant = media.relevant_articles(found, media.clean_classes(found, classes))
    r = media.report(rows, relevant, found.groupBy("week").agg(F.count("*").alias("n_candidates"))).first()
    assert (r.n_collected, r.n_candidates, r.n_relevant, r.tone_index) == (5, 4, 3, -33)
    assert r.topics == {"ceny_energii": 1, "obnovitelne_zdroje": 1, "klimaticka_politika": 1} and r.genres["komentar"] == 1
    picked = media.as_scored(media.one_per_outlet(relevant, rows.where("id = 'i001'")))
    assert ids(picked) == ["i000", "i002"] and picked.where("id = 'i002'").first().is_opinion
    assert ids(media.unclassified(found, media.clean_classes(found, classes.where("item_id <> 'i001'")))) == ["i001"]
    assert {r.genre for r in media.clean_classes(found, None).collect()} == {"zprava"}


# -- sources -------------------------------------------------------------------------------------------------------

def registry_of(spark):
    return registry.source_table(spark, [{"source_type": "media", **e} for e in [
        {"id": "respekt", "region": "CZ"}, {"id": "oenergetice", "region": "CZ"}, {"id": "seznam", "region": "CZ", "protected": True},
        {"id": "heavy", "weight": 1.4}, {"id": "r-eu", "region": "EU", "reserve": True}, {"id": "r-cz", "region": "CZ", "reserve": True},
        {"id": "off", "enabled": False}]])


def performance(spark, rows):
    weeks = ["2026-W40", "2026-W41", "2026-W42", "2026-W43"]
    return spark.createDataFrame([(w, s, *c) for s, cs in rows.items() for w, c in zip(weeks, cs) if c], schemas.PERFORMANCE)


def test_rotation(spark):
    perf = performance(spark, {"respekt": [(30, 0, 0)] * 4, "oenergetice": [(10, 0, 4)] * 4, "seznam": [(30, 0, 0)] * 4, "heavy": [(1, 0, 0)] * 4})
    none = spark.createDataFrame([], review.STATUS_SCHEMA)
    after = review.rotate(perf, registry_of(spark), none, "2026-W43")
    got = {(r.kind, r.source_id): (r.until, r.partner) for r in after.collect()}
    assert got == {("paused", "respekt"): ("2026-W47", "r-cz"), ("activated", "r-cz"): (None, "respekt")}
    active = ids(review.active_sources(registry_of(spark), after))
    assert "r-cz" in active and "respekt" not in active and "off" not in active and "r-eu" not in active
    again = review.rotate(performance(spark, {"respekt": [(1, 0, 0)]}), registry_of(spark), after, "2026-W47")
    assert ids(again.where("kind = 'paused'"), "source_id") == []
    used = spark.createDataFrame([("activated", r, "", None, None) for r in ("r-cz", "r-eu")], review.STATUS_SCHEMA)
    assert ids(review.rotate(perf, registry_of(spark), used, "2026-W43").where("kind = 'flagged'"), "source_id") == ["respekt"]


def test_rotation_takes_reserves_in_turn(spark):
    sources = registry.source_table(spark, [{"source_type": "media", **e} for e in [
        {"id": "a", "region": "EU"}, {"id": "b", "region": "US"}, {"id": "c", "region": "US"}, {"id": "d", "region": "EU"},
        {"id": "r1", "region": "US", "reserve": True}, {"id": "r2", "region": "CZ", "reserve": True}, {"id": "r3", "region": "US", "reserve": True}]])
    perf = performance(spark, {s: [(n, 0, 0)] * 4 for s, n in (("a", 40), ("b", 30), ("c", 20), ("d", 10))})
    got = review.rotate(perf, sources, spark.createDataFrame([], review.STATUS_SCHEMA), "2026-W43")
    # the worst has no reserve of its region and takes the first of all; the last finds none
    assert {r.source_id: r.partner for r in got.where("kind = 'paused'").collect()} == {"a": "r1", "b": "r3", "c": "r2"}
    assert ids(got.where("kind = 'activated'"), "source_id") == ["r1", "r2", "r3"] and ids(got.where("kind = 'flagged'"), "source_id") == ["d"]


def test_no_rotation_without_full_history(spark):
    none = spark.createDataFrame([], review.STATUS_SCHEMA)
    for rows in ({"respekt": [None, None, None, (25, 0, 0)]}, {"respekt": [(30, 0, None)] * 4}, {"respekt": [(30, 0, 0), None, (30, 0, 0), (30, 0, 0)]}):
        assert review.rotate(performance(spark, rows), registry_of(spark), none, "2026-W43").count() == 0


def test_performance_rows(spark):
    week = F.lit("2026-W43")
    rows = table(spark, [item(1, source_id="a"), item(2, source_id="a"), item(3, source_id="b")]).withColumn("week", week)
    fetched = spark.createDataFrame([("2026-W43", s) for s in ("a", "b", "idle")], "week string, source_id string")
    got = {r.source_id: (r.n_window, r.n_selected, r.n_passed) for r in review.performance(
        rows, rows.where("id = 'i001'"), rows.where("id <> 'i002'"), fetched).collect()}
    assert got == {"a": (2, 1, 1), "b": (1, 0, 1), "idle": (0, 0, 0)}
    assert review.rebuild_history(rows, rows.where("id = 'i001'")).where("source_id = 'a'").first().n_passed == 2


def test_health(spark):
    src = spark.createDataFrame([(s, True) for s in ("ok", "empty", "stale", "undated", "bad")], "source_id string, enabled boolean")
    rows = table(spark, [item(1, source_id="ok"), item(2, source_id="stale", published_at=NOW - dt.timedelta(days=61)),
                         item(3, source_id="undated", published_at=None)])
    problems = spark.createDataFrame([("bad", "parse_error", "x")], "source_id string, status string, detail string")
    got = {r.source_id: r for r in health.source_health(src, rows, NOW, problems).collect()}
    assert {k: v.status for k, v in got.items()} == {"ok": "ok", "empty": "empty", "stale": "stale", "undated": "ok", "bad": "parse_error"}
    assert got["undated"].detail == health.UNDATED


# -- calls ---------------------------------------------------------------------------------------------------------

def call(n, deadline, programme="HORIZON", **kw):
    return item(n, title=f"Výzva {n} ({programme}-CL5-2027-01-D{n})", source_id="eu", source_type="funding",
                summary_raw=f"Výzva EU | Uzávěrka: {deadline} | Štítek SSH (společenské a humanitní vědy)", **kw)


def pool(spark, rows, shown=(), week="2026-W40"):
    src = registry.source_table(spark, [{"id": "eu", "funding": True}, {"id": "tacr", "funding": True}])
    df = spark.createDataFrame(list(shown), "key string, week string")
    return [r.id for r in calls.call_pool(table(spark, rows), src, df, NOW, week, NOW).collect()]


def test_call_pool(spark):
    rng, rows, deadlines = random.Random(12), [], {}
    for n in range(60):
        day = rng.choice([None, NOW.date() + dt.timedelta(days=rng.randint(-40, 400))])
        deadlines[f"i{n:03d}"] = day
        rows.append(call(n, f"{day.day}. {day.month}. {day.year}" if day else "neuvedena"))
    told = {f"i{n:03d}": rng.choice(["2026-W31", "2026-W40"]) for n in range(0, 60, 3)}
    last = calls.deadline_window(NOW, config.Calls.max_months)[1]

    def stays(key):
        day = deadlines[key]
        if day and not NOW.date() <= day <= last:
            return False
        soon = day is not None and day <= NOW.date() + dt.timedelta(days=config.Calls.reminder_days)
        return told.get(key, "2026-W40") == "2026-W40" or soon

    want = sorted(filter(stays, deadlines), key=lambda k: (deadlines[k] or dt.date.max, k))
    assert pool(spark, rows, told.items()) == want and 0 < len(want) < 60


def test_call_pool_order_and_news(spark):
    # a call is news with a title that announces one; climate comes first, then domestic sources
    rows = [item(1, title="Grant scheme for choirs"), item(2, title="Open call: heating from rivers"), item(3, title="Rivers are warm"),
            item(4, title="Tender for sewage heating", region="CZ"), item(5, title="Open call: heat pumps", published_at=NOW - dt.timedelta(days=31))]
    assert pool(spark, rows) == ["i004", "i002", "i001"]


def test_drafts(spark):
    rng = random.Random(13)
    names = ["CEF", "JUST", "SMP", "CERV"]
    rows = [call(n, "5. 2. 2027", names[n % 4]) for n in range(24)]
    drafted = [(pos, rng.choice([f"i{n:03d}" for n in range(24)]), rng.choice(["", "5. 2. 2027", "8. 8. 2027"])) for pos in range(40)]
    drafted[5] = (5, "gone", "")
    limits, lo, hi = config.Calls(max_items=7, max_per_programme=2), dt.date(2026, 10, 1), dt.date(2027, 4, 1)
    want, met, load = [], set(), dict.fromkeys(names, 0)
    for _, key, deadline in drafted:
        programme = names[int(key[1:]) % 4] if key != "gone" else None
        if key == "gone":
            want.append("unknown id")
        elif deadline.startswith("8"):
            want.append("outside window")
        elif key in met:
            want.append("repeated")
        else:
            met.add(key)
            load[programme] += 1
            shown = want.count("shown") < limits.max_items
            want.append("programme full" if load[programme] > limits.max_per_programme else "shown" if shown else "over limit")
    drafts = spark.createDataFrame([(pos, key, "", "", deadline, "") for pos, key, deadline in drafted], schemas.OPPORTUNITY_DRAFT)
    got = calls.check_drafts(drafts, table(spark, rows), lo, hi, limits).orderBy("pos").collect()
    assert [r.outcome for r in got] == want and len(set(want)) == 6


def test_deadlines_are_read_once_and_drafts_written_once(spark):
    rows, src = table(spark, [call(1, "5. 2. 2027"), call(2, "neuvedena")]), registry.source_table(spark, [{"id": "eu", "funding": True}])
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    found = calls.call_pool(rows, src, spark.createDataFrame([], "key string, week string"), NOW, "2026-W40", NOW, config.Calls(pool_max=None))
    assert plan(found).count("Uzávěrka") == 1
    drafts = spark.createDataFrame([(0, "i001", "", "", "", ""), (1, "i002", "", "", "8. 8. 2027", "")], schemas.OPPORTUNITY_DRAFT)
    checked = calls.check_drafts(drafts, found, dt.date(2026, 10, 1), dt.date(2027, 4, 1))
    assert "Uzávěrka" not in plan(checked)
    assert [(r.outcome, r.deadline_date) for r in checked.orderBy("pos").collect()] == [("shown", dt.date(2027, 2, 5)), ("outside window", dt.date(2027, 8, 8))]


# -- report --------------------------------------------------------------------------------------------------------

def sections(spark, *rows):
    return spark.createDataFrame([("2026-W39", s, p, f"{s}{p}", "EU", False, ev) for s, p, ev in rows], schemas.SECTION_REF)


def flat(df):
    return {(r.section, r.pos): r.evidence_ids for r in df.collect()}


def test_sections(spark):
    known = table(spark, [item(i, summary_raw="x") for i in range(1, 9)]).withColumn("week", F.lit("2026-W39")).withColumn("is_event", F.col("id") == "i008")
    draft = sections(spark, ("key_findings", 0, ["i001"]), ("cz_items", 0, ["i001"]), ("cz_items", 1, ["i002"]), ("world_items", 0, ["i002"]),
                     ("world_items", 1, ["i003"]), ("recommendations", 0, ["i003"]), ("recommendations", 1, ["i003", " i004", "bad", "i004"]),
                     ("watchlist", 0, ["i001"]), ("strengths", 0, ["bad"]), ("threats", 0, ["i005", "bad", "i008"]))
    valid = report.valid_evidence(draft, known)
    assert flat(valid)["recommendations", 1] == ["i003", "i004"] and ("strengths", 0) not in flat(valid)
    moved = report.move_events(valid, known)
    assert flat(moved)["threats", 0] == ["i005"] and flat(moved)["watchlist", 1] == ["i008"]
    single = flat(report.single_place(moved))
    assert ("world_items", 0) not in single and single["world_items", 1] == ["i003"]
    assert ("recommendations", 0) not in single and single["recommendations", 1] == ["i004"] and single["watchlist", 0] == ["i001"]
    assert [r.id for r in report.fill_findings(valid, known).orderBy("place").collect()] == ["i001", "i002", "i003"]
    assert report.unusable_weeks(report.capped_sections(valid), known).count() == 0
    assert ids(report.unusable_weeks(report.capped_sections(valid.where("section <> 'key_findings'")), known), "week") == ["2026-W39"]


def test_digest_mix(spark):
    rows = [item(i, summary_raw="x") for i in range(1, 7)]
    kept = table(spark, rows).withColumns({"week": F.lit("2026-W39"), "has_summary": F.lit(True), "is_event": F.lit(False),
                                           "geo_focus": F.when(F.col("id") == "i006", "EU").otherwise("CZ")})
    cand = report.digest_candidates(sections(spark, *[("cz_items", i, [f"i{i:03d}"]) for i in range(1, 6)], ("world_items", 1, ["i006"])))
    assert [r.id for r in report.digest_default(cand, kept).orderBy("place").collect()] == ["i001", "i006", "i002"]
    found = spark.createDataFrame([("2026-W39", p, i) for p, i in enumerate(["i003", "i004", "i005", "zzz"])], "week string, pos int, id string")
    got = report.mixed_findings(found, cand, kept).orderBy("place").collect()
    assert [r.id for r in got] == ["i003", "i004", "i006"]

    def mixed(*chosen):
        own = spark.createDataFrame([("2026-W39", p, i) for p, i in enumerate(chosen)], "week string, pos int, id string")
        return [r.id for r in report.mixed_findings(own, cand, kept).orderBy("place").collect()]

    assert mixed() == ["i001", "i002", "i006"]  # nothing found: the default, domestic first
    assert mixed("i006") == ["i001", "i002", "i006"] and mixed("i006", "i004") == ["i004", "i001", "i006"]
    assert mixed("i005", "i005") == ["i005", "i001", "i006"] and mixed("zzz") == ["i001", "i002", "i006"]


# -- validation and usage ---------------------------------------------------------------------------------------------

def test_kappa(spark):
    a, b = "1111100000", "1111000001"
    rows = [("same", x, x) for x in a] + [("some", x, y) for x, y in zip(a, b)] + [("blank", "", "1")] + [("one", "1", "1")] * 3
    got = {r.pair: r.kappa for r in validation.kappa(spark.createDataFrame(rows, "pair string, a string, b string")).collect()}
    assert got == {"same": 1.0, "some": 0.6, "blank": None, "one": 1.0}


def test_agreement_and_sample(spark):
    sheet = spark.createDataFrame([("1", "ano", "CZ", "ANO ", "cz"), ("2", "ne", "EU", "no", "EU"), ("3", "", "", "1", "US")],
                                  "id string, A_relevantni string, A_geo string, B_relevantni string, B_geo string")
    model = spark.createDataFrame([("1", 8, "CZ"), ("2", 2, "EU")], "id string, relevance int, geo string")
    got = {r.pair: r.kappa for r in validation.agreement(sheet, model).collect()}
    assert len(got) == 6 and set(got.values()) == {1.0}
    rows = spark.createDataFrame([(f"x{i}", i < 10) for i in range(40)], "id string, selected boolean")
    picks = validation.stratified_sample(rows, 30).collect()
    assert len(picks) == 30 and sum(r.selected for r in picks) == 10 and sorted(r.position for r in picks) == list(range(1, 31))


def test_usage(spark):
    prices = spark.createDataFrame([(0, "a", 1.0, 5.0, None, None), (1, "b", 2.0, 10.0, 2.5, 0.2)],
                                   "position int, name string, input double, output double, cache_write double, cache_read double")
    ledger = spark.createDataFrame([("a-2026", 1000000, 0, 1000000, 1000000), ("b", 0, 100000, 0, 0), ("zzz", 1000000, 0, 0, 0)],
                                   "model string, input_tokens long, output_tokens long, cache_write_tokens long, cache_read_tokens long")
    got = {r.model: r.cost_usd for r in usage.usage_totals(usage.call_costs(ledger, prices)).collect()}
    assert got == {"a-2026": 2.35, "b": 1.0, "zzz": 2.0, None: 5.35}


def test_running_sums_equal_a_window(spark):
    from pyspark.sql.window import Window

    from pressmill.operators.common import running_sums

    rng = random.Random(3)
    # one scope holds most rows, one is null, and there is a scope of one row
    rows = [(k, rng.choice(["hot"] * 6 + ["b", None]), rng.randint(0, 40), rng.choice([1, 5, None])) for k in range(900)] + [(900, "one", 1, 7)]
    df = spark.createDataFrame(rows, "id int, scope string, score int, cost int").repartition(6)
    got = running_sums(df, "scope", [F.desc("score"), F.asc("id")], {"spent": F.col("cost"), "place": F.lit(1)})
    w = Window.partitionBy("scope").orderBy(F.desc("score"), F.asc("id")).rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("place", F.row_number().over(w)).withColumn("spent", F.coalesce(F.sum("cost").over(w), F.lit(0)))
    assert got.columns == [*df.columns, "spent", "place"]
    assert {r.id: (r.place, r.spent or 0) for r in got.collect()} == {r.id: (r.place, r.spent) for r in want.collect()}
    assert running_sums(df.where("false"), "scope", [F.asc("id")], {"n": F.lit(1)}).count() == 0
