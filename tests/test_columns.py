import datetime as dt
import hashlib
import random
import re
import unicodedata
from email.utils import format_datetime
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from pressmill.functions import dates, text, urls
from pressmill.functions.keywords import Keywords, default_keywords, keyword_table, keywords_from_table, plain
from pressmill.operators import calls
from pressmill.sources import academic, payloads


def column(spark, values, fn):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.r for r in rows.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def plain_url(url):
    """The rule of ``normalize_url`` with the standard library."""
    parts = urlsplit(url.strip())
    if not url.strip():
        return ""
    host = parts.netloc.lower()
    host = host.rsplit(":", 1)[0] if host.endswith((":80", ":443")) else host
    kept = [p if "=" in p else p + "=" for p in parts.query.split("&") if p and not (
        p.split("=")[0].lower().startswith("utm_") or p.split("=")[0].lower() in urls.TRACKING_PARAMETERS)]
    scheme = "https" if parts.scheme == "http" else parts.scheme
    return f"{scheme}://{host}{parts.path.rstrip('/')}" + ("?" + "&".join(kept) if kept else "")


def test_urls(spark):
    rng = random.Random(4)
    some = lambda *values: rng.choice(values)
    made = ["", "  "]
    for _ in range(300):
        query = "&".join(some("k=1", "K", "utm_term=z", "UTM_ID=3", "gclid=g", "reference=r", "b=x=y", "") for _ in range(rng.randint(0, 4)))
        made.append(some("", " ") + some("http", "https", "ftp") + "://" + some("Mill.test", "weir.test:80", "lock.test:443", "ford.test:8443")
                    + some("", "/", "/Gate", "/gate/7//", "/a.b/c/") + (f"?{query}" if query else "") + some("", "#top", "#/x?y"))
    assert column(spark, made, urls.normalize_url) == [plain_url(u) for u in made]
    assert column(spark, made, urls.make_id) == [hashlib.sha1(plain_url(u).encode()).hexdigest()[:12] for u in made]
    bare = ["10.4021/weir-9", "10.77/UPPER(2)"]
    spelled = [f"{lead}{d}" for d in bare for lead in ("", "doi:", "DOI:", "http://dx.doi.org/", "https://doi.org/", " doi.org/")]
    assert column(spark, spelled + [" ", None], urls.normalize_doi) == [d.lower() for d in bare for _ in range(6)] + [None, None]


def test_dates(spark):
    rng = random.Random(8)
    days = [dt.date(1991, 1, 1) + dt.timedelta(days=rng.randrange(39_000)) for _ in range(40)]
    stamp = lambda d, h=0: dt.datetime(d.year, d.month, d.day, h)
    cases = []
    for d in days:
        zone = dt.timezone(dt.timedelta(hours=rng.randint(-9, 11)))
        local = dt.datetime(d.year, d.month, d.day, 13, 20, 5, tzinfo=zone)
        utc = local.astimezone(dt.timezone.utc)
        cases += [(d.isoformat(), stamp(d)), (local.isoformat(), utc.replace(tzinfo=None)), (format_datetime(utc), utc.replace(tzinfo=None)),
                  (format_datetime(local), utc.replace(tzinfo=None)), (f"{d.day}.{d.month}.{d.year}", stamp(d)),
                  (f"vloženo {d.day}. {d.month}. {d.year} redakcí", stamp(d))]
        cases += [(f"{d.day}{dot} {name.upper()} {d.year}", stamp(d)) for table, dot in ((dates.MONTHS_CS, "."), (dates.MONTHS_PL, ""))
                  for name, number in table.items() if number == d.month]
        cases.append((f"Posted {d:%B} {d.day}, {d.year}", stamp(d)))
    cases += [(f"31. {m}. 2031", None) for m in (2, 4, 6, 9, 11)] + [("1989-12-31", None), ("2101-01-01", None), (None, None), ("\u00a0", None), ("???", None)]
    got = column(spark, [c for c, _ in cases], lambda v: dates.parse_date(v, F.lit("2031-03-05").cast("timestamp")))
    assert [(c, g) for (c, want), g in zip(cases, got) if g != want] == []
    # a spelling without a year takes it from now
    assert column(spark, ["7 July"], lambda v: dates.parse_date(v, F.lit("2031-03-05").cast("timestamp"))) == [dt.datetime(2031, 7, 7)]


def test_deadlines(spark):
    rng = random.Random(9)
    cases = [("kdykoli", None), ("", None), (None, None)]
    for d in (dt.date(2025, 1, 1) + dt.timedelta(days=rng.randrange(2500)) for _ in range(30)):
        last = (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        cases += [(f"do {d.day}.{d.month}.{d.year} včetně", d), (f"{d.isoformat()}T17:00", d)]
        for name, number in {**dates.MONTHS_CS, **dates.MONTHS_EN}.items():
            if number == d.month:
                cases += [(f"nejpozději {d.day}. {name} {d.year}", d), (f"{name} {d.year}", last)]
    got = column(spark, [c for c, _ in cases], dates.parse_deadline)
    assert [(c, g) for (c, want), g in zip(cases, got) if g != want] == []


def test_weeks(spark):
    assert column(spark, ["2021-01-03", "2024-12-30 00:00:01"], lambda v: dates.week_of(v.cast("timestamp"))) == [
        "2020-W53", "2025-W01"]
    assert column(spark, ["2025-W01", "2020-W53", "2025-W52"], lambda v: dates.plus_weeks(v, 1)) == [
        "2025-W02", "2021-W01", "2026-W01"]
    assert dates.week_bounds("2025-W01")[0] == dt.datetime(2024, 12, 30)
    assert dates.shift_week("2021-W01", -1) == "2020-W53"
    assert dates.last_completed_week(dt.datetime(2025, 1, 6, 6)) == "2025-W01"


def test_texts(spark):
    rng = random.Random(6)
    letters = [chr(c) for block in ((0x41, 0x5A), (0xC0, 0x17F), (0x1E00, 0x1EFF), (0x2150, 0x215F), (0xFB00, 0xFB06)) for c in range(block[0], block[1] + 1)]
    made = ["".join(rng.choice([*letters, " ", "\t", "\u00a0"]) for _ in range(30)) for _ in range(100)]

    def plain(t):
        return re.sub(r"\s+", " ", "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower())

    assert column(spark, made, text.match_text) == [plain(t) for t in made]

    words = [rng.choice(["jez", "hráz", "splav", "náhon", "kolo"]) for _ in range(400)]
    marked = "".join(f"<{t}>{w}</{t}>&#32;" for w, t in zip(words, rng.choices(["b", "li", "span"], k=400)))
    for limit in (40, 333, 5000):
        got, = column(spark, [marked], lambda v, limit=limit: text.clean_text(v, limit))
        whole = " ".join(words)
        assert got == whole if len(whole) <= limit else got.endswith("…") and len(got) <= limit + 1 and whole.startswith(got[:-1] + " ")
    assert column(spark, ["R&amp;D &lt; 5 %", None, "  "], lambda v: text.clean_text(v, 100)) == ["R&D < 5 %", "", ""]
    titles = {"Webinář o splavech": True, "  konference: jezy": True, "Po konferenci o jezech": False, "": False, None: False}
    assert column(spark, list(titles), text.looks_like_event) == list(titles.values())


@pytest.mark.parametrize("kw", ["built", "table"])
def test_keywords(spark, kw):
    keywords = default_keywords()
    if kw == "table":
        keywords = keywords_from_table(keyword_table(spark).collect())
    yes = ["Nové jaderné bloky a jejich cena", "Domácnosti bez peněz: energetická chudoba roste", "Průzkum ukázal změnu názorů",
           "Na trhu stouply povolenky", "Firmy a CBAM od ledna", "Uhelný region čeká proměna", "Vodíková strategie státu",
           "Solární park u Tábora", "Messaging that works for voters", "A survey of tenants", "Carbon budgets explained",
           "Výnosy z EU ETS"]
    no = ["Hokej: vítězství doma", "Recept na svíčkovou", "Museum opens new wing", "Assets of the bank"]
    assert column(spark, yes + no, lambda v: text.matches(text.match_text(v), keywords)) == [True] * len(yes) + [False] * len(no)
    cats = column(spark, ["Veřejné mínění o větrných parcích"],
                  lambda v: text.categories(text.match_text(v), keywords))[0]
    assert "public_attitudes" in cats and "technology" in cats
    assert column(spark, ["Volné místo v týmu", "Internship in policy", "Doprava"],
                  lambda v: text.is_excluded(text.match_text(v), keywords)) == [True, True, False]


def test_absolute_urls(spark):
    rows = spark.createDataFrame([("https://e.org/a/b?x#y", "c"), ("https://e.org", "c"), ("https://e.org/a/b", "/z"),
                                  ("https://e.org/a/b", "//h/z"), ("https://e.org/a", "http://q/z")], "b string, l string")
    got = [r.u for r in rows.select(urls.absolute_url(F.col("l"), F.col("b")).alias("u")).collect()]
    assert got == ["https://e.org/a/c", "https://e.org/c", "https://e.org/z", "https://h/z", "http://q/z"]


def test_abstract_and_programme(spark):
    rows = spark.createDataFrame([({"Heat": [0], "falls": [1, 4], "as": [2], "prices": [3]},), (None,),
                                  ({"slovo": None},)], "m map<string,array<int>>")
    got = [r.a for r in rows.select(academic.reconstruct_abstract(F.col("m")).alias("a")).collect()]
    assert got == ["Heat falls as prices falls", "", ""]
    assert column(spark, ["Téma (HORIZON-MISS-2028-02)", "Téma (RFCS-2028-9)", "Nic"],
                  lambda v: calls.programme_name(v, F.lit("Zdroj"), F.lit(""))) == [
        "Horizon Europe", "Výzkumný fond pro uhlí a ocel", "Zdroj"]


def test_payload_kinds(spark):
    challenge = '<html lang="en"><script>window._cf_chl_opt = {}</script><p>Wait</p>'
    got = column(spark, [challenge, "<!doctype html><html><body>Hi</body></html>", "<?xml version='1.0'?><rss></rss>", "plain"],
                 lambda v: payloads.payload_kind(v, F.lit("text/html")))
    assert got == ["cloudflare", "html_instead_of_feed", "ok", "html_instead_of_feed"]


def test_dot_segments(spark):
    base = "https://host.test/a/b/page?x=1"
    cases = {"../c": "https://host.test/a/c", "./d?y=../z": "https://host.test/a/b/d?y=../z", "../../../e": "https://host.test/e",
             "/p/./q/../r#t": "https://host.test/p/r#t", "..": "https://host.test/a/", "plain": "https://host.test/a/b/plain"}
    df = spark.createDataFrame([(k,) for k in cases], "link string")
    got = {r.link: r.u for r in df.select("link", urls.absolute_url(F.col("link"), F.lit(base)).alias("u")).collect()}
    assert got == cases


def test_terms_among_words(spark):
    """Hits and categories beside each term's own pattern, on texts generated from pieces of the terms."""
    odd = Keywords(stems=["barge", "bar", "net-zero", "we're in", "lock gate", "lock gate keep", "-weir", "ødem"], exact=["ev", "eu ets", "c++", "co2"],
                   categories={"a": ["ets", "lock"], "b": ["gate keeper", "ev"]})
    rng = random.Random(11)
    for kw in (odd, default_keywords()):
        pieces = [w for t in kw.all_terms() for w in t.words] + ["x", "Évs", "ﬁn", "s", "-", "'", " ", "　", "\x0b", "\x01", "ß", "9"]
        texts = [None, "", " ", "lock-gate", "lock - gates keep", "ev", "evs ev", "lock gate"]
        texts += ["".join(rng.choice(pieces) + rng.choice(("", " ", " ", "-", "s ", "\n", "  ")) for _ in range(rng.randrange(1, 14))) for _ in range(400)]
        # runs of white space as one blank, also of kinds that have no plain form
        norm = text.match_text(F.col("t"))
        rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", norm.alias("norm"))
        got = rows.select("t", "norm", text.hits(F.col("norm"), kw).alias("hits"), text.hit_count(F.col("norm"), kw).alias("n"),
                          text.categories(F.col("norm"), kw).alias("cats"),
                          *[F.col("norm").rlike("(?U)" + t.pattern).alias(f"t{i}") for i, t in enumerate(kw.terms())],
                          *[F.col("norm").rlike("(?U)" + p).alias(f"c{i}") for i, (_, p) in enumerate(kw.category_patterns())]).collect()
        for r in got:
            assert r.norm == plain(r.t)
            assert r.hits == [t.name for i, t in enumerate(kw.terms()) if r[f"t{i}"]] and r.n == len(r.hits)
            assert r.cats == [name for i, (name, _) in enumerate(kw.category_patterns()) if r[f"c{i}"]]
        assert sum(r.n for r in got) > 400
    assert spark.range(1).select(F.size(text.hits(F.lit("any"), Keywords(stems=[])))).first()[0] == 0
