"""Manifest, decontamination and divergence audit against plain versions, on rows with nulls, ties, copies and foreign columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressmill.llm import audit, leaks, manifest, queries
from pressmill.llm.wordspans import hashes, word_bytes, words_of

SMALL = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, row int, grp string, n long, size long, "
          "path string, item string, term string, hits int, _at int, _g string")
LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, rows):
    """Rows (doc_id, text, lang, source) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, g, s, len(t or ""), -1, 2, "g", 3, 4, "p", "i", "t", 5, 6, "_") for i, t, g, s in rows], SCHEMA)


def words(pattern, text):
    return re.findall(pattern, (text or "").translate(LETTERS))


# -- words --------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("digits,pattern", [(True, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (False, r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")])
def test_words_of_texts(digits, pattern, monkeypatch):
    from pressmill.llm import wordspans

    monkeypatch.setattr(wordspans, "CHUNK_BYTES", 40)
    rng = random.Random(4)
    texts = [None, "", "É", "İİ", "x" * 500, "\x85  a"] + ["".join(rng.choice("aBZ19 é_-\n漢") for _ in range(rng.randint(0, 25))) for _ in range(200)]
    got = defaultdict(list)
    for part in words_of(pa.array(["before", *texts]).slice(1), word_bytes(digits)):
        for r, c in zip(part.text, part.code, strict=True):
            got[part.first_row + r].append(part.distinct[int(c)].as_py().decode())
    assert [got[k] for k in range(len(texts))] == [words(pattern, t) for t in texts]


def test_hashes_do_not_depend_on_the_place():
    a = hashes(pa.array([b"ab", b"", b"cde", b"ab"]))
    assert a[0] == a[3] and len(set(a.tolist())) == 3 and (hashes(pa.array([b"x", b"cde", b"ab"]).slice(1)) == a[[2, 0]]).all()


# -- manifest -----------------------------------------------------------------------------------------------------

def plain_tree(level):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([hashlib.sha256("".join(levels[-1][k:k + 16]).encode()).hexdigest() for k in range(0, len(levels[-1]), 16)])
    return levels


def test_layout_uses_each_place_once():
    for height in (1, 2, 3, 4):
        for leaves in {2, 15, 16, 17, 255, 256, 257, 4095, 4096} - ({17, 255, 256, 257, 4095, 4096} if height == 1 else set()):
            if leaves <= 16 ** height:
                sizes = manifest.level_sizes(leaves, height)
                at = np.concatenate([manifest.address(d, np.arange(n), height + 1, leaves) for d, n in enumerate(sizes)])
                assert sorted(at) == list(range(sum(sizes)))
    # whole trees of four levels: two levels on top, then the trees below them one after the other
    assert manifest.address(2, np.array([0, 1, 255]), 4, 4096).tolist() == [17, 34, 17 + 17 * 255]


@pytest.mark.parametrize("height", [1, 2])
def test_manifest_against_a_plain_tree(spark, height):
    rng = random.Random(height)
    rows = [(k, f"Text {k} É", "en", "hot") for k in range(700)]
    rows += [(rng.randint(0, 10 ** 6), rng.choice([None, "", "ABC", "abc\n" * 50]), None, rng.choice([None, "", "é", "z", "Z"])) for _ in range(60)]
    rows += [(9, "one", "en", "alone"), (None, None, None, None), (5, "same", "x", "twice"), (5, "same", "x", "twice"), (5, "other", "x", "twice")]
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, rows).repartition(5)
    built = manifest.build(docs, columns, keep={"doc_id": F.col("doc_id"), "text": F.col("text")}, height=height)
    got = manifest.verify(manifest.prove(built, height=height), F.col("digest")).collect()
    by_source = defaultdict(list)
    for i, t, g, s in rows:
        parts = "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, g, len(t or ""), t))
        by_source[s].append((i is not None, i or 0, hashlib.sha256(parts.encode()).hexdigest()))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([h for *_, h in sorted(by_source[s])]) for s in order}
    top = plain_tree([trees[s][-1][0] for s in order])
    want = Counter()
    for k, s in enumerate(order):
        for n, digest in enumerate(trees[s][0]):
            others = ""
            for levels, at in ((trees[s], n), (top, k)):
                for level in levels[:-1]:
                    first = at // 16 * 16
                    others += "".join(level[first:at] + level[at + 1:first + 16])
                    at //= 16
            want[s, n, digest, trees[s][-1][0], top[-1][0], hashlib.sha256(others.encode()).hexdigest(), top[-1][0]] += 1
    assert Counter((r.grp, r.n, r.digest.hex(), r.subroot.hex(), r.root.hex(), r.proof_sha256, r.folded) for r in got) == want
    few = manifest.prove(built, built.leaves.where("row.doc_id in (3, 9) and size > 0"), height=height).collect()
    assert {(r.row.doc_id, r.grp) for r in few} >= {(3, "hot"), (9, "alone"), (9, "hot")}
    assert all(manifest.fold(r.digest, manifest.unpacked(r.path)).hex() == top[-1][0] for r in few)
    wrong = manifest.fold(hashlib.sha256(b"").digest(), manifest.unpacked(few[0].path)).hex()
    assert wrong != top[-1][0]


def test_proofs_are_checked_where_they_are_made(spark):
    rows = [(k, f"T{k}", "en", "hot") for k in range(300)] + [(9, "one", "en", "alone"), (None, None, None, None)]
    built = manifest.build(table(spark, rows), ["doc_id", "source", "lang", "n_chars", "text"], keep={"doc_id": F.col("doc_id")}, height=2)
    digest = F.when(F.col("n") % 3 == 0, F.unhex(F.sha2(F.lit("other"), 256))).otherwise(F.col("digest"))
    got = manifest.prove(built, height=2, digest=digest)
    # no path goes on to another Python worker: only single leaves' proofs are checked apart
    assert got._jdf.queryExecution().optimizedPlan().toString().startswith("Union")
    want = manifest.verify(manifest.prove(built, height=2), digest).select(*got.columns)
    assert Counter(got.collect()) == Counter(want.collect()) and got.where("folded = lower(hex(root))").count() == 200


def test_manifest_of_nothing_and_of_one_row(spark):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    assert manifest.prove(manifest.build(table(spark, []), columns)).count() == 0
    one = manifest.prove(manifest.build(table(spark, [(1, None, None, None)]), columns)).collect()
    assert len(one) == 1 and one[0].digest == one[0].subroot == one[0].root and one[0].path == b""


# -- benchmark passages -------------------------------------------------------------------------------------------

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_leaks(rows, items):
    windows = defaultdict(set)
    for name, text in items:
        w = words(ALNUM, text)
        size = min(10, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[k:k + size])].add(name)
    out = {}
    for i, t, *_ in rows:
        w, hit, names = words(ALNUM, t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if found := windows.get(tuple(w[k:k + size])):
                    hit |= set(range(k, k + size))
                    names |= found
        out[i] = len(w), len(hit), sorted(n for n in names if n is not None)
    return out


@pytest.mark.parametrize("part_words,segment", [(1 << 20, 4096), (60, 7)])
def test_leaks_against_all_windows(spark, monkeypatch, part_words, segment):
    monkeypatch.setattr(leaks, "SEGMENT_WORDS", segment)
    rng = random.Random(8)
    vocabulary = ["Ab", "c", "d1", "É", "f", "漢字"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(str(k), say(rng.choice([2, 5, 9, 10, 11, 40]))) for k in range(25)]
    items = [*items, ("7", "seven-more words;here"), ("e", ""), ("n", None), (None, "no name c c c d1"), ("b", "..."), ("z", items[3][1].upper())]
    rows = []
    for k in range(150):
        text = say(rng.randint(0, 30))
        if k % 3 == 0:
            text += f", {rng.choice(items)[1] or ''}\n{say(3)}"
        rows.append((k, text, "en", "s"))
    rows += [(150, None, None, None), (151, "", None, None), (152, say(8) * 300 + " " + items[0][1], None, None), (153, "NO name, c_C c d1", None, None)]
    docs = table(spark, rows)
    bench = spark.createDataFrame(items, "item_id string, text string")
    found = leaks.find_leaks(docs.repartition(3), bench, part_words=part_words).collect()
    assert {r.row.doc_id: (r.n_words, sum(h.last - h.first for h in r["hits"]), r["items"]) for r in found} == plain_leaks(rows, items)
    assert len(found) == len(rows) and any(r["items"] for r in found)
    for r in found:
        raw = (r.row.text or "").encode()
        for hit, span in zip(r["hits"], r["spans"], strict=True):
            piece = raw[span.first:span.last].decode()
            assert words(ALNUM, piece) == words(ALNUM, r.row.text)[hit.first:hit.last]


def test_removal_and_empty_tables(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Before. {item.upper()}! after", "en", "s"), (2, "clean", "en", "s"), (3, None, None, None), (1, f"Before. {item.upper()}! after", "en", "s")]
    docs, bench = table(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string")
    cut = leaks.decontaminate(docs, bench)
    assert cut.columns == docs.columns
    assert sorted((r.doc_id, r.text or "-", r.term) for r in cut.collect()) == [
        (1, "Before. ! after", "t"), (1, "Before. ! after", "t"), (2, "clean", "t"), (3, "-", "t")]
    assert sorted(r.doc_id for r in leaks.decontaminate(docs, bench, remove="documents").collect()) == [2, 3]
    assert {len(r["hits"]) for r in leaks.find_leaks(docs, bench.limit(0)).collect()} == {0}
    assert leaks.find_leaks(docs.limit(0), bench).count() == 0


def test_colliding_window_hashes_get_another_seed(monkeypatch):
    plain = leaks._window_hashes
    monkeypatch.setattr(leaks, "_window_hashes", lambda c, a, size, seed: plain(c, a, size, seed) if seed else np.zeros(len(a), np.uint64))
    made = leaks.window_set([("a", 2, 3, b"x y z"), ("b", 2, 2, b"y z")])
    assert made.seed == 1 and sorted(map(tuple, made.items)) == [("a",), ("a", "b")]


# -- divergence of sources ----------------------------------------------------------------------------------------

def plain_audit(rows, least, ranks):
    groups, by_lang, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, t, g, s in rows:
        w = words(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)
        groups[g or "", s or ""].update(w)
        docs[g or ""].update(set(w))
    kept = {g: sorted(t for t, n in c.items() if n >= least) for g, c in docs.items()}
    for (g, _), c in groups.items():
        by_lang[g].update(c)
    share = lambda c, terms: {t: 1 + 10 ** 9 * (c[t] + 5) // (sum(c[x] for x in terms) + 5 * len(terms)) for t in terms}
    out = set()
    for (g, s), c in groups.items():
        own, usual = share(c, kept[g]), share(by_lang[g], kept[g])
        pair = [(-sum(abs(own[t] - other[t]) for t in kept[g]), o.encode(), o) for (h, o), d in groups.items()
                if h == g and o != s for other in [share(d, kept[g])]]
        term = [(usual[t] - own[t], t.encode(), t) for t in kept[g] if c[t] and own[t] > usual[t]]
        for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:ranks])):
            out |= {(g, s, part, item, -value, n + 1) for n, (value, _, item) in enumerate(found)}
    return out


@pytest.mark.parametrize("dense,shard,at_once,cells", [(1 << 27, 1 << 20, 1 << 25, 1 << 21), (300, 60, 100, 12)])
def test_audit_against_counts(spark, monkeypatch, dense, shard, at_once, cells):
    for name, value in (("DENSE_BYTES", dense), ("SHARD_BYTES", shard), ("CELLS", cells)):
        monkeypatch.setattr(audit, name, value)
    rng = random.Random(6)
    vocabulary = ["Ab", "b", "É", "漢", "ssß", "x" * 300] + [f"w{chr(97 + k)}" for k in range(26)]
    rows = []
    for k in range(300):
        source = rng.choice(["hot", "hot", "a", "B", "é", "", None])
        lang = rng.choice(["en", "en", "de", None])
        rows.append((k, "1".join(rng.choice(vocabulary[:rng.randint(1, 32)]) for _ in range(rng.randint(0, 20))), lang, source))
    rows += [(400, None, "en", "mute"), (401, "", "xx", "p"), (402, "rare", "xx", "q"), (402, "rare", "xx", "q"), (None, "one", "solo", "s")]
    got = audit.audit(table(spark, rows).repartition(4), least_docs=12, term_ranks=5, pass_bytes=at_once)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == plain_audit(rows, 12, 5)
    assert {r for r in got if r[0] == "xx"} == {("xx", "p", "pair", "q", 0, 1), ("xx", "q", "pair", "p", 0, 1)}


def test_audit_of_nothing(spark):
    assert audit.audit(table(spark, [])).count() == 0


def test_perfect_hash(monkeypatch):
    terms = pa.array([f"term{k}".encode() for k in range(5000)] + [b"", b"y" * 2000], pa.large_binary())
    made = audit.PerfectHash.build(terms)
    slots = made.slots(terms, hashes(terms))
    assert sorted(slots) == list(range(len(terms))) and not made.listed
    assert made.terms.take(pa.array(slots)).equals(terms)
    strange = pa.array([f"other{k}".encode() for k in range(3000)], pa.large_binary())
    assert (made.slots(strange, hashes(strange)) == -1).all()
    # terms whose hashes are equal are found by their bytes
    monkeypatch.setattr(audit, "hashes", lambda t: np.zeros(len(t), np.uint64))
    few = terms.slice(0, 3)
    made = audit.PerfectHash.build(few)
    assert sorted(made.slots(few, np.zeros(3, np.uint64))) == [0, 1, 2] and len(made.listed) == 3
    assert made.slots(strange.slice(0, 2), np.zeros(2, np.uint64)).tolist() == [-1, -1]


# -- registered queries -------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_benchmark_decontamination", "op13_source_divergence"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    df = queries.queries()[name](spark, SMALL)
    assert df.columns == columns
    got = [tuple(r) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want.fetchall()))
    if name.startswith("op11"):
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
        for r in df.collect():
            touched = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and re.search("[A-Z]", texts[r.doc_id] or "")
            assert r.verified != bool(touched)
