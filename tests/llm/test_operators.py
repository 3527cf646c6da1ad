"""Every operator against a plain version, on rows with nulls, empty texts, ties, copies and foreign columns."""

import glob
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pressmill import session
from pressmill.llm import bpe, embeddings, language, lines, mixing, near_documents, quality, queries, repeats, token_files, topk
from pressmill.llm.common import components, forest

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, keys string, row int, kept string"


def docs(spark, texts, **more):
    rows = [(k, t, "en", "s0", len(t or ""), -k, "x", 1, "y") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def sentence(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


ODD = [None, "", " ", "\n\n", "a", "Ünï cödé 你好　x\x1cy\x85z İstanbul", "<|endoftext|> in <|endoftext|>", "tab\tand\r\nline",
       "don't we'll I'm 1234 567", "x" * 5000, "é combining", "\U0001f600 face"]


# -- components -----------------------------------------------------------------------------------------------------

def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(130)] + [(k, k + 1) for k in range(300, 340)] + [(400, 400)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    a, b = np.array(links).T
    root = forest(401, a, b)
    assert got == {k: root[k] for k in {x for p in links if p[0] != p[1] for x in p}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- tokens -------------------------------------------------------------------------------------------------------

def test_written_tables_leave_no_shuffle_files(spark):
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    before, setting = files(), spark.conf.get(session.DROP_SHUFFLES, None)
    kept = spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()
    table = session.cut_lineage(kept)
    assert not files() - before
    assert spark.conf.get(session.DROP_SHUFFLES, None) == setting
    # what was written can be used again, as can the table
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, table.collect())) == [(k, len(range(k, 1000, 7))) for k in range(7)]


def test_trie_encoding_equals_the_library(spark):
    rng = random.Random(2)
    texts = ODD + [sentence(rng, 40, "abcdeéß' 12.,") for _ in range(40)] * 2
    tok = Tokenizer.from_file(BYTES)
    got = {r.id: r for r in bpe.encode_documents(docs(spark, texts).repartition(3), BYTES).collect()}
    for k, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(got[k].ids, "<u4").tolist() == ids and got[k].n_tokens == len(ids)
        assert got[k].decoded == tok.decode(ids, skip_special_tokens=False) == (t or "")
    assert bpe.encode_documents(docs(spark, []), BYTES).count() == 0


def test_trie_walk_looks_at_tokens_that_end_there(monkeypatch):
    with open(BYTES, encoding="utf-8") as f:
        enc = bpe.TrieEncoder(f.read())
    monkeypatch.setattr(bpe, "DECODED", 7)
    rng, tok = random.Random(4), Tokenizer.from_file(BYTES)
    texts = [t or "" for t in ODD] + [sentence(rng, 60, "abcdeéß' 12.,") for _ in range(20)] + [" " * 300 + "." * 300 + "ab" * 300]
    got = enc.encode(texts)
    ids = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == ids
    assert enc.decode(got) == [tok.decode(i, skip_special_tokens=False) for i in ids] == texts and enc.decode([]) == []
    # a few texts ask for few tokens: neither are all put together beforehand nor do their prefixes all become steps
    assert len(enc.parts) < len(enc.token) // 10 and len(enc.steps) < len(enc.begins) // 10


def test_token_files(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    texts = ODD + [sentence(rng, 200, "abcdeé' 12.,") for _ in range(200)]
    monkeypatch.setattr(token_files, "SHARD_ROWS", 40)
    table = docs(spark, texts).withColumn("doc_id", F.col("doc_id") * 3)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(table.repartition(5), path, WORDS)
    got = sorted(token_files.crc32_column(token_files.read_tokens(spark, path)).collect(), key=lambda r: r.id)
    tok, start = Tokenizer.from_file(WORDS), 0
    assert [r.id for r in got] == [3 * k for k in range(len(texts))]
    for r, t in zip(got, texts, strict=True):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids) // 4, zlib.crc32(ids)) and bytes(r.ids) == ids
        start += len(ids) // 4
    assert spark.read.parquet(f"{path}/blocks").count() > 2
    assert [r.id for r in token_files.read_tokens(spark, path, ids=[9, 300, 5]).orderBy("id").collect()] == [9, 300]
    token_files.write_tokens(docs(spark, []), str(tmp_path / "none"), WORDS)
    assert token_files.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_token_pieces_equal_the_library():
    rng, tok = random.Random(5), Tokenizer.from_file(WORDS)
    with open(WORDS, encoding="utf-8") as f:
        enc = token_files.Encoder(f.read())
    every = "".join(map(chr, [9, 10, 13, *range(32, 127), *range(0xa1, 0x180)]))
    texts = [t or "" for t in ODD] + [sentence(rng, 40, every) for _ in range(40)] + [f"a{c}b {c}{c}'{c} {c}S" for c in every]
    texts += ["Don'T WE'LL I'M 12½ x²", "a<|startoftext|>b", "ǅ Ⱥ \u0130I ŉ", "e\u0301", "\u212b\xa0b\x85c\x1cd\x0be"]
    want = [np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes() for t in texts]
    assert enc.encode(texts, 1) == want
    # of a Latin text the pieces are kept, once for both cases and whatever sign follows
    enc.known.clear()
    enc.encode(["Stone stone stone. STONE, (stone)"], 1)
    assert set(enc.known) == {"stone", ".", ",", "(", ")"}


# -- vectors ------------------------------------------------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep long, cell int")


def near_vectors(rng, n, dim=16):
    base = rng.standard_normal((12, dim))
    out = []
    for k in range(n):
        v = base[k % 12] + rng.choice([0.02, 0.15, 0.28]) * rng.standard_normal(dim)
        out.append((k, [float(x) for x in v], int(k % 12 % 2), 7, 7))
    return out


def test_embedding_links(spark):
    rows = near_vectors(np.random.default_rng(4), 400)
    rows += [(400 + k, rows[5][1], rows[5][2], 1, 1) for k in range(30)]
    rows += [(500, None, 0, 1, 1), (501, [0.0] * 16, 0, 1, 1), (502, [float("nan")] * 16, 0, 1, 1), (503, [None] * 16, 0, 1, 1),
             (504, rows[5][1], None, 1, 1), (505, rows[5][1][:15], rows[5][2], 1, 1), (506, [], 0, 1, 1)]
    got = {r.id: r for r in embeddings.near_duplicates(vectors(spark, rows)).collect()}
    found = expected = 0
    a, b = [], []
    ok = [r for r in rows if r[0] < 500]
    unit = {r[0]: np.array(r[1], np.float32).astype(float) / np.linalg.norm(np.array(r[1], np.float32).astype(float)) for r in ok}
    count = Counter()
    for x in ok:
        for y in ok:
            if x[0] < y[0] and x[2] == y[2] and unit[x[0]] @ unit[y[0]] >= 0.93:
                a.append(x[0])
                b.append(y[0])
                count[x[0]] += 1
                count[y[0]] += 1
    for r in ok:
        assert got[r[0]].n_links <= count[r[0]]
        found, expected = found + got[r[0]].n_links, expected + count[r[0]]
    assert found >= 0.9 * expected > 1000
    assert len(got) == len(rows) and all(got[k].n_links == 0 and got[k].kept for k in range(500, 507))
    assert embeddings.near_duplicates(vectors(spark, [])).count() == 0


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(k, [float(x) for x in np.round(rng.standard_normal(4), 1)], 0, 1, 1) for k in range(300)]
    rows += [(k, rows[3][1], 0, 1, 1) for k in range(300, 320)]
    rows += [(400, None, 0, 1, 1), (401, [float("inf")] * 4, 0, 1, 1), (402, [None] * 4, 0, 1, 1), (403, [1.0], 0, 1, 1), (None, rows[0][1], 0, 1, 1)]
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "TILE_ROWS", 2)
    df = vectors(spark, rows)
    got = {}
    for r in topk.top_k(df.where("vec_id % 100 = 0"), df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    e = {k: np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int) for k, v, *_ in rows[:320]}
    for q in (0, 100, 200, 300):
        want = sorted(((int(e[q] @ v), k) for k, v in e.items() if k != q), key=lambda x: (-x[0], x[1]))[:10]
        assert got[q] == [(k, s) for s, k in want]
    assert set(got) == {0, 100, 200, 300}
    assert topk.top_k(df.where("false"), df).count() == 0
    few = topk.top_k(df.where("vec_id = 403"), df.where("vec_id in (403, 402)"))
    assert few.count() == 0
    blank = vectors(spark, [(0, [], 0, 1, 1), (1, [], 0, 1, 1), (100, [], 0, 1, 1), (2, [1.0], 0, 1, 1)])
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(blank.where("vec_id % 100 = 0"), blank).collect()) == [
        (0, 1, 1, 0), (0, 2, 100, 0), (100, 1, 0, 0), (100, 2, 1, 0)]


def test_products_beyond_doubles():
    big = np.array([[2.0 ** 40, 3.0]])
    assert topk.products(big, np.array([[2.0 ** 20, 1.0], [2.0 ** 40, 0.0]])).tolist() == [[2 ** 60 + 3, 2 ** 63 - 1]]


# -- near documents, lines, passages -------------------------------------------------------------------------------

def plain_shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def copies(rng):
    texts = list(ODD)
    shared = sentence(rng, 60)
    for _ in range(25):
        base = sentence(rng, rng.randint(3, 120)).split()
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            other = list(base)
            for _ in range(rng.randint(0, 4)):
                other[rng.randrange(len(other))] = sentence(rng, 1)
            texts.append(" ".join(other).upper() if rng.random() < 0.3 else " ".join(other))
    texts += [shared + " " + sentence(rng, rng.randint(1, 30)) for _ in range(60)] + ["one two three"] * 3
    return texts


@pytest.mark.parametrize("seed,frequent", [(6, 100), (7, 4)])
def test_near_documents(spark, monkeypatch, seed, frequent):
    monkeypatch.setattr(near_documents, "FREQUENT_LEAST", frequent)
    texts = copies(random.Random(seed))
    sets = [plain_shingles(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = forest(len(texts), *np.array(links).T)
    table = docs(spark, texts)
    null = table.limit(1).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit("one two three"))
    got = {r.id: r for r in near_documents.near_documents(table.union(null).repartition(4)).collect()}
    assert len(got) == len(texts) + 1 and got[None].component_id is None
    for k in range(len(texts)):
        assert (got[k].n_shingles, got[k].component_id) == (len(sets[k]), root[k])
    assert near_documents.near_documents(docs(spark, [])).count() == 0


def test_lines(spark):
    rng = random.Random(8)
    pool = [sentence(rng, rng.randint(3, 30)) for _ in range(60)]
    texts = list(ODD)
    for _ in range(60):
        part = []
        for line in rng.sample(pool, 4) + [sentence(rng, 9)]:
            w = line.split()
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = sentence(rng, 1)
            part.append(" ".join(w))
        texts.append("\n".join([*part, "", "end"]))
    seen, want = [], {}
    for k, t in enumerate(texts):
        keep = []
        for line in (t or "").split("\n"):
            w = [x for x in re.split("[ \t\x0b\f\r]+", line) if x]
            s = set(w)
            if len(w) >= 5 and any(100 * len(s & o) >= 80 * len(s | o) for o in seen):
                seen.append(s)
                continue
            if len(w) >= 5:
                seen.append(s)
            keep.append(line)
        want[k] = None if t is None else "\n".join(keep)
    table = docs(spark, texts)
    null = table.limit(40).withColumn("doc_id", F.lit(None).cast("long"))
    out = lines.dedup_lines(table.union(null).repartition(4), least_words=5).collect()
    assert {r.doc_id: r.text for r in out if r.doc_id is not None} == want and len(out) == len(texts) + 40
    assert {r.n_removed for r in out if r.doc_id is None} == {0} and sum(r.n_removed for r in out) > 50
    assert all(r.id == -r.doc_id for r in out if r.doc_id is not None)
    assert lines.dedup_lines(docs(spark, [])).count() == 0


def test_line_pairs_are_verified_in_turns(spark, monkeypatch):
    rng = random.Random(12)
    base = [sentence(rng, 12) for _ in range(30)]
    texts = base + [b + " more" for b in base] + [sentence(rng, 12) for _ in range(5)]
    split = lines.split_lines(docs(spark, texts))
    pairs = spark.createDataFrame([(30 + k, 0, k, 0) for k in range(30)] + [(60 + k, 0, k, 0) for k in range(5)],
                                  "id long, pos int, o_id long, o_pos int")
    steps, write = [], lines.written

    def recorded(df, wait=0):
        steps.append(write(df))
        return steps[-1]

    monkeypatch.setattr(lines, "written", recorded)
    monkeypatch.setattr(lines, "TURNS", 3)
    assert sorted(r.id for r in lines._similar(pairs, split).collect()) == list(range(30, 60))
    found = [s.count() for s in steps if s.columns == ["id", "pos"]]
    assert len(found) == 3 and sum(found) == 30 and max(found) < 30


def test_line_pairs_beyond_the_bound_of_places_are_not_verified(spark, monkeypatch):
    # 20 words each; the rare words that two lines share stand at the start of one prefix and at the end of the other
    common = [f"w{k}" for k in range(16)]
    texts = [" ".join([f"a{k}" for k in range(4)] + common), " ".join([f"b{k}" for k in range(4)] + common),
             " ".join(["a3"] + [f"c{k}" for k in range(19)]), " ".join(["a0"] + [f"d{k}" for k in range(19)])]
    n, places = 20, [(0, 0), (0, 2), (0, 3), (4, 1), (2, 4)]
    rows = spark.createDataFrame([(n, i, n, j) for i, j in places], "n int, i int, o_n int, o_i int")
    kept = [(r.i, r.o_i) for r in rows.where(lines._never_beyond("n", "i", "o_n", "o_i")).collect()]
    # 18 of 20 words must be shared: from places i and j on, 1 + min(i, j) + 19 - max(i, j) can be
    assert kept == [(0, 0), (0, 2), (2, 4)]
    tables, write = [], lines.written
    monkeypatch.setattr(lines, "written", lambda df: tables.append(write(df)) or tables[-1])
    assert lines.repeated_lines(docs(spark, texts)).count() == 0
    # words of lines, and what met, are gone when nothing reads them any more; earlier lines come in the turns that name them
    assert not any(glob.glob(f.removeprefix("file:")) for t in tables if {"a", "leader"} & set(t.columns) for f in t.inputFiles())


def test_marks_bound_the_shared_keys(spark):
    rng = random.Random(7)
    sets = [[rng.sample(range(400), rng.randint(1, 60)) for _ in range(2)] for _ in range(300)]
    marked = lambda side: lines._marks(spark.createDataFrame(
        [(k, list(enumerate(pair[side]))) for k, pair in enumerate(sets)], "k int, keys array<struct<i:int,key:long>>")).drop("keys")
    both = marked(0).join(marked(1).withColumnsRenamed({"marks": "o_marks", "lost": "o_lost"}), "k")
    most = {r.k: r.most for r in both.select("k", lines._most_shared("marks", "lost", "o_marks", "o_lost").alias("most")).collect()}
    shared = [len(set(a) & set(b)) for a, b in sets]
    assert all(most[k] >= n for k, n in enumerate(shared))
    assert any(most[k] < min(len(a), len(b)) for k, (a, b) in enumerate(sets))


def test_lines_of_the_same_words_are_ruled_out_before_their_words_are_compared(spark, monkeypatch):
    """Lines of a small vocabulary meet under many words; nearly no pair of unlike ones is left to verify, no index row is written."""
    rng = random.Random(17)
    words = [f"word{k}" for k in range(60)]
    texts = ["\n".join(" ".join(rng.sample(words, rng.choice([24, 40]))) for _ in range(20)) for _ in range(15)]
    texts.append(" ".join(texts[3].split("\n")[5].split()[:-1] + ["other"]))
    tables, write = [], lines.written
    monkeypatch.setattr(lines, "written", lambda df: tables.append((df.columns, write(df), df.count())) or tables[-1][1])
    assert [tuple(r) for r in lines.repeated_lines(docs(spark, texts)).collect()] == [(15, 0)]
    assert not any("key" in columns for columns, *_ in tables)
    pairs = [n for columns, _, n in tables if columns == ["id", "pos", "o_id", "o_pos"]]
    assert 1 <= sum(pairs) < 40
    assert not any(glob.glob(f.removeprefix("file:")) for columns, t, _ in tables if "keys" in columns for f in t.inputFiles())


def test_parities_rule_out_no_similar_line(spark):
    rng = random.Random(19)
    pairs = []
    for _ in range(400):
        a = [rng.getrandbits(60) for _ in range(rng.choice([1, 4, 5, 9, 30, 32, 35, 60, 200]))]
        b = [rng.getrandbits(60) for _ in range(rng.randint(0, len(a) // 4))] + a[rng.randint(0, len(a) // 4):]
        pairs.append((a, b or a, [rng.getrandbits(60) for _ in a]))

    def side(k, prefix):
        rows = spark.createDataFrame([(i, p[k]) for i, p in enumerate(pairs)], "k int, numbers array<long>")
        return rows.select("k", F.size("numbers").alias(f"{prefix}n"), *(c.alias(prefix + n) for c, n in zip(lines._parities(), ("parity", "part"))))

    def near(k):
        return {r.k for r in side(0, "").join(side(k, "o_"), "k").where(lines._near_parity("", "o_")).collect()}

    similar_ones = {i for i, (a, b, _) in enumerate(pairs) if 100 * len({*a} & {*b}) >= lines.PERCENT * len({*a} | {*b})}
    assert similar_ones <= near(1) and len(similar_ones) > 100
    assert len({i for i in near(2) if 9 <= len(pairs[i][0]) <= 60}) <= 2


def test_lines_of_every_length(spark):
    rng = random.Random(13)
    words = sentence(rng, 9).split()
    texts = [*ODD, "Les.\nonce", "Les.", " Les. \tLes.", "你好世界", "你好世界\nelse", "a b c d", "x d c b a", "x d c b y", "a b c d e", "p q r s t",
             "s r q p", "p p q q r", "r q p"]
    for _ in range(150):
        texts.append("\n".join(" ".join(rng.choices(words, k=rng.randint(0, 8))) for _ in range(3)))
    seen, want = [], {}
    for k, t in enumerate(texts):
        keep = []
        for line in (t or "").split("\n"):
            s = {x for x in re.split("[ \t\x0b\f\r]+", line) if x}
            if not any(100 * len(s & o) >= 80 * len(s | o) for o in seen):
                keep.append(line)
            if s:
                seen.append(s)
        want[k] = None if t is None else "\n".join(keep)
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs(spark, texts).repartition(4)).collect()}
    assert got == want


def test_line_query_compares_short_lines(spark, tmp_path):
    docs(spark, ["Les.\none two", "Les.", "two one"]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.n_removed for r in queries.op8_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {0: 0, 1: 1, 2: 1}
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert [r.doc_id for r in corpus_pipeline.drop_repeated_lines(spark, table, str(tmp_path)).collect()] == [0]


def test_flagged_samples_are_bits():
    text = "é" * 5000
    at = repeats.cover_positions(10000)
    mask = np.arange(len(at)) % 7 == 3
    marks = np.packbits(mask).tobytes()
    assert repeats._flagged(text, marks).tolist() == at[mask].tolist() and len(marks) < 10000 / 60
    assert repeats._flagged("", b"").tolist() == []


def test_repeated_passages(spark):
    rng = random.Random(9)
    passages = [sentence(rng, rng.randint(15, 60)) for _ in range(8)] + ["ab" * 130, "é" * 77]
    texts = list(ODD)
    for _ in range(50):
        texts.append(" ".join([sentence(rng, rng.randint(0, 8)), rng.choice(passages), sentence(rng, 3), rng.choice(passages)])[rng.randint(0, 9):])
    texts += [texts[-1]] * 3
    seen, want = set(), {}
    for k, t in enumerate(texts):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            s = data[i:i + 100]
            if s in seen:
                gone[i:i + 100] = True
            seen.add(s)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
        want[k] = (len(data), int(gone.sum()), list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)),
                   hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    table = docs(spark, texts)
    null = table.where("doc_id = 30").withColumn("doc_id", F.lit(None).cast("long"))
    got = {r.id: (r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], hashlib.sha256(bytes(r.kept)).hexdigest())
           for r in repeats.remove_repeats(table.union(null).repartition(5)).collect()}
    assert got.pop(None)[1] == 0 and got == want
    twice = repeats.remove_repeats(table.union(table.where("doc_id = 40")))
    assert twice.count() == len(texts) + 1
    assert repeats.remove_repeats(docs(spark, [])).count() == 0


def test_runs_are_few_entries(spark):
    run = "-" * 30000
    at = np.arange(len(run))
    _, _, deal = repeats._suffix_entries(run, at)
    assert len(deal) > 29000 and repeats.first_two(deal).sum() == 2
    assert repeats.first_two(np.array([5, 3, 5, 5, 3, 7], np.uint64)).tolist() == [True, True, True, False, True, True]
    assert repeats.first_two(np.empty(0, np.uint64)).tolist() == []
    # strings that share only their first half are dealt apart
    deals = {int(repeats._suffix_entries("-" * 50 + f"{k:050d}", at[:1])[2][0]) for k in range(100)}
    assert len(deals) == 100
    got = {r.id: (r.n_removed, len(r.spans)) for r in repeats.remove_repeats(docs(spark, ["=" * 700, "ab" * 300, "-" * 120, "x" + "-" * 119])).collect()}
    assert got == {0: (699, 1), 1: (598, 1), 2: (119, 1), 3: (119, 1)}


def test_difference_cover():
    assert {(a - b) % repeats.PERIOD for a in repeats.COVER for b in repeats.COVER} == set(range(repeats.PERIOD))


# -- language, quality, mixing --------------------------------------------------------------------------------------

def test_language(spark):
    rng = random.Random(10)
    letters = {"aa": "abcde", "bb": "fghij", "cc": "klmnoé"}
    rows = [(k, sentence(rng, 30, letters[lang]), lang) for k in range(60) for lang in letters]
    train = spark.createDataFrame(rows + [(0, None, "aa"), (1, "xyz", None), (2, "", "bb")], "doc_id long, text string, lang string")
    names, shares = language.learn(train)
    assert names == ["aa", "bb", "cc"]
    mixed = sentence(rng, 60, letters["aa"]) + " " + sentence(rng, 30, letters["cc"])
    texts = [sentence(rng, 10, letters["bb"]), mixed, None, "", "123 ...", sentence(rng, 4000, letters["cc"])]
    got = {r.id: r for r in language.predict(docs(spark, texts), names, shares, keep=("lang",)).collect()}
    assert [got[k].lang_pred for k in range(6)] == ["bb", "aa", "und", "und", "und", "cc"] and got[2].score == 0
    assert set(got[1].proportions) == {"aa", "cc"} and 0.55 < got[1].score < 0.8 and set(got[0].proportions) == {"bb"}
    none, empty = language.learn(train.where("false"))
    assert none == [] and language.predict(docs(spark, ["abc"]), none, empty).first().lang_pred == "und"


def test_quality(spark):
    rng = random.Random(11)
    good = [". ".join(sentence(rng, rng.randint(6, 14)).capitalize() for _ in range(8)) + "." for _ in range(150)]
    bad = [f"{sentence(rng, 1)} " * 60 for _ in range(12)] + [" ".join(w + "&&&" for w in sentence(rng, 50).split()) for _ in range(12)]
    bad += [" ".join(w + "!!" for w in sentence(rng, 50).upper().split()) for _ in range(12)] + [" | ".join(sentence(rng, 60).split()) for _ in range(12)]
    texts = good + bad + [None, "", " \n"]
    rows = quality.score_documents(docs(spark, texts).repartition(3)).collect()
    kept = {r.id for r in rows if r.kept}
    assert len(rows) == len(texts) and len(kept & set(range(150))) >= 145 and len(kept - set(range(150))) <= 2
    assert all(r.row.doc_id == r.id and r.row.kept == "y" for r in rows) and all(r.score == 0 for r in rows if r.id >= len(texts) - 3)
    assert quality.score_documents(docs(spark, [])).count() == 0


def test_mixing(spark):
    rng = random.Random(12)
    rows = [(k, sentence(rng, rng.randint(1, 60)) if k % 50 else None, rng.choice(["en", "fr", None]),
             "big" if rng.random() < 0.4 else f"s{rng.randint(0, 5)}", 1) for k in range(900)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic int")
    got = mixing.mix(table, budget=0.5, rounds=25).toPandas()
    assert len(got) == 900 and got.probability.between(0, 1).all()
    total = got.n_tokens.sum()
    for m in mixing.MARGINS:
        have = got.groupby(m).n_tokens.sum().astype(float) ** mixing.TEMPERATURE
        want, is_ = have / have.sum() * total * 0.5, got.groupby(m).weight.sum()
        assert (abs(is_ - want) / want).max() < 0.1, m
    picked = set(got.id[got.sampled])
    assert abs(got.n_tokens[got.sampled].sum() / total - 0.5) < 0.1
    sample = mixing.sample(table, budget=0.5, rounds=25)
    assert {r.doc_id for r in sample.collect()} == picked and sample.columns == table.columns
    assert mixing.mix(table.where("false")).count() == 0 and mixing.sample(table.where("false")).count() == 0


def test_topics(spark):
    texts = ["The match was lost; the TEAM has a new player.", "A new player for the team.", "The bank has money, the market a price, one team.",
             "The the of.", None, "Spieler, Trainer und Preis"]
    got = {r.id: r.topic for r in mixing.keyed(docs(spark, texts)).collect()}
    assert got == {0: "sport", 1: "sport", 2: "economy", 3: mixing.OTHER, 4: mixing.OTHER, 5: "sport"}
    words = [w for ws in mixing.KEYWORDS.values() for w in ws.split()]
    assert len(words) == len(set(words)) and all(w == w.lower() for w in words)


def test_given_topics(spark):
    rng = random.Random(14)
    rows = [(k, sentence(rng, rng.randint(1, 40)), "en", "s0", rng.choice(["x", "x", "x", "y", None])) for k in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic string")
    got = mixing.mix(table, budget=0.5).toPandas()
    assert dict(zip(got.id, got.topic, strict=True)) == {r[0]: r[4] or mixing.NONE for r in rows}
    have = got.groupby("topic").n_tokens.sum().astype(float) ** mixing.TEMPERATURE
    want = have / have.sum() * got.n_tokens.sum() * 0.5
    assert (abs(got.groupby("topic").weight.sum() - want) / want).max() < 0.01
    assert {r.doc_id for r in mixing.sample(table, budget=0.5).collect()} == set(got.id[got.sampled])
