"""Source divergence audit: how differently the sources of a language use its frequent terms.

A first pass counts in how many documents of a language each term stands, exactly, and keeps the frequent ones. The kept terms
are dealt into shards; a task builds a minimal perfect hash of each shard (levels of bit fields: a term that is alone at its
place sets the bit, the others go on to the next level; a term's slot is the number of bits before its own). The shards are
broadcast, and a second pass counts the kept terms of each (language, source) group in dense arrays by slot; the term stored
under a slot is held against the term looked up.

A broadcast has a bound: PASS_BYTES of terms. More kept terms are counted in several passes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.llm.wordspans import finished, hashes, word_bytes, words_of
from pressmill.session import cut_lineage

KIND = word_bytes(digits=False)
LEAST_DOCS = 30
SMOOTH = 5
UNIT = 1_000_000_000
TERM_RANKS = 50
#: bytes of terms (and eight more for each) of a shard, about, and of the shards that one broadcast holds
SHARD_BYTES = 1 << 20
PASS_BYTES = 48 << 20
#: bytes of counts that a task holds before it gives them on
DENSE_BYTES = 64 << 20
#: values (sources x terms) that one group of the comparison holds
CELLS = 1 << 16
#: places per term at each level of a perfect hash, and levels; terms still not alone after the last are listed
GAMMA = 1.5
LEVELS = 48


# -- terms of documents ----------------------------------------------------------------------------------------------

def _texts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    empty = F.lit("")
    return docs.select(*(F.coalesce(F.col(c).cast("string"), empty).alias(n) for c, n in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))))


def _codes(values: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def kept_terms(texts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, n_docs) of the terms that stand in ``least_docs`` documents of a language or more.

    Each task sends a term once per language and chunk of texts, so neither a frequent term nor a large language is a hot key.
    """
    def run(batches):
        for batch in batches:
            lang, names = _codes(batch.column(0))
            for part in words_of(batch.column(1), KIND):
                n = len(part.distinct)
                if not n:
                    continue
                once = np.unique(part.text * n + part.code)
                of = lang[part.first_row + once // n].astype(np.int64)
                pair, docs = np.unique(of * n + once % n, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()).take(pa.array(pair // n)), part.distinct.take(pa.array(pair % n)).cast(pa.string()),
                     pa.array(docs, pa.int64())], ["lang", "term", "n"])

    counts = texts.select("lang", "text").mapInArrow(run, "lang string, term string, n long")
    return counts.groupBy("lang", "term").agg(F.sum("n").alias("n_docs")).where(F.col("n_docs") >= least_docs)


# -- minimal perfect hashes ------------------------------------------------------------------------------------------

class PerfectHash:
    """Slots 0..n-1 of n different terms, and the terms by slot.

    Terms left after the last level, whose hashes never part, have the last slots and are found by their bytes.
    """

    def __init__(self, terms: pa.Array, bits: list[np.ndarray]):
        self.terms, self.bits, self.before = terms, bits, []
        total = 0
        for words in bits:
            counts = np.bitwise_count(words).astype(np.int64)
            self.before.append(total + np.cumsum(counts) - counts)
            total += int(counts.sum())
        self.listed = {terms[k].as_py(): k for k in range(total, len(terms))}

    @classmethod
    def build(cls, terms: pa.Array) -> PerfectHash:
        h = hashes(terms)
        left, bits, order = np.arange(len(h)), [], []
        while len(left) and len(bits) < LEVELS:
            size = max(64, -(-int(GAMMA * len(left)) // 64) * 64)
            place = cls._places(h[left], len(bits), size)
            alone = np.bincount(place, minlength=size)[place] == 1
            field = np.zeros(size, bool)
            field[place[alone]] = True
            bits.append(np.packbits(field, bitorder="little").view("<u8"))
            order.append(left[alone][np.argsort(place[alone])])
            left = left[~alone]
        return cls(terms.take(pa.array(np.concatenate([np.empty(0, np.int64), *order, left]))), bits)

    @staticmethod
    def _places(h: np.ndarray, level: int, size: int) -> np.ndarray:
        return (finished(h + np.uint64(0x632BE59BD9B4E019 * (level + 1) % 2 ** 64)) % np.uint64(size)).astype(np.int64)

    def slots(self, terms: pa.Array, h: np.ndarray) -> np.ndarray:
        """Slot of each term, -1 for one that has none; ``h`` are the terms' hashes."""
        slot = np.full(len(h), -1, np.int64)
        open_ = np.arange(len(h))
        for level, (words, before) in enumerate(zip(self.bits, self.before, strict=True)):
            if not len(open_):
                break
            place = self._places(h[open_], level, 64 * len(words))
            word, bit = words[place >> 6], (place & 63).astype(np.uint64)
            found = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            slot[open_[found]] = before[place[found] >> 6] + below[found]
            open_ = open_[~found]
        hit = np.flatnonzero(slot >= 0)
        same = pc.equal(self.terms.take(pa.array(slot[hit])), terms.take(pa.array(hit))).to_numpy(zero_copy_only=False)
        slot[hit[~same]] = -1
        if self.listed:
            for k in open_.tolist():
                slot[k] = self.listed.get(terms[k].as_py(), -1)
        return slot


def _shard_of(h: np.ndarray, shards: int | np.ndarray) -> np.ndarray:
    return (finished(h ^ np.uint64(0xA0761D6478BD642F)) % np.asarray(shards, np.uint64)).astype(np.int64)


def shards_of(kept: DataFrame) -> DataFrame:
    """(lang, shard, shards, size, terms): the terms of each shard, written out; ``size`` in bytes."""
    size = F.sum(F.octet_length("term") + 8)
    counts = kept.groupBy("lang").agg(F.ceil(size / SHARD_BYTES).cast("long").alias("shards"))
    dealt = kept.join(counts, "lang").select("lang", F.lit(0).cast("long").alias("shard"), "shards", "term")

    def deal(batches):
        for batch in batches:
            shards = batch.column(2).to_numpy()
            at = _shard_of(hashes(batch.column(3).cast(pa.large_binary())), shards)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at), batch.column(2), batch.column(3)], ["lang", "shard", "shards", "term"])

    rows = dealt.mapInArrow(deal, "lang string, shard long, shards long, term string")
    # a shard is of bounded size, whatever the number of terms
    return cut_lineage(rows.groupBy("lang", "shard", "shards").agg(
        size.alias("size"), F.sort_array(F.collect_list("term")).alias("terms")))


def hashed(shards: DataFrame) -> DataFrame:
    """(lang, shard, shards, size, terms, bits): the perfect hash of each shard, built in a task of its own; terms by slot."""
    def run(batches):
        for batch in batches:
            made = [PerfectHash.build(terms.values.cast(pa.large_binary())) for terms in batch.column(4)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([m.terms.cast(pa.string()).to_pylist() for m in made], pa.list_(pa.string())),
                 pa.array([[words.tobytes() for words in m.bits] for m in made], pa.list_(pa.binary()))],
                ["lang", "shard", "shards", "size", "terms", "bits"])

    return cut_lineage(shards.mapInArrow(run, "lang string, shard long, shards long, size long, terms array<string>, bits array<binary>"))


def _passes(built: DataFrame, pass_bytes: int) -> list[list[tuple[str, int]]]:
    """Shards in lots of ``pass_bytes`` at most (or of one shard)."""
    lots, room = [], 0
    # one short row per shard of about SHARD_BYTES
    for r in built.select("lang", "shard", "size").orderBy("lang", "shard").collect():
        if not lots or r["size"] > room:
            lots.append([])
            room = pass_bytes
        lots[-1].append((r["lang"], r["shard"]))
        room -= r["size"]
    return lots


# -- counts ----------------------------------------------------------------------------------------------------------

def recount(texts: DataFrame, built: DataFrame, lot: list[tuple[str, int]]) -> DataFrame:
    """(lang, source, term, n): occurrences of the terms of one lot of shards, as each task adds them up."""
    spark = texts.sparkSession
    named = spark.createDataFrame(lot, "lang string, shard long")
    lot_rows = built.join(F.broadcast(named), ["lang", "shard"]).toArrow()  # a lot is bounded by PASS_BYTES
    shared = spark.sparkContext.broadcast([
        (r["lang"], r["shard"], r["shards"], pa.array(terms.as_py(), pa.string()), r["bits"]) for r, terms in zip(
            lot_rows.drop_columns(["terms"]).to_pylist(), lot_rows.column("terms"), strict=True)])

    def run(batches):
        tables: dict[str, dict[int, tuple[PerfectHash, int]]] = {}
        width: dict[str, int] = {}
        shards: dict[str, int] = {}
        for lang, shard, n, terms, bits in shared.value:
            table = PerfectHash(terms.cast(pa.large_binary()), [np.frombuffer(b, "<u8") for b in bits])
            tables.setdefault(lang, {})[shard] = table, width.get(lang, 0)
            width[lang] = width.get(lang, 0) + len(terms)
            shards[lang] = n
        dense: dict[tuple[str, str], np.ndarray] = {}

        def given():
            for (lang, source), count in dense.items():
                for table, base in tables[lang].values():
                    own = count[base:base + len(table.terms)]
                    at = np.flatnonzero(own)
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(at), pa.string()), pa.array([source] * len(at), pa.string()),
                             table.terms.take(pa.array(at)).cast(pa.string()), pa.array(own[at])], ["lang", "source", "term", "n"])
            dense.clear()

        for batch in batches:
            lang, langs = _codes(batch.column(0))
            source, sources = _codes(batch.column(1))
            for part in words_of(batch.column(2), KIND):
                n = len(part.distinct)
                if not n:
                    continue
                row = part.first_row + part.text
                group = lang[row].astype(np.int64) * len(sources) + source[row]
                pair, count = np.unique(group * n + part.code, return_counts=True)
                h = hashes(part.distinct)
                for k, name in enumerate(langs):
                    if name not in tables:
                        continue
                    lo, hi = np.searchsorted(pair, [k * len(sources) * n, (k + 1) * len(sources) * n])
                    code = np.unique(pair[lo:hi] % n)
                    slot_of = np.full(n, -1, np.int64)
                    shard = _shard_of(h[code], shards[name])
                    for s, (table, base) in tables[name].items():
                        here = code[shard == s]
                        if len(here):
                            found = table.slots(part.distinct.take(pa.array(here)), h[here])
                            slot_of[here] = np.where(found >= 0, base + found, -1)
                    slot = slot_of[pair[lo:hi] % n]
                    where = pair[lo:hi] // n
                    for g in np.unique(where).tolist():
                        a, b = np.searchsorted(where, [g, g + 1])
                        use = slot[a:b] >= 0
                        if not use.any():
                            continue
                        key = name, sources[g % len(sources)]
                        if key not in dense:
                            if sum(d.nbytes for d in dense.values()) + 8 * width[name] > DENSE_BYTES:
                                yield from given()
                            dense[key] = np.zeros(width[name], np.int64)
                        dense[key][slot[a:b][use]] += count[lo + a:lo + b][use]
        yield from given()

    return texts.mapInArrow(run, "lang string, source string, term string, n long")


# -- the audit -------------------------------------------------------------------------------------------------------

def _share(count: str, total: str, kept: str) -> Column:
    """1 + floor(UNIT * (count + SMOOTH) / (total + SMOOTH * kept)) in whole numbers."""
    return F.expr(f"1 + (cast({UNIT} as decimal(10,0)) * cast({count} + {SMOOTH} as decimal(20,0))) "
                  f"div cast({total} + {SMOOTH} * {kept} as decimal(20,0))")


def _distances(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value), a < b: sum of the differences of two sources' shares over all kept terms.

    ``rows``: (lang, source, term, share) where a term occurs; ``groups``: (lang, source, base, kept), ``base`` the share of a term
    that does not occur. The terms of a language are dealt into pieces of CELLS values at most; each piece gets the base of every
    source, so its matrix is whole, and gives one row per pair of sources.
    """
    sized = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.max("kept").alias("kept"))
    per_piece = F.greatest(F.lit(1), F.floor(F.lit(CELLS) / F.col("sources")))
    pieces = sized.select("lang", F.greatest(F.lit(1), F.ceil(F.col("kept") / per_piece)).cast("long").alias("pieces"))
    bases = (groups.join(pieces, "lang").select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"), "source",
                                                F.lit(None).cast("string").alias("term"), F.col("base").alias("share")))
    terms = rows.join(pieces, "lang").select("lang", F.pmod(F.xxhash64("term"), F.col("pieces")).alias("piece"), "source", "term", "share")

    def run(key, table):
        source, names = _codes(table.column("source").combine_chunks())
        term = table.column("term").combine_chunks().dictionary_encode()
        share, given = table.column("share").to_numpy(), term.indices.is_valid().to_numpy(zero_copy_only=False)
        matrix = np.zeros((len(names), len(term.dictionary)), np.int64)
        base = np.zeros(len(names), np.int64)
        base[source[~given]] = share[~given]
        matrix[:] = base[:, None]
        matrix[source[given], term.indices.fill_null(0).to_numpy()[given]] = share[given]
        order = sorted(range(len(names)), key=lambda k: names[k].encode())
        found: list[list] = [[], [], []]
        for j, k in enumerate(order[:-1]):
            rest = order[j + 1:]
            found[0] += [names[k]] * len(rest)
            found[1] += [names[r] for r in rest]
            found[2] += np.abs(matrix[rest] - matrix[k]).sum(axis=1).tolist()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()] * len(found[0]), pa.string()), pa.array(found[0], pa.string()),
                                          pa.array(found[1], pa.string()), pa.array(found[2], pa.int64())], ["lang", "a", "b", "value"])

    def whole(key, table):
        return pa.Table.from_batches(list(run(key, table)))

    parts = bases.unionByName(terms).groupBy("lang", "piece").applyInArrow(whole, "lang string, a string, b string, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS,
          term_ranks: int = TERM_RANKS, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank): for each source of a language its distance to every other one (part ``pair``), and
    the terms it uses most beyond the language (part ``term``, ``term_ranks`` at most).

    Null texts, languages and sources count as empty ones; a source without terms takes part with smoothed shares. A language
    that keeps no term has pairs of value 0 and no terms. Ties of a value go by the item's bytes. Repeated rows are documents of
    their own. An empty table gives no rows.
    """
    texts = _texts(docs, text_col, lang_col, source_col)
    kept = cut_lineage(kept_terms(texts, least_docs))
    built = hashed(shards_of(kept))
    counts = None
    for lot in _passes(built, pass_bytes):
        part = recount(texts, built, lot)
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        counts = kept.select("lang", F.lit("").alias("source"), "term", F.lit(0).cast("long").alias("n")).limit(0)
    counts = cut_lineage(counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(known, "lang", "left").na.fill(0, ["total", "kept"])
    groups = cut_lineage(groups.withColumn("lang_total", F.sum("total").over(Window.partitionBy("lang")))
                         .withColumn("zero", F.lit(0)).withColumn("base", F.when(F.col("kept") > 0, _share("zero", "total", "kept")).otherwise(F.lit(0)))
                         .drop("zero"))
    # at most one row per source and term
    shared = counts.withColumn("lang_n", F.sum("n").over(Window.partitionBy("lang", "term"))).join(groups, ["lang", "source"]).select(
        "lang", "source", "term", _share("n", "total", "kept").alias("share"), _share("lang_n", "lang_total", "kept").alias("usual"))
    shared = cut_lineage(shared)
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (shared.where("share > usual").select("lang", "source", F.col("term").alias("item"), (F.col("share") - F.col("usual")).alias("value"))
             .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= term_ranks))
    either = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = (_distances(shared, groups).select("lang", "value", either.alias("e")).select("lang", "e.source", "e.item", "value")
             .withColumn("rank", F.row_number().over(ranked)))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(terms.withColumn("part", F.lit("term")).select(*columns))
