"""Removal of repeated passages: strings of 100 bytes that also start earlier, found by hashes of suffixes in buckets.

Suffixes are compared to a fixed depth. A difference cover gives sample positions so that any two equal strings of that
depth hold a sample at the same offset; the samples are hashed first, with their following bytes, and those that occur more
than once tell which suffixes can be equal to another at all. Only these are dealt out, one set of buckets at a time: equal
suffixes meet in a bucket and are ordered by document and position. No suffix is ordered by its bytes and no sample has a
rank: the result asks only which strings are equal, and that is decided on 64-bit hashes. A document sends each string
twice at most, so a long run of one byte or of a short pattern is a few entries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import dealt, mixed, pieces, written

DEPTH = 100
#: period of the difference cover; the orbit of 1 under doubling is a perfect difference set for it
PERIOD = 73
COVER = sorted({pow(2, k, PERIOD) for k in range(9)})
#: bytes after a sample that its name stands for
NAMED = DEPTH - PERIOD + 1
#: suffix buckets are gone through in so many turns
TURNS = 2
#: suffixes of one bucket, about
ENTRIES = 3_000_000
#: bytes of a text hashed at a time
CHUNK = 1 << 22
BASE = 0x9E3779B97F4A7C15

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, modulo 2 ** 64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = []
        for factor in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, factor, np.uint64)
            p[0] = 1
            have.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[base] = tuple(have)
    return _POWERS[base]


class Names:
    """Numbers for the bytes from given positions of a text (ascending), equal for equal bytes.

    Only the part of the text that the positions span is gone over, CHUNK bytes at a time.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, length: int):
        self.parts = []
        low = int(at[0]) if len(at) else 0
        while len(at) and low <= at[-1]:
            a, b = np.searchsorted(at, [low, low + CHUNK])
            if a < b:
                part = data[low:min(low + CHUNK, int(at[b - 1])) + length]
                power, inverse = _powers(BASE, len(part) + 1)
                total = np.zeros(len(part) + 1, np.uint64)
                np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[:len(part)], out=total[1:])
                self.parts.append((a, b, total, inverse, at[a:b] - low))
            low += CHUNK

    def of(self, length: int, only: np.ndarray | None = None, skip: int = 0) -> np.ndarray:
        """For ``length`` bytes after the first ``skip``, of the positions marked in ``only`` or of all."""
        out = [np.empty(0, np.uint64)]
        for a, b, total, inverse, here in self.parts:
            if only is not None:
                here = here[only[a:b]]
            here = here + skip
            out.append(mixed((total[here + length] - total[here]) * inverse[here]))
        return np.concatenate(out)


def cover_positions(n: int) -> np.ndarray:
    """Sample positions of a text of ``n`` bytes that have NAMED bytes from there on."""
    at = (np.arange(0, n, PERIOD)[:, None] + np.array(COVER)).ravel()
    return at[at + NAMED <= n]


def zones(flagged: np.ndarray, n: int) -> np.ndarray:
    """Starts of suffixes of full depth that hold a flagged sample at an offset below PERIOD."""
    mark = np.zeros(n + 1, np.int32)
    np.add.at(mark, np.maximum(0, flagged - PERIOD + 1), 1)
    np.add.at(mark, flagged + 1, -1)
    return np.flatnonzero(np.cumsum(mark)[:max(0, n - DEPTH + 1)] > 0)


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)


def _sample_entries(text: str, mine=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, name and deal of each sample of a text."""
    data = _bytes(text)
    at = cover_positions(len(data))
    key = Names(data, at, NAMED).of(NAMED)
    return at, key, mixed(key + np.uint64(1))


def _flagged(text: str, marks: bytes) -> np.ndarray:
    """Positions of the samples of a text that are marked, one bit each."""
    at = cover_positions(len(_bytes(text)))
    return at[np.unpackbits(np.frombuffer(marks, np.uint8), count=len(at)).astype(bool)]


def _suffix_entries(text: str, flagged: np.ndarray, mine=None) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Start, name and deal of each suffix that can be equal to another.

    The deal is a number for the whole string, made of its halves: strings that share only their start are dealt apart.
    Names are made for the suffixes whose deals ``mine`` picks, none without it.
    """
    data = _bytes(text)
    at = zones(flagged, len(data))
    numbers = Names(data, at, DEPTH)
    deal = mixed(numbers.of(DEPTH // 2) * np.uint64(3) + numbers.of(DEPTH // 2, skip=DEPTH // 2))
    return at, None if mine is None else numbers.of(DEPTH, mine(deal)), deal


def first_two(deal: np.ndarray) -> np.ndarray:
    """Marks the first two entries of each deal of a document; any further one is known to be equal to them."""
    order = np.argsort(deal, kind="stable")
    head = np.ones(len(deal), bool)
    head[1:] = deal[order[1:]] != deal[order[:-1]]
    second = np.zeros(len(deal), bool)
    second[1:] = head[:-1]
    sent = np.zeros(len(deal), bool)
    sent[order[head | second]] = True
    return sent


def _exchange(rows: DataFrame, entries_of, n: int, later_only: bool, turn: int = 0, turns: int = 1) -> DataFrame:
    """(id, bucket, bits): for each document's entries of a bucket that are sent (``first_two``), in order, whether the name
    occurs elsewhere or earlier.

    ``rows`` start with id; ``entries_of`` makes (at, name, deal) of a row's other columns. Only buckets of ``turn`` are dealt.
    """
    def send(batches):
        ids, keys, deals, held = [], [], [], 0

        def mine(deal):
            return deal % np.uint64(n) % np.uint64(turns) == turn

        def out():
            run = [len(k) for k in keys]
            bucket = (np.concatenate(deals) % np.uint64(n)).astype(np.int64)
            key, row = np.concatenate(keys), np.repeat(np.arange(len(keys), dtype=np.uint32), run)
            sent = []
            for b, (k, r) in dealt(bucket, n, [key, row]):
                doc, count = np.unique(np.frombuffer(r, np.uint32), return_counts=True)
                sent.append((b, np.array([ids[d] for d in doc], "<i8").tobytes(), count.astype("<u4").tobytes(), k))
            cols = list(zip(*sent, strict=True)) if sent else [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                              ["bucket", "ids", "counts", "names"])

        for batch in batches:
            for k in range(batch.num_rows):
                row = [c[k].as_py() for c in batch.columns]
                _, key, deal = entries_of(*row[1:], mine)
                if not len(key):
                    continue
                deal = deal[mine(deal)]
                sent = first_two(deal)
                ids.append(row[0])
                keys.append(key[sent])
                deals.append(deal[sent])
                held += len(keys[-1])
                if held >= ENTRIES // 2:
                    yield out()
                    ids, keys, deals, held = [], [], [], 0
        if ids:
            yield out()

    def meet(batches):
        now, held = None, []

        def out():
            ids, counts, key = (np.concatenate([np.frombuffer(h[k], t) for h in held]) for k, t in enumerate(("<i8", "<u4", "<u8")))
            # documents in order, each one's entries as they came
            order = np.argsort(ids, kind="stable")
            starts = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            take = np.concatenate([np.arange(starts[d], starts[d + 1]) for d in order])
            ids, counts, key = ids[order], counts[order], key[take]
            by = np.argsort(key, kind="stable")
            same = key[by[1:]] == key[by[:-1]]
            hit = np.zeros(len(key), bool)
            hit[by[1:][same]] = True
            if not later_only:
                hit[by[:-1][same]] = True
            ends = np.cumsum(counts, dtype=np.int64)
            before = np.concatenate([[0], np.cumsum(hit)])
            some = np.flatnonzero(before[ends] > before[ends - counts])
            for a in range(0, len(some), 5000):
                part = some[a:a + 5000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[part], pa.int64()), pa.array([now] * len(part), pa.int32()),
                     pa.array([np.packbits(hit[ends[d] - counts[d]:ends[d]]).tobytes() for d in part], pa.binary())],
                    ["id", "bucket", "bits"])

        for batch in batches:
            for b, *rest in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if b != now and held:
                    yield from out()
                    held = []
                now = b
                held.append(rest)
        if held:
            yield from out()

    sent = rows.mapInArrow(send, "bucket int, ids binary, counts binary, names binary")
    return sent.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, "id long, bucket int, bits binary")


def _hits(deal: np.ndarray, n: int, bits: list) -> np.ndarray:
    """Which entries of a document were hit, from the bits of its buckets; those that were not sent are."""
    sent = first_two(deal)
    bucket = (deal[sent] % np.uint64(n)).astype(np.int64)
    hit = np.zeros(len(bucket), bool)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(n + 1))
    for b, packed in bits:
        mine = order[ends[b]:ends[b + 1]]
        hit[mine] = np.unpackbits(np.frombuffer(packed, np.uint8), count=len(mine)).astype(bool)
    out = ~sent
    out[sent] = hit
    return out


def _by_document(bits: DataFrame) -> DataFrame:
    return bits.groupBy("id").agg(F.collect_list(F.struct("bucket", "bits")).alias("hits")).withColumnRenamed("id", "_id")


def removal(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Remaining bytes and the maximal removed runs, for the starts of strings that start earlier elsewhere."""
    mark = np.zeros(len(data) + 1, np.int32)
    mark[starts] += 1
    mark[starts + DEPTH] -= 1
    gone = np.cumsum(mark)[:-1] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
    return data[~gone], list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, spans array<struct<start,end>>, kept binary) of every row.

    Whole texts as UTF-8 bytes; a null text is empty. A byte goes if it lies in a string of DEPTH bytes that also starts
    in a document of smaller id, or earlier in its own; what remains may end within a character. ``spans`` are the maximal
    removed runs. Texts below DEPTH bytes stay whole, as do those of rows without an id. Ids are expected to be distinct;
    of rows with one id the smallest text is taken for all. An empty table gives no rows.

    A bucket holds the suffixes of a range of hashes, so a passage with many copies has its suffixes in all buckets. The
    entries of one string, two a document at most, are in one bucket and are held together.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = rows.where("id is not null")
    if not known.groupBy("id").count().where("count > 1").isEmpty():
        known = known.groupBy("id").agg(F.min("text").alias("text"))
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_samples = pieces(size * len(COVER) / PERIOD, ENTRIES, 12)
    flags = written(_by_document(_exchange(known, _sample_entries, n_samples, False)))

    def prepare(batches):
        """Texts with flagged samples, with a bit for each sample and how many suffixes the flagged ones leave."""
        for batch in batches:
            ids, flagged, count = [], [], []
            for text, hits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                at, _, deal = _sample_entries(text)
                marks = _hits(deal, n_samples, [(h["bucket"], h["bits"]) for h in hits])
                flagged.append(np.packbits(marks).tobytes())
                count.append(len(zones(at[marks], len(_bytes(text)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(flagged, pa.binary()), pa.array(count, pa.int64())],
                                             ["id", "text", "flagged", "n"])

    work = written(known.join(flags, F.col("id") == F.col("_id")).select("id", "text", "hits").mapInArrow(
        prepare, "id long, text string, flagged binary, n long").where("n > 0"))
    n_suffixes = pieces(work.agg(F.sum("n")).first()[0] or 0, ENTRIES, 12 * TURNS)
    suffixes = lambda text, flagged, mine=None: _suffix_entries(text, _flagged(text, flagged), mine)
    later = None
    for turn in range(TURNS):
        part = written(_exchange(work.select("id", "text", "flagged"), suffixes, n_suffixes, True, turn, TURNS))
        later = part if later is None else later.union(part)

    def cut(batches):
        for batch in batches:
            n, removed, spans, kept = [], [], [], []
            for text, flagged, hits in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                at, _, deal = suffixes(text, flagged)
                data = _bytes(text)
                rest, runs = removal(data, at[_hits(deal, n_suffixes, [(h["bucket"], h["bits"]) for h in hits])])
                n.append(len(data))
                removed.append(len(data) - len(rest))
                spans.append([{"start": a, "end": b} for a, b in runs])
                kept.append(rest.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                ["id", "n_bytes", "n_removed", "spans", "kept"])

    shape = "id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
    hits = written(_by_document(later))
    changed = work.join(hits, F.col("id") == F.col("_id")).select("id", "text", "flagged", "hits").mapInArrow(cut, shape)
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    same = rows.join(hits.select("_id"), F.col("id") == F.col("_id"), "left_anti").select(
        "id", F.length(data).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"), data.alias("kept"))
    # rows of one id share its result
    return same.union(rows.select(F.col("id").alias("_row")).join(changed, F.col("_row") == F.col("id")).drop("_row"))

