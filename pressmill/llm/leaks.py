"""Benchmark decontamination: passages of benchmark items inside documents.

A window is WINDOW consecutive words of an item; an item of fewer words, but not none, is one window. The windows of the
benchmark are broadcast as a hash set; each task scans the words of its own documents and holds every hit against the words
themselves. Documents are never shuffled.

The set has a bound: PART_WORDS words of items are broadcast at a time. A larger benchmark is cut into several parts; each
part is a further scan, which adds its hits to those found before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.llm.common import pieces
from pressmill.llm.wordspans import finished, word_bytes, words_of
from pressmill.session import cut_lineage

WINDOW = 10
#: words of items that one broadcast holds at most
PART_WORDS = 1 << 20
#: a long item is cut into segments of about so many words, which overlap by a window less one word
SEGMENT_WORDS = 4096
KIND = word_bytes(digits=True)


# -- the benchmark ---------------------------------------------------------------------------------------------------

def segments(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item string, size, n, words binary): each item's words, joined by blanks, in segments; ``size`` is the length of its
    windows. An item without words, or without text, has no row."""
    def run(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            for part in words_of(batch.column(1), KIND):
                ends = np.searchsorted(part.text, np.arange(part.rows + 1))
                word = part.distinct.to_pylist()
                rows = []
                for r in range(part.rows):
                    code = part.code[ends[r]:ends[r + 1]]
                    for at in range(0, max(1, len(code) - WINDOW + 1) if len(code) else 0, SEGMENT_WORDS):
                        piece = code[at:at + SEGMENT_WORDS + WINDOW - 1]
                        rows.append((names[part.first_row + r], min(WINDOW, len(code)), len(piece), b" ".join(word[c] for c in piece)))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int32(), pa.binary()), strict=True)],
                        ["item", "size", "n", "words"])

    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "item string, size int, n int, words binary")


def parts(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", part_words: int = PART_WORDS) -> list[DataFrame]:
    """The segments of a benchmark in parts of ``part_words`` words at most (or of one segment)."""
    rows = cut_lineage(segments(benchmark, id_col, text_col).withColumn("no", F.monotonically_increasing_id()))
    total = rows.agg(F.sum("n")).first()[0] or 0
    n = pieces(total, part_words / 2) if total > part_words else 1
    while True:
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("no"), F.lit(n)))
        sizes = dealt.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
        if n == 1 or sizes.where((F.col("n") > part_words) & (F.col("rows") > 1)).isEmpty():
            return [dealt.where(F.col("part") == k).drop("part", "no") for k in range(n)]
        n *= 2


@dataclass
class Windows:
    """The windows of one part of a benchmark, for lookups.

    ``word`` are its different words, ``stream`` their numbers in order of the segments. For each length of windows there are
    the sorted hashes of the different windows, the place of each in the stream, and the class of the items that hold it;
    ``items`` lists the items of a class.
    """

    word: pa.Array
    stream: np.ndarray
    seed: int
    by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    items: list[list[str]]


def _window_hashes(code: np.ndarray, at: np.ndarray, size: int, seed: int) -> np.ndarray:
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total = finished(total + code[at + k].astype(np.uint64) + np.uint64(seed * 64 + 1))
    return total


def window_set(rows: list[tuple[str | None, int, int, bytes]]) -> Windows:
    """``rows`` (item, size, n, words): the segments of one part."""
    word: dict[bytes, int] = {}
    stream, starts, sizes, owners = [], [], [], []
    at = 0
    for owner, (_, size, n, joined) in enumerate(rows):
        stream.extend(word.setdefault(w, len(word)) for w in joined.split(b" "))
        starts.append(np.arange(at, at + n - size + 1))
        sizes.append(np.full(n - size + 1, size))
        owners.append(np.full(n - size + 1, owner))
        at += n
    code = np.array(stream, np.int64)
    start, size_of, owner = (np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64) for x in (starts, sizes, owners))
    seed = 0
    while True:  # another seed if two different windows share a hash
        by_size, classes, known, fine = {}, {}, [], True
        for size in np.unique(size_of):
            here = np.flatnonzero(size_of == size)
            h = _window_hashes(code, start[here], size, seed)
            order = np.argsort(h, kind="stable")
            here, h = here[order], h[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            place = start[here[first]]
            same = np.repeat(place, np.diff(np.append(first, len(h))))
            if any((code[start[here] + k] != code[same + k]).any() for k in range(size)):
                fine = False
                break
            kind = np.empty(len(first), np.int64)
            for j, group in enumerate(np.split(owner[here], first[1:])):
                names = tuple(sorted({rows[o][0] for o in group if rows[o][0] is not None}))
                kind[j] = classes.setdefault(names, len(classes))
                if kind[j] == len(known):
                    known.append(list(names))
            by_size[int(size)] = h[first], place, kind
        if fine:
            return Windows(pa.array(list(word), pa.binary()), code, seed, by_size, known)
        seed += 1


# -- documents -------------------------------------------------------------------------------------------------------

def _ranges(flag: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of set flags; runs end at the bounds."""
    cut = np.zeros(len(flag) + 1, bool)
    cut[bounds] = True
    begins = flag & np.concatenate([[True], ~flag[:-1]]) | flag & cut[:-1]
    ends = flag & np.concatenate([~flag[1:], [True]]) | flag & cut[1:]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _scan(part, found: Windows, before: list[list[dict]], items_before: list[list[str]]):
    """Hit words, as ranges, and items of each text of a chunk; ``before`` are those of earlier scans."""
    number = pc.index_in(part.distinct.cast(pa.binary()), value_set=found.word).fill_null(-1).to_numpy(zero_copy_only=False)
    code = number[part.code].astype(np.int64) if len(part.code) else np.empty(0, np.int64)
    n = len(code)
    unknown = np.concatenate([[0], np.cumsum(code < 0)])
    change = np.zeros(n + 1, np.int64)
    who, kinds = [], []
    for size, (known, place, kind) in found.by_size.items():
        if n < size:
            continue
        at = np.flatnonzero((unknown[size:] == unknown[:n - size + 1]) & (part.text[size - 1:] == part.text[:n - size + 1]))
        h = _window_hashes(code, at, size, found.seed)
        j = np.minimum(np.searchsorted(known, h), len(known) - 1)
        hit = known[j] == h
        at, j = at[hit], j[hit]
        for k in range(size):  # equal hashes are held against the words
            same = code[at + k] == found.stream[place[j] + k]
            at, j = at[same], j[same]
        np.add.at(change, at, 1)
        np.add.at(change, at + size, -1)
        who.append(part.text[at])
        kinds.append(kind[j])
    flag = np.cumsum(change)[:n] > 0
    ends = np.searchsorted(part.text, np.arange(part.rows + 1))
    for r in np.flatnonzero([bool(b) for b in before]):
        for span in before[r]:
            flag[ends[r] + span["first"]:ends[r] + span["last"]] = True
    pairs = np.unique(np.stack([np.concatenate([np.empty(0, np.int64), *who]), np.concatenate([np.empty(0, np.int64), *kinds])]), axis=1)
    items = [list(x or []) for x in items_before]
    for r, lo, hi in zip(*_groups(pairs[0]), strict=True):
        names = set(items[r]).union(*(found.items[k] for k in pairs[1, lo:hi]))
        items[r] = sorted(names)
    return ends, flag, items


def _groups(sorted_ids: np.ndarray):
    """Each different id, and where its run begins and ends."""
    ids, first, counts = np.unique(sorted_ids, return_index=True, return_counts=True)
    return ids.tolist(), first.tolist(), (first + counts).tolist()


def _lists(begin: np.ndarray, end: np.ndarray, row: np.ndarray, base: np.ndarray, rows: int) -> pa.Array:
    """Ranges as one list per row, counted from the row's base."""
    counts = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    flat = pa.StructArray.from_arrays([pa.array(begin - base[row], pa.int64()), pa.array(end - base[row], pa.int64())], ["first", "last"])
    return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), flat)


def _pass(docs: DataFrame, segment_rows: DataFrame) -> DataFrame:
    """One scan of (row, text, found columns) against one part."""
    # a part is bounded by PART_WORDS
    got = [(r.item, r.size, r.n, bytes(r.words)) for r in segment_rows.collect()]
    shared = docs.sparkSession.sparkContext.broadcast(window_set(got))

    def run(batches):
        windows = shared.value
        for batch in batches:
            for part in words_of(batch.column(1), KIND):
                here = batch.slice(part.first_row, part.rows)
                ends, flag, items = _scan(part, windows, here.column(3).to_pylist(), here.column(5).to_pylist())
                begin, end = _ranges(flag, ends)
                row = part.text[begin]
                spans = _lists(part.start[begin], part.end[end - 1], row, part.offsets, part.rows)
                yield pa.RecordBatch.from_arrays(
                    [here.column(0), here.column(1), pa.array(np.diff(ends), pa.int64()), _lists(begin, end, row, ends, part.rows),
                     spans, pa.array(items, pa.list_(pa.string()))], batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               part_words: int = PART_WORDS) -> DataFrame:
    """(row struct, n_words, hits, spans, items) for every row of ``docs``.

    ``row`` holds the given columns; ``hits`` are ranges of hit words and ``spans`` the bytes from the first to the last word
    of each (of the text in UTF-8; the end is excluded); ``items`` are the ids, as text, of the items that have a window in the
    text, in order.

    Null texts have no words. Windows of an item without an id hit, but name no item; items that share an id are one name.
    Repeated rows each have their result. Texts are read whole, whatever their length. No benchmark, or one without words,
    hits nothing.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"),
                       *(F.expr(f"cast(array() as {t})").alias(c) for c, t in (
                           ("hits", "array<struct<first:bigint,last:bigint>>"), ("spans", "array<struct<first:bigint,last:bigint>>"),
                           ("items", "array<string>"))))
    every = parts(benchmark, item_col, item_text_col, part_words)
    for k, part in enumerate(every):
        rows = _pass(rows, part)
        if k + 1 < len(every):
            rows = cut_lineage(rows)  # a scan at a time, so that a worker holds one part
    return rows.drop("text")


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", text_col: str = "text", **more) -> DataFrame:
    """``docs`` without what ``find_leaks`` finds: the bytes of its spans, or whole documents (``remove``: 'spans', 'documents').

    Columns stay as given; only the text changes, and only where it is hit.
    """
    if remove not in ("spans", "documents"):
        raise ValueError("remove spans or documents")
    found = find_leaks(docs, benchmark, text_col, **more)
    if remove == "documents":
        return found.where(F.size("hits") == 0).select("row.*")

    def cut(batches):
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw, out, at = text.encode(), [], 0
                for span in spans:
                    out.append(raw[at:span["first"]])
                    at = span["last"]
                texts.append(b"".join([*out, raw[at:]]).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "cut"])

    text = F.col("row")[text_col]
    hit = found.where(F.size("hits") > 0).select("row", text.cast("string").alias("text"), "spans").mapInArrow(
        cut, T.StructType([found.schema["row"], T.StructField("cut", T.StringType())]))
    columns = [F.col("cut").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    return found.where(F.size("hits") == 0).select("row.*").unionByName(hit.select(*columns))
