"""Token ids as binary files: one zstandard dictionary for all, one frame per document, an index for single documents.

A written folder holds three tables of Spark's own file format:

* ``dictionary``: one row, the shared dictionary and its hash;
* ``blocks``: rows of about 4 MB, each a binary block of whole documents in ascending id order. A block is a header
  (magic, dictionary hash, number of documents), then the arrays of ids, of starts within the shard, of token counts and
  of frame ends, then the frames;
* ``shards``: for each shard the number of its ids and of the ids of all shards before it.

The arrays are the offset index: a document is read by its block's header and its own frame alone.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressmill.llm.bpe import byte_letters, text_slices
from pressmill.llm.common import pieces

MAGIC = b"TOKZ0001"
#: documents and ids of each that the dictionary is trained on
SAMPLE_DOCUMENTS, SAMPLE_IDS = 2000, 2048
DICTIONARY_BYTES = 64 << 10
BLOCK_BYTES = 4 << 20
#: rows of a shard, about
SHARD_ROWS = 20_000
LEVEL = 3
#: chunks and pieces of text kept by a worker; beyond it, the store starts afresh
CACHED_CHUNKS = 300_000
#: characters, and rows, worked on at a time
SLICE, SLICE_ROWS = 1 << 20, 1000

# the rules of the public vocabulary, and what they come to in texts of the Latin ranges up to U+017F
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PUBLIC_RULES = (
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾"
LATIN_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")
# the lower case of U+0130 has a mark that is no letter
BEYOND_LATIN = re.compile("[^\t\n\r\x20-\x7e\xa1-\u012f\u0131-\u017f]")
_BYTES = {b: c for c, b in byte_letters().items()}

_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """The library's tokenizer of one vocabulary file, as text, with what it has encoded.

    The vocabulary drops white space and none of its rules reaches across it, so a text is encoded by its chunks between
    ASCII white space, each distinct chunk once. Latin texts under the public rules are cut into the pieces that the rules
    lead to, and the library's model alone merges each distinct piece.
    """

    def __init__(self, spec: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        data = json.loads(spec)
        self.public = (data["normalizer"], data["pre_tokenizer"]) == PUBLIC_RULES
        self.added = [t["content"] for t in data["added_tokens"]]
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        #: ids of pieces (text) and of chunks (bytes)
        self.known: dict[str | bytes, bytes] = {}

    def parts(self, text: str) -> list[str] | list[bytes]:
        """The pieces of a Latin text, else the chunks."""
        if self.public and not BEYOND_LATIN.search(text) and not any(t in text for t in self.added):
            return LATIN_PIECES.findall(text.lower())
        return text.encode().split()

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        """Ids of whole texts with ``end_id`` after each, as little-endian unsigned 32-bit integers."""
        if len(self.known) > CACHED_CHUNKS:
            self.known.clear()
        split = [self.parts(t) for t in texts]
        new = set().union(*split) - self.known.keys()
        chunks = [c for c in new if isinstance(c, bytes)]
        for a in range(0, len(chunks), 1000):
            part = chunks[a:a + 1000]
            for chunk, got in zip(part, self.tokenizer.encode_batch_fast([c.decode() for c in part], add_special_tokens=False),
                                  strict=True):
                self.known[chunk] = np.array(got.ids, "<u4").tobytes()
        for piece in new:
            if isinstance(piece, str):
                ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(_BYTES))]
                self.known[piece] = struct.pack(f"<{len(ids)}I", *ids)
        end = struct.pack("<I", end_id)
        return [b"".join(map(self.known.__getitem__, parts)) + end for parts in split]


def encoder(spec: str) -> Encoder:
    """One encoder for a worker process and vocabulary, kept between tasks."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def _encoded_slices(batches, spec, end_id: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches whose second column is the text, with the ids of their texts."""
    enc = encoder(spec.value)
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            rows = batch.slice(start, SLICE_ROWS)
            texts = [t or "" for t in rows.column(1).to_pylist()]
            for a, b in text_slices(texts, SLICE):
                yield rows.slice(a, b - a), enc.encode(texts[a:b], end_id)


def _encoded(docs: DataFrame, spec, end_id: int, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        for part, ids in _encoded_slices(batches, spec, end_id):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, ids binary")


def train_dictionary(docs: DataFrame, spec, end_id: int, id_col: str, text_col: str) -> bytes:
    """A dictionary from the first ids of a bounded sample of documents; empty if there is too little to train on."""
    import zstandard

    sample = (docs.where(F.col(id_col).isNotNull()).orderBy(F.xxhash64(id_col), id_col).limit(SAMPLE_DOCUMENTS)
              .select(id_col, F.substring(text_col, 1, 4 * SAMPLE_IDS).alias(text_col)))
    rows = _encoded(sample, spec, end_id, id_col, text_col).select(F.substring("ids", 1, 4 * SAMPLE_IDS)).collect()
    samples = [bytes(r[0]) for r in rows if len(r[0]) >= 8]
    if sum(map(len, samples)) < 100 * 1024 or len(samples) < 20:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 10), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _pack(digest: bytes, rows: list[tuple[int, int, int, bytes]]) -> bytes:
    ids, starts, counts, frames = zip(*rows, strict=True)
    return b"".join([MAGIC, digest, struct.pack("<Q", len(rows)), np.array(ids, "<i8").tobytes(),
                     np.array(starts, "<u8").tobytes(), np.array(counts, "<u8").tobytes(),
                     np.cumsum([len(f) for f in frames]).astype("<u8").tobytes(), *frames])


def unpack(block: bytes, digest: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[memoryview]]:
    """Ids, starts, token counts and frames of a block; raises if it was written with another dictionary."""
    if block[:8] != MAGIC or block[8:40] != digest:
        raise ValueError("not a block of this dictionary")
    (n,), at = struct.unpack_from("<Q", block, 40), 48
    ids, starts, counts, ends = (np.frombuffer(block, t, n, at + 8 * n * k) for k, t in enumerate(("<i8", "<u8", "<u8", "<u8")))
    body = memoryview(block)[at + 32 * n:]
    first = np.concatenate([[0], ends[:-1].astype(np.int64)]) if n else []
    return ids, starts, counts, [body[a:b] for a, b in zip(first, ends, strict=True)]


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 1, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Encode every whole text, add ``end_id`` and write the folder ``path``, in ascending id order.

    ``vocabulary`` is the path of a vocabulary file that drops white space, read on the driver. A null text counts as
    empty. Rows of equal id all stay, next to each other; rows with a null id come first, as id -2**63. An empty table
    gives a folder without blocks. Shards are id ranges, so no task sees more than its range.
    """
    import zstandard

    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-2 ** 63)).alias("id"), F.col(text_col).alias("text"))
    dictionary = train_dictionary(keyed, spec, end_id, "id", "text")
    digest = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(digest, dictionary)], "hash binary, dictionary binary").write.parquet(f"{path}/dictionary")
    n = pieces(keyed.count(), SHARD_ROWS)
    bounds = sorted(set(keyed.approxQuantile("id", [k / n for k in range(1, n)], 0.1 / n))) if n > 1 else []
    shard = F.lit(0)
    if bounds:
        # the number of bounds at or below the id
        marks = F.split(F.lit(",".join(str(int(b)) for b in bounds)), ",").cast("array<bigint>")
        shard = F.size(F.filter(marks, lambda b: b <= F.col("id")))

    def compress(batches):
        packer = _compressor(zstandard, dictionary)
        for part, ids in _encoded_slices(batches, spec, end_id):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([packer.compress(x) for x in ids], pa.binary()), part.column(2)], ["id", "n", "frame", "shard"])

    def blocks(batches):
        shard_now, start, number, held, rows = None, 0, 0, 0, []

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([shard_now], pa.int32()), pa.array([number], pa.int32()), pa.array([rows[0][0]], pa.int64()),
                 pa.array([rows[-1][0]], pa.int64()), pa.array([sum(r[2] for r in rows)], pa.int64()),
                 pa.array([_pack(digest, rows)], pa.binary())], ["shard", "number", "first_id", "last_id", "n_tokens", "block"])

        for batch in batches:
            for s, i, n_ids, frame in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if rows and (s != shard_now or held >= BLOCK_BYTES):
                    yield out()
                    rows, held, number = [], 0, number + 1
                if s != shard_now:
                    shard_now, start, number = s, 0, 0
                rows.append((i, start, n_ids, frame))
                start += n_ids
                held += len(frame)
        if rows:
            yield out()

    # ids are compressed where they are made: they are larger than the texts
    frames = keyed.withColumn("shard", shard).mapInArrow(compress, "id long, n long, frame binary, shard int")
    # ties of an id are ordered by their frames, so that a lost task is written again alike
    (frames.repartition(n, "shard").sortWithinPartitions("shard", "id", "frame").select("shard", "id", "n", "frame")
     .mapInArrow(blocks, "shard int, number int, first_id long, last_id long, n_tokens long, block binary")
     .write.option("compression", "none").parquet(f"{path}/blocks"))
    totals = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"))
    # one row per shard of about SHARD_ROWS documents
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{path}/shards")


def _compressor(zstandard, dictionary: bytes):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_dict_id=False)


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """(id, start, n_tokens, ids binary) of all documents, or of those named; only their blocks and frames are opened."""
    import zstandard

    row = spark.read.parquet(f"{path}/dictionary").first()
    digest, dictionary = bytes(row["hash"]), bytes(row["dictionary"])
    found = spark.read.parquet(f"{path}/blocks")
    asked = None if ids is None else {int(i) for i in ids}
    if asked is not None:
        # the blocks' id ranges are columns, so blocks of other ranges are not read
        hit = F.lit(False)
        for i in sorted(asked):
            hit = hit | F.lit(i).between(F.col("first_id"), F.col("last_id"))
        found = found.where(hit)
    joined = found.join(spark.read.parquet(f"{path}/shards").select("shard", "base"), "shard").select("base", "block")

    def run(batches: Iterator[pa.RecordBatch]):
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        opener = zstandard.ZstdDecompressor(dict_data=shared)
        for batch in batches:
            for base, block in zip(batch.column(0), batch.column(1), strict=True):
                doc, start, count, frames = unpack(block.as_py(), digest)
                keep = [k for k in range(len(doc)) if asked is None or int(doc[k]) in asked]
                for a in range(0, len(keep), 500):
                    part = keep[a:a + 500]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc[part], pa.int64()), pa.array(start[part].astype(np.int64) + base.as_py(), pa.int64()),
                         pa.array(count[part].astype(np.int64), pa.int64()),
                         pa.array([opener.decompress(frames[k]) for k in part], pa.binary())],
                        ["id", "start", "n_tokens", "ids"])

    return joined.mapInArrow(run, "id long, start long, n_tokens long, ids binary")


def crc32_column(df: DataFrame, ids_col: str = "ids") -> DataFrame:
    """Adds ids_crc32, the unsigned crc32 of the ids' bytes, a function of Spark's own."""
    return df.withColumn("ids_crc32", F.crc32(ids_col))


