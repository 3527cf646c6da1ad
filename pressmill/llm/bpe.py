"""Byte-pair encoding over a prefix-sharing trie of distinct words.

The last token of the encoding of a prefix is a state of the prefix alone: it is the one token that ends there and fits
the last token of what is left of it. Walking the trie of distinct words depth first therefore gives the encodings of
all words, and a shared prefix is worked out once.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: words kept by a worker; beyond it, the store starts afresh
CACHED_WORDS = 1_000_000
#: bytes of text worked on at a time
SLICE = 2 << 20
#: tokens whose bytes are gathered at a time
DECODED = 1 << 16

# fixed values: the split pattern of the public byte-level vocabulary, for texts of the Latin ranges up to U+024F
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
LATIN_SPLIT = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+")
BEYOND_LATIN = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ]")


def byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable bytes themselves, others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class TrieEncoder:
    """Encoder and decoder for one byte-level vocabulary file, as text."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        data, letters = json.loads(spec), byte_letters()
        raw = {t: bytes(letters[c] for c in t) for t in data["model"]["vocab"]}
        self.bytes_of = {i: raw[t] for t, i in data["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.size = {i: len(b) for i, b in self.bytes_of.items()}
        placed = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.letters, self.lengths = np.frombuffer(b"".join(placed), np.uint8), np.array([len(b) for b in placed])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        vocab = data["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        self.merged = {(vocab[a], vocab[b]): (k, vocab[a + b]) for k, (a, b) in enumerate(pairs)}
        self.single = [0] * 256
        for t, i in vocab.items():
            if len(raw[t]) == 1:
                self.single[raw[t][0]] = i
        self.token = {raw[t]: i for t, i in vocab.items()}
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.begins = {b[:n] for b in self.token for n in range(len(b) + 1)}
        self.steps: dict[bytes, tuple[bytes, list[tuple[int, int]]]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.edges: dict[tuple[int, int], list] = {}
        self.known: dict[str, bytes] = {}
        self.split = re.compile(LATIN_SPLIT).findall
        self.library = Tokenizer.from_str(spec).pre_tokenizer

    def merge(self, word: bytes) -> tuple[list[int], tuple[int, int] | None]:
        """The plain rule: join the pair of lowest rank, leftmost first, as long as there is one; and the last pair."""
        ids, joined = [self.single[b] for b in word], None
        while len(ids) > 1:
            best = min((self.merged[p] + (k,) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.merged),
                       key=lambda x: (x[0], x[2]), default=None)
            if best is None:
                break
            k = best[2]
            joined = ids[k], ids[k + 1]
            ids[k:k + 2] = [best[1]]
        return ids, joined

    def edge(self, token: int, side: int) -> list[tuple[int, float, float]]:
        """The tokens that stand at one edge while ``token`` is put together: (token, rank it comes with, rank it goes with)."""
        key = (token, side)
        got = self.edges.get(key)
        if got is None:
            got, gone = [], float("inf")
            while True:
                pair = self.parts[token]
                rank = self.merged[pair][0] if pair else -1
                got.append((token, rank, gone))
                if not pair:
                    break
                token, gone = pair[side], rank
            self.edges[key] = got
        return got

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stand side by side in the encoding of their joint bytes.

        They do unless two edge tokens that are there at the same time have a merge that comes before either is used up
        in its own token; of two equal merges the left one comes first.
        """
        key = (left, right)
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            got = True
            for x, born, gone in self.edge(left, 1):
                for y, y_born, y_gone in self.edge(right, 0):
                    if born < y_gone and y_born < gone:
                        pair = self.merged.get((x, y))
                        if pair and pair[0] < gone and pair[0] <= y_gone:
                            got = False
            self.pairs[key] = got
        return got

    def made(self, token: bytes) -> bool:
        """Whether the bytes are a token that they lead to; any other token never comes out of an encoding."""
        i = self.token.get(token)
        if i is not None and i not in self.parts:
            ids, joined = self.merge(token)
            if ids != [i]:
                del self.token[token]
                return False
            self.parts[i] = joined
        return i is not None

    def step(self, end: bytes) -> tuple[bytes, list[tuple[int, int]]]:
        """The longest tail of ``end`` that some token begins with, and the tokens that are tails of it, longest first.

        A tail of a prefix that no token begins with can't take part in a token that ends later, so the tail found for a
        prefix and the next byte are all that the next step depends on.
        """
        if len(self.steps) > 500_000:
            self.steps.clear()
        tail = next(end[k:] for k in range(len(end) + 1) if end[k:] in self.begins)
        ends = [(len(tail) - k, self.token[tail[k:]]) for k in range(len(tail)) if self.made(tail[k:])]
        self.steps[end] = tail, ends
        return tail, ends

    def learn(self, new: set[str]) -> None:
        """Encode new words by a depth-first walk of their trie.

        Sorted order, of code points as of their bytes, is the depth-first order; ``last[d]`` is the state of the node at depth d on the current path, and
        ``tails[d]`` tells the tokens that can end there (see ``step``).
        """
        steps, pairs, known, size = self.steps, self.pairs, self.known, self.size
        last, tails, before = [0], [b""], b""
        for text in sorted(new):
            word = text.encode()
            n = min(len(before), len(word))
            # the bits from the first that differs on
            differ = (int.from_bytes(before[:n]) ^ int.from_bytes(word[:n])).bit_length()
            shared = n - (differ + 7 >> 3)
            del last[shared + 1:], tails[shared + 1:]
            tail = tails[shared]
            for d in range(shared + 1, len(word) + 1):
                end = tail + word[d - 1:d]
                tail, ends = steps.get(end) or self.step(end)
                tails.append(tail)
                for n, t in ends:
                    if n == d:
                        last.append(t)
                        break
                    got = pairs.get((last[d - n], t))
                    if got is None:
                        got = self.fits(last[d - n], t)
                    if got:
                        last.append(t)
                        break
            ids, d = [], len(word)
            while d:
                t = last[d]
                ids.append(t)
                d -= size[t]
            known[text] = struct.pack(f"<{len(ids)}I", *ids[::-1])
            before = word

    def split_words(self, text: str) -> list[str]:
        if not BEYOND_LATIN.search(text):
            return self.split(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts = []
        for text in texts:
            runs = self.special_split.split(text) if self.special_split and any(s in text for s in self.special) else [text]
            parts.append([np.array([self.special[r]], "<u4").tobytes() if k % 2 else self.split_words(r)
                          for k, r in enumerate(runs)])
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        asked = set()
        for runs in parts:
            for run in runs:
                if not isinstance(run, bytes):
                    asked.update(run)
        new = asked - self.known.keys()
        if new:
            self.learn(new)
        find = self.known.__getitem__
        return [b"".join(r if isinstance(r, bytes) else b"".join(map(find, r)) for r in runs) for runs in parts]

    def decode(self, ids: list[bytes]) -> list[str]:
        """Texts of several ids: the bytes of many tokens are gathered at a time from all tokens' bytes, one after another."""
        tokens, parts, ends = np.frombuffer(b"".join(ids), "<u4"), [], []
        held = 0
        for a in range(0, len(tokens), DECODED):
            part = tokens[a:a + DECODED]
            n = self.lengths[part]
            to = np.cumsum(n)
            parts.append(self.letters[np.arange(to[-1]) + np.repeat(self.starts[part] - (to - n), n)].tobytes())
            ends.append(to + held)
            held += int(to[-1])
        data, at = b"".join(parts), np.concatenate([[0], *ends])
        cuts = at[np.cumsum([0] + [len(x) // 4 for x in ids])].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)]


_ENCODERS: dict[str, TrieEncoder] = {}


def encoder(spec: str) -> TrieEncoder:
    """One encoder for a worker process and vocabulary, kept between tasks."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = TrieEncoder(spec)
    return _ENCODERS[key]


def text_slices(values: list, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``most`` characters together."""
    start = held = 0
    for k, v in enumerate(values):
        held += len(v or "")
        if held >= most or k == len(values) - 1:
            yield start, k + 1
            start, held = k + 1, 0


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids binary, n_tokens, decoded) of every text; ids are little-endian unsigned 32-bit integers.

    ``vocabulary`` is the path of a byte-level vocabulary file, read on the driver (a few MB, sent to each task once).
    A null text counts as empty and has no ids. Every row stands for itself: equal rows and null ids stay. Strings of
    the file's special tokens in a text become those tokens. Other columns of ``docs`` are left out.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        enc = encoder(spec.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in text_slices(texts):
                ids = enc.encode(texts[a:b])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(ids, pa.binary()),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(enc.decode(ids), pa.string())], ["id", "ids", "n_tokens", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, ids binary, n_tokens long, decoded string")

