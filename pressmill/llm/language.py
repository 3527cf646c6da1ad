"""Language of a document by a mixture over languages, fitted to its letter n-grams.

A model holds, for each learned language, the share of each bucket of byte trigrams. A document's trigrams are explained
by a mixture: expectation-maximisation estimates the proportion of each language, and the set of languages grows one by one
as long as the penalised likelihood does.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: buckets of trigrams; the model has this many shares per language, whatever the corpus
BUCKETS = 1 << 16
#: learned languages at most; more is an error, not a cut
MOST_LANGUAGES = 500
ROUNDS = 15
#: for each further language, so many times the logarithm of the number of trigrams must be gained
PENALTY = 2.0
SMOOTHING = 0.5

_LETTER = re.compile(r"[^\W\d_]")


def _byte_classes() -> np.ndarray:
    """Lower-case letters and all bytes beyond ASCII stand for themselves, anything else for a space."""
    kind = np.full(256, 32, np.uint32)
    kind[97:123] = np.arange(97, 123)
    kind[128:] = np.arange(128, 256)
    return kind


CLASS = _byte_classes()


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their counts in the whole text: lower case, runs of other than letters as one space."""
    raw = CLASS[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != 32) | (raw[:-1] != 32)
    raw = raw[keep]
    if len(raw) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
    bucket = (code * np.uint32(2654435761)) >> np.uint32(16)
    if len(bucket) < BUCKETS // 4:
        return np.unique(bucket, return_counts=True)
    count = np.bincount(bucket, minlength=BUCKETS)
    at = np.flatnonzero(count)
    return at, count[at]


def has_letter(text: str | None) -> bool:
    return bool(text and _LETTER.search(text))


def learn(train: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and the logarithm of the share of each bucket (languages x buckets).

    Every text with a language counts. Each task adds up its own rows before the shuffle, so a language with most of the
    rows is no hot key. The result is bounded by MOST_LANGUAGES x BUCKETS. No rows give no languages.
    """
    def run(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if has_letter(text):
                    at, count = trigrams(text)
                    held.setdefault(lang, np.zeros(BUCKETS, np.int64))[at] += count
        for lang, count in held.items():
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(count[at], pa.int64())], ["lang", "bucket", "n"])

    rows = train.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counts.groupBy("lang").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n")).limit(
        MOST_LANGUAGES + 1).collect()
    if len(got) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    got.sort(key=lambda r: r["lang"])
    share = np.full((len(got), BUCKETS), SMOOTHING)
    for k, r in enumerate(got):
        share[k, r["at"]] += r["n"]
    return [r["lang"] for r in got], np.log(share / share.sum(1, keepdims=True)) if got else share


def mixture(log_share: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Proportions of the languages in one document (log_share: languages x its buckets)."""
    n_lang, total = len(log_share), count.sum()
    shift = log_share.max(0)
    like = np.exp(log_share - shift)
    alone = log_share @ count
    chosen = [int(alone.argmax())]
    fitted, value = np.ones(1), alone.max()
    while len(chosen) < n_lang:
        now = fitted @ like[chosen]
        # the language that would gain most from a small share is tried next
        gain = like @ (count / now)
        gain[chosen] = -np.inf
        more = int(gain.argmax())
        if gain[more] <= total:
            break
        trial = [*chosen, more]
        pi = np.append(fitted * 0.8, 0.2)
        part = like[trial]
        for _ in range(ROUNDS):
            got = pi[:, None] * part
            pi = got @ (count / got.sum(0)) / total
        new = float((np.log(pi @ part) + shift) @ count)
        if new - value <= PENALTY * np.log(total + 1):
            break
        chosen, fitted, value = trial, pi, new
    out = np.zeros(n_lang)
    out[chosen] = fitted
    return out


def predict(docs: DataFrame, languages: list[str], log_share: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
            keep: tuple[str | Column, ...] = ()) -> DataFrame:
    """(id, lang_pred, score, proportions map, columns of ``keep``) for every row; only the text is looked at.

    lang_pred is the language of the largest proportion, ties to the first in order; score is that proportion. A text that
    is null or without a letter, and any text if nothing was learned, has ``und``, 0 and no proportions. The model is
    sent to the tasks once; its size is bounded (see ``learn``).
    """
    model = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(log_share.T.astype(np.float32)))

    def run(batches):
        rows = model.value
        for batch in batches:
            pred, score, shares = [], [], []
            for text in batch.column(1).to_pylist():
                at, count = trigrams(text) if languages and has_letter(text) else ((), ())
                if len(at) == 0:
                    pred.append("und")
                    score.append(0.0)
                    shares.append([])
                    continue
                pi = mixture(rows[at].T.astype(np.float64), count.astype(np.float64))
                k = int(pi.argmax())
                pred.append(languages[k])
                score.append(float(min(1.0, max(0.0, pi[k]))))
                shares.append([(languages[j], float(pi[j])) for j in np.flatnonzero(pi)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array(shares, pa.map_(pa.string(), pa.float64())), *batch.columns[2:]],
                ["id", "lang_pred", "score", "proportions", *batch.schema.names[2:]])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *keep)
    extra = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, proportions map<string,double>{extra}")
