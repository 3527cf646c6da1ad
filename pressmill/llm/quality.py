"""Quality without hand labels: overlapping heuristic labellers, their accuracies, and a scorer trained on their verdicts.

Each labeller says good, bad or nothing about a text. Expectation-maximisation over the counts of vote patterns estimates
how often each labeller is right; the posterior of each pattern labels a sample, on which a linear scorer over hashed
features is trained. The scorer, not the votes, decides about every document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: rows the scorer is trained on at most, those of the smallest hash of the id
SAMPLE_ROWS = 8000
FEATURES = 1 << 15
EM_ROUNDS = 200
FIT_ROUNDS = 300
#: a document goes if its probability of being good is below
KEEP_FROM = 0.5
#: a labeller calls documents with its own fault bad at least so often
SEES = 0.7

# kinds of bytes
LOWER, UPPER, DIGIT, SPACE, NEWLINE, POINT, SYMBOL, MARK = range(8)


def _kinds() -> np.ndarray:
    kind = np.full(256, SYMBOL, np.uint32)
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = LOWER, UPPER, DIGIT, LOWER
    kind[[9, 11, 12, 13, 32]], kind[10] = SPACE, NEWLINE
    kind[[ord(c) for c in ".,;:'-\""]], kind[[ord(c) for c in "!?"]] = POINT, MARK
    return kind


KIND = _kinds()


def look(text: str) -> tuple[np.ndarray, dict[str, float]]:
    """The kind of each byte, and whole-text figures that the labellers look at; shares are of words unless said."""
    words = text.split()
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    raw = KIND[data]
    count = np.bincount(raw, minlength=8)
    n, letters = max(1, len(words)), int(count[LOWER] + count[UPPER])
    solid = max(1, len(raw) - int(count[SPACE] + count[NEWLINE]))
    odd = raw >= POINT
    lines = [x for x in text.split("\n") if x]
    return raw, {
        "words": len(words),
        "distinct": len(set(words)) / n ** 0.85,
        "repeats": sum(map(eq, words, words[1:])) / n,
        "commonest": max(Counter(words).values(), default=0) / n,
        "upper": int(count[UPPER]) / max(1, letters),
        "shouted": int(((raw[1:] == UPPER) & (raw[:-1] == UPPER)).sum()) / n,
        "symbols": int(count[SYMBOL]) / n,
        "letters": letters / solid,
        "doubled": int(((data[1:] == data[:-1]) & odd[1:]).sum()) / n,
        "bare": int(((raw[1:-1] == SYMBOL) & (raw[:-2] == SPACE) & (raw[2:] == SPACE)).sum()) / n,
        "marks": int(count[MARK]) / n,
        "word_length": letters / n,
        "ends": text.count(". ") / n + (text.count(".\n") + text.endswith(".")) / n,
        "repeated_lines": 1 - len(set(lines)) / max(1, len(lines)),
    }


def _bounds(name: str, bad: float, good: float) -> Callable[[dict], bool | None]:
    """Bad beyond one bound of a figure, good on the other side of the other, no opinion between."""
    if bad > good:
        return lambda m: False if m[name] > bad else True if m[name] < good else None
    return lambda m: False if m[name] < bad else True if m[name] > good else None


def _long(f: Callable[[dict], bool | None], least: int) -> Callable[[dict], bool | None]:
    return lambda m: f(m) if m["words"] >= least else None


# each labeller: True is good, False is bad, None is no opinion; each kind of fault is in the view of several
LABELLERS: dict[str, Callable[[dict], bool | None]] = {
    "repeats": _long(_bounds("repeats", 0.1, 0.03), 8),
    "distinct": _long(_bounds("distinct", 0.25, 0.6), 20),
    "commonest": _long(_bounds("commonest", 0.25, 0.15), 12),
    "upper": _bounds("upper", 0.3, 0.1),
    "shouted": _bounds("shouted", 0.5, 0.1),
    "symbols": _bounds("symbols", 0.1, 0.03),
    "letters": _bounds("letters", 0.88, 0.92),
    "doubled": _bounds("doubled", 0.1, 0.02),
    "bare": _bounds("bare", 0.1, 0.01),
    "marks": _bounds("marks", 0.2, 0.05),
    "word_length": _bounds("word_length", 2.0, 3.0),
    "ends": _long(lambda m: True if 0.02 < m["ends"] < 0.5 else False if m["ends"] < 0.005 else None, 30),
    "repeated_lines": lambda m: False if m["repeated_lines"] > 0.4 else None,
}
ABSTAIN, BAD, GOOD = 0, 1, 2


def votes(measures: dict) -> int:
    """All votes as one number in base 3."""
    code = 0
    for f in LABELLERS.values():
        said = f(measures)
        code = code * 3 + (ABSTAIN if said is None else GOOD if said else BAD)
    return code


def _unpacked(code: np.ndarray) -> np.ndarray:
    n = len(LABELLERS)
    return code[:, None] // 3 ** np.arange(n - 1, -1, -1) % 3


def accuracies(patterns: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share of each class of documents, and the chance of each vote of each labeller in it (classes x labellers x 3).

    Class 0 is good; class k + 1 are documents with the fault that labeller k looks for, which it sees at least as often
    as SEES. Other labellers see it as often as the counts say, so faults that several see become sure. The belief that
    a labeller seldom calls a good document bad stays as a prior. Saying nothing is no evidence: its chance is 1 everywhere.
    """
    vote, n = _unpacked(patterns), len(LABELLERS)
    total = float(count.sum())
    said = np.stack([[count[vote[:, k] == v].sum() for v in (BAD, GOOD)] for k in range(n)]) + 1.0
    start = np.ones((n + 1, n, 3))
    start[0, :, [BAD, GOOD]] = np.array([0.01, 0.99])[:, None]
    start[1:, :, BAD:] = 0.5 * said / said.sum(1, keepdims=True) + 0.25
    start[1 + np.arange(n), np.arange(n), BAD:] = [0.95, 0.05]
    prior = start * (0.002 * total)
    prior[0] *= 50
    chance, share = start.copy(), np.concatenate([[0.8], np.full(n, 0.2 / n)])
    for _ in range(EM_ROUNDS):
        weight = _classes(vote, share, chance) * count
        new = np.stack([np.stack([weight[:, vote[:, k] == v].sum(1) for v in range(3)], 1) for k in range(n)], 1) + prior
        new[:, :, BAD:] /= new[:, :, BAD:].sum(2, keepdims=True)
        new[:, :, ABSTAIN] = 1
        for k in range(n):
            bad = max(SEES, new[k + 1, k, BAD])
            new[k + 1, k, BAD:] = bad, 1 - bad
        moved = np.abs(new - chance).max()
        chance, share = new, (weight.sum(1) + 1) / (total + n + 1)
        if moved < 1e-6:
            break
    return share, chance


def _classes(vote: np.ndarray, share: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Probability of each class for each pattern (classes x patterns)."""
    log = np.log(share)[:, None] + np.log(chance[:, np.arange(vote.shape[1]), vote]).sum(2)
    p = np.exp(log - log.max(0))
    return p / p.sum(0)


def posterior(vote: np.ndarray, share: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Probability of being good."""
    return _classes(vote, share, chance)[0]


def features(raw: np.ndarray, measures: dict) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and weights: shares of the shapes of five bytes in the whole text, and the figures in steps."""
    at, value = np.empty(0, np.int64), np.empty(0)
    if len(raw) >= 5:
        code = raw[:-4] << np.uint32(12) | raw[1:-3] << np.uint32(9) | raw[2:-2] << np.uint32(6) | raw[3:-1] << np.uint32(3) | raw[4:]
        count = np.bincount(code, minlength=FEATURES)
        at = np.flatnonzero(count)
        value = np.sqrt(count[at] / len(code))
    steps = [hash_name(f"{k}:{int(min(20, 20 * v)) if k != 'words' else min(6, int(np.log2(v + 1)))}") for k, v in measures.items()]
    return np.concatenate([at, np.array(steps, np.int64)]), np.concatenate([value, np.full(len(steps), 0.3)])


def hash_name(name: str) -> int:
    """A place among FEATURES for a named feature, the same in every process."""
    code = 0
    for b in name.encode():
        code = (code * 1_000_003 + b) & 0xFFFFFFFF
    return (code * 2654435761 & 0xFFFFFFFF) >> 17


def train_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and constant of a logistic scorer for soft labels, by full-batch gradient steps with momentum."""
    size = np.array([len(a) for a, _ in rows])
    at, value, row = np.concatenate([a for a, _ in rows]), np.concatenate([v for _, v in rows]), np.repeat(np.arange(len(rows)), size)
    w, b, mw, mb = np.zeros(FEATURES), 0.0, np.zeros(FEATURES), 0.0
    # bad documents are few: both kinds weigh the same
    weight = np.where(target >= 0.5, 0.5 / max(1e-9, (target >= 0.5).mean()), 0.5 / max(1e-9, (target < 0.5).mean())) / len(rows)
    for _ in range(FIT_ROUNDS):
        z = np.bincount(row, w[at] * value, len(rows)) + b
        err = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) * weight
        mw = 0.9 * mw + np.bincount(at, err[row] * value, FEATURES) + 1e-5 * w
        mb = 0.9 * mb + err.sum()
        w -= 2.0 * mw
        b -= 2.0 * mb
    return w, b


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, votes, posterior, score, kept) of every row, over whole texts.

    All documents' votes are counted (a count per pattern, at most 3 ** labellers of them, comes to the driver). The
    scorer is trained on at most SAMPLE_ROWS documents. ``kept`` is score >= KEEP_FROM; a null or blank text has score 0
    and goes. The columns of ``docs`` come along as the struct ``row``. Without documents there are no rows; if all votes agree, the posteriors are near the prior and all is kept.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    whole = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.struct(*docs.columns).alias("row"))

    def vote(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([votes(look(t)[1]) for t in batch.column(0).to_pylist()], pa.int32())], ["votes"])

    counted = rows.select("text").mapInArrow(vote, "votes int").groupBy("votes").count().collect()
    pattern, count = (np.array([r[k] for r in counted], np.int64) for k in range(2))
    share, chance = (accuracies(pattern, count) if counted else
                     (np.ones(2) / 2, np.full((2, len(LABELLERS), 3), 1 / 3)))

    def sampled(batches):
        for batch in batches:
            got = [(m, features(raw, m)) for raw, m in map(look, batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([votes(m) for m, _ in got], pa.int32()), pa.array([f[0].astype("<i4").tobytes() for _, f in got], pa.binary()),
                 pa.array([f[1].astype("<f4").tobytes() for _, f in got], pa.binary())], ["votes", "at", "value"])

    chosen = (rows.select(F.col("id").alias("chosen")).orderBy(F.xxhash64("chosen"), "chosen").limit(SAMPLE_ROWS)).distinct()
    # with fewer than SAMPLE_ROWS ids the sample is the table
    got = (rows.join(F.broadcast(chosen), F.col("id").eqNullSafe(F.col("chosen"))).select("text").limit(SAMPLE_ROWS)
           .mapInArrow(sampled, "votes int, at binary, value binary").collect()) if counted else []
    sample = [(np.frombuffer(r["at"], "<i4"), np.frombuffer(r["value"], "<f4")) for r in got]
    target = posterior(_unpacked(np.array([r["votes"] for r in got], np.int64)), share, chance) if got else np.empty(0)
    w, b = train_scorer(sample, target) if got else (np.zeros(FEATURES), 0.0)
    model = docs.sparkSession.sparkContext.broadcast((w, b))

    def score(batches):
        weights, constant = model.value
        for batch in batches:
            said, value = [], []
            for t in batch.column(1).to_pylist():
                raw, m = look(t)
                said.append(votes(m))
                at, x = features(raw, m)
                z = float(np.clip(weights[at] @ x + constant, -50, 50))
                value.append(1 / (1 + np.exp(-z)) if m["words"] else 0.0)
            post = posterior(_unpacked(np.array(said, np.int64)), share, chance) if said else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(said, pa.int32()), pa.array(post, pa.float64()), pa.array(value, pa.float64()),
                 pa.array([v >= KEEP_FROM for v in value], pa.bool_()), batch.column(2)],
                ["id", "votes", "posterior", "score", "kept", "row"])

    kind = rows.schema["id"].dataType.simpleString()
    row = whole.schema["row"].dataType.simpleString()
    return whole.mapInArrow(score, f"id {kind}, votes int, posterior double, score double, kept boolean, row {row}")
