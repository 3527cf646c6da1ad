"""Near-duplicate vectors by an inverted multi-index.

Each half of the vector has a codebook of its own, and the pairs of their words form a grid of cells. A vector lives in
one cell and looks into others: a multi-sequence traversal visits cells in the order of a lower bound of the distance any
vector there must have, until the bound passes a limit that keeps the target recall. What it meets there is verified.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import components, forest, written

#: vectors the codebooks are fitted on, those of the smallest hash of the id
SAMPLE = 8192
#: words of a codebook at most
MOST_WORDS = 256
CODEBOOK_ROUNDS = 12
TARGET_RECALL = 0.995
#: rows of one side of a verification task, about
SIDE = 2048
VERIFY_ROWS = 1024


def directions(values: list) -> tuple[list[int], np.ndarray]:
    """Places and unit vectors (double) of the vectors of one length that have a direction; others are left out."""
    kept, rows = [], []
    for k, v in enumerate(values):
        if v is None:
            continue
        x = np.array([np.nan if c is None else c for c in v], np.float64)
        most = np.abs(x).max(initial=0)
        if not np.isfinite(most) or most == 0 or np.isnan(x).any():
            continue
        x = x / most
        kept.append(k)
        rows.append(x / np.sqrt(x @ x))
    return kept, rows


def codebook(points: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Centres by Lloyd's rounds from random points."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(size, len(points)), replace=False)]
    for _ in range(CODEBOOK_ROUNDS):
        near = _squares(points, centres).argmin(1)
        count = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, points)
        centres = np.where(count[:, None] > 0, total / np.maximum(1, count)[:, None], centres)
    return centres


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances; summed along the last axis, so that a row's value does not depend on its neighbours."""
    out = np.empty((len(points), len(centres)))
    for a in range(0, len(points), 256):
        out[a:a + 256] = ((points[a:a + 256, None, :] - centres[None]) ** 2).sum(-1)
    return out


class Index:
    """Two codebooks for vectors of one length, and the limit of the traversal."""

    def __init__(self, sample: np.ndarray, words: int, threshold: float):
        self.half = sample.shape[1] // 2
        self.books = [codebook(sample[:, :self.half], words), codebook(sample[:, self.half:], words)]
        self.gaps = [np.sqrt(_squares(b, b)) for b in self.books]
        self.radius2 = 2 - 2 * threshold
        self.limit = self._limit(sample, threshold)

    def bounds(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Home words of both halves, and for each word a lower bound of the squared distance to any vector that has it."""
        home, low = [], []
        for part, book, gap in zip((rows[:, :self.half], rows[:, self.half:]), self.books, self.gaps, strict=True):
            d = _squares(part, book)
            near = d.argmin(1)
            here = d[np.arange(len(d)), near][:, None]
            apart = np.maximum(gap[near], 1e-12)
            low.append(np.where(np.arange(len(book)) == near[:, None], 0.0, ((d - here) / (2 * apart)) ** 2))
            home.append(near)
        return home[0], home[1], low

    def _limit(self, sample: np.ndarray, threshold: float) -> float:
        """The bound that pairs at the very threshold stay under, for the target share of them (either way counts)."""
        rng = np.random.default_rng(1)
        x = sample[:2000]
        noise = rng.standard_normal(x.shape)
        noise -= (noise * x).sum(1, keepdims=True) * x
        size = np.linalg.norm(noise, axis=1, keepdims=True)
        y = threshold * x + np.sqrt(1 - threshold ** 2) * noise / np.maximum(size, 1e-12)
        a, b, low = self.bounds(x)
        c, d, back = self.bounds(y)
        k = np.arange(len(x))
        need = np.minimum(low[0][k, c] + low[1][k, d], back[0][k, a] + back[1][k, b])
        return float(min(self.radius2, np.quantile(need, TARGET_RECALL)))

    def visit(self, low: list[np.ndarray], row: int) -> list[int]:
        """Cells in ascending order of their bound, up to the limit: the multi-sequence traversal of two sorted lists."""
        first, second = low[0][row], low[1][row]
        a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        first, second = first[a].tolist(), second[b].tolist()
        heap, out = [(first[0] + second[0], 0, 0)], []
        while heap and heap[0][0] <= self.limit:
            _, i, j = heapq.heappop(heap)
            out.append(int(a[i]) * MOST_WORDS + int(b[j]))
            if j + 1 < len(b):
                heapq.heappush(heap, (first[i] + second[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (first[i + 1] + second[0], i + 1, 0))
        return out


def _distinct(rows: DataFrame) -> DataFrame:
    """(key, label, dim, vec, rep, copies): vectors with label and direction, equal ones under their smallest id."""
    def run(batches):
        for batch in batches:
            ids, values, labels = (batch.column(k).to_pylist() for k in range(3))
            kept, unit = directions(values)
            raw = [np.array(values[k], np.float64).tobytes() for k in kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[k] for k in kept], pa.int64()), pa.array([labels[k] for k in kept], pa.string()),
                 pa.array([len(v) for v in unit], pa.int32()),
                 pa.array([hashlib.blake2b(f"{labels[k]}|".encode() + r, digest_size=16).digest() for k, r in zip(kept, raw, strict=True)], pa.binary()),
                 pa.array([v.tobytes() for v in unit], pa.binary())], ["id", "label", "dim", "key", "vec"])

    return rows.mapInArrow(run, "id long, label string, dim int, key binary, vec binary")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    Rows of equal, non-null label link if their cosine (double precision) is at least ``threshold``. Equal vectors are
    compared once and count as linked with each other. A vector that is null, zero or holds null or non-finite
    components, and one without label, has no links. Vectors of different length never link. Rows with a null id are
    left out; ids are expected to be distinct (rows of one id share its result). ``kept`` is id = component_id.

    The codebooks are fitted on a bounded sample; all vectors are indexed. A cell with many rows is split into tasks of
    about SIDE rows a side, which give counts and a spanning forest, not pairs.
    """
    rows = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"),
                                                           F.col(label_col).cast("string").alias("label"))
    valid = written(_distinct(rows.where("label is not null and v is not null")))
    reps = written(valid.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"),
                                            F.first("dim").alias("dim"), F.first("vec").alias("vec")))
    n = reps.count()
    drawn = reps.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("dim", "vec").collect()
    by_dim: dict[int, list] = {}
    for r in drawn:
        by_dim.setdefault(r["dim"], []).append(np.frombuffer(r["vec"], np.float64))
    words = int(min(MOST_WORDS, max(4, round(n ** 0.25))))
    # a length that the sample lacks, or one component, gets one cell
    indexes = {d: Index(np.array(v), words, threshold) for d, v in by_dim.items() if d > 1}
    model = vectors.sparkSession.sparkContext.broadcast(indexes)

    def place(batches):
        """Each vector's home cell and the cells it visits."""
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                dims = np.array(part.column(3).to_pylist())
                vecs = part.column(4).to_pylist()
                home, cells = [0] * len(dims), [[0]] * len(dims)
                for dim in set(dims.tolist()) & model.value.keys():
                    at, index = np.flatnonzero(dims == dim), model.value[dim]
                    a, b, low = index.bounds(np.array([np.frombuffer(vecs[i], np.float64) for i in at]))
                    for j, i in enumerate(at):
                        home[i], cells[i] = int(a[j]) * MOST_WORDS + int(b[j]), index.visit(low, j)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home, pa.int32()), pa.array(cells, pa.list_(pa.int32()))],
                                                 [*part.schema.names, "home", "cells"])

    placed = written(reps.select("rep", "copies", "label", "dim", "vec").mapInArrow(
        place, "rep long, copies long, label string, dim int, vec binary, home int, cells array<int>"))
    probes = placed.select("rep", "copies", "label", "dim", "vec", "home", F.explode("cells").alias("cell"))
    cell = ["label", "dim", "cell"]
    homes = placed.select("rep", "copies", "label", "dim", "vec", "home", F.col("home").alias("cell"))
    # only cells that somebody lives in are looked into
    sizes = (homes.groupBy(*cell).agg(F.ceil(F.count("*") / SIDE).cast("int").alias("n_homes"))
             .join(probes.groupBy(*cell).agg(F.ceil(F.count("*") / SIDE).cast("int").alias("n_probes")), cell))
    spot = lambda n_col: F.pmod(F.xxhash64("rep"), F.col(n_col)).cast("int")
    every = lambda n_col: F.explode(F.sequence(F.lit(0), F.col(n_col) - 1))
    carried = [*cell, "rep", "copies", "vec", "home"]
    sent = (homes.join(sizes, cell).select(*carried, F.lit(True).alias("lives"), spot("n_homes").alias("i"), every("n_probes").alias("j"))
            .union(probes.join(sizes, cell).select(*carried, F.lit(False).alias("lives"), every("n_homes").alias("i"), spot("n_probes").alias("j"))))

    def verify(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        index = model.value.get(int(key[1]))
        lives = rows["lives"].to_numpy()
        h, p = rows[lives], rows[~lives]
        empty = pd.DataFrame({"id": [], "n": [], "other": []}).astype("int64")
        if not len(h) or not len(p):
            return empty
        hv, pv = (np.frombuffer(b"".join(x["vec"]), np.float64).reshape(len(x), -1) for x in (h, p))
        h_id, p_id, h_n, p_n = h["rep"].to_numpy(), p["rep"].to_numpy(), h["copies"].to_numpy(), p["copies"].to_numpy()
        p_home, low = p["home"].to_numpy(), index.bounds(hv)[2] if index else None
        ids = np.unique(np.concatenate([h_id, p_id]))
        h_at, p_at = np.searchsorted(ids, h_id), np.searchsorted(ids, p_id)
        linked, found = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for a in range(0, len(p), VERIFY_ROWS):
            i, j = np.nonzero(pv[a:a + VERIFY_ROWS] @ hv.T >= threshold)
            i += a
            keep = p_id[i] != h_id[j]
            if index:
                # if the other one visits this one's cell as well, the smaller id counts the pair
                x, y = np.divmod(p_home[i], MOST_WORDS)
                back = low[0][j, x] + low[1][j, y] <= index.limit
                keep &= ~back | (p_id[i] < h_id[j])
            else:
                keep &= p_id[i] < h_id[j]
            i, j = i[keep], j[keep]
            np.add.at(linked, p_at[i], h_n[j])
            np.add.at(linked, h_at[j], p_n[i])
            found = forest(len(ids), np.concatenate([np.arange(len(ids)), p_at[i]]), np.concatenate([found, h_at[j]]))
        at = np.flatnonzero(linked)
        return pd.DataFrame({"id": ids[at], "n": linked[at], "other": ids[found[at]]})

    met = written(sent.groupBy("label", "dim", "cell", "i", "j").applyInPandas(verify, "id long, n long, other long"))
    counts = met.groupBy("id").agg(F.sum("n").alias("linked")).withColumnRenamed("id", "rep")
    roots = components(met.select(F.col("id").alias("a"), F.col("other").alias("b"))).withColumnRenamed("id", "rep")
    classes = (reps.select("key", "rep", "copies").join(counts, "rep", "left").join(roots, "rep", "left")
               .select("key", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
                       F.coalesce("component_id", "rep").alias("component_id")))
    members = valid.select("id", "key").join(classes, "key").groupBy("id").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return rows.select("id").join(members, "id", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    ).withColumn("kept", F.col("id") == F.col("component_id"))


