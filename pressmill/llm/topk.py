"""Exact top-k search: matrix products of query tiles and blocks of rows, top lists per tile, merged as a tree."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import pieces

TILE_ROWS = 1024
BLOCK_ROWS = 2048
#: blocks that meet one tile in one group of the grid
GROUP_BLOCKS = 4
FAN_IN = 8
LONG = 2 ** 63 - 1


def scaled(vector, scale: int) -> np.ndarray | None:
    """floor(scale * x) of each component as double, or None if the vector is null or has a component that is not a number."""
    if vector is None:
        return None
    x = np.array([np.nan if v is None else v for v in vector], np.float64)
    return np.floor(scale * x) if np.isfinite(x).all() else None


def _packed(df: DataFrame, rows: int, scale: int) -> DataFrame:
    """(dim, no, ids binary, data binary): blocks of up to ``rows`` vectors of one length; ``no`` names the block."""
    def run(batches):
        held: dict[int, list] = {}
        made = 0
        part = TaskContext.get().partitionId()

        def out(dim):
            nonlocal made
            items = sorted(held.pop(dim), key=lambda x: x[0])
            made += 1
            return pa.RecordBatch.from_arrays([
                pa.array([dim], pa.int32()), pa.array([part << 32 | made], pa.int64()),
                pa.array([np.array([i for i, _ in items], "<i8").tobytes()], pa.binary()),
                pa.array([np.array([v for _, v in items], "<f8").tobytes()], pa.binary())], ["dim", "no", "ids", "data"])

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = scaled(v, scale)
                if i is None or x is None:
                    continue
                held.setdefault(len(x), []).append((i, x))
                if len(held[len(x)]) >= rows:
                    yield out(len(x))
        for dim in list(held):
            yield out(dim)

    return df.mapInArrow(run, "dim int, no long, ids binary, data binary")


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products as 64-bit integers; beyond the exact range of doubles by Python's integers, held to that of long."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if most < 2 ** 53:
        return (q @ c.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    return np.array([[max(-LONG, min(LONG, sum(a * b for a, b in zip(x, y, strict=True)))) for y in exact(c)]
                     for x in exact(q)], np.int64).reshape(len(q), len(c))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to the smaller id."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= kth)
        scores, ids = scores[at], ids[at]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def top_k(queries: DataFrame, rows: DataFrame, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` rows of highest integer inner product.

    Both sides are packed into blocks; a grid of (tile, group of blocks) spreads their products, so a tile is sent to
    each group and a block to each tile, whatever their numbers. Each cell of the grid keeps k rows per query, and the
    lists are merged FAN_IN at a time.

    Vectors that are null or hold null or non-finite components, and rows with a null id, take no part; vectors of other
    lengths than the query's are no candidates, nor are rows of the query's own id; empty ones score 0 with each other. Scores are held to the range of long.
    Repeated candidate ids count as rows of their own; repeated query ids are one query per row, and get the merged list.
    No queries or no candidates give no rows.
    """
    queries, rows = (d.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")) for d in (queries, rows))
    # a query id that comes twice would meet each candidate twice
    queries = queries.dropDuplicates(["id"])
    tiles_across = pieces(queries.count(), TILE_ROWS)
    groups = pieces(rows.count(), GROUP_BLOCKS * BLOCK_ROWS)
    hashed = F.pmod(F.xxhash64("no"), F.lit(1 << 40))
    tiles = (_packed(queries.repartition(tiles_across), TILE_ROWS, scale)
             .select("dim", (hashed % tiles_across).cast("int").alias("r"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("c"),
                     F.col("ids").alias("qids"), F.col("data").alias("q")))
    blocks = (_packed(rows, BLOCK_ROWS, scale)
              .select("dim", (hashed % groups).cast("int").alias("c"),
                      F.explode(F.sequence(F.lit(0), F.lit(tiles_across - 1))).alias("r"), "ids", "data"))

    def cell(batches):
        for batch in batches:
            for dim, c, qids, q, ids, data in zip(*(batch.column(i) for i in range(6)), strict=True):
                dim = dim.as_py()
                qids, ids = np.frombuffer(qids.as_py(), "<i8"), np.frombuffer(ids.as_py(), "<i8")
                # the number of rows is named: vectors may be empty
                score = products(np.frombuffer(q.as_py(), "<f8").reshape(len(qids), dim),
                                 np.frombuffer(data.as_py(), "<f8").reshape(len(ids), dim))
                lists = []
                for row, own in zip(score, qids, strict=True):
                    other = ids != own
                    lists.append(best(row[other], ids[other], k))
                n = [len(s) for s, _ in lists]
                flat = pa.StructArray.from_arrays(
                    [pa.array(-np.concatenate([s for s, _ in lists]), pa.int64()),
                     pa.array(np.concatenate([i for _, i in lists]), pa.int64())], ["less", "vec_id"])
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qids, pa.int64()), pa.array([c.as_py()] * len(qids), pa.int32()),
                     pa.ListArray.from_arrays(offsets, flat)], ["query_id", "c", "top"])

    lists = tiles.join(blocks, ["dim", "r", "c"]).select("dim", "c", "qids", "q", "ids", "data").mapInArrow(
        cell, "query_id long, c int, top array<struct<less:long,vec_id:long>>")
    while True:
        groups = -(-groups // FAN_IN)
        merged = F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k).alias("top")
        lists = lists.groupBy("query_id", F.floor(F.col("c") / FAN_IN).cast("int").alias("c")).agg(merged)
        if groups == 1:
            break
    return lists.select("query_id", F.posexplode("top").alias("p", "t")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), (-F.col("t.less")).alias("score"))
