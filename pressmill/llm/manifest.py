"""Merkle manifest of a dataset: a 16-ary hash tree per source, and one over the sources' roots.

Leaves are numbered within their source and cut into aligned blocks of BLOCK_LEAVES; a block is a subtree of HEIGHT levels,
stored as one row in van Emde Boas order: the subtree is split at half its height into a top tree and the trees below it,
each laid out in the same way, one after the other, and only nodes that exist take a place. Where a node stands follows
from its level, its number and the number of leaves alone. Blocks are built by tasks of their own; their roots are the
leaves of the blocks above, and so on to the root, so no task holds more than a block, however large a source is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.session import cut_lineage

FAN_OUT = 16
BITS = 4
#: levels above the leaves of a block
HEIGHT = 3
DIGEST = 32
#: what a proof is checked to
CHECKED = ["proof_sha256", "folded"]


# -- digests ---------------------------------------------------------------------------------------------------------

def field(value: Column) -> Column:
    """A value with its length in bytes before it, ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The leaf's digest, lowercase hex."""
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def parent(children: bytes) -> bytes:
    """The digest of a run of nodes; a node's digest enters as hex text."""
    return hashlib.sha256(children.hex().encode()).digest()


# -- the layout ------------------------------------------------------------------------------------------------------

def level_sizes(leaves: int, height: int) -> list[int]:
    """Nodes of each level, from the top (1) to the leaves."""
    out = [leaves]
    for _ in range(height):
        out.append(-(-out[-1] // FAN_OUT))
    return out[::-1]


def _nodes(leaves: np.ndarray, levels: int) -> np.ndarray:
    """Nodes of trees of so many levels that have so many leaves, filled from the left."""
    total, now = leaves.copy(), leaves
    for _ in range(levels - 1):
        now = (now + FAN_OUT - 1) >> BITS
        total += now
    return total


def address(depth: int, index: np.ndarray, levels: int, leaves: int | np.ndarray) -> np.ndarray:
    """Place of the nodes ``index`` of level ``depth`` in a tree of ``levels`` levels with ``leaves`` leaves."""
    index = np.asarray(index, np.int64)
    leaves = np.broadcast_to(np.asarray(leaves, np.int64), index.shape)
    if levels == 1:
        return np.zeros(index.shape, np.int64)
    top = levels // 2
    below = levels - top
    full = 1 << BITS * (below - 1)  # leaves of a whole tree below
    roots = (leaves + full - 1) // full
    top_leaves = (roots + FAN_OUT - 1) >> BITS
    if depth < top:
        return address(depth, index, top, top_leaves)
    shift = BITS * (depth - top)
    tree = index >> shift
    whole = ((1 << BITS * below) - 1) // (FAN_OUT - 1)
    inside = address(depth - top, index - (tree << shift), below, np.minimum(full, leaves - tree * full))
    return _nodes(top_leaves, top) + tree * whole + inside


def build_block(digests: bytes, height: int) -> bytes:
    """The nodes of a block in their order, from the digests of its leaves."""
    leaves = len(digests) // DIGEST
    sizes = level_sizes(leaves, height)
    out = np.empty((sum(sizes), DIGEST), np.uint8)
    level = digests
    for depth in range(height, -1, -1):
        out[address(depth, np.arange(sizes[depth]), height + 1, leaves)] = np.frombuffer(level, np.uint8).reshape(-1, DIGEST)
        step = FAN_OUT * DIGEST
        level = b"".join(parent(level[k:k + step]) for k in range(0, len(level), step)) if depth else b""
    return out.tobytes()


def siblings(nodes: bytes, height: int, leaves: int, index: np.ndarray) -> list[list[tuple[int, bytes]]]:
    """For each leaf: per level upwards, its own place among the run and the digests of the others, left to right."""
    found = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    sizes = level_sizes(leaves, height)
    index = np.asarray(index, np.int64)
    out: list[list[tuple[int, bytes]]] = [[] for _ in index]
    for depth in range(height, 0, -1):
        run, which = np.unique(index >> BITS, return_inverse=True)
        runs = []
        for r in run.tolist():
            here = np.arange(r << BITS, min((r + 1) << BITS, sizes[depth]))
            runs.append(found[address(depth, here, height + 1, leaves)].tobytes())
        for k, (i, r) in enumerate(zip(index.tolist(), which.tolist(), strict=True)):
            own = i & (FAN_OUT - 1)
            out[k].append((own, runs[r][:own * DIGEST] + runs[r][(own + 1) * DIGEST:]))
        index = index >> BITS
    return out


def fold(digest: bytes, path: list[tuple[int, bytes]]) -> bytes:
    """The root that follows from a leaf and its siblings."""
    for own, others in path:
        digest = parent(others[:own * DIGEST] + digest + others[own * DIGEST:])
    return digest


def packed(path: list[tuple[int, bytes]]) -> bytes:
    """A path as bytes: per level the number of siblings, the own place and the siblings."""
    return b"".join(bytes([len(others) // DIGEST, own]) + others for own, others in path)


def unpacked(path: bytes) -> list[tuple[int, bytes]]:
    out, at = [], 0
    while at < len(path):
        n, own = path[at], path[at + 1]
        out.append((own, path[at + 2:at + 2 + n * DIGEST]))
        at += 2 + n * DIGEST
    return out


# -- numbers of rows -------------------------------------------------------------------------------------------------

def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds ``n``, the place of a row in its group from 0 (by ``order``, nulls first), and ``size``, the group's rows.

    Rows are sorted over all tasks by ranges of group and order, so a group of any size spans many tasks; only the numbers
    of rows per task and group are added up. Ties of the whole order have any places.
    """
    # the last key parts rows that are equal in all others
    keys = [F.asc_nulls_first(group), *(F.asc_nulls_first(c) for c in order), F.col("_at")]
    placed = rows.withColumn("_at", F.monotonically_increasing_id())
    kept = cut_lineage(placed.repartitionByRange(*keys).sortWithinPartitions(*keys)
                       .withColumn("_at", F.monotonically_increasing_id()).withColumn("_task", F.shiftright("_at", 33)))
    # one row per group and task that has rows of it
    counts = kept.groupBy(F.col(group).alias("_group"), F.col("_task").alias("_in")).agg(
        F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    counts = (counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
              .withColumn("size", F.sum("_rows").over(whole)))
    joined = kept.join(counts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_task") == F.col("_in")))
    return joined.withColumn("n", F.col("_at") - F.col("_first") + F.col("_before")).select(*rows.columns, "n", "size")


# -- the tree --------------------------------------------------------------------------------------------------------

@dataclass
class Manifest:
    """``leaves``: (grp, row, n, size, digest), ``row`` the struct of what the caller keeps. ``tiers``: the blocks of the sources'
    trees, from the leaves up: (grp, block, above, height, leaves, nodes, root), ``above`` the number of the tier's blocks in
    the group. ``subroots``: (all, grp, digest, n, size), the leaves of the last tree, and ``root_tiers`` its blocks."""

    leaves: DataFrame
    tiers: list[DataFrame]
    subroots: DataFrame
    root_tiers: list[DataFrame]


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _spans(keys: list) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(keys):
        end = at + 1
        while end < len(keys) and keys[end] == keys[at]:
            end += 1
        yield at, end
        at = end


def _keys(batch: pa.RecordBatch) -> list[tuple]:
    return list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    """Blocks over the nodes (grp, n, size, digest) of groups with more than one."""
    width = FAN_OUT ** height
    columns = {"grp": pa.string(), "block": pa.int64(), "above": pa.int64(), "height": pa.int32(), "leaves": pa.int32(),
               "nodes": pa.binary(), "root": pa.binary()}

    def made(key, size, digests):
        levels = min(height, next(h for h in range(1, 64) if FAN_OUT ** h >= size))
        nodes = build_block(b"".join(digests), levels)
        row = (*key, -(-size // width), levels, len(digests), nodes, nodes[:DIGEST])
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, columns.values(), strict=True)], list(columns))

    def run(batches):
        now, size, held = None, 0, []
        for batch in batches:
            keys, digests = _keys(batch), batch.column(3).to_pylist()
            for at, end in _spans(keys):
                if held and keys[at] != now:
                    yield made(now, size, held)
                    held = []
                now, size = keys[at], batch.column(2)[at].as_py()
                held += digests[at:end]
        if held:
            yield made(now, size, held)

    rows = nodes.where("size > 1").select("grp", F.expr(f"n div {width}").alias("block"), "n", "size", "digest")
    # the rows of a block meet; those of a large group are dealt out block by block
    return (rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "n").select("grp", "block", "size", "digest")
            .mapInArrow(run, "grp string, block long, above long, height int, leaves int, nodes binary, root binary"))


def _as_nodes(tier: DataFrame) -> DataFrame:
    return tier.select("grp", F.col("block").alias("n"), F.col("above").alias("size"), F.col("root").alias("digest"))


def _tree(nodes: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """All tiers over (grp, n, size, digest), and (grp, digest) of each group's root."""
    tiers, tops = [], nodes.where("size = 1").select("grp", "digest")
    while True:
        tier = cut_lineage(_blocks(nodes, height))
        if tier.isEmpty():
            return tiers, tops
        tiers.append(tier)
        nodes = _as_nodes(tier)
        tops = tops.unionByName(nodes.where("size = 1").select("grp", "digest"))


def build(docs: DataFrame, columns: list[str], source_col: str = "source", id_col: str = "doc_id",
          keep: dict[str, Column] | None = None, height: int = HEIGHT) -> Manifest:
    """The manifest of all rows: a leaf is the digest of ``columns`` in their order; leaves ascend by id in their source.

    Null sources are a source of their own, the first; null ids come first in their source. Rows that share an id are
    ordered by their digests, so the root does not depend on how the table is dealt out; equal rows are leaves of their own.
    A text enters whole. An empty table has no leaves, blocks or roots. ``keep`` names what the leaves' ``row`` holds, by
    default the id.
    """
    kept = F.struct(*(c.alias(k) for k, c in (keep or {"id": F.col(id_col)}).items()))
    digests = cut_lineage(docs.select(
        F.col(source_col).cast("string").alias("grp"), F.col(id_col).alias("at"), F.unhex(leaf(*(F.col(c) for c in columns))).alias("digest"),
        kept.alias("row")))
    leaves = cut_lineage(numbered(digests, "grp", ["at", "digest"]).select("grp", "row", "n", "size", "digest"))
    tiers, tops = _tree(leaves.drop("row"), height)
    # the sources' roots, in order, are the leaves of the last tree
    subroots = cut_lineage(numbered(cut_lineage(tops.select(F.lit("").alias("all"), "grp", "digest")), "all", ["grp"]))
    root_tiers, _ = _tree(subroots.select(F.col("all").alias("grp"), "n", "size", "digest"), height)
    return Manifest(leaves, tiers, subroots, root_tiers)


# -- proofs ----------------------------------------------------------------------------------------------------------

def _checks(paths: list[bytes], starts: list[bytes]) -> list[pa.Array]:
    """For each path the digest of all its siblings and the root that follows from the digest it starts with, both hex."""
    proof, folded = [], []
    for path, start in zip(paths, starts, strict=True):
        steps = unpacked(path)
        proof.append(parent(b"".join(others for _, others in steps)).hex())
        folded.append(fold(start, steps).hex())
    return [pa.array(proof, pa.string()), pa.array(folded, pa.string())]


def _served(wanted: DataFrame, blocks: DataFrame, height: int) -> DataFrame:
    """(grp, n, digest, row, path, subroot, root) of the wanted (grp, n, digest, row): siblings inside the block, then the block's path.

    Wanted nodes and their block (grp, block, height, leaves, nodes, path, subroot, root) are sorted together: the block comes
    first and is held while its nodes pass. If ``wanted`` has a column ``_checked``, paths are folded from it here and do not
    leave the task: the result has proof_sha256 and folded (see ``verify``) in their place.
    """
    width = FAN_OUT ** height
    checked = "_checked" in wanted.columns
    more = ["_checked"] if checked else []
    nodes = wanted.select("grp", F.expr(f"n div {width}").alias("block"), "n", "digest", "row", *more)
    rows = (nodes.unionByName(blocks.withColumn("n", F.lit(-1).cast("long")), allowMissingColumns=True)
            .select("grp", "block", "n", "digest", "row", "height", "leaves", "nodes", "path", "subroot", "root", *more))
    proofs = CHECKED if checked else ["path"]

    def run(batches):
        held = None
        for batch in batches:
            for at, end in _spans(_keys(batch)):
                part = batch.slice(at, end - at)
                if part.column(2)[0].as_py() < 0:
                    held = [part.column(k)[0].as_py() for k in range(5, 11)]
                    part = part.slice(1)
                if not part.num_rows:
                    continue
                levels, leaves, stored, path, subroot, root = held
                n = part.column(2).to_numpy()
                found = siblings(stored, levels, leaves, n - part.column(1)[0].as_py() * width)
                paths = [packed(p) + path for p in found]
                made = _checks(paths, part.column(11).to_pylist()) if checked else [pa.array(paths, pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(3), part.column(4), *made,
                     pa.array([subroot] * len(n), pa.binary()), pa.array([root] * len(n), pa.binary())],
                    ["grp", "n", "digest", "row", *proofs, "subroot", "root"])

    kind = T.StringType() if checked else T.BinaryType()
    schema = T.StructType([T.StructField("grp", T.StringType()), T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()),
                           wanted.schema["row"], *(T.StructField(c, kind) for c in proofs),
                           *(T.StructField(c, T.BinaryType()) for c in ("subroot", "root"))])
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "n").mapInArrow(run, schema)


def _climb(wanted: DataFrame, tiers: list[DataFrame], ends: DataFrame, height: int) -> DataFrame:
    """As ``_served``, through all tiers; ``ends`` (grp, path, subroot, root) goes on where a group's tree ends."""
    ends = ends.withColumnRenamed("grp", "_g")
    more = ["path", "subroot", "root"]
    paths = None
    for k in range(len(tiers) - 1, -1, -1):
        blocks = tiers[k].select("grp", "block", "above", "height", "leaves", "nodes")
        served = blocks.where("above = 1").join(ends, _same("grp", "_g")).drop("_g", "above")
        if paths is not None:
            higher = paths.select(F.col("grp").alias("_g"), F.col("n").alias("_n"), *more)
            served = served.unionByName(blocks.where("above > 1").join(higher, _same("grp", "_g") & (F.col("block") == F.col("_n")))
                                        .drop("_g", "_n", "above"))
        if k:
            inner = _as_nodes(tiers[k - 1]).where("size > 1").withColumn("row", F.lit(None).cast("string"))
            paths = cut_lineage(_served(inner, served, height))
    columns = ["grp", "n", "digest", "row", *more]
    alone = wanted.where("size = 1").join(ends, _same("grp", "_g"))
    if "_checked" in wanted.columns:
        alone = verify(alone.select(*columns, F.col("_checked").alias("_start")), F.col("_start"))
        columns = [*columns[:4], *CHECKED, *more[1:]]
    alone = alone.select(*columns)
    return _served(wanted.where("size > 1"), served, height).unionByName(alone) if tiers else alone


def prove(manifest: Manifest, wanted: DataFrame | None = None, height: int = HEIGHT, digest: Column | None = None) -> DataFrame:
    """(grp, n, digest, row, path, subroot, root) of the wanted rows of ``manifest.leaves``, by default all.

    ``path`` are the siblings of each level from the leaf to the root, as ``packed`` writes them. With a ``digest`` the proofs
    are checked as ``verify`` does, in the task that makes them: proof_sha256 and folded stand in place of the path.
    """
    wanted = manifest.leaves if wanted is None else wanted
    if digest is not None:
        wanted = wanted.withColumn("_checked", digest)
    top = manifest.root_tiers[-1].where("above = 1").select("root") if manifest.root_tiers else manifest.subroots.select(
        F.col("digest").alias("root"))
    end = top.select(F.lit("").alias("grp"), F.lit(b"").alias("path"), F.lit(b"").alias("subroot"), "root")
    subroots = manifest.subroots.select(F.col("all").alias("grp"), "n", "size", "digest", F.struct("grp").alias("row"))
    ends = cut_lineage(_climb(subroots, manifest.root_tiers, end, height).select(
        "row.grp", "path", F.col("digest").alias("subroot"), "root"))
    return _climb(wanted, manifest.tiers, ends, height)


def verify(proofs: DataFrame, digest: Column) -> DataFrame:
    """Adds proof_sha256 (hex digest of all siblings) and folded (hex root that follows from ``digest`` and the path)."""
    rows = proofs.withColumn("_checked", digest)

    def run(batches):
        for batch in batches:
            checks = _checks(batch.column("path").to_pylist(), batch.column("_checked").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *checks], [*batch.schema.names[:-1], *CHECKED])

    text = [T.StructField(c, T.StringType()) for c in CHECKED]
    return rows.mapInArrow(run, T.StructType([*proofs.schema.fields, *text]))
