"""Balanced selection under quotas and caps.

The rule walks the ranked pool several times. Most weeks are settled by the best ``block`` rows: clusters and picks
depend only on better-ranked rows. A week that these do not settle, say one with a quota that it cannot meet, is walked
block by block: Spark leaves out the rows that the picks so far rule out, and a task gets the best ``block`` of the others
with the counters of the blocks before. Clusters are looked for as rows come to a block, so not for rows that a quota does
not ask for or that their address, source or kind rules out. The first row of a block whose clusters were all known is
picked, so there are no more blocks than picks, steps and blocks of rows whose clusters were new.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill import config
from pressmill.functions import urls
from pressmill.operators.cluster import clusters_of, keyed, topic_clusters
from pressmill.operators.common import region_rank, top_per_group
from pressmill.operators.score import is_domestic, rank_columns, rank_key
from pressmill.session import cut_lineage

#: rows of a week that one task walks at once
BLOCK = 1000


def with_organisation(scored: DataFrame, sources: DataFrame) -> DataFrame:
    """The organisation behind a source; a source without one stands for itself."""
    org = sources.select(F.col("id").alias("source_id"), F.nullif("organization", F.lit("")).alias("_org"))
    return scored.join(org, "source_id", "left").withColumn("org", F.coalesce("_org", "source_id")).drop("_org")


@dataclass(frozen=True)
class Quota:
    """At least ``least`` selected rows for which ``condition`` holds, as far as there are such rows."""

    name: str
    condition: Callable[[], Column]
    least: int


def default_quotas(sel: config.Selection) -> list[Quota]:
    return [Quota("domestic", is_domestic, sel.min_domestic),
            Quota("attitudes", lambda: F.col("is_public_attitudes_or_communication"), sel.min_attitudes)]


def _group_columns(sel: config.Selection) -> dict[str, Column]:
    """The groups of a row and how many rows each takes: firm ones hold in every step, soft ones in strict steps.

    A copy is nothing special: its address or DOI is a group that is full. The cluster is one more firm group (``_with_cluster``).
    """
    def group(kind: str, value: Column, cap: int) -> Column:
        return F.struct(F.concat(F.lit(f"{kind} "), F.coalesce(value, F.lit(""))).alias("key"), F.lit(cap).alias("cap"))

    firm = [group("url", F.col("url_key"), 1),
            F.when(F.col("doi_key") != "", group("doi", F.col("doi_key"), 1))]
    soft = [group("org", F.col("org"), sel.max_per_org),
            *(F.when(F.col("source_type") == kind, group("type", F.lit(kind), cap)) for kind, cap in sel.type_caps().items())]
    both = {"firm": F.array_compact(F.array(*firm)), "soft": F.array_compact(F.array(*soft))}
    return {f"{name}_{part}": groups[part] for name, groups in both.items() for part in ("key", "cap")}  # a field of each struct


def _cluster_key() -> Column:
    return F.concat(F.lit("cluster "), F.col("cluster"))


def _with_cluster(rows: DataFrame, sel: config.Selection) -> DataFrame:
    return rows.withColumns({"firm_key": F.array_append("firm_key", _cluster_key()), "firm_cap": F.array_append("firm_cap", F.lit(sel.max_per_cluster))})


class _Picks:
    """The rows picked so far, as counters of their groups; ``load`` may come from earlier blocks."""

    def __init__(self, pdf: pd.DataFrame, load: dict[str, int] | None = None):
        self.firm, self.soft = ([list(zip(k, c)) for k, c in zip(pdf[f"{n}_key"], pdf[f"{n}_cap"])] for n in ("firm", "soft"))
        self.load = Counter(load or {})
        self.order: list[int] = []

    def run(self, strict: bool, wanted: list[bool], missing: int) -> bool:
        """One pass down the ranks until ``missing`` more of the ``wanted`` rows are picked; whether it got there."""
        for k in range(len(self.firm)):
            if missing <= 0:
                break
            groups = self.firm[k] + self.soft[k] if strict else self.firm[k]
            if not wanted[k] or any(self.load[key] >= cap for key, cap in groups):
                continue
            self.load.update(key for key, _ in self.firm[k] + self.soft[k])
            self.order.append(k)
            missing -= 1
        return missing <= 0


def _goals(sel: config.Selection, quotas: list[Quota]) -> list[int]:
    """Rows to reach: of each quota, then of all. Each has a strict step, and a lax one if that falls short."""
    return [*(q.least for q in quotas), sel.max_items]


def _first_block(goals: list[int]):
    """The picked rows of one week's best block, and whether more rows could give others."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank", kind="stable")
        picks, settled = _Picks(pdf), True
        for g, goal in enumerate(goals):
            wanted = [bool(f[g]) for f in pdf["flags"]]
            # a strict pass that reaches its goal has seen all rows it needs; a lax one follows only if it does not
            for strict in (True, False):
                if picks.run(strict, wanted, goal - sum(wanted[k] for k in picks.order)):
                    break
                settled = False
        chosen = pdf.iloc[picks.order]
        return pd.DataFrame({"scope": chosen["scope"] if len(chosen) else pdf["scope"].iloc[:1], "id": chosen["id"] if len(chosen) else None,
                             "done": settled or bool(pdf["whole"].iloc[0])})

    return run


_STATE = "scope string, step int, load map<string,int>, have array<int>, ids array<string>"


def _later_block(goals: list[int], block: int):
    """One step of one week over a block: the counters after it, and the step that comes next."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank", kind="stable")
        whole, pdf = len(pdf) <= block, pdf.iloc[:block]
        first = pdf.iloc[0]
        step, have = int(first["step"]), [int(n) for n in first["have"]]
        picks = _Picks(pdf, dict(first["load"]))
        reached = picks.run(step % 2 == 0, [True] * len(pdf), goals[step // 2] - have[step // 2])
        for k in picks.order:
            have = [n + bool(f) for n, f in zip(have, pdf["flags"].iloc[k])]
        ids = [*first["ids"], *pdf["id"].iloc[picks.order]]
        return pd.DataFrame({"scope": [first["scope"]], "step": [step + 1 if reached or whole else step], "load": [dict(picks.load)],
                             "have": [have], "ids": [ids]})

    return run


def _walk(rows: DataFrame, items: DataFrame, known: DataFrame, sel: config.Selection, goals: list[int], block: int) -> DataFrame:
    """scope and id of the picked rows, block by block. ``rows``: scope, id, rank, flags and the columns of groups.

    ``items``: the rows as clusters compare them (``cluster.keyed``); ``known``: scope, id, rank and cluster of some.
    """
    last = 2 * len(goals)
    state = cut_lineage(rows.select("scope").distinct().selectExpr(
        "scope", "0 AS step", "map_from_arrays(array(), array()) AS load", f"array_repeat(0, {len(goals)}) AS have", "array() AS ids"
    ).select(*(F.col(f.name).cast(f.dataType) for f in rows.sparkSession.createDataFrame([], _STATE).schema)))
    wanted = F.array(*[F.lit(g) for g in goals])
    goal_no = (F.col("step") / 2).cast("int")

    def free(name: str) -> Column:
        return ~F.exists(F.arrays_zip(f"{name}_key", f"{name}_cap"), lambda g: F.coalesce(
            F.try_element_at("load", g[f"{name}_key"]), F.lit(0)) >= g[f"{name}_cap"])

    while True:
        going = state.where(F.col("step") < last)
        if going.isEmpty():
            return state.select("scope", F.explode("ids").alias("id"))
        left = (rows.join(going, "scope").where((F.get("have", goal_no) < F.get(wanted, goal_no)) & F.get("flags", goal_no))
                .where(free("firm") & ((F.col("step") % 2 == 1) | free("soft")))
                .join(known.select("scope", "id", "cluster"), ["scope", "id"], "left")
                .where(F.coalesce(F.try_element_at("load", _cluster_key()), F.lit(0)) < sel.max_per_cluster))
        best = cut_lineage(top_per_group(left, ["scope"], [F.col("rank")], block + 1, salt_by="id"))
        asked = best.where("cluster is null").select("scope", "id")
        if not asked.isEmpty():
            known = cut_lineage(known.unionByName(clusters_of(asked, items, known, sel.cluster_threshold)))
            best = best.drop("cluster").join(known.select("scope", "id", "cluster"), ["scope", "id"])
        best = _with_cluster(best, sel)
        moved = best.groupBy("scope").applyInPandas(_later_block(goals, block), _STATE).withColumn("_moved", F.lit(True))
        after = going.join(moved.select("scope", F.struct("step", "load", "have", "ids").alias("_to")), "scope", "left")
        # a step without any row left is over, also one whose goal is met
        state = cut_lineage(state.where(F.col("step") >= last).unionByName(after.select(
            "scope", F.coalesce("_to.step", F.col("step") + 1).alias("step"),
            *(F.coalesce(f"_to.{c}", c).alias(c) for c in ("load", "have", "ids")))))


def select_balanced(scored: DataFrame, sel: config.Selection = config.Selection(), scope: str = "week",
                    block: int = BLOCK, quotas: list[Quota] | None = None) -> DataFrame:
    """The selected rows of every week. ``scored`` holds score columns, final_score and ``org``.

    ``quotas`` (by default domestic focus and public attitudes) are filled in their order before the rest. No task
    walks more than ``block`` rows.
    """
    quotas = default_quotas(sel) if quotas is None else quotas
    goals = _goals(sel, quotas)
    pool = cut_lineage(scored.where(F.col("relevance") >= sel.min_relevance).select(
        F.col(scope).cast("string").alias("scope"), F.col("id").cast("string").alias("id"), "org", "source_type",
        F.array(*(F.coalesce(q.condition(), F.lit(False)) for q in quotas), F.lit(True)).alias("flags"),
        urls.normalize_url(F.col("url")).alias("url_key"), F.lower(F.coalesce("doi", F.lit(""))).alias("doi_key"),
        rank_key().alias("rank"), "title", "title_cs", "url", "doi", "final_score", "cz_impact", "published_at",
        "first_seen"))

    rows = pool.select("scope", "id", "rank", "flags", *(c.alias(n) for n, c in _group_columns(sel).items()))
    sizes = pool.groupBy("scope").agg((F.count("*") <= block).alias("whole"))
    best = cut_lineage(top_per_group(pool, ["scope"], [F.col("rank")], block, salt_by="id"))
    known = cut_lineage(topic_clusters(best, sel.cluster_threshold, scope="scope").join(best.select("scope", "id", "rank"), ["scope", "id"])
                        .select("scope", "id", "rank", "cluster"))
    clustered = _with_cluster(rows.join(known.select("scope", "id", "cluster"), ["scope", "id"]), sel)
    first = cut_lineage(clustered.join(sizes, "scope").groupBy("scope").applyInPandas(
        _first_block(goals), "scope string, id string, done boolean"))
    picked = first.where("done and id is not null").select("scope", "id")
    waiting = first.where("not done").select("scope").distinct()
    if not waiting.isEmpty():
        open_pool = cut_lineage(pool.join(waiting, "scope", "left_semi"))
        picked = picked.unionByName(_walk(cut_lineage(rows.join(waiting, "scope", "left_semi")), keyed(open_pool, "scope"),
                                          known.join(waiting, "scope", "left_semi"), sel, goals, block))
    on = ((F.col(scope).cast("string") == F.col("_scope")) & (F.col("id").cast("string") == F.col("_id")))
    keys = picked.select(F.col("scope").alias("_scope"), F.col("id").alias("_id"))
    return scored.join(keys, on, "left_semi")


def presentation_order(selected: DataFrame) -> DataFrame:
    """Domestic focus first, then by rank."""
    return selected.orderBy(F.when(region_rank(F.col("geo_focus")) == 0, 0).otherwise(1), *rank_columns())
