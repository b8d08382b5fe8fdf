"""One-to-one assignment of candidate pairs and the log of decisions made."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.config import ReconConfig
from ledgerlink.session import cut_lineage

PAIR = ["run_id", "erp_id", "bank_ref"]
_EDGE = [*PAIR, "erp_ord", "rank"]


def greedy_assignment(edges: DataFrame, config: ReconConfig | None = None) -> DataFrame:
    """Accept pairs in (ledger order, rank) order, each record at most once.

    Equals the sequential scan, without one. Every ledger record proposes its
    earliest open pair, every statement record holds its earliest proposal and
    all later pairs of a held record close. When a round closes nothing, the
    proposals are the assignment. Both steps are aggregations with map-side
    combine, so a statement row wanted by a third of the ledger is no hot spot.

    Chains of displacement can need many such rounds. After
    ``assignment_rounds`` of them the pairs that nothing precedes are accepted,
    and with them every pair whose fate hangs on one other pair each: such a
    chain is followed by pointer doubling, in as many steps as its length has
    binary digits. What is left goes on. No step gathers the rest in one task.
    """
    config = config or ReconConfig()
    open_pairs = cut_lineage(edges.select(*_EDGE))
    n_open = open_pairs.count()
    accepted = []
    while True:
        for _ in range(config.assignment_rounds):
            narrowed = cut_lineage(_close_later_pairs(open_pairs))
            n_left = narrowed.count()
            open_pairs, stable = narrowed, n_left == n_open
            n_open = n_left
            if stable:
                return _union(accepted, _proposals(open_pairs))
        settled = cut_lineage(_settled(open_pairs))
        accepted.append(settled)
        open_pairs = cut_lineage(_untouched(open_pairs, settled))
        n_open = open_pairs.count()


def _union(parts: list[DataFrame], last: DataFrame) -> DataFrame:
    for part in parts:
        last = part.select(*_EDGE).unionByName(last)
    return last


def _proposals(open_pairs: DataFrame) -> DataFrame:
    earliest = F.min(F.struct("erp_ord", "rank", "bank_ref")).alias("p")
    return open_pairs.groupBy("run_id", "erp_id").agg(earliest).select(
        "run_id", "erp_id", "p.bank_ref", "p.erp_ord", "p.rank"
    )


def _held(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("run_id", "bank_ref").agg(
        F.min(F.struct("erp_ord", "rank")).alias("held")
    )


def _close_later_pairs(open_pairs: DataFrame) -> DataFrame:
    held = _held(_proposals(open_pairs))
    return (
        open_pairs.join(held, ["run_id", "bank_ref"], "left")
        .where(F.col("held").isNull() | (F.struct("erp_ord", "rank") <= F.col("held")))
        .select(*_EDGE)
    )


def _first_two(pairs: DataFrame, side: str) -> DataFrame:
    """The first and second open pair of each record of a side; null where there is no second."""
    key = ["run_id", side]
    order = F.struct("erp_ord", "rank")
    first = pairs.groupBy(*key).agg(F.min(order).alias(f"{side}_1"))
    second = (
        pairs.join(first, key).where(order > F.col(f"{side}_1")).groupBy(*key).agg(F.min(order).alias(f"{side}_2"))
    )
    return first.join(second, key, "left")


def _settled(open_pairs: DataFrame) -> DataFrame:
    """Open pairs that are certain: those without an earlier rival, and all that follow from them.

    A pair that is first at one of its records and second at the other has one
    rival, the first there, and is accepted if and only if that one is not.
    """
    order = F.struct("erp_ord", "rank")
    placed = open_pairs
    for side in ("erp_id", "bank_ref"):
        placed = placed.join(_first_two(open_pairs, side), ["run_id", side])
    leads = {side: order == F.col(f"{side}_1") for side in ("erp_id", "bank_ref")}
    follows = {side: order == F.col(f"{side}_2") for side in ("erp_id", "bank_ref")}
    rival = (
        F.when(leads["erp_id"] & follows["bank_ref"], F.col("bank_ref_1"))
        .when(leads["bank_ref"] & follows["erp_id"], F.col("erp_id_1"))
    )
    placed = cut_lineage(placed.select(*_EDGE, (leads["erp_id"] & leads["bank_ref"]).alias("sure"), rival.alias("rival")))
    sure = placed.where("sure").select(*_EDGE)
    linked = placed.where("rival is not null").select("run_id", order.alias("at"), "rival")
    chained = _end_of_chains(linked)
    if chained is None:
        return sure
    ends = sure.select("run_id", order.alias("end"))
    won = chained.where("not odd").join(ends, ["run_id", "end"]).select("run_id", F.col("at.erp_ord"), F.col("at.rank"))
    return sure.unionByName(placed.select(*_EDGE).join(won, ["run_id", "erp_ord", "rank"]).select(*_EDGE))


def _end_of_chains(linked: DataFrame) -> DataFrame | None:
    """(run_id, at, end, odd): where the chain of rivals of each pair ends, and if its length is odd.

    ``linked`` (run_id, at, rival) has one row per pair with a single rival. Each
    step doubles the distance covered, and only pairs still on their way move.
    """
    known = linked.select("run_id", F.col("at").alias("end"), F.lit(True).alias("on"))
    paths = cut_lineage(
        linked.select("run_id", "at", F.col("rival").alias("end"), F.lit(True).alias("odd"))
        .join(known, ["run_id", "end"], "left").withColumn("on", F.coalesce("on", F.lit(False)))
    )
    if paths.isEmpty():
        return None
    while not paths.where("on").isEmpty():
        ahead = paths.select(
            "run_id", F.col("at").alias("end"), F.col("end").alias("next"),
            F.col("odd").alias("more"), F.col("on").alias("further"),
        )
        moved = paths.where("on").join(ahead, ["run_id", "end"]).select(
            "run_id", "at", F.col("next").alias("end"), (F.col("odd") != F.col("more")).alias("odd"),
            F.col("further").alias("on"),
        )
        paths = cut_lineage(paths.where("not on").select("run_id", "at", "end", "odd", "on").unionByName(moved))
    return paths


def _untouched(open_pairs: DataFrame, settled: DataFrame) -> DataFrame:
    for side in ("erp_id", "bank_ref"):
        open_pairs = open_pairs.join(
            settled.select("run_id", side), ["run_id", side], "left_anti"
        )
    return open_pairs.select(*_EDGE)


def judged_decisions(decisions: DataFrame, assigned: DataFrame) -> DataFrame:
    """Decisions with ``logged``: whether both records were still open when their turn came."""
    order = F.struct("erp_ord", "rank")
    for side in ("erp_id", "bank_ref"):
        taken = assigned.groupBy("run_id", side).agg(
            F.min(F.struct("erp_ord", "rank")).alias(f"{side}_taken")
        )
        decisions = decisions.join(taken, ["run_id", side], "left")
    still_open = [
        F.col(f"{side}_taken").isNull() | (order <= F.col(f"{side}_taken"))
        for side in ("erp_id", "bank_ref")
    ]
    logged = F.coalesce(still_open[0] & still_open[1], F.lit(False))
    return decisions.withColumn("logged", logged).drop("erp_id_taken", "bank_ref_taken")


def logged_decisions(decisions: DataFrame, assigned: DataFrame) -> DataFrame:
    """Decisions whose two records were both still open when their turn came."""
    return judged_decisions(decisions, assigned).where("logged").drop("logged")
