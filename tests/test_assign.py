import random

import pytest

from ledgerlink.config import ReconConfig
from ledgerlink.operators import assign
from ledgerlink.operators.assign import greedy_assignment, logged_decisions

SCHEMA = "run_id string, erp_id string, bank_ref string, erp_ord bigint, rank int"


def in_sequence(edges):
    taken, kept, logged = set(), set(), set()
    for run, erp, bank, order, rank in sorted(edges, key=lambda e: (e[0], e[3], e[4])):
        if (run, "e", erp) in taken or (run, "b", bank) in taken:
            continue
        logged.add((run, erp, bank, order, rank))
        kept.add((run, erp, bank, order, rank))
        taken |= {(run, "e", erp), (run, "b", bank)}
    return kept, logged


def assigned(spark, edges, **knobs):
    frame = spark.createDataFrame(edges, SCHEMA)
    return {tuple(r) for r in greedy_assignment(frame, ReconConfig(**knobs)).collect()}


def random_edges(seed, n, banks, k, ids=None):
    rng = random.Random(seed)
    return [
        (run, f"e{rng.randrange(ids) if ids else i}", f"b{b}", i, rank)
        for run in ("x", "y")
        for i in range(n)
        for rank, b in enumerate(rng.sample(range(banks), k), 1)
    ]


@pytest.mark.parametrize(
    "seed, n, banks, k, ids",
    [(1, 40, 40, 2, None), (2, 60, 10, 3, None), (3, 60, 3, 2, None), (4, 50, 25, 2, 20)],
)
@pytest.mark.parametrize("knobs", [{}, {"assignment_rounds": 1}])
def test_equals_the_sequential_scan(spark, seed, n, banks, k, ids, knobs):
    edges = random_edges(seed, n, banks, k, ids)
    assert assigned(spark, edges, **knobs) == in_sequence(edges)[0]


def chain(length):
    edges = [("r", "e0", "b0", 0, 1)]
    for i in range(1, length):
        edges += [("r", f"e{i}", f"b{i - 1}", i, 1), ("r", f"e{i}", f"b{i}", i, 2)]
    return edges


def ladder(length):
    """Chains that share statement records: many pairs have two rivals."""
    edges = []
    for i in range(length):
        edges += [("r", f"e{i}", f"b{max(0, i - 2)}", i, 1), ("r", f"e{i}", f"b{max(0, i - 1)}", i, 2), ("r", f"e{i}", f"b{i}", i, 3)]
    return [e for n, e in enumerate(edges) if all(e[1:3] != f[1:3] for f in edges[max(0, n - 3):n])]


@pytest.mark.parametrize("edges", [chain(60), ladder(30), chain(9) + [("r", f"x{i}", "b4", 100 + i, 1) for i in range(40)]])
def test_chains_longer_than_the_rounds(spark, edges):
    assert assigned(spark, edges, assignment_rounds=1) == in_sequence(edges)[0]


def test_a_long_chain_takes_few_steps(spark, monkeypatch):
    written = []
    cut = assign.cut_lineage
    monkeypatch.setattr(assign, "cut_lineage", lambda df: written.append(1) or cut(df))
    edges = chain(50_000)  # 99,999 pairs, each of which waits for the one before
    assert assigned(spark, edges, assignment_rounds=1) == in_sequence(edges)[0]
    assert len(written) < 30


def test_no_edges(spark):
    assert assigned(spark, []) == set()


def test_decisions_are_logged_while_both_records_are_open(spark):
    edges = random_edges(5, 30, 15, 2)
    frame = spark.createDataFrame(edges, SCHEMA)
    eligible = frame.where("erp_ord % 3 <> 0")
    won = greedy_assignment(eligible)
    logged = {tuple(r) for r in logged_decisions(frame, won).select(frame.columns).collect()}
    taken, expected = set(), set()
    for edge in sorted(edges, key=lambda e: (e[0], e[3], e[4])):
        run, erp, bank, order, _ = edge
        if (run, "e", erp) in taken or (run, "b", bank) in taken:
            continue
        expected.add(edge)
        if order % 3:
            taken |= {(run, "e", erp), (run, "b", bank)}
    assert logged == expected
