"""Candidates against a plain loop over all pairs, on small data."""

import random
import re
from datetime import date, timedelta
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlink.config import ReconConfig
from ledgerlink.operators import candidates, nearest
from ledgerlink.operators.candidates import top_candidates

STOP = {"pvt", "ltd", "settlement", "payout"}


def tokens(text, fold):
    text = (text or "").lower() if fold else text or ""
    return {w for w in re.findall("[a-z0-9]+", text) if len(w) > 2 and w not in STOP}


def brute_force(erp_rows, bank_rows, k, fold):
    best = set()
    for e, (_, d, m, a, _, t) in enumerate(erp_rows):
        if a is None:
            continue
        names, scored = tokens(m, fold), []
        for b, (_, bd, text, net, fee) in enumerate(bank_rows):
            if net is None:
                continue
            overlap = len(names & tokens(text, fold))
            delta = float(abs(a + (t or 0) - (fee or 0) - net))
            if overlap == 0 and delta > 50:
                continue
            days = 30 if d is None or bd is None else abs((d - bd).days)
            score = (
                overlap / max(len(names), 1) * 0.55
                + 1 / (1 + delta) * 0.30
                + 1 / (1 + days) * 0.15
            )
            scored.append((-score, b))
        best |= {(e, b, r + 1) for r, (_, b) in enumerate(sorted(scored)[:k])}
    return best


def check(ledger, statement, erp_rows, bank_rows, k=2, fold=False, **knobs):
    config = ReconConfig(max_candidates=k, fold_case=fold, **knobs)
    found = top_candidates(ledger(erp_rows), statement(bank_rows), config)
    got = [(r.erp_ord, r.bank_ord, r["rank"]) for r in found.collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_force(erp_rows, bank_rows, k, fold)


def random_rows(seed, n, words, cents, days, blanks=0.05):
    rng = random.Random(seed)
    start = date(2024, 1, 1)

    def a_day():
        return None if rng.random() < blanks else start + timedelta(rng.randrange(days))

    def text():
        return " ".join(rng.sample(words, rng.randint(0, min(3, len(words)))))

    def amount():
        return Decimal(rng.randrange(cents)) / 100

    erp = [(f"E{i}", a_day(), text(), amount(), "INR", amount() / 10) for i in range(n)]
    bank = [(f"B{i}", a_day(), text(), amount(), amount() / 10) for i in range(n)]
    quant = Decimal("0.0001")
    erp = [(*r[:3], r[3].quantize(quant), r[4], r[5].quantize(quant)) for r in erp]
    bank = [(*r[:3], r[3].quantize(quant), r[4].quantize(quant)) for r in bank]
    return erp, bank


WORDS = ["india", "shop", "green", "basket", "Cloud", "x1", "ltd"]


@pytest.mark.parametrize("fold", [False, True])
def test_pairs_of_ordinary_groups(ledger, statement, fold):
    check(ledger, statement, *random_rows(1, 120, WORDS, 100_000, 40), fold=fold)


@pytest.mark.parametrize(
    "seed, words, cents, days, k",
    [
        (2, ["india"], 3_000, 5, 2),  # dense amounts and days
        (3, ["india", "shop"], 3_000_000, 5, 2),  # sparse amounts
        (4, WORDS, 20_000, 900, 3),  # sparse days
        (5, ["india", "shop", "green"], 30, 3, 1),  # many ties
        (6, ["india"], 50_000_000, 3_000, 2),  # sparse in both
    ],
)
def test_hot_groups_give_the_same_result(ledger, statement, seed, words, cents, days, k):
    rows = random_rows(seed, 150, words, cents, days)
    check(ledger, statement, *rows, k=k, hot_group_rows=4)


def test_hot_group_far_from_every_date(ledger, statement):
    erp, bank = random_rows(7, 60, ["india"], 4_000, 3, blanks=0)
    later = timedelta(700)
    bank = [(b, d + later, *rest) for b, d, *rest in bank]
    check(ledger, statement, erp, bank, hot_group_rows=2)


def test_copies_of_one_row(ledger, statement):
    erp = [(f"E{i}", date(2024, 1, 1), "india shop", Decimal("10"), "INR", None) for i in range(40)]
    bank = [(f"B{i}", date(2024, 1, 2), "india", Decimal("10"), None) for i in range(40)]
    check(ledger, statement, erp, bank, hot_group_rows=4)
    check(ledger, statement, erp, bank)


@pytest.mark.parametrize("worn, k", [(8, 2), (10, 3)])
def test_names_of_many_hot_tokens(ledger, statement, worn, k):
    words = [f"word{i}" for i in range(11)]
    rng = random.Random(8)
    start = date(2024, 1, 1)

    def text():
        return " ".join(rng.sample(words, worn))

    erp = [(f"E{i}", start + timedelta(i % 9), text(), Decimal(rng.randrange(9000)), "INR", None) for i in range(40)]
    bank = [(f"B{i}", start + timedelta(i % 7), text(), Decimal(rng.randrange(9000)), None) for i in range(40)]
    check(ledger, statement, erp, bank, k=k, hot_group_rows=3)


def test_a_name_whose_tokens_are_hot_in_other_numbers(ledger, statement):
    """Ten hot tokens asked for, statement rows hold any number of them."""
    words = [f"word{i}" for i in range(10)]
    rng = random.Random(18)
    start = date(2024, 1, 1)
    some = lambda: " ".join(rng.sample(words, rng.randrange(11)))
    erp = [(f"E{i}", start + timedelta(i % 40), " ".join(words) if i % 2 else some(), Decimal(rng.randrange(90)), "INR", None) for i in range(50)]
    bank = [(f"B{i}", start + timedelta(i % 37), some(), Decimal(rng.randrange(90)), None) for i in range(90)]
    check(ledger, statement, erp, bank, hot_group_rows=3)


def test_ranges_of_one_group_are_even(spark, monkeypatch):
    monkeypatch.setattr(nearest, "RANGE_ROWS", 2_000)
    points = spark.range(20_000).selectExpr(
        "'r' AS run_id", "'one' AS grp", "int(id % 3) AS list", "id * id % 977 AS px", "id AS bank_ord", "int(id % 3) AS pday"
    )
    asked = spark.range(20_000).selectExpr(
        "'r' AS run_id", "id AS erp_ord", "'one' AS grp", "0D AS base", "5L AS x", "int(id % 3) AS day", "int(id % 3) AS list"
    )
    sizes = []
    ranges = nearest._sorted_ranges
    monkeypatch.setattr(nearest, "_sorted_ranges", lambda e: sizes.append(ranges(e)) or sizes[-1])
    found = nearest.neighbours(asked, points, 2)
    of = {day: sorted(x * x % 977 for x in range(20_000) if x % 3 == day) for day in range(3)}
    for day, near in found.groupBy("day").agg(F.collect_set("px")).collect():
        below, above = [x for x in of[day] if x <= 5], [x for x in of[day] if x > 5]
        assert set(near) <= set(below[-2:] + above[:2] + [5])
    assert found.groupBy("erp_ord").count().where("count <> 4").isEmpty()
    rows = sorted(r[0] for r in sizes[0].groupBy(F.spark_partition_id()).agg(F.count("*")).select("count(1)").collect())
    assert len(rows) >= 20 and rows[-1] < 2 * rows[len(rows) // 2]


def test_band_edge_is_included(ledger, statement):
    erp = [("E", date(2024, 1, 1), "aaa", Decimal("100"), "INR", Decimal("0"))]
    bank = [
        ("IN", date(2024, 1, 1), "bbb", Decimal("150.00"), Decimal("0")),
        ("OUT", date(2024, 1, 1), "bbb", Decimal("150.01"), Decimal("0")),
        ("LOW", date(2024, 1, 1), "bbb", Decimal("50.00"), Decimal("0")),
    ]
    check(ledger, statement, erp, bank, k=5)


def test_negative_amounts(ledger, statement):
    erp, bank = random_rows(9, 80, ["india"], 3_000, 4)
    erp = [(*r[:3], r[3] - 15, *r[4:]) for r in erp]
    bank = [(*r[:3], r[3] - 15, *r[4:]) for r in bank]
    check(ledger, statement, erp, bank, hot_group_rows=4)
    check(ledger, statement, erp, bank)


def test_runs_do_not_mix(spark, ledger, statement):
    erp, bank = random_rows(10, 30, WORDS, 5_000, 10)
    both_l = ledger(erp, "a").unionByName(ledger(erp[:15], "b"))
    both_s = statement(bank[:20], "a").unionByName(statement(bank, "b"))
    for hot in (512, 3):
        found = top_candidates(both_l, both_s, ReconConfig(hot_group_rows=hot)).collect()
        for run, e, b in (("a", erp, bank[:20]), ("b", erp[:15], bank)):
            got = {(r.erp_ord, r.bank_ord, r["rank"]) for r in found if r.run_id == run}
            assert got == brute_force(e, b, 2, False)


def test_a_one_sided_hot_token_and_a_far_date(ledger, statement):
    rng = random.Random(11)
    start = date(2024, 1, 1)
    erp = [(f"E{i}", start + timedelta(i), "common name", Decimal(rng.randrange(1, 500)), "INR", None) for i in range(3)]
    bank = [
        (f"B{i}", start + timedelta(rng.randrange(300)), "common", Decimal(rng.randrange(1, 500)), None) for i in range(80)
    ]
    bank.append(("B-far", date(2099, 12, 31), "common", Decimal("250"), None))
    check(ledger, statement, erp, bank, hot_group_rows=10)


def test_hot_joins_are_equality_joins(spark, ledger, statement):
    config = ReconConfig(hot_group_rows=2)
    erp = candidates.ledger_features(ledger([(f"E{i}", "2024-01-01", "common name", i, "INR", 0) for i in range(9)]), config)
    bank = candidates.statement_features(statement([(f"B{i}", "2024-01-01", "common", i, 0) for i in range(9)]), config)
    ways = (candidates.TOKEN, candidates.BAND)
    erp_keys = candidates._keyed(erp, "erp_tokens", "gross", 1, ways)
    bank_keys = candidates._keyed(bank, "bank_tokens", "settled", 0, ways)
    hot = candidates._hot_groups(erp_keys, bank_keys, 2)
    frames = (
        candidates._paired(erp_keys, bank_keys),
        candidates._nearest_by_tokens(erp, bank, erp_keys, bank_keys, hot, config),
        candidates._nearest_in_band(erp_keys, bank_keys, hot, erp, bank, config),
    )
    for frame in frames:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_many_buckets_of_middle_size_are_searched(ledger, statement):
    """No bucket is hot by itself, yet all together have many pairs a row."""
    rng = random.Random(21)
    start = date(2024, 1, 1)
    cents = lambda: Decimal(rng.randrange(150_000)) / 100
    erp = [(f"E{i}", start + timedelta(rng.randrange(900)), f"buyer{i}", cents(), "INR", None) for i in range(1200)]
    bank = [(f"B{i}", start + timedelta(rng.randrange(900)), f"payer{i}", cents(), None) for i in range(1200)]
    config = ReconConfig(hot_group_rows=60)
    pairs = candidates.plausible_pairs(
        candidates.ledger_features(ledger(erp), config), candidates.statement_features(statement(bank), config), config
    )
    assert pairs.count() <= 2 * 1200 * config.max_candidates
    check(ledger, statement, erp, bank, hot_group_rows=60)


def test_names_count_among_the_pairs_of_a_searched_band(ledger, statement):
    rng = random.Random(22)
    start = date(2024, 1, 1)
    names = [f"name{i}" for i in range(12)]
    erp = [(f"E{i}", start, rng.choice(names), Decimal(rng.randrange(9000)) / 100, "INR", None) for i in range(80)]
    bank = [(f"B{i}", start, rng.choice(names), Decimal(rng.randrange(9000)) / 100, None) for i in range(80)]
    config = ReconConfig(hot_group_rows=3)
    pairs = candidates.plausible_pairs(
        candidates.ledger_features(ledger(erp), config), candidates.statement_features(statement(bank), config), config,
        (candidates.BAND,),
    )
    got = {(r.erp_ord, r.bank_ord, r["rank"], r.overlap) for r in candidates.rank_pairs(pairs, 2).collect()}
    want = set()
    for e, (_, _, name, amount, _, _) in enumerate(erp):
        near = sorted(
            (-((n == name) * 0.55 + 1 / (1 + float(abs(amount - net))) * 0.30), b, int(n == name))
            for b, (_, _, n, net, _) in enumerate(bank) if abs(amount - net) <= 50
        )[:2]
        want |= {(e, b, r + 1, same) for r, (_, b, same) in enumerate(near)}
    assert got == want


def test_rows_that_repeat_a_record_are_searched_as_one(ledger, statement):
    rng = random.Random(23)
    start = date(2024, 1, 1)
    erp = [(f"E{i}", start + timedelta(i % 5), "common", Decimal(rng.randrange(900)), "INR", None) for i in range(20)]
    bank = [(f"B{i}", start + timedelta(i % 7), "common", Decimal(rng.randrange(900)), None) for i in range(40)]
    twice = statement(bank).unionByName(statement(bank).where("row_ord % 9 = 0"))
    found = [
        {tuple(r) for r in top_candidates(ledger(erp), twice, ReconConfig(hot_group_rows=hot)).select("erp_ord", "bank_ord", "rank").collect()}
        for hot in (5, 1000)
    ]
    assert found[0] == found[1]
    assert {r for r in found[0] if r[2] <= 2} == brute_force(erp, bank, 2, False)


def test_a_key_hands_on_its_best_pairs_only(spark, ledger, statement):
    config = ReconConfig(max_candidates=2)
    erp = candidates.ledger_features(ledger([("E", "2024-01-01", "alpha beta", 100, "INR", 0)]), config)
    rows = [(f"B{i}", "2024-01-01", "alpha" if i % 2 else "beta", 100 + i, 0) for i in range(40)]
    bank = candidates.statement_features(statement(rows), config)
    keyed = [candidates._keyed(side, tokens, amount, 0, ("t",)) for side, tokens, amount in (
        (erp, "erp_tokens", "gross"), (bank, "bank_tokens", "settled")
    )]
    nothing = spark.createDataFrame([], "run_id string, key string")
    pairs = candidates._paired_or_searched(erp, bank, *keyed, nothing, config)
    assert sorted(r.bank_ord for r in pairs.collect()) == [0, 1, 2, 3]


def test_far_amounts_are_searched_by_their_days(monkeypatch):
    """A question whose amounts are far apart meets the points of the nearest days, not all of its group."""
    rng = random.Random(24)
    points, n = [(rng.randrange(10**10), i, rng.randrange(300)) for i in range(3000)], 200
    asked = [(rng.randrange(10**10), i, rng.randrange(300)) for i in range(n)]
    table = lambda rows: pa.table({
        "run_id": ["r"] * len(rows), "grp": ["g"] * len(rows),
        **{c: pa.array([row[i] for row in rows], pa.int32() if c == "day" else pa.int64()) for i, c in enumerate(("x", "ord", "day"))},
    })
    met, value = [], nearest._amount_value
    monkeypatch.setattr(nearest, "_amount_value", lambda delta: met.append(len(delta)) or value(delta))
    questions = table(asked).append_column("base", pa.array([0.0] * n))
    _, _, rows, places, _ = nearest._best_points(questions, table(points), 2, None, nearest.np.arange(300))
    assert sum(met) < 100 * n
    worth = lambda x, day, p: 0.3 / (1 + abs(x - p[0]) / 10_000) + 0.15 / (1 + abs(day - p[2]))
    want = {(q, i) for x, q, day in asked for i in sorted(range(3000), key=lambda i: (-worth(x, day, points[i]), i))[:2]}
    assert set(zip(rows.tolist(), places.tolist())) == want


def test_buckets_of_some_rows_are_searched(ledger, statement):
    """Fifteen rows a bucket are forty-five pairs a row, as every row has three buckets."""
    rng = random.Random(25)
    start, n = date(2024, 1, 1), 6000
    cents = lambda: Decimal(rng.randrange(2_000_000)) / 100
    erp = ledger([(f"E{i}", start + timedelta(rng.randrange(900)), f"buyer{i}", cents(), "INR", None) for i in range(n)])
    bank = statement([(f"B{i}", start + timedelta(rng.randrange(900)), f"payer{i}", cents(), None) for i in range(n)])
    searched, paired = ReconConfig(hot_group_rows=60), ReconConfig(hot_group_rows=1000)
    pairs = candidates.plausible_pairs(
        candidates.ledger_features(erp, searched), candidates.statement_features(bank, searched), searched
    )
    assert pairs.count() <= 2 * n * searched.max_candidates
    found = [{tuple(r) for r in top_candidates(erp, bank, c).collect()} for c in (searched, paired)]
    assert found[0] == found[1]
