import pytest

from ledgerlink.operators.exact import (
    duplicate_keys,
    exact_false_positives,
    exact_matches,
    extracted_ids,
    found_ids,
    unresolved_ledger,
    unresolved_statement,
)

DAY = "2024-01-01"


def ids(ledger, statement, known, texts):
    led = ledger([(i, DAY, "m", 10, "INR", 0) for i in known])
    bank = statement([(f"B{n}", DAY, t, 10, 0) for n, t in enumerate(texts)])
    rows = extracted_ids(led, bank).collect()
    return {r.row_ord: r.id_text for r in rows}


@pytest.mark.parametrize(
    "text, found",
    [
        ("pay ERP-1 now", "ERP-1"),
        ("pay (ERP-1), now", "ERP-1"),
        ("pay erp-1 now", "erp-1"),
        ("XERP-1", None),
        ("ERP-1-A", None),
        ("ERP-10", None),
        ("_ERP-1", None),
        ("ERP-1 and ERP-2", None),
        ("ERP-1 and ERP-1", "ERP-1"),
        ("ERP-1 and erp-1", "erp-1"),
        ("erp-1/ERP-1", "ERP-1"),
        ("", None),
        (None, None),
    ],
)
def test_id_in_text(ledger, statement, text, found):
    got = ids(ledger, statement, ["ERP-1", "ERP-2"], [text])
    assert got.get(0) == found


@pytest.mark.parametrize(
    "known, text, found",
    [
        (["INV/7"], "for INV/7 paid", "INV/7"),
        (["INV/7"], "for inv/7, paid", "inv/7"),
        (["INV/7"], "XINV/7", None),
        (["INV/7"], "INV/70", None),
        (["INV/7"], "INV 7", None),
        (["#7"], "ref #7.", "#7"),
        (["#7"], "ref A#7", None),
        (["7#"], "ref 7#A", None),
        (["A B", "C"], "x A B y", "A B"),
        # At one place the identifier listed first wins and hides what follows.
        (["INV", "INV/7"], "INV/7", "INV"),
        (["INV/7", "INV"], "INV/7", "INV/7"),
        (["INV/7", "7/INV"], "INV/7/INV", "INV/7"),
    ],
)
def test_id_with_separators(ledger, statement, known, text, found):
    assert ids(ledger, statement, known, [text]).get(0) == found


def pairs(ledger, statement, erp, bank):
    led = ledger([(i, DAY, "m", a, "INR", 0) for i, a in erp])
    st = statement([(f"B{n}", DAY, t, a, 0) for n, (t, a) in enumerate(bank)])
    found = exact_matches(led, st)
    return {(r.erp_id, r.bank_ref) for r in found.collect()}, found, led, st


def test_amount_must_be_equal_to_four_decimals(ledger, statement):
    got, *_ = pairs(ledger, statement, [("A-1", 10), ("A-2", 10)], [("A-1", 10), ("A-2", 10.001)])
    assert got == {("A-1", "B0")}


def test_spelling_must_agree(ledger, statement):
    got, *_ = pairs(ledger, statement, [("A-1", 10)], [("a-1", 10)])
    assert got == set()


def test_key_used_twice_on_either_side_is_left_out(ledger, statement):
    erp = [("A-1", 10), ("A-1", 10), ("A-2", 5), ("A-3", 7), ("A-3", 8)]
    bank = [("A-1", 10), ("A-2", 5), ("A-2", 5), ("A-3", 7), ("A-3", 8)]
    got, *_ = pairs(ledger, statement, erp, bank)
    assert got == {("A-3", "B3"), ("A-3", "B4")}


def test_missing_ids_and_amounts_never_match(ledger, statement):
    got, *_ = pairs(ledger, statement, [(None, 10), ("A-1", None), ("", 3)], [("x", 10), ("A-1", None)])
    assert got == set()


def test_empty_sides_leave_everything_unresolved(ledger, statement):
    got, found, led, st = pairs(ledger, statement, [], [("A-1", 10)])
    assert got == set()
    assert unresolved_statement(st, found).count() == 1
    got, found, led, st = pairs(ledger, statement, [("A-1", 10)], [])
    assert got == set()
    assert unresolved_ledger(led, found).count() == 1


def test_false_positives_and_duplicates(spark, ledger, statement):
    _, found, led, st = pairs(
        ledger, statement, [("A-1", 1), ("A-2", 2), ("A-2", 3)], [("A-1", 1), ("A-2", 2)]
    )
    truth = spark.createDataFrame(
        [("run", "A-1", "B0", "exact"), ("run", "A-2", "B1", "fuzzy_name")],
        "run_id string, erp_id string, bank_ref string, match_type string",
    )
    wrong = exact_false_positives(found, truth, led, st).collect()
    assert [(r.erp_id, r.bank_ref, r.description) for r in wrong] == [("A-2", "B1", "A-2")]
    twice = duplicate_keys(led, st).collect()
    assert [(r.dataset, r.record_id, r.n_rows) for r in twice] == [("erp", "A-2", 2)]


def test_ids_of_many_sizes_take_one_scan(spark, ledger, statement):
    """Fifty numbers of pieces, beside a run of plain identifiers only."""
    known = ["/".join(f"p{n}x{k}" for k in range(n)) for n in range(1, 51)]
    texts = [f"for {k}, paid" for k in known] + [f"{k}/" for k in known[:3]] + ["p50x0/p50x1", "X" + known[4], "//"]
    led = ledger([(k, DAY, "m", 10, "INR", 0) for k in [*known, "//"]], "odd").unionByName(
        ledger([(f"A-{i}", DAY, "m", 10, "INR", 0) for i in range(9)], "plain")
    )
    bank = statement([(f"B{n}", DAY, t, 10, 0) for n, t in enumerate(texts)], "odd").unionByName(
        statement([(f"C{i}", DAY, f"a-{i} and / p1x0", 10, 0) for i in range(12)], "plain")
    )
    rows = extracted_ids(led, bank)
    got = {(r.run_id, r.row_ord): r.id_text for r in rows.collect()}
    want = {("odd", n): k for n, k in enumerate(known)} | {("odd", 50 + n): known[n] for n in range(3)}
    want |= {("odd", 55): "//"} | {("plain", i): f"a-{i}" for i in range(9)}
    assert got == want
    plan = found_ids(led, spark.createDataFrame(bank.collect(), bank.schema).repartition(3))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") + plan.count("Repartition ") == 1


def test_hot_first_piece(ledger, statement):
    known = [f"INV/{i}" for i in range(40)] + ["INV", "INV/7/x"]
    found = ids(ledger, statement, known, [f"INV/{i}" for i in range(40)] + ["INV/7/x", "INV 9"])
    assert found == {**{i: f"INV/{i}" for i in range(40)}, 40: "INV/7", 41: "INV"}
