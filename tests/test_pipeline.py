import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlink import reconcile
from ledgerlink.config import aliases_of
from ledgerlink.operators import audit, decide, evaluate, metrics
from ledgerlink.operators.decide import validated
from ledgerlink.plans.evaluation import compare_summaries, evaluate_artifacts
from ledgerlink.sources import sinks

# A small ledger with every class of row.
ERP = [
    ("E1", "2024-01-01", "Razorpay Software", 100, "INR", 18),
    ("E2", "2024-01-02", "Acme Retail India", 200, "INR", 36),
    ("E3", "2024-01-03", "Nimbus Cloud", 300, "inr", 54),
    ("E4", "2024-01-04", "Green Basket", 400, "USD", 32),
    ("E5", "2024-01-05", "Urban Mobility", 5000, "", 900),
    ("E6", None, None, 60000, None, None),
    ("E7", "2024-01-07", "Mango Tree", 700, "INR", 126),
]
BANK = [
    ("B7", "2024-01-07", "Bluebird Edu", 824.5, 1),
    ("B1", "2024-01-01", "Razorpay Software E1 SETTLEMENT", 100, 0),
    ("B2", "2024-01-03", "ACME RETAIL SETTLEMENT", 233.5, 2.5),
    ("B3", "2024-01-05", "NIMBUS CLOUD / CARD PAYOUT", 351.01, 3),
    ("B9", None, None, 999999, 0),
]


@pytest.fixture(scope="module")
def run(ledger, statement):
    return reconcile(ledger(ERP), statement(BANK))


def test_pairs_and_exceptions_are_computed_once(run):
    for rows in (run.pairs, run.exceptions):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan


def test_matches(run):
    got = {(r.erp_id, r.bank_ref, r.match_type, r.source) for r in run.matched.collect()}
    assert got == {
        ("E1", "B1", "exact", "deterministic"),
        ("E2", "B2", "fuzzy_name_match", "llm"),
        ("E3", "B3", "rounding_discrepancy", "llm"),
    }


def test_exceptions(run):
    got = {r.record_id: r for r in run.exceptions.collect()}
    assert {k: r.category for k, r in got.items()} == {
        "E4": "amount_currency_mismatch",
        "E5": "no_counterpart_found",
        "E6": "amount_currency_mismatch",
        "E7": "below_confidence_threshold",
        "B7": "below_confidence_threshold",
        "B9": "no_counterpart_found",
    }
    assert got["E6"].reason == "Currency is NULL (foreign settlement/currency mismatch)."
    assert got["E7"].related_record_id == "B7"
    assert got["E7"].confidence_score == 0.1
    assert got["E7"].reason == (
        "Highest LLM confidence score (0.10) was below threshold (0.8)."
    )
    assert got["B7"].related_record_id == "E7"
    assert got["B9"].related_record_id == "" and got["B9"].confidence_score == 0.0
    details = json.loads(got["E6"].details)
    assert details["erp_id"] == "E6" and details["merchant_name"] is None
    assert "row_ord" not in details and "run_id" not in details


def test_every_record_is_matched_or_an_exception(run):
    matched = {r.erp_id for r in run.pairs.collect()} | {r.bank_ref for r in run.pairs.collect()}
    open_records = {r.record_id for r in run.exceptions.collect()}
    assert not matched & open_records
    assert matched | open_records == {r[0] for r in ERP} | {r[0] for r in BANK}


def test_metrics(run):
    row = run.metrics.first()
    assert row.total_erp_records == 7 and row.total_bank_records == 5
    assert row.deterministic_matches_count == 1 and row.llm_matches_count == 2
    assert row.llm_calls_made == run.candidates.count()
    assert row.unresolved_exceptions_count == 6
    assert row.deterministic_match_percent == pytest.approx(100 / 3)
    kpi = metrics.kpi_summary(run.ledger, run.pairs, run.exceptions).first()
    assert kpi.match_rate_percent == pytest.approx(300 / 7)


def test_a_second_row_of_a_matched_id_is_neither_matched_nor_open(ledger, statement):
    erp = [*ERP, ("E1", "2024-01-01", "Other", 7777, "INR", 0)]
    run = reconcile(ledger(erp), statement(BANK))
    assert run.matched.where("erp_id = 'E1'").count() == 1
    assert run.exceptions.where("record_id = 'E1'").count() == 0


def test_an_empty_side(ledger, statement):
    for erp, bank in ((ERP, []), ([], BANK)):
        run = reconcile(ledger(erp), statement(bank))
        assert run.matched.count() == 0
        assert run.exceptions.count() == len(erp) + len(bank)
        assert run.metrics.first().total_matched_pairs == 0


def test_results_do_not_depend_on_partitions(spark, ledger, statement, run):
    expected = sorted(map(str, run.matched.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = reconcile(ledger(ERP).repartition(5), statement(BANK).repartition(2))
        assert sorted(map(str, again.matched.collect())) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def always(decision):
    return lambda erp, bank: dict(decision)


GOOD = {
    "is_match": True,
    "confidence_score": 0.80,
    "match_type": "fuzzy_name_match",
    "reasoning": "ok",
}


@pytest.mark.parametrize(
    "change, accepted",
    [
        ({}, True),
        ({"confidence_score": 0.79}, False),
        ({"confidence_score": 1.2}, False),
        ({"confidence_score": float("nan")}, False),
        ({"match_type": "no_match"}, False),
        ({"match_type": "perhaps"}, False),
        ({"is_match": False}, False),
        ({"is_match": "yes"}, False),
        ({"reasoning": ""}, False),
        ({"reasoning": None}, False),
        ({"extra": 1}, False),
    ],
)
def test_only_valid_confident_decisions_count(ledger, statement, change, accepted):
    run = reconcile(ledger(ERP[1:2]), statement(BANK[2:3]), evaluator=always({**GOOD, **change}))
    assert (run.assigned.count() == 1) == accepted
    assert run.log.count() == 1
    assert run.exceptions.count() == (0 if accepted else 2)


def test_a_failing_evaluator_still_gives_a_full_report(ledger, statement):
    def fail(erp, bank):
        raise RuntimeError("x" * 500)

    run = reconcile(ledger(ERP), statement(BANK), evaluator=fail, parallelism=2)
    assert run.matched.count() == 1
    reasons = {r.reasoning for r in run.log.collect()}
    assert reasons == {"AI provider unavailable after fallback: " + "x" * 180}
    with pytest.raises(ValueError):
        reconcile(ledger(ERP), statement(BANK), evaluator=fail, parallelism=0).decisions


def test_invalid_decisions_become_rejections(spark):
    rows = spark.createDataFrame(
        [(True, 0.9, "exact", "r"), (True, -0.1, "exact", "r"), (None, 0.5, "exact", "r")],
        "is_match boolean, confidence_score double, match_type string, reasoning string",
    )
    got = [r.match_type for r in validated(rows).collect()]
    assert got == ["exact", "no_match", "no_match"]


PAIRS = "run_id string, erp_id string, bank_ref string, match_type string, source string, reasoning string"


def test_evaluation(spark):
    matched = spark.createDataFrame(
        [
            ("r", "e1", "b1", "exact", "deterministic", "x"),
            ("r", "e2", "b2", "exact", "llm", "x"),
            ("r", "e3", "b3", "fuzzy_name_match", "llm", " "),
        ],
        PAIRS,
    )
    truth = spark.createDataFrame(
        [
            ("r", "e1", "b1", "exact"),
            ("r", "e2", "b2", "exact"),
            ("r", "e3", "b9", "fuzzy_name"),
        ],
        "run_id string, erp_id string, bank_ref string, match_type string",
    )
    by_category = {r.category: r for r in evaluate.category_prf(matched, truth).collect()}
    exact = by_category["exact"]
    assert (exact.tp, exact.fp, exact.fn) == (1, 0, 1)
    fuzzy = by_category["fuzzy_name_match"]
    assert (fuzzy.tp, fuzzy.fp, fuzzy.fn, fuzzy.f1) == (0, 1, 1, 0.0)
    nothing = by_category["rounding_discrepancy"]
    assert (nothing.precision, nothing.recall, nothing.f1) == (100.0, 100.0, 100.0)
    overall = evaluate.overall_prf(matched, truth).first()
    assert (overall.tp, overall.fp, overall.fn) == (2, 1, 1)
    assert overall.accuracy == pytest.approx(200 / 3)
    assert evaluate.audit_complete(matched, truth).first().audit_trail_ok is False
    assert evaluate.audit_complete(matched.limit(0), truth).first().audit_trail_ok is False
    assert evaluate.audit_complete(matched.limit(2), truth).first().audit_trail_ok is True
    # The flags agree with the set operations they stand for.
    flags = evaluate.compare_sets(matched, truth, evaluate.PAIR)
    left, right = matched.select(*evaluate.PAIR), truth.select(*evaluate.PAIR)
    assert flags.where("p = 1 AND t = 1").count() == left.intersect(right).count()
    assert flags.where("p = 1 AND t = 0").count() == left.exceptAll(right).count()
    assert flags.where("p = 0 AND t = 1").count() == right.exceptAll(left).count()


def test_calibration_buckets_are_half_open(spark):
    log = spark.createDataFrame(
        [("r", f"e{i}", "b", True, c) for i, c in enumerate((0.0, 0.49, 0.5, 0.79, 0.8, 1.0))],
        "run_id string, erp_id string, bank_ref string, is_match boolean, confidence_score double",
    )
    truth = spark.createDataFrame(
        [("r", "e0", "b", "exact"), ("r", "e5", "b", "exact")],
        "run_id string, erp_id string, bank_ref string, match_type string",
    )
    got = {
        r.bucket: (r.total, r.correct, r.incorrect, r.accuracy)
        for r in evaluate.confidence_calibration(log, truth).collect()
    }
    assert got == {
        "0.0-0.5": (2, 1, 1, 50.0),
        "0.5-0.8": (2, 0, 2, 0.0),
        "0.8-1.0": (2, 1, 1, 50.0),
    }


def test_metric_comparison(spark):
    table = spark.createDataFrame(
        [("a", "f1", 50.0), ("b", "f1", 75.0), ("b", "only", 1.0), ("c", "f1", 9.0)],
        "run_id string, metric string, value double",
    )
    got = {r.metric: tuple(r)[1:] for r in evaluate.metric_comparison(table, "a", "b").collect()}
    assert got == {"f1": (50.0, 75.0, 25.0), "only": (0.0, 1.0, 1.0)}


def test_job_status(spark):
    events = spark.createDataFrame(
        [("j", 1, 0, "pending", None), ("j", 1, 1, "processing", None), ("j", 2, 2, "failed", "x")],
        "job_id string, ts int, seq int, status string, error_message string",
    )
    row = audit.job_status_latest(events).first()
    assert (row.status, row.error_message, row.created_at, row.updated_at) == ("failed", "x", 1, 2)


def test_batch_and_column_evaluators_agree_with_a_plain_one(spark, ledger, statement):
    def plain(erp, bank):
        if bank["bank_ref"] == "B3":
            raise RuntimeError("no answer")
        near = abs(erp["amount"] - bank["net_amount"]) < 1
        return {"is_match": bool(near), "confidence_score": 0.9, "match_type": "fuzzy_name_match", "reasoning": "near"}

    def frames(erp, bank):
        if (bank["bank_ref"] == "B3").any():
            raise RuntimeError("no answer")
        near = (erp["amount"] - bank["net_amount"]).abs() < 1
        return pd.DataFrame({"is_match": near, "confidence_score": 0.9, "match_type": "fuzzy_name_match", "reasoning": "near"})

    def column():
        failed = F.col("bank_ref") == "B3"
        near = F.abs(F.col("amount") - F.col("net_amount")) < 1
        return F.struct(
            (~failed & near).alias("is_match"),
            F.when(failed, 0.0).otherwise(0.9).alias("confidence_score"),
            F.when(failed, "no_match").otherwise("fuzzy_name_match").alias("match_type"),
            F.when(failed, decide.FAILURE_PREFIX + "no answer").otherwise("near").alias("reasoning"),
        )

    sides = ledger(ERP), statement(BANK)
    made = []
    for evaluator in (plain, decide.BatchEvaluator(frames), decide.ColumnEvaluator(column)):
        rows = reconcile(*sides, evaluator=evaluator).decisions
        made.append(sorted(map(tuple, rows.select("erp_id", "bank_ref", *decide.DECISION_FIELDS).collect())))
    assert made[0] == made[1] == made[2] and len(made[0]) > 2


def test_aliases_come_from_a_table(spark, ledger, statement):
    table = spark.createDataFrame([("ACMEX", "acme"), ("zed", None), ("acmex", "zzz")], "alias string, name string")
    aliases = aliases_of(table)
    assert aliases == (("acmex", "acme"),)
    rows = spark.createDataFrame([("acme shop", "ACMEX PAYOUT", "0.00")], "merchant_name string, description string, amount_delta string")
    rows = rows.withColumn("amount_delta", F.col("amount_delta").cast("decimal(18,4)"))
    known = decide.evaluate_candidates(rows, aliases=aliases).first()
    unknown = decide.evaluate_candidates(rows, aliases=()).first()
    assert known.is_match and not unknown.is_match


def test_two_summaries_are_compared_whole(spark, tmp_path, ledger, statement):
    truth = spark.createDataFrame(
        [(r, "E1", "B1", "exact") for r in ("one", "two")], "run_id string, erp_id string, bank_ref string, match_type string"
    )
    open_ = spark.createDataFrame([("one", "erp", "E4")], "run_id string, dataset string, record_id string")
    for run in ("one", "two"):
        rows = ERP if run == "one" else ERP[:2]
        sinks.write_all(reconcile(ledger(rows, run), statement(BANK, run)), str(tmp_path))
    summaries = evaluate_artifacts(spark, str(tmp_path), truth, open_)
    (both,) = compare_summaries(summaries, "one", "two").collect()
    figures = {r.metric: r for r in both.comparison}
    assert figures["total_time_seconds"].first_value > 0 and "overall_f1" in figures
    assert both.first_summary.run_id == "one" and both.second_summary.overall.tp == 1
    absent = evaluate_artifacts(spark, str(tmp_path / "nothing"), truth, open_, 3.0).collect()
    assert {r.overall.fn for r in absent} == {1}
