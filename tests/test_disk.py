"""What a run leaves on disk: no shuffle files, no passing results, narrow decisions."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlink import reconcile
from ledgerlink.operators import evaluate
from ledgerlink.operators.candidates import _best_scored
from ledgerlink.operators.exact import available_statement, without_keys
from ledgerlink.session import checkpoint_folder, checkpointed, cut_lineage, lasting, passing_results

ERP = [
    (f"E{i}", "2024-01-01", f"shop{i} goods", 100 * i, "INR", 18 * i) for i in range(1, 9)
]
BANK = [
    (f"B{i}", "2024-01-02", f"shop{i} goods PAYOUT" if i % 2 else f"shop{i} E{i} SETTLEMENT", 118 * i if i % 2 else 100 * i, 0)
    for i in range(1, 9)
]


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in disk.localDirs() for f in Path(d.getPath()).rglob("shuffle_*.data")}


def left_over(spark, before):
    """Shuffle files added since; they are removed in the background, soon after an execution."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            return 0
        time.sleep(0.1)
    return len(shuffle_files(spark) - before)


def folders(spark):
    return {p.name for p in Path(checkpoint_folder(spark).removeprefix("file:")).iterdir()}


@pytest.mark.parametrize("write", [cut_lineage, checkpointed, lasting])
def test_written_results_leave_no_shuffle_files(spark, write):
    before = shuffle_files(spark)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    kept = write(rows)
    assert left_over(spark, before) == 0
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, rows.collect()))


def test_passing_results_are_removed_and_lasting_ones_stay(spark):
    checkpoint_folder(spark)
    rows, before = spark.range(10), folders(spark)
    with passing_results(spark):
        passing = cut_lineage(rows)
        kept = lasting(passing.select((F.col("id") * 2).alias("id")))
        assert len(folders(spark) - before) == 2
    assert len(folders(spark) - before) == 1
    assert kept.count() == 10


def test_passing_checkpoints_are_removed(spark):
    folder = Path(checkpoint_folder(spark).removeprefix("file:"))
    before = set(folder.rglob("rdd-*"))
    with passing_results(spark):
        checkpointed(spark.range(10))
        assert set(folder.rglob("rdd-*")) - before
    assert not set(folder.rglob("rdd-*")) - before


def test_candidates_leave_only_themselves(spark, ledger, statement):
    run = reconcile(ledger(ERP), statement(BANK))
    exact, before = run.exact, folders(spark)
    assert exact.count() == 4
    assert run.candidates.count() > 0
    assert len(folders(spark) - before) == 1


def test_decisions_hold_only_what_products_show(ledger, statement):
    run = reconcile(ledger(ERP), statement(BANK))
    assert not {"net_amount", "amount", "score", "days", "amount_delta"} & set(run.decisions.columns)
    assert run.assigned.count() == 4


def test_counts_take_exceptions_and_log_without_texts(ledger, statement):
    run = reconcile(ledger(ERP + [("E99", None, "none", 9e6, "USD", 0)]), statement(BANK))
    assert "details" not in run.open_records.columns and "reasoning" not in run.logged.columns
    names = run.open_records.columns
    assert sorted(map(tuple, run.open_records.collect())) == sorted(map(tuple, run.exceptions.select(names).collect()))
    assert len(run.open_records.collect()) == 1
    key = ["erp_id", "bank_ref", "rank", "confidence_score"]
    assert sorted(map(tuple, run.logged.select(key).collect())) == sorted(map(tuple, run.log.select(key).collect()))
    truth = run.exact.limit(0).select("run_id", "erp_id", "bank_ref", F.lit("exact").alias("match_type"))
    tables = [evaluate.confidence_calibration(log, truth).collect() for log in (run.logged, run.log)]
    assert sorted(map(tuple, tables[0])) == sorted(map(tuple, tables[1])) and tables[0]


def test_available_rows_are_found_without_shuffling_them(spark, statement):
    rows = statement(BANK + [(None, None, "x", 1, 0), ("B2", None, "again", 2, 0)])
    exact = spark.createDataFrame([("run", "B2"), ("run", None), ("other", "B3")], "run_id string, bank_ref string")
    left = available_statement(rows, exact)
    assert sorted(r.row_ord for r in left.collect()) == [0, 2, 3, 4, 5, 6, 7, 8]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5000")  # the taken keys alone fit
    try:
        many = spark.range(20_000).select(F.lit("run").alias("run_id"), F.col("id").cast("string").alias("k"), F.lit("x" * 50).alias("text"))
        taken = spark.range(19_999, 40_000).select(F.lit("run").alias("run_id"), F.col("id").cast("string").alias("k"))
        rest = without_keys(cut_lineage(many), cut_lineage(taken), ["run_id", "k"])
        plan = rest._jdf.queryExecution().executedPlan().toString()
        assert rest.count() == 19_999
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_pairs_meet_without_their_scores(spark):
    rows = spark.createDataFrame(
        [("r", 1, 2, 1, 2, 0, 0, 0.725), ("r", 1, 2, 0, 0, 0, 0, 0.45), ("r", 1, 3, 0, 0, 10_000, 1, 0.225)],
        "run_id string, erp_ord bigint, bank_ord bigint, overlap int, n_tokens int, delta_units bigint, days int, score double",
    )
    best = _best_scored(rows)
    assert sorted((r.bank_ord, r.overlap, round(r.score, 6)) for r in best.collect()) == [(2, 1, 0.725), (3, 0, 0.225)]
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert "score" not in plan.split("RepartitionByExpression")[1].split("LogicalRDD")[0].replace("[run_id", "")
