"""Named queries over the given tables; each has the form (spark, sf_dir) -> DataFrame.

Outputs are flattened for comparison: money as double, dates as text.
"""

from __future__ import annotations

import functools
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.config import ReconConfig
from ledgerlink.functions.scoring import (
    amount_delta,
    from_units,
    gross_amount,
    settled_amount,
)
from ledgerlink.functions.text import name_tokens, zero_padded
from ledgerlink.operators import audit, candidates, decide, evaluate, exact, metrics
from ledgerlink.operators.assign import greedy_assignment
from ledgerlink.plans.evaluation import compare_summaries, evaluate_artifacts
from ledgerlink.plans.reconcile import ReconResult, reconcile
from ledgerlink.schemas import DECISION_LOG, MONEY, TRUTH
from ledgerlink.session import checkpoint_folder, cut_lineage, lasting, passing_results
from ledgerlink.sources import derived, files, sinks
from ledgerlink.streaming.intake import REQUEST_SCHEMA, start_intake

QUERIES: dict = {}
_results: dict[tuple, ReconResult] = {}


def query(function):
    """Register a query under its function's name, with its output flattened."""

    @functools.wraps(function)
    def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _flat(function(spark, sf_dir))

    QUERIES[function.__name__.removesuffix("_")] = flat
    return function


def forget_results() -> None:
    """Drop shared pipeline results, so that the next query computes its own."""
    _results.clear()


def _pipeline(spark: SparkSession, sf_dir: str, fold_case: bool = False) -> ReconResult:
    """The run over the derived tables, shared by the queries of one session."""
    key = (spark.sparkContext.applicationId, sf_dir, fold_case)
    if key not in _results:
        _results[key] = reconcile(
            derived.derived_ledger(spark, sf_dir),
            derived.derived_statement(spark, sf_dir),
            ReconConfig(fold_case=fold_case),
        )
    return _results[key]


def _truth(spark, sf_dir):
    return derived.derived_truth_pairs(spark, sf_dir)


def _flat(rows: DataFrame) -> DataFrame:
    """Money as double, integers as bigint, dates as text, without the run column."""
    columns = []
    for field in rows.schema:
        if field.name == "run_id":
            continue
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared checkpoint folder."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- Derived inputs -------------------------------------------------------------


@query
def fixture_ledger(spark, sf_dir):
    return derived.derived_ledger(spark, sf_dir)


@query
def fixture_statement(spark, sf_dir):
    return derived.derived_statement(spark, sf_dir)


@query
def fixture_truth(spark, sf_dir):
    return _truth(spark, sf_dir)


_DATE_STYLES = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyy/MM/dd", "MMM d yyyy")


def _odd_text(text, k):
    """Texts with quotes, commas and backslashes, by the key's remainder."""
    return (
        F.when(k % 4 == 0, F.concat(text, F.lit(' "GOLD", E1')))
        .when(k % 4 == 1, F.concat(F.lit("a\\b "), text, F.lit("\\")))
        .when(k % 4 == 2, F.concat(text, F.lit('"')))
        .otherwise(text)
    )


def _odd_date(date, k):
    shown = F.date_format(date, _DATE_STYLES[0])
    for number in (1, 2, 3):
        shown = F.when(k % 4 == number, F.date_format(date, _DATE_STYLES[number])).otherwise(shown)
    return shown


def _written_csv(rows: DataFrame, folder: str) -> None:
    rows.write.option("header", True).option("escape", '"').csv(folder)


@query
def ledger_scan(spark, sf_dir):
    """The ledger, with quoted names and dates of four styles, written as CSV and read back."""
    folder, k = _scratch(spark, "ledger"), F.col("row_ord")
    rows = derived.derived_ledger(spark, sf_dir)
    rows = rows.withColumns({"merchant_name": _odd_text(F.col("merchant_name"), k), "date": _odd_date(F.col("date"), k)})
    _written_csv(rows.drop("row_ord"), folder)
    return files.read_ledger(spark, folder).drop("row_ord")


@query
def statement_scan(spark, sf_dir):
    folder, k = _scratch(spark, "statement"), F.col("row_ord")
    rows = derived.derived_statement(spark, sf_dir)
    rows = rows.withColumns(
        {"description": _odd_text(F.col("description"), k), "settlement_date": _odd_date(F.col("settlement_date"), k)}
    )
    _written_csv(rows.drop("row_ord"), folder)
    return files.read_statement(spark, folder).drop("row_ord")


@query
def ledger_normalize(spark, sf_dir):
    """Orders with padded identifiers and text amounts, typed and trimmed."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    raw = orders.select(
        F.col("o_orderkey").alias("k"),
        F.concat(F.lit("  ORD-"), F.col("o_orderkey").cast("string"), F.lit(" ")).alias("erp_id"),
        F.when(F.col("o_orderkey") % 10 == 0, "not a date")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("date"),
        F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderpriority")).alias("merchant_name"),
        F.col("o_totalprice").cast(MONEY).cast("string").alias("amount"),
        F.lit("INR").alias("currency"),
        F.lit("0.5").alias("tax_line_item"),
    )
    typed = files.ledger_from_table(raw, "k")
    date = F.coalesce(F.date_format("date", "yyyy-MM-dd"), F.lit(""))
    return typed.withColumn("date", date).na.fill("", ["merchant_name"])


@query
def truth_explode(spark, sf_dir):
    """The truth as nested documents of at most 500 keys each, exploded to both kinds of rows."""
    number = lambda name: F.regexp_extract(name, "([0-9]+)$", 1).cast("bigint")
    part = lambda name: F.floor(number(name) / 500).alias("part")
    matches = _truth(spark, sf_dir).groupBy(part("erp_id")).agg(
        F.collect_list(
            F.struct(
                "erp_id",
                "bank_ref",
                "match_type",
                F.col("expected_fee_deducted").cast("double").alias("expected_fee_deducted"),
            )
        ).alias("matches")
    )
    unmatched = derived.derived_truth_exceptions(spark, sf_dir)
    side = lambda name: F.collect_list(F.when(F.col("dataset") == name, F.col("record_id")))
    lists = unmatched.groupBy(part("record_id")).agg(
        F.struct(side("erp").alias("erp_only"), side("bank").alias("bank_only")).alias("exceptions")
    )
    folder = _scratch(spark, "truth")
    matches.join(lists, "part", "full").drop("part").write.json(folder)
    pairs, open_records = files.explode_truth(spark.read.schema(TRUTH).json(folder), F.lit("orders"))
    rows = pairs.unionByName(open_records, allowMissingColumns=True)
    return rows.na.fill("").na.fill(0.0)


# --- Text and exact stage -------------------------------------------------------


def _noisy_statement(spark, sf_dir) -> DataFrame:
    """Statement texts with repeated, second, lower-case and embedded identifiers."""
    k = F.col("row_ord")
    own = F.concat(F.lit("ERP-"), zero_padded(k, 7))
    other = F.concat(F.lit("ERP-"), zero_padded(k + 1, 7))
    text = (
        F.when(k % 7 == 0, F.concat("description", F.lit(" ref "), other))
        .when(k % 7 == 1, F.concat("description", F.lit("/"), own, F.lit("/"), F.lower(own)))
        .when(k % 7 == 2, F.lower("description"))
        .when(k % 7 == 3, F.regexp_replace("description", "ERP-", "XERP-"))
        .when(k % 7 == 4, F.regexp_replace("description", " SETTLEMENT", "-A SETTLEMENT"))
        .otherwise(F.col("description"))
    )
    return derived.derived_statement(spark, sf_dir).withColumn("description", text)


@query
def id_extract(spark, sf_dir):
    found = exact.extracted_ids(
        derived.derived_ledger(spark, sf_dir), _noisy_statement(spark, sf_dir)
    )
    return found.select("row_ord", "id_text")


@query
def id_ambiguous(spark, sf_dir):
    counted = exact.id_counts(
        derived.derived_ledger(spark, sf_dir), _noisy_statement(spark, sf_dir)
    )
    return counted.where(F.col("n_ids") > 1).select("row_ord", "n_ids")


@query
def exact_matches(spark, sf_dir):
    return _pipeline(spark, sf_dir).exact.select(
        "erp_id", "bank_ref", "amount", "erp_ord", "bank_ord"
    )


@query
def exact_matches_noisy(spark, sf_dir):
    found = exact.exact_matches(
        derived.derived_ledger(spark, sf_dir), _noisy_statement(spark, sf_dir)
    )
    return found.select("erp_id", "bank_ref")


@query
def exact_matches_punct(spark, sf_dir):
    """Identifiers that contain a separator character."""
    ledger = derived.derived_ledger(spark, sf_dir).withColumn(
        "erp_id", F.regexp_replace("erp_id", "-", "/")
    )
    statement = derived.derived_statement(spark, sf_dir).withColumn(
        "description", F.regexp_replace("description", "ERP-", "ERP/")
    )
    return exact.exact_matches(ledger, statement).select("erp_id", "bank_ref")


def _coarse_keys(spark, sf_dir) -> DataFrame:
    """The ledger with identifiers and amounts that several rows share."""
    return derived.derived_ledger(spark, sf_dir).select(
        "run_id",
        "row_ord",
        F.concat(F.lit("C-"), F.substring("merchant_name", 1, 10)).alias("erp_id"),
        (F.floor(F.col("amount") / 50000) * 50000).cast(MONEY).alias("amount"),
    )


@query
def key_multiplicity(spark, sf_dir):
    ledger = _coarse_keys(spark, sf_dir)
    bank = derived.derived_statement(spark, sf_dir).select(
        "run_id",
        "row_ord",
        "bank_ref",
        F.concat(F.lit("C-"), F.substring("description", 1, 10)).alias("id_text"),
        (F.floor(F.col("net_amount") / 50000) * 50000).cast(MONEY).alias("net_amount"),
    )
    counted = exact.key_multiplicity(ledger, bank)
    return counted.select("side", "erp_id", "amount", "n")


@query
def duplicate_keys(spark, sf_dir):
    found = exact.duplicate_keys(
        _coarse_keys(spark, sf_dir), derived.derived_statement(spark, sf_dir)
    )
    return found


@query
def unresolved_erp(spark, sf_dir):
    return _pipeline(spark, sf_dir).unresolved_ledger


@query
def unresolved_bank(spark, sf_dir):
    return _pipeline(spark, sf_dir).unresolved_statement


@query
def exact_false_positives(spark, sf_dir):
    """Exact pairs against a truth that calls every fifth of them something else."""
    k = F.expr("cast(substring(erp_id, 5) AS bigint)")
    doubted = _truth(spark, sf_dir).withColumn(
        "match_type", F.when(k % 5 == 0, "fuzzy_name").otherwise(F.col("match_type"))
    )
    run = _pipeline(spark, sf_dir)
    return exact.exact_false_positives(run.exact, doubted, run.ledger, run.statement)


# --- Candidate stage ------------------------------------------------------------


@query
def name_tokens_(spark, sf_dir):
    ledger = derived.derived_ledger(spark, sf_dir)
    return _token_rows(ledger, fold_case=False)


@query
def name_tokens_folded(spark, sf_dir):
    return _token_rows(derived.derived_ledger(spark, sf_dir), fold_case=True)


def _token_rows(ledger: DataFrame, fold_case: bool) -> DataFrame:
    tokens = name_tokens(F.col("merchant_name"), fold_case)
    return ledger.select("row_ord", F.array_join(tokens, " ").alias("tokens"))


@query
def amount_delta_(spark, sf_dir):
    ledger = derived.derived_ledger(spark, sf_dir)
    statement = derived.derived_statement(spark, sf_dir)
    pairs = ledger.join(statement, ["run_id", "row_ord"])
    delta = amount_delta(
        gross_amount(F.col("amount"), F.col("tax_line_item")),
        settled_amount(F.col("net_amount"), F.col("fee_deducted")),
    )
    return pairs.select("row_ord", delta.alias("amount_delta"))


def _features(spark, sf_dir, fold_case=False):
    run, config = _pipeline(spark, sf_dir, fold_case), ReconConfig(fold_case=fold_case)
    available = exact.available_statement(run.unresolved_statement, run.exact)
    return (
        cut_lineage(candidates.ledger_features(run.unresolved_ledger, config)),
        cut_lineage(candidates.statement_features(available, config)),
        config,
    )


def _pair_rows(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "erp_ord", "bank_ord", "rank", "overlap", "amount_delta", "days", "score"
    )


@query
def token_overlap_pairs(spark, sf_dir):
    """The best candidates of each ledger row among rows sharing a token."""
    erp, bank, config = _features(spark, sf_dir)
    pairs = candidates.plausible_pairs(erp, bank, config, (candidates.TOKEN,))
    return _pair_rows(candidates.rank_pairs(pairs, config.max_candidates))


@query
def amount_band_pairs(spark, sf_dir):
    """The best candidates of each ledger row among rows within the amount band."""
    erp, bank, config = _features(spark, sf_dir)
    pairs = candidates.plausible_pairs(erp, bank, config, (candidates.BAND,))
    return _pair_rows(candidates.rank_pairs(pairs, config.max_candidates))


@query
def candidate_pairs(spark, sf_dir):
    """What either way of being plausible contributes to the final ranking."""
    erp, bank, config = _features(spark, sf_dir)
    parts = [
        candidates.rank_pairs(
            candidates.plausible_pairs(erp, bank, config, (way,)), config.max_candidates
        )
        for way in (candidates.TOKEN, candidates.BAND)
    ]
    return parts[0].unionByName(parts[1]).select("erp_ord", "bank_ord").distinct()


@query
def candidate_scores(spark, sf_dir):
    """The score of every ledger row with the statement row of the same order."""
    config = ReconConfig(fold_case=True)
    erp = candidates.ledger_features(derived.derived_ledger(spark, sf_dir), config)
    bank = candidates.statement_features(derived.derived_statement(spark, sf_dir), config)
    pairs = erp.join(bank.drop("run_id"), F.col("erp_ord") == F.col("bank_ord"))
    delta = from_units(F.col("delta_units")).alias("amount_delta")
    return candidates.score_pairs(pairs).select("*", delta).drop("delta_units")


@query
def top_k_candidates(spark, sf_dir):
    return _pair_rows(_pipeline(spark, sf_dir).candidates)


@query
def top_k_candidates_folded(spark, sf_dir):
    return _pair_rows(_pipeline(spark, sf_dir, fold_case=True).candidates)


@query
def top_k_candidates_hot(spark, sf_dir):
    """The best candidates when twenty names cover all orders, so every token is hot."""
    k = F.col("row_ord")
    named = lambda number, tail: F.concat(F.lit("shop"), (number % 20).cast("string"), F.lit(tail))
    ledger = derived.derived_ledger(spark, sf_dir).withColumn("merchant_name", named(k, ""))
    statement = derived.derived_statement(spark, sf_dir).withColumn("description", named(k + k % 3, " x"))
    run = reconcile(ledger, statement, ReconConfig(hot_group_rows=200))
    return _pair_rows(run.candidates)


# --- Decisions and assignment ---------------------------------------------------


def _decision_rows(decisions: DataFrame) -> DataFrame:
    return decisions.select(
        "erp_id", "bank_ref", "is_match", "confidence_score", "match_type", "reasoning"
    )


@query
def rule_decisions(spark, sf_dir):
    return _decision_rows(_pipeline(spark, sf_dir).decisions)


@query
def rule_decisions_folded(spark, sf_dir):
    return _decision_rows(_pipeline(spark, sf_dir, fold_case=True).decisions)


@query
def accept_predicate(spark, sf_dir):
    decisions = _pipeline(spark, sf_dir).decisions
    return decisions.where(decide.accepted()).select("erp_id", "bank_ref")


@query
def decision_validation(spark, sf_dir):
    """Decisions, some of them broken on purpose, after validation."""
    k = F.col("erp_ord")
    broken = (
        _pipeline(spark, sf_dir)
        .decisions.withColumn(
            "confidence_score",
            F.when(k % 5 == 0, 1.2).otherwise(F.col("confidence_score")),
        )
        .withColumn("match_type", F.when(k % 7 == 0, "maybe").otherwise(F.col("match_type")))
        .withColumn("reasoning", F.when(k % 11 == 0, "").otherwise(F.col("reasoning")))
    )
    return _decision_rows(decide.validated(broken))


def _close_amounts(erp: dict, bank: dict) -> dict:
    """A sample user evaluator: equal totals match, others do not."""
    total = erp["amount"] + erp["tax_line_item"]
    matched = total == bank["net_amount"] + bank["fee_deducted"]
    return {
        "is_match": bool(matched),
        "confidence_score": 0.9 if matched else 0.3,
        "match_type": "fuzzy_name_match" if matched else "no_match",
        "reasoning": "totals agree" if matched else "totals differ",
    }


def _failing(erp: dict, bank: dict) -> dict:
    """A sample evaluator that fails for foreign currency and misbehaves for some."""
    if erp["currency"] == "USD":
        raise RuntimeError("no rates for " + erp["currency"])
    decision = _close_amounts(erp, bank)
    if erp["erp_id"].endswith("1"):
        decision["confidence_score"] = 1.2
    return decision


def _evaluated(spark, sf_dir, evaluator) -> DataFrame:
    run = _pipeline(spark, sf_dir)
    pairs = run.candidates.select("run_id", "erp_ord", "bank_ord")  # the evaluators see records, not ranks and scores
    rows = decide.candidate_rows(pairs, run.unresolved_ledger, run.unresolved_statement)
    return _decision_rows(decide.evaluate_candidates(rows, evaluator, parallelism=8))


@query
def evaluator_plugin(spark, sf_dir):
    return _evaluated(spark, sf_dir, _close_amounts)


@query
def evaluator_faults(spark, sf_dir):
    return _evaluated(spark, sf_dir, _failing)


def _agreeing_totals():
    """The sample evaluator as a column expression."""
    same = F.col("amount") + F.col("tax_line_item") == F.col("net_amount") + F.col("fee_deducted")
    matched = F.coalesce(same, F.lit(False))
    return F.struct(
        matched.alias("is_match"),
        F.when(matched, 0.9).otherwise(0.3).alias("confidence_score"),
        F.when(matched, "fuzzy_name_match").otherwise("no_match").alias("match_type"),
        F.when(matched, "totals agree").otherwise("totals differ").alias("reasoning"),
    )


def _agreeing_frames(erp, bank):
    """The sample evaluator for whole batches."""
    matched = (erp["amount"] + erp["tax_line_item"]) == (bank["net_amount"] + bank["fee_deducted"])
    return pd.DataFrame(
        {
            "is_match": matched,
            "confidence_score": matched.map({True: 0.9, False: 0.3}),
            "match_type": matched.map({True: "fuzzy_name_match", False: "no_match"}),
            "reasoning": matched.map({True: "totals agree", False: "totals differ"}),
        }
    )


@query
def evaluator_columns(spark, sf_dir):
    return _evaluated(spark, sf_dir, decide.ColumnEvaluator(_agreeing_totals))


@query
def evaluator_batches(spark, sf_dir):
    return _evaluated(spark, sf_dir, decide.BatchEvaluator(_agreeing_frames))


@query
def greedy_assignment_(spark, sf_dir):
    """Assignment with every ranked candidate eligible."""
    decisions = _pipeline(spark, sf_dir).decisions
    with passing_results(spark):
        return lasting(greedy_assignment(decisions).select("erp_id", "bank_ref", "rank"))


@query
def greedy_assignment_accepted(spark, sf_dir):
    return _pipeline(spark, sf_dir).assigned.select("erp_id", "bank_ref", "rank")


@query
def decision_log(spark, sf_dir):
    return _pipeline(spark, sf_dir).log.drop("erp_ord")


# --- Reports --------------------------------------------------------------------


@query
def matched_report(spark, sf_dir):
    return _pipeline(spark, sf_dir).matched


@query
def erp_exceptions(spark, sf_dir):
    return _pipeline(spark, sf_dir).erp_exceptions.drop("details")


@query
def bank_exceptions(spark, sf_dir):
    return _pipeline(spark, sf_dir).bank_exceptions.drop("details")


@query
def exception_details(spark, sf_dir):
    """The record behind each exception, parsed back from its JSON."""
    fields = "erp_id string, merchant_name string, amount double, bank_ref string, net_amount double"
    rows = _pipeline(spark, sf_dir).exceptions.select(
        "dataset", "record_id", F.from_json("details", fields).alias("d")
    )
    return rows.select(
        "dataset",
        "record_id",
        F.coalesce("d.erp_id", "d.bank_ref").alias("detail_id"),
        F.coalesce("d.amount", "d.net_amount").alias("detail_amount"),
    )


# --- Metrics and evaluation -----------------------------------------------------


@query
def exception_counts(spark, sf_dir):
    return metrics.exception_counts(_pipeline(spark, sf_dir).open_records)


@query
def run_metrics(spark, sf_dir):
    return _pipeline(spark, sf_dir).metrics


@query
def kpi_summary(spark, sf_dir):
    run = _pipeline(spark, sf_dir)
    return metrics.kpi_summary(run.ledger, run.pairs, run.open_records)


@query
def stage_breakdown(spark, sf_dir):
    return metrics.stage_breakdown(_pipeline(spark, sf_dir).pairs)


@query
def throughput_fallback(spark, sf_dir):
    return metrics.throughput_fallback(_pipeline(spark, sf_dir).pairs, 1.5)


@query
def job_summary(spark, sf_dir):
    """The result record with the measured time, of which only its sign is comparable."""
    run = _pipeline(spark, sf_dir)
    taken = int(run.measure()["total"] * 1000)
    return metrics.job_summary(
        run.pairs, run.open_records, "out/reconciled_report.csv", "out/exceptions_list.csv", taken
    ).withColumn("timed", F.col("duration_ms") > 0).drop("duration_ms")


@query
def category_prf(spark, sf_dir):
    scored = evaluate.category_prf(_pipeline(spark, sf_dir).pairs, _truth(spark, sf_dir))
    return scored


@query
def overall_prf(spark, sf_dir):
    scored = evaluate.overall_prf(_pipeline(spark, sf_dir).pairs, _truth(spark, sf_dir))
    return scored


@query
def exception_prf(spark, sf_dir):
    truth = derived.derived_truth_exceptions(spark, sf_dir)
    return evaluate.exception_prf(_pipeline(spark, sf_dir).open_records, truth)


@query
def exception_prf_by_dataset(spark, sf_dir):
    truth = derived.derived_truth_exceptions(spark, sf_dir)
    scored = evaluate.exception_prf(_pipeline(spark, sf_dir).open_records, truth, True)
    return scored


@query
def pair_set_difference(spark, sf_dir):
    """Predicted and true pairs: which side holds each pair that only one holds."""
    run = _pipeline(spark, sf_dir)
    flags = evaluate.compare_sets(
        run.pairs, _truth(spark, sf_dir), evaluate.PAIR
    )
    return flags.where(F.col("p") != F.col("t"))


@query
def confidence_calibration(spark, sf_dir):
    scored = evaluate.confidence_calibration(
        _pipeline(spark, sf_dir).logged, _truth(spark, sf_dir)
    )
    return scored


@query
def audit_complete(spark, sf_dir):
    run = _pipeline(spark, sf_dir)
    return evaluate.audit_complete(run.pairs, run.ledger)


def _metric_table(spark, sf_dir, fold_case: bool, name: str) -> DataFrame:
    run, truth = _pipeline(spark, sf_dir, fold_case), _truth(spark, sf_dir)
    table = evaluate.metric_table(
        evaluate.overall_prf(run.pairs, truth),
        evaluate.category_prf(run.pairs, truth),
        evaluate.exception_prf(
            run.open_records, derived.derived_truth_exceptions(spark, sf_dir)
        ),
        run.metrics,
        evaluate.confidence_calibration(run.logged, truth),
    )
    return table.withColumn("run_id", F.lit(name))


@query
def metric_comparison(spark, sf_dir):
    """Figures of the run with tokens as written against the run with folded case."""
    both = _metric_table(spark, sf_dir, False, "as_written").unionByName(
        _metric_table(spark, sf_dir, True, "folded")
    )
    return evaluate.metric_comparison(both, "as_written", "folded")


def _products(spark, sf_dir, fold_case: bool = False) -> str:
    """All products of the run, written; their files are only read back, and so compressed."""
    folder = _scratch(spark, "products")
    sinks.write_all(
        _pipeline(spark, sf_dir, fold_case), folder, runs=[derived.DERIVED_RUN], compression="gzip"
    )
    return folder


def _summary(spark, sf_dir, fold_case: bool = False) -> DataFrame:
    """The evaluation summary of the written products."""
    return evaluate_artifacts(
        spark, _products(spark, sf_dir, fold_case), _truth(spark, sf_dir),
        derived.derived_truth_exceptions(spark, sf_dir),
    )


@query
def report_roundtrip(spark, sf_dir):
    """The matched report written and read back."""
    return files.read_matched_report(spark, f"{_products(spark, sf_dir)}/{sinks.REPORT}", None)


@query
def exceptions_roundtrip(spark, sf_dir):
    rows = files.read_exceptions(spark, f"{_products(spark, sf_dir)}/{sinks.EXCEPTIONS}", None)
    return rows.drop("details").na.fill("", ["related_record_id"])


@query
def log_roundtrip(spark, sf_dir):
    """The decision log read back, with the order that tells first evidence."""
    return files.read_decision_log(
        spark, f"{_products(spark, sf_dir)}/{sinks.DECISIONS}", None, lines=True
    ).drop("erp_ord")


@query
def metrics_roundtrip(spark, sf_dir):
    """Rounded, timed metrics read back; of the times only their sign is comparable."""
    rows = files.read_metrics(spark, f"{_products(spark, sf_dir)}/{sinks.METRICS}")
    timed = F.least("deterministic_time_seconds", "llm_time_seconds", "total_time_seconds") > 0
    return rows.withColumn("timed", timed).drop(
        "deterministic_time_seconds", "llm_time_seconds", "total_time_seconds"
    )


@query
def artifact_summary(spark, sf_dir):
    """One call from written artifacts and truth to the evaluation summary, flattened."""
    return _summary(spark, sf_dir).select(
        *[F.col(f"overall.{c}").alias(f"overall_{c}") for c in ("precision", "recall", "f1", "accuracy", "tp", "fp", "fn")],
        F.col("category_metrics")["true_exception"]["f1"].alias("exception_f1"),
        F.col("throughput_breakdown.deterministic_matches_count").alias("exact_matches"),
        F.col("throughput_breakdown.llm_matches_count").alias("llm_matches"),
        (F.col("throughput_breakdown.total_time_seconds") > 0).alias("timed"),
        F.col("confidence_calibration")["0.8-1.0"]["total"].alias("confident"),
        "audit_trail_ok",
    )


@query
def summary_roundtrip(spark, sf_dir):
    """The categories of the evaluation summary, written and read back."""
    summary, folder = _summary(spark, sf_dir), _scratch(spark, "summary")
    sinks.write_summary(summary, folder, [derived.DERIVED_RUN])
    stored = spark.read.schema(summary.schema).json(f"{folder}/{sinks.SUMMARY}")
    rows = stored.select("run_id", F.explode("category_metrics").alias("category", "m"))
    return rows.select("run_id", "category", "m.*")


@query
def comparison_roundtrip(spark, sf_dir):
    """Two runs' summaries compared, written and read back; all figures but the time."""
    folder = _scratch(spark, "comparison")
    named = [
        _summary(spark, sf_dir, fold).withColumn("run_id", F.lit(name))
        for fold, name in ((False, "as_written"), (True, "folded"))
    ]
    compared = compare_summaries(named[0].unionByName(named[1]), "as_written", "folded")
    sinks.write_comparison(compared, folder)
    stored = spark.read.schema(compared.schema).json(f"{folder}/{sinks.COMPARISON}")
    return stored.select(F.inline("comparison")).where("metric <> 'total_time_seconds'")


@query
def report_or_none(spark, sf_dir):
    """Rows of the report and exceptions of a run, and of a folder that no run wrote."""
    parts = []
    for source, folder in (("written", _products(spark, sf_dir)), ("absent", _scratch(spark, "nothing"))):
        for product, read in ((sinks.REPORT, files.read_matched_report), (sinks.EXCEPTIONS, files.read_exceptions)):
            rows = read(spark, f"{folder}/{product}", None)
            parts.append(rows.agg(F.count("*").alias("n_rows")).select(
                F.lit(source).alias("source"), F.lit(product).alias("product"), "n_rows"
            ))
    return functools.reduce(DataFrame.unionByName, parts)


@query
def log_array_roundtrip(spark, sf_dir):
    """The decision log as JSON arrays of 5000 ledger rows each, read back."""
    folder, log = _scratch(spark, "arrays"), _pipeline(spark, sf_dir).log
    fields = [F.col(c) for c in DECISION_LOG.fieldNames()]
    arrays = log.groupBy(F.floor(F.col("erp_ord") / 5000).alias("part")).agg(
        F.to_json(F.collect_list(F.struct(*fields))).alias("value")
    )
    arrays.write.option("compression", "gzip").partitionBy("part").text(folder)
    return files.read_decision_log(spark, folder, None).drop("part", "erp_ord")


# --- Audit, intake and streaming ------------------------------------------------


@query
def audit_rows(spark, sf_dir):
    run = _pipeline(spark, sf_dir)
    rows = audit.audit_rows(run.pairs, run.exceptions, 1500)
    return rows.where("created_at is not null and error_message is null").drop(
        "created_at", "error_message"
    ).na.fill("", ["model_name"])


@query
def stage_timing_rows(spark, sf_dir):
    """Three measured stages per run; of the times only their sign is comparable."""
    run = _pipeline(spark, sf_dir)
    seconds = run.measure()
    stages = {"deterministic": seconds["deterministic"], "llm": seconds["llm"], "pipeline": seconds["total"]}
    rows = audit.stage_timing_rows(run.metrics, stages)
    return rows.select("job_id", "stage", "metadata", (F.col("duration_ms") > 0).alias("timed"))


@query
def idempotent_append(spark, sf_dir):
    """The audit table after two writers at once and a later one appended the same rows."""
    run, folder = _pipeline(spark, sf_dir), _scratch(spark, "audit")
    rows = audit.audit_rows(run.pairs, run.exceptions, 1500)
    at_once = [audit.new_rows(rows, folder, audit.AUDIT_KEY, unique=True) for _ in range(2)]
    for fresh in at_once:
        audit.write_attempt(fresh, folder)
    audit.append_new(rows, folder, audit.AUDIT_KEY, unique=True)
    return audit.unique_rows(rows, folder, audit.AUDIT_KEY).groupBy("job_id", "stage").agg(
        F.count("*").alias("n_rows"), F.count_distinct("transaction_hash").alias("n_hashes")
    )


@query
def job_status_latest(spark, sf_dir):
    """Events as status transitions of one job per user; the last one counts."""
    kind = F.col("event_type")
    status = (
        F.when(kind == "view", audit.PENDING)
        .when(kind == "click", audit.PROCESSING)
        .when(kind == "error", audit.FAILED)
        .otherwise(audit.SUCCESS)
    )
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("job_id"),
        "ts",
        F.col("event_id").alias("seq"),
        status.alias("status"),
        F.when(kind == "error", F.col("props")).otherwise("").alias("error_message"),
    )
    return audit.job_status_latest(events).select("job_id", "status", "error_message")


@query
def intake_gate(spark, sf_dir):
    """Pages as arriving files: named by the kind of their address, as large as their text."""
    named = (
        F.when(F.col("url").contains(".html"), files.LEDGER_FILE)
        .when(F.col("url").contains("?"), F.regexp_extract("url", "([^/?]*)[?]", 1))
        .otherwise(files.STATEMENT_FILE)
    )
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id",
        F.concat(F.lit("in/"), F.col("page_id").cast("string"), F.lit("/"), named).alias("path"),
        F.octet_length("html").cast("bigint").alias("length"),
    )
    return files.intake_gate(pages, (files.LEDGER_FILE, files.STATEMENT_FILE), 2000)


def _streamed(
    spark, sf_dir, name: str, n_jobs: int, broken: bool = False, lacking: dict[int, tuple[str, ...]] | None = None
) -> str:
    """Run jobs derived from the orders through the intake stream.

    When ``broken``, job 1 has a bad amount, job 2 a wrong key and job 3 taxes
    and fees of more decimals than money has. ``lacking`` names columns that the
    files of a job do without.
    """
    folder = _scratch(spark, name)
    for file, rows, amount, extra in (
        (files.LEDGER_FILE, derived.derived_ledger(spark, sf_dir), "amount", "tax_line_item"),
        (files.STATEMENT_FILE, derived.derived_statement(spark, sf_dir), "net_amount", "fee_deducted"),
    ):
        job = F.floor(F.col("row_ord") / 2) % n_jobs
        text = F.col(amount).cast("string")
        if broken:
            text = F.when((job == 1) & (F.col("row_ord") % 100 == 2), "n/a").otherwise(text)
            fine = F.when(job == 3, "0.00001").otherwise(F.col(extra).cast("string"))
            rows = rows.withColumn(extra, fine)
        rows = rows.withColumn("job", job).withColumn(amount, text)
        for number in range(n_jobs):
            part = rows.where(F.col("job") == number).orderBy("row_ord")
            part = part.drop("job", "run_id", "row_ord", *(lacking or {}).get(number, ()))
            part.write.option("header", True).csv(f"{folder}/job-{number}/{file}")
    wrong = "/ledger.csv" if broken else f"/{files.LEDGER_FILE}"
    requests = [
        (
            f"job-{n}",
            "anonymous",
            f"{folder}/job-{n}" + (wrong if n == 2 else f"/{files.LEDGER_FILE}"),
            f"{folder}/job-{n}/{files.STATEMENT_FILE}",
        )
        for n in range(n_jobs)
    ]
    spark.createDataFrame(requests, REQUEST_SCHEMA).write.json(f"{folder}/requests")
    stream = start_intake(
        spark, f"{folder}/requests", f"{folder}/out", f"{folder}/checkpoint"
    )
    stream.awaitTermination()
    return f"{folder}/out"


@query
def stream_intake(spark, sf_dir):
    """Matches per job and class after the stream has taken in all jobs."""
    out = _streamed(spark, sf_dir, "intake", 2)
    report = spark.read.option("header", True).csv(f"{out}/{sinks.REPORT}")
    return report.groupBy(F.col("run_id").alias("job_id"), "match_type", "source").agg(
        F.count("*").alias("n_pairs")
    )


def _latest_status(spark, out: str) -> DataFrame:
    events = spark.read.schema(
        "job_id string, ts timestamp, seq int, status string, error_message string"
    ).parquet(f"{out}/job_status")
    return audit.job_status_latest(events)


@query
def missing_columns(spark, sf_dir):
    """Jobs of a stream of which two lack columns, with what each job matched."""
    out = _streamed(spark, sf_dir, "columns", 3, lacking={1: ("erp_id", "amount"), 2: ("net_amount",)})
    report = spark.read.option("header", True).csv(f"{out}/{sinks.REPORT}")
    pairs = report.groupBy(F.col("run_id").alias("job_id")).agg(F.count("*").alias("n_pairs"))
    return _latest_status(spark, out).join(pairs, "job_id", "left").select(
        "job_id", "status", F.coalesce("error_message", F.lit("")).alias("error_message"),
        F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"),
    )


@query
def dead_letter(spark, sf_dir):
    """The jobs of a stream in which three of four have bad input."""
    out = _streamed(spark, sf_dir, "broken", 4, broken=True)
    letters = spark.read.schema(
        "job_id string, payload string, error_message string, retry_count int"
    ).parquet(f"{out}/failed_jobs")
    latest = _latest_status(spark, out).select("job_id", "status")
    return latest.join(letters.select("job_id", "error_message", "retry_count"), "job_id", "left").select(
        "job_id",
        "status",
        F.coalesce("error_message", F.lit("")).alias("error_message"),
        F.coalesce("retry_count", F.lit(0)).alias("retry_count"),
    )
