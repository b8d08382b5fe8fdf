"""Matched report, decision log and categorised exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.config import BASE_CURRENCY, CONFIDENCE_THRESHOLD
from ledgerlink.schemas import (
    DECISION_LOG_COLUMNS,
    EXCEPTION_COLUMNS,
    MATCHED_COLUMNS,
)

# Sources, categories and reason texts of the written reports.
EXACT_SOURCE = "deterministic"
MODEL_SOURCE = "llm"
EXACT_REASONING = "ERP ID embedded in bank description and amount matched exactly."
CURRENCY_CATEGORY = "amount_currency_mismatch"
NO_COUNTERPART = "no_counterpart_found"
BELOW_THRESHOLD = "below_confidence_threshold"
CURRENCY_REASON = "Currency is %s (foreign settlement/currency mismatch)."
ERP_NO_EVIDENCE = "No candidate bank settlement found in candidate search pool."
ERP_BELOW = "Highest LLM confidence score (%.2f) was below threshold ({})."
ERP_UNSATISFIED = "No matching bank settlement record satisfied business constraints."
BANK_NO_EVIDENCE = (
    "No candidate ERP transaction found matching bank settlement details."
)
BANK_BELOW = "Evaluated candidate confidence (%.2f) was below threshold ({})."
BANK_UNSATISFIED = "Candidate evaluations did not produce an accepted ERP match."


def matched_pairs(exact: DataFrame, assigned: DataFrame, decisions: DataFrame) -> DataFrame:
    """Both stages' pairs with how and why they matched, without their records."""
    rows = ["run_id", "erp_id", "bank_ref", "erp_ord", "bank_ord"]
    by_id = exact.select(
        *rows,
        F.lit("exact").alias("match_type"),
        F.lit(1.0).alias("confidence_score"),
        F.lit(EXACT_REASONING).alias("reasoning"),
        F.lit(EXACT_SOURCE).alias("source"),
    )
    won = assigned.select("run_id", "erp_ord", "rank")
    by_decision = decisions.join(won, ["run_id", "erp_ord", "rank"], "left_semi").select(
        *rows,
        "match_type",
        "confidence_score",
        "reasoning",
        F.lit(MODEL_SOURCE).alias("source"),
    )
    return by_id.unionByName(by_decision)


def _dates_as_given(rows: DataFrame, column: str) -> DataFrame:
    """The date column as the text that was read, where there is one."""
    given = f"{column}_text"
    shown = F.col(column).cast("string")
    if given in rows.columns:
        shown = F.coalesce(given, shown)
    return rows.withColumn(column, shown).drop(given)


def matched_report(pairs: DataFrame, ledger: DataFrame, statement: DataFrame) -> DataFrame:
    """The matched pairs with the fields of their records."""
    erp = _dates_as_given(ledger, "date").withColumnRenamed("row_ord", "erp_ord").drop("erp_id")
    bank = _dates_as_given(statement, "settlement_date")
    bank = bank.withColumnRenamed("row_ord", "bank_ord").drop("bank_ref")
    return (
        pairs.join(erp, ["run_id", "erp_ord"])
        .join(bank, ["run_id", "bank_ord"])
        .select("run_id", *MATCHED_COLUMNS)
    )


def decision_log(logged: DataFrame) -> DataFrame:
    return logged.select(
        "run_id",
        "erp_ord",
        "rank",
        *DECISION_LOG_COLUMNS[:6],
        F.coalesce("merchant_name", F.lit("")).alias(DECISION_LOG_COLUMNS[6]),
        F.coalesce("description", F.lit("")).alias(DECISION_LOG_COLUMNS[7]),
        F.coalesce("currency", F.lit("")).alias(DECISION_LOG_COLUMNS[8]),
    )


def _evidence(log: DataFrame, own: str, other: str) -> DataFrame:
    """Per record: the first logged counterpart and the highest confidence."""
    return log.groupBy("run_id", own).agg(
        F.min_by(other, F.struct("erp_ord", "rank")).alias("related_record_id"),
        F.max("confidence_score").alias("top_confidence"),
    )


def _exceptions(
    rows: DataFrame,
    dataset: str,
    own: str,
    evidence: DataFrame,
    category: Column,
    reason: Column,
) -> DataFrame:
    details = [c for c in rows.columns if c not in ("run_id", "row_ord")]
    return (
        rows.join(evidence, ["run_id", own], "left")
        .select(
            "run_id",
            F.lit(dataset).alias("dataset"),
            F.col(own).alias("record_id"),
            F.coalesce("related_record_id", F.lit("")).alias("related_record_id"),
            F.coalesce("top_confidence", F.lit(0.0)).alias("confidence_score"),
            F.lit("no_match").alias("match_type"),
            category.alias("category"),
            reason.alias("reason"),
            F.to_json(
                F.struct(*details), {"ignoreNullFields": "false"}
            ).alias("details"),
        )
        .select("run_id", *EXCEPTION_COLUMNS)
    )


def erp_exceptions(
    ledger: DataFrame,
    matched: DataFrame,
    log: DataFrame,
    threshold: float = CONFIDENCE_THRESHOLD,
) -> DataFrame:
    """Ledger rows whose id no match used, with category, reason and evidence."""
    open_rows = _dates_as_given(ledger, "date").join(
        matched.select("run_id", "erp_id"), ["run_id", "erp_id"], "left_anti"
    )
    currency = F.upper(F.coalesce("currency", F.lit("NULL")))
    foreign = ~currency.isin(BASE_CURRENCY, "")
    top = F.col("top_confidence")
    category = (
        F.when(foreign, CURRENCY_CATEGORY)
        .when(top < threshold, BELOW_THRESHOLD)
        .otherwise(NO_COUNTERPART)
    )
    reason = (
        F.when(foreign, F.format_string(CURRENCY_REASON, currency))
        .when(top.isNull(), ERP_NO_EVIDENCE)
        .when(top < threshold, F.format_string(ERP_BELOW.format(threshold), top))
        .otherwise(ERP_UNSATISFIED)
    )
    evidence = _evidence(log, "erp_id", "bank_ref")
    return _exceptions(open_rows, "erp", "erp_id", evidence, category, reason)


def bank_exceptions(
    statement: DataFrame,
    matched: DataFrame,
    log: DataFrame,
    threshold: float = CONFIDENCE_THRESHOLD,
) -> DataFrame:
    """Statement rows whose reference no match used."""
    open_rows = _dates_as_given(statement, "settlement_date").join(
        matched.select("run_id", "bank_ref"), ["run_id", "bank_ref"], "left_anti"
    )
    top = F.col("top_confidence")
    category = F.when(top < threshold, BELOW_THRESHOLD).otherwise(NO_COUNTERPART)
    reason = (
        F.when(top.isNull(), BANK_NO_EVIDENCE)
        .when(top < threshold, F.format_string(BANK_BELOW.format(threshold), top))
        .otherwise(BANK_UNSATISFIED)
    )
    evidence = _evidence(log, "bank_ref", "erp_id")
    return _exceptions(open_rows, "bank", "bank_ref", evidence, category, reason)
