"""Run metrics and dashboard aggregates. Ratios stay unrounded until a sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.operators.report import EXACT_SOURCE, MODEL_SOURCE


# What a summary says about stages and times.
THROUGHPUT_COLUMNS = (
    "deterministic_matches_count",
    "deterministic_match_percent",
    "deterministic_time_seconds",
    "llm_matches_count",
    "llm_match_percent",
    "llm_time_seconds",
    "llm_calls_made",
    "total_time_seconds",
)


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, 0 when there is no whole."""
    return F.when(whole > 0, part * 100.0 / whole).otherwise(0.0)


def _counted(rows: DataFrame, name: str | Column) -> DataFrame:
    """(run_id, name, n) rows; pre-aggregated, so unions of them stay tiny."""
    name = F.lit(name) if isinstance(name, str) else name
    return rows.groupBy("run_id", name.alias("name")).agg(F.count("*").alias("n"))


def _per_run(counts: list[DataFrame], names: list[str]) -> DataFrame:
    stacked = counts[0]
    for part in counts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.groupBy("run_id").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("name") == n, F.col("n"))), F.lit(0)).alias(n)
            for n in names
        ]
    )


def exception_counts(exceptions: DataFrame) -> DataFrame:
    """Exceptions per category, most frequent first."""
    return (
        exceptions.groupBy("run_id", "category")
        .agg(F.count("*").alias("n_exceptions"))
        .orderBy("run_id", F.desc("n_exceptions"), "category")
    )


def run_metrics(
    ledger: DataFrame,
    statement: DataFrame,
    candidates: DataFrame,
    log: DataFrame,
    matched: DataFrame,
    exceptions: DataFrame,
) -> DataFrame:
    """One row per run: sizes, matches by stage, evaluations made, exceptions."""
    names = [
        "total_erp_records",
        "total_bank_records",
        "deterministic_matches_count",
        "llm_matches_count",
        "llm_calls_made",
        "logged_decisions_count",
        "unresolved_exceptions_count",
    ]
    by_stage = F.when(F.col("source") == EXACT_SOURCE, names[2]).otherwise(names[3])
    counts = [
        _counted(ledger, names[0]),
        _counted(statement, names[1]),
        _counted(matched, by_stage),
        _counted(candidates, names[4]),
        _counted(log, names[5]),
        _counted(exceptions, names[6]),
    ]
    total = F.col("deterministic_matches_count") + F.col("llm_matches_count")
    return (
        _per_run(counts, names)
        .withColumn("total_matched_pairs", total)
        .withColumn(
            "deterministic_match_percent",
            percent(F.col("deterministic_matches_count"), total),
        )
        .withColumn("llm_match_percent", percent(F.col("llm_matches_count"), total))
    )


def kpi_summary(ledger: DataFrame, matched: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Records processed, match rate against the ledger, open exceptions."""
    names = ["records_processed", "matched_pairs", "unresolved_exceptions"]
    counts = [
        _counted(rows, name)
        for rows, name in zip((ledger, matched, exceptions), names)
    ]
    rate = F.col("matched_pairs") * 100.0 / F.greatest("records_processed", F.lit(1))
    return _per_run(counts, names).withColumn("match_rate_percent", rate)


def stage_breakdown(matched: DataFrame) -> DataFrame:
    """Pairs resolved per stage and their share; both stages always appear."""
    total = F.col("exact_n") + F.col("model_n")
    per_run = matched.groupBy("run_id").agg(
        F.count_if(F.col("source") == EXACT_SOURCE).alias("exact_n"),
        F.count_if(F.col("source") == MODEL_SOURCE).alias("model_n"),
    )
    stages = F.array(
        F.struct(F.lit(EXACT_SOURCE).alias("stage"), F.col("exact_n").alias("resolved")),
        F.struct(F.lit(MODEL_SOURCE).alias("stage"), F.col("model_n").alias("resolved")),
    )
    return per_run.select("run_id", total.alias("total"), F.inline(stages)).select(
        "run_id",
        "stage",
        "resolved",
        percent(F.col("resolved"), F.col("total")).alias("share_percent"),
    )


def throughput_fallback(matched: DataFrame, elapsed_seconds: float = 0.0) -> DataFrame:
    """Stage counts from the report alone, for runs that left no metrics."""
    pairs = F.count_distinct("erp_id", "bank_ref")
    exact = F.count_distinct(
        F.when(
            (F.col("match_type") == "exact") & (F.col("source") == EXACT_SOURCE),
            F.struct("erp_id", "bank_ref"),
        )
    )
    whole = F.greatest("pairs", F.lit(1))
    return (
        matched.groupBy("run_id")
        .agg(pairs.alias("pairs"), exact.alias("deterministic_matches_count"))
        .select(
            "run_id",
            "deterministic_matches_count",
            (F.col("deterministic_matches_count") * 100.0 / whole).alias(
                "deterministic_match_percent"
            ),
            F.lit(0.0).alias("deterministic_time_seconds"),
            (F.col("pairs") - F.col("deterministic_matches_count")).alias(
                "llm_matches_count"
            ),
            (
                (F.col("pairs") - F.col("deterministic_matches_count")) * 100.0 / whole
            ).alias("llm_match_percent"),
            F.lit(float(elapsed_seconds)).alias("llm_time_seconds"),
            F.lit(0).cast("bigint").alias("llm_calls_made"),
            F.lit(float(elapsed_seconds)).alias("total_time_seconds"),
        )
    )


def job_summary(
    matched: DataFrame,
    exceptions: DataFrame,
    report_uri: str,
    exceptions_uri: str,
    duration_ms: int,
) -> DataFrame:
    """Result record of a finished job, one row per run."""
    names = ["matched_count", "exception_count"]
    counts = [_counted(rows, n) for rows, n in zip((matched, exceptions), names)]
    return _per_run(counts, names).select(
        F.col("run_id").alias("job_id"),
        *names,
        F.lit(report_uri).alias("report_uri"),
        F.lit(exceptions_uri).alias("exceptions_uri"),
        F.lit(duration_ms).cast("bigint").alias("duration_ms"),
    )
