"""Table contracts.

Every table carries ``run_id`` so that one plan can reconcile many independent
ledger/statement pairs, and the two inputs carry ``row_ord``, the file order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Four decimals keep 10.001 apart from 10.00; 18 digits stay a plain long in memory.
MONEY = T.DecimalType(18, 4)

# Column names of the input files and of the written reports.
LEDGER_COLUMNS = (
    "erp_id",
    "date",
    "merchant_name",
    "amount",
    "currency",
    "tax_line_item",
)
STATEMENT_COLUMNS = (
    "bank_ref",
    "settlement_date",
    "description",
    "net_amount",
    "fee_deducted",
)
MATCHED_COLUMNS = (
    "erp_id",
    "bank_ref",
    "date",
    "settlement_date",
    "merchant_name",
    "description",
    "amount",
    "tax_line_item",
    "net_amount",
    "fee_deducted",
    "match_type",
    "confidence_score",
    "reasoning",
    "source",
)
EXCEPTION_COLUMNS = (
    "dataset",
    "record_id",
    "related_record_id",
    "confidence_score",
    "match_type",
    "category",
    "reason",
    "details",
)
DECISION_LOG_COLUMNS = (
    "erp_id",
    "bank_ref",
    "is_match",
    "confidence_score",
    "match_type",
    "reasoning",
    "merchant_erp",
    "description_bank",
    "currency",
)

# The log's own order: ledger row, then rank of the candidate.
LOG_ORDER = ("erp_ord", "rank")

LEDGER = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("row_ord", T.LongType()),
        T.StructField("erp_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("currency", T.StringType()),
        T.StructField("tax_line_item", MONEY),
    ]
)
STATEMENT = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("row_ord", T.LongType()),
        T.StructField("bank_ref", T.StringType()),
        T.StructField("settlement_date", T.DateType()),
        T.StructField("description", T.StringType()),
        T.StructField("net_amount", MONEY),
        T.StructField("fee_deducted", MONEY),
    ]
)
MATCHED = T.StructType(
    [
        T.StructField("erp_id", T.StringType()),
        T.StructField("bank_ref", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("settlement_date", T.StringType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("tax_line_item", MONEY),
        T.StructField("net_amount", MONEY),
        T.StructField("fee_deducted", MONEY),
        T.StructField("match_type", T.StringType()),
        T.StructField("confidence_score", T.DoubleType()),
        T.StructField("reasoning", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)
EXCEPTIONS = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("related_record_id", T.StringType()),
        T.StructField("confidence_score", T.DoubleType()),
        T.StructField("match_type", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("details", T.StringType()),
    ]
)
DECISION = T.StructType(
    [
        T.StructField("is_match", T.BooleanType()),
        T.StructField("confidence_score", T.DoubleType()),
        T.StructField("match_type", T.StringType()),
        T.StructField("reasoning", T.StringType()),
    ]
)
DECISION_LOG = T.StructType(
    [
        T.StructField("erp_id", T.StringType()),
        T.StructField("bank_ref", T.StringType()),
        *DECISION.fields,
        T.StructField("merchant_erp", T.StringType()),
        T.StructField("description_bank", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("erp_ord", T.LongType()),
        T.StructField("rank", T.IntegerType()),
    ]
)
# What is read back of the written metrics.
METRICS = (
    "run_id string, total_erp_records bigint, total_bank_records bigint,"
    " deterministic_matches_count bigint, deterministic_match_percent double,"
    " deterministic_time_seconds double, llm_matches_count bigint, llm_match_percent double,"
    " llm_time_seconds double, llm_calls_made bigint, logged_decisions_count bigint,"
    " unresolved_exceptions_count bigint, total_matched_pairs bigint, total_time_seconds double"
)
TRUTH = T.StructType(
    [
        T.StructField("seed", T.LongType()),
        T.StructField(
            "record_counts",
            T.StructType(
                [
                    T.StructField("erp", T.LongType()),
                    T.StructField("bank", T.LongType()),
                    T.StructField("matched_pairs", T.LongType()),
                ]
            ),
        ),
        T.StructField(
            "matches",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("erp_id", T.StringType()),
                        T.StructField("bank_ref", T.StringType()),
                        T.StructField("match_type", T.StringType()),
                        T.StructField("expected_fee_deducted", T.DoubleType()),
                    ]
                )
            ),
        ),
        T.StructField(
            "exceptions",
            T.StructType(
                [
                    T.StructField("erp_only", T.ArrayType(T.StringType())),
                    T.StructField("bank_only", T.ArrayType(T.StringType())),
                ]
            ),
        ),
    ]
)


def require_columns(columns, required, dataset_name: str) -> None:
    """Raise when ``columns`` lacks any of ``required``, naming what is missing."""
    missing = sorted(set(required) - set(columns))
    if missing:
        raise ValueError(
            f"{dataset_name} is missing required columns: {', '.join(missing)}"
        )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to ``schema`` by name; casts follow ANSI rules and raise."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
