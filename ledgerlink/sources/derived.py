"""Ledger, statement and truth derived from an ``orders`` table.

A pure projection of the order key: each order is one ledger row and one
statement row. The key's remainders pick the match class and the class picks
the description, date shift, fee and net amount, so the truth is known for
every row at any scale and nothing is random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.functions.text import zero_padded
from ledgerlink.schemas import MONEY

DERIVED_RUN = "orders"
_ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"
)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.round(F.col("o_totalprice") * 100).cast("bigint")
    key = F.col("o_orderkey")
    tax_rate = F.when(key % 5 == 4, 8).otherwise(18)
    shop = F.concat(F.lit("Shop"), zero_padded(F.col("o_custkey"), 6))
    orders = spark.read.schema(_ORDERS).parquet(f"{sf_dir}/orders.parquet")
    return (
        _spread(orders, "o_orderkey")
        .select(
            key.alias("k"),
            F.col("o_orderdate").cast("date").alias("day"),
            shop.alias("shop"),
            amount.alias("amt_c"),
            tax_rate.alias("rate"),
        )
        .withColumn(
            "tax_c", F.floor((F.col("amt_c") * F.col("rate") + 50) / 100.0).cast("bigint")
        )
        .withColumn("erp_id", F.concat(F.lit("ERP-"), _padded_key()))
    )


def _spread(rows: DataFrame, key: str) -> DataFrame:
    """Give a scan of fewer splits than cores one partition per core.

    Inputs of a useful size have more splits than that and stay as they are.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() >= cores:
        return rows
    return rows.repartition(cores, key)


def _padded_key() -> Column:
    return zero_padded(F.col("k"), 7)


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") * F.expr("0.01BD")).cast(MONEY)


def _by_class(unmatched, exact, fuzzy, rounding) -> Column:
    k = F.col("k")
    return (
        F.when(k % 8 == 7, unmatched)
        .when(k % 3 == 0, exact)
        .when(k % 3 == 1, fuzzy)
        .otherwise(rounding)
    )


def derived_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select(
        F.lit(DERIVED_RUN).alias("run_id"),
        F.col("k").alias("row_ord"),
        "erp_id",
        F.col("day").alias("date"),
        F.concat("shop", F.lit(" Pvt Ltd")).alias("merchant_name"),
        _money(F.col("amt_c")).alias("amount"),
        F.when(F.col("rate") == 8, "USD").otherwise("INR").alias("currency"),
        _money(F.col("tax_c")).alias("tax_line_item"),
    )


def _fee_cents() -> Column:
    amt = F.col("amt_c")
    return _by_class(
        F.col("k") % 500,
        F.lit(0),
        F.floor(amt / 80.0).cast("bigint"),
        F.floor(amt / 100.0).cast("bigint"),
    ).cast("bigint")


def _bank_ref() -> Column:
    prefix = F.when(F.col("k") % 8 == 7, "BNK-UNMATCHED-").otherwise("BNK-")
    return F.concat(prefix, _padded_key())


def derived_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    amt, total = F.col("amt_c"), F.col("amt_c") + F.col("tax_c")
    fee = F.col("fee_c")
    return (
        _orders(spark, sf_dir)
        .withColumn("fee_c", _fee_cents())
        .select(
            F.lit(DERIVED_RUN).alias("run_id"),
            F.col("k").alias("row_ord"),
            _bank_ref().alias("bank_ref"),
            F.expr(
                "date_add(day, CASE WHEN k % 8 = 7 THEN 30 ELSE cast(k % 3 AS int) END)"
            ).alias("settlement_date"),
            _by_class(
                F.concat(F.lit("UNKNOWN MERCHANT "), (F.col("k") % 100).cast("string")),
                F.concat("shop", F.lit(" Pvt Ltd "), "erp_id", F.lit(" SETTLEMENT")),
                F.concat(F.upper("shop"), F.lit(" SETTLEMENT")),
                F.concat("shop", F.lit(" / CARD PAYOUT")),
            ).alias("description"),
            _money(_by_class(amt + 12345, amt, total - fee, total - fee + 1)).alias(
                "net_amount"
            ),
            _money(fee).alias("fee_deducted"),
        )
    )


def derived_truth_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _orders(spark, sf_dir)
        .where(F.col("k") % 8 != 7)
        .select(
            F.lit(DERIVED_RUN).alias("run_id"),
            "erp_id",
            _bank_ref().alias("bank_ref"),
            _by_class(
                F.lit(None), F.lit("exact"), F.lit("fuzzy_name"), F.lit("rounding_difference")
            ).alias("match_type"),
            _money(_fee_cents()).alias("expected_fee_deducted"),
        )
    )


def derived_truth_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    unmatched = _orders(spark, sf_dir).where(F.col("k") % 8 == 7)
    sides = F.array(
        F.struct(F.lit("erp").alias("dataset"), F.col("erp_id").alias("record_id")),
        F.struct(F.lit("bank").alias("dataset"), _bank_ref().alias("record_id")),
    )
    return unmatched.select(
        F.lit(DERIVED_RUN).alias("run_id"), F.inline(sides)
    )
