"""Money, date and score columns of a ledger/statement pair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlink.config import (
    AMOUNT_WEIGHT,
    DATE_WEIGHT,
    MISSING_DATE_DAYS,
    NAME_WEIGHT,
)
from ledgerlink.schemas import MONEY


def gross_amount(amount: Column, tax: Column) -> Column:
    """What the ledger expects in total; a missing tax counts as zero."""
    return (amount + F.coalesce(tax, F.lit(0).cast(MONEY))).cast(MONEY)


def settled_amount(net: Column, fee: Column) -> Column:
    """What the statement row settles before its fee; a missing fee is zero."""
    return (net + F.coalesce(fee, F.lit(0).cast(MONEY))).cast(MONEY)


MONEY_UNITS = 10_000  # money carries four decimals


def in_units(amount: Column) -> Column:
    """Money as a whole number of its smallest units."""
    return (amount * F.lit(MONEY_UNITS)).cast("bigint")


def from_units(units: Column) -> Column:
    """Units back to money as a double: the double nearest to the decimal."""
    return units.cast("double") / F.lit(float(MONEY_UNITS))


def amount_delta(gross: Column, settled: Column) -> Column:
    """|amount + tax - fee - net| as an exact decimal."""
    return F.abs(gross - settled).cast(MONEY)


def date_gap(left: Column, right: Column) -> Column:
    """Days between two dates; a fixed gap when either is missing."""
    return F.coalesce(F.abs(F.datediff(left, right)), F.lit(MISSING_DATE_DAYS))


def amount_part(delta: Column) -> Column:
    return (F.lit(1.0) / (F.lit(1.0) + delta)) * F.lit(AMOUNT_WEIGHT)


def date_part(days: Column) -> Column:
    return (F.lit(1.0) / (F.lit(1.0) + days)) * F.lit(DATE_WEIGHT)


def name_part(overlap: Column, n_tokens: Column) -> Column:
    share = overlap.cast("double") / F.greatest(n_tokens, F.lit(1)).cast("double")
    return share * F.lit(NAME_WEIGHT)


def candidate_score(
    overlap: Column, n_tokens: Column, delta: Column, days: Column
) -> Column:
    """Weighted name, amount and date closeness; ``delta`` is money as a double."""
    return name_part(overlap, n_tokens) + amount_part(delta) + date_part(days)
