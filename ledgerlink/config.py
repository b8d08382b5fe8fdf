"""Settings of one reconciliation run."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# The acceptance threshold, scoring weights, limits and word
# lists decide which rows match, so they are part of the result contract.
CONFIDENCE_THRESHOLD = 0.80
MAX_CANDIDATES = 2
AMOUNT_BAND = Decimal("50.00")
ROUNDING_LIMIT = Decimal("1.00")
NAME_WEIGHT = 0.55
AMOUNT_WEIGHT = 0.30
DATE_WEIGHT = 0.15
MISSING_DATE_DAYS = 30
BASE_CURRENCY = "INR"
MIN_TOKEN_LENGTH = 3
STOP_TOKENS = ("pvt", "ltd", "settlement", "payout")
DESCRIPTOR_TOKENS = ("card",)
MERCHANT_ALIASES = (("rzpay", "razorpay"),)

#: A larger alias table is refused, as it becomes part of the plan.
MOST_ALIASES = 10_000


def aliases_of(table) -> tuple[tuple[str, str], ...]:
    """The aliases of a table (alias, name); of a repeated alias the smallest name counts."""
    pairs = table.where("alias is not null and name is not null").selectExpr(
        "lower(alias) AS alias", "lower(name) AS name"
    )
    found = pairs.groupBy("alias").agg({"name": "min"}).limit(MOST_ALIASES + 1).collect()
    if len(found) > MOST_ALIASES:
        raise ValueError(f"more than {MOST_ALIASES} merchant aliases")
    return tuple(sorted((alias, name) for alias, name in found))


@dataclass(frozen=True)
class ReconConfig:
    """Knobs that a run may change, with the contract values as defaults.

    ``hot_group_rows`` bounds how many statement rows of one token or amount
    bucket are paired directly; larger groups go through the nearest-neighbour
    search. ``assignment_rounds`` are the rounds of proposals before chains of
    displacement are followed by doubling. Both change the plan only, never the
    result. ``merchant_aliases`` are (alias, name) tokens; :func:`aliases_of`
    reads them from a table.
    """

    confidence_threshold: float = CONFIDENCE_THRESHOLD
    max_candidates: int = MAX_CANDIDATES
    fold_case: bool = False
    hot_group_rows: int = 1000
    assignment_rounds: int = 8
    merchant_aliases: tuple[tuple[str, str], ...] = MERCHANT_ALIASES

    def __post_init__(self) -> None:
        if self.confidence_threshold != CONFIDENCE_THRESHOLD:
            raise ValueError(
                f"confidence_threshold is fixed at {CONFIDENCE_THRESHOLD:.2f}"
            )
        for knob in ("max_candidates", "hot_group_rows", "assignment_rounds"):
            if getattr(self, knob) < 1:
                raise ValueError(f"{knob} must be at least 1")
