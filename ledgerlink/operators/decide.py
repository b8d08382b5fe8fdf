"""Decision stage: one structured decision per candidate pair."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.config import CONFIDENCE_THRESHOLD, MERCHANT_ALIASES, ROUNDING_LIMIT
from ledgerlink.functions.text import identity_tokens
from ledgerlink.schemas import DECISION

# The decision vocabulary, and how a failed evaluation reads.
MATCH_TYPES = ("exact", "fuzzy_name_match", "rounding_discrepancy", "no_match")
FAILURE_PREFIX = "AI provider unavailable after fallback: "
FAILURE_DETAIL_CHARS = 180

# Thresholds and confidences of the rule evaluator.
MIN_IDENTITY = 0.5
MATCH_CONFIDENCE = 0.95
SAME_NAME_CONFIDENCE = 0.2
OTHER_CONFIDENCE = 0.1

DECISION_FIELDS = [field.name for field in DECISION]


def candidate_rows(
    candidates: DataFrame, ledger: DataFrame, statement: DataFrame
) -> DataFrame:
    """Candidates with the fields of both records, as evaluators see them."""
    erp = ledger.select(
        "run_id",
        F.col("row_ord").alias("erp_ord"),
        "erp_id",
        "date",
        "merchant_name",
        "amount",
        "currency",
        "tax_line_item",
    )
    bank = statement.select(
        "run_id",
        F.col("row_ord").alias("bank_ord"),
        "bank_ref",
        "settlement_date",
        "description",
        "net_amount",
        "fee_deducted",
    )
    return candidates.join(erp, ["run_id", "erp_ord"]).join(bank, ["run_id", "bank_ord"])


def identity_share(
    merchant: Column, description: Column, aliases: tuple[tuple[str, str], ...] = MERCHANT_ALIASES
) -> Column:
    """Share of the description's tokens that begin some token of the merchant.

    The tokens are handed to a function, so that each side's are found once a pair,
    not once for every use and token of the other side.
    """
    tokens = F.struct(identity_tokens(merchant, aliases).alias("names"), identity_tokens(description, aliases).alias("words"))

    def share(pair: Column) -> Column:
        known = F.filter(pair.words, lambda w: F.exists(pair.names, lambda n: n.startswith(w)))
        return F.when(F.size(pair.words) == 0, 0.0).otherwise(F.size(known).cast("double") / F.size(pair.words))

    return F.get(F.transform(F.array(tokens), share), F.lit(0))


def rule_decision(pair: DataFrame) -> Column:
    """Decide by rule: the merchant must be recognisable and the amounts close."""
    same_name = F.col("identity") >= MIN_IDENTITY
    delta = pair["amount_delta"]
    matched = same_name & (delta < F.lit(ROUNDING_LIMIT))
    kind = (
        F.when(~matched, "no_match")
        .when(delta == 0, "fuzzy_name_match")
        .otherwise("rounding_discrepancy")
    )
    confidence = (
        F.when(matched, MATCH_CONFIDENCE)
        .when(same_name, SAME_NAME_CONFIDENCE)
        .otherwise(OTHER_CONFIDENCE)
    )
    reason = (
        F.when(kind == "fuzzy_name_match", "Merchant recognised and totals agree.")
        .when(matched, "Merchant recognised and totals differ by less than one unit.")
        .when(same_name, "Merchant recognised but totals differ too much.")
        .otherwise("Merchant not recognised in the bank description.")
    )
    return F.struct(
        matched.alias("is_match"),
        confidence.alias("confidence_score"),
        kind.alias("match_type"),
        reason.alias("reasoning"),
    )


def rule_decisions(
    rows: DataFrame, aliases: tuple[tuple[str, str], ...] = MERCHANT_ALIASES
) -> DataFrame:
    named = rows.withColumn(
        "identity", identity_share(F.col("merchant_name"), F.col("description"), aliases)
    )
    return named.withColumn("decision", rule_decision(named)).select(
        *rows.columns, "decision.*"
    )


def decision_valid() -> Column:
    """Whether the decision columns honour the decision contract."""
    return F.coalesce(
        F.col("is_match").isNotNull()
        & F.col("confidence_score").between(0.0, 1.0)
        & ~F.isnan("confidence_score")
        & F.col("match_type").isin(*MATCH_TYPES)
        & (F.length("reasoning") > 0),
        F.lit(False),
    )


def validated(decisions: DataFrame) -> DataFrame:
    """Replace decisions that break the contract by a rejection that says so."""
    ok = decision_valid()
    rejection = {
        "is_match": F.lit(False),
        "confidence_score": F.lit(0.0),
        "match_type": F.lit("no_match"),
        "reasoning": F.lit(FAILURE_PREFIX + "decision violates the contract"),
    }
    return decisions.withColumn("_ok", ok).select(
        *[
            F.when(F.col("_ok"), F.col(name)).otherwise(rejection[name]).alias(name)
            if name in rejection
            else F.col(name)
            for name in decisions.columns
        ]
    )


def accepted(threshold: float = CONFIDENCE_THRESHOLD) -> Column:
    return (
        F.col("is_match")
        & (F.col("match_type") != "no_match")
        & (F.col("confidence_score") >= threshold)
    )


@dataclass(frozen=True)
class BatchEvaluator:
    """``decide(erp, bank)`` takes two frames of equal length and returns the decision fields.

    Made for models that score many pairs at once. Should a batch fail, its
    pairs are tried one by one, so that an error rejects its own pair only.
    """

    decide: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]


@dataclass(frozen=True)
class ColumnEvaluator:
    """``decide()`` returns the decision struct over the candidate columns; no Python runs on rows."""

    decide: Callable[[], Column]


Evaluator = Callable[[dict, dict], dict] | BatchEvaluator | ColumnEvaluator


def evaluate_candidates(
    rows: DataFrame,
    evaluator: Evaluator | None = None,
    parallelism: int | None = None,
    aliases: tuple[tuple[str, str], ...] = MERCHANT_ALIASES,
) -> DataFrame:
    """Decide every candidate, by the built-in rule or by a user's evaluator.

    A plain function ``evaluator(erp_row, bank_row)`` returns the decision
    fields of one pair. Python evaluators run in Arrow batches on the executors;
    ``parallelism`` spreads the pairs over that many tasks. An error in one pair
    rejects that pair only. ``aliases`` are the rule's merchant aliases.
    """
    if evaluator is None:
        return validated(rule_decisions(rows, aliases))
    if isinstance(evaluator, ColumnEvaluator):
        decided = rows.withColumn("decision", evaluator.decide()).select(*rows.columns, "decision.*")
        return validated(decided.select(*rows.columns, *DECISION_FIELDS))
    if parallelism is not None:
        if parallelism < 1:
            raise ValueError("parallelism must be at least 1")
        rows = rows.repartition(parallelism, "run_id", "erp_ord", "bank_ord")
    schema = T.StructType([*rows.schema.fields, *DECISION.fields])
    made = _frame_evaluator(evaluator) if isinstance(evaluator, BatchEvaluator) else _batch_evaluator(evaluator)
    return validated(rows.mapInPandas(made, schema))


_ERP_FIELDS = ("erp_id", "date", "merchant_name", "amount", "currency", "tax_line_item")
_BANK_FIELDS = ("bank_ref", "settlement_date", "description", "net_amount", "fee_deducted")


def _rejected(error: Exception) -> dict:
    return {
        "is_match": False,
        "confidence_score": 0.0,
        "match_type": "no_match",
        "reasoning": FAILURE_PREFIX + str(error)[:FAILURE_DETAIL_CHARS],
    }


def _frame_evaluator(evaluator: BatchEvaluator):
    def decided(erp: pd.DataFrame, bank: pd.DataFrame) -> pd.DataFrame:
        made = evaluator.decide(erp, bank)
        if len(made) != len(erp) or set(made.columns) != set(DECISION_FIELDS):
            raise ValueError("decisions differ from the contract in rows or fields")
        return made[DECISION_FIELDS].astype({"is_match": bool, "confidence_score": float}).set_axis(erp.index)

    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            erp, bank = batch[list(_ERP_FIELDS)], batch[list(_BANK_FIELDS)]
            try:
                made = decided(erp, bank)
            except Exception:
                parts = []
                for i in range(len(batch)):
                    try:
                        parts.append(decided(erp.iloc[[i]], bank.iloc[[i]]))
                    except Exception as error:
                        parts.append(pd.DataFrame([_rejected(error)], columns=DECISION_FIELDS, index=erp.index[[i]]))
                made = pd.concat(parts)
            yield pd.concat([batch, made], axis=1)

    return evaluate


def _batch_evaluator(evaluator):
    def decide(erp_row: dict, bank_row: dict) -> dict:
        try:
            decision = dict(evaluator(erp_row, bank_row))
            unknown = set(decision) ^ set(DECISION_FIELDS)
            if unknown:
                raise ValueError(f"decision fields differ: {sorted(unknown)}")
            confidence = float(decision["confidence_score"])
            texts = (decision["match_type"], decision["reasoning"])
            well_typed = isinstance(decision["is_match"], bool) and all(
                isinstance(text, str) for text in texts
            )
            if not well_typed or math.isnan(confidence):
                raise ValueError("decision values have the wrong type")
            return {**decision, "confidence_score": confidence}
        except Exception as error:
            return _rejected(error)

    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            erp = batch[list(_ERP_FIELDS)].to_dict("records")
            bank = batch[list(_BANK_FIELDS)].to_dict("records")
            decisions = [decide(e, b) for e, b in zip(erp, bank)]
            made = pd.DataFrame(decisions, columns=DECISION_FIELDS, index=batch.index)
            yield pd.concat([batch, made], axis=1)

    return evaluate
