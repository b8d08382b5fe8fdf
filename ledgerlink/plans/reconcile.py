"""The reconciliation pipeline over two DataFrames."""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame

from ledgerlink.config import ReconConfig
from ledgerlink.operators.assign import greedy_assignment, judged_decisions
from ledgerlink.operators.candidates import top_candidates
from ledgerlink.operators.decide import (
    DECISION_FIELDS,
    Evaluator,
    accepted,
    candidate_rows,
    evaluate_candidates,
)
from ledgerlink.operators.exact import (
    available_statement,
    exact_matches,
    unresolved_ledger,
    unresolved_statement,
    without_keys,
)
from ledgerlink.operators.metrics import run_metrics
from ledgerlink.operators.report import (
    bank_exceptions,
    decision_log,
    erp_exceptions,
    matched_pairs,
    matched_report,
)
from ledgerlink.session import cut_lineage, lasting, passing_results

#: What identifies a decision, and what is kept of one: the fields that products show, not both records.
_PLACE = ["run_id", "erp_id", "bank_ref", "erp_ord", "rank"]
_DECIDED = [*_PLACE, "bank_ord", *DECISION_FIELDS, "merchant_name", "description", "currency"]


@dataclass(frozen=True)
class ReconResult:
    """Every product of a run, each computed when first asked for.

    Results that feed several products are written once (``cut_lineage``); they
    hold keys and scores, not whole records.
    """

    ledger: DataFrame
    statement: DataFrame
    config: ReconConfig
    evaluator: Evaluator | None = None
    parallelism: int | None = None
    seconds: dict[str, float] = field(default_factory=dict, compare=False)

    def _written(self, stage: str, df: DataFrame) -> DataFrame:
        """``df`` written once, with the seconds this took added to its stage."""
        started = time.perf_counter()
        written = lasting(df)
        self.seconds[stage] = self.seconds.get(stage, 0.0) + time.perf_counter() - started
        return written

    def measure(self) -> dict[str, float]:
        """Run the stages, unless they ran already, and return the seconds of each.

        Both stages end in written results, so this is the time of the work, not
        of planning it. The keys are those of the metrics document.
        """
        self.logged
        return {**self.seconds, "total": sum(self.seconds.values())}

    @cached_property
    def exact(self) -> DataFrame:
        return self._written("deterministic", exact_matches(self.ledger, self.statement))

    @cached_property
    def unresolved_ledger(self) -> DataFrame:
        return unresolved_ledger(self.ledger, self.exact)

    @cached_property
    def unresolved_statement(self) -> DataFrame:
        return unresolved_statement(self.statement, self.exact)

    @cached_property
    def candidates(self) -> DataFrame:
        exact = self.exact
        with passing_results(exact.sparkSession):
            available = available_statement(self.unresolved_statement, exact)
            return self._written(
                "llm", top_candidates(self.unresolved_ledger, available, self.config)
            )

    @cached_property
    def decisions(self) -> DataFrame:
        rows = candidate_rows(self.candidates, self.unresolved_ledger, self.unresolved_statement)
        made = evaluate_candidates(rows, self.evaluator, self.parallelism, self.config.merchant_aliases)
        return self._written("llm", made.select(*_DECIDED))

    @cached_property
    def _live_decisions(self) -> DataFrame:
        """Decisions on ledger ids that no exact pair has used already."""
        return without_keys(self.decisions, self.exact, ["run_id", "erp_id"])

    @property
    def _accepted(self) -> Column:
        return accepted(self.config.confidence_threshold)

    @cached_property
    def assigned(self) -> DataFrame:
        eligible = self._live_decisions.where(self._accepted)
        with passing_results(eligible.sparkSession):
            return self._written("llm", greedy_assignment(eligible, self.config))

    @cached_property
    def _judged(self) -> DataFrame:
        """Keys, outcome and confidence of all live decisions, and whether each is logged."""
        keys = self._live_decisions.select(*_PLACE, "is_match", "confidence_score")
        return self._written("llm", judged_decisions(keys, self.assigned))

    @property
    def logged(self) -> DataFrame:
        """The log's keys, outcomes and confidence without its texts, for everything that only counts."""
        return self._judged.where("logged").drop("logged")

    @cached_property
    def log(self) -> DataFrame:
        late = self._judged.where("not logged").select(*_PLACE)
        logged = self._live_decisions.join(late, _PLACE, "left_anti")
        return self._written("llm", decision_log(logged))

    @cached_property
    def pairs(self) -> DataFrame:
        """Matched pairs without their records, for everything that only counts."""
        return cut_lineage(matched_pairs(self.exact, self.assigned, self.decisions.where(self._accepted)))

    @cached_property
    def matched(self) -> DataFrame:
        return matched_report(self.pairs, self.ledger, self.statement)

    @cached_property
    def erp_exceptions(self) -> DataFrame:
        return erp_exceptions(
            self.ledger, self._matched_ids, self.logged, self.config.confidence_threshold
        )

    @cached_property
    def bank_exceptions(self) -> DataFrame:
        return bank_exceptions(
            self.statement, self._matched_ids, self.logged, self.config.confidence_threshold
        )

    @cached_property
    def exceptions(self) -> DataFrame:
        return cut_lineage(self.erp_exceptions.unionByName(self.bank_exceptions))

    @cached_property
    def open_records(self) -> DataFrame:
        """The exceptions without their records' details, for everything that only counts."""
        if "exceptions" in self.__dict__:  # written already
            return self.exceptions.drop("details")
        sides = self.erp_exceptions.drop("details"), self.bank_exceptions.drop("details")
        return cut_lineage(sides[0].unionByName(sides[1]))

    @cached_property
    def _matched_ids(self) -> DataFrame:
        pair = ["run_id", "erp_id", "bank_ref"]
        return self.exact.select(*pair).unionByName(self.assigned.select(*pair))

    @cached_property
    def metrics(self) -> DataFrame:
        return run_metrics(
            self.ledger,
            self.statement,
            self.candidates,
            self.logged,
            self.pairs,
            self.open_records,
        )


def reconcile(
    ledger: DataFrame,
    statement: DataFrame,
    config: ReconConfig | None = None,
    evaluator: Evaluator | None = None,
    parallelism: int | None = None,
) -> ReconResult:
    """Match ledger and statement rows, run by run.

    The inputs follow ``schemas.LEDGER`` and ``schemas.STATEMENT``. ``evaluator``
    replaces the built-in rule: a function of two rows, a ``BatchEvaluator`` or a
    ``ColumnEvaluator``. ``parallelism`` bounds how many tasks run it.
    """
    return ReconResult(ledger, statement, config or ReconConfig(), evaluator, parallelism)
