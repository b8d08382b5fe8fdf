"""Ledger and bank-statement reconciliation as Spark DataFrame operators."""

from ledgerlink.config import ReconConfig
from ledgerlink.plans.reconcile import ReconResult, reconcile

__all__ = ["ReconConfig", "ReconResult", "reconcile"]
