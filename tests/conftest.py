import os
import sys
from datetime import date
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlink.schemas import LEDGER, STATEMENT  # noqa: E402
from ledgerlink.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(cpus=8, shuffle_partitions=4)


def money(value):
    return None if value is None else Decimal(str(value))


def day(value):
    return date.fromisoformat(value) if isinstance(value, str) else value


@pytest.fixture(scope="session")
def ledger(spark):
    """Build a ledger from (erp_id, date, merchant, amount, currency, tax) rows."""

    def build(rows, run_id="run"):
        typed = [
            (run_id, i, e, day(d), m, money(a), c, money(t))
            for i, (e, d, m, a, c, t) in enumerate(rows)
        ]
        return spark.createDataFrame(typed, LEDGER)

    return build


@pytest.fixture(scope="session")
def statement(spark):
    """Build a statement from (bank_ref, date, description, net, fee) rows."""

    def build(rows, run_id="run"):
        typed = [
            (run_id, i, b, day(d), s, money(n), money(f))
            for i, (b, d, s, n, f) in enumerate(rows)
        ]
        return spark.createDataFrame(typed, STATEMENT)

    return build
