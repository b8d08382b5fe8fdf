"""Every named query against its SQL, and the plans against forbidden nodes."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402
from conftest import SF_DIR  # noqa: E402
from ledgerlink.plans.oracles import oracle_queries  # noqa: E402
from ledgerlink.plans.queries import QUERIES, forget_results  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    forget_results()
    return compare.database(SF_DIR)


def test_all_oracles_belong_to_a_query():
    assert set(oracle_queries()) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_query_equals_its_sql(spark, database, name):
    assert compare.compare(spark, database, SF_DIR, name).startswith("ok")


@pytest.mark.parametrize("name", ["exact_matches_noisy", "matched_report", "erp_exceptions", "category_prf"])
def test_no_pairing_without_a_key(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_scan_reads_only_what_is_needed(spark):
    frame = QUERIES["exact_matches_noisy"](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("o_orderpriority" not in s for s in schemas)
