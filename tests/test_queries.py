"""Every named query against its SQL on the smallest tables."""

import os

import pytest

from grantflow.queries import REGISTRY
from oracle import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    q = REGISTRY[name]
    assert q.sql is not None
    problem, rows, _ = compare(spark, con, FOLDER, name, q.run, q.sql)
    assert problem is None, problem
    assert rows > 0 or name in ("alert_sum", "alert_ratio_now")


def test_entry(spark):
    import __spark_entry__ as entry

    assert {r.outcome for r in entry.entry(spark).collect()} <= {"created", "updated", "skipped", "failed"}
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())
