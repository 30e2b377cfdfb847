"""Every registered query gives the rows of its SQL on the driver's smallest tables."""

import os

import pytest

from __spark_entry__ import ENTRY_FOLDER, entry, oracle_sql, queries
from suite.compare import connect, differences
from suite.registry import ORACLES, QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(ENTRY_FOLDER), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(ENTRY_FOLDER)


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    rows, notes = differences(queries()[name](spark, ENTRY_FOLDER), duck, oracle_sql()[name])
    assert not notes
    assert rows > 0


@pytest.fixture
def compiled(spark):
    """Code generation as users have it; the other tests interpret their many tiny plans, which is faster."""
    names = ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "true")
    spark.conf.set(names[1], "FALLBACK")
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("name", [*sorted(QUERIES)[::8], "activity_trend", "engagement_vs_performance", "profile_lines"])
def test_query_compiled(compiled, duck, name):
    _, notes = differences(queries()[name](compiled, ENTRY_FOLDER), duck, oracle_sql()[name])
    assert not notes


@pytest.mark.parametrize("name", ["dq_all", "dq_student_vle"])
def test_checks_scan_stored_tables(spark, name):
    """Their passes do not derive the tables anew."""
    plan = queries()[name](spark, ENTRY_FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "o_orderkey" not in plan
