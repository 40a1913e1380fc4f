"""Every registered query against its SQL."""

import oracle
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_matches_sql(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    assert oracle.compare(df, db, entry.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_clamp_plan_pushes_columns_and_needs_no_shuffle(spark):
    df = entry.queries()["clamp_join_location"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and "p_type" not in plan
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_orderkey)]" in plan
    assert "Exchange hashpartitioning" not in plan
