"""Every query that needs no landing or bronze folder, against its SQL, at the smallest scale.

The rest writes hundreds of per-hour files; ``tools/compare.py`` runs all of them.
"""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from lakequeries.catalog import QUERIES  # noqa: E402
from lakequeries.oracle import SQL  # noqa: E402
from tools.compare import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
FILE_HEAVY = ("s01", "s02", "s03", "s08", "i12", "i16", "r0", "t0", "p06")
NAMES = [n for n in QUERIES if n in SQL and not n.startswith(FILE_HEAVY)]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    got = QUERIES[name](spark, SF).toArrow()
    assert compare(got, con.execute(SQL[name]).to_arrow_table()) is None


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_no_cartesian_products(spark):
    for name in ("g02_scd2_snapshot", "g07_point_in_time_join", "g07b_asof_window", "g10_fact_events", "m01_daily_activity", "m02_lifecycle_percentiles"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["m02b_line_price_percentiles"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string,l_linestatus:string>" in plan
    plan = QUERIES["q06_no_future_events"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts," in plan
