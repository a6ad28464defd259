import math

import duckdb
import pytest

import __spark_entry__ as entry
from scriptmill.plans.oracle import ORACLE
from scriptmill.plans.queries import QUERIES
from scriptmill.plans.views import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)) or hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["category", "n"] and len(rows) > 0


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s_cols = df.columns
    s = df.collect()
    cur = con.execute(ORACLE[name])
    d_cols = [x[0] for x in cur.description]
    d = cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    ss = sorted((tuple(_norm(r[i]) for i in si) for r in s), key=repr)
    dd = sorted((tuple(_norm(r[i]) for i in di) for r in d), key=repr)
    assert ss == dd


def test_no_python_udf_in_any_plan(spark):
    for name, q in QUERIES.items():
        plan = q(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
