import duckdb
import pytest

from scriptmill.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    cols = sorted(d[0] for d in cur.description)
    want = sorted((dict(zip([d[0] for d in cur.description], r)) for r in cur.fetchall()), key=str)
    df = QUERIES[name](spark, SF)
    got = [r.asDict() for r in df.collect()]
    assert sorted(df.columns) == cols
    rows = lambda xs: sorted(tuple(str(x[c]) for c in cols) for x in xs)
    assert rows(got) == rows(want)
