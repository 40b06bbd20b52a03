"""Every registered query against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from catchment.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "tinyint": "TINYINT", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "-"
    return f"{v + 0.0:.4f}".replace("-0.0000", "0.0000") if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in SQL:
        assert got
        return
    rel = con.execute(SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    kinds = dict(df.dtypes)
    assert {d[0]: str(d[1]) for d in rel.description} == {c: KINDS[kinds[c]] for c in columns}
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


def test_donors_of_snow_years_at_nearly_equal_distances(spark, con, tmp_path):
    """Days on which many polygons need a donor, and two stand at distances that only rounding tells apart."""
    con.execute(f"COPY (SELECT * FROM read_parquet('/root/testdata/sf0.01/lineitem.parquet') WHERE year(l_shipdate) = 1996) TO '{tmp_path}/lineitem.parquet'")
    columns = ["hru", "t", "lower_bound", "upper_bound", "n_sources", "nn_filled"]
    got = sorted(tuple(map(plain, r)) for r in QUERIES["e6_swe_by_year"](spark, str(tmp_path)).select(columns).collect())
    sql = SQL["e6_swe_by_year"].replace("FROM lineitem", f"FROM read_parquet('{tmp_path}/lineitem.parquet')")
    assert got == sorted(tuple(map(plain, r)) for r in con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())
