"""Every registered query equals its SQL oracle (DuckDB) on the smallest
driver tables; queries without an oracle must at least run."""
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = os.environ.get("WARDFLOW_TEST_SF", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _norm(df: pd.DataFrame):
    df = df[sorted(df.columns)]
    out = []
    for row in df.itertuples(index=False):
        vals = []
        for v in row:
            if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
                vals.append(None)
            elif isinstance(v, float):
                vals.append(round(v, 6))
            elif hasattr(v, "isoformat"):
                vals.append(pd.Timestamp(v).isoformat())
            elif hasattr(v, "item"):
                vals.append(v.item())
            else:
                vals.append(v)
        out.append(tuple(vals))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns) > 0
        return
    exp = con.sql(sql).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert _norm(got) == _norm(exp)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 27 and df.count() >= 0
