"""Every registered query of the query layer against its SQL in DuckDB."""

import duckdb
import pandas as pd
import pytest

from siftwork.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(df: pd.DataFrame) -> list:
    def cell(v):
        return "null" if pd.isna(v) else f"{float(v):.6g}" if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v)

    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple(map(cell, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_equals_sql(name, spark, duck):
    got = catalogue.queries()[name](spark, SF)
    want = duck.execute(catalogue.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.toPandas()) == rows(want)


def test_filter_and_columns_reach_the_scan(spark):
    c = catalogue.catalog(spark, SF)
    q = c.query("customer").where(lambda r: (r.c_acctbal > 100) & r.c_mktsegment.startswith("B")).select(lambda r: {"k": r.c_custkey})
    plan = q.to_df()._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(c_acctbal,100" in plan and "StringStartsWith(c_" in plan
    assert "c_name" not in plan.split("ReadSchema")[-1]


def test_quantifiers_are_semi_joins(spark):
    plan = catalogue.queries()["j9_any"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
