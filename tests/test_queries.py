"""Every query with SQL against DuckDB, and the shape of the entry module."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from celltrove.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def normal(rows):
    return sorted(tuple(repr(float(v)) if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    names = sorted(df.columns)
    got = df.select(*[f"`{c}`" for c in names]).collect()
    want = duck.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in names)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert normal(got) == normal(want)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_other_queries_run(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(registry.queries()) <= set(entry.queries())


#: Their plans are reads of tables that earlier steps wrote; the other tests run them.
LONG = {"modularity_clusters", "graph_layout", "expression_pca", "expression_loadings", "label_propagation", "kmeans_elbow"}


def test_plans_have_no_product(spark):
    for name, q in registry.queries().items():
        if name in LONG:
            continue
        plan = q(spark, SF)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
