"""Every registered query against its DuckDB oracle on the smallest scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from haven.plans import all_oracle, all_queries
from tools.oracle_check import TABLES, canon

ORACLE = all_oracle()
NAMES = sorted(all_queries())  # the training-data queries have tests of their own
PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
PAIRING = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(NAMES) - set(ORACLE)
    assert rows_only == {"rows_per_file"}
    assert len(NAMES) >= 91


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["project_type", "total_qty"] and df.count() >= 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, sf_dir, name):
    """Same rows as the oracle; and the plan is JVM-only and pairs nothing
    (no Python evaluation, no cross or nested-loop join)."""
    df = E.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in PY_NODES + PAIRING if n in plan]
    if name not in ORACLE:
        assert len(srows) > 0
        return
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    sc, sr = canon(df.columns, srows)
    oc, orr = canon(ocols, cur.fetchall())
    assert sc == oc
    assert sr == orr
