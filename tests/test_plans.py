"""Plan-level guarantees: pushdown, naming (JVM-only plans are checked per query in test_queries)."""

from __future__ import annotations

import re

import __spark_entry__ as E


def test_gold_is_snake_case(spark, sf_dir):
    """M6: every gold table uses snake_case column names."""
    q = E.queries()
    for name in ("fact_service_event", "dim_project", "dim_client", "dim_date", "dim_program_type",
                 "scd2_client_history"):
        for c in q[name](spark, sf_dir).columns:
            assert re.fullmatch(r"[a-z][a-z0-9_]*", c) or c in ("DisablingCondition", "HousingStatus",
                                                                "IncomeAmount", "ContactStatus"), (name, c)


def test_fact_filters_reach_the_scan(spark, sf_dir):
    """A date filter on the gold fact is pushed into the Parquet scan."""
    from pyspark.sql import functions as F
    fact = E.queries()["fact_service_event"](spark, sf_dir)
    plan = fact.filter(F.col("service_date") == F.lit("2000-01-01").cast("date"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(service_date), EqualTo(service_date,2000-01-01)]" in plan
