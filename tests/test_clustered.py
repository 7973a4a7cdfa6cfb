"""Clustered tables: files a query opens; gates that stop a layer."""

from __future__ import annotations

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from haven.operators import quality
from haven.sources.clustered import curve, manifest, read_within, splitters, write_clustered
from haven.sources.layers import materialize

DAY = dt.date(2024, 1, 1)


def _days(spark, n=6000):
    r = random.Random(2)
    rows = [(i, None if r.random() < .01 else DAY + dt.timedelta(days=int(r.random() ** 2 * 300)),
             None if r.random() < .01 else f"P{int(r.random() ** 3 * 200):03d}") for i in range(n)]
    return spark.createDataFrame(rows, "id int, day date, project string"), rows


def test_one_day_and_one_project_open_few_files(spark, scratch):
    df, rows = _days(spark)
    path = f"{scratch}/t"
    write_clustered(df, path, ["day", "project"], files=64)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(len(rows)))  # the manifest is no part of it
    m = manifest(spark, path).collect()
    assert len(m) > 40 and sum(r.n_rows for r in m) == len(rows) and max(r.n_rows for r in m) < 6 * len(rows) / len(m)
    for ranges, keep in (({"day": (DAY + dt.timedelta(days=9),) * 2}, lambda d, p: d == DAY + dt.timedelta(days=9)),
                         ({"project": ("P007", "P007")}, lambda d, p: p == "P007"),
                         ({"day": (DAY, DAY + dt.timedelta(days=20)), "project": ("P000", "P003")},
                          lambda d, p: d and p and d <= DAY + dt.timedelta(days=20) and p <= "P003"),
                         ({"day": (dt.date(2024, 8, 1), None)}, lambda d, p: d and d >= dt.date(2024, 8, 1))):
        got = read_within(spark, path, **ranges)
        assert sorted(r.id for r in got.collect()) == [i for i, d, p in rows if keep(d, p)]
        assert 0 < len(got.inputFiles()) <= 0.4 * len(m), ranges
    assert read_within(spark, path, day=(dt.date(1999, 1, 1), dt.date(1999, 1, 2))).collect() == []
    assert read_within(spark, path).count() == len(rows)


def test_splitters_follow_the_rows_and_odd_tables_are_written(spark, scratch):
    df, _ = _days(spark)
    cuts = splitters(df, ["day", "project"], bits=3)
    assert all(len(v) <= 7 and v == sorted(set(v)) for v in cuts.values())
    one = spark.createDataFrame([(1, None, "x")] * 5, "id int, day date, project string")
    for i, table in enumerate((one, one.limit(0))):
        write_clustered(table, f"{scratch}/{i}", ["day", "project"])
        assert spark.read.parquet(f"{scratch}/{i}").count() == table.count()


def test_the_fact_is_read_by_manifest(spark, sf_dir):
    from haven.plans.context import Ctx
    ctx = Ctx(spark, sf_dir)
    day = ctx.last_service_date()
    assert day == ctx.fact.agg(F.max("service_date")).first()[0]
    want = ctx.fact.filter(F.col("service_date") == F.lit(day))
    assert sorted(map(tuple, ctx.fact_within(service_date=(day, day)).collect())) == sorted(map(tuple, want.collect()))


def _fact(spark, **broken):
    row = dict(service_id="s1", client_id_hash="a" * 64, enrollment_id="e", project_id="p", project_type=1, service_type="Meal",
               service_date=DAY, qty=1, financial_assistance=0)
    rows = [dict(row, service_id=f"s{i}") for i in range(20)] + [dict(row, **broken)]
    return spark.createDataFrame([tuple(r.values()) for r in rows], "service_id string, client_id_hash string, enrollment_id string, "
                                 "project_id string, project_type int, service_type string, service_date date, qty int, financial_assistance int")


def test_a_broken_gold_table_is_not_published(spark, scratch):
    services = spark.range(21)
    services.write.parquet(f"{scratch}/src")
    for broken, rule in (({"service_id": None}, "not_null service_id"), ({"client_id_hash": "C00000001"}, "match_regex client_id_hash"),
                         ({"service_type": "123-45-6789"}, "personal data in service_type")):
        name = f"gold_{uuid.uuid4().hex[:8]}"
        with pytest.raises(quality.QualityError, match=rule):
            materialize(spark, name, lambda b=broken: _fact(spark, **b), [f"{scratch}/src"], ["service_date", "project_id"],
                        lambda fact: quality.gold_gate(fact, services))
    with pytest.raises(quality.QualityError, match="reconcile counts"):
        quality.require(quality.gold_gate(_fact(spark).limit(15), services), "gold")
    out = materialize(spark, f"gold_{uuid.uuid4().hex[:8]}", lambda: _fact(spark), [f"{scratch}/src"], ["service_date", "project_id"],
                      lambda fact: quality.gold_gate(fact, services))
    assert out.count() == 21


def test_the_input_is_counted_while_it_is_written(spark, scratch):
    bronze = spark.range(5000).select(F.concat(F.lit("k"), F.col("id") % 4000).alias("id"), F.lit("x").alias("note"))
    for keep, ok in ((4000, True), (3600, False)):
        counted, seen = quality.observed_input(bronze, "id")
        counted.groupBy("id").agg(F.first("note").alias("note")).orderBy("id").limit(keep).write.parquet(f"{scratch}/{keep}")
        silver = spark.read.parquet(f"{scratch}/{keep}")
        assert seen.get["bronze_rows"] == 5000
        if ok:
            quality.require(quality.observed_gate("t", seen, silver), "t")
        else:
            with pytest.raises(quality.QualityError, match="reconcile counts"):
                quality.require(quality.observed_gate("t", seen, silver), "t")


def test_a_failed_suite_stops_the_job(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    suite = quality.run_suite(df, "t", [quality.not_null("id"), quality.unique("id")])
    with pytest.raises(quality.QualityError, match="t: not_null id, unique id"):
        quality.require(suite, "t")
    quality.require(quality.run_suite(df.limit(1), "t", [quality.not_null("id"), quality.unique("id")]), "t")


def test_the_place_on_the_curve_is_compiled_and_counts_the_cuts(spark):
    df, rows = _days(spark, 400)
    cuts = splitters(df, ["day", "project"], bits=3)
    place = df.select("day", "project", curve(cuts).alias("place"))

    def want(*values):
        below = [sum(v is not None and c <= v for c in cuts[name]) for name, v in zip(cuts, values, strict=True)]
        return sum((n >> b & 1) << (2 * b + i) for i, n in enumerate(below) for b in range(3))
    got = place.collect()
    assert len({r.place for r in got}) > 20 and all(r.place == want(r.day, r.project) for r in got)
    plan = place._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "array(" not in plan  # comparisons alone: no function is called for each cut
    assert {r.place for r in df.select(curve({"day": [], "project": []}).alias("place")).collect()} == {0}


def test_a_gate_reads_its_table_once(spark, scratch):
    _fact(spark).write.parquet(f"{scratch}/fact")
    fact = spark.read.parquet(f"{scratch}/fact")
    seen = type("Seen", (), {"get": {"bronze_keys": 21}})
    for gate in (quality.gold_gate(fact, spark.range(21)), quality.observed_gate("t", seen, fact)):
        assert gate._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
        assert {r.status for r in gate.collect()} == {"OK"}


def test_raw_personal_data_is_found_as_by_the_patterns(spark):
    values = ["123456789", "12345678", "1234567890", "123-45-6789", "123-45-678", "123456789\n", "123-45-6789\r\n", "123456789\u2028",
              "123-45-6789\u2028", "\n123456789", " 123456789", "a123456789", "\u0661\u0662\u0663456789", "a@b.co", "1@b.co", "é@ü.co",
              "a@b.co\n", "a @b.co", "@b.co", "a@b", "a@b@c.org", "123456789@x.yz", ":23456789", "", None, "a" * 64]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    plain = df.filter(F.col("v").rlike(quality.RAW_SSN) | F.col("v").rlike(quality.RAW_EMAIL))
    assert sorted(r.v for r in df.filter(quality._raw_pii(F.col("v"))).collect()) == sorted(r.v for r in plain.collect())
    assert quality.pii_scan(df, "t").first()["n_raw_pii"] == plain.count() >= 8
