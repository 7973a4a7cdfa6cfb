"""Sinks and layouts: pruning, CTAS, JDBC import, materialisations, overwrite."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from haven.operators.upsert import upsert, write_partitioned
from haven.plans.context import Ctx
from haven.sources import batch


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_clustered_layout_prunes(spark, sf_dir, scratch):
    """Partition by period, sort by project: both predicates reach the scan.
    (Monthly partitions here keep the test's file count small; the mechanism
    is the same as for the daily layout.)"""
    fact = Ctx(spark, sf_dir).fact.withColumn("service_month", F.trunc("service_date", "month"))
    write_partitioned(fact.sortWithinPartitions("project_id"), scratch, "service_month", mode="errorifexists")
    month = fact.agg(F.max("service_month")).first()[0]
    cond = (F.col("service_month") == F.lit(month)) & (F.col("project_id") == "P0001")
    q = spark.read.parquet(scratch).filter(cond)
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(service_month" in plan
    assert "PushedFilters: [IsNotNull(project_id), EqualTo(project_id,P0001)]" in plan
    assert q.count() == fact.filter(cond).count()


def test_scan_prunes_columns(spark, sf_dir):
    """A 2-column aggregate reads 2 columns of lineitem, not all of them."""
    plan = _plan(Ctx(spark, sf_dir).raw.services.groupBy("ServiceType").agg(F.sum("QuantityOfServices")))
    scan = [ln for ln in plan.splitlines() if "lineitem" in ln][0]
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in scan


def test_ctas_if_not_exists(spark, scratch):
    """Create-if-absent is never refreshed by a second run."""
    name = f"t_{uuid.uuid4().hex[:8]}"
    for n in (3, 5):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{scratch}' "
                  f"AS SELECT id FROM range({n})")
    assert spark.table(name).count() == 3


def test_jdbc_parallel_import(spark):
    """Split import over 4 JDBC partitions from an in-process database (no server)."""
    url = f"jdbc:derby:memory:haven{uuid.uuid4().hex[:6]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    spark.range(100).select(F.col("id").alias("N"), (F.col("id") * 2).alias("V")).write.jdbc(
        url, "SERVICES", mode="overwrite", properties=props)
    df = batch.read_jdbc_parallel(spark, url, "SERVICES", "N", 0, 100, 4, props)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 100


def test_materializations(spark, scratch):
    """View follows its source; table is a snapshot; incremental upserts by key."""
    base = f"{scratch}/src"
    spark.range(3).write.parquet(base)
    name = f"v_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS SELECT * FROM parquet.`{base}`")
    spark.read.parquet(base).write.parquet(f"{scratch}/table")
    spark.range(3, 5).write.mode("append").parquet(base)
    assert spark.sql(f"SELECT * FROM {name}").count() == 5   # the view re-reads its source
    assert spark.read.parquet(base).count() == 5
    assert spark.read.parquet(f"{scratch}/table").count() == 3
    d = dt.date(2024, 1, 1)
    inc = f"{scratch}/inc"
    write_partitioned(spark.createDataFrame([("a", d, 1)], "k string, p date, v int"), inc, "p")
    upsert(spark, inc, spark.createDataFrame([("a", d, 2), ("b", d, 3)], "k string, p date, v int"), "k", "p")
    assert sorted((r.k, r.v) for r in spark.read.parquet(inc).collect()) == [("a", 2), ("b", 3)]


def test_overwrite_idempotent(spark, sf_dir, scratch):
    """Writing the same partitions twice replaces them: no loss, no doubles."""
    fact = Ctx(spark, sf_dir).fact.withColumn("service_month", F.trunc("service_date", "month"))
    for _ in range(2):
        write_partitioned(fact, scratch, "service_month")
    back = spark.read.parquet(scratch)
    assert back.count() == fact.count()
    assert back.select("service_id").distinct().count() == fact.select("service_id").distinct().count()


def test_by_name_load_is_case_insensitive(spark, scratch):
    from haven import contracts as C
    src = spark.createDataFrame([("S1", 3, "junk")], "SERVICE_ID string, QTY string, EXTRA string")
    got = batch.load_by_name(src, C.FACT_SERVICE_EVENT).collect()[0]
    assert got.service_id == "S1" and got.qty == 3 and got.project_type is None


def test_missing_layer_reads_as_empty_contract(spark, scratch):
    """A19: an absent table is an empty frame with the contract's columns."""
    from haven import contracts as C
    df = batch.read_or_empty(spark, f"{scratch}/not-there", C.OUTREACH)
    assert df.count() == 0 and df.columns == [f.name for f in C.OUTREACH.fields]
    spark.range(1).select(F.lit("OE-1").alias("event_id")).write.parquet(f"{scratch}/there")
    assert batch.read_or_empty(spark, f"{scratch}/there", C.OUTREACH).count() == 1


def test_upsert_accepts_rows_without_a_date(spark, scratch):
    from haven.operators.upsert import upsert, write_partitioned
    rows = [("a", 1, "2024-01-01"), ("b", 2, None), ("c", 3, "2024-01-02")]
    schema = "k string, v int, d string"
    write_partitioned(spark.createDataFrame(rows, schema), scratch, "d", mode="errorifexists")
    upsert(spark, scratch, spark.createDataFrame([("a", 9, None), ("b", 8, "2024-01-02")], schema), "k", "d")
    got = {r.k: (r.v, str(r.d) if r.d else None) for r in spark.read.parquet(scratch).collect()}
    assert got == {"a": (9, None), "b": (8, "2024-01-02"), "c": (3, "2024-01-02")}


def test_fingerprint_sees_a_file_change_inside_a_folder(spark, scratch):
    import os
    from haven.sources.layers import fingerprint
    spark.range(5).write.parquet(scratch)
    before = fingerprint(spark, [scratch])
    part = next(os.path.join(scratch, f) for f in os.listdir(scratch) if f.endswith(".parquet"))
    os.utime(part, (1, 1))
    assert fingerprint(spark, [scratch]) != before


def _crash_case(spark, scratch):
    from haven.operators.upsert import write_partitioned
    schema = "k string, v int, d string"
    path = f"{scratch}/t"
    rows = [("a", 1, "2024-01-01"), ("b", 2, "2024-01-01"), ("c", 3, "2024-01-02")]
    write_partitioned(spark.createDataFrame(rows, schema), path, "d", mode="errorifexists")
    batch = spark.createDataFrame([("a", 9, "2024-01-03"), ("c", 7, "2024-01-03")], schema)
    want = {("a", 9, "2024-01-03"), ("b", 2, "2024-01-01"), ("c", 7, "2024-01-03")}
    read = lambda: {(r.k, r.v, str(r.d)) for r in spark.read.parquet(path).collect()}
    return path, batch, want, read


def test_upsert_that_died_while_publishing_loses_nothing(spark, scratch):
    """Between removing old partitions and writing new ones, unchanged rows live in the stage alone."""
    import shutil

    from haven.operators import upsert as U
    path, batch, want, read = _crash_case(spark, scratch)
    U.stage(spark, path, batch, "k", "d", spark.read.parquet(path))
    shutil.rmtree(f"{path}/d=2024-01-01")  # the crash: a touched partition is gone
    U.upsert(spark, path, batch, "k", "d")
    assert read() == want
    U.upsert(spark, path, batch, "k", "d")  # and once more: the same table
    assert read() == want


def test_upsert_that_died_while_staging_leaves_the_table(spark, scratch):
    import os

    from haven.operators import upsert as U
    path, batch, want, read = _crash_case(spark, scratch)
    before = read()
    batch.limit(1).write.parquet(f"{path}__stage/content")  # no list of partitions: incomplete
    assert not U.recover(spark, path, "d") and read() == before
    assert not os.path.exists(f"{path}__stage")
    U.upsert(spark, path, batch, "k", "d")
    assert read() == want


def test_a_silver_table_that_fails_its_gate_is_not_published(spark, scratch):
    import os

    import pytest

    from haven.operators.quality import silver_gate
    from haven.sources.layers import QualityError, materialize
    src = f"{scratch}/src"
    bronze = spark.createDataFrame([(f"k{i}", "x") for i in range(40)], "id string, note string")
    bronze.write.parquet(src)
    name = f"gate_{uuid.uuid4().hex[:8]}"
    gate = lambda silver: silver_gate("t", bronze, "id", silver)
    with pytest.raises(QualityError, match="reconcile counts"):
        materialize(spark, name, lambda: bronze.limit(10), [src], gate=gate)
    leak = bronze.withColumn("note", F.lit("123-45-6789"))
    with pytest.raises(QualityError, match="personal data in note"):
        materialize(spark, name, lambda: leak, [src], gate=gate)
    root = f"{spark.conf.get('spark.checkpoint.dir')}/haven/layers/shared"
    assert not os.path.isdir(root) or not [f for f in os.listdir(root) if f.startswith(name)]
    assert materialize(spark, name, lambda: bronze, [src], gate=gate).count() == 40


def test_increment_looks_back_for_late_older_rows(spark, scratch):
    """A row that arrives after the mark has passed its day needs the look-back."""
    from haven.operators.upsert import high_water_mark, increment
    day = lambda n: dt.date(2024, 1, n)
    schema = "k string, v int, d date"
    write_partitioned(spark.createDataFrame([("a", 1, day(8)), ("b", 2, day(10))], schema), scratch, "d",
                      mode="errorifexists")
    source = spark.createDataFrame([("a", 1, day(8)), ("b", 2, day(10)), ("late", 3, day(7)), ("old", 4, day(1)),
                                    ("new", 5, day(11)), ("none", 6, None)], schema)
    mark = high_water_mark(spark.read.parquet(scratch), "d")
    assert {r.k for r in increment(source, "d", mark).collect()} == {"b", "new"}
    upsert(spark, scratch, increment(source, "d", mark, lookback_days=3), "k", "d")
    assert {(r.k, r.v) for r in spark.read.parquet(scratch).collect()} == {("a", 1), ("b", 2), ("late", 3), ("new", 5)}
    assert increment(source, "d", None, 3).count() == 6


def test_increment_with_undated_rows(spark, scratch):
    from haven.operators.upsert import high_water_mark, increment
    day = lambda n: dt.date(2024, 1, n)
    schema = "k string, v int, d date"
    write_partitioned(spark.createDataFrame([("a", 1, day(8)), ("b", 2, day(10))], schema), scratch, "d",
                      mode="errorifexists")
    source = spark.createDataFrame([("a", 1, day(8)), ("b", 2, day(10)), ("new", 5, day(11)), ("none", 6, None),
                                    ("nil", 7, None)], schema)
    for _ in range(2):  # again changes nothing
        mark = high_water_mark(spark.read.parquet(scratch), "d")
        upsert(spark, scratch, increment(source, "d", mark, undated=True), "k", "d")
        assert sorted((r.k, r.v, r.d) for r in spark.read.parquet(scratch).collect()) == sorted(map(tuple, source.collect()))


def test_incremental_fact_keeps_undated_rows(spark, sf_dir, monkeypatch):
    from haven.plans import history
    fact = history.Ctx(spark, sf_dir).fact
    undated = F.pmod(F.xxhash64("service_id"), F.lit(50)) == 0
    planted = fact.withColumn("service_date", F.when(~undated, F.col("service_date")))
    monkeypatch.setattr(history, "Ctx", lambda spark, sf_dir: type("Planted", (), {"fact": planted}))
    got = history.incremental_fact(spark, sf_dir)
    n = planted.filter("service_date IS NULL").count()
    assert n > 0 and got.filter("service_date IS NULL").count() == n
    assert got.count() == planted.count() == got.select("service_id").distinct().count()


def test_rows_per_file_sum_to_the_table(spark, sf_dir):
    from haven.plans.kpis import rows_per_file
    got = rows_per_file(spark, sf_dir).agg(F.sum("n_rows")).first()[0]
    assert got == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()


def test_content_checksum_sees_what_sums_do_not(spark):
    """Same rows in another order agree; a changed hash, a moved null or a lost copy do not."""
    from haven.operators.quality import content_checksum
    schema, cols = "h string, t string, qty int", ["h", "t", "qty"]
    rows = [("x", "Meal", 1), ("y", None, 2), ("y", None, 2), (None, "Meal", 3)]
    of = lambda r: tuple(content_checksum(spark.createDataFrame(r, schema), cols).first())
    assert of(rows) == of(rows[::-1])
    for other in ([("z", "Meal", 1), *rows[1:]], [*rows[:3], ("Meal", None, 3)], rows[:3], [*rows[:1], *rows[:1], *rows[2:]]):
        assert of(rows) != of(other)
    assert of([]) == (0, 0)
