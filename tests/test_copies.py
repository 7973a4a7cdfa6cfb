"""Checksum tree and schema log."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from haven.operators.hashtree import differences, leaves, require_equal
from haven.operators.quality import QualityError
from haven.sources import schema_log

DAY = dt.date(2024, 1, 1)
SCHEMA = "k string, d date, v int, w string"


def _table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_each_changed_moved_lost_and_added_row_is_named(spark):
    rows = [(f"k{i}", None if i % 50 == 0 else DAY + dt.timedelta(days=i % 20), i, None if i % 7 else "w") for i in range(400)]
    copy = [list(r) for r in rows]
    copy[3][2] = -1                                   # changed
    copy[4][1] = DAY + dt.timedelta(days=11)          # moved
    copy[50][1] = DAY                                 # moved from no date
    copy[7][3], copy[7][2] = "w", None                # a value and a null
    del copy[9]                                       # lost
    copy += [["new", DAY, 1, "x"], [None, DAY, 1, "x"]]  # added
    a, b = _table(spark, rows), _table(spark, copy)
    got = sorted((r.key or "", r.change, r.left_date, r.right_date) for r in differences(a, b, "k", "d", buckets=8).collect())
    day = lambda i: DAY + dt.timedelta(days=i % 20)
    assert got == sorted([("k3", "changed", day(3), day(3)), ("k4", "moved", day(4), day(11)), ("k50", "moved", None, DAY),
                          ("k7", "changed", day(7), day(7)), ("k9", "lost", day(9), None), ("new", "added", None, DAY), ("", "added", None, DAY)],
                         key=lambda x: (x[0], x[1]))
    with pytest.raises(QualityError, match=r"copy: 2 added .*, 2 changed .*, 1 lost \(such as k9\), 2 moved"):
        require_equal(a, b, "k", "d", "copy")
    require_equal(a, _table(spark, rows[::-1]), "k", "d", "copy")


def test_only_unlike_dates_are_read(spark, scratch):
    rows = [(f"k{i}", DAY + dt.timedelta(days=i % 20), i, "w") for i in range(400)]
    for name, value in (("a", 0), ("b", 1)):
        changed = [(k, d, value if k == "k5" else v, w) for k, d, v, w in rows]
        _table(spark, changed).write.partitionBy("d").parquet(f"{scratch}/{name}")
    a, b = (spark.read.parquet(f"{scratch}/{n}").select("k", "d", "v", "w") for n in "ab")
    stored = {n: leaves(t, "k", "d", buckets=8).cache() for n, t in (("a", a), ("b", b))}
    out = differences(a, b, "k", "d", buckets=8, left_leaves=stored["a"], right_leaves=stored["b"])
    assert [r.key for r in out.collect()] == ["k5"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [(d#") + plan.count("PartitionFilters: [isnotnull(d") >= 2 and "2024-01-06" in plan


def test_schema_log_widens_adds_and_refuses(spark, scratch):
    path = f"{scratch}/t"
    a = spark.createDataFrame([(1, 1.5)], "id int, x float")
    assert schema_log.append(a, path) == 0 and schema_log.append(a, path) == 0
    assert schema_log.append(spark.createDataFrame([(5_000_000_000, 2.25, "n")], "id long, x double, note string"), path) == 1
    assert schema_log.append(spark.createDataFrame([("m", 7)], "Note string, id int"), path) == 1  # narrower, reordered, other case
    for bad in ("id string, x double", "id long, x string", "id long, ID int"):
        df = spark.range(1).selectExpr(*[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in bad.split(", ")])
        with pytest.raises(schema_log.SchemaError):
            schema_log.append(df, path)
    out = schema_log.read(spark, path)
    assert out.schema.simpleString() == "struct<id:bigint,x:double,note:string>"
    got = sorted(((r.id, r.x, r.note) for r in out.collect()), key=str)
    assert got == sorted([(1, 1.5, None), (1, 1.5, None), (5_000_000_000, 2.25, "n"), (7, None, "m")], key=str)
    assert schema_log.schema(spark, path, 0).simpleString() == "struct<id:int,x:float>"
    assert schema_log.read(spark, path).filter(F.col("id") > 10).count() == 1


def test_two_writers_of_one_schema_version(spark, scratch):
    from pyspark.sql import types as T
    path = f"{scratch}/t"
    schema_log.append(spark.createDataFrame([(1,)], "id int"), path)
    schema_log._add_version(spark, path, 1, T.StructType([T.StructField("id", T.LongType())]))
    with pytest.raises(Exception, match="(?i)exist"):
        schema_log._add_version(spark, path, 1, T.StructType([T.StructField("id", T.StringType())]))
    assert schema_log.schema(spark, path).simpleString() == "struct<id:bigint>"
