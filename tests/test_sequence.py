"""ordered_by_key (day-bucketed, skew-split) equals the plain per-key window."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from haven.operators.sequence import hot_splits, ordered_by_key

T0 = dt.datetime(2024, 1, 1)

rows_st = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 5 * 24 * 60),
              st.one_of(st.none(), st.integers(0, 9))),
    min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=12, deadline=None)
@given(rows_st)
def test_bucketed_equals_plain_window(spark, rows):
    df = spark.createDataFrame([(k, T0 + dt.timedelta(minutes=m), v) for k, m, v in rows],
                               "k string, t timestamp, v int")
    got = ordered_by_key(df.withColumn("f", F.col("v")), ["k"], ["t"],
                         lag={"lag_v": "v"}, lead={"lead_t": "t"}, ffill=["f"],
                         row_number="rn", running_sum={"cum": "v"})
    w = Window.partitionBy("k").orderBy("t")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "t", "v",
                     F.lag("v").over(w).alias("lag_v"), F.lead("t").over(w).alias("lead_t"),
                     F.last("v", ignorenulls=True).over(run).alias("f"),
                     F.row_number().over(w).cast("bigint").alias("rn"),
                     F.sum("v").over(run).alias("cum"))
    cols = ["k", "t", "v", "lag_v", "lead_t", "f", "rn", "cum"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())


def test_null_keys_and_times_equal_the_plain_window(spark):
    from pyspark.sql import Window
    rows = [(k, t, i) for i, (k, t) in enumerate(
        [(None, "2024-01-01 00:00:00"), (None, "2024-01-02 00:00:00"), (None, None), ("a", None), ("a", "2024-01-01 05:00:00"),
         ("a", "2024-01-03 05:00:00")])]
    df = spark.createDataFrame(rows, "k string, t string, v long").withColumn("t", F.col("t").cast("timestamp"))
    w = Window.partitionBy("k").orderBy("t")
    want = df.select("v", F.lag("v").over(w).alias("l"), F.row_number().over(w).alias("n")).collect()
    got = ordered_by_key(df, ["k"], ["t"], lag={"l": "v"}, row_number="n").select("v", "l", "n").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_a_hot_key_within_one_day_is_cut(spark):
    """A client with a third of all rows on one day spreads over parts; results equal the plain window."""
    rows = [("hot", T0 + dt.timedelta(seconds=7 * i), i if i % 3 else None) for i in range(3000)]
    rows += [("hot", None, 1), (None, T0, 2), (None, T0 + dt.timedelta(days=1), 3)]
    rows += [(f"k{i % 40}", T0 + dt.timedelta(minutes=i), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v int").repartition(6)
    splits = hot_splits(df, ["k"], "t", rows=500)
    found = splits.collect()
    assert [(r.k, r._bucket) for r in found] == [("hot", T0)] and 200 < len(found[0]._cuts) <= 255
    parts = df.filter("k = 'hot'").withColumn("n", F.size(F.filter(F.array(*map(F.lit, found[0]._cuts)), lambda c: c <= F.unix_micros("t"))))
    assert parts.groupBy("n").count().agg(F.max("count")).first()[0] < 60
    got = ordered_by_key(df.withColumn("f", F.col("v")), ["k"], ["t"], lag={"lag_v": "v"}, lead={"lead_t": "t"}, ffill=["f"],
                         row_number="rn", running_sum={"cum": "v"}, splits=splits)
    w = Window.partitionBy("k").orderBy("t")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "t", "v", F.lag("v").over(w).alias("lag_v"), F.lead("t").over(w).alias("lead_t"),
                     F.last("v", ignorenulls=True).over(run).alias("f"), F.row_number().over(w).cast("bigint").alias("rn"),
                     F.sum("v").over(run).alias("cum"))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got.select(*want.columns).collect())) == sorted(map(key, want.collect()))
    assert hot_splits(df, ["k"], "t", rows=5000).count() == 0
