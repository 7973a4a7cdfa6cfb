"""Mergeable daily state and small-file compaction."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from haven.operators import quality
from haven.operators.daily_state import DISTINCT_ERROR, RANK_ERROR, DailyState, merge_days, reduce_days, report
from haven.sources.compaction import CompactedTable, bins

DAY = dt.date(2024, 1, 1)


def _shape():
    return {"sums": ["qty"], "distinct": ["client"], "spread": ["qty"],
            "rules": [quality.not_null("client"), quality.between("qty", 1, 90)]}


def _events(spark, days=range(12), n=12_000, shift=0):
    r = random.Random(3)
    rows = [(DAY + dt.timedelta(days=i % 12), None if i % 97 == 0 else f"c{r.randrange(5000)}", r.randint(1, 100) + shift) for i in range(n)]
    return spark.createDataFrame([x for x in rows if (x[0] - DAY).days in days], "day date, client string, qty int")


def test_merged_days_equal_one_pass_within_bounds(spark, scratch):
    df = _events(spark)
    state = DailyState(spark, scratch, "day", **_shape())
    for days in (range(5), range(5, 12)):
        state.put(_events(spark, days))
    got = report(state.between()).first()
    want = df.agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("s"), F.min("qty").alias("lo"), F.max("qty").alias("hi"),
                  F.count_distinct("client").alias("d"), F.count_if(F.col("client").isNull()).alias("b0"),
                  F.count_if(~F.col("qty").between(1, 90)).alias("b1")).first()
    assert (got.n_rows, int(got.sum_qty), got.lo_qty, got.hi_qty, got.bad_0, got.bad_1) == (want.n, want.s, want.lo, want.hi, want.b0, want.b1)
    assert abs(got.distinct_client - want.d) <= DISTINCT_ERROR * want.d
    for q in (50, 95):
        rank = df.filter(F.col("qty") <= got[f"q{q}_qty"]).count() / want.n
        below = df.filter(F.col("qty") < got[f"q{q}_qty"]).count() / want.n
        assert below - RANK_ERROR <= q / 100 <= rank + RANK_ERROR
    few = report(state.between(DAY + dt.timedelta(days=2), DAY + dt.timedelta(days=3))).first()
    assert few.n_rows == df.filter(F.col("day").between(DAY + dt.timedelta(days=2), DAY + dt.timedelta(days=3))).count()


def test_a_new_or_corrected_day_touches_that_day_alone(spark, scratch):
    state = DailyState(spark, scratch, "day", **_shape())
    state.put(_events(spark, range(6)))
    before = set(spark.read.parquet(scratch).inputFiles())
    state.put(_events(spark, [3], shift=1))       # corrected
    state.put(_events(spark, [6]))                # new
    after = set(spark.read.parquet(scratch).inputFiles())
    day_of = lambda files: {f.split("day=")[1][:10] for f in files}
    assert day_of(before - after) == {"2024-01-04"} and day_of(after - before) == {"2024-01-04", "2024-01-07"}
    whole = _events(spark, [0, 1, 2, 4, 5, 6]).unionByName(_events(spark, [3], shift=1))
    assert report(state.between()).first().sum_qty == report(merge_days(reduce_days(whole, "day", **_shape()))).first().sum_qty


def test_bins_hold_about_the_target():
    r = random.Random(1)
    sizes = {f"f{i}": r.randint(1, 60) for i in range(300)} | {"big": 51, "whole": 500}
    out = bins(sizes, 100)
    placed = [n for names in out for n in names]
    assert len(placed) == len(set(placed)) and "whole" not in placed and all(sizes[n] <= 50 for n in placed)
    assert all(sum(sizes[n] for n in names) <= 100 for names in out)
    assert sum(sum(sizes[n] for n in names) >= 80 for names in out) >= len(out) - 1


def test_compaction_beside_a_running_sink_loses_nothing(spark, scratch):
    from haven.streaming import jobs
    table = CompactedTable(spark, f"{scratch}/t", target=40_000)
    schema = "value string"

    def land(i):
        jobs.publish(spark.createDataFrame([(f"{i}-{j}",) for j in range(20)], schema).coalesce(2), f"{scratch}/landing-{i}")
        jobs.run_available_now(jobs.file_source(spark, f"{scratch}/landing-*", max_files=1), table.data, f"{scratch}/_chk")

    def read():
        return sorted(r.value for r in table.read(schema).collect())

    def want(n):
        return sorted(f"{i}-{j}" for i in range(n) for j in range(20))
    for i in range(3):
        land(i)
    assert read() == want(3) and len(table.live()) >= 6
    new, old = table.stage(schema)
    assert read() == want(3)                       # a run that dies here has changed nothing
    land(3)                                        # the sink goes on
    assert read() == want(4)
    table.publish(new, old)
    assert read() == want(4) and len(table.live()) < 6
    land(4)
    assert table.compact(schema) > 0 and read() == want(5) and len(table.live()) <= 2
    assert table.compact(schema) == 0 or read() == want(5)
    assert table.vacuum() > 0 and read() == want(5)
    land(5)
    assert read() == want(6)
