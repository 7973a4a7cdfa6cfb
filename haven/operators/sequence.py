"""Ordered per-key computations that stay balanced when one key is huge.

A window partitioned by the key alone sends all of a key's rows to one task;
if one client or bed holds a third of all rows, that task does a third of
the job.  Here each key is split into time buckets (a day by default): the
window runs per (key, bucket), and state crosses bucket boundaries through a
per-(key, bucket) summary — one row per bucket, combined map-side — whose own
window per key is bounded by the number of buckets the key spans.

A key may also be hot within one bucket.  ``hot_splits`` finds such buckets by
count and cuts them at quantiles of time, taken from mergeable sketches; given to
``ordered_by_key``, each part is a bucket of its own.

``ordered_by_key`` computes any mix of lag / lead / forward-fill / row number
/ running sum in one pass (one local window stage, one summary, one carry
window, one join back).  Each result equals the plain
``Window.partitionBy(keys).orderBy(order)`` result; ``order`` must be a total
order within a key and ``order[0]`` its time column.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haven.session import job_dir

BUCKET_UNIT = "day"
_B, _P = "_bucket", "_part"
#: Rows of one key in one bucket beyond which it is cut, and the parts it is cut into.
BUCKET_ROWS, PARTS = 200_000, 256


def hot_splits(df: DataFrame, keys: list[str], time: str, rows: int = BUCKET_ROWS, unit: str = BUCKET_UNIT) -> DataFrame:
    """(keys, bucket, cuts) of every (key, bucket) with more than ``rows`` rows of
    ``df``: the quantiles of time that cut it into about equal parts.  Counts and
    sketches are combined map-side; the result has at most count / ``rows`` rows and
    is written once, since every pass over the keys reads it."""
    at = F.col(time).cast("timestamp")
    d = df.select(*keys, F.date_trunc(unit, at).alias(_B), F.unix_micros(at).alias("_at"))
    hot = d.groupBy(*keys, _B).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows)
    hot = hot.select(*[F.col(c).alias(f"_hk_{c}") for c in (*keys, _B)])
    same = reduce(and_, [d[c].eqNullSafe(hot[f"_hk_{c}"]) for c in (*keys, _B)])
    cuts = F.percentile_approx("_at", [i / PARTS for i in range(1, PARTS)], 10 * PARTS)
    path = job_dir(df.sparkSession, "hot-splits")
    d.join(hot, same, "left_semi").groupBy(*keys, _B).agg(F.array_distinct(cuts).alias("_cuts")).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ordered_by_key(df: DataFrame, keys: list[str], order: list[str], *,
                   lag: dict[str, str] | None = None, lead: dict[str, str] | None = None,
                   ffill: list[str] | None = None, row_number: str | None = None,
                   running_sum: dict[str, str] | None = None,
                   unit: str = BUCKET_UNIT, splits: DataFrame | None = None) -> DataFrame:
    """lag/lead/running_sum map output column -> source column; ffill lists
    columns filled in place; row_number names its (1-based, bigint) output.
    ``splits`` (of ``hot_splits`` with the same keys and unit) cuts hot buckets."""
    lag, lead, running_sum, ffill = lag or {}, lead or {}, running_sum or {}, ffill or []
    d = df.withColumn(_B, F.date_trunc(unit, F.col(order[0]).cast("timestamp")))
    if splits is None:
        d = d.withColumn(_P, F.lit(0))
    else:
        cut = splits.select(*[F.col(c).alias(f"_hk_{c}") for c in (*keys, _B)], "_cuts")
        same = reduce(and_, [d[c].eqNullSafe(cut[f"_hk_{c}"]) for c in (*keys, _B)])
        time = F.unix_micros(F.col(order[0]).cast("timestamp"))
        part = F.size(F.filter("_cuts", lambda c: c <= time))
        d = (d.join(cut, same, "left").withColumn(_P, F.when(F.col("_cuts").isNull(), 0).otherwise(part))
             .drop("_cuts", *[f"_hk_{c}" for c in (*keys, _B)]))
    wl = Window.partitionBy(*keys, _B, _P).orderBy(*order)
    run = wl.rowsBetween(Window.unboundedPreceding, 0)
    ordering = F.struct(*[F.col(c) for c in order])

    summary_aggs = []
    for out, v in lag.items():
        summary_aggs.append(F.max_by(v, ordering).alias(f"_sl_{out}"))
    for out, v in lead.items():
        summary_aggs.append(F.min_by(v, ordering).alias(f"_sf_{out}"))
    for out, v in running_sum.items():
        summary_aggs.append(F.sum(v).alias(f"_ss_{out}"))
    if row_number:
        summary_aggs.append(F.count(F.lit(1)).alias("_sn"))

    # local (per key and bucket) pass
    if lag:
        d = d.withColumn("_first", F.row_number().over(wl) == 1)
    if lead:
        d = d.withColumn("_last", F.row_number().over(
            Window.partitionBy(*keys, _B, _P).orderBy(*[F.desc(c) for c in order])) == 1)
    for out, v in lag.items():
        d = d.withColumn(out, F.lag(v).over(wl))
    for out, v in lead.items():
        d = d.withColumn(out, F.lead(v).over(wl))
    for out, v in running_sum.items():
        d = d.withColumn(out, F.sum(v).over(run))
    if row_number:
        d = d.withColumn(row_number, F.row_number().over(wl).cast("bigint"))
    for c in ffill:
        d = d.withColumn(c, F.last(c, ignorenulls=True).over(run))
    for c in ffill:   # after local fill, the bucket's last non-null value
        summary_aggs.append(F.max_by(c, F.when(F.col(c).isNotNull(), ordering)).alias(f"_sc_{c}"))

    # one row per (key, bucket), then state carried across a key's buckets
    summary = d.groupBy(*keys, _B, _P).agg(*summary_aggs)
    across = Window.partitionBy(*keys).orderBy(_B, _P)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = [F.lag(f"_sl_{o}").over(across).alias(f"_cl_{o}") for o in lag]
    carry_cols += [F.lead(f"_sf_{o}").over(across).alias(f"_cf_{o}") for o in lead]
    carry_cols += [F.sum(f"_ss_{o}").over(before).alias(f"_cs_{o}") for o in running_sum]
    if row_number:
        carry_cols.append(F.coalesce(F.sum("_sn").over(before), F.lit(0)).alias("_cn"))
    carry_cols += [F.last(f"_sc_{c}", ignorenulls=True).over(before).alias(f"_cc_{c}") for c in ffill]
    at = [*keys, _B, _P]  # null keys and times are keys and times like others
    carry = summary.select(*[F.col(c).alias(f"_ck_{c}") for c in at], *carry_cols)
    same = reduce(and_, [d[c].eqNullSafe(carry[f"_ck_{c}"]) for c in at])
    out = d.join(carry, same, "left").drop(*[f"_ck_{c}" for c in at])
    for o in lag:
        out = out.withColumn(o, F.when(F.col("_first"), F.col(f"_cl_{o}")).otherwise(F.col(o)))
    for o in lead:
        out = out.withColumn(o, F.when(F.col("_last"), F.col(f"_cf_{o}")).otherwise(F.col(o)))
    for o in running_sum:
        # SUM ignores nulls: null only while every value so far is null
        local, before_sum = F.col(o), F.col(f"_cs_{o}")
        out = out.withColumn(o, F.when(local.isNull() & before_sum.isNull(), F.lit(None))
                             .otherwise(F.coalesce(local, F.lit(0)) + F.coalesce(before_sum, F.lit(0))))
    if row_number:
        out = out.withColumn(row_number, (F.col(row_number) + F.col("_cn")).cast("bigint"))
    for c in ffill:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_cc_{c}")))
    helpers = [c for c in out.columns if c.startswith(("_cl_", "_cf_", "_cs_", "_cc_"))]
    return out.drop(*helpers, "_cn", "_first", "_last", _B, _P)
