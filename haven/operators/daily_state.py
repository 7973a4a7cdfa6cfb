"""Quality and KPI state that is kept a day at a time and merged, not rescanned.

Each day's rows are reduced once to one row: counts, sums, offences against the
rules, and sketches of distinct values and of quantiles.  The state of any span
of days is the merge of its rows, so a new or corrected day scans that day
alone, and a report over years reads a row a day.

Counts, sums, least and greatest values and offences merge exactly.  Distinct
counts are HyperLogLog sketches with a relative standard error of about 1.04 /
sqrt(2^``LG_K``) (0.8 %); quantiles are KLL sketches with a rank error of about
1.3 %.  Uniqueness is never judged from a sketch: ``quality.run_suite`` and
``quality.duplicate_keys`` stay exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haven.operators.quality import Rule
from haven.operators.upsert import write_partitioned

LG_K = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
RANK_ERROR = 0.03


def reduce_days(df: DataFrame, day: str, sums: list[str], distinct: list[str], spread: list[str],
                rules: list[Rule]) -> DataFrame:
    """One row a day: n_rows, sum_, lo_ and hi_ of ``sums``, hll_ of ``distinct``, kll_ of ``spread``, bad_i of each rule."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in sums:
        aggs += [F.sum(c).cast("decimal(38,4)").alias(f"sum_{c}"), F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}")]
    aggs += [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K)).alias(f"hll_{c}") for c in distinct]
    aggs += [F.kll_sketch_agg_double(F.col(c).cast("double")).alias(f"kll_{c}") for c in spread]
    aggs += [F.count_if(r.bad).alias(f"bad_{i}") for i, r in enumerate(rules) if not r.unique]
    return df.groupBy(day).agg(*aggs)


def _over(state: DataFrame, prefix: str) -> list[str]:
    return [c for c in state.columns if c.startswith(prefix)]


def merge_days(state: DataFrame) -> DataFrame:
    """The state of all days of ``state``: one row of the same columns, without the day."""
    def all_of(prefix: str, f) -> list[Column]:
        return [f(c).alias(c) for c in _over(state, prefix)]
    return state.agg(F.sum("n_rows").alias("n_rows"), *all_of("sum_", F.sum), *all_of("lo_", F.min), *all_of("hi_", F.max),
                     *all_of("hll_", F.hll_union_agg), *all_of("kll_", lambda c: F.kll_merge_agg_double(F.col(c))),
                     *all_of("bad_", F.sum))


def report(merged: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """Readable figures of a merged state."""
    cols = [F.col("n_rows")] + [F.col(c) for p in ("sum_", "lo_", "hi_", "bad_") for c in _over(merged, p)]
    cols += [F.hll_sketch_estimate(c).alias(f"distinct_{c[4:]}") for c in _over(merged, "hll_")]
    cols += [F.kll_sketch_get_quantile_double(F.col(c), F.lit(q)).alias(f"q{round(q * 100)}_{c[4:]}")
             for c in _over(merged, "kll_") for q in quantiles]
    return merged.select(*cols)


class DailyState:
    """The days' rows as a table partitioned by day."""

    def __init__(self, spark: SparkSession, path: str, day: str, **shape):
        self.spark, self.path, self.day, self.shape = spark, path, day, shape

    def put(self, df: DataFrame) -> None:
        """Reduce the days present in ``df`` (whole days) and replace their rows; other days are not touched."""
        write_partitioned(reduce_days(df, self.day, **self.shape), self.path, self.day)

    def between(self, first=None, last=None) -> DataFrame:
        state = self.spark.read.parquet(self.path)
        if first is not None:
            state = state.filter(F.col(self.day) >= F.lit(first))
        if last is not None:
            state = state.filter(F.col(self.day) <= F.lit(last))
        return merge_days(state)
