"""Where two copies of a table differ, found through a tree of order-free checksums.

The tree's leaves are (date, bucket of keys); each holds the number of its rows
and the sum of their hashes, so neither order nor partitioning matters.  Dates
and the table itself are sums of leaves.  A copy's leaves take one pass, combined
map-side, and can be stored with it.  Comparing walks down only where nodes
differ: equal copies end at the root, and otherwise rows are read from the
dates and buckets that differ, and nowhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haven.operators.quality import QualityError

BUCKETS = 64


def _row_hash(columns: list[str]) -> Column:
    """A null's place is hashed too, so that values cannot swap columns unseen."""
    return F.xxhash64(*[p for c in columns for p in (F.col(c).isNull(), F.col(c))])


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def leaves(df: DataFrame, key: str, date: str, columns: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(date, bucket, n, content) of one copy."""
    content = F.sum(_row_hash(columns or df.columns).cast("decimal(38,0)")).alias("content")
    return (df.groupBy(F.col(date).alias("date"), _bucket(key, buckets).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), content))


def _unlike(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Nodes at level ``by`` that differ, or that one side has alone."""
    def side(nodes: DataFrame, name: str) -> DataFrame:
        return nodes.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("content").alias("content")).select(
            *by, F.struct("n", "content").alias(name))
    a, b = side(left, "a"), side(right, "b")
    if not by:
        return a.crossJoin(b).filter(~F.col("a").eqNullSafe(F.col("b")))  # one row each
    both = a.select(*by, "a", F.lit(None).cast(b.schema["b"].dataType).alias("b")).unionByName(
        b.select(*by, F.lit(None).cast(a.schema["a"].dataType).alias("a"), "b"))
    return (both.groupBy(*by).agg(F.max("a").alias("a"), F.max("b").alias("b"))
            .filter(~F.col("a").eqNullSafe(F.col("b"))).select(*by))


def differences(left: DataFrame, right: DataFrame, key: str, date: str, columns: list[str] | None = None,
                buckets: int = BUCKETS, left_leaves: DataFrame | None = None, right_leaves: DataFrame | None = None) -> DataFrame:
    """(key, change, left_date, right_date) of every row that is ``lost`` (not on the
    right), ``added`` (not on the left), ``moved`` (to another date) or ``changed``.

    ``key`` is unique in each copy; null keys and null dates are keys and dates
    like others.  Stored leaves may be given, of the same columns and buckets."""
    columns = columns or left.columns
    la = left_leaves if left_leaves is not None else leaves(left, key, date, columns, buckets)
    ra = right_leaves if right_leaves is not None else leaves(right, key, date, columns, buckets)
    empty = left.select(F.col(key).alias("key"), F.lit("").alias("change"), F.col(date).alias("left_date"),
                        F.col(date).alias("right_date")).limit(0)
    if _unlike(la, ra, []).isEmpty():
        return empty
    # a row may have moved, so a bucket is compared over all dates that differ; at most one value a date
    dates = [r[0] for r in _unlike(la, ra, ["date"]).collect()]
    known = [d for d in dates if d is not None]

    def dated(c: str) -> Column:
        return F.col(c).isin(known) | (F.col(c).isNull() if len(known) < len(dates) else F.lit(False))
    odd = [r[0] for r in _unlike(la.filter(dated("date")), ra.filter(dated("date")), ["date", "bucket"])
           .select("bucket").distinct().collect()]

    def rows(df: DataFrame, name: str) -> DataFrame:
        wanted = df.filter(dated(date) & _bucket(key, buckets).isin(odd))
        return wanted.select(F.col(key).alias(f"{name}_key"), F.struct(F.col(date).alias("date"), _row_hash(columns).alias("hash")).alias(name))
    a, b = rows(left, "a"), rows(right, "b")
    both = a.join(b, F.col("a_key").eqNullSafe(F.col("b_key")), "full")
    change = (F.when(F.col("b").isNull(), "lost").when(F.col("a").isNull(), "added")
              .when(~F.col("a.date").eqNullSafe(F.col("b.date")), "moved").when(F.col("a.hash") != F.col("b.hash"), "changed"))
    return (both.withColumn("change", change).filter(F.col("change").isNotNull())
            .select(F.coalesce("a_key", "b_key").alias("key"), "change", F.col("a.date").alias("left_date"),
                    F.col("b.date").alias("right_date")))


def require_equal(left: DataFrame, right: DataFrame, key: str, date: str, name: str, **options) -> None:
    """Stop the job if the copies differ, naming how many rows of which kind and an example of each."""
    found = (differences(left, right, key, date, **options).groupBy("change")
             .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("example")).orderBy("change").collect())
    if found:
        raise QualityError(f"{name}: " + ", ".join(f"{r['n']} {r['change']} (such as {r['example']})" for r in found))
