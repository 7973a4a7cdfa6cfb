"""Deterministic dedupe, latest-by-key and surrogate keys.

``first_by_key`` is an aggregate, not a window: Spark combines rows map-side
(partial aggregation) before the shuffle, so a key that holds a third of all
rows reaches the reducer as one row per input partition instead of landing
whole in one task.  Ties are broken by the full row, so the survivor is the
same on every run.  That combining sorts an input split; ``first_by_key_dealt``
and ``count_by_key`` combine a batch at a time, for large tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _pick_row(df: DataFrame, keys: list[str], order: list[str], largest: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*[F.col(c) for c in order + rest])
    agg = F.max(row) if largest else F.min(row)
    out = df.groupBy(*keys).agg(agg.alias("_row"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c)
                        for c in df.columns])


def first_by_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order``, then by every other column."""
    return _pick_row(df, keys, list(order or []), largest=False)


#: Types that Arrow orders as Spark does, nulls first.
_SAME_ORDER = (T.IntegralType, T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.DecimalType)


def _first_in_batch(key: str, order: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = b.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            several = np.bincount(codes)[codes] > 1 if len(codes) else np.zeros(0, bool)
            if not several.any():
                yield b
                continue
            yield b.filter(pa.array(~several))
            rows, codes = b.filter(pa.array(several)), codes[several]
            at = pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in order], null_placement="at_start").to_numpy()
            yield rows.take(pa.array(at[np.unique(codes[at], return_index=True)[1]]))
    return combine


def first_by_key_dealt(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """``first_by_key`` of a large table: no task sorts its whole input split.

    Before the shuffle rows are combined an Arrow batch at a time, so a key that holds a
    third of all rows still leaves a batch as one row; the rest is done after rows are
    dealt by key, in parts that adaptive execution sizes.  Other column types than
    ``_SAME_ORDER`` take the plain aggregate.
    """
    if not all(isinstance(f.dataType, _SAME_ORDER) for f in df.schema.fields):
        return first_by_key(df, [key], order)
    by = [*(order or []), *[c for c in df.columns if c != key and c not in (order or [])]]
    return first_by_key(df.mapInArrow(_first_in_batch(key, by), df.schema).repartition(key), [key], order)


def _counts_in_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        values, counts = pc.value_counts(b.column(0)).flatten()
        yield pa.RecordBatch.from_arrays([values, counts], names=[b.schema.names[0], "n"])


def count_by_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """(key, rows of that key as ``name``) of a column of nearly as many keys as rows.

    A map-side aggregate would hold every key of an input split.  Rows are counted an
    Arrow batch at a time instead (a hot key leaves a batch as one row), then dealt over
    all shuffle partitions: so narrow, they would be coalesced to millions of keys a task.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(key)
    field = rows.schema.fields[0]
    schema = T.StructType([T.StructField(field.name, field.dataType), T.StructField("n", T.LongType())])
    return rows.mapInArrow(_counts_in_batch, schema).repartition(n, key).groupBy(key).agg(F.sum("n").alias(name))


#: Keys with several rows that are sent to every task; with more, all rows are dealt by key.
FEW_REPEATED = 200_000


def first_of_repeated(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """``first_by_key`` for a table whose keys are nearly all held by one row.

    The rows are written once, then only hashes of their keys are dealt and counted.
    Rows whose hash is held once are the first of their key and stay where they are;
    the others (copies, or two keys of one hash) are compared in full.
    """
    from haven.session import job_dir
    spark = df.sparkSession
    path = job_dir(spark, "keyed-rows")
    df.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    key = F.xxhash64(*keys)
    path = job_dir(spark, "repeated-keys")
    (rows.groupBy(key.alias("_repeated")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_repeated")
     .write.parquet(path))
    repeated = spark.read.schema("_repeated long").parquet(path)
    n = repeated.count()
    if not n:
        return rows
    if n > FEW_REPEATED:
        return first_by_key(rows, keys, order)
    is_repeated = key == F.broadcast(repeated)["_repeated"]
    several = rows.join(F.broadcast(repeated), is_repeated, "left_semi")
    return rows.join(F.broadcast(repeated), is_repeated, "left_anti").unionByName(first_by_key(several, keys, order))


def last_by_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the largest by ``order``, then by every other column."""
    return _pick_row(df, keys, list(order or []), largest=True)


def hex_key(hex_col: str | Column) -> Column:
    """Stable BIGINT key from the first 15 hex digits of a SHA-256 id."""
    c = F.col(hex_col) if isinstance(hex_col, str) else hex_col
    return F.conv(F.substring(c, 1, 15), 16, 10).cast("bigint")


def dense_key(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """0..n-1 in natural-key order (ties broken by the rest of the row).

    The rows are range-partitioned on the key and written once with the number
    of their range.  Everything after reads that one table: rows are numbered
    within each range and shifted by the sizes of the earlier ranges (one row
    per range), so sampled range bounds cannot differ between steps and no task
    holds more than a range.
    """
    from pyspark.sql import Window

    from haven.session import job_dir
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = job_dir(spark, "dense-key")
    df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    rest = [c for c in df.columns if c not in order]
    local = ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_range").orderBy(*order, *rest)) - 1)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # one row per range: bounded by the number of shuffle partitions
    starts = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_start"))
    return (local.join(starts, "_range").withColumn(name, (F.col("_start") + F.col("_local")).cast("bigint"))
            .select(*df.columns, name))
