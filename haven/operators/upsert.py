"""Keyed upsert into a date-partitioned Parquet table (no MERGE on Parquet).

Only *touched* partitions are rewritten: the partitions that held an old
version of a changed key plus the partitions of the new rows.  An upsert has
two steps.  *Stage*: the whole new content of the touched partitions is written
beside the table, then the list of those partitions; the table is only read.
*Publish*: the staged content replaces the touched partitions, partitions left
without rows are removed, and the stage is dropped, its list first.

Where the old versions are is told by a *key index* beside the table: (key,
partition) rows in buckets by key hash.  A batch reads the buckets of its own
keys, then the partitions they name, and no key column of any other partition;
after the publish the same buckets are rewritten.  The index carries the names of
the table's files: after anything else wrote the table, or a run died before its
index was written, it is built anew from the key column.

A run that dies while staging leaves the table as it was; one that dies while
publishing leaves a complete stage, and ``recover`` (which every upsert calls
first) publishes it again.  Nothing then depends on what the table's touched
partitions hold, so no row is lost.  One writer at a time per table.

A null key is a key like any other: its rows are replaced by the next batch that
has rows without a key.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haven.functions.privacy import packed, unpacked
from haven.session import job_dir


def _delete_partition(spark: SparkSession, table_path: str, part_col: str, value) -> None:
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    value = "__HIVE_DEFAULT_PARTITION__" if value is None else escape(str(value))
    _drop(spark, f"{table_path}/{part_col}={value}")


def write_partitioned(df: DataFrame, path: str, part_col: str, mode: str = "overwrite",
                      hashes: list[str] | None = None) -> None:
    """Partitioned write, clustered so each partition gets few, sorted files.

    ``overwrite`` replaces only the partitions present in ``df`` (dynamic
    mode); a first load into a new path should pass ``errorifexists``, which
    skips the staging that partition replacement needs.  ``hashes`` names columns of
    lower-hex hashes or nulls: they are dealt as bytes."""
    hashes = hashes or []
    # rebalanced, not repartitioned: adaptive execution splits a large date over several tasks
    dealt = df.withColumns({c: packed(c) for c in hashes}).hint("rebalance", part_col).sortWithinPartitions(part_col)
    (dealt.withColumns({c: unpacked(c) for c in hashes})
       .write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
       .partitionBy(part_col).parquet(path))


#: Tasks that list the folders of a table (Spark's own default starts one task a folder, up to 10,000).
LISTING = ("spark.sql.sources.parallelPartitionDiscovery.parallelism", 64)


def read_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The table, its partition folders listed by a bounded number of tasks whatever the session's
    own setting, which is put back: folders are listed while the frame is made."""
    name, tasks = LISTING
    own = spark.conf.get(name, None)  # None: not set
    if own is not None and int(own) <= tasks:
        return spark.read.parquet(table_path)
    spark.conf.set(name, tasks)
    try:
        return spark.read.parquet(table_path)
    finally:
        if own is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, own)


def _stage_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}__stage"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _drop(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


# ---- the key index ------------------------------------------------------------------

#: Buckets of a new index; a batch of few keys reads few of them.
INDEX_BUCKETS = 16


def _index_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}__keys"


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _index_rows(rows: DataFrame, key: str, part_col: str, buckets: int) -> DataFrame:
    out = rows.select(F.col(key).alias("key"), F.col(part_col).alias("part"), _bucket(F.col(key), buckets).alias("bucket"))
    # only a null key is meant to have several rows: they are one index row a partition, and the
    # others are not dealt by key to look for copies, which would do no harm (every join is semi or anti)
    return out.filter(F.col("key").isNotNull()).unionByName(out.filter(F.col("key").isNull()).distinct())


def _write_index(rows: DataFrame, path: str) -> None:
    (rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/rows"))


def _file_names(table: DataFrame) -> str:
    """What files a table has; every write gives its files new names."""
    return hashlib.sha256("\n".join(sorted(table.inputFiles())).encode()).hexdigest()


def _write_stamp(spark: SparkSession, path: str, table: DataFrame, buckets: int) -> None:
    spark.createDataFrame([(_file_names(table), buckets)], "files string, buckets int").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/stamp")


def build_index(spark: SparkSession, table_path: str, key: str, part_col: str, buckets: int = INDEX_BUCKETS) -> DataFrame:
    """Write the index from the table's key column; returns the table as it was read."""
    path, table = _index_path(table_path), read_table(spark, table_path)
    _drop(spark, path)
    _write_index(_index_rows(table, key, part_col, buckets), path)
    _write_stamp(spark, path, table, buckets)
    return table


def index_buckets(spark: SparkSession, table_path: str, table: DataFrame) -> int | None:
    """The number of buckets of an index that tells of just this table's files."""
    path = _index_path(table_path)
    fs, done = _fs(spark, f"{path}/stamp/_SUCCESS")
    if not fs.exists(done):
        return None
    stamp = spark.read.parquet(f"{path}/stamp").first()
    return stamp["buckets"] if stamp["files"] == _file_names(table) else None


def _keys(batch: DataFrame, key: str) -> DataFrame:
    """A batch's keys as ``_key``, to be looked up by hash: a task holds its share of the keys
    (a repeated one once), and neither they nor the rows that look them up are sorted."""
    return batch.select(F.col(key).alias("_key")).hint("shuffle_hash")


def _own_buckets(spark: SparkSession, table_path: str, keys: DataFrame, buckets: int) -> DataFrame:
    """Index rows of the buckets that the keys fall into; other buckets' files stay closed."""
    own = [r[0] for r in keys.select(_bucket(F.col("_key"), buckets)).distinct().collect()]
    return spark.read.parquet(f"{_index_path(table_path)}/rows").filter(F.col("bucket").isin(own))


def create(df: DataFrame, table_path: str, key: str, part_col: str, buckets: int = INDEX_BUCKETS,
           hashes: list[str] | None = None) -> DataFrame:
    """First load of a table, with its key index; ``hashes`` as in ``write_partitioned``.  Returns the table."""
    write_partitioned(df, table_path, part_col, mode="errorifexists", hashes=hashes)
    return build_index(df.sparkSession, table_path, key, part_col, buckets)


# ---- stage and publish ---------------------------------------------------------------

def stage(spark: SparkSession, table_path: str, changes: DataFrame, key: str, part_col: str,
          target: DataFrame) -> DataFrame:
    """Write the new content of every touched partition beside the table; returns the batch as it was written."""
    base = _stage_path(table_path)
    # the batch is written once: every later step reads it instead of re-deriving it
    batch_path = job_dir(spark, "upsert-batch")
    changes.select(*target.columns).write.option("compression", "zstd").parquet(batch_path)
    batch = spark.read.parquet(batch_path)
    keys = _keys(batch, key)
    if (buckets := index_buckets(spark, table_path, target)) is None:
        buckets = INDEX_BUCKETS
        build_index(spark, table_path, key, part_col, buckets)
    held = _own_buckets(spark, table_path, keys, buckets)
    # touched partition values (bounded by the table's partition count) become
    # a static partition filter: untouched partitions are never read
    old_parts = held.join(keys, F.col("key").eqNullSafe(F.col("_key")), "left_semi").select(F.col("part").alias(part_col))
    touched = old_parts.unionByName(batch.select(part_col)).distinct()
    values = [r[0] for r in touched.collect()]
    kept = _within(target, part_col, values).join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    kept.unionByName(batch.select(*target.columns)).write.option("compression", "zstd").parquet(f"{base}/content")
    # written last: its _SUCCESS says that the stage is complete
    spark.createDataFrame([(v,) for v in values], touched.schema).coalesce(1).write.parquet(f"{base}/touched")
    return batch


def _within(target: DataFrame, part_col: str, values: list) -> DataFrame:
    dates = [t for t in values if t is not None]
    within = F.col(part_col).isin(dates)
    if len(dates) < len(values):  # rows without a date have a partition of their own
        within = within | F.col(part_col).isNull()
    return target.filter(within)


def _reindex(spark: SparkSession, table_path: str, changes: DataFrame, key: str, part_col: str, buckets: int) -> None:
    """Bring the buckets of the changed keys up to date with a table that was just published."""
    keys = _keys(changes, key)
    held = _own_buckets(spark, table_path, keys, buckets)
    others = held.join(keys, F.col("key").eqNullSafe(F.col("_key")), "left_anti")
    path = _index_path(table_path)
    # dynamic overwrite swaps whole buckets after all of them are read
    _write_index(others.select("key", "part", "bucket").unionByName(_index_rows(changes, key, part_col, buckets)), path)
    _write_stamp(spark, path, read_table(spark, table_path), buckets)


def publish(spark: SparkSession, table_path: str, part_col: str, hashes: list[str] | None = None) -> dict:
    """Put a complete stage into the table and drop it; may be repeated."""
    base = _stage_path(table_path)
    content = spark.read.parquet(f"{base}/content")
    touched = {r[0] for r in spark.read.parquet(f"{base}/touched").collect()}
    # partitions left with no rows (every row moved away): dynamic overwrite
    # would not touch them, so they are removed explicitly
    emptied = touched - {r[0] for r in content.select(part_col).distinct().collect()}
    if touched:
        write_partitioned(content, table_path, part_col, mode="overwrite", hashes=hashes)
    for value in emptied:
        _delete_partition(spark, table_path, part_col, value)
    _drop(spark, f"{base}/touched")
    _drop(spark, base)
    return {"touched_partitions": len(touched), "emptied_partitions": len(emptied)}


def recover(spark: SparkSession, table_path: str, part_col: str) -> bool:
    """Finish what an earlier upsert left: publish a complete stage, drop an
    incomplete one.  True when the table changed."""
    base = _stage_path(table_path)
    fs, done = _fs(spark, f"{base}/touched/_SUCCESS")
    if fs.exists(done):
        publish(spark, table_path, part_col)
        return True
    _drop(spark, base)
    return False


def upsert(spark: SparkSession, table_path: str, changes: DataFrame, key: str,
           part_col: str, target: DataFrame | None = None, hashes: list[str] | None = None) -> dict:
    """Apply ``changes`` (full new rows, unique on ``key``) to the table.

    ``target`` may be passed when the caller already read the table (saves a
    second listing of its partition folders); ``hashes`` as in ``write_partitioned``."""
    if recover(spark, table_path, part_col) or target is None:
        target = read_table(spark, table_path)
    batch = stage(spark, table_path, changes, key, part_col, target)
    buckets = index_buckets(spark, table_path, target)
    out = publish(spark, table_path, part_col, hashes)
    if out["touched_partitions"]:
        _reindex(spark, table_path, batch, key, part_col, buckets)
    return out


def high_water_mark(table: DataFrame, col: str):
    """max(col) of the table: the inclusive start of the next increment."""
    return table.agg(F.max(col)).first()[0]


def increment(source: DataFrame, col: str, since: dt.date | None, lookback_days: int = 0,
              undated: bool = False) -> DataFrame:
    """Source rows from ``lookback_days`` before the high-water mark on (both days
    included), so that rows which arrived late for an older day are met too;
    every row when the table is still empty (``since`` is None).  A range on the
    column itself: it reaches the scan.  Rows without a date are on neither side of
    the mark: ``undated`` takes them with every increment (a keyed upsert may meet
    them again)."""
    if since is None:
        return source
    late = F.col(col) >= F.lit(since - dt.timedelta(days=lookback_days))
    return source.filter(late | F.col(col).isNull() if undated else late)
