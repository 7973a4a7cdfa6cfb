"""Batch sources and sinks: JSON seeds, bronze ingest, by-name load, layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def write_seed(df: DataFrame, path: str) -> None:
    """Land a table as JSON lines (dates as ISO text), as upstream systems drop it."""
    df.write.mode("errorifexists").json(path)


def read_bronze(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Schema-on-read JSON with provenance columns.

    Lines that do not fit the schema are kept whole in ``_corrupt_record``
    (PERMISSIVE) instead of silently becoming NULL rows.
    """
    with_corrupt = StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])
    return (spark.read.schema(with_corrupt).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path)
            .withColumn("_ingest_ts", F.current_timestamp())
            .withColumn("_source_file", F.col("_metadata.file_path")))


def load_by_name(df: DataFrame, contract: StructType) -> DataFrame:
    """Project a file onto a contract by column name, case-insensitively.

    Missing columns become NULL, extra columns are dropped, and values are
    cast (try_cast: a bad value becomes NULL, never a failed load).
    """
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for f in contract.fields:
        src = by_lower.get(f.name.lower())
        c = F.col(f"`{src}`").try_cast(f.dataType) if src else F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def landing_to_lake(spark: SparkSession, landing: str, schema: StructType, lake: str,
                    conform, partition_col: str) -> int:
    """Landing JSON -> conform -> partitioned snappy Parquet; returns rows written.

    The count is observed during the write (no second job over the source).
    """
    obs = Observation("landing")
    df = conform(spark.read.schema(schema).json(landing)).observe(obs, F.count(F.lit(1)).alias("n"))
    # rebalanced, not repartitioned: adaptive execution splits a large value over several tasks
    (df.hint("rebalance", partition_col).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
       .partitionBy(partition_col).parquet(lake))
    return int(obs.get["n"])


def read_jdbc_parallel(spark: SparkSession, url: str, table: str, column: str,
                       lower: int, upper: int, partitions: int = 4,
                       props: dict | None = None) -> DataFrame:
    """Parallel import of a SQL table split on a numeric column (4 splits by default)."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=props or {})


def register_partitioned_table(spark: SparkSession, name: str, path: str, schema_ddl: str,
                               partition_col: str) -> DataFrame:
    """External partitioned table over landing folders + partition discovery."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING parquet "
              f"PARTITIONED BY ({partition_col}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A layer table, or an empty frame of its contract when it does not exist yet
    (a dashboard asking before the first stream batch landed gets zero rows, not an error)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
