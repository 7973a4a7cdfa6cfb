"""Appending tables whose schema grows, with the schema in a log beside the data.

Every load that changes the schema adds a version to the log; a reader takes the
newest one and opens no file to learn it.  Columns may be added and types
widened (to a type that holds every value of the old one); anything else is
refused before a row is written.  Files keep the types they were written with:
older ones read missing columns as null and narrower numbers as wider ones.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LOG = "_schema"  # readers of the table pass over names that begin with an underscore

#: Types that a reader may take for one that was written.
WIDER = {
    T.ByteType(): [T.ShortType(), T.IntegerType(), T.LongType()],
    T.ShortType(): [T.IntegerType(), T.LongType()],
    T.IntegerType(): [T.LongType(), T.DoubleType()],
    T.FloatType(): [T.DoubleType()],
    T.DateType(): [T.TimestampNTZType()],
}


class SchemaError(ValueError):
    """A load does not fit the table's schema."""


def widened(old: T.DataType, new: T.DataType, column: str) -> T.DataType:
    """The type that holds values of both."""
    if old == new:
        return old
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        whole = max(old.precision - old.scale, new.precision - new.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if new in WIDER.get(old, []):
        return new
    if old in WIDER.get(new, []):
        return old
    raise SchemaError(f"column {column} is {old.simpleString()}, the load has {new.simpleString()}")


def merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """Old columns in their order, then added ones; all may be null."""
    fields = {f.name.lower(): f for f in old.fields}
    if len({f.name.lower() for f in new.fields}) < len(new.fields):
        raise SchemaError("the load has two columns of one name")
    for f in new.fields:
        held = fields.get(f.name.lower())
        kind = f.dataType if held is None else widened(held.dataType, f.dataType, f.name)
        fields[f.name.lower()] = T.StructField(f.name if held is None else held.name, kind, True)
    return T.StructType(list(fields.values()))


def _log(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{LOG}")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[int]:
    fs, p = _log(spark, path)
    if not fs.exists(p):
        return []
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit())


def schema(spark: SparkSession, path: str, version: int | None = None) -> T.StructType | None:
    """The newest schema, or that of a version."""
    known = versions(spark, path)
    if not known:
        return None
    name = f"{path.rstrip('/')}/{LOG}/{known[-1] if version is None else version:06d}"
    return T.StructType.fromJson(json.loads(spark.read.text(name, wholetext=True).first()[0]))


def _add_version(spark: SparkSession, path: str, version: int, new: T.StructType) -> None:
    """Create the version's file; another writer's version of that number stays, and this load is refused."""
    fs, p = _log(spark, path)
    fs.mkdirs(p)
    out = fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, f"{version:06d}"), False)
    try:
        out.write(bytearray(new.json().encode()))
    finally:
        out.close()


def append(df: DataFrame, path: str) -> int:
    """Append a load and return the schema version it was written under.

    The log comes first: a run that dies in between leaves a schema that is wider
    than the data, which reads the same."""
    spark = df.sparkSession
    known = versions(spark, path)
    old = schema(spark, path)
    new = merged(old or T.StructType([]), df.schema)
    if new != old:
        _add_version(spark, path, (known[-1] + 1) if known else 0, new)
    df.write.mode("append").parquet(path)
    return versions(spark, path)[-1]


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """All loads under the newest schema (or that of a version); no footer is opened to learn it."""
    return spark.read.schema(schema(spark, path, version)).parquet(path)
