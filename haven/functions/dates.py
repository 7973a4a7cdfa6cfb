"""Date conformance that never fails a job on bad text (ANSI mode)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType


def as_date(df: DataFrame, col: str) -> Column:
    """DATE from a DATE, TIMESTAMP or ISO-text column; unparseable text -> NULL."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, DateType):
        return F.col(col)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.to_date(F.col(col))
    if isinstance(dtype, StringType):
        return F.try_to_date(F.col(col))
    return F.try_to_date(F.col(col).cast("string"))


def date_key(col: str | Column) -> Column:
    """yyyymmdd integer key."""
    return F.date_format(col, "yyyyMMdd").cast("int")


def day_range(col: str, day: str) -> Column:
    """Half-open [day, day+1) test on a timestamp, so Parquet min/max pushdown works."""
    start = F.lit(day).cast("timestamp")
    return (F.col(col) >= start) & (F.col(col) < start + F.expr("INTERVAL 1 DAY"))
