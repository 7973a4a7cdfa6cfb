"""Tables laid out along a space-filling curve, with a manifest that says which files a query needs.

Each clustering column is cut at splitters taken from a bounded sample, so
every interval holds about as many rows, whatever the column's type or skew.
Interleaving the bits of a row's intervals gives its place on a Morton curve; rows
are dealt to files by ranges of that place.  A file then covers a small part of
every clustering column's range: a query on one day and a query on one project
both need few files.  The manifest, a small table beside the data, holds the
least and greatest value of each clustering column in each file, so files are
chosen without opening any.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haven.functions.privacy import packed, unpacked

#: Bits of the curve per column, and rows that the splitters are taken from.
BITS, SAMPLE_ROWS = 6, 20_000
MANIFEST = "_manifest"  # readers of the table pass over names that begin with an underscore


def splitters(df: DataFrame, columns: list[str], bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """Per column at most 2^bits - 1 ascending values that cut a sample into equal parts."""
    n = df.count()
    share = min(1.0, sample_rows / max(n, 1))
    rows = df.select(*columns).sample(fraction=share, seed=1).limit(2 * sample_rows).collect()
    out = {}
    for i, c in enumerate(columns):
        values = sorted(r[i] for r in rows if r[i] is not None)
        parts = 1 << bits
        out[c] = sorted({values[len(values) * j // parts] for j in range(1, parts)}) if values else []
    return out


def _spread(interval: int, columns: int, i: int) -> int:
    """The bits of an interval's number at the places of column ``i`` on the curve."""
    return sum((interval >> b & 1) << (b * columns + i) for b in range(interval.bit_length()))


def _halved(column: str, at: list, places: list[int]) -> Column:
    """places[number of cuts that are not above the column], by halving the cuts: a
    handful of compiled comparisons a row.  A null is above no cut."""
    if not at:
        return F.lit(places[0]).cast("long")
    mid = len(at) // 2
    return (F.when(F.col(column) >= F.lit(at[mid]), _halved(column, at[mid + 1:], places[mid + 1:]))
            .otherwise(_halved(column, at[:mid], places[:mid + 1])))


def curve(cuts: dict[str, list]) -> Column:
    """A row's place on the Morton curve through the columns' intervals; nulls lie in the first."""
    return reduce(lambda p, q: p + q, [
        _halved(c, at, [_spread(k, len(cuts), i) for k in range(len(at) + 1)]) for i, (c, at) in enumerate(cuts.items())])


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int | None = None,
                    hashes: list[str] | None = None) -> None:
    """Write ``df`` along the curve, then its manifest.  ``files`` is left to adaptive
    execution unless given: it joins neighbouring ranges up to its advisory size.
    ``hashes`` names columns of lower-hex hashes or nulls: they are dealt as bytes."""
    hashes = [c for c in hashes or [] if c not in columns]
    dealt = df.withColumn("_place", curve(splitters(df, columns))).withColumns({c: packed(c) for c in hashes})
    ranges = ["_place", *columns]
    dealt = dealt.repartitionByRange(files, *ranges) if files else dealt.repartitionByRange(*ranges)
    dealt.sortWithinPartitions(*ranges).drop("_place").select(*[
        unpacked(c).alias(c) if c in hashes else F.col(c) for c in df.columns]).write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.parquet(path)
    sides = [f(c).alias(f"{side}_{c}") for c in columns for side, f in (("lo", F.min), ("hi", F.max))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns]
    (table.select("*", F.col("_metadata.file_name").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), *sides, *nulls)
     .coalesce(1).write.parquet(f"{path}/{MANIFEST}"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, n_rows, lo_, hi_ and nulls_ of each clustering column)."""
    return spark.read.parquet(f"{path}/{MANIFEST}")


def read_within(spark: SparkSession, path: str, **ranges: tuple[Any, Any]) -> DataFrame:
    """Rows whose columns lie within ``column=(least, greatest)``, None for no bound,
    from the files that may hold such rows alone.  Nulls lie in no range."""
    wanted = []
    for c, (lo, hi) in ranges.items():
        if lo is not None:
            wanted.append((c, F.col(f"hi_{c}") >= F.lit(lo), F.col(c) >= F.lit(lo)))
        if hi is not None:
            wanted.append((c, F.col(f"lo_{c}") <= F.lit(hi), F.col(c) <= F.lit(hi)))
    if not wanted:
        return spark.read.parquet(path)
    meet = reduce(lambda p, q: p & q, [m for _, m, _ in wanted])
    inside = reduce(lambda p, q: p & q, [r for *_, r in wanted])
    names = [r[0] for r in manifest(spark, path).filter(meet).select("file").collect()]
    schema = spark.read.parquet(path).schema
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in sorted(names)]).filter(inside)
