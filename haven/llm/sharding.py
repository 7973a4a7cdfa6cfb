"""Proportional stratified interleaving: shards that each match the mixture.

Rows are ranked in a seeded shuffle within their source; a row's fractional
rank (rank - 1/2) / n(source) spreads every source evenly over [0, 1).  Sorting
by it interleaves the sources in proportion, and cutting the order into equal
runs gives shards whose counts differ by at most one and whose mixtures agree.

Places in an order come from a range exchange, never from one sort: rows are
dealt by ranges of the order's own keys, numbered inside their range, and the
ranges' counts give the offsets.  A source holding a third of all rows spreads
like any other, and so do any number of sources of one row, whose fractions are
all 1/2: the ranges cut by the whole key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from haven.llm.common import written

#: Rows numbered in one task on average: ranges grow with the data.
ROWS_PER_BUCKET = 20_000


def shuffle_key(seed: int, doc_id, crc, size):
    """A row's place in the seeded shuffle: 32 hex digits of (seed, id, content)."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit("~"))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), part(doc_id), part(crc), part(size)).cast("binary"))


def numbered(rows: DataFrame, keys: list[str], ranges: int, name: str) -> DataFrame:
    """``rows`` with their place (from 0) in the order by ``keys``, nulls first; rows alike in all keys in any order."""
    # the salt spreads rows that are alike in all keys
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    dealt = salted.repartitionByRange(ranges, *keys, "salt").sortWithinPartitions(*keys, "salt").drop("salt")
    # partition in the upper bits, row within it in the lower 33
    at = written(dealt.withColumn("at", F.monotonically_increasing_id()), "shard-places")
    at = at.withColumn("range", F.shiftright("at", 33)).withColumn("row", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    # one row per range
    before = at.groupBy(F.col("range").alias("r")).agg(F.count(F.lit(1)).alias("k")).select(
        "r", F.coalesce(F.sum("k").over(W.orderBy("r").rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long")).alias("before"))
    return at.join(before, F.col("range") == F.col("r")).withColumn(name, F.col("row") + F.col("before")).drop(
        "at", "range", "row", "r", "before")


def interleave(docs: DataFrame, shards: int = 8, seed: int = 17, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Per document row: doc_id, size (UTF-8 bytes + 1), text_crc32, source,
    shard (0-based) and slot (gapless from 0 within the shard).

    Null texts have no bytes; null sources are one source of their own; null
    ids are ordinary rows.  Rows alike in id, source and content are
    interchangeable, so ties cannot change the result as a set.  An empty
    table gives an empty result; shards beyond the row count stay empty.
    """
    utf8 = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    lean = docs.select("doc_id", "source", (F.octet_length(utf8) + 1).cast("long").alias("size"),
                       F.crc32(utf8).alias("text_crc32"))
    lean = written(lean.withColumn("h", shuffle_key(seed, F.col("doc_id"), F.col("text_crc32"), F.col("size"))), "shard-rows")
    n = lean.count()
    ranges = max(1, -(-n // rows_per_bucket))
    ties = ["h", "doc_id", "text_crc32", "size"]

    # rank within each source: place in the order by source, less the source's first place
    by_source = numbered(lean, ["source", *ties], ranges, "place")
    sources = by_source.groupBy(F.col("source").alias("src")).agg(F.count(F.lit(1)).alias("n_source"), F.min("place").alias("first"))
    # (2 * rank - 1) / (2 * n): the fraction
    frac = (2 * (F.col("place") - F.col("first")) + 1) / (2 * F.col("n_source"))
    ranked = written(by_source.join(sources, by_source["source"].eqNullSafe(F.col("src")))
                     .select("doc_id", "source", "size", "text_crc32", "h", frac.alias("frac")), "shard-ranks")

    place = numbered(ranked, ["frac", "source", *ties], ranges, "place")
    small, extra = divmod(n, shards)
    cut = extra * (small + 1)  # the first ``extra`` shards hold one row more
    early = F.col("place") < cut
    shard = F.when(early, F.floor(F.col("place") / (small + 1))).otherwise(
        extra + F.floor((F.col("place") - cut) / max(1, small)))
    first = F.when(early, F.col("shard") * (small + 1)).otherwise(cut + (F.col("shard") - extra) * small)
    out = place.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("place") - first).cast("long"))
    return out.select("doc_id", "source", "size", "text_crc32", "shard", "slot")


def law_columns(sharded: DataFrame) -> DataFrame:
    """The digest of the sharding query; rows are the law, so no shard grows."""
    return sharded.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                          F.lit(None).cast(T.IntegerType()).alias("grown_shard"))


#: The same shuffle, fractions and cut in DuckDB, CRC-32 included (reflected polynomial 0xEDB88320).
ORACLE = """
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0,0,0,0,0,0,0,0]),
      lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT range::BIGINT AS i FROM range(256)))),
rows_ AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')]),
      lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]))) AS text_crc32
  FROM documents, crc_table),
hashed AS (
  SELECT *, md5('17:' || coalesce(doc_id::VARCHAR, '~') || ':' || text_crc32 || ':' || size) AS h FROM rows_),
ranked AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, text_crc32, size) - 1)::DOUBLE
            / (2 * count(*) OVER (PARTITION BY source)) AS frac, count(*) OVER () AS n FROM hashed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY frac, source NULLS FIRST, h, doc_id NULLS FIRST, text_crc32, size) - 1 AS place,
         n // 8 AS small, n % 8 AS extra FROM ranked),
cut AS (
  SELECT *, CASE WHEN place < extra * (small + 1) THEN place // (small + 1)
                 ELSE extra + (place - extra * (small + 1)) // greatest(small, 1) END AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard,
  (place - CASE WHEN shard < extra THEN shard * (small + 1) ELSE extra * (small + 1) + (shard - extra) * small END)::BIGINT AS slot,
  NULL::INTEGER AS grown_shard
FROM cut
"""
