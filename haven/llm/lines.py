"""Line dedup over levelled sorted runs of line hashes.

The index has *runs*, sorted tables of (line hash, number of documents that hold
it, largest such doc_id), and *increments* of the same columns.  A new batch
reduces its lines to one row per hash and merge-anti-joins the runs: lines never
met before become its own run at level 0, lines that a run holds become an
increment.  So a line lies in exactly one run, with what its first batch knew of
it, and all that came later is in the increments.  A level of ``fanout`` runs is
compacted into one run of the next level, and increments likewise, so a batch
meets O(log batches) runs.  Runs and increments are bucketed by hash: neither the
anti-join nor a compaction nor the decision shuffles them again.

The decision adds a run's increments to it: a line found in at least ``min_docs``
documents goes everywhere but in the largest doc_id that holds it.

DataFrame functions only; a line is named by 128 bits of hash.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haven.llm.common import WHITESPACE, ascii_lower, document_rows, scratch_root, written

HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line with white space stripped at both ends and A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(WHITESPACE)))


def line_hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def document_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, th, pos, h1, h2) of every line long enough to count."""
    return (rows.select("doc_id", "th", F.posexplode(F.transform(lines_of(F.col("text")), line_key)).alias("pos", "key"))
            .filter(F.length("key") >= min_chars)
            .select("doc_id", "th", "pos", line_hashes(F.col("key")).alias("h")).select("doc_id", "th", "pos", "h.*"))


class LineIndex:
    """Levelled runs and increments; ``add`` takes batches, ``totals`` is the whole state."""

    def __init__(self, spark: SparkSession, fanout: int = 4):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[list[DataFrame]] = []
        self.increments: list[list[DataFrame]] = []

    def _store(self, rows: DataFrame, name: str) -> DataFrame:
        """A table bucketed and sorted by hash."""
        table = f"line_{name}_{uuid.uuid4().hex[:12]}"
        (rows.select(*HASH, "n_docs", "max_doc").write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
         .option("path", f"{scratch_root(self.spark)}/{table}").saveAsTable(table))
        return self.spark.table(table)

    def unmet(self, batch: DataFrame) -> DataFrame:
        """The batch's lines that no run holds: one merge-anti-join a run."""
        for run in chain.from_iterable(self.runs):
            batch = batch.join(run, HASH, "left_anti")
        return batch

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch of (doc_id, h1, h2), one row per document and hash; returns
        the lines never met before.  A document comes in one batch only."""
        batch = self._store(lines.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("max_doc")), "batch")
        if not self.runs:
            fresh = batch
        else:
            fresh = self._store(self.unmet(batch), "run")
            self._push(self.increments, self._store(batch.join(fresh, HASH, "left_anti"), "increment"), _summed)
        self._push(self.runs, fresh, lambda runs: reduce(DataFrame.unionByName, runs))  # no line is in two of them
        return fresh

    def _push(self, levels: list[list[DataFrame]], table: DataFrame, merge: Callable[[list[DataFrame]], DataFrame]) -> None:
        """Put a table on level 0 and compact every level that is full."""
        for level in range(len(levels) + 1):
            if level == len(levels):
                levels.append([])
            levels[level].append(table)
            if len(levels[level]) < self.fanout:
                return
            table = self._store(merge(levels[level]), f"level_{level + 1}")
            levels[level] = []

    def totals(self) -> DataFrame:
        """(h1, h2, n_docs, max_doc) of every line: its run's row and its increments."""
        out = []
        for run in chain.from_iterable(self.runs):
            for more in chain.from_iterable(self.increments):
                added = more.select(*HASH, F.col("n_docs").alias("n"), F.col("max_doc").alias("m"))
                run = run.join(added, HASH, "left").select(
                    *HASH, (F.col("n_docs") + F.coalesce("n", F.lit(0))).alias("n_docs"), F.greatest("max_doc", "m").alias("max_doc"))
            out.append(run)
        return reduce(DataFrame.unionByName, out)


def _summed(increments: list[DataFrame]) -> DataFrame:
    """One increment for several, by merge joins: an aggregation over a union of
    bucketed tables would either shuffle them or trust a partitioning that the
    scans may give up."""
    def pair(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.select(*HASH, F.col("n_docs").alias("n"), F.col("max_doc").alias("m"))
        return a.join(b, HASH, "full").select(*HASH, (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("n_docs"),
                                              F.greatest("max_doc", "m").alias("max_doc"))
    return reduce(pair, increments)


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 3, fanout: int = 2,
               keep: list[str] | None = None) -> DataFrame:
    """Per document row: doc_id, n_lines (before dropping), n_dropped and
    kept_text (other lines joined by ``\\n``), after the input columns ``keep``.

    Lines are split at ``\\n`` of the whole text.  Null and empty texts are one
    empty line; lines under ``min_chars`` code points (stripped) never go; a
    line repeated inside one document counts once for it.  Rows that share an
    id are one document, repeated rows as well; rows with a null id are one
    document too, the smallest.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = document_rows(docs)
    lines = written(document_lines(rows, min_chars), "lines")
    index = LineIndex(spark, fanout)
    batch_of = F.pmod(F.xxhash64(F.lit("batch"), "doc_id"), F.lit(batches))
    per_doc = written(lines.select("doc_id", *HASH).distinct().withColumn("batch", batch_of.cast("int")), "line-docs")
    for b in range(batches):
        index.add(per_doc.filter(F.col("batch") == b))
    # written, so that the join below stands on plain exchanges and a hot line's rows can be split
    common = written(index.totals().filter(F.col("n_docs") >= min_docs).select(*HASH, "max_doc"), "line-common")
    gone = (lines.join(common, HASH).filter(~F.col("doc_id").eqNullSafe(F.col("max_doc")))
            .groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("pos")).alias("gone")))
    # a bit per line up to the last dropped one, from the gaps between dropped positions
    g = F.col("gone")
    bits = F.split(F.array_join(F.transform(g, lambda x, i: F.concat(F.repeat(F.lit("0"), F.when(i == 0, x).otherwise(
        x - F.get(g, i - 1) - 1)), F.lit("1"))), ""), "")
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("th").alias("gone_th"), F.size("gone").alias("n_gone"),
                       bits.alias("bits"))
    text = F.coalesce("text", F.lit(""))
    base = docs.select(F.struct(*(keep or [])).alias("kept_columns") if keep else F.lit(None).alias("kept_columns"),
                       "doc_id", F.xxhash64(text).alias("th"), lines_of(text).alias("all_lines"))
    out = base.join(gone, base["doc_id"].eqNullSafe(gone["gone_id"]) & (base["th"] == gone["gone_th"]), "left")
    stays = lambda x, i: F.coalesce(F.get(F.col("bits"), i), F.lit("0")) != "1"
    left = F.when(F.col("bits").isNull(), F.col("all_lines")).otherwise(F.filter("all_lines", stays))
    carried = [F.col("kept_columns")[c].alias(c) for c in keep or [] if c != "doc_id"]
    return out.select("doc_id", F.size("all_lines").cast("long").alias("n_lines"),
                      F.coalesce("n_gone", F.lit(0)).cast("long").alias("n_dropped"),
                      F.array_join(left, "\n").alias("kept_text"), *carried)


ORACLE = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS max_doc FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT coalesce(doc_id::VARCHAR, '~')) >= 3),
judged AS (
  SELECT k.*, (c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.max_doc) AS gone FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
