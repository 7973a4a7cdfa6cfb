"""A stored client history (SCD2) that a batch of updates changes in place of the clients it names.

History and change log lie in buckets by client hash.  A merge reads the
buckets of its own clients, rebuilds those clients' versions, writes the buckets
anew and names them in a new manifest; all other buckets keep their files.  A
reader takes the newest complete manifest, so it sees a merge whole or not at
all, and a run that dies leaves files that no manifest names.  Of two writers of
one version the second fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haven.operators.history import collapse, effective, history_from_changes, merge_history

BUCKETS = 16
KINDS = ("history", "log")


class HistoryStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    # ---- manifests ----------------------------------------------------------------

    def version(self) -> int | None:
        """The newest version whose manifest is complete."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/*/_SUCCESS")
        done = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
        return max((int(f.getPath().getParent().getName()) for f in done or []), default=None)

    def manifest(self, version: int | None = None) -> dict[tuple[str, int], str]:
        """(kind, bucket) -> folder of one version, the newest by default; at most 2 x buckets entries."""
        version = self.version() if version is None else version
        if version is None:
            return {}
        rows = self.spark.read.parquet(f"{self.path}/manifests/{version:06d}").collect()
        return {(r["kind"], r["bucket"]): r["folder"] for r in rows}

    def _read(self, kind: str, buckets: set[int] | None = None, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        folders = [f for (k, b), f in sorted(self.manifest(version).items()) if k == kind and (buckets is None or b in buckets)]
        schema = self.spark.read.parquet(f"{self.path}/schema/{kind}").schema
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def history(self, version: int | None = None) -> DataFrame:
        return self._read("history", version=version)

    def log(self) -> DataFrame:
        return self._read("log")

    # ---- writing --------------------------------------------------------------------

    def bucket(self, client: Column) -> Column:
        return F.pmod(F.xxhash64(client), F.lit(self.buckets)).cast("int")

    def _publish(self, version: int, kept: dict[tuple[str, int], str], tables: dict[str, DataFrame]) -> None:
        folders = dict(kept)
        for kind, df in tables.items():
            base = f"{self.path}/data/{version:06d}/{kind}"
            (df.withColumn("_bucket", self.bucket(F.col("client_id_hash"))).hint("rebalance", "_bucket")
             .sortWithinPartitions("_bucket", "client_id_hash").write.partitionBy("_bucket").parquet(base))
            there = self.spark.read.parquet(base)
            if "_bucket" in there.columns:  # an empty table has no folders
                for r in there.select("_bucket").distinct().collect():
                    folders[kind, r[0]] = f"{base}/_bucket={r[0]}"
        rows = [(kind, b, folder) for (kind, b), folder in sorted(folders.items())]
        self.spark.createDataFrame(rows, "kind string, bucket int, folder string").coalesce(1).write.parquet(
            f"{self.path}/manifests/{version:06d}")

    def create(self, base: DataFrame, updates: DataFrame) -> None:
        """Version 0: the history of all updates so far."""
        log = collapse(updates)
        tables = {"history": history_from_changes(base, effective(log)), "log": log}
        for kind, df in tables.items():
            df.limit(0).write.parquet(f"{self.path}/schema/{kind}")
        self._publish(0, {}, tables)

    def merge(self, base: DataFrame, updates: DataFrame) -> set[int]:
        """Fold in a batch, backdated events included; returns the buckets it rewrote."""
        old = self.version()
        touched = {r[0] for r in updates.select(self.bucket(F.col("client_id_hash"))).distinct().collect()}
        if not touched:
            return touched
        history, log = merge_history(self._read("history", touched, old), self._read("log", touched, old), base, updates)
        kept = {(kind, b): folder for (kind, b), folder in self.manifest(old).items() if b not in touched}
        self._publish(old + 1, kept, {"history": history, "log": log})
        return touched
