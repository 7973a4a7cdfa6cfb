"""Small-file compaction of an append-only Parquet table beside its running sink.

Appenders only ever add files below ``data``.  A compaction bins the small ones by
bytes, writes each bin as one file of a new generation, and then publishes a
manifest: the generations that count, and the files they stand for.  A reader
takes what the newest complete manifest says and every file below ``data`` that it
does not name as replaced, so rows appended meanwhile are seen, and none is seen
twice.  A run that dies leaves files that no manifest names.  Replaced files are
removed by ``vacuum`` once no reader needs them.  One compaction at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TARGET_BYTES = 128 << 20


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _files(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files below a folder and their bytes; files of unfinished writes are passed over."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    found, it = {}, fs.listFiles(p, True)
    while it.hasNext():
        st = it.next()
        name = st.getPath().toUri().getPath()
        inner = name[len(p.toUri().getPath()):]
        if inner.endswith(".parquet") and not any(part.startswith(("_", ".")) for part in inner.split("/")):
            found[name] = st.getLen()
    return found


def bins(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Files under half the target in bins of about the target, the largest first, each where it fits first."""
    out: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        if size * 2 > target:
            continue
        for i, (used, names) in enumerate(out):
            if used + size <= target:
                out[i] = (used + size, [*names, name])
                break
        else:
            out.append((size, [name]))
    return [names for _, names in out if len(names) > 1]


class CompactedTable:
    def __init__(self, spark: SparkSession, path: str, target: int = TARGET_BYTES):
        self.spark, self.path, self.target = spark, path.rstrip("/"), target

    @property
    def data(self) -> str:
        """Where the sink writes."""
        return f"{self.path}/data"

    def version(self) -> int:
        fs, p = _fs(self.spark, f"{self.path}/manifests/*/_SUCCESS")
        return max((int(f.getPath().getParent().getName()) for f in fs.globStatus(p) or []), default=0)

    def _manifest(self) -> tuple[set[str], set[str]]:
        """(compacted files that count, files they and their forerunners replace)."""
        v = self.version()
        if not v:
            return set(), set()
        rows = self.spark.read.parquet(f"{self.path}/manifests/{v:06d}").collect()
        return {r["file"] for r in rows if r["live"]}, {r["file"] for r in rows if not r["live"]}

    def live(self) -> dict[str, int]:
        """The files a reader takes, and their bytes."""
        compacted, replaced = self._manifest()
        appended = {f: n for f, n in _files(self.spark, self.data).items() if f not in replaced}
        return appended | {f: n for f, n in _files(self.spark, f"{self.path}/compacted").items() if f in compacted}

    def read(self, schema) -> DataFrame:
        files = sorted(self.live())
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def stage(self, schema) -> tuple[list[str], list[str]]:
        """Write the bins; returns (new files, files they stand for).  Nothing is visible yet."""
        version = self.version() + 1
        old, new = [], []
        for i, names in enumerate(bins(self.live(), self.target)):
            out = f"{self.path}/compacted/{version:06d}/{i:06d}"
            self.spark.read.schema(schema).parquet(*names).coalesce(1).write.mode("overwrite").parquet(out)
            old += names
            new += sorted(_files(self.spark, out))
        return new, old

    def publish(self, new: list[str], old: list[str]) -> None:
        compacted, replaced = self._manifest()
        rows = [(f, True) for f in sorted((compacted | set(new)) - set(old))] + [(f, False) for f in sorted(replaced | set(old))]
        self.spark.createDataFrame(rows, "file string, live boolean").coalesce(1).write.parquet(
            f"{self.path}/manifests/{self.version() + 1:06d}")

    def compact(self, schema) -> int:
        """Bin, write, publish; returns the number of files replaced."""
        new, old = self.stage(schema)
        if old:
            self.publish(new, old)
        return len(old)

    def vacuum(self) -> int:
        """Remove replaced files; call when no reader holds an older manifest."""
        gone = 0
        for f in self._manifest()[1]:
            fs, p = _fs(self.spark, f)
            gone += bool(fs.delete(p, False))
        return gone
