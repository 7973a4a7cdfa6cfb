"""Materialised medallion layers (silver, gold) as Parquet tables.

A layer is built once per (inputs, code) fingerprint and written under the
shared folder; every later query reads the written table, so scans get
column pruning, pushed filters and row-group pruning, and a lost executor
costs a re-read rather than a rebuild of the lineage.

Publishing is atomic: the build writes to a private staging folder and is
then renamed into place; a reader trusts a layer only once its ``_SUCCESS``
marker exists, and a concurrent builder that loses the rename simply reads
the winner's table.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from haven.operators.quality import QualityError, require  # noqa: F401 - raised by a gate
from haven.session import job_dir, shared_dir
from haven.sources.clustered import write_clustered

_CODE_FILES = ["sources/fixtures.py", "operators/conform.py", "operators/star.py", "operators/keys.py",
               "operators/history.py", "operators/sequence.py", "operators/quality.py", "sources/clustered.py",
               "functions/privacy.py", "functions/dates.py", "contracts.py", "plans/context.py"]


def _code_version() -> str:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha256()
    for rel in _CODE_FILES:
        with open(os.path.join(root, rel), "rb") as fh:
            h.update(fh.read())
    return h.hexdigest()[:12]


CODE_VERSION = _code_version()


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Identity of the inputs (every file's path, size and modification time) plus our code."""
    h = hashlib.sha256(CODE_VERSION.encode())
    for path in sorted(paths):
        fs, p = _fs(spark, path)
        # a folder's own time says nothing about its files (and object stores keep none)
        files, found = fs.listFiles(p, True), []
        while files.hasNext():
            st = files.next()
            found.append(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()}")
        h.update("\n".join([path, *sorted(found)]).encode())
    return h.hexdigest()[:16]


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def materialize(spark: SparkSession, name: str, build: Callable[[], DataFrame], inputs: list[str],
                cluster_by: list[str] | None = None, gate: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The published layer as a table; see ``layer_path``."""
    return spark.read.parquet(layer_path(spark, name, build, inputs, cluster_by, gate))


def layer_path(spark: SparkSession, name: str, build: Callable[[], DataFrame], inputs: list[str],
               cluster_by: list[str] | None = None, gate: Callable[[DataFrame], DataFrame] | None = None,
               hashes: list[str] | None = None) -> str:
    """The folder of the published layer.  ``gate`` turns the staged table into
    (rule, status) rows, one per rule; any status but OK stops the layer before
    it is published.  ``cluster_by`` lays the table out along a curve through
    these columns, with a manifest (see ``clustered``); what is staged is
    sampled for it and passes the gate first, so nothing is derived twice."""
    # a session may ask for its own namespace (e.g. a benchmark that must time the build)
    space = spark.conf.get("haven.layers.namespace", "") or "shared"
    final = f"{shared_dir(spark)}/haven/layers/{space}/{name}-{fingerprint(spark, inputs)}"
    if not _exists(spark, f"{final}/_SUCCESS"):
        df = build()
        stage = job_dir(spark, f"stage-{name}")
        df.write.mode("errorifexists").option("compression", "zstd").parquet(stage)
        if gate is not None:
            require(gate(spark.read.parquet(stage)), name)
        if cluster_by:
            staged, stage = spark.read.parquet(stage), f"{stage}-clustered"
            write_clustered(staged, stage, cluster_by, hashes=hashes)
        _publish(spark, stage, final)
        if not _exists(spark, f"{final}/_SUCCESS"):
            raise RuntimeError(f"could not publish layer {name} at {final}")
    return final


def _publish(spark: SparkSession, stage: str, final: str) -> None:
    """Rename stage -> final, failing (not nesting) when final already exists.

    ``FileContext.rename`` with ``Rename.NONE`` is an atomic create-if-absent:
    when two builders race, exactly one wins and the other keeps its staging
    copy, instead of being moved inside the winner's folder as a plain
    ``FileSystem.rename`` onto an existing directory would do.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src, dst = jvm.org.apache.hadoop.fs.Path(stage), jvm.org.apache.hadoop.fs.Path(final)
    fs = dst.getFileSystem(conf)
    fs.mkdirs(dst.getParent())
    fc = jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.toUri(), conf)
    rename_cls = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    opts = spark.sparkContext._gateway.new_array(rename_cls, 1)
    opts[0] = rename_cls.NONE
    try:
        fc.rename(src, dst, opts)
    except Exception as exc:
        if "FileAlreadyExists" not in str(exc) and not fs.exists(dst):
            raise
        # another builder published first; the caller checks for its _SUCCESS
