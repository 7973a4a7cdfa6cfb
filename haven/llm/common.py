"""Shared pieces of the training-data operators: row keys, written intermediates, hashing.

Every operator first projects the columns it needs, so extra input columns
(whatever their names) never reach its internal ones.
"""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haven.session import shared_dir

#: The white space of the word and line contracts: space, tab, LF, VT, FF, CR.
WHITESPACE = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` once below the cluster's shared folder and
    read it back.  A lost executor then costs a re-read, not a recomputation.
    The folder carries the application id, so a finished job's intermediates
    can be removed as one tree (``cleanup``)."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/haven-llm/{spark.sparkContext.applicationId}"


def cleanup(spark: SparkSession) -> None:
    """Remove this application's intermediates; call once its results are stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def document_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text): a row is known by its id and its text's hash, so null
    or repeated ids with different texts stay apart, and wholly repeated rows
    share one decision."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("th"), text.alias("text"))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["th"] == right["th"])


# ---- numpy hashing, inside tasks ------------------------------------------------

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


class Rolling:
    """Position-free hashes of any word range from one prefix sum: with an odd
    base b, sum(w[i] * b^i) over [s, e) times b^-s (mod 2^64)."""

    def __init__(self, base: int, salt: int):
        self.base, self.salt = base | 1, np.uint64(salt)
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) <= n:
            size = 1 << (n + 1).bit_length()
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(size, np.uint64(b), np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def prefix(self, hashes: np.ndarray) -> np.ndarray:
        n = len(hashes)
        self._grow(n)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(mix64(hashes ^ self.salt) * self.up[:n], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((prefix[end] - prefix[start]) * self.down[start])


#: Two independent rolling hashes: together 128 bits name a word sequence.
ROLL_A = Rolling(0x9E3779B97F4A7C15, 0x243F6A8885A308D3)
ROLL_B = Rolling(0xD6E8FEB86659FD93, 0x13198A2E03707344)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
