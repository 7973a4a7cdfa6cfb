"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Every sender (an input partition) fingerprints its normalised texts, sorts
   the distinct fingerprints of each owner (a range of fingerprint space) and
   sends them as one Golomb-Rice coded block, with a bit for those it met again:
   a hot text reaches its owner once per sender.
2. Owners decode the blocks of all senders, find fingerprints met more than
   once and answer each block with a bitmap over its sorted entries.
3. Senders read the bitmaps back onto their rows.  Only the suspects' texts are
   shuffled, and compared byte for byte by grouping on the text itself.

The exchange moves about 2 + log2(space / n) bits a document instead of rows;
texts of unsuspected documents never move to be compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haven.llm.common import WHITESPACE, document_rows, same_row, written

_WS = WHITESPACE.encode()
#: Fingerprints that one owner compares, on average at most.
OWNER_ROWS = 5_000_000


def golomb_encode(values: np.ndarray, shift: int) -> bytes:
    """Golomb-Rice code of ascending integers: the gaps' quotients in unary
    (zeros ended by a one), then the ``shift`` low bits of each gap."""
    gaps = np.diff(np.r_[np.uint64(0), values.astype(np.uint64)])
    ends = np.cumsum((gaps >> np.uint64(shift)).astype(np.int64) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    unary[ends] = 1
    low = (gaps[:, None] >> np.arange(shift, dtype=np.uint64)[None, :]) & np.uint64(1)
    return np.packbits(unary).tobytes() + np.packbits(low.astype(np.uint8).ravel()).tobytes()


def golomb_decode(block: bytes, n: int, shift: int) -> np.ndarray:
    if n == 0:
        return np.zeros(0, np.uint64)
    bits = np.unpackbits(np.frombuffer(block, np.uint8))
    ends = np.flatnonzero(bits)[:n]
    used = (int(ends[-1]) // 8 + 1) * 8
    quotients = np.diff(np.r_[-1, ends]) - 1
    low = bits[used: used + n * shift].reshape(n, shift).astype(np.uint64)
    gaps = (quotients.astype(np.uint64) << np.uint64(shift)) + (low << np.arange(shift, dtype=np.uint64)).sum(
        axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def best_shift(n: int, space: int) -> int:
    """Low bits per gap for ``n`` values spread over ``space``."""
    return max(1, int(space // max(1, n)).bit_length() - 1)


def sender_blocks(fingerprints: np.ndarray, per_owner: int) -> list[tuple[int, int, int, bytes, bytes]]:
    """(owner, n, shift, coded block, bits of repeats) of one sender's fingerprints, each sent once."""
    fp, times = np.unique(fingerprints.astype(np.uint64), return_counts=True)
    owner = fp // np.uint64(per_owner)
    out = []
    for o in np.unique(owner):
        at = owner == o
        own = fp[at] - np.uint64(int(o) * per_owner)
        shift = best_shift(len(own), per_owner)
        out.append((int(o), len(own), shift, golomb_encode(own, shift), np.packbits(times[at] > 1).tobytes()))
    return out


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sender = TaskContext.get().partitionId()
    for batch in batches:
        sha = [hashlib.sha256(t.encode().translate(None, _WS)).hexdigest()
               for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(sha), sender, np.int32)), pa.array(sha), batch.column("doc_id"),
             batch.column("th"), batch.column("n_cp")], names=["sender", "text_sha256", "doc_id", "th", "n_cp"])


def exact_dedup(docs: DataFrame, owners: int | None = None, fingerprint_bits: int = 48) -> DataFrame:
    """Per document row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting all white space.  Of equal
    texts the row with the most code points, then the smallest doc_id, stays.
    A null text counts as empty; empty texts equal one another; a null doc_id
    is larger than any other; wholly repeated rows count each in group_size
    and share one decision; an empty table gives an empty result.

    ``fingerprint_bits`` (8 to 60) only decides how many suspects need
    comparing, never the result: suspects are compared on whole texts.
    """
    spark = docs.sparkSession
    space = 1 << fingerprint_bits
    rows = document_rows(docs).withColumn("n_cp", F.length("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    lean = written(rows.mapInArrow(_fingerprint, f"sender int, text_sha256 string, doc_id {id_type}, th long, n_cp int")
                   .withColumn("fp", F.conv(F.substring("text_sha256", 1, 15), 16, 10).cast("long")
                               .bitwiseAND(F.lit(space - 1))), "exact-fingerprints")
    # an owner's share is bounded whatever the width of a shuffle
    owners = owners or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lean.count() // OWNER_ROWS))
    per_owner = -(-space // owners)

    def send(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *b) for b in sender_blocks(pdf["fp"].to_numpy(), per_owner)],
                            columns=["sender", "owner", "n", "shift", "block", "again"])

    def answer(key, pdf: pd.DataFrame) -> pd.DataFrame:
        blocks = [golomb_decode(b, n, s) for b, n, s in zip(pdf["block"], pdf["n"], pdf["shift"], strict=True)]
        values, counts = np.unique(np.concatenate(blocks), return_counts=True)
        again = [b[np.unpackbits(np.frombuffer(r, np.uint8), count=len(b)).astype(bool)]
                 for b, r in zip(blocks, pdf["again"], strict=True)]
        met = np.union1d(values[counts > 1], np.concatenate(again))
        return pd.DataFrame({"sender": pdf["sender"], "owner": key[0],
                             "bitmap": [np.packbits(np.isin(b, met)).tobytes() for b in blocks]})

    def read_back(key, mine: pd.DataFrame, bitmaps: pd.DataFrame) -> pd.DataFrame:
        fp = np.unique(mine["fp"].to_numpy())
        owner = fp // per_owner
        flags = np.zeros(len(fp), bool)
        for o, bitmap in zip(bitmaps["owner"], bitmaps["bitmap"], strict=True):
            at = np.flatnonzero(owner == o)
            flags[at] = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(at)).astype(bool)
        # flags travel; ids stay with Spark (a nullable id would turn into a float here)
        return pd.DataFrame({"fp": fp[flags]})

    blocks = lean.select("sender", "fp").groupBy("sender").applyInPandas(
        send, "sender int, owner int, n int, shift int, block binary, again binary")
    bitmaps = blocks.groupBy("owner").applyInPandas(answer, "sender int, owner int, bitmap binary")
    suspected = (lean.select("sender", "fp").groupBy("sender").cogroup(bitmaps.groupBy("sender"))
                 .applyInPandas(read_back, "fp long").distinct())
    suspects = lean.join(suspected, "fp", "left_semi").select("doc_id", "th").distinct()

    # byte verification: equal means one group of one text; copies combine map-side
    normal = F.translate(rows["text"], WHITESPACE, "")
    texts = rows.join(suspects, same_row(rows, suspects), "left_semi").select(
        "doc_id", "n_cp", F.sha2(normal, 256).alias("text_sha256"), normal.alias("normal"))
    null_last = F.struct((-F.col("n_cp")).alias("n"), F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("id"))
    classes = (texts.groupBy("text_sha256", "normal")
               .agg(F.count(F.lit(1)).alias("group_size"), F.min(null_last).alias("best"))
               .select("text_sha256", "group_size", F.col("best.id").alias("keep"), (-F.col("best.n")).alias("best_cp")))
    out = lean.join(classes, "text_sha256", "left")
    keep = F.when(F.col("best_cp").isNotNull(), F.col("keep")).otherwise(F.col("doc_id"))
    # rows of one id with equal texts but other spaces: the longest stays
    kept = keep.eqNullSafe(F.col("doc_id")) & (F.coalesce("best_cp", "n_cp") == F.col("n_cp"))
    return out.select("doc_id", keep.alias("keep_id"),
                      F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                      kept.alias("kept"), "text_sha256")
