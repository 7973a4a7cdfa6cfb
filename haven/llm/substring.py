"""Substring dedup by seed and extend over winnowed anchors.

Seeds: each window of ``min_words`` words selects one anchor, the smallest
k-gram hash inside it (winnowing, rightmost on ties), so equal windows always
select equal anchors at equal offsets.  An anchor serves a contiguous run of
windows; the words those windows span are its *context*.

Extend: documents meet on anchor hashes.  Members of an anchor group with the
same context repeat all of it, however many they are (counted by aggregation,
never paired).  Where one anchor has several contexts, one representative of
each is extended both ways: the ``min_words`` windows around the shared anchor
(every split into words before and after it) are hashed and met by equality.
Overlapping repeated windows merge into maximal repeats.

Work is linear in occurrences: no pairs inside a group, and hot anchors are
combined map-side before each shuffle.  Windows are named by 128 bits of hash,
contexts by 64 bits within their anchor's group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haven.llm.common import ROLL_A, ROLL_B, document_rows, same_row, signed, word_hashes, written

ANCHOR = "ah long, c1 long, n_win int, doc_id {id}, th long, s0 int"
GRAM = 12  # words per seed; a window of min_words holds min_words - GRAM + 1 of them


def rightmost_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` entries the index of its minimum, the last
    one on ties, by doubling."""
    best, have = np.arange(len(x)), 1
    while have < width:
        step = min(have, width - have)
        a, b = best[: len(best) - step], best[step:]
        best, have = np.where(x[b] <= x[a], b, a), have + step
    return best


def anchors_of(hashes: np.ndarray, min_words: int, gram: int):
    """(anchor hash, first window, number of windows, context hash) arrays."""
    n = len(hashes)
    pa_ = ROLL_A.prefix(hashes)
    at = np.arange(n - gram + 1)
    grams = ROLL_A.ranges(pa_, at, at + gram)
    chosen = rightmost_argmin(grams, min_words - gram + 1)
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    count = np.diff(np.r_[first, len(chosen)])
    end = first + count - 1 + min_words
    return grams[chosen[first]], first, count, ROLL_B.ranges(ROLL_B.prefix(hashes), first, end)


def _anchors(min_words: int, gram: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = text.encode().split()
                if len(words) < min_words:
                    continue
                ah, first, count, c1 = anchors_of(word_hashes(words), min_words, gram)
                for c, v in zip(cols, (signed(ah), signed(c1), count.astype(np.int32),
                                       np.full(len(ah), i, np.int32), first.astype(np.int32)), strict=True):
                    c.append(v)
            if cols[0]:
                ah, c1, count, row, first = (np.concatenate(c) for c in cols)
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ah), pa.array(c1), pa.array(count),
                     batch.column("doc_id").take(row), batch.column("th").take(row), pa.array(first)], schema=schema)
    return run


def _windows(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                hashes = word_hashes(text.encode().split())
                pa_, pb = ROLL_A.prefix(hashes), ROLL_B.prefix(hashes)
                s0 = np.array([s["s0"] for s in spans])
                n = np.array([s["n_win"] for s in spans])
                off = np.concatenate([np.arange(k) for k in n])
                at = np.repeat(s0, n) + off
                for c, v in zip(out, (signed(ROLL_A.ranges(pa_, at, at + min_words)),
                                      signed(ROLL_B.ranges(pb, at, at + min_words)),
                                      *(np.repeat(np.array([s[k] for s in spans], np.int64), n)
                                        for k in ("ah", "c1")),
                                      np.repeat(n, n).astype(np.int32), off.astype(np.int32)), strict=True):
                    c.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=[
                    "w1", "w2", "ah", "c1", "n_win", "off"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, sha, kept_text, spans_out = [], [], [], [], []
        for text, marks in zip(batch.column("text").to_pylist(), batch.column("marks").to_pylist(), strict=True):
            words = text.encode().split()
            edge = np.zeros(len(words) + 1, np.int64)
            for m in marks or ():
                edge[m["a"]] += 1
                edge[m["b"]] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            turn = np.flatnonzero(np.diff(np.r_[0, gone.view(np.int8), 0]))
            kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if len(turn) else b" ".join(words)
            n_words.append(len(words))
            n_removed.append(int(gone.sum()))
            sha.append(hashlib.sha256(kept).hexdigest())
            kept_text.append(kept.decode())
            spans_out.append([{"start": int(a), "end": int(b)} for a, b in turn.reshape(-1, 2)])
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha),
            pa.array(kept_text, pa.string()),
            pa.array(spans_out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "repeats"])


def repeated_spans(rows: DataFrame, min_words: int = 35, gram: int | None = None) -> DataFrame:
    """(doc_id, th, marks): per document row the word ranges [a, b) that lie in
    a window repeated anywhere; documents without any are absent."""
    gram = gram or min(GRAM, max(1, min_words // 3))
    id_type = rows.schema["doc_id"].dataType
    schema = ANCHOR.format(id=id_type.simpleString())
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    anchors = rows.mapInArrow(_anchors(min_words, gram, arrow), schema)
    # seeds: anchors found more than once (counts combine map-side)
    # (written, so that the join stands on plain exchanges and a hot anchor's rows can be split)
    shared = written(anchors.groupBy("ah").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("ah"), "substring-shared")
    seeds = written(anchors.join(shared, "ah", "left_semi"), "substring-seeds")

    # one row per distinct context of an anchor
    ctx = ["ah", "c1", "n_win"]
    contexts = seeds.groupBy(*ctx).agg(F.count(F.lit(1)).alias("n"),
                                       F.min(F.struct("doc_id", "th", "s0")).alias("at"))
    several = contexts.groupBy("ah").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("ah")
    reps = contexts.join(several, "ah", "left_semi").filter("n_win > 0")
    per_doc = (reps.groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.th").alias("th"))
               .agg(F.collect_list(F.struct(*ctx, F.col("at.s0").alias("s0"))).alias("spans")))
    texts = rows.join(per_doc, same_row(rows, per_doc)).select(rows["text"], per_doc["spans"])
    windows = written(texts.mapInArrow(_windows(min_words), "w1 long, w2 long, ah long, c1 long, n_win int, off int")
                      .distinct(), "substring-windows")
    twice = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w1", "w2")
    extended = (windows.join(twice, ["w1", "w2"], "left_semi")
                .select(*ctx, F.col("off").alias("lo"), (F.col("off") + 1).alias("hi")))
    whole = contexts.filter("n > 1").select(*ctx, F.lit(0).alias("lo"), F.col("n_win").alias("hi"))
    # neighbouring repeated windows of one context as ranges, at most n_win of them
    found = written(whole.unionByName(extended).groupBy(*ctx)
                    .agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("offs")), "substring-found")
    marks = (seeds.join(found, ctx)
             .select("doc_id", "th", F.explode("offs").alias("o"), "s0")
             .select("doc_id", "th", F.struct((F.col("s0") + F.col("o.lo")).alias("a"),
                                              (F.col("s0") + F.col("o.hi") - 1 + min_words).alias("b")).alias("m")))
    return marks.groupBy("doc_id", "th").agg(F.collect_set("m").alias("marks"))


def substring_dedup(docs: DataFrame, min_words: int = 35) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed, kept_sha256, kept_text
    (kept words joined by one space) and the removed word ranges (maximal
    repeats, as [start, end)).

    Words are ``[^\\x20\\x09-\\x0D]+``.  Every word inside a window of
    ``min_words`` words whose sequence also starts anywhere else goes.  Null or
    empty texts have no words and stay; texts shorter than a window lose
    nothing; a wholly repeated row is a repeat of its twin; an empty table
    gives an empty result; null ids are kept apart by their texts.
    """
    rows = document_rows(docs)
    marks = repeated_spans(rows, min_words)
    joined = rows.join(marks, same_row(rows, marks), "left").select(rows["doc_id"], rows["text"], marks["marks"])
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(_cut, f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string, "
                                   "kept_text string, repeats array<struct<start: int, end: int>>")
