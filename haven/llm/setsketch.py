"""Near-duplicate linking with SetSketch registers.

A document's set of word shingles is summarised in ``REGISTERS`` registers.
Each shingle drives a Poisson process whose events hit uniformly random
registers; a register keeps its first event time h over all shingles, truncated
to the exponential grid k = floor(1 - log_b h).  Registers of a union are the
element-wise maxima (mergeable), and equal registers signal similar sets
(locality-sensitive).

Candidates: documents meet on bands of ``ROWS`` registers.  A band group is never
paired off: members are linked to one changing leader per round, linked
components drop out, and only members still in different components are
compared in the last, complete round.  There a pair of a small group is a
candidate row; a large group is compared inside tasks, block by block, on whole
shingle sets (one matrix product per block pair gives every intersection), and
only links come out.  A candidate row is dropped when its size ratio rules it
out or when the joint likelihood of both sketches puts its similarity far below
the threshold.  What remains is verified on whole shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haven.llm.common import ROLL_A, ROLL_B, document_rows, mix64, signed, word_hashes, written
from haven.llm.components import components

REGISTERS, ROWS = 192, 4
BANDS = REGISTERS // ROWS
BASE, RATE, TOP = 1.02, 20.0, 30_000
#: Six standard deviations of the estimate below the threshold (0.75 with 192 registers).
MARGIN = 0.19
ROUNDS = 2
#: Band groups up to this size give candidate rows; larger ones are compared inside tasks.
SMALL_GROUP = 24
#: Members of a large group that one task holds on either side of a comparison.
BLOCK = 512
#: Shingles per step of the matrix product.
CHUNK = 4096


def shingle_set(text: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of the ASCII-lower-cased words as sorted 64-bit hashes
    (and a second hash, in the same order); fewer than k words make one shingle."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = word_hashes(words)
    k = min(k, len(words))
    at = np.arange(len(words) - k + 1)
    a, first = np.unique(ROLL_A.ranges(ROLL_A.prefix(h), at, at + k), return_index=True)
    return a, ROLL_B.ranges(ROLL_B.prefix(h), at[first], at[first] + k)


def _events(elements: np.ndarray, start: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Steps (exponential with rate REGISTERS) and registers of events start..start+count-1 per element."""
    j = np.arange(start, start + count, dtype=np.uint64)
    x = mix64(elements[:, None] + (j[None, :] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    u = ((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0 ** -52
    return -np.log(u) / REGISTERS, ((x & np.uint64(0xFFF)) * np.uint64(REGISTERS) >> np.uint64(12)).astype(np.int64)


def sketch(elements: np.ndarray) -> np.ndarray:
    """Register values (int16) of a non-empty set of 64-bit hashes."""
    n = len(elements)
    horizon = (math.log(REGISTERS) + 3.0) / n
    while True:
        first = np.full(REGISTERS, np.inf)
        step, reg = _events(elements, 0, 1)
        live = np.flatnonzero(step[:, 0] <= horizon)
        times = step[live, 0]
        np.minimum.at(first, reg[live, 0], times)
        start, rest = 1, elements[live]
        width = max(4, int(REGISTERS * horizon / 2))
        while len(rest):
            step, reg = _events(rest, start, width)
            at = times[:, None] + np.cumsum(step, axis=1)
            due = at <= horizon
            np.minimum.at(first, reg[due], at[due])
            more = due[:, -1]
            rest, times, start = rest[more], at[more, -1], start + width
        if np.isfinite(first).all():
            k = np.floor(1.0 - np.log(first * (1.0 / RATE)) / math.log(BASE))
            return np.clip(k, 0, TOP).astype(np.int16)
        horizon *= 1.5


def likely(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, least: float) -> np.ndarray:
    """Whether the joint maximum-likelihood similarity of sketch rows a and b is
    at least ``least``: the log-likelihood is concave, so its slope at ``least``
    tells.  Cardinalities are known exactly."""
    u, v = na / (na + nb), nb / (na + nb)
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - above - below
    c, ln_b = (BASE - 1) / BASE, math.log(BASE)
    p = lambda x: -np.log1p(-c * x) / ln_b
    dp = lambda x: c / (1 - c * x) / ln_b
    j = np.minimum(least, np.minimum(u / v, v / u) * (1 - 1e-9))
    xu, xv = u - v * j, v - u * j  # shares above and below, before truncation
    pu, pv = np.maximum(p(np.maximum(xu, 0)), 1e-12), np.maximum(p(np.maximum(xv, 0)), 1e-12)
    du, dv = -v * dp(np.maximum(xu, 0)), -u * dp(np.maximum(xv, 0))
    slope = above * du / pu + below * dv / pv - same * (du + dv) / np.maximum(1 - pu - pv, 1e-12)
    return slope >= 0


def band_hashes(registers: np.ndarray) -> np.ndarray:
    """One 64-bit hash per band, for sketch rows."""
    x = registers.astype(np.int64).astype(np.uint64).reshape(len(registers), BANDS, ROWS)
    h = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)
    for r in range(ROWS):
        h = mix64(h ^ (x[:, :, r] + np.uint64(0x632BE59BD9B4E019)))
    return h


def _sketches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, s1, s2, regs = [], [], [], []
            for text in batch.column("text").to_pylist():
                a, b = shingle_set(text, k)
                size.append(len(a))
                s1.append(int(mix64(a).sum(dtype=np.uint64)) - (1 << 63) if len(a) else None)
                s2.append(int(mix64(b).sum(dtype=np.uint64)) - (1 << 63) if len(a) else None)
                regs.append(sketch(a).tobytes() if len(a) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(size, pa.int64()), pa.array(s1, pa.int64()),
                 pa.array(s2, pa.int64()), pa.array(regs, pa.binary())],
                names=["doc_id", "th", "n_shingles", "set1", "set2", "registers"])
    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        if n:
            regs = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.int16).reshape(n, REGISTERS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(band_hashes(regs)).ravel()),
                 batch.column("node").take(pa.array(np.repeat(np.arange(n), BANDS)))], names=["band", "node"])


def _shingles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([shingle_set(t, k)[0].tobytes() for t in batch.column("text").to_pylist()],
                                                pa.binary())], names=["node", "shingles"])
    return run


def _prefilter(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int16).reshape(-1, REGISTERS) for c in ("ra", "rb")]
                na, nb = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
                ok = likely(*rows, na, nb, threshold - MARGIN) & (np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9)
                yield batch.select(["u", "v"]).filter(pa.array(ok))
    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            # sets are read where the batch holds them, not copied as a list of them all
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                ok.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))
    return run


def _grouped(batches: Iterator[pa.RecordBatch], key: list[str], rest: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of equal keys in sorted batches."""
    held, at = [], None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in key + rest), strict=True):
            if row[: len(key)] != at:
                if held:
                    yield at, held
                held, at = [], row[: len(key)]
            held.append(row[len(key):])
    if held:
        yield at, held


def _small_groups(threshold: float):
    """Likely pairs of a small group whose components differ, each in the first band its members share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (band,), held in _grouped(batches, ["band"], ["node", "comp", "n", "registers"]):
            node, comp, n = (np.array([r[i] for r in held]) for i in range(3))
            i, j = np.triu_indices(len(held), 1)
            ok = (comp[i] != comp[j]) & (np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]) - 1e-9)
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            regs = np.frombuffer(b"".join(r[3] for r in held), np.int16).reshape(-1, REGISTERS)
            bands = band_hashes(regs)
            first = bands[i, np.argmax(bands[i] == bands[j], axis=1)]
            ok = (signed(first) == band) & likely(regs[i], regs[j], n[i].astype(float), n[j].astype(float), threshold - MARGIN)
            i, j = i[ok], j[ok]
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(node[i], node[j])),
                                                  pa.array(np.minimum(node[i], node[j]))], names=["u", "v"])
    return run


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of hash sets."""
    size = np.array([len(x) for x in left + right])
    values, column = np.unique(np.concatenate(left + right), return_inverse=True)
    shared = np.bincount(column, minlength=len(values)) > 1
    place = np.cumsum(shared) - 1
    row = np.repeat(np.arange(len(size)), size)[shared[column]]
    column = place[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(shared.sum()), CHUNK):
        a, b = np.searchsorted(column, (lo, lo + CHUNK))
        m = np.zeros((len(size), CHUNK), np.float32)
        m[row[a:b], column[a:b] - lo] = 1
        out += m[: len(left)] @ m[len(left):].T
    return out


def _large_groups(percent: int):
    """Links of one block pair of a large group: one for each member and other component it reaches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, bi, bj), held in _grouped(batches, ["band", "bi", "bj"], ["node", "comp", "blk", "shingles"]):
            left, right = ([(n, c, np.frombuffer(x, np.uint64)) for n, c, b, x in held if b == k] for k in (bi, bj))
            if not left or not right:
                continue
            met = intersections([x for *_, x in left], [x for *_, x in right])
            na, nb = (np.array([len(x) for *_, x in side]) for side in (left, right))
            ca, cb = (np.array([c for _, c, _ in side]) for side in (left, right))
            linked = (100 * met >= percent * (na[:, None] + nb[None, :] - met)) & (ca[:, None] != cb[None, :])
            out = set()
            for i in np.flatnonzero(linked.any(axis=1)).tolist():
                at = np.flatnonzero(linked[i])
                for j in at[np.unique(cb[at], return_index=True)[1]].tolist():
                    out.add((max(left[i][0], right[j][0]), min(left[i][0], right[j][0])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in out]), pa.array([v for _, v in out])], names=["u", "v"])
    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id (smallest doc_id
    reachable over links, itself included) and kept (it is that document).

    Two documents are linked when 100 * shared >= percent * union over their
    sets of distinct k-word shingles (A-Z in lower case).  Null, empty and
    blank texts have no shingles and link with nothing; texts under k words are
    one shingle.  Rows that share an id are one document: a link of either
    counts for both.  A null id is linked with nothing and kept.  doc_id must
    be an integer column; an empty table gives an empty result.

    A pair at exactly the threshold misses every band with probability below
    2e-8; every link found is confirmed on whole sets.
    """
    threshold = percent / 100
    rows = document_rows(docs)
    id_type = rows.schema["doc_id"].dataType
    if not isinstance(id_type, T.IntegralType):
        raise ValueError("near_duplicates needs integer document ids")
    sketched = written(rows.mapInArrow(_sketches(k), f"doc_id {id_type.simpleString()}, th long, n_shingles long, "
                                                     "set1 long, set2 long, registers binary"), "sketches")
    usable = sketched.filter("n_shingles > 0 and doc_id is not null")
    # equal sets: linked to the smallest id that has the set, which alone goes on
    one_set = written(usable.groupBy("set1", "set2", "n_shingles").agg(F.min(F.col("doc_id").cast("long")).alias("node")),
                      "sketch-one")
    copies = (usable.join(one_set, ["set1", "set2", "n_shingles"]).filter("doc_id <> node")
              .select(F.col("doc_id").cast("long").alias("u"), F.col("node").alias("v")).distinct())
    heads = (one_set.join(usable.select(F.col("doc_id").cast("long").alias("node"), "set1", "set2", "n_shingles", "registers",
                                        "th").dropDuplicates(["node", "set1", "set2", "n_shingles"]),
                          ["node", "set1", "set2", "n_shingles"]))
    # a head is (node, th): rows of one id with several sets are several heads of one node
    heads = written(heads.select("node", "th", F.col("n_shingles").alias("n"), "registers"), "sketch-heads")
    bands = heads.select("node", "registers").mapInArrow(_bands, "band long, node long")
    groups = (bands.groupBy("band").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("lead"), F.max("node").alias("top"))
              .filter("lead <> top"))
    met = written(bands.join(groups.select("band", "members"), "band"), "sketch-bands")
    suspects = written(met.select("node").distinct().join(heads, "node"), "sketch-suspects")
    texts = rows.select(F.col("doc_id").cast("long").alias("node"), "th", "text")
    sets = written(texts.join(suspects.select("node", "th"), ["node", "th"]).dropDuplicates(["node", "th"])
                   .select("node", "text").mapInArrow(_shingles(k), "node long, shingles binary"), "sketch-sets")
    sk = suspects.select("node", "n", "registers")

    def verified(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("sa"))
        right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("sb"))
        return pairs.join(left, "u").join(right, "v").select("u", "v", "sa", "sb").mapInArrow(
            _verify(percent), "u long, v long").distinct()

    def estimated(pairs: DataFrame) -> DataFrame:
        left = sk.select(F.col("node").alias("u"), F.col("n").alias("na"), F.col("registers").alias("ra"))
        right = sk.select(F.col("node").alias("v"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
        return pairs.join(left, "u").join(right, "v").select("u", "v", "na", "nb", "ra", "rb").mapInArrow(
            _prefilter(threshold), "u long, v long").distinct()

    links = copies
    labelled = met.withColumn("comp", F.col("node"))
    for turn in range(ROUNDS):
        # one leader per group: the smallest member first, then a changing one
        order = F.struct((F.xxhash64(F.lit(turn), "node") if turn else F.col("node")).alias("at"), "node", "comp")
        lead = labelled.groupBy("band").agg(F.min(order).alias("lead"), F.min("comp").alias("lo"), F.max("comp").alias("hi")) \
            .filter("lo <> hi").select("band", F.col("lead.node").alias("lead"), F.col("lead.comp").alias("lead_comp"))
        pairs = (labelled.join(lead, "band").filter("comp <> lead_comp")
                 .select(F.greatest("node", "lead").alias("u"), F.least("node", "lead").alias("v")).distinct())
        found = written(verified(estimated(pairs)), "sketch-links")
        links = written(links.unionByName(found), "sketch-all-links")
        comps = written(components(links), "sketch-components")
        labelled = written(met.join(comps.withColumnRenamed("node", "n2"), F.col("node") == F.col("n2"), "left")
                           .select("band", "node", "members", F.coalesce("component", "node").alias("comp")), "sketch-labels")

    # the complete round: whatever still lies in different components of one group
    open_ = labelled.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("band")
    rest = written(labelled.join(open_, "band"), "sketch-open")
    small = (rest.filter(F.col("members") <= SMALL_GROUP).join(sk, "node").select("band", "node", "comp", "n", "registers")
             .repartition("band").sortWithinPartitions("band").mapInArrow(_small_groups(threshold), "u long, v long").distinct())
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    large = rest.filter(F.col("members") > SMALL_GROUP).withColumn(
        "blk", F.pmod(F.xxhash64("node", F.lit("block")), blocks).cast("int"))
    spread = (large.select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
              .select("band", "node", "comp", "blk", F.least("blk", "other").alias("bi"), F.greatest("blk", "other").alias("bj")))
    inside = (spread.join(sets, "node").repartition("band", "bi", "bj").sortWithinPartitions("band", "bi", "bj")
              .mapInArrow(_large_groups(percent), "u long, v long").distinct())
    found = verified(small).unionByName(inside)
    links = written(links.unionByName(found), "sketch-final-links")
    comps = components(links)
    out = sketched.select("doc_id", "n_shingles").join(comps, F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("component", F.col("doc_id").cast("long")).cast(id_type)
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
