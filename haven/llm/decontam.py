"""Benchmark decontamination by pigeonhole edit matching.

A test item may occur in a document with up to k = floor(max_error * length)
edits.  Split into k + 1 pieces, at least one piece of any such occurrence is
untouched, so exact piece hits (one Aho-Corasick pass over each whole text)
find every candidate place.  Each place is verified with Myers' bit-parallel
edit distance.

Short items have no error budget: they match exactly, where no word goes on at
either end.

The test items are a stated query set: they reach the tasks in blocks of
bounded size, and every block meets every document.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haven.llm.common import LOWER, UPPER, WHITESPACE

#: Characters of test items that one block may hold (what a task keeps in memory).
BLOCK_CHARS = 1_000_000
_FOLD = str.maketrans(UPPER + WHITESPACE, LOWER + " " * len(WHITESPACE))


#: Letters of scripts written without spaces: a word may end anywhere between them.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def fold(text: str) -> str:
    """A-Z in lower case, any white space as a space; offsets stay."""
    return text.translate(_FOLD)


def in_word(c: str) -> bool:
    """Letters, digits, marks and _, but for scripts written without spaces."""
    return (c == "_" or unicodedata.category(c)[0] in "LNM") and not _UNSPACED.match(c)


def whole_words(text: str, start: int, end: int) -> bool:
    """Whether no word goes on across ``start`` or ``end``."""
    return not (start > 0 and in_word(text[start - 1]) and in_word(text[start])
                or end < len(text) and in_word(text[end - 1]) and in_word(text[end]))


def myers_ends(pattern: str, text: str, k: int) -> list[tuple[int, int]]:
    """(end, distance) wherever ``pattern`` ends in ``text`` within ``k`` edits
    (Myers 1999, one machine word as wide as the pattern)."""
    m = len(pattern)
    peq: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        peq[c] |= 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, out = full, 0, m, []
    get = peq.get
    for j, c in enumerate(text):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
        if score <= k:
            out.append((j + 1, score))
    return out


def pieces_of(item: str, max_error: float) -> tuple[int, list[tuple[int, str]]]:
    """The error budget and its budget + 1 pieces as (offset, piece)."""
    k = int(len(item) * max_error)
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return k, [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class ItemBlock:
    """The automaton over the pieces of one block of items; those under
    ``min_chars`` are one piece (offset -1), without white space at the ends."""

    def __init__(self, items: list[tuple[object, str]], max_error: float, min_chars: int = 0):
        self.items = [(i, fold(t)) for i, t in items]
        self.budget = []
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, t) in enumerate(self.items):
            k, pieces = pieces_of(t, max_error) if len(t) >= min_chars else (0, [(-1, t.strip(" "))] if t.strip(" ") else [])
            self.budget.append(k)
            for offset, piece in pieces:
                places[piece].append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, at in places.items():
            self.automaton.add_word(piece, (len(piece), at))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[object, int, int, int]]:
        """(item id, start, end, distance) of the closest occurrence of each item found."""
        if not len(self.automaton):
            return []
        body = fold(text)
        starts: dict[int, set[int]] = defaultdict(set)
        exact: dict[int, tuple[int, int]] = {}  # first occurrence of short items
        for end, (length, places) in self.automaton.iter(body):
            for n, offset in places:
                if offset >= 0:
                    starts[n].add(end - length + 1 - offset)
                elif n not in exact and whole_words(body, end - length + 1, end + 1):
                    exact[n] = end - length + 1, end + 1
        out = [(self.items[n][0], a, b, 0) for n, (a, b) in exact.items()]
        for n, where in starts.items():
            item_id, item = self.items[n]
            k, best = self.budget[n], None
            lo = hi = None
            for s in [*sorted(where), None]:  # candidate places merged where their windows meet
                a, b = (s - k, s + len(item) + k) if s is not None else (None, None)
                if lo is not None and (s is None or a > hi):
                    for end, d in self._verify(item, body, max(0, lo), hi, k):
                        if best is None or d < best[1]:
                            best = end, d
                    lo = hi = None
                if s is not None:
                    lo, hi = (a if lo is None else lo), b
                if best is not None and best[1] == 0:
                    break
            if best is not None:
                end, d = best
                # where it starts: the same search backwards from its end
                back = body[max(0, end - len(item) - k): end][::-1]
                start = end - min((x for x in myers_ends(item[::-1], back, d) if x[1] == d), key=lambda x: x[0])[0]
                out.append((item_id, start, end, d))
        return out

    @staticmethod
    def _verify(item: str, body: str, lo: int, hi: int, k: int) -> list[tuple[int, int]]:
        at = body.find(item, lo, hi)
        if at >= 0:
            return [(at + len(item), 0)]
        return [(lo + e, d) for e, d in myers_ends(item, body[lo:hi], k)]


def contaminated(docs: DataFrame, benchmark: DataFrame, max_error: float = 0.05, min_chars: int = 40,
                 block_chars: int = BLOCK_CHARS, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document and test item found in it: doc_id (or the columns
    ``keys`` of the document), item_id, start, end (code points of the closest
    occurrence), distance (edits).

    Both sides are compared with A-Z in lower case and white space as spaces.
    Items shorter than ``min_chars`` code points match without edits, and only
    where no word goes on at either end (white space at their ends does not
    count).  Blank and null items and null texts match nothing.  Repeated rows and
    null ids give rows of their own; ties go to the first occurrence; an empty
    table on either side gives an empty result.
    """
    spark = docs.sparkSession
    items = (benchmark.select("item_id", F.col("text").alias("item")).filter(F.length("item") > 0)
             .withColumn("chars", F.length("item")))
    total = items.agg(F.sum("chars")).first()[0] or 0
    blocks = max(1, -(-2 * total // block_chars))
    items = items.withColumn("block", F.pmod(F.xxhash64("item", "item_id"), F.lit(blocks)))
    texts = docs.select(*keys, "text").filter(F.length("text") > 0)
    key_types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keys)
    schema = f"{key_types}, item_id {benchmark.schema['item_id'].dataType.simpleString()}, start long, end long, distance long"

    def one(block: int) -> DataFrame:
        # a block holds at most block_chars characters on average: bounded, whatever the benchmark's size
        own = spark.sparkContext.broadcast(
            [(r[0], r[1]) for r in items.filter(F.col("block") == block).select("item_id", "item").collect()])
        made: list[ItemBlock] = []

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not made:
                made.append(ItemBlock(own.value, max_error, min_chars))
            if not own.value:
                return
            for batch in batches:
                rows, hits = [], []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    for hit in made[0].find(text):
                        rows.append(i)
                        hits.append(hit)
                if rows:
                    item, start, end, d = zip(*hits, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(pa.array(rows)) for c in keys), pa.array(item), pa.array(start, pa.int64()),
                         pa.array(end, pa.int64()), pa.array(d, pa.int64())],
                        names=[*keys, "item_id", "start", "end", "distance"])

        return texts.mapInArrow(run, schema)

    return reduce(DataFrame.unionByName, [one(b) for b in range(blocks)])
