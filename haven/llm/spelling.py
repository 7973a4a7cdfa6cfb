"""Spelling variant grouping on a relational trie frontier.

The distinct words form a trie that is a table of edges: a node is the hash of a
prefix, and chains without a branch or a word end are one edge with a longer
label.  Every word walks the trie as rows (word, position, node, edits).  While
no edit is spent a word stays on its own path, so its states without an edit are
the branching nodes and word ends of that path.  At each of them one edit leaves the path: another first
character (replaced) or a character of the word passed over (deleted); an
inserted character is the deletion of the other word.  States with the edit
spent follow the rest of the word, level by level, one join with the edge table a
level, until none is left.  A state whose word is used up at a word end is a
neighbour; a join with the words themselves confirms it, so that hashes lose and
add nothing.

The first edit lies in the latter half of the word or, read backwards, in the
latter half of the reversed word.  Both readings are in one trie, and only nodes
in those halves are kept: near the root nearly all characters follow.

Nodes many words pass are salted by their number of words.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haven.llm.common import ROLL_A, ROLL_B, signed, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
NOT_RUN = re.compile("[^A-Za-zÀ-ÿ]")
ASCII_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
#: Characters of a text searched at once, and distinct runs a task holds before it sends them on.
PIECE, HELD = 1 << 20, 400_000
#: Words at one node that meet its edges in one task.
NODE_WORDS = 20_000
#: Codes of what follows a prefix: 0 its end, 1 to 26 a to z, 27 to 90 U+00C0 to U+00FF; two bit masks hold them.
SPLIT = 46


# ---- words and their counts -----------------------------------------------------

def text_pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces that cut no run."""
    at = 0
    while at < len(text):
        cut = NOT_RUN.search(text, at + size) if at + size < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def noisy(run: str, doc_id: str, noise: int | None) -> str:
    """The run, without one code point if ``noise`` divides the checksum of document and run."""
    if noise is None:
        return run
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % noise else run[:h % len(run)] + run[h % len(run) + 1:]


def word_counts(docs: DataFrame, min_chars: int, min_count: int, noise: int | None) -> DataFrame:
    """(word, n) over all documents; tasks send on partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                             names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc"), batch.column("text"), strict=True):
                doc = doc.as_py()
                for piece in text_pieces(text.as_py() or ""):
                    for found, n in Counter(RUN.findall(piece)).items():
                        word = noisy(found.translate(ASCII_LOWER), doc, noise)
                        if len(word) >= min_chars:
                            total[word] += n
                    if len(total) > HELD:
                        yield flush()
        if total:
            yield flush()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text")
    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= min_count))


# ---- the trie -------------------------------------------------------------------

def _half_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, back, pos, node, m0, m1): the prefixes of each word, and of the word reversed, from the middle on."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        ids = batch.column("id").to_numpy()
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        lo = 0
        while lo < len(words):  # bounded characters at once
            hi = max(lo + 1, int(np.searchsorted(np.cumsum(lengths[lo:]), PIECE)) + lo)
            for back in (False, True):
                part = [w[::-1] for w in words[lo:hi]] if back else words[lo:hi]
                n = lengths[lo:hi]
                chars = np.frombuffer("".join(part).encode("utf-32-le"), np.uint32).astype(np.int64)
                starts = np.concatenate([[0], np.cumsum(n)[:-1]])
                first = n - n // 2 if back else n // 2
                counts = n - first + 1
                which = np.repeat(np.arange(len(n)), counts)
                pos = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + first[which]
                roll = ROLL_B if back else ROLL_A
                end = starts[which] + pos
                node = roll.ranges(roll.prefix(chars.astype(np.uint64)), starts[which], end)
                code = np.where(chars <= 122, chars - 96, chars - 165)
                code = np.where(pos < n[which], np.append(code, 0)[end], 0)
                one = np.int64(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi][which]), pa.array(np.full(len(which), back)), pa.array(pos.astype(np.int32)),
                     pa.array(signed(node)),
                     pa.array(np.where(code < SPLIT, one << np.minimum(code, SPLIT - 1), 0)),
                     pa.array(np.where(code >= SPLIT, one << np.maximum(code - SPLIT, 0), 0))],
                    names=["id", "back", "pos", "node", "m0", "m1"])
            lo = hi


def _char(word: Column, at: Column) -> Column:
    """The character at ``at`` (from 0), '' behind the end."""
    return F.substr(word, at + 1, F.lit(1))


def _follows(c: Column, m0: Column, m1: Column) -> Column:
    """Whether character ``c`` ('' : the end) is among those of the masks."""
    code = F.ascii(c)
    code = F.when(code == 0, 0).when(code <= 122, code - 96).otherwise(code - 165)
    at = F.when(code < SPLIT, F.call_function("shiftright", m0, code)).otherwise(
        F.call_function("shiftright", m1, code - SPLIT))
    return at.bitwiseAND(F.lit(1)) == 1


def trie_paths(words: DataFrame) -> DataFrame:
    """(w, n, back, path): per word and reading, its own nodes that branch or end a word, by position."""
    prefixes = written(words.select("id", "word").mapInArrow(
        _half_prefixes, "id long, back boolean, pos int, node long, m0 long, m1 long"), "spelling-prefixes")
    marks = (prefixes.groupBy("node").agg(F.bit_or("m0").alias("m0"), F.bit_or("m1").alias("m1"),
                                          F.count(F.lit(1)).alias("words"))
             .filter((F.bit_count("m0") + F.bit_count("m1") >= 2) | (F.col("m0").bitwiseAND(F.lit(1)) == 1)))
    own = (prefixes.select("id", "back", "pos", "node").join(marks, "node").groupBy("id", "back")
           .agg(F.sort_array(F.collect_list(F.struct("pos", "node", "m0", "m1", "words"))).alias("path")))
    text = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    return written(own.join(words, "id").select(text.alias("w"), "n", "back", "path"), "spelling-paths")


def trie_edges(paths: DataFrame) -> DataFrame:
    """(node, words, label, child, m0, m1): the edge table; m0 and m1 say what follows the child."""
    def edge(a: Column, i: Column) -> Column:
        b = F.get(F.col("path"), i + 1)
        return F.struct(a["node"].alias("node"), a["words"].alias("words"),
                        F.substr(F.col("w"), a["pos"] + 1, b["pos"] - a["pos"]).alias("label"),
                        b["node"].alias("child"), b["m0"].alias("m0"), b["m1"].alias("m1"))
    steps = F.transform(F.slice("path", F.lit(1), F.size("path") - 1), edge)
    return written(paths.select(F.explode(steps).alias("e")).select("e.*").distinct(), "spelling-edges")


# ---- the frontier ---------------------------------------------------------------

#: Of a state with its edit spent: word, reading, where the edit was and what it put there, next position and node.
STATE = ["w", "n", "back", "at", "put", "i", "node"]


def first_edits(paths: DataFrame, edges: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """Level 0: each word leaves its own path with its one edit."""
    w, at, label = F.col("w"), F.col("at"), F.col("label")
    own = (paths.select("w", "n", "back", F.explode("path").alias("p"))
           .select("w", "n", "back", F.col("p.pos").alias("at"), F.col("p.node").alias("node"), F.col("p.words").alias("words"),
                   F.col("p.m0").alias("own0")).filter(at < F.length(w)))
    salts = lambda: F.ceil(F.col("words") / node_words).cast("int")
    left = own.withColumn("salt", F.pmod(F.xxhash64("w"), salts()).cast("int")).drop("words", "own0")
    right = edges.withColumn("salt", F.explode(F.sequence(F.lit(0), salts() - 1))).drop("words")
    head = _char(label, F.lit(0))
    replaced = F.struct(head.alias("put"), (at + F.length(label)).alias("i"))
    deleted = F.struct(F.lit("").alias("put"), (at + 1 + F.length(label)).alias("i"))
    fits = [(head > _char(w, at)) & (F.substr(label, F.lit(2)) == F.substr(w, at + 2, F.length(label) - 1)),
            label == F.substr(w, at + 2, F.length(label))]
    steps = F.filter(F.array(F.when(fits[0], replaced), F.when(fits[1], deleted)), lambda s: s.isNotNull())
    moved = (left.join(right, ["node", "salt"]).filter(head != _char(w, at))
             .withColumn("s", F.explode(steps)).withColumn("put", F.col("s.put")).withColumn("i", F.col("s.i"))
             .filter(_follows(_char(w, F.col("i")), F.col("m0"), F.col("m1"))))
    # the last character deleted: the word without it ends at this node
    cut = own.filter((at == F.length(w) - 1) & (F.col("own0").bitwiseAND(F.lit(1)) == 1))
    return moved.select("w", "n", "back", "at", "put", "i", F.col("child").alias("node")).unionByName(
        cut.select("w", "n", "back", "at", F.lit("").alias("put"), (at + 1).alias("i"), "node"))


def follow(states: DataFrame, edges: DataFrame) -> DataFrame:
    """One level on: states whose word goes on meet the one edge that its next character names."""
    step = edges.select("node", _char(F.col("label"), F.lit(0)).alias("next"), "label", "child", "m0", "m1")
    i = F.col("i") + F.length("label")
    return (states.withColumn("next", _char(F.col("w"), F.col("i"))).join(step, ["node", "next"])
            .filter((F.col("label") == F.substr(F.col("w"), F.col("i") + 1, F.length("label")))
                    & _follows(_char(F.col("w"), i), F.col("m0"), F.col("m1")))
            .select("w", "n", "back", "at", "put", i.alias("i"), F.col("child").alias("node")))


def near_pairs(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """(word, n, near, near_n), each pair of words one edit apart once.  ``words`` is (id, word, n)."""
    paths = trie_paths(words)
    edges = trie_edges(paths)
    ended = F.col("i") >= F.length("w")
    level = written(first_edits(paths, edges, node_words), "spelling-level-0")
    found = [level.filter(ended)]
    while True:
        alive = level.filter(~ended)
        if alive.isEmpty():
            break
        level = written(follow(alive, edges), f"spelling-level-{len(found)}")
        found.append(level.filter(ended))
    ends = found[0]
    for more in found[1:]:
        ends = ends.unionByName(more)
    w, at = F.col("w"), F.col("at")
    x = F.concat(F.substr(w, F.lit(1), at), F.col("put"), F.substr(w, at + 2))
    turn = lambda c: F.when(F.col("back"), F.reverse(c)).otherwise(c)
    half = F.floor(F.length("word") / 2).cast("int")
    same_half = F.substr(F.col("word"), F.lit(1), half) == F.substr(F.col("near"), F.lit(1), half)
    pairs = ends.select(turn(w).alias("word"), "n", turn(x).alias("near"), "back").filter(~(F.col("back") & same_half))
    return pairs.drop("back").join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form, by pointer doubling: the path to the last form halves each round."""
    at = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = at.join(onward, "root").select("word", F.col("further").alias("root"))
        if moved.isEmpty():
            return at
        at = written(at.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")


def spelling_groups(docs: DataFrame, min_chars: int = 5, min_count: int = 3, ratio: int = 2, noise: int | None = None,
                    node_words: int = NODE_WORDS) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    Words are maximal runs of letters (A-Z lower-cased) of at least ``min_chars``
    code points that occur at least ``min_count`` times.  A word's form is its most
    frequent near word (ties: first in code-point order) if that is at least
    ``ratio`` times as frequent; the root is the end of the chain of forms.  With
    ``noise`` a run loses a character where the checksum of document and run is divisible by it.

    Null and empty texts have no words; rows count each, repeats included; a null
    id counts as empty text in the checksum; no word gives an empty result.
    """
    counted = word_counts(docs, min_chars, min_count, noise)
    words = written(counted.withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    pairs = written(near_pairs(words, node_words), "spelling-pairs")
    best = lambda n, x: F.struct((-F.col(n)).alias("least"), F.col(x).alias("x"))
    sides = pairs.select("word", "n", best("near_n", "near").alias("b")).unionByName(
        pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), best("n", "word").alias("b")))
    every = words.select("word", "n", F.lit(None).cast(sides.schema["b"].dataType).alias("b")).unionByName(sides)
    judged = every.groupBy("word").agg(F.max("n").alias("n"), F.count("b").alias("n_near"), F.min("b").alias("b"))
    form = F.when(-F.col("b.least") >= ratio * F.col("n"), F.col("b"))
    judged = written(judged.select("word", "n", "n_near", form["x"].alias("form"), (-form["least"]).alias("form_n")),
                     "spelling-forms")
    roots = last_forms(judged.filter(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                                                     "form_n")


ORACLE = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0,0,0,0,0,0,0,0]),
      lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT range::BIGINT AS i FROM range(256)))),
runs AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents) GROUP BY ALL),
marked AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..')]),
      lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]))) AS h
  FROM runs, crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
    FROM marked) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS less FROM (
    SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT c.word, c.n, w.word, w.n FROM cuts c JOIN words w ON c.less = w.word
  UNION SELECT w.word, w.n, c.word, c.n FROM cuts c JOIN words w ON c.less = w.word),
best AS (
  SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r FROM pairs),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 2 * w.n THEN b.near END AS form,
         CASE WHEN b.near_n >= 2 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM best WHERE r = 1) b USING (word)),
chain AS (
  SELECT word, word AS at, form AS further FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.further)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.further IS NULL
"""
