"""Conversation structure repair by Hirschberg's divide and conquer.

A repaired conversation has role initials ``(s?(ua)+)?``: an automaton of four
states (nothing yet, after s, after u, after a).  A row is a table of the cheapest
words of edits from state to state, inserts before the row included.  Forward
costs from the start and backward costs from the end meet at the middle row; of
the states with the least sum the one whose audit so far is least in ASCII is the
crossing, and both halves are solved alike.  No more than a state a row is kept.

To compare audits without keeping them, the forward vector ranks its four states
by their audits: each ends with the edit of the same row, so none is a prefix of
another, and the order at the next row follows from rank and word.

On Spark, rows are dealt by ranges of (conversation, turn), so a conversation of
any length spreads over tasks.  Conversations that lie within a range are solved
there.  Of one cut by a range border, each piece becomes one table of the same
kind (state to state: cost, rank); the crossings at its borders come from the same
recursion over these tables, one row a piece, and then the pieces are solved each
by itself.  Only SHA-256, a chain by nature, streams a cut conversation through
one task, without holding it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haven.llm.common import WHITESPACE, written

STATES = range(4)
NEVER = 1 << 40
#: Where an inserted row leads from each state, and the cost of ending there.
INSERTED = (2, 2, 3, 2)
END_INSERTS = (0, 2, 1, 0)
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
END_COST = tuple(n * INSERT for n in END_INSERTS)
FINE, CUT_OFF, GOES = "fine", "truncated", "goes"


class Table:
    """Cost and rank (among the ends of one start) of the best audit from state to state."""

    def __init__(self, cost: list[list[int]], rank: list[list[int]], word: list[list[str]] | None = None):
        self.cost, self.rank, self.word = cost, rank, word


@lru_cache(None)
def row_table(initial: str, fault: str) -> Table:
    """What can become of one row: the cheapest, then least word for each pair of states."""
    initial = initial if initial in ("s", "u", "a") else "?"
    kept = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "?": {}}[initial]
    extra = TRUNCATED if fault == CUT_OFF else 0
    cost, rank, word = [], [], []
    for s in STATES:
        best: dict[int, tuple[int, str]] = {}
        at, before = s, ""
        for n in range(3):  # a third insert would only go round in a circle
            ways = [(at, DELETE, "D")]
            if fault != GOES:
                ways.append((INSERTED[at], REROLE + extra, "R"))
                if at in kept:
                    ways.append((kept[at], extra, "K"))
            for t, c, edit in ways:
                got = (n * INSERT + c, before + edit)
                best[t] = min(best.get(t, got), got)
            at, before = INSERTED[at], before + "I"
        order = sorted(best, key=lambda t: best[t][1])
        cost.append([best[t][0] if t in best else NEVER for t in STATES])
        word.append([best[t][1] if t in best else "" for t in STATES])
        rank.append([order.index(t) if t in best else len(order) for t in STATES])
    return Table(cost, rank, word)


@lru_cache(1 << 14)
def _forward_step(costs: tuple[int, ...], ranks: tuple[int, ...], table: Table) -> tuple[int, tuple, tuple]:
    """The next forward vector, less its least cost: (least, costs, ranks)."""
    best = [min((costs[s] + table.cost[s][t], ranks[s], table.rank[s][t]) for s in STATES) for t in STATES]
    order = sorted(STATES, key=lambda t: best[t][1:])
    least = min(b[0] for b in best)
    return least, tuple(min(b[0] - least, NEVER) for b in best), tuple(order.index(t) for t in STATES)


@lru_cache(1 << 14)
def _backward_step(costs: tuple[int, ...], table: Table) -> tuple[int, ...]:
    best = [min(table.cost[s][t] + costs[t] for t in STATES) for s in STATES]
    least = min(best)
    return tuple(min(b - least, NEVER) for b in best)


def only(state: int) -> tuple[int, ...]:
    return tuple(0 if s == state else NEVER for s in STATES)


def forward(tables: list[Table], lo: int, hi: int, start: int) -> tuple[int, tuple, tuple]:
    total, costs, ranks = 0, only(start), (0, 1, 2, 3)
    for i in range(lo, hi):
        least, costs, ranks = _forward_step(costs, ranks, tables[i])
        total += least
    return total, costs, ranks


def crossings(tables: list[Table], start: int, end: tuple[int, ...]) -> list[int]:
    """The state behind each table on the cheapest, then audit-least way from ``start`` to ends that cost ``end``."""
    after = [0] * len(tables)
    todo = [(0, len(tables), start, end)] if tables else []
    while todo:
        lo, hi, s, end = todo.pop()
        mid = (lo + hi + 1) // 2
        _, costs, ranks = forward(tables, lo, mid, s)
        back = end
        for i in range(hi - 1, mid - 1, -1):
            back = _backward_step(back, tables[i])
        x = min(STATES, key=lambda t: (costs[t] + back[t], ranks[t]))
        after[mid - 1] = x
        if mid - lo > 1:
            todo.append((lo, mid, s, only(x)))
        if hi > mid:
            todo.append((mid, hi, x, end))
    return after


def merged(tables: list[Table]) -> Table:
    """One table for a row of tables."""
    rows = [forward(tables, 0, len(tables), s) for s in STATES]
    return Table([[min(total + c, NEVER) for c in costs] for total, costs, _ in rows], [list(r) for *_, r in rows])


def audit_words(tables: list[Table], start: int, after: list[int]) -> Iterator[tuple[int, str]]:
    """(state before, word) of each row."""
    s = start
    for table, t in zip(tables, after, strict=True):
        yield s, table.word[s][t]
        s = t


def repaired_lines(rows: list[tuple[str, str]], words: Iterator[tuple[int, str]]) -> Iterator[str]:
    """``role:text`` of what the audit leaves."""
    for (role, text), (s, word) in zip(rows, words, strict=True):
        for edit in word:
            if edit == "K":
                yield f"{role}:{text}"
            elif edit != "D":
                yield f"{'assistant' if s == 2 else 'user'}:{text if edit == 'R' else ''}"
                s = INSERTED[s]


def inserted_lines(s: int) -> Iterator[str]:
    """The rows put behind the last one."""
    for _ in range(END_INSERTS[s]):
        yield "assistant:" if s == 2 else "user:"
        s = INSERTED[s]


# ---- Spark ----------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the contract's damage; dropped rows stay with no copy."""
    whole = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(whole("conv_id"), F.lit(":"), whole("turn")), "UTF-8")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(whole("text"), "[.!?]", "")).otherwise(whole("text"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       F.when(kind == 4, "user").otherwise(whole("role")).alias("role"),
                       F.when(kind == 0, "").otherwise(text).alias("text"),
                       F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def undamaged(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).alias("copies"))


def _fault(text: Column) -> Column:
    """blank or truncated; duplicates show later."""
    body = F.rtrim(text, F.lit(WHITESPACE))
    return F.when(body == "", "blank").when(~F.right(body, F.lit(1)).isin(".", "!", "?"), CUT_OFF).otherwise(FINE)


COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Piece:
    """Rows in order with their faults known: counts, and a table a row."""

    def __init__(self, rows: list[dict[str, Any]]):
        self.rows: list[tuple[str, str]] = []
        self.tables: list[Table] = []
        n = dict.fromkeys(COUNTS, 0)
        self.least = self.most = None
        last, before = object(), None
        for r in rows:
            for copy in range(r["copies"]):
                fault = r["fault"] if r["fault"] == "blank" else "duplicate" if r["again"] or copy else r["fault"]
                if fault != FINE:
                    n[fault] += 1
                initial = r["role"][:1]
                self.rows.append((r["role"], r["text"]))
                self.tables.append(row_table(initial, GOES if fault in ("blank", "duplicate") else fault))
                if before is not None:
                    n["illegal"] += before + initial not in ("su", "ua", "au")
                before = initial
            if r["copies"] and r["turn"] is not None:
                n["turns"] += r["turn"] != last
                last = r["turn"]
                self.least = last if self.least is None else self.least
                self.most = last
        self.n = n


def _solved(p: Piece) -> dict[str, Any]:
    """The result of a whole conversation."""
    after = crossings(p.tables, 0, END_COST)
    words = list(audit_words(p.tables, 0, after))
    end = after[-1] if after else 0
    lines = [*repaired_lines(p.rows, iter(words)), *inserted_lines(end)]
    audit = "".join(w for _, w in words) + "I" * END_INSERTS[end]
    states = [0, *after]
    cost = sum(t.cost[a][b] for t, a, b in zip(p.tables, states, after)) + END_COST[end]
    return dict(p.n, gaps=_gaps(p.least, p.most, p.n["turns"]), cost=cost, audit=audit,
                repaired_sha256=hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _gaps(least: int | None, most: int | None, turns: int) -> int:
    return 0 if least is None else most - least + 1 - turns


def grouped(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, Iterator[dict[str, Any]]]]:
    """Consecutive rows of equal keys, as a stream of groups that are streams (each to be read before the next)."""
    from itertools import groupby
    rows = (r for batch in batches for lo in range(0, batch.num_rows, 500) for r in batch.slice(lo, 500).to_pylist())
    return groupby(rows, key=lambda r: tuple(r[k] for k in keys))


def emit(rows: Iterator[dict[str, Any]], schema: pa.Schema, size: int = 2000, chars: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    held: list[dict[str, Any]] = []
    big = 0
    for r in rows:
        held.append(r)
        big += len(r.get("text") or "") + len(r.get("audit") or "")
        if len(held) >= size or big >= chars:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, big = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, Any]]], out: str) -> DataFrame:
    """``run`` over Arrow batches, giving dicts; ``conv_id`` keeps its type."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = StructType([df.schema["conv_id"]] + StructType.fromDDL(out).fields)
    arrow = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: emit(run(batches), arrow), schema)


def _within_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
    """Solve the conversations inside this range; pass on the rows of its first and last one."""
    pid, seq, held = TaskContext.get().partitionId(), 0, None
    for first, (_, rows) in enumerate(grouped(batches, "conv_id")):
        if held:
            seen: set[tuple[str, str]] = set()
            for r in held:
                r["again"] = (r["role"], r["text"]) in seen
                if r["copies"]:
                    seen.add((r["role"], r["text"]))
            yield dict(_solved(Piece(held)), conv_id=held[0]["conv_id"])
        held = None
        if first:
            held = list(rows)
            continue
        for r in rows:
            yield dict(r, pid=pid, seq=seq)
            seq += 1
    for r in held or ():
        yield dict(r, pid=pid, seq=seq)
        seq += 1


def _piece_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
    for (conv, pid), rows in grouped(batches, "conv_id", "pid"):
        p = Piece(list(rows))
        t = merged(p.tables)
        yield dict(p.n, conv_id=conv, pid=pid, least=p.least, most=p.most, cost=sum(t.cost, []), rank=sum(t.rank, []),
                   first=p.rows[0][0][:1] if p.rows else None, last=p.rows[-1][0][:1] if p.rows else None)


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
    """The states at the borders of each cut conversation's pieces; its totals go with the first piece."""
    for (conv,), rows in grouped(batches, "conv_id"):
        pieces = list(rows)  # a row a piece: no more than there are ranges
        tables = [Table([p["cost"][4 * s: 4 * s + 4] for s in STATES], [p["rank"][4 * s: 4 * s + 4] for s in STATES])
                  for p in pieces]
        after = crossings(tables, 0, END_COST)
        n = {c: sum(p[c] for p in pieces) for c in COUNTS}
        full = [p for p in pieces if p["first"] is not None]
        n["illegal"] += sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(full, full[1:]))
        timed = [p for p in pieces if p["least"] is not None]
        n["turns"] -= sum(a["most"] == b["least"] for a, b in zip(timed, timed[1:]))
        gaps = _gaps(timed[0]["least"], timed[-1]["most"], n["turns"]) if timed else 0
        cost = sum(t.cost[a][b] for t, a, b in zip(tables, [0, *after], after)) + END_COST[after[-1]]
        start = 0
        for i, (p, end) in enumerate(zip(pieces, after, strict=True)):
            totals = dict(n, gaps=gaps, cost=cost) if i == 0 else {}
            yield dict(totals, conv_id=conv, pid=p["pid"], start=start, stop=end, final=i == len(pieces) - 1)
            start = end


def _piece_audits(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
    """The audit and the repaired lines of each piece, the lines as many rows."""
    for (conv, pid), rows in grouped(batches, "conv_id", "pid"):
        held = list(rows)
        p, head = Piece(held), held[0]
        after = crossings(p.tables, head["start"], only(head["stop"]))
        words = list(audit_words(p.tables, head["start"], after))
        end = head["stop"]
        audit = "".join(w for _, w in words) + ("I" * END_INSERTS[end] if head["final"] else "")
        totals = {c: head[c] for c in ("gaps", "cost", *COUNTS)} if head["cost"] is not None else {}
        yield dict(totals, conv_id=conv, pid=pid, part=0, audit=audit)
        lines = repaired_lines(p.rows, iter(words))
        for part, line in enumerate(lines, 1):
            yield dict(conv_id=conv, pid=pid, part=part, text=line)
        if head["final"]:
            for part, line in enumerate(inserted_lines(end), len(p.rows) * 3 + 1):
                yield dict(conv_id=conv, pid=pid, part=part, text=line)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
    """Join the audits and run SHA-256 along the lines."""
    for (conv,), rows in grouped(batches, "conv_id"):
        digest, audit, out, started = hashlib.sha256(), [], None, False
        for r in rows:
            if r["text"] is not None:
                digest.update(("\n" if started else "").encode() + r["text"].encode())
                started = True
                continue
            audit.append(r["audit"])
            out = out or r
        yield dict(out, conv_id=conv, audit="".join(audit), repaired_sha256=digest.hexdigest())


def repair_structure(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, copies): conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A row's turn order is completed by role and text (their first 64 characters,
    then a hash), so ties have one order and equal rows are neighbours.  Null
    conv_ids are one conversation; null turns come first and count in no gap; a
    null role or text is one space; an empty role has no initial, so it is never
    kept as it is; rows with no copy are gone but their conversation is reported
    with zeros, an empty audit and the hash of nothing; an empty table gives none.
    """
    text_key = lambda c: F.substr(F.col(c), F.lit(1), F.lit(64)).alias(f"{c}_key")
    order = ["conv_id", "turn", "role_key", "text_key", "h", "salt"]
    keyed = rows.select("conv_id", "turn", "role", "text", "copies", _fault(F.col("text")).alias("fault"), text_key("role"),
                        text_key("text"), F.xxhash64("role", "text").alias("h"), F.monotonically_increasing_id().alias("salt"))
    # the salt spreads equal rows of one turn over ranges
    ranges = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop(*order[2:])
    row = "turn long, role string, text string, copies int, fault string"
    solved = written(_mapped(ranges, _within_ranges, f"{RESULT}, {row}, pid int, seq long"), "dialogue-ranges")
    names = ["conv_id", *(f.split()[0] for f in RESULT.split(", "))]
    whole = solved.filter("pid is null").select(*names)

    cut = solved.filter("pid is not null").select("conv_id", "pid", "seq", *(c.split()[0] for c in row.split(", ")))
    cut = cut.withColumn("h1", F.xxhash64("role", "text")).withColumn("h2", F.xxhash64(F.lit("row"), "text", "role"))
    firsts = (cut.filter("copies > 0").groupBy(F.col("conv_id").alias("c"), F.col("h1").alias("f1"), F.col("h2").alias("f2"))
              .agg(F.min(F.struct("pid", "seq")).alias("met"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    again = F.coalesce(F.struct("pid", "seq") != F.col("met"), F.lit(False))
    cut = written(cut.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h1") == F.col("f1"))
                           & (F.col("h2") == F.col("f2")), "left").withColumn("again", again)
                  .drop("c", "h1", "h2", "f1", "f2", "met", "n"), "dialogue-cut")
    counts = ", ".join(f"{c} long" for c in COUNTS)

    def dealt(df: DataFrame, keys: list[str], within: list[str]) -> DataFrame:
        return df.repartition(*keys).sortWithinPartitions(*keys, *within)

    tables = _mapped(dealt(cut, ["conv_id", "pid"], ["seq"]), _piece_tables,
                     f"pid int, {counts}, least long, most long, cost array<long>, rank array<int>, first string, last string")
    borders = written(_mapped(dealt(tables, ["conv_id"], ["pid"]), _borders,
                              f"pid int, start int, stop int, final boolean, {counts}, gaps long, cost long"), "dialogue-borders")
    borders = borders.withColumnRenamed("conv_id", "c").withColumnRenamed("pid", "p")
    told = cut.join(borders, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("pid") == F.col("p"))).drop("c", "p")
    audits = _mapped(dealt(told, ["conv_id", "pid"], ["seq"]), _piece_audits,
                     f"pid int, part long, text string, audit string, {counts}, gaps long, cost long")
    chained = _mapped(dealt(audits, ["conv_id"], ["pid", "part"]), _chained, RESULT)
    return whole.unionByName(chained.select(*names))


ORACLE = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0,0,0,0,0,0,0,0]),
      lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT range::BIGINT AS i FROM range(256)))),
marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [('0x' || h)::BIGINT FOR h IN regexp_extract_all(
          hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..')]),
      lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]))) % 20 AS kind
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM marked),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS met,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged),
faults AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN body = '' THEN 'blank' WHEN met > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated'
         ELSE '' END AS fault FROM numbered),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id),
inserts(s, m, word, added) AS (VALUES
  (0, 0, '', []::VARCHAR[]), (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']),
  (1, 1, '', []), (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']),
  (2, 2, '', []), (2, 3, 'I', ['assistant:']), (3, 3, '', []), (3, 2, 'I', ['user:'])),
edits(m, edit, initial, t, price, named) AS (VALUES
  (0, 'D', NULL, 0, 2, NULL), (1, 'D', NULL, 1, 2, NULL), (2, 'D', NULL, 2, 2, NULL), (3, 'D', NULL, 3, 2, NULL),
  (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (3, 'K', 'u', 2, 0, NULL),
  (2, 'K', 'a', 3, 0, NULL), (0, 'R', NULL, 2, 1, 'user'), (1, 'R', NULL, 2, 1, 'user'), (3, 'R', NULL, 2, 1, 'user'),
  (2, 'R', NULL, 3, 1, 'assistant')),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS s, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} AS best FROM conversations
  UNION ALL
  SELECT w.conv_id, f.i, e.t, min({'cost': w.best.cost + 5 * length(n.word) + e.price
        + CASE WHEN f.fault = 'truncated' AND e.edit <> 'D' THEN 5 ELSE 0 END,
      'audit': w.best.audit || n.word || e.edit,
      'lines': w.best.lines || n.added || CASE WHEN e.edit = 'D' THEN [] ELSE [coalesce(e.named, f.role) || ':' || f.text] END})
  FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
  JOIN inserts n ON n.s = w.s JOIN edits e ON e.m = n.m AND (e.initial IS NULL OR e.initial = f.initial)
    AND (e.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
  GROUP BY w.conv_id, f.i, e.t),
ends AS (
  SELECT w.conv_id, min({'cost': w.best.cost + 5 * length(n.word), 'audit': w.best.audit || n.word,
                         'lines': w.best.lines || n.added}) AS best
  FROM walk w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
  JOIN inserts n ON n.s = w.s AND (n.m = 3 OR n.m = 0) WHERE w.i = coalesce(c.n, 0) GROUP BY w.conv_id)
SELECT e.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
  CASE WHEN c.n IS NULL THEN 0 ELSE e.best.cost END::BIGINT AS cost, CASE WHEN c.n IS NULL THEN '' ELSE e.best.audit END AS audit,
  sha256(CASE WHEN c.n IS NULL THEN '' ELSE coalesce(array_to_string(e.best.lines, chr(10)), '') END) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
