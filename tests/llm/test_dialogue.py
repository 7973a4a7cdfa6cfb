"""Conversation structure repair against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

from haven.llm.common import read_table
from haven.llm.dialogue import END_COST, Piece, audit_words, crossings, damaged, merged, repair_structure, undamaged

COLS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def broken(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute_repair(rows):
    """Whole audits carried through a plain dynamic program."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    n, seen, faults = defaultdict(int), set(), []
    for _, role, text in rows:
        body = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        fault = ("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
        faults.append(fault)
        n[fault] += 1
    turns = [t for t, *_ in rows if t is not None]
    # the best (cost, audit, lines, initials) by last initial

    def legal(x):
        return re.fullmatch("(s?(ua)*u?)?", x) is not None

    def put(into, initials, cost, audit, lines):
        if not legal(initials):
            return
        key = initials[-1:]
        new = (cost, audit, lines, initials)
        if key not in into or new[:2] < into[key][:2]:
            into[key] = new

    now = {"": (0, "", (), "")}

    def inserts(have):
        for _ in range(2):
            for cost, audit, lines, x in list(have.values()):
                for role in ("user", "assistant"):
                    put(have, x + role[0], cost + 5, audit + "I", (*lines, f"{role}:"))
        return have
    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for cost, audit, lines, x in inserts(now).values():
            put(new, x, cost + 2, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            late = 5 * (fault == "truncated")
            if role:
                put(new, x + role[0], cost + late, audit + "K", (*lines, f"{role}:{text}"))
            for other in ("user", "assistant"):
                put(new, x + other[0], cost + 1 + late, audit + "R", (*lines, f"{other}:{text}"))
        now = new
    cost, audit, lines, _ = min(v for v in inserts(now).values() if re.fullmatch("(s?(ua)+)?", v[3]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"], n["truncated"],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    return {conv: brute_repair(got) for conv, got in broken(rows).items()}


def got(df):
    out = {r.conv_id: tuple(r[c] for c in COLS[1:]) for r in df.collect()}
    assert len(out) == df.count()
    return out


def random_rows(r, conv, n):
    for turn in range(n):
        yield (conv, None if r.random() < .05 else turn - r.randint(0, 1),
               r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]),
               r.choice(["Yes.", "No!", "a b?", "open", " \t", "", None, f"x{r.random()}.", f"y{r.random()} "]))


def test_every_short_conversation(spark):
    """All sequences of up to four rows: the recursion against whole audits."""
    kinds = [("user", "."), ("assistant", "."), ("system", "."), ("assistant", ""), ("tool", "x"), ("user", "x")]
    for n in range(5):
        for rows in itertools.product(kinds, repeat=n):
            plain = [(i, role, (f"{i}" if text != "" else "") + text) for i, (role, text) in enumerate(rows)]
            p = Piece([dict(turn=t, role=role, text=text, copies=1, again=False,
                            fault="blank" if not text else "fine" if text[-1] == "." else "truncated") for t, role, text in plain])
            after = crossings(p.tables, 0, END_COST)
            audit = "".join(w for _, w in audit_words(p.tables, 0, after)) + "I" * (END_COST[after[-1] if after else 0] // 5)
            assert audit == brute_repair(plain)[6], rows


def test_pieces_join_as_the_whole():
    r = random.Random(2)
    for _ in range(300):
        rows = [dict(turn=t, role=role or " ", text=text or " ", copies=1, again=r.random() < .1,
                     fault=r.choice(["fine", "fine", "blank", "truncated"])) for _, t, role, text in random_rows(r, 1, r.randint(2, 40))]
        tables = Piece(rows).tables
        whole = crossings(tables, 0, END_COST)
        cuts = sorted(r.sample(range(1, len(tables)), r.randint(1, min(5, len(tables) - 1))))
        pieces = [merged(tables[a:b]) for a, b in itertools.pairwise([0, *cuts, len(tables)])]
        assert crossings(pieces, 0, END_COST) == [whole[c - 1] for c in [*cuts, len(tables)]]


def test_brute_force(spark):
    r = random.Random(9)
    rows = [x for conv in range(150) for x in random_rows(r, conv, r.randint(1, 12))]
    rows += list(random_rows(r, 1000, 900)) + list(random_rows(r, None, 40))  # one holds most rows of many ranges
    rows += [(2000, 5, "user", "same.")] * 300 + [(2001, None, "user", "a.")] * 2
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = expected(rows)
    assert got(repair_structure(damaged(df))) == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:  # conversations cut at many borders
        assert got(repair_structure(damaged(df))) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_given_table(spark, sf_dir):
    from haven.llm import queries as Q
    rows = [tuple(r) for r in read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    df = Q.op13_conversation_repair(spark, sf_dir)
    assert df.columns == list(COLS) and got(df) == expected(rows)


def test_awkward_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert got(repair_structure(damaged(empty))) == {}
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    rows = [(1, gone, "user", "x."), (2, None, None, None), (3, 1, "", ""), (4, 7, "user", "long " * 200_000)]
    df = spark.createDataFrame([(*x, "a", 1, 2, "b") for x in rows], f"{SCHEMA}, audit string, pid int, copies int, fault string")
    assert got(repair_structure(damaged(df))) == expected(rows)
    assert got(repair_structure(damaged(df)))[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    plain = got(repair_structure(undamaged(spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")], SCHEMA))))
    assert plain[1][5:7] == (0, "KK")
