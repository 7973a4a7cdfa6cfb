"""Spelling variant grouping against brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

from haven.llm.spelling import ASCII_LOWER, RUN, spelling_groups, text_pieces

COLS = ("word", "form", "root", "n", "n_near", "form_n")


def brute_groups(docs, noise, min_chars=5, min_count=3):
    seen = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if noise and h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    n = {w: c for w, c in seen.items() if len(w) >= min_chars and c >= min_count}
    less = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            less[i, w[:i] + w[i + 1:]].add(w)
    near = {w: set() for w in n}
    for (_, cut), group in less.items():
        for w in group:
            near[w] |= group - {w}
            if cut in n:
                near[w].add(cut)
                near[cut].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(docs, **kw):
    return sorted(tuple(r[c] for c in COLS) for r in spelling_groups(docs, **kw).collect())


def test_brute_force_on_crowded_words(spark):
    r = random.Random(11)
    docs = [(i, " ".join("".join(r.choice("abÀÿz") for _ in range(r.choice((4, 5, 5, 6, 7)))) for _ in range(60)))
            for i in range(400)]
    long = "ab" * 700
    docs += [(None, f"{long} {long[:-1]} x{long} {long}"), (7, f"{long[::-1]} {long} {long[:-1]}"), (8, f"{long[:-1]}\n{long}x"),
             (9, f"{long}x {long}x x{long} x{long}")]
    docs += [(10_000 + i, "aaaaa aaaaaa aaaaaaa bbbbb") for i in range(5)] + [(20_000, "aaaaaaaa " * 50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    for noise in (97, 3, None):
        assert got(df, noise=noise) == brute_groups(docs, noise)
    assert got(df, noise=3, node_words=2) == brute_groups(docs, 3)  # salts change nothing


def test_chains_of_forms_end_at_the_last(spark):
    words = {"color": 40, "colour": 20, "colours": 10, "coloursx": 5, "lonely": 3, "rarer": 2}
    docs = [(1, " ".join(w for w, n in words.items() for _ in range(n)))]
    assert {w: root for w, _, root, *_ in got(spark.createDataFrame(docs, "doc_id long, text string"))} == {
        "color": "color", "colour": "color", "colours": "color", "coloursx": "color", "lonely": "lonely"}


def test_awkward_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert got(none) == []
    docs = [(1, None), (None, None), (2, ""), (3, "1234 中文 ab ABCDE abcde"), (3, "abcde"), (4, "×÷×÷× ×÷×÷× ×÷×÷×"),
            (5, "ÀBCDE àbcde " * 3)]
    df = spark.createDataFrame([(*d, "x", 1, 2, 3) for d in docs],
                               "doc_id long, text string, word string, n int, node int, back int")
    assert got(df) == brute_groups(docs, None)


def test_pieces_cut_no_run():
    text = "ab1" * 50 + "word" * 40 + " é" * 9
    for size in (1, 3, 64):
        parts = list(text_pieces(text, size))
        assert "".join(parts) == text and [x for p in parts for x in RUN.findall(p)] == RUN.findall(text)
