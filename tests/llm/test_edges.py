"""Rows that once broke an operator, and operators at the sizes that once did not scale."""

from __future__ import annotations

import gzip
import random
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from haven.llm import queries as Q
from haven.llm import setsketch

DOCS = "doc_id long, text string"


# ---- op 3 ---------------------------------------------------------------------

def test_a_source_a_row_spreads_over_tasks(spark):
    from haven.llm.sharding import interleave, numbered
    df = spark.createDataFrame([(i, f"text {i}", f"site {i}") for i in range(3000)], f"{DOCS}, source string")
    tied = df.withColumn("frac", F.lit(0.5)).withColumn("h", F.md5("text"))
    placed = numbered(tied, ["frac", "source", "h"], 10, "place").collect()
    assert sorted((r.source, r.place) for r in placed) == [(s, i) for i, s in enumerate(sorted(f"site {i}" for i in range(3000)))]
    dealt = tied.repartitionByRange(10, "frac", "source", "h").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in dealt) < 900
    got = interleave(df, 8, rows_per_bucket=100).collect()
    assert sorted((r.shard, r.slot) for r in got) == [(s, i) for s in range(8) for i in range(375)]


def test_repeated_rows_are_numbered_apart(spark):
    from haven.llm.sharding import interleave
    df = spark.createDataFrame([(1, "same", "s")] * 500 + [(2, None, None)] * 13, f"{DOCS}, source string")
    got = interleave(df, 8, rows_per_bucket=20).collect()
    assert len({(r.shard, r.slot) for r in got}) == 513 and max(r.slot for r in got) == 64


# ---- op 4 ---------------------------------------------------------------------

def test_lexing_is_linear_in_the_text():
    from haven.llm.secret_scan import flagged_literals

    def seconds(text):
        t = time.perf_counter()
        flagged_literals(text)
        return time.perf_counter() - t
    makes = {"signs": lambda n: "a=" * n, "terms": lambda n: "a=b+" * n, "sums": lambda n: "x = " + "b + " * n,
             "quotes": lambda n: "a=\"b='" * n, "known": lambda n: "".join(f"c{i}=1\n" for i in range(n)) + "a=" + " + ".join(f"c{i}" for i in range(n))}
    for name, make in makes.items():
        small, large = seconds(make(8_000)), seconds(make(80_000))
        assert large < 25 * max(small, 0.02), (name, small, large)


def test_padding_stays_with_its_literal():
    from haven.llm.secret_scan import flagged_literals, lex
    text = "client_secret = dGhpc2lzYXNlY3JldHZhbHVlMTIz==\n"
    assert [text[a:b] for a, b in flagged_literals(text)] == ["dGhpc2lzYXNlY3JldHZhbHVlMTIz=="]
    assert [(name, [v for *_, v in literals]) for name, literals, _ in lex("a=b=c")] == [("a", ["b"]), ("b", ["c"])]


# ---- op 6 ---------------------------------------------------------------------

def test_a_page_may_be_named_like_a_version_block(spark):
    from haven.llm.warc import arc_record, arc_version_block, pages_through_warc, parse_arc
    rows = [(1, "filedesc://x", "page"), (2, "filedesc://x 1", "1 0 y\nURL IP\n"), (3, "http://a", "z" * 200), (4, "filedesc://z", "z" * 200)]
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in pages_through_warc(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: ("response", None, 4), 2: ("response", None, 13), 3: ("response", None, 200), 4: ("revisit", 3, 200)}
    data = arc_version_block(2, "f.arc", "20240101000000") + arc_record(2, "filedesc://u", "20240203040506", b"1 0 x\nURL\n")
    assert [r.is_version_block for r in parse_arc(data)] == [True, False]


def test_warc_is_read_in_pieces():
    from haven.llm.warc import parse_warc, unzipped, warc_record
    records = [warc_record("response", f"http://{i}", "2024-01-01T00:00:00Z", "d", str(i), b"x\r\n\r\nWARC/1.1" * i, None) + b"\r\n\r\n"
               for i in range(40)]
    whole = b"".join(records)
    one, many = gzip.compress(whole), b"".join(map(gzip.compress, records))
    want = [(h["X-Source-Key"], b) for h, b in parse_warc([whole])]
    assert [len(b) for _, b in want] == [13 * i for i in range(40)]
    for data in (one, many):
        for size in (1, 7, 1 << 16):
            assert [(h["X-Source-Key"], b) for h, b in parse_warc(unzipped(data, size))] == want
    assert [(h["X-Source-Key"], b) for h, b in parse_warc(whole[i:i + 5] for i in range(0, len(whole), 5))] == want
    for cut in (30, 200, len(whole) - 20):
        with pytest.raises(ValueError):
            list(parse_warc([whole[:cut]]))


# ---- op 7 ---------------------------------------------------------------------

def test_long_runs_join_at_compatible_pieces():
    import sentencepiece

    from haven.llm.pieces import PieceCodec
    codec = PieceCodec.from_file(Q.VOCABULARY)
    lib = sentencepiece.SentencePieceProcessor(model_file=Q.VOCABULARY)
    r = random.Random(4)
    runs = ["a" * 3000, "ab" * 1500, "".join(r.choice("aeiou") for _ in range(3000)), "".join(r.choice("etaoinshr") for _ in range(3000)),
            "".join(r.choice(["the", "ing", "tion", "er", "est", "x"]) for _ in range(900)), "-" * 2500 + "=" * 2500, "中文" * 900]
    for run in runs:
        whole = codec._encode_known(run)
        for block in (3, 5, 16, 61, 500):
            assert codec._encode_run(run, block) == whole
        assert codec.encode(run) == lib.encode(run, add_bos=True, add_eos=True)


# ---- op 9 ---------------------------------------------------------------------

def test_numerals_are_no_letters(spark):
    from haven.llm import langid
    texts = ["½ ² ½", "Ⅷ ⅷ", "12 _ 3", "½ a", "一二"]
    train = [(i, "the cat sat on the mat" if i % 2 else "der Hund und die Katze", "en" if i % 2 else "de") for i in range(40)]
    df = spark.createDataFrame(train + [(100 + i, t, None) for i, t in enumerate(texts)], f"{DOCS}, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(df, langid.fit(df, Q.VOCABULARY), Q.VOCABULARY).collect()}
    assert [got[100 + i][0] == "und" for i in range(5)] == [not any(map(str.isalpha, t)) for t in texts]
    assert got[100] == ("und", 0.0)


def test_the_sample_is_the_least_hashes(spark):
    """The bound only spares ranking; the sample is that of a plain sort."""
    from haven.llm import langid
    docs = [(i, f"word{i} of a text", "en") for i in range(3000)] + [(5, "word5 again", "en")] * 900 + [(9000 + i, "wort", "de") for i in range(20)]
    df = spark.createDataFrame(docs, f"{DOCS}, lang string").repartition(5)
    small, all_ = langid.fit(df, Q.VOCABULARY, train_docs=20, rounds=1), langid.fit(df.limit(0), Q.VOCABULARY)
    assert small.languages == ["de", "en"] and all_.languages == []
    usable = df.filter(~langid.held_out(F.col("doc_id"))).distinct().withColumn("at", F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 40)))
    least = usable.filter("lang = 'en'").orderBy("at", "doc_id", F.xxhash64("text")).limit(20).union(usable.filter("lang = 'de'"))
    same = langid.fit(least.select("doc_id", "text", "lang"), Q.VOCABULARY, train_docs=20, rounds=1)
    assert (small.p == same.p).all()


# ---- op 10 --------------------------------------------------------------------

LINE = "a line of twenty letters or more"


def test_rows_of_one_id_are_one_document(spark):
    from haven.llm.lines import line_dedup
    df = spark.createDataFrame([(7, LINE), (7, f"{LINE}\nx"), (8, LINE)], DOCS)
    assert {r.n_dropped for r in line_dedup(df).collect()} == {0}
    df = df.union(spark.createDataFrame([(None, LINE), (None, LINE)], DOCS))
    got = sorted((r.doc_id or 0, r.n_dropped, r.kept_text) for r in line_dedup(df).collect())
    assert got == [(0, 1, ""), (0, 1, ""), (7, 1, ""), (7, 1, "x"), (8, 0, LINE)]


def test_the_anti_join_carries_the_result(spark, sf_dir, monkeypatch):
    from haven.llm import lines
    r = random.Random(6)
    batches = [[(doc, r.randrange(40), 0) for doc in range(b * 100, b * 100 + 60) for _ in range(3)] for b in range(7)]

    def state(fanout):
        index = lines.LineIndex(spark, fanout)
        for b in batches:
            index.add(spark.createDataFrame(sorted(set(b)), "doc_id long, h1 long, h2 long"))
        return index, sorted((x.h1, x.n_docs, x.max_doc) for x in index.totals().collect())
    holders = defaultdict(set)
    for doc, h, _ in (x for b in batches for x in b):
        holders[h].add(doc)
    want = sorted((h, len(d), max(d)) for h, d in holders.items())
    for fanout in (2, 3, 50):
        index, got = state(fanout)
        assert got == want
        met = [x.h1 for level in index.runs for run in level for x in run.collect()]
        assert len(met) == len(set(met)) == len(want)
        assert all(len(level) < fanout for level in index.runs + index.increments)
    # neither decision nor compaction shuffles a run again
    assert "Exchange" not in index.totals()._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
    monkeypatch.setattr(lines.LineIndex, "unmet", lambda self, batch: batch)
    assert state(2)[1] != want
    few = spark.createDataFrame([(i, LINE) for i in range(4)], DOCS)  # under three a batch
    assert {r.n_dropped for r in lines.line_dedup(few).collect()} == {0}
    monkeypatch.undo()
    assert sorted(r.n_dropped for r in lines.line_dedup(few).collect()) == [0, 1, 1, 1]


# ---- the pipeline -------------------------------------------------------------

def test_stages_on_awkward_and_empty_tables(spark, sf_dir, awkward_documents):
    import corpus_pipeline as P
    docs = awkward_documents
    want = docs.columns
    for table in (docs, docs.limit(0)):
        n = table.count()
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, table, sf_dir)
            got = out.collect()
            assert out.columns == want and len(got) <= n, name
            assert all(r.score == "clash" and r.n_lines == "clash" for r in got)
            if name == "line_dedup":
                assert len(got) == n
                by = defaultdict(set)
                for r in got:
                    by[r.doc_id].add(r.text)
                    assert r.n_chars == len(r.text)
                assert n == 0 or by[1] == {""} and by[9] == {""} and by[10] == {"  LINE of twenty letters or more "}
            if name == "language_id" and n:
                assert not {1, 2, 3, 4} & {r.doc_id for r in got}
            if name == "near_dedup" and n:
                assert {1, 2, 3, 4, 5, 6, 7} <= {r.doc_id for r in got}
            if name == "decontamination" and n:
                assert len(got) == n
        assert P.STAGES[-1][1](spark, table, sf_dir).count() == n


@pytest.fixture(scope="module")
def awkward_documents(spark):
    from tests.llm.test_llm_queries import AWKWARD
    df = spark.createDataFrame(AWKWARD, f"{DOCS}, lang string, source string, n_chars long")
    for c in ("score", "lang_pred", "kept_text", "n_dropped", "n_lines", "th", "stays_id", "hit_id", "hit_th", "row", "a.b", "kept"):
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3)


def test_sets_are_verified_without_a_copied_list():
    """A batch of set pairs is compared where it lies; no list of all sets is made beside it."""
    class Column:
        def __init__(self, values):
            self.values = pa.array(values, pa.binary())

        def __iter__(self):
            return iter(self.values)

        def to_pylist(self):
            raise MemoryError("a list of all sets")

    class Batch:
        sets = [np.array(x, np.uint64).tobytes() for x in ([1, 2, 3, 4], [1, 2, 3], [7])]
        columns = {"sa": Column(sets), "sb": Column([sets[1], sets[2], sets[2]])}
        rows = pa.RecordBatch.from_arrays([pa.array([10, 11, 12]), pa.array([1, 2, 3])], names=["u", "v"])

        def column(self, name):
            return self.columns[name]

        def select(self, names):
            return self.rows.select(names)

    got = [b.to_pydict() for b in setsketch._verify(75)(iter([Batch()]))]
    assert got == [{"u": [10, 12], "v": [1, 3]}]
