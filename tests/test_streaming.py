"""Streaming behaviour: restart, rate limit, lateness, supervision, adapters."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from haven import contracts as C
from haven.streaming import jobs

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def _bed(spark, rows):
    return spark.createDataFrame(
        [(e, "CHECKIN", "C1", "P1", "B1", t) for e, t in rows], C.BED_EVENTS)


def _drop(spark, root, name, rows):
    jobs.publish(jobs.to_messages(_bed(spark, rows).coalesce(1)), f"{root}/landing/{name}")
    time.sleep(1.1)  # ascending file times: the source takes oldest first


def test_restart_no_dup_no_loss(spark, scratch):
    _drop(spark, scratch, "d0", [("e1", T0), ("e2", T0)])
    src = lambda: jobs.parse_topic(jobs.file_source(spark, f"{scratch}/landing/*"), C.BED_EVENTS, "bed")
    jobs.run_available_now(src(), f"{scratch}/out", f"{scratch}/_chk")
    _drop(spark, scratch, "d1", [("e3", T0)])
    jobs.run_available_now(src(), f"{scratch}/out", f"{scratch}/_chk")   # restart on the same checkpoint
    ids = sorted(r.event_id for r in spark.read.parquet(f"{scratch}/out").collect())
    assert ids == ["e1", "e2", "e3"]


def test_rate_limit_batches(spark, scratch):
    for i in range(3):
        _drop(spark, scratch, f"d{i}", [(f"e{i}", T0)])
    s = jobs.parse_topic(jobs.file_source(spark, f"{scratch}/landing/*", max_files=1), C.BED_EVENTS, "bed")
    q = jobs.run_available_now(s, f"{scratch}/out", f"{scratch}/_chk")
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3 and all(p["numInputRows"] == 1 for p in batches)


def test_late_rows_dropped_only_by_a_stateful_operator(spark, scratch):
    """I3: the watermark drops a late row only in a stateful operator, and the
    late filter lags: it uses the watermark of the batch before, so the late
    row is dropped two batches after the one that moved the watermark."""
    _drop(spark, scratch, "d0", [("e1", T0)])
    _drop(spark, scratch, "d1", [("e2", T0 + dt.timedelta(hours=3))])
    _drop(spark, scratch, "d2", [("e3", T0 + dt.timedelta(hours=3, minutes=1))])
    _drop(spark, scratch, "d3", [("e4", T0 + dt.timedelta(minutes=5))])     # 3 h late
    src = jobs.file_source(spark, f"{scratch}/landing/*", max_files=1)
    parsed = jobs.parse_topic(src, C.BED_EVENTS, "bed")
    q = jobs.run_available_now(jobs.hourly_counts(parsed, "project_id"), f"{scratch}/out", f"{scratch}/_chk")
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  if p["stateOperators"])
    assert dropped == 1
    closed = spark.read.parquet(f"{scratch}/out").collect()
    assert [(r.window_start, r.n) for r in closed] == [(T0, 1)]
    # a stateless bronze stream over the same files keeps every row
    jobs.run_available_now(jobs.parse_topic(jobs.file_source(spark, f"{scratch}/landing/*", max_files=1),
                                            C.BED_EVENTS, "bed"), f"{scratch}/bronze", f"{scratch}/_chk2")
    assert spark.read.parquet(f"{scratch}/bronze").count() == 4


def test_one_query_fails_is_reported(spark, scratch):
    _drop(spark, scratch, "d0", [("e1", T0)])
    good = (jobs.file_source(spark, f"{scratch}/landing/*").writeStream.format("parquet")
            .option("checkpointLocation", f"{scratch}/_c1").trigger(availableNow=True).start(f"{scratch}/o1"))

    def boom(batch, batch_id):
        raise ValueError("sink unavailable")

    bad = (jobs.file_source(spark, f"{scratch}/landing/*").writeStream.foreachBatch(boom)
           .option("checkpointLocation", f"{scratch}/_c2").trigger(availableNow=True).start())
    errors = jobs.supervise([good, bad], timeout=120)
    assert len(errors) == 1 and "sink unavailable" in errors[0]


def test_source_adapter_options(spark, scratch):
    """Kafka is an option when its connector is present; here it is not, and
    the failure names the missing source rather than passing silently."""
    with pytest.raises(Exception, match="(?i)kafka"):
        jobs.kafka_source(spark, "localhost:9", "hmis.bed_events").writeStream.format("noop").start()
    _drop(spark, scratch, "d0", [("e1", T0)])
    r = jobs.file_source(spark, f"{scratch}/landing/*", max_files=7)
    assert r.isStreaming


def test_dedupe_within_watermark(spark, scratch):
    _drop(spark, scratch, "d0", [("e1", T0), ("e1", T0), ("e2", T0)])
    parsed = jobs.parse_topic(jobs.file_source(spark, f"{scratch}/landing/*"), C.BED_EVENTS, "bed")
    jobs.run_available_now(jobs.dedupe_events(parsed), f"{scratch}/out", f"{scratch}/_chk")
    assert sorted(r.event_id for r in spark.read.parquet(f"{scratch}/out").collect()) == ["e1", "e2"]


def test_client_id_hashed_before_sink(spark, scratch):
    """M4/M5: raw client ids never reach a stream sink."""
    _drop(spark, scratch, "d0", [("e1", T0)])
    parsed = jobs.parse_topic(jobs.file_source(spark, f"{scratch}/landing/*"), C.BED_EVENTS, "bed")
    jobs.run_available_now(parsed, f"{scratch}/out", f"{scratch}/_chk")
    cols = spark.read.parquet(f"{scratch}/out").columns
    assert "client_id" not in cols and "client_id_hash" in cols
    assert spark.read.parquet(f"{scratch}/out").filter(F.col("client_id_hash").rlike("^[a-f0-9]{64}$")).count() == 1


def test_live_bed_status_equals_batch(spark, sf_dir, scratch):
    """L3 streaming twin: state-store latest-per-bed + keyed upsert per batch
    ends equal to the batch computation over all events."""
    from haven.operators.beds import bed_status_current
    from haven.plans.context import Ctx
    ev = Ctx(spark, sf_dir).raw.bed_events
    mid = ev.agg(F.expr("percentile_approx(unix_micros(event_time), 0.5)")).first()[0]
    for i, part in enumerate([ev.filter(F.unix_micros("event_time") <= mid),
                              ev.filter(F.unix_micros("event_time") > mid)]):
        jobs.publish(jobs.to_messages(part.coalesce(1)), f"{scratch}/landing/d{i}")
        time.sleep(1.1)
    parsed = jobs.parse_topic(jobs.file_source(spark, f"{scratch}/landing/*", max_files=1), C.BED_EVENTS, "bed")
    q = (jobs.bed_status_updates(parsed).writeStream.outputMode("update")
         .foreachBatch(jobs.status_upsert_writer(f"{scratch}/status", ["project_id", "bed_id"]))
         .option("checkpointLocation", f"{scratch}/_chk").trigger(availableNow=True).start())
    jobs.finish(q)
    live = jobs.latest_version(spark, f"{scratch}/status")
    batch = bed_status_current(ev)
    assert sorted(live.collect()) == sorted(batch.select(*live.columns).collect())


def test_stream_sessions_equal_closed_batch_sessions(spark, sf_dir, scratch):
    """Native session windows on the stream emit exactly the batch sessions the
    watermark has closed (end <= max event time - 15 min)."""
    import datetime as _dt

    from haven.operators import outreach as ops
    from haven.plans.context import Ctx
    o = Ctx(spark, sf_dir).raw.outreach
    jobs.publish(jobs.to_messages(o), f"{scratch}/landing/d0")
    parsed = jobs.parse_topic(jobs.file_source(spark, f"{scratch}/landing/*"), C.OUTREACH, "outreach")
    jobs.run_available_now(ops.outreach_sessions_stream(parsed), f"{scratch}/out", f"{scratch}/_chk")
    streamed = spark.read.parquet(f"{scratch}/out")
    horizon = o.agg(F.max("event_time")).first()[0] - _dt.timedelta(minutes=15)
    batch = ops.outreach_sessions(o).filter(F.col("session_end") <= F.lit(horizon))
    cols = ["client_id_hash", "session_start", "session_end", "n_events"]
    assert sorted(streamed.select(*cols).collect()) == sorted(batch.select(*cols).collect())


def test_junk_is_a_dead_letter_on_every_path(spark, scratch):
    """A bad message is in the dead-letter table and in no result, whatever the pipeline keeps as state."""
    from haven import contracts as C
    good = [f'{{"event_id": "e{i}", "event_type": "CHECKIN", "client_id": "c", "project_id": "p", "bed_id": "b", '
            f'"event_time": "2024-01-01T0{i}:00:00.000000Z"}}' for i in range(4)]
    junk = ["junk", "42", "", "   ", '{"x": 1}', '{"event_id": null}', '["e1"]', '{"event_id": "']
    jobs.publish(spark.createDataFrame([(v,) for v in good + junk], "value string").coalesce(1), f"{scratch}/landing")
    builds = {"plain": lambda e: e, "dedupe": jobs.dedupe_events,
              "hourly": lambda e: jobs.hourly_counts(e, "project_id", "CHECKIN")}
    for name, build in builds.items():
        root = f"{scratch}/{name}"
        for _ in range(2):  # a second run finds nothing new
            jobs.run_with_dead_letters(jobs.file_source(spark, f"{scratch}/landing"),
                                       lambda g, b=build: b(jobs.parse_topic(g, C.BED_EVENTS, "bed_events")), f"{root}/out", root)
        letters = sorted((bytes(r.raw).decode(), r.reason) for r in jobs.dead_letters(spark, root).collect())
        assert letters == sorted([("junk", "malformed_json"), ("42", "not_an_object"), ("", "empty"), ("   ", "empty"),
                                  ('{"x": 1}', "no_event_id"), ('{"event_id": null}', "no_event_id"), ('["e1"]', "not_an_object"),
                                  ('{"event_id": "', "malformed_json")])
        out = spark.read.parquet(f"{root}/out")
        if "event_id" in out.columns:
            assert sorted(r.event_id for r in out.collect()) == ["e0", "e1", "e2", "e3"]
        assert out.filter("client_id_hash is null" if "client_id_hash" in out.columns else "project_id is null").count() == 0


def test_a_micro_batch_is_bounded(spark, scratch, monkeypatch):
    """The file source reads a bounded number of bytes at a time."""
    monkeypatch.setattr(jobs, "BATCH_BYTES", 300)
    for i in range(6):
        jobs.publish(spark.createDataFrame([("x" * 190,)], "value string").coalesce(1), f"{scratch}/landing-{i}")
    sizes = []
    jobs.run_batches(jobs.file_source(spark, f"{scratch}/landing-*"), lambda b, i: sizes.append(b.count()), f"{scratch}/_chk")
    assert sum(sizes) == 6 and max(sizes) <= 2


def test_live_versions_equal_the_batch_history(spark, scratch):
    """Late, repeated and tied updates, no-ops and nulls, over two runs of one query."""
    import random

    from haven.operators import history
    from haven.streaming import versions
    r, start = random.Random(1), dt.datetime(2024, 1, 1)
    rows = [(f"CU-{i:05d}", r.choice("cuud"), f"c{r.randrange(6)}", "e", r.choice(C.CASE_FIELDS), r.choice(["1", "0", "x", None]),
             start + dt.timedelta(minutes=i // 3 - r.randint(0, 9), microseconds=r.choice([0, 5]))) for i in range(400)]
    with versions.rocksdb_state(spark):
        for i, part in enumerate([rows[:200], rows[200:]]):
            sent = spark.createDataFrame(part + part[:20], C.CASE_UPDATES)
            jobs.publish(jobs.to_messages(sent).coalesce(1), f"{scratch}/landing-{i}")
            jobs.run_with_dead_letters(
                jobs.file_source(spark, f"{scratch}/landing-*"),
                lambda g: versions.client_versions(jobs.parse_topic(g, C.CASE_UPDATES, "case_updates")), f"{scratch}/out", scratch)
    out = spark.read.parquet(f"{scratch}/out").collect()
    key = lambda *x: tuple("" if v is None else v for v in x)
    got = sorted(key(x.client_id_hash, x.field_changed, x.new_value, x.prev_value, x.valid_from, x.event_id) for x in out)
    settled = max(x[6] for x in rows) - dt.timedelta(minutes=15)
    full = spark.createDataFrame(rows, C.CASE_UPDATES).withColumn("client_id_hash", F.sha2("client_id", 256))
    want = [x for x in history.client_changes(full).collect() if x.event_time < settled]
    assert got == sorted(key(x.client_id_hash, x.field_changed, x.new_value, x.prev_value, x.event_time, x.event_id) for x in want)
    base = full.select("client_id_hash").distinct().select(
        F.col("client_id_hash").alias("ClientID_hash"), *[F.lit("x").alias(c) for c in ("Gender", "Race", "Ethnicity")],
        F.lit(0).alias("VeteranStatus"), F.lit(1980).alias("YearOfBirth"))
    batch = {(x.client_id_hash, x.valid_from): (x.version, *(x[f] for f in C.CASE_FIELDS)) for x in history.scd2_history(base, full).collect()}
    assert out and all(batch[x.client_id_hash, x.valid_from] == (x.version, *(x[f] for f in C.CASE_FIELDS)) for x in out)


def test_a_clients_open_updates_are_read_once_a_watermark():
    """However many instants the watermark passes, the first timer settles them all; a batch's
    repeats of one instant and field reach the state once."""
    from types import SimpleNamespace

    from haven.streaming.versions import ClientVersions

    class State(dict):
        reads = writes = 0

        def containsKey(self, k):
            return k in self

        getValue, removeKey = dict.get, dict.pop

        def updateValue(self, k, v):
            self.writes += 1
            self[k] = v

        def iterator(self):
            self.reads += len(self)
            return iter(list(self.items()))

    class Number:
        n = None
        exists = lambda self: self.n is not None
        get = lambda self: self.n

        def update(self, n):
            self.n = n

    opened, last, timers = State(), State(), []
    states = iter([opened, last])
    p = ClientVersions()
    p.init(SimpleNamespace(getMapState=lambda *a: next(states), getValueState=lambda *a: Number(), registerTimer=timers.append))
    rows = [SimpleNamespace(op="u", at=i * 1000, field_changed="HousingStatus", event_id=f"{j}", new_value=f"{i}-{j}")
            for i in range(100) for j in range(3)]
    assert list(p.handleInputRows(("c",), iter(rows), None)) == []
    assert opened.writes == 100 and sorted(timers) == list(range(1, 101))
    out = []
    for ms in sorted(timers):
        out += p.handleExpiredTimer(("c",), SimpleNamespace(getCurrentWatermarkInMs=lambda: 1000),
                                    SimpleNamespace(getExpiryTimeInMs=lambda ms=ms: ms))
    assert opened.reads == 100 and not opened and last.writes == 1
    assert [(r.version, r.new_value) for r in out] == [(i + 2, f"{i}-2") for i in range(100)]
