"""Streaming queries: each publishes the fixture events as message files under
the shared folder, runs the stream to completion (availableNow) into a
checkpointed sink, and returns the sink as a reader sees it."""

from __future__ import annotations

from pyspark.sql import functions as F

from haven import contracts as C
from haven.operators.metrics import latest_value
from haven.plans.context import Ctx
from haven.plans.history import CHANGES_CTES
from haven.plans.kpis import ENVELOPE_SQL
from haven.plans.oracle_base import sql
from haven.plans.registry import query
from haven.session import job_dir
from haven.streaming import jobs, versions

_WM = "INTERVAL 15 MINUTE"
#: Files of one delivery in the live status query.
DELIVERY_FILES = 4
_ENVELOPE_DDL = C.ddl(C.EVENT_ENVELOPE)


# Junk deliveries mixed into the real events of every stream: malformed, scalar, array, bytes that are
# not UTF-8, and an object that is no event.
JUNK_HEX = ["7B226576656E745F6964223A2022", "3432", "5B312C325D", "7B226576656E745F6964223A2280227D"]
NO_EVENT = "7B2278223A20317D"


def _with_junk(spark, root: str, hexes: list[str] = [*JUNK_HEX, NO_EVENT]) -> None:
    junk = spark.createDataFrame([(h,) for h in hexes], "h string").select(F.unhex("h").cast("string").alias("value"))
    jobs.publish(junk.coalesce(1), f"{root}/landing-junk")


def _junk_is_kept(spark, root: str) -> None:
    """A message is in the result or among the dead letters; none may be lost."""
    n = jobs.dead_letters(spark, root).count()
    if n != len(JUNK_HEX) + 1:
        raise RuntimeError(f"{n} dead letters under {root}")


def _drained(spark, root: str, schema, topic: str, build, landing: str = "landing*"):
    """Run ``build`` over the parsed good messages under ``root``; bad ones become dead letters."""
    _with_junk(spark, root)
    jobs.run_with_dead_letters(jobs.file_source(spark, f"{root}/{landing}"),
                               lambda good: build(jobs.parse_topic(good, schema, topic)), f"{root}/out", root)
    _junk_is_kept(spark, root)
    return spark.read.parquet(f"{root}/out")


def _topic_bronze(spark, sf_dir, topic: str):
    ctx = Ctx(spark, sf_dir)
    root = job_dir(spark, f"stream-{topic}")
    jobs.publish(jobs.to_messages(getattr(ctx.raw, topic)), f"{root}/landing")
    _with_junk(spark, root)

    def parse(good):
        return jobs.parse_topic(good, C.TOPICS[topic], topic, watermark=None)

    # one pass over each micro-batch for both sinks
    handler = jobs.dead_letter_writer(f"{root}/bronze", f"{root}/dlq", parse, required="event_id")
    jobs.run_batches(jobs.file_source(spark, f"{root}/landing*"), handler, f"{root}/_chk")
    _junk_is_kept(spark, root)
    return spark.read.parquet(f"{root}/bronze").drop("_ingest_ts", "batch_id")


@query("stream_bed_bronze", sql(
    "SELECT event_id, event_type, project_id, bed_id, event_time, 'bed_events' AS _source_topic, "
    "sha256(client_id) AS client_id_hash FROM bed_events", "bed_events"))
def stream_bed_bronze(spark, sf_dir):
    return _topic_bronze(spark, sf_dir, "bed_events")


@query("stream_outreach_bronze", sql(
    "SELECT event_id, zone, encounter_type, needs, lat, lon, event_time, 'outreach' AS _source_topic, "
    "sha256(client_id) AS client_id_hash FROM outreach", "outreach"))
def stream_outreach_bronze(spark, sf_dir):
    return _topic_bronze(spark, sf_dir, "outreach")


@query("stream_case_bronze", sql(
    "SELECT event_id, op, enrollment_id, field_changed, new_value, event_time, 'case_updates' AS _source_topic, "
    "sha256(client_id) AS client_id_hash FROM case_updates", "case_updates"))
def stream_case_bronze(spark, sf_dir):
    return _topic_bronze(spark, sf_dir, "case_updates")


@query("stream_dedup_events", sql(
    "SELECT event_id, event_type, project_id, bed_id, event_time, 'bed_events' AS _source_topic, "
    "sha256(client_id) AS client_id_hash FROM bed_events", "bed_events"))
def stream_dedup_events(spark, sf_dir):
    """At-least-once delivery: every bed event arrives twice; the stream keeps one."""
    ctx = Ctx(spark, sf_dir)
    root = job_dir(spark, "stream-dedup")
    msgs = jobs.to_messages(ctx.raw.bed_events)
    jobs.publish(msgs, f"{root}/landing-first")
    jobs.publish(msgs, f"{root}/landing-redelivered")
    return _drained(spark, root, C.BED_EVENTS, "bed_events", jobs.dedupe_events).drop("_ingest_ts")


@query("incremental_file_ingest", sql(
    "SELECT event_id, event_type, project_id, bed_id, event_time, 'bed_events' AS _source_topic, "
    "sha256(client_id) AS client_id_hash FROM bed_events", "bed_events"))
def incremental_file_ingest(spark, sf_dir):
    """Files dropped in two deliveries; each run ingests only files it has not seen."""
    ev = Ctx(spark, sf_dir).raw.bed_events
    root = job_dir(spark, "file-ingest")
    mid = latest_value(ev, "event_time")
    first = ev.filter(F.col("event_time") < F.lit(mid) - F.expr("INTERVAL 15 DAYS"))
    rest = ev.filter(F.col("event_time") >= F.lit(mid) - F.expr("INTERVAL 15 DAYS"))
    _with_junk(spark, root)
    for i, part in enumerate([first, rest]):
        jobs.publish(jobs.to_messages(part), f"{root}/landing-drop{i}")
        jobs.run_with_dead_letters(
            jobs.file_source(spark, f"{root}/landing-*"),
            lambda good: jobs.parse_topic(good, C.BED_EVENTS, "bed_events", watermark=None), f"{root}/out", root)
    _junk_is_kept(spark, root)
    return spark.read.parquet(f"{root}/out").drop("_ingest_ts")


def _mixed_landing(spark, ctx: Ctx, root: str) -> None:
    r = ctx.raw
    msgs = (jobs.to_messages(r.bed_events, "bed_events")
            .unionByName(jobs.to_messages(r.outreach, "outreach"))
            .unionByName(jobs.to_messages(r.case_updates, "case_updates")))
    jobs.publish(msgs, f"{root}/landing/events")


@query("stream_union_events", sql(ENVELOPE_SQL, "bed_events", "outreach", "case_updates"))
def stream_union_events(spark, sf_dir):
    """All topics on one stream -> common envelope table partitioned by event date."""
    ctx = Ctx(spark, sf_dir)
    root = job_dir(spark, "stream-union")
    _mixed_landing(spark, ctx, root)

    def envelope(good):
        return jobs.envelope_by_topic(good).withColumn("event_date", F.to_date("event_time"))

    handler = jobs.dead_letter_writer(f"{root}/events", f"{root}/dlq", envelope)
    jobs.run_batches(jobs.file_source(spark, f"{root}/landing/*"), handler, f"{root}/_chk")
    return spark.read.schema(_ENVELOPE_DDL + ", event_date date, batch_id int").parquet(
        f"{root}/events").drop("event_date", "batch_id")


@query("event_dlq", sql(
    "SELECT event_id, 'ok' AS reason, 'main' AS sink FROM bed_events UNION ALL "
    "SELECT * FROM (VALUES (CAST(NULL AS VARCHAR), 'malformed_json', 'dlq'), (NULL, 'not_an_object', 'dlq'), "
    "(NULL, 'not_an_object', 'dlq'), (NULL, 'invalid_utf8', 'dlq')) t(event_id, reason, sink)", "bed_events"))
def event_dlq(spark, sf_dir):
    """Parse with a dead-letter side output; both outputs are kept."""
    ctx = Ctx(spark, sf_dir)
    root = job_dir(spark, "stream-dlq")
    jobs.publish(jobs.to_messages(ctx.raw.bed_events), f"{root}/landing/events")
    junk = spark.createDataFrame([(h,) for h in JUNK_HEX], "h string").select(
        F.unhex("h").cast("string").alias("value"))
    jobs.publish(junk, f"{root}/landing/junk")

    def parse(good):
        return good.select(F.from_json("value", C.BED_EVENTS, jobs.JSON_OPTS).alias("e")).select("e.*")

    handler = jobs.dead_letter_writer(f"{root}/main", f"{root}/dlq", parse)
    jobs.run_batches(jobs.file_source(spark, f"{root}/landing/*"), handler, f"{root}/_chk")
    main = spark.read.schema(C.ddl(C.BED_EVENTS) + ", batch_id int").parquet(f"{root}/main")
    dlq = spark.read.schema("raw binary, reason string, batch_id int").parquet(f"{root}/dlq")
    return (main.select("event_id", F.lit("ok").alias("reason"), F.lit("main").alias("sink"))
            .unionByName(dlq.select(F.lit(None).cast("string").alias("event_id"), "reason",
                                    F.lit("dlq").alias("sink"))))


@query("stream_hourly_checkins", sql(
    "SELECT project_id, time_bucket(INTERVAL 1 HOUR, event_time) AS window_start, "
    "time_bucket(INTERVAL 1 HOUR, event_time) + INTERVAL 1 HOUR AS window_end, count(*) AS n FROM bed_events "
    "WHERE event_type = 'CHECKIN' GROUP BY 1, 2 HAVING time_bucket(INTERVAL 1 HOUR, event_time) + INTERVAL 1 HOUR "
    f"<= (SELECT max(event_time) FROM bed_events) - {_WM}", "bed_events"))
def stream_hourly_checkins(spark, sf_dir):
    """Check-ins per project per hour; append mode emits only windows the
    watermark has closed."""
    ctx = Ctx(spark, sf_dir)
    root = job_dir(spark, "stream-hourly")
    jobs.publish(jobs.to_messages(ctx.raw.bed_events), f"{root}/landing")
    return _drained(spark, root, C.BED_EVENTS, "bed_events", lambda e: jobs.hourly_counts(e, "project_id", "CHECKIN"))


@query("stream_outreach_sliding", sql(
    "WITH w AS (SELECT zone, time_bucket(INTERVAL 15 MINUTE, event_time) - k * INTERVAL 15 MINUTE AS window_start "
    "FROM outreach, range(0, 8) r(k)) "
    "SELECT zone, window_start, window_start + INTERVAL 2 HOUR AS window_end, count(*) AS n_events FROM w "
    "GROUP BY 1, 2 HAVING window_start + INTERVAL 2 HOUR <= "
    f"(SELECT max(event_time) FROM outreach) - {_WM}", "outreach"))
def stream_outreach_sliding(spark, sf_dir):
    """Rolling 2-hour outreach activity per zone, sliding every 15 minutes."""
    ctx = Ctx(spark, sf_dir)
    root = job_dir(spark, "stream-sliding")
    jobs.publish(jobs.to_messages(ctx.raw.outreach), f"{root}/landing")
    return _drained(spark, root, C.OUTREACH, "outreach", lambda e: jobs.sliding_counts(e, "zone"))


@query("stream_enriched_checkins", sql(
    "SELECT e.event_id, sha256(e.client_id) AS client_id_hash, e.project_id, p.ProjectName AS project_name, "
    "p.ProjectType AS project_type, e.event_type, e.event_time FROM bed_events e "
    "LEFT JOIN silver_projects p ON e.project_id = p.ProjectID", "bed_events", "silver_projects"))
def stream_enriched_checkins(spark, sf_dir):
    """Stream-static join: each bed event enriched with its project."""
    ctx = Ctx(spark, sf_dir)
    root = job_dir(spark, "stream-enriched")
    jobs.publish(jobs.to_messages(ctx.raw.bed_events), f"{root}/landing")
    dim = ctx.silver_projects.select(F.col("ProjectID").alias("project_id"),
                                     F.col("ProjectName").alias("project_name"),
                                     F.col("ProjectType").alias("project_type"))
    return _drained(spark, root, C.BED_EVENTS, "bed_events", lambda e: e.join(dim, "project_id", "left").select(
        "event_id", "client_id_hash", "project_id", "project_name", "project_type", "event_type", "event_time"))


@query("stream_bed_status", sql(
    "SELECT project_id, bed_id, event_id AS last_event_id, event_type AS last_event_type, "
    "event_time AS last_event_time, event_type = 'CHECKIN' AS occupied FROM (SELECT *, row_number() "
    "OVER (PARTITION BY project_id, bed_id ORDER BY event_time DESC, event_id DESC) AS rn "
    "FROM bed_events) t WHERE rn = 1", "bed_events"))
def stream_bed_status(spark, sf_dir):
    """Live bed status: latest event per bed held in the state store (update
    mode), each micro-batch's changed beds upserted into a versioned status
    table.  Two deliveries; the final version equals the batch answer."""
    ev = Ctx(spark, sf_dir).raw.bed_events
    root = job_dir(spark, "stream-bed-status")
    mid = latest_value(ev, "event_time")
    cut = F.lit(mid) - F.expr("INTERVAL 15 DAYS")
    for i, part in enumerate([ev.filter(F.col("event_time") < cut), ev.filter(F.col("event_time") >= cut)]):
        jobs.publish(jobs.to_messages(part).coalesce(DELIVERY_FILES), f"{root}/landing-drop{i}")
    _with_junk(spark, root)
    # one trigger takes at most the first delivery's files: each delivery is a micro-batch of its own
    raw = jobs.file_source(spark, f"{root}/landing-*", max_files=DELIVERY_FILES)
    good, dead = jobs.split_dead_letters(raw, "value", "event_id")
    parsed = jobs.parse_topic(good, C.BED_EVENTS, "bed_events")
    letters = dead.select(F.col("value").cast("binary").alias("raw"), "reason")
    jobs.run_available_now(letters, f"{root}/dlq", f"{root}/_chk_dlq")
    _junk_is_kept(spark, root)
    q = (jobs.bed_status_updates(parsed).writeStream.outputMode("update")
         .foreachBatch(jobs.status_upsert_writer(f"{root}/status", ["project_id", "bed_id"]))
         .option("checkpointLocation", f"{root}/_chk").trigger(availableNow=True).start())
    jobs.finish(q)
    return jobs.latest_version(spark, f"{root}/status")


@query("stream_outreach_sessions", sql(
    "WITH k AS (SELECT sha256(client_id) AS h, event_time FROM outreach WHERE client_id IS NOT NULL), "
    "m AS (SELECT h, event_time, CASE WHEN lag(event_time) OVER (PARTITION BY h ORDER BY event_time) IS NULL "
    "OR event_time - lag(event_time) OVER (PARTITION BY h ORDER BY event_time) >= INTERVAL 30 MINUTE "
    "THEN 1 ELSE 0 END AS new_s FROM k), "
    "n AS (SELECT h, event_time, sum(new_s) OVER (PARTITION BY h ORDER BY event_time "
    "ROWS UNBOUNDED PRECEDING) AS sid FROM m), "
    "s AS (SELECT h AS client_id_hash, min(event_time) AS session_start, "
    "max(event_time) + INTERVAL 30 MINUTE AS session_end, count(*) AS n_events FROM n GROUP BY h, sid) "
    f"SELECT * FROM s WHERE session_end <= (SELECT max(event_time) FROM outreach) - {_WM}", "outreach"))
def stream_outreach_sessions(spark, sf_dir):
    """Contact sessions on the outreach stream (native session windows); append
    mode emits each session once the watermark has closed it."""
    from haven.operators.outreach import outreach_sessions_stream
    ctx = Ctx(spark, sf_dir)
    root = job_dir(spark, "stream-sessions")
    jobs.publish(jobs.to_messages(ctx.raw.outreach), f"{root}/landing")
    return _drained(spark, root, C.OUTREACH, "outreach", outreach_sessions_stream)


_F = C.CASE_FIELDS


@query("stream_client_versions", sql(
    f"WITH {CHANGES_CTES}, wide AS (SELECT h, t, " + ", ".join(f"max(CASE WHEN f = '{f}' THEN v END) AS {f}" for f in _F)
    + " FROM eff GROUP BY h, t), filled AS (SELECT h, t, CAST(1 + row_number() OVER (PARTITION BY h ORDER BY t) AS INTEGER) AS version, "
    + ", ".join(f"last_value({f} IGNORE NULLS) OVER (PARTITION BY h ORDER BY t ROWS UNBOUNDED PRECEDING) AS {f}" for f in _F)
    + " FROM wide) SELECT h AS client_id_hash, t AS valid_from, version, f AS field_changed, v AS new_value, pv AS prev_value, "
    "id AS event_id, " + ", ".join(_F) + " FROM eff JOIN filled USING (h, t) "
    f"WHERE t < (SELECT max(event_time) FROM case_updates) - {_WM}", "case_updates"))
def stream_client_versions(spark, sf_dir):
    """Client versions settled on the stream (state store with event-time timers),
    for every instant that the watermark has passed; two deliveries, so the second
    run restarts from the first one's state."""
    cu = Ctx(spark, sf_dir).raw.case_updates
    root = job_dir(spark, "stream-versions")
    _with_junk(spark, root)
    cut = F.lit(latest_value(cu, "event_time")) - F.expr("INTERVAL 15 DAYS")
    with versions.rocksdb_state(spark):
        for i, part in enumerate([cu.filter(F.col("event_time") < cut), cu.filter(F.col("event_time") >= cut)]):
            jobs.publish(jobs.to_messages(part), f"{root}/landing-drop{i}")
            jobs.run_with_dead_letters(
                jobs.file_source(spark, f"{root}/landing-*"),
                lambda good: versions.client_versions(jobs.parse_topic(good, C.CASE_UPDATES, "case_updates")), f"{root}/out", root)
    _junk_is_kept(spark, root)
    return spark.read.parquet(f"{root}/out")
