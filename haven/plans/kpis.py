"""KPI, service-mix and outreach-aggregate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from haven.operators import envelope, metrics
from haven.plans.context import Ctx
from haven.plans.oracle_base import sql
from haven.plans.registry import query

_RECENT = ("event_time > (SELECT max(event_time) FROM outreach) - INTERVAL 2 HOUR "
           "AND event_time <= (SELECT max(event_time) FROM outreach)")


def _recent_outreach(ctx: Ctx):
    o = ctx.raw.outreach
    return metrics.recent(o, metrics.latest_value(o, "event_time"))


@query("service_mix_qty", sql(
    "SELECT service_type, CAST(sum(qty) AS BIGINT) AS total_qty FROM fact GROUP BY service_type",
    "fact"))
def service_mix_qty(spark, sf_dir):
    return metrics.service_mix_qty(Ctx(spark, sf_dir).fact)


@query("service_mix_counts", sql(
    "SELECT service_type, count(*) AS n_services FROM fact WHERE service_type IS NOT NULL "
    "GROUP BY service_type ORDER BY n_services DESC, service_type", "fact"))
def service_mix_counts(spark, sf_dir):
    return metrics.service_mix_counts(Ctx(spark, sf_dir).fact)


@query("fa_total", sql(
    "SELECT CAST(sum(financial_assistance) AS DECIMAL(18,2)) AS total_fa, count(*) AS n_services "
    "FROM fact", "fact"))
def fa_total(spark, sf_dir):
    return metrics.fa_total(Ctx(spark, sf_dir).fact)


@query("services_daily", sql(
    "SELECT service_date, service_type, count(*) AS n_services, "
    "CAST(sum(financial_assistance) AS DECIMAL(18,2)) AS total_fa FROM fact "
    "GROUP BY service_date, service_type", "fact"))
def services_daily(spark, sf_dir):
    return metrics.services_daily(Ctx(spark, sf_dir).fact)


@query("daily_volume_by_type", sql(
    "SELECT service_date, project_type, count(*) AS n_services, CAST(sum(qty) AS BIGINT) AS total_qty "
    "FROM fact GROUP BY service_date, project_type", "fact"))
def daily_volume_by_type(spark, sf_dir):
    return metrics.daily_volume_by_type(Ctx(spark, sf_dir).fact)


@query("length_of_stay_days", sql(
    "SELECT round(avg(days), 6) AS avg_length_of_stay_days, count(*) AS n_enrollments FROM "
    "(SELECT enrollment_id, CAST(max(service_date) - min(service_date) AS INT) AS days FROM fact "
    "WHERE service_date IS NOT NULL GROUP BY enrollment_id) t", "fact"))
def length_of_stay_days(spark, sf_dir):
    return metrics.length_of_stay_days(Ctx(spark, sf_dir).fact)


@query("first_service_per_client", sql(
    "SELECT *, min(service_date) OVER (PARTITION BY client_id_hash) AS first_service_date FROM fact",
    "fact"))
def first_service_per_client(spark, sf_dir):
    return metrics.first_service_per_client(Ctx(spark, sf_dir).fact)


@query("services_on_day", sql(
    "SELECT * FROM fact WHERE service_date = (SELECT max(service_date) FROM fact)", "fact"))
def services_on_day(spark, sf_dir):
    """Services delivered on the data's own 'today' (its latest service date)."""
    ctx = Ctx(spark, sf_dir)
    today = ctx.last_service_date()
    return ctx.fact_within(service_date=(today, today))


@query("ops_kpis", sql(
    "SELECT count(*) FILTER (WHERE service_date = (SELECT max(service_date) FROM fact)) "
    "AS services_today, count(DISTINCT client_id_hash) AS active_clients, "
    "count(DISTINCT project_id) AS active_projects, count(*) AS n_services, "
    f"(SELECT count(*) FROM outreach WHERE {_RECENT}) AS outreach_2h FROM fact",
    "fact", "outreach"))
def ops_kpis(spark, sf_dir):
    ctx = Ctx(spark, sf_dir)
    f, o = ctx.fact, ctx.raw.outreach
    return metrics.ops_kpis(f, o, metrics.latest_value(f, "service_date"),
                            metrics.latest_value(o, "event_time"))


@query("outreach_recent", sql(f"SELECT * FROM outreach WHERE {_RECENT}", "outreach"))
def outreach_recent(spark, sf_dir):
    return _recent_outreach(Ctx(spark, sf_dir))


@query("outreach_center", sql(
    "SELECT round(avg(lat), 6) AS center_lat, round(avg(lon), 6) AS center_lon, "
    f"count(*) AS n_points FROM outreach WHERE {_RECENT}", "outreach"))
def outreach_center(spark, sf_dir):
    return metrics.outreach_center(_recent_outreach(Ctx(spark, sf_dir)))


@query("outreach_hotspots", sql(
    "SELECT CAST(floor(lat / 0.01) AS BIGINT) AS cell_lat, CAST(floor(lon / 0.01) AS BIGINT) AS cell_lon, "
    "count(*) AS n_events, round(avg(lat), 6) AS mean_lat, round(avg(lon), 6) AS mean_lon "
    f"FROM outreach WHERE {_RECENT} GROUP BY 1, 2", "outreach"))
def outreach_hotspots(spark, sf_dir):
    return metrics.outreach_hotspots(_recent_outreach(Ctx(spark, sf_dir)))


@query("outreach_needs_mix", sql(
    "SELECT need, count(*) AS n_encounters FROM (SELECT unnest(CAST(needs AS JSON)::VARCHAR[]) AS need "
    "FROM outreach) t GROUP BY need", "outreach"))
def outreach_needs_mix(spark, sf_dir):
    return metrics.outreach_needs_mix(Ctx(spark, sf_dir).raw.outreach)


ENVELOPE_SQL = (
    "SELECT event_id, coalesce(nullif(event_type, ''), NULL) AS event_type, sha256(client_id) AS client_id_hash, "
    "project_id, event_time, to_json({'event_id': event_id, 'event_type': event_type, 'project_id': project_id, "
    "'bed_id': bed_id, 'event_time': strftime(event_time, '%Y-%m-%d %H:%M:%S.%f')}) AS payload FROM bed_events "
    "UNION ALL SELECT event_id, coalesce(nullif(encounter_type, ''), NULL), sha256(client_id), NULL, event_time, "
    "to_json({'event_id': event_id, 'zone': zone, 'encounter_type': encounter_type, 'needs': needs, "
    "'lat': CAST(lat AS VARCHAR), 'lon': CAST(lon AS VARCHAR), "
    "'event_time': strftime(event_time, '%Y-%m-%d %H:%M:%S.%f')}) FROM outreach "
    "UNION ALL SELECT event_id, NULL, sha256(client_id), NULL, event_time, "
    "to_json({'event_id': event_id, 'op': op, 'enrollment_id': enrollment_id, "
    "'field_changed': field_changed, 'new_value': new_value, "
    "'event_time': strftime(event_time, '%Y-%m-%d %H:%M:%S.%f')}) FROM case_updates")


def _envelope(ctx: Ctx):
    r = ctx.raw
    return envelope.union_envelopes(r.bed_events, r.outreach, r.case_updates)


@query("union_event_envelope", sql(ENVELOPE_SQL, "bed_events", "outreach", "case_updates"))
def union_event_envelope(spark, sf_dir):
    return _envelope(Ctx(spark, sf_dir))


@query("daily_event_counts", sql(
    f"SELECT CAST(event_time AS DATE) AS service_date, project_id, event_type, count(*) AS n "
    f"FROM ({ENVELOPE_SQL}) e GROUP BY 1, 2, 3", "bed_events", "outreach", "case_updates"))
def daily_event_counts(spark, sf_dir):
    """The curated view over the raw event table, registered as a temp view."""
    _envelope(Ctx(spark, sf_dir)).createOrReplaceTempView("hmis_raw_events")
    return spark.sql(
        "SELECT to_date(event_time) AS service_date, project_id, event_type, count(*) AS n "
        "FROM hmis_raw_events GROUP BY ALL")


@query("scalar_function_panel", sql(
    "SELECT EnrollmentID AS enrollment_id, sha256(EnrollmentID) AS id_hash, "
    "regexp_full_match(sha256(EnrollmentID), '^[a-f0-9]{64}$') AS hash_ok, "
    "CAST(strftime(EntryDate, '%Y%m%d') AS INT) AS entry_key, CAST(year(EntryDate) AS INT) AS entry_year, "
    "CAST(quarter(EntryDate) AS INT) AS entry_quarter, CAST(month(EntryDate) AS INT) AS entry_month, "
    "CAST(day(EntryDate) AS INT) AS entry_day, CAST(ExitDate - EntryDate AS INT) AS stay_days, "
    "CAST(EntryDate + INTERVAL 180 DAY AS DATE) AS return_horizon, "
    "left(EnrollmentID, 4) || '...' AS id_token, "
    "abs(CAST(ExitDate - EntryDate AS INT) - 90) AS stay_dev, greatest(DisablingCondition, 1) AS dc_floor, "
    "Destination IN ('Permanent housing', 'Rental with subsidy') AS permanent_exit, "
    "DisablingCondition BETWEEN 0 AND 1 AS dc_valid, ExitDate IS NULL AS still_enrolled "
    "FROM enrollments", "enrollments"))
def scalar_function_panel(spark, sf_dir):
    """One row per enrollment exercising the scalar functions the pipeline uses."""
    e = Ctx(spark, sf_dir).raw.enrollments
    stay = F.datediff("ExitDate", "EntryDate")
    h = F.sha2("EnrollmentID", 256)
    return e.select(
        F.col("EnrollmentID").alias("enrollment_id"),
        h.alias("id_hash"),
        h.rlike("^[a-f0-9]{64}$").alias("hash_ok"),
        F.date_format("EntryDate", "yyyyMMdd").cast("int").alias("entry_key"),
        F.year("EntryDate").alias("entry_year"), F.quarter("EntryDate").alias("entry_quarter"),
        F.month("EntryDate").alias("entry_month"), F.dayofmonth("EntryDate").alias("entry_day"),
        stay.alias("stay_days"),
        F.date_add("EntryDate", 180).alias("return_horizon"),
        F.concat(F.left("EnrollmentID", F.lit(4)), F.lit("...")).alias("id_token"),
        F.abs(stay - 90).alias("stay_dev"),
        F.greatest("DisablingCondition", F.lit(1)).alias("dc_floor"),
        F.col("Destination").isin("Permanent housing", "Rental with subsidy").alias("permanent_exit"),
        F.col("DisablingCondition").between(0, 1).alias("dc_valid"),
        F.col("ExitDate").isNull().alias("still_enrolled"),
    )


@query("rows_per_file")
def rows_per_file(spark, sf_dir):
    """Row count per source file of the service source (footer-level reconcile)."""
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return (li.select(F.col("_metadata.file_path").alias("file_path"))
            .groupBy("file_path").agg(F.count(F.lit(1)).alias("n_rows")))

