"""Bed, outreach, HUD APR, returns, equity and case-status queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from haven import contracts as C
from haven.functions.privacy import hash_and_drop_client
from haven.operators import beds, care, outreach
from haven.operators.metrics import latest_value
from haven.operators.nearest import nearest
from haven.plans.context import Ctx
from haven.plans.oracle_base import sql
from haven.plans.registry import query

_PERM = ", ".join(f"'{d}'" for d in C.PERMANENT_DESTINATIONS)

# --- beds -------------------------------------------------------------------------------

_STATUS_SQL = (
    "SELECT project_id, bed_id, event_id AS last_event_id, event_type AS last_event_type, "
    "event_time AS last_event_time, event_type = 'CHECKIN' AS occupied FROM (SELECT *, row_number() "
    "OVER (PARTITION BY project_id, bed_id ORDER BY event_time DESC, event_id DESC) AS rn "
    "FROM bed_events) t WHERE rn = 1")

_AVAIL_SQL = (
    "SELECT project_id, count(*) AS beds_seen, count_if(occupied) AS beds_occupied, "
    f"count(*) - count_if(occupied) AS beds_open FROM ({_STATUS_SQL}) s GROUP BY project_id")


def _availability(ctx: Ctx):
    return beds.bed_availability(beds.bed_status_current(ctx.raw.bed_events))


@query("bed_status_current", sql(_STATUS_SQL, "bed_events"))
def bed_status_current(spark, sf_dir):
    return beds.bed_status_current(Ctx(spark, sf_dir).raw.bed_events)


@query("bed_availability_by_project", sql(_AVAIL_SQL, "bed_events"))
def bed_availability_by_project(spark, sf_dir):
    return _availability(Ctx(spark, sf_dir))


@query("bed_utilization_hourly", sql(
    "WITH st AS (SELECT project_id, bed_id, event_type, event_time AS s, coalesce(lead(event_time) OVER "
    "(PARTITION BY project_id, bed_id ORDER BY event_time, event_id), "
    "(SELECT max(event_time) FROM bed_events)) AS e FROM bed_events), "
    "occ AS (SELECT project_id, hour, count(DISTINCT bed_id) AS occupied_beds FROM (SELECT project_id, "
    "bed_id, unnest(generate_series(date_trunc('hour', s), date_trunc('hour', e - INTERVAL 1 MICROSECOND), "
    "INTERVAL 1 HOUR)) AS hour FROM st WHERE event_type = 'CHECKIN' AND e > s) x GROUP BY project_id, hour), "
    "seen AS (SELECT project_id, count(DISTINCT bed_id) AS beds_seen FROM bed_events GROUP BY project_id) "
    "SELECT o.project_id, o.hour, o.occupied_beds, s.beds_seen, "
    "round(o.occupied_beds / s.beds_seen, 6) AS utilization FROM occ o JOIN seen s ON o.project_id = s.project_id",
    "bed_events"))
def bed_utilization_hourly(spark, sf_dir):
    ev = Ctx(spark, sf_dir).raw.bed_events
    return beds.bed_utilization_hourly(ev, latest_value(ev, "event_time"))


@query("nearest_open_bed", sql(
    "WITH z AS (SELECT zone, avg(lat) AS lat, avg(lon) AS lon FROM outreach GROUP BY zone), "
    f"av AS ({_AVAIL_SQL}), "
    "c AS (SELECT a.project_id, a.beds_open, p.Latitude AS lat, p.Longitude AS lon FROM av a "
    "JOIN silver_projects p ON a.project_id = p.ProjectID WHERE a.beds_open > 0), "
    "d AS (SELECT z.zone, c.project_id, c.beds_open, 2 * 6371.0088 * asin(sqrt(pow(sin(radians(c.lat - z.lat) / 2), 2) "
    "+ cos(radians(z.lat)) * cos(radians(c.lat)) * pow(sin(radians(c.lon - z.lon) / 2), 2))) AS dist FROM z CROSS JOIN c) "
    "SELECT zone, CAST(rk AS INTEGER) AS rank, project_id, round(dist, 6) AS distance_km, beds_open FROM "
    "(SELECT *, row_number() OVER (PARTITION BY zone ORDER BY dist, project_id) AS rk FROM d) t WHERE rk <= 3",
    "outreach", "bed_events", "silver_projects"))
def nearest_open_bed(spark, sf_dir):
    """3 nearest projects with an open bed from each outreach zone's centre.

    Exact search down a tree of cells (no cross join); the oracle checks it by brute force.
    """
    ctx = Ctx(spark, sf_dir)
    zones = (ctx.raw.outreach.groupBy("zone")
             .agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
             .withColumnRenamed("zone", "pid"))
    p = ctx.silver_projects.select("ProjectID", F.col("Latitude").alias("lat"),
                                   F.col("Longitude").alias("lon"))
    cands = (_availability(ctx).filter(F.col("beds_open") > 0)
             .join(p, F.col("project_id") == F.col("ProjectID"), "inner")
             .select(F.col("project_id").alias("cid"), "lat", "lon", "beds_open"))
    return (nearest(zones, cands)
            .select(F.col("pid").alias("zone"), "rank", F.col("cid").alias("project_id"),
                    "distance_km", "beds_open"))


# --- outreach ------------------------------------------------------------------------------

@query("underserved_zones_hourly", sql(
    "WITH g AS (SELECT z.zone, h.hour FROM (SELECT DISTINCT zone FROM outreach) z, "
    "(SELECT unnest(generate_series(date_trunc('hour', min(event_time)), date_trunc('hour', max(event_time)), "
    "INTERVAL 1 HOUR)) AS hour FROM outreach) h), "
    "c AS (SELECT zone, date_trunc('hour', event_time) AS hour, count(DISTINCT event_id) AS n FROM outreach "
    "GROUP BY 1, 2) "
    "SELECT g.zone, g.hour, coalesce(c.n, 0) AS n_events, CAST(rank() OVER (PARTITION BY g.hour "
    "ORDER BY coalesce(c.n, 0), g.zone) AS INTEGER) AS underserved_rank FROM g LEFT JOIN c "
    "ON g.zone = c.zone AND g.hour = c.hour", "outreach"))
def underserved_zones_hourly(spark, sf_dir):
    o = Ctx(spark, sf_dir).raw.outreach
    b = o.agg(F.date_trunc("hour", F.min("event_time")), F.date_trunc("hour", F.max("event_time"))).first()
    return outreach.underserved_zones_hourly(o, b[0], b[1])


@query("outreach_sessions", sql(
    "WITH k AS (SELECT sha256(client_id) AS h, event_time FROM outreach WHERE client_id IS NOT NULL), "
    "m AS (SELECT h, event_time, CASE WHEN lag(event_time) OVER (PARTITION BY h ORDER BY event_time) IS NULL "
    "OR event_time - lag(event_time) OVER (PARTITION BY h ORDER BY event_time) >= INTERVAL 30 MINUTE "
    "THEN 1 ELSE 0 END AS new_s FROM k), "
    "n AS (SELECT h, event_time, sum(new_s) OVER (PARTITION BY h ORDER BY event_time "
    "ROWS UNBOUNDED PRECEDING) AS sid FROM m) "
    "SELECT h AS client_id_hash, min(event_time) AS session_start, "
    "max(event_time) + INTERVAL 30 MINUTE AS session_end, count(*) AS n_events FROM n GROUP BY h, sid",
    "outreach"))
def outreach_sessions(spark, sf_dir):
    return outreach.outreach_sessions(Ctx(spark, sf_dir).raw.outreach)


@query("chronic_encounters", sql(
    "WITH d AS (SELECT DISTINCT sha256(client_id) AS h, CAST(event_time AS DATE) AS day FROM outreach "
    "WHERE client_id IS NOT NULL), "
    "w AS (SELECT h, day, count(*) OVER (PARTITION BY h ORDER BY CAST(day - DATE '1970-01-01' AS INT) "
    "RANGE BETWEEN 29 PRECEDING AND CURRENT ROW) AS cw FROM d) "
    "SELECT h AS client_id_hash, count(*) AS n_days, max(cw) AS max_days_in_window, min(day) AS first_day, "
    "max(day) AS last_day FROM w GROUP BY h HAVING max(cw) >= 4", "outreach"))
def chronic_encounters(spark, sf_dir):
    return outreach.chronic_encounters(Ctx(spark, sf_dir).raw.outreach)


@query("client_seen_before", sql(
    "SELECT o.event_id, o.h AS client_id_hash, f.first_service_date, "
    "coalesce(f.first_service_date <= CAST(o.event_time AS DATE), false) AS seen_before FROM "
    "(SELECT event_id, sha256(client_id) AS h, event_time FROM outreach WHERE client_id IS NOT NULL) o "
    "LEFT JOIN (SELECT client_id_hash, min(service_date) AS first_service_date FROM fact GROUP BY 1) f "
    "ON o.h = f.client_id_hash", "outreach", "fact"))
def client_seen_before(spark, sf_dir):
    """Has the client met at this outreach contact been served before?"""
    ctx = Ctx(spark, sf_dir)
    enc = outreach.known_clients(ctx.raw.outreach)
    return care.client_seen_before(enc, ctx.fact)


# --- case updates ----------------------------------------------------------------------------

def _case(ctx: Ctx):
    return hash_and_drop_client(ctx.raw.case_updates)


_PIVOT = ", ".join(f"max(CASE WHEN field_changed = '{f}' AND rn = 1 THEN new_value END) AS {f}"
                   for f in C.CASE_FIELDS)


@query("client_case_status", sql(
    f"SELECT h AS client_id_hash, {_PIVOT}, max(event_time) AS last_update, count(*) AS n_updates FROM "
    "(SELECT sha256(client_id) AS h, field_changed, new_value, event_time, row_number() OVER "
    "(PARTITION BY client_id, field_changed ORDER BY event_time DESC, event_id DESC) AS rn FROM case_updates) t "
    "GROUP BY h", "case_updates"))
def client_case_status(spark, sf_dir):
    return care.client_case_status(_case(Ctx(spark, sf_dir)))


@query("case_update_activity", sql(
    "SELECT CAST(event_time AS DATE) AS event_date, field_changed, op, count(*) AS n_updates, "
    "count(DISTINCT sha256(client_id)) AS n_clients FROM case_updates GROUP BY 1, 2, 3", "case_updates"))
def case_update_activity(spark, sf_dir):
    return care.case_update_activity(_case(Ctx(spark, sf_dir)))


# --- dimensions ------------------------------------------------------------------------------

@query("dim_agency", sql(
    "SELECT OrganizationID AS organization_id, count(*) AS n_projects, "
    "min(OperatingStartDate) AS first_operating_date FROM silver_projects GROUP BY 1", "silver_projects"))
def dim_agency(spark, sf_dir):
    return care.dim_agency(Ctx(spark, sf_dir).silver_projects)


@query("dim_geography", sql(
    "SELECT CAST(floor(Latitude / 0.05) AS BIGINT) AS cell_lat, CAST(floor(Longitude / 0.05) AS BIGINT) "
    "AS cell_lon, count(*) AS n_projects, round(avg(Latitude), 6) AS center_lat, "
    "round(avg(Longitude), 6) AS center_lon FROM silver_projects GROUP BY 1, 2", "silver_projects"))
def dim_geography(spark, sf_dir):
    return care.dim_geography(Ctx(spark, sf_dir).silver_projects)


# --- HUD APR -----------------------------------------------------------------------------------

@query("apr_entries_exits", sql(
    "WITH e AS (SELECT EntryDate, ExitDate FROM silver_enrollments), "
    "g AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', min(EntryDate)) AS DATE), "
    "CAST(date_trunc('month', greatest(max(EntryDate), max(ExitDate))) AS DATE), INTERVAL 1 MONTH)) AS DATE) "
    "AS month FROM e), "
    "i AS (SELECT CAST(date_trunc('month', EntryDate) AS DATE) AS m, count(*) AS n FROM e GROUP BY 1), "
    "o AS (SELECT CAST(date_trunc('month', ExitDate) AS DATE) AS m, count(*) AS n FROM e "
    "WHERE ExitDate IS NOT NULL GROUP BY 1) "
    "SELECT g.month, coalesce(i.n, 0) AS entries, coalesce(o.n, 0) AS exits, "
    "CAST(sum(coalesce(i.n, 0)) OVER (ORDER BY g.month) - sum(coalesce(o.n, 0)) OVER (ORDER BY g.month) "
    "AS BIGINT) AS active_at_month_end FROM g LEFT JOIN i ON g.month = i.m LEFT JOIN o ON g.month = o.m",
    "silver_enrollments"))
def apr_entries_exits(spark, sf_dir):
    return care.apr_entries_exits(Ctx(spark, sf_dir).silver_enrollments)


APR_PERIOD_DAYS = 365


@query("apr_exits_by_destination", sql(
    "SELECT project_type, destination, count(*) AS n_exits, "
    "CAST(grouping(project_type, destination) AS INTEGER) AS grouping_level FROM "
    "(SELECT p.ProjectType AS project_type, e.Destination AS destination FROM silver_enrollments e "
    "LEFT JOIN silver_projects p ON e.ProjectID = p.ProjectID WHERE e.ExitDate BETWEEN "
    f"CAST((SELECT max(ExitDate) FROM silver_enrollments) - INTERVAL {APR_PERIOD_DAYS - 1} DAY AS DATE) "
    "AND (SELECT max(ExitDate) FROM silver_enrollments)) t GROUP BY ROLLUP (project_type, destination)",
    "silver_enrollments", "silver_projects"))
def apr_exits_by_destination(spark, sf_dir):
    """Exits in the reporting year ending at the last exit, stacked by destination."""
    ctx = Ctx(spark, sf_dir)
    end = latest_value(ctx.silver_enrollments, "ExitDate")
    start = end - dt.timedelta(days=APR_PERIOD_DAYS - 1)
    return care.apr_exits_by_destination(ctx.silver_enrollments, ctx.silver_projects, start, end)


@query("apr_stay_length", sql(
    "WITH a AS (SELECT greatest(max(EntryDate), max(ExitDate)) AS t FROM silver_enrollments) "
    "SELECT p.ProjectType AS project_type, count(*) AS n_enrollments, "
    "round(avg(CAST(coalesce(e.ExitDate, (SELECT t FROM a)) - e.EntryDate AS INT)), 6) AS avg_stay_days, "
    "max(CAST(coalesce(e.ExitDate, (SELECT t FROM a)) - e.EntryDate AS INT)) AS max_stay_days "
    "FROM silver_enrollments e LEFT JOIN silver_projects p ON e.ProjectID = p.ProjectID GROUP BY 1",
    "silver_enrollments", "silver_projects"))
def apr_stay_length(spark, sf_dir):
    ctx = Ctx(spark, sf_dir)
    e = ctx.silver_enrollments
    b = e.agg(F.greatest(F.max("EntryDate"), F.max("ExitDate"))).first()[0]
    return care.apr_stay_length(e, ctx.silver_projects, b)


# --- returns ---------------------------------------------------------------------------------

@query("returns_180d_gap", sql(
    "SELECT client_id_hash, count(*) AS n_gaps, min(service_date) AS first_return_date, "
    "max(gap) AS longest_gap_days FROM (SELECT client_id_hash, service_date, CAST(service_date - "
    "lag(service_date) OVER (PARTITION BY client_id_hash ORDER BY service_date) AS INT) AS gap FROM "
    "(SELECT DISTINCT client_id_hash, service_date FROM fact WHERE service_date IS NOT NULL) d) t "
    "WHERE gap > 180 GROUP BY 1", "fact"))
def returns_180d_gap(spark, sf_dir):
    return care.returns_gap(Ctx(spark, sf_dir).fact)


@query("returns_180d_any", sql(
    "SELECT client_id_hash, min(service_date) AS first_date, max(service_date) AS last_date, "
    "CAST(max(service_date) - min(service_date) AS INT) AS span_days FROM fact "
    "WHERE service_date IS NOT NULL GROUP BY 1 HAVING CAST(max(service_date) - min(service_date) AS INT) > 180",
    "fact"))
def returns_180d_any(spark, sf_dir):
    return care.returns_any(Ctx(spark, sf_dir).fact)


@query("returns_after_ph_exit", sql(
    "SELECT x.h AS client_id_hash, x.d AS exit_date, x.nxt AS next_entry_date, "
    "CAST(x.nxt - x.d AS INT) AS days_to_return, coalesce(CAST(x.nxt - x.d AS INT) <= 180, false) AS returned "
    "FROM (SELECT h, d, (SELECT min(e.EntryDate) FROM silver_enrollments e WHERE e.PersonalID_hash = y.h "
    "AND e.EntryDate > y.d) AS nxt FROM (SELECT DISTINCT PersonalID_hash AS h, ExitDate AS d "
    f"FROM silver_enrollments WHERE Destination IN ({_PERM}) AND ExitDate IS NOT NULL) y) x",
    "silver_enrollments"))
def returns_after_ph_exit(spark, sf_dir):
    return care.returns_after_ph_exit(Ctx(spark, sf_dir).silver_enrollments)


# --- equity, clinic wait ---------------------------------------------------------------------------

_EQ_DIMS = [("veteran_status", "CAST(VeteranStatus AS VARCHAR)"), ("race", "Race"), ("gender", "Gender")]


@query("equity_disparity", sql(
    "WITH pc AS (SELECT client_id_hash, sum(qty) AS qty FROM fact GROUP BY client_id_hash), "
    "j AS (SELECT pc.qty, " + ", ".join(f"{e} AS {d}" for d, e in _EQ_DIMS) + " FROM pc JOIN silver_clients c "
    "ON pc.client_id_hash = c.ClientID_hash), "
    "g AS (" + " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {d} AS value, count(*) AS n_clients, CAST(sum(qty) AS BIGINT) AS total_qty "
        f"FROM j GROUP BY {d}" for d, _ in _EQ_DIMS) + "), "
    "t AS (SELECT count(*) AS tc, sum(qty) AS tq FROM j) "
    "SELECT dimension, value, n_clients, total_qty, round(n_clients / tc, 6) AS share_clients, "
    "round(total_qty / tq, 6) AS share_qty, round((total_qty / tq) / (n_clients / tc), 6) AS ratio, "
    "((total_qty / tq) / (n_clients / tc) < 0.8 OR (total_qty / tq) / (n_clients / tc) > 1.25) "
    "AS disparity_flag FROM g, t", "fact", "silver_clients"))
def equity_disparity(spark, sf_dir):
    ctx = Ctx(spark, sf_dir)
    return care.equity_disparity(ctx.fact, ctx.silver_clients)


@query("clinic_wait_proxy", sql(
    "SELECT e.ProjectID AS project_id, count(v.first_visit) AS n_with_visit, "
    "count_if(v.first_visit IS NULL) AS n_without_visit, "
    "round(avg(CAST(v.first_visit - e.EntryDate AS INT)), 6) AS avg_wait_days_proxy FROM silver_enrollments e "
    "LEFT JOIN (SELECT s.EnrollmentID, min(s.DateProvided) AS first_visit FROM silver_services s "
    "JOIN silver_enrollments x ON s.EnrollmentID = x.EnrollmentID WHERE s.ServiceType = 'Clinic visit' "
    "AND s.DateProvided >= x.EntryDate GROUP BY s.EnrollmentID) v ON e.EnrollmentID = v.EnrollmentID "
    "GROUP BY e.ProjectID", "silver_enrollments", "silver_services"))
def clinic_wait_proxy(spark, sf_dir):
    ctx = Ctx(spark, sf_dir)
    return care.clinic_wait_proxy(ctx.silver_services, ctx.silver_enrollments)
