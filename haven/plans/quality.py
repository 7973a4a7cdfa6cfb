"""Quality, reconciliation, masking and row-access queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from haven import contracts as C
from haven.functions.privacy import hash_id, packed, unpacked
from haven.operators import governance, hashtree, quality, star
from haven.operators.daily_state import DISTINCT_ERROR, DailyState, report
from haven.plans.context import Ctx
from haven.plans.oracle_base import sql
from haven.plans.registry import query
from haven.session import job_dir

_HEX = "'^[a-f0-9]{64}$'"


def _suite_sql(table: str, src: str, rules: list[tuple[str, str, str]]) -> str:
    """UNION ALL of one row per rule; each rule is (name, column, n_bad SQL)."""
    parts = []
    for name, col, bad in rules:
        parts.append(f"SELECT '{table}' AS table_name, count(*) AS n_rows, '{name}' AS rule, "
                     f"'{col}' AS column_name, CAST({bad} AS BIGINT) AS n_bad, "
                     f"CAST({bad} AS BIGINT) = 0 AS passed FROM {src}")
    return " UNION ALL ".join(parts)


_FACT_SUITE = _suite_sql("fact_service_event", "fact", [
    ("not_null", "service_id", "count_if(service_id IS NULL)"),
    ("unique", "service_id", "count(service_id) - count(DISTINCT service_id)"),
    ("not_null", "service_date", "count_if(service_date IS NULL)"),
    ("not_null", "client_id_hash", "count_if(client_id_hash IS NULL)"),
    ("not_null", "project_id", "count_if(project_id IS NULL)"),
    ("between", "qty", "count_if(qty IS NOT NULL AND NOT qty BETWEEN 1 AND 100)"),
    ("between", "financial_assistance",
     "count_if(financial_assistance IS NOT NULL AND NOT financial_assistance BETWEEN 0 AND 100000)"),
    ("match_regex", "client_id_hash",
     f"count_if(client_id_hash IS NOT NULL AND NOT regexp_matches(client_id_hash, {_HEX}))"),
])

_CLIENT_SUITE = _suite_sql("silver_clients", "silver_clients", [
    ("not_null", "ClientID_hash", "count_if(ClientID_hash IS NULL)"),
    ("unique", "ClientID_hash", "count(ClientID_hash) - count(DISTINCT ClientID_hash)"),
    ("match_regex", "ClientID_hash",
     f"count_if(ClientID_hash IS NOT NULL AND NOT regexp_matches(ClientID_hash, {_HEX}))"),
    ("not_null", "SSN_hash", "count_if(SSN_hash IS NULL)"),
    ("match_regex", "SSN_hash", f"count_if(SSN_hash IS NOT NULL AND NOT regexp_matches(SSN_hash, {_HEX}))"),
    ("in_set", "VeteranStatus", "count_if(VeteranStatus IS NOT NULL AND VeteranStatus NOT IN (0, 1))"),
])


@query("dq_fact_suite", sql(_FACT_SUITE, "fact"))
def dq_fact_suite(spark, sf_dir):
    return quality.run_suite(Ctx(spark, sf_dir).fact, "fact_service_event", quality.fact_rules())


@query("dq_clients_suite", sql(_CLIENT_SUITE, "silver_clients"))
def dq_clients_suite(spark, sf_dir):
    return quality.run_suite(Ctx(spark, sf_dir).silver_clients, "silver_clients", quality.client_rules())


@query("dq_fk_violations", sql(
    "SELECT 'fact.project_id->dim_project' AS fk_name, f.project_id AS key_value, count(*) AS n_rows "
    "FROM fact f WHERE f.project_id IS NOT NULL AND f.project_id NOT IN (SELECT ProjectID FROM silver_projects) "
    "GROUP BY f.project_id UNION ALL "
    "SELECT 'services.enrollment_id->enrollments', s.EnrollmentID, count(*) FROM silver_services s "
    "WHERE s.EnrollmentID IS NOT NULL AND s.EnrollmentID NOT IN (SELECT EnrollmentID FROM silver_enrollments) "
    "GROUP BY s.EnrollmentID", "fact", "silver_services", "silver_enrollments", "silver_projects"))
def dq_fk_violations(spark, sf_dir):
    ctx = Ctx(spark, sf_dir)
    return quality.fk_violations(ctx.fact, "project_id", ctx.silver_projects, "ProjectID",
                                 "fact.project_id->dim_project").unionByName(
        quality.fk_violations(ctx.silver_services, "EnrollmentID", ctx.silver_enrollments,
                              "EnrollmentID", "services.enrollment_id->enrollments"))


@query("dq_uniqueness", sql(
    "SELECT 'bronze_services' AS table_name, ServiceID AS key_value, count(*) AS n_copies FROM services "
    "GROUP BY ServiceID HAVING count(*) > 1 UNION ALL "
    "SELECT 'fact_service_event', service_id, count(*) FROM fact GROUP BY service_id HAVING count(*) > 1",
    "services", "fact"))
def dq_uniqueness(spark, sf_dir):
    ctx = Ctx(spark, sf_dir)
    return quality.duplicate_keys(ctx.raw.services, "ServiceID", "bronze_services").unionByName(
        quality.duplicate_keys(ctx.fact, "service_id", "fact_service_event"))


_PII_TABLES = [
    ("bronze_clients", "clients", ["ClientID", "FirstName", "LastName", "SSN", "Gender", "Race",
                                   "Ethnicity", "PersonalEmail"]),
    ("silver_clients", "silver_clients", ["ClientID_hash", "SSN_hash", "Name_hash", "Gender", "Race",
                                          "Ethnicity"]),
    ("silver_enrollments", "silver_enrollments", ["EnrollmentID", "ProjectID", "Destination",
                                                  "LivingSituation", "RelationshipToHoH",
                                                  "PersonalID_hash"]),
    ("silver_services", "silver_services", ["ServiceID", "EnrollmentID", "ServiceType",
                                            "PersonalID_hash"]),
    ("fact_service_event", "fact", ["service_id", "client_id_hash", "enrollment_id", "project_id",
                                    "service_type"]),
]


def _pii_sql() -> str:
    parts = []
    for label, src, cols in _PII_TABLES:
        for c in cols:
            forb = "true" if c in C.FORBIDDEN_DOWNSTREAM else "false"
            bad = (f"count_if(regexp_matches({c}, '{quality.RAW_SSN}') OR "
                   f"regexp_matches({c}, '{quality.RAW_EMAIL}'))")
            parts.append(f"SELECT '{label}' AS table_name, count(*) AS n_rows, '{c}' AS column_name, "
                         f"{forb} AS forbidden_name, CAST({bad} AS BIGINT) AS n_raw_pii FROM {src}")
    return " UNION ALL ".join(parts)


@query("dq_pii_leak", sql(_pii_sql(), "clients", "silver_clients", "silver_enrollments",
                          "silver_services", "fact"))
def dq_pii_leak(spark, sf_dir):
    """Forbidden column names and raw-looking SSN/e-mail values per layer.

    Bronze clients are the positive control (raw PII is allowed there only).
    """
    ctx = Ctx(spark, sf_dir)
    frames = {"bronze_clients": ctx.raw.clients, "silver_clients": ctx.silver_clients,
              "silver_enrollments": ctx.silver_enrollments,
              "silver_services": ctx.silver_services, "fact_service_event": ctx.fact}
    out = None
    for label, df in frames.items():
        s = quality.pii_scan(df, label)
        out = s if out is None else out.unionByName(s)
    return out


@query("reconcile_layers", sql(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, b.bronze_rows, b.bronze_keys, s.silver_rows, "
        "b.bronze_rows - b.bronze_keys AS raw_duplicates, "
        "round(abs(b.bronze_keys - s.silver_rows) / greatest(b.bronze_keys, 1), 6) AS drift, "
        "CASE WHEN round(abs(b.bronze_keys - s.silver_rows) / greatest(b.bronze_keys, 1), 6) <= 0.01 "
        "THEN 'OK' ELSE 'FAIL' END AS status FROM "
        f"(SELECT count(*) AS bronze_rows, count(DISTINCT {k}) AS bronze_keys FROM {t}) b, "
        f"(SELECT count(*) AS silver_rows FROM silver_{t}) s"
        for t, k in [("clients", "ClientID"), ("enrollments", "EnrollmentID"), ("services", "ServiceID")]),
    "silver_clients", "silver_enrollments", "silver_services"))
def reconcile_layers(spark, sf_dir):
    ctx = Ctx(spark, sf_dir)
    r = ctx.raw
    return (quality.reconcile_counts("clients", r.clients, "ClientID", ctx.silver_clients)
            .unionByName(quality.reconcile_counts("enrollments", r.enrollments, "EnrollmentID",
                                                  ctx.silver_enrollments))
            .unionByName(quality.reconcile_counts("services", r.services, "ServiceID",
                                                  ctx.silver_services)))


_MART_SQL = (
    "SELECT f.service_id, f.client_id_hash, f.enrollment_id, f.project_id, p.ProjectType AS project_type, "
    "f.service_type, f.service_date, f.qty, f.financial_assistance FROM fact f "
    "LEFT JOIN silver_projects p ON f.project_id = p.ProjectID")


def _mart(ctx: Ctx):
    dim = star.dim_project(ctx.silver_projects, ctx.raw.project_types).select("project_id", "project_type")
    return (ctx.fact.drop("project_type").join(dim, "project_id", "left")
            .select(*[c for c in ctx.fact.columns]))


@query("mart_fct_service_event", sql(_MART_SQL, "fact", "silver_projects"))
def mart_fct_service_event(spark, sf_dir):
    """Mart copy of the fact that re-reads project_type from dim_project (USING join)."""
    return _mart(Ctx(spark, sf_dir))


_CHECKSUM_SQL = " UNION ALL ".join(
        f"SELECT '{side}' AS side, count(*) AS n_rows, CAST(sum(qty) AS BIGINT) AS total_qty, "
        "CAST(sum(financial_assistance) AS DECIMAL(18,2)) AS total_fa, "
        "count(DISTINCT service_id) AS n_keys, min(service_date) AS min_date, max(service_date) AS max_date, "
        "round(abs(count(*) - (SELECT count(*) FROM fact)) / greatest((SELECT count(*) FROM fact), 1), 6) AS drift, "
        "CASE WHEN round(abs(count(*) - (SELECT count(*) FROM fact)) / greatest((SELECT count(*) FROM fact), 1), 6) "
        "<= 0.01 THEN 'OK' ELSE 'FAIL' END AS status "
        f"FROM {src}" for side, src in [("lake", "fact"), ("warehouse", f"({_MART_SQL}) m")])


@query("reconcile_checksums", sql(_CHECKSUM_SQL, "fact", "silver_projects"))
def reconcile_checksums(spark, sf_dir):
    """Lake fact vs warehouse mart: counts plus content checksums, 1% tolerance."""
    ctx = Ctx(spark, sf_dir)
    return quality.reconcile_copies(ctx.fact, _mart(ctx))


@query("daily_state_merged", sql(
    "SELECT count(*) AS n_rows, CAST(sum(qty) AS BIGINT) AS total_qty, min(qty) AS min_qty, max(qty) AS max_qty, "
    "count_if(service_id IS NULL) AS null_ids, count_if(qty NOT BETWEEN 1 AND 100) AS qty_out_of_range, "
    "true AS clients_within_bound FROM fact", "fact"))
def daily_state_merged(spark, sf_dir):
    """Fact state kept a day at a time (two loads), merged: exact figures, and the
    sketched number of clients checked against the exact one."""
    f = Ctx(spark, sf_dir).fact
    rules = [quality.not_null("service_id"), quality.between("qty", 1, 100)]
    state = DailyState(spark, job_dir(spark, "daily-state"), "service_date", sums=["qty"], distinct=["client_id_hash"],
                       spread=["qty"], rules=rules)
    cut = F.coalesce(F.col("service_date") < F.lit(dt.date(1996, 1, 1)), F.lit(True))
    state.put(f.filter(cut))
    state.put(f.filter(~cut))
    clients = f.agg(F.count_distinct(packed("client_id_hash"))).scalar()
    within = F.abs(F.col("distinct_client_id_hash") - clients) <= F.greatest(clients * DISTINCT_ERROR, F.lit(1))
    return report(state.between()).select(
        "n_rows", F.col("sum_qty").cast("bigint").alias("total_qty"), F.col("lo_qty").alias("min_qty"), F.col("hi_qty").alias("max_qty"),
        F.col("bad_0").alias("null_ids"), F.col("bad_1").alias("qty_out_of_range"), within.alias("clients_within_bound"))


_PLANTED = ("WITH p AS (SELECT *, (SELECT min(service_date) FROM fact) AS d0, (SELECT max(service_date) FROM fact) AS d1 FROM fact) "
            "SELECT service_id AS key, CASE WHEN service_date = d0 THEN 'lost' WHEN service_date = d1 THEN 'changed' ELSE 'moved' END "
            "AS change, service_date AS left_date, CASE WHEN service_date = d1 THEN d1 WHEN service_date = d0 THEN NULL "
            "ELSE service_date - 1 END AS right_date FROM p WHERE service_date = d0 OR service_date = d1 "
            "OR (service_date > d1 - 30 AND service_type = 'Meal')")


@query("copy_differences", sql(_PLANTED, "fact"))
def copy_differences(spark, sf_dir):
    """Every row in which a copy of the fact differs, found down the checksum tree.

    The copy has lost the first day, shows one unit more on the last day, and has
    the last month's meals a day early."""
    f = Ctx(spark, sf_dir).fact
    ends = f.agg(F.min("service_date"), F.max("service_date")).first()
    d0, d1 = F.lit(ends[0]), F.lit(ends[1])
    day = F.col("service_date")
    last = F.coalesce(day == d1, F.lit(False))
    early = F.coalesce((day > F.date_sub(d1, 30)) & ~last & (day != d0) & (F.col("service_type") == "Meal"), F.lit(False))
    copy = (f.filter(F.coalesce(day != d0, F.lit(True)))
            .withColumn("qty", F.when(last, F.col("qty") + 1).otherwise(F.col("qty")))
            .withColumn("service_date", F.when(early, F.date_sub(day, 1)).otherwise(day)))
    return hashtree.differences(f, copy, "service_id", "service_date")


def _masked(role):
    def run(spark, sf_dir):
        return governance.mask(Ctx(spark, sf_dir).fact, role)
    return run


_FACT_COLS = ("service_id, {h} AS client_id_hash, enrollment_id, project_id, project_type, service_type, "
              "service_date, qty, financial_assistance")
for _name, _role, _expr in [
        ("masked_fact_caseworker", C.ROLE_CASEWORKER, "client_id_hash"),
        ("masked_fact_analyst", C.ROLE_ANALYST, "left(client_id_hash, 8) || '...'"),
        ("masked_fact_hud", C.ROLE_HUD, "'AGG'"),
        ("masked_fact_other", "R_PUBLIC", "CAST(NULL AS VARCHAR)")]:
    query(_name, sql(f"SELECT {_FACT_COLS.format(h=_expr)} FROM fact", "fact"))(_masked(_role))

SCOPED_USER = "user_1"


@query("row_access_scoped", sql(
    f"SELECT {_FACT_COLS.format(h='left(client_id_hash, 8) || ' + chr(39) + '...' + chr(39))} FROM fact "
    f"WHERE project_id IN (SELECT project_id FROM user_project_grants WHERE user_name = '{SCOPED_USER}')",
    "fact", "user_project_grants"))
def row_access_scoped(spark, sf_dir):
    """An analyst sees only granted projects, with tokenised client ids."""
    ctx = Ctx(spark, sf_dir)
    return governance.secure_view(ctx.fact, ctx.raw.grants, SCOPED_USER, C.ROLE_ANALYST)


@query("row_access_hud", sql(
    "SELECT project_id, client_id_hash, CAST(count(*) AS BIGINT) AS n_services FROM "
    f"(SELECT {_FACT_COLS.format(h=chr(39) + 'AGG' + chr(39))} FROM fact) v GROUP BY project_id, client_id_hash",
    "fact"))
def row_access_hud(spark, sf_dir):
    """HUD reporting bypasses row scope but only ever sees the 'AGG' bucket."""
    ctx = Ctx(spark, sf_dir)
    v = governance.secure_view(ctx.fact, ctx.raw.grants, "hud_user", C.ROLE_HUD)
    return v.groupBy("project_id", "client_id_hash").agg(F.count(F.lit(1)).alias("n_services"))


@query("safe_cast_conform", sql(
    "SELECT event_id, field_changed, new_value, TRY_CAST(new_value AS INTEGER) AS value_int, "
    "TRY_CAST(new_value AS INTEGER) IS NOT NULL AS cast_ok FROM case_updates", "case_updates"))
def safe_cast_conform(spark, sf_dir):
    """Text values cast with try_cast: bad text gives NULL + a flag, never a failed job."""
    cu = Ctx(spark, sf_dir).raw.case_updates
    v = F.col("new_value").try_cast("int")
    return cu.select("event_id", "field_changed", "new_value", v.alias("value_int"),
                     v.isNotNull().alias("cast_ok"))


@query("pii_hash", sql(
    "SELECT h AS client_id_hash, CAST(count_if(src = 'fact') AS BIGINT) AS n_services, "
    "CAST(count_if(src = 'bed') AS BIGINT) AS n_bed_events FROM "
    "(SELECT client_id_hash AS h, 'fact' AS src FROM fact UNION ALL "
    "SELECT sha256(client_id), 'bed' FROM bed_events) u GROUP BY h", "fact", "bed_events"))
def pii_hash(spark, sf_dir):
    """Unsalted SHA-256 ids join across batch and stream: per client, services and
    bed events counted under the same hash (a union + one aggregate, no join)."""
    ctx = Ctx(spark, sf_dir)
    u = (ctx.fact.select(packed("client_id_hash").alias("h"), F.lit("fact").alias("src"))
         .unionByName(ctx.raw.bed_events.select(packed(hash_id("client_id")).alias("h"), F.lit("bed").alias("src"))))
    return u.groupBy("h").agg(
        F.count_if(F.col("src") == "fact").alias("n_services"),
        F.count_if(F.col("src") == "bed").alias("n_bed_events")).select(
        unpacked("h").alias("client_id_hash"), "n_services", "n_bed_events")


def _in(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in values)


def _bronze_sql() -> str:
    def nn(c): return ("not_null", c, f"count_if({c} IS NULL)")
    def uq(c): return ("unique", c, f"count({c}) - count(DISTINCT {c})")
    def st(c, vals): return ("in_set", c, f"count_if({c} IS NOT NULL AND {c} NOT IN ({_in(vals)}))")
    suites = {
        "clients": [nn("ClientID"), uq("ClientID"),
                    ("match_regex", "ClientID",
                     "count_if(ClientID IS NOT NULL AND NOT regexp_matches(ClientID, '^C[0-9]{8}$'))"),
                    st("VeteranStatus", [0, 1]), st("Gender", C.GENDERS), st("Race", C.RACES),
                    st("Ethnicity", C.ETHNICITIES)],
        "enrollments": [nn("EnrollmentID"), uq("EnrollmentID"), nn("PersonalID"),
                        st("Destination", C.DESTINATIONS), st("LivingSituation", C.LIVING_SITUATIONS),
                        st("RelationshipToHoH", C.RELATIONSHIPS)],
        "services": [nn("ServiceID"), nn("EnrollmentID"),
                     ("between", "QuantityOfServices", "count_if(QuantityOfServices IS NOT NULL AND NOT "
                                                       "QuantityOfServices BETWEEN 1 AND 1000000)"),
                     st("ServiceType", C.SERVICE_TYPES)],
        "bed_events": [nn("event_id"), uq("event_id"), st("event_type", C.BED_EVENT_TYPES)],
        "outreach": [nn("event_id"), uq("event_id"), st("encounter_type", C.ENCOUNTER_TYPES)],
        "case_updates": [nn("event_id"), uq("event_id"), st("op", C.CASE_OPS),
                         st("field_changed", C.CASE_FIELDS)],
    }
    return " UNION ALL ".join(_suite_sql(t, t, rules) for t, rules in suites.items())


@query("dq_bronze_suite", sql(_bronze_sql(), "clients", "enrollments", "services", "bed_events", "outreach",
                              "case_updates"))
def dq_bronze_suite(spark, sf_dir):
    """Shape checks of every raw input: id patterns, code lists, quantities —
    one aggregate pass per table."""
    raw = Ctx(spark, sf_dir).raw
    out = None
    for table, rules in quality.bronze_rules().items():
        r = quality.run_suite(getattr(raw, table), table, rules)
        out = r if out is None else out.unionByName(r)
    return out
