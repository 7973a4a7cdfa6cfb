"""SCD2 history, as-of views and incremental upsert queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from haven import contracts as C
from haven.functions.privacy import hash_and_drop_client
from haven.operators import history, upsert
from haven.operators.history_store import HistoryStore
from haven.operators.keys import FEW_REPEATED
from haven.operators.metrics import latest_value
from haven.plans.context import Ctx
from haven.plans.oracle_base import sql
from haven.plans.registry import query
from haven.session import job_dir

_F = C.CASE_FIELDS

CHANGES_CTES = (
    "cu AS (SELECT sha256(client_id) AS h, field_changed AS f, new_value AS v, event_time AS t, event_id AS id "
    "FROM case_updates WHERE op IN ('c', 'u')), "
    "c1 AS (SELECT h, f, t, v, id FROM (SELECT *, row_number() OVER (PARTITION BY h, f, t ORDER BY id DESC) AS rn "
    "FROM cu) x WHERE rn = 1), "
    "eff AS (SELECT * FROM (SELECT h, f, v, lag(v) OVER (PARTITION BY h, f ORDER BY t) AS pv, t, id FROM c1) y "
    "WHERE pv IS NULL OR pv <> v)")

_HIST_CTES = CHANGES_CTES + (
    ", wide AS (SELECT h, t AS valid_from, "
    + ", ".join(f"max(CASE WHEN f = '{f}' THEN v END) AS {f}" for f in _F)
    + " FROM eff WHERE h IN (SELECT ClientID_hash FROM silver_clients) GROUP BY h, t), "
    "vers AS (SELECT ClientID_hash AS h, TIMESTAMP '1970-01-01 00:00:00' AS valid_from, "
    + ", ".join(f"CAST(NULL AS VARCHAR) AS {f}" for f in _F)
    + " FROM silver_clients UNION ALL SELECT * FROM wide), "
    "filled AS (SELECT h, valid_from, "
    + ", ".join(f"last_value({f} IGNORE NULLS) OVER (PARTITION BY h ORDER BY valid_from ROWS BETWEEN "
                f"UNBOUNDED PRECEDING AND CURRENT ROW) AS {f}" for f in _F)
    + ", lead(valid_from) OVER (PARTITION BY h ORDER BY valid_from) AS valid_to, "
    "CAST(row_number() OVER (PARTITION BY h ORDER BY valid_from) AS INTEGER) AS version FROM vers), "
    "hist AS (SELECT x.h AS client_id_hash, x.valid_from, " + ", ".join(f"x.{f}" for f in _F)
    + ", x.valid_to, x.version, c.Gender AS gender, c.Race AS race, c.Ethnicity AS ethnicity, "
    "c.VeteranStatus AS veteran_status, c.YearOfBirth AS year_of_birth, x.valid_to IS NULL AS is_current, "
    "CAST('0x' || substr(sha256(x.h || '|' || epoch_us(x.valid_from)), 1, 15) AS BIGINT) AS client_version_key "
    "FROM filled x JOIN silver_clients c ON x.h = c.ClientID_hash)")

_AS_OF_SQL = ("(SELECT date_trunc('day', min(event_time)) + INTERVAL 14 DAY FROM case_updates)")


def _case(ctx: Ctx):
    return hash_and_drop_client(ctx.raw.case_updates)


def _history(ctx: Ctx):
    return ctx.client_history


def _as_of(ctx: Ctx) -> dt.datetime:
    start = ctx.raw.case_updates.agg(F.min("event_time")).first()[0]
    return dt.datetime(start.year, start.month, start.day) + dt.timedelta(days=14)


@query("client_changes", sql(
    f"WITH {CHANGES_CTES} SELECT h AS client_id_hash, f AS field_changed, v AS new_value, pv AS prev_value, "
    "t AS event_time, id AS event_id FROM eff", "case_updates"))
def client_changes(spark, sf_dir):
    """Effective case changes (same-instant collapse, no-op updates dropped)."""
    return history.client_changes(_case(Ctx(spark, sf_dir)))


@query("scd2_client_history", sql(f"WITH {_HIST_CTES} SELECT * FROM hist", "case_updates", "silver_clients"))
def scd2_client_history(spark, sf_dir):
    return _history(Ctx(spark, sf_dir))


@query("scd2_incremental_merge", sql(f"WITH {_HIST_CTES} SELECT * FROM hist", "case_updates", "silver_clients"))
def scd2_incremental_merge(spark, sf_dir):
    """History built in two loads equals the one-shot history.

    Load 1 holds the first half of the updates by arrival (event id); load 2
    the rest, which includes events older than load 1's newest (backdated).
    History and change log are a bucketed store in the shared folder; the
    second load rewrites the buckets of its own clients, as a scheduled job would.
    """
    ctx = Ctx(spark, sf_dir)
    cu = _case(ctx).withColumn("_arrival", F.substring("event_id", 4, 20).cast("bigint"))
    split = cu.agg(F.percentile_approx("_arrival", 0.5)).first()[0]
    first, second = cu.filter(F.col("_arrival") <= split), cu.filter(F.col("_arrival") > split)
    base = ctx.silver_clients
    store = HistoryStore(spark, job_dir(spark, "scd2"))
    store.create(base, first.drop("_arrival"))
    store.merge(base, second.drop("_arrival"))
    return store.history()


@query("dim_client_as_of", sql(
    f"WITH {_HIST_CTES} SELECT * FROM hist WHERE valid_from <= {_AS_OF_SQL} AND "
    f"(valid_to IS NULL OR valid_to > {_AS_OF_SQL})", "case_updates", "silver_clients"))
def dim_client_as_of(spark, sf_dir):
    """The client dimension as it stood two weeks into the change stream."""
    ctx = Ctx(spark, sf_dir)
    return history.as_of_rows(_history(ctx), _as_of(ctx))


@query("fact_scd2_asof_join", sql(
    f"WITH {_HIST_CTES} SELECT e.event_id, sha256(e.client_id) AS client_id_hash, e.event_type, e.project_id, "
    "e.bed_id, e.event_time, h.version, h.HousingStatus, h.ContactStatus FROM bed_events e JOIN hist h "
    "ON sha256(e.client_id) = h.client_id_hash AND h.valid_from <= e.event_time "
    "AND (h.valid_to IS NULL OR e.event_time < h.valid_to)", "case_updates", "silver_clients", "bed_events"))
def fact_scd2_asof_join(spark, sf_dir):
    """Each bed event with the client's history version valid at event time."""
    ctx = Ctx(spark, sf_dir)
    ev = hash_and_drop_client(ctx.raw.bed_events)
    return history.as_of_join(ev, _history(ctx), carry=["version", "HousingStatus", "ContactStatus"])


# --- incremental fact ---------------------------------------------------------------------

CUT_DAYS = 365
LOOKBACK_DAYS = 6
_FACT_COLS = ["service_id", "client_id_hash", "enrollment_id", "project_id", "project_type",
              "service_type", "service_date", "qty", "financial_assistance"]


@query("incremental_fact", sql(
    "WITH hwm AS (SELECT max(service_date) AS h FROM fact WHERE service_date < "
    f"CAST((SELECT max(service_date) FROM fact) - INTERVAL {CUT_DAYS} DAY AS DATE)), "
    "fx AS (SELECT *, service_type = 'Meal' AND service_date <= (SELECT h FROM hwm) AND "
    f"service_date >= (SELECT h FROM hwm) - {LOOKBACK_DAYS} AS corr FROM fact) "
    "SELECT service_id, client_id_hash, enrollment_id, project_id, project_type, service_type, "
    "CASE WHEN corr THEN service_date + 1 ELSE service_date END AS service_date, "
    "CASE WHEN corr THEN qty + 1 ELSE qty END AS qty, financial_assistance FROM fx", "fact"))
def incremental_fact(spark, sf_dir):
    """Incremental, keyed upsert of the fact into a date-partitioned table.

    The table first holds the fact up to a cut date, but for hygiene kits of
    the last days, which arrive late.  The next batch carries every row from the
    look-back before the table's high-water mark on (so the late rows are met
    and the days between are reprocessed) and every row without a date, plus corrections to recent rows — some
    of which move to another date partition.  The result must equal the fact
    with the corrections applied.
    """
    f = Ctx(spark, sf_dir).fact
    cut = latest_value(f, "service_date") - dt.timedelta(days=CUT_DAYS)
    path = job_dir(spark, "fact-table")
    first = f.filter(F.col("service_date") < F.lit(cut))
    last = latest_value(first, "service_date")
    late = (F.col("service_type") == "Hygiene kit") & F.col("service_date").between(
        F.lit(last - dt.timedelta(days=LOOKBACK_DAYS)), F.lit(last - dt.timedelta(days=1)))
    table = upsert.create(first.filter(~F.coalesce(late, F.lit(False))), path, "service_id", "service_date",
                          hashes=["client_id_hash"])
    hwm = upsert.high_water_mark(table, "service_date")
    fixes = (table.filter((F.col("service_type") == "Meal")
                          & F.col("service_date").between(F.lit(hwm - dt.timedelta(days=LOOKBACK_DAYS)),
                                                          F.lit(hwm)))
             .withColumn("service_date", F.date_add("service_date", 1))
             .withColumn("qty", F.col("qty") + 1))
    fixed = fixes.select("service_id")
    if fixed.count() <= FEW_REPEATED:  # so few go to every task: the increment itself is not dealt by key
        fixed = F.broadcast(fixed)
    fresh = upsert.increment(f, "service_date", hwm, LOOKBACK_DAYS, undated=True).join(fixed, "service_id", "left_anti")
    batch = fresh.unionByName(fixes.select(*f.columns))
    upsert.upsert(spark, path, batch, "service_id", "service_date", target=table, hashes=["client_id_hash"])
    return upsert.read_table(spark, path).select(*_FACT_COLS)
