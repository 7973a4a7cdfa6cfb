"""Care-pathway analytics: HUD APR, returns, clinic wait, equity, case status."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haven import contracts as C
from haven.functions.geo import grid_cell
from haven.functions.privacy import packed, unpacked

DISPARITY_LOW = 0.8
DISPARITY_HIGH = 1.25
GEO_CELL_DEG = 0.05


# --- HUD APR ------------------------------------------------------------------------

def apr_entries_exits(enrollments: DataFrame) -> DataFrame:
    """Per calendar month: entries, exits, and enrollments active at month end.

    Active at month end = entries so far - exits so far, a running sum over
    the month grid (one row per month), instead of expanding each stay.
    """
    e = enrollments.select("EntryDate", "ExitDate")
    ins = e.groupBy(F.trunc("EntryDate", "month").alias("month")).agg(F.count(F.lit(1)).alias("entries"))
    outs = (e.filter(F.col("ExitDate").isNotNull())
            .groupBy(F.trunc("ExitDate", "month").alias("month")).agg(F.count(F.lit(1)).alias("exits")))
    bounds = e.agg(F.trunc(F.min("EntryDate"), "month").alias("lo"),
                   F.trunc(F.greatest(F.max("EntryDate"), F.max("ExitDate")), "month").alias("hi"))
    grid = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    w = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return (grid.join(ins, "month", "left").join(outs, "month", "left")
            .select("month", F.coalesce("entries", F.lit(0)).alias("entries"),
                    F.coalesce("exits", F.lit(0)).alias("exits"))
            .withColumn("active_at_month_end",
                        (F.sum("entries").over(w) - F.sum("exits").over(w)).cast("bigint")))


def with_project_type(enrollments: DataFrame, projects: DataFrame) -> DataFrame:
    p = projects.select("ProjectID", F.col("ProjectType").alias("project_type"))
    return enrollments.join(p, "ProjectID", "left")


def apr_exits_by_destination(enrollments: DataFrame, projects: DataFrame, start, end) -> DataFrame:
    """Exits in [start, end] by rollup(project_type, destination) with grouping id."""
    ex = (with_project_type(enrollments, projects)
          .filter(F.col("ExitDate").between(F.lit(start), F.lit(end))))
    return (ex.rollup("project_type", F.col("Destination").alias("destination"))
            .agg(F.count(F.lit(1)).alias("n_exits"),
                 F.grouping_id().cast("int").alias("grouping_level")))


def apr_stay_length(enrollments: DataFrame, projects: DataFrame, as_of) -> DataFrame:
    """Per project type: mean and max days from entry to exit (or as_of)."""
    stay = F.datediff(F.coalesce("ExitDate", F.lit(as_of).cast("date")), "EntryDate")
    return (with_project_type(enrollments, projects).withColumn("stay", stay)
            .groupBy("project_type")
            .agg(F.count(F.lit(1)).alias("n_enrollments"),
                 F.round(F.avg("stay"), 6).alias("avg_stay_days"),
                 F.max("stay").alias("max_stay_days")))


# --- returns ------------------------------------------------------------------------

def client_days(fact: DataFrame) -> DataFrame:
    """Distinct (client, service day): bounded per client by the calendar."""
    return (fact.filter(F.col("service_date").isNotNull())
            .select("client_id_hash", "service_date").distinct())


def returns_gap(fact: DataFrame, days: int = C.RETURN_WINDOW_DAYS) -> DataFrame:
    """Clients with a gap > days between consecutive service days."""
    w = Window.partitionBy("client_id_hash").orderBy("service_date")
    d = client_days(fact).withColumn("prev", F.lag("service_date").over(w))
    gaps = d.filter(F.datediff("service_date", "prev") > days)
    return gaps.groupBy("client_id_hash").agg(
        F.count(F.lit(1)).alias("n_gaps"),
        F.min("service_date").alias("first_return_date"),
        F.max(F.datediff("service_date", "prev")).alias("longest_gap_days"))


def returns_any(fact: DataFrame, days: int = C.RETURN_WINDOW_DAYS) -> DataFrame:
    """Clients with any service later than days after their first one."""
    return (fact.filter(F.col("service_date").isNotNull())
            .groupBy("client_id_hash")
            .agg(F.min("service_date").alias("first_date"), F.max("service_date").alias("last_date"))
            .withColumn("span_days", F.datediff("last_date", "first_date"))
            .filter(F.col("span_days") > days))


def returns_after_ph_exit(enrollments: DataFrame, days: int = C.RETURN_WINDOW_DAYS) -> DataFrame:
    """Permanent-housing exits followed by a new entry of the same client in
    (exit, exit + days].  Per client one row per calendar day (entries and
    permanent exits folded together), then the next entry day after each exit
    day by a running min — no pairing of exits with entries.
    """
    perm = F.col("Destination").isin(*C.PERMANENT_DESTINATIONS) & F.col("ExitDate").isNotNull()
    marks = (enrollments.select("PersonalID_hash", F.col("EntryDate").alias("day"),
                                F.lit(True).alias("is_entry"), F.lit(False).alias("is_exit"))
             .unionByName(enrollments.filter(perm).select(
                 "PersonalID_hash", F.col("ExitDate").alias("day"),
                 F.lit(False).alias("is_entry"), F.lit(True).alias("is_exit"))))
    per_day = (marks.filter(F.col("day").isNotNull())
               .groupBy("PersonalID_hash", "day")
               .agg(F.max("is_entry").alias("is_entry"), F.max("is_exit").alias("is_exit")))
    w = (Window.partitionBy("PersonalID_hash").orderBy("day")
         .rowsBetween(1, Window.unboundedFollowing))
    nxt = F.min(F.when(F.col("is_entry"), F.col("day"))).over(w)
    return (per_day.withColumn("next_entry_date", nxt)
            .filter("is_exit")
            .select(F.col("PersonalID_hash").alias("client_id_hash"), F.col("day").alias("exit_date"),
                    "next_entry_date",
                    F.datediff("next_entry_date", "day").alias("days_to_return"))
            .withColumn("returned", F.coalesce(F.col("days_to_return") <= days, F.lit(False))))


# --- clinic wait, equity, case status --------------------------------------------------

def clinic_wait_proxy(services: DataFrame, enrollments: DataFrame) -> DataFrame:
    """Days from entry to the first clinic visit on/after it, per project.

    No wait-time field exists; this is a proxy and is labelled as one.
    """
    visits = services.filter(F.col("ServiceType") == "Clinic visit").select("EnrollmentID", "DateProvided")
    e = enrollments.select("EnrollmentID", "ProjectID", "EntryDate")
    first = (visits.join(e, "EnrollmentID", "inner")
             .filter(F.col("DateProvided") >= F.col("EntryDate"))
             .groupBy("EnrollmentID").agg(F.min("DateProvided").alias("first_visit")))
    per = e.join(first, "EnrollmentID", "left").withColumn(
        "wait", F.datediff("first_visit", "EntryDate"))
    return per.groupBy(F.col("ProjectID").alias("project_id")).agg(
        F.count("wait").alias("n_with_visit"),
        F.count_if(F.col("wait").isNull()).alias("n_without_visit"),
        F.round(F.avg("wait"), 6).alias("avg_wait_days_proxy"))


def equity_disparity(fact: DataFrame, clients: DataFrame) -> DataFrame:
    """Share of services vs share of clients per veteran status, race, gender.

    The fact is first reduced to one row per client (map-side combine), so the
    join with clients and the grouping sets run over clients, not services.
    """
    per_client = fact.groupBy("client_id_hash").agg(F.sum("qty").alias("qty"))
    c = clients.select(F.col("ClientID_hash").alias("client_id_hash"),
                       F.col("VeteranStatus").cast("string").alias("veteran_status"),
                       F.col("Race").alias("race"), F.col("Gender").alias("gender"))
    j = per_client.join(c, "client_id_hash", "inner")
    g = j.groupingSets([["veteran_status"], ["race"], ["gender"]], "veteran_status", "race", "gender").agg(
        F.count(F.lit(1)).alias("n_clients"), F.sum("qty").cast("bigint").alias("total_qty"),
        F.grouping_id().alias("gid"))
    # every grouping set partitions all clients, so its own sums are the
    # totals: a window over the few grouped rows, not another pass over j
    per_set = Window.partitionBy("gid")
    tot_c = F.sum("n_clients").over(per_set)
    tot_q = F.sum("total_qty").over(per_set)
    dim = (F.when(F.col("gid") == 3, "veteran_status").when(F.col("gid") == 5, "race")
           .otherwise("gender"))
    val = F.coalesce("veteran_status", "race", "gender")
    share_c = F.col("n_clients") / tot_c
    share_q = F.col("total_qty") / tot_q
    ratio = share_q / share_c
    return g.select(dim.alias("dimension"), val.alias("value"), "n_clients", "total_qty",
                    F.round(share_c, 6).alias("share_clients"), F.round(share_q, 6).alias("share_qty"),
                    F.round(ratio, 6).alias("ratio"),
                    ((ratio < DISPARITY_LOW) | (ratio > DISPARITY_HIGH)).alias("disparity_flag"))


def client_case_status(case_updates: DataFrame) -> DataFrame:
    """Latest value per case field and client (ties on time broken by event_id)."""
    order = F.struct("event_time", "event_id")
    aggs = [F.max_by("new_value", F.when(F.col("field_changed") == f, order)).alias(f)
            for f in C.CASE_FIELDS]
    return case_updates.groupBy("client_id_hash").agg(
        *aggs, F.max("event_time").alias("last_update"), F.count(F.lit(1)).alias("n_updates"))


def case_update_activity(case_updates: DataFrame) -> DataFrame:
    return (case_updates.groupBy(F.to_date("event_time").alias("event_date"), "field_changed", "op")
            .agg(F.count(F.lit(1)).alias("n_updates"),
                 F.count_distinct("client_id_hash").alias("n_clients")))


def client_seen_before(encounters: DataFrame, fact: DataFrame) -> DataFrame:
    """Per encounter: has the client a service on or before the encounter day?"""
    # hashes are dealt as bytes, half as long as their text
    firsts = fact.groupBy(packed("client_id_hash").alias("_h")).agg(F.min("service_date").alias("first_service_date"))
    met = encounters.select("event_id", packed("client_id_hash").alias("_h"), "event_time")
    return (met.join(firsts, "_h", "left")
            .select("event_id", unpacked("_h").alias("client_id_hash"), "first_service_date",
                    F.coalesce(F.col("first_service_date") <= F.to_date("event_time"),
                               F.lit(False)).alias("seen_before")))


def dim_agency(projects: DataFrame) -> DataFrame:
    return projects.groupBy(F.col("OrganizationID").alias("organization_id")).agg(
        F.count(F.lit(1)).alias("n_projects"),
        F.min("OperatingStartDate").alias("first_operating_date"))


def dim_geography(projects: DataFrame, cell: float = GEO_CELL_DEG) -> DataFrame:
    return (projects.withColumn("cell_lat", grid_cell(F.col("Latitude"), cell))
            .withColumn("cell_lon", grid_cell(F.col("Longitude"), cell))
            .groupBy("cell_lat", "cell_lon")
            .agg(F.count(F.lit(1)).alias("n_projects"),
                 F.round(F.avg("Latitude"), 6).alias("center_lat"),
                 F.round(F.avg("Longitude"), 6).alias("center_lon")))
