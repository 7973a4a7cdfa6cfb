"""Bed status, availability and hourly utilisation (the nearest open bed: ``nearest``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haven.operators.keys import last_by_key
from haven.operators.sequence import hot_splits, ordered_by_key


def bed_status_current(bed_events: DataFrame) -> DataFrame:
    """Latest event per bed by (event_time, event_id); CHECKIN means occupied.

    An aggregate (partial on the map side), so a bed with a huge history
    still reaches the reducer as one row per input partition.
    """
    latest = last_by_key(
        bed_events.select("project_id", "bed_id", "event_time", "event_id", "event_type"),
        ["project_id", "bed_id"], ["event_time", "event_id"])
    return latest.select("project_id", "bed_id",
                         F.col("event_id").alias("last_event_id"),
                         F.col("event_type").alias("last_event_type"),
                         F.col("event_time").alias("last_event_time"),
                         (F.col("event_type") == "CHECKIN").alias("occupied"))


def bed_availability(status: DataFrame) -> DataFrame:
    """Beds seen, occupied and open per project (capacity = observed beds)."""
    return (status.groupBy("project_id")
            .agg(F.count(F.lit(1)).alias("beds_seen"),
                 F.count_if("occupied").alias("beds_occupied"))
            .withColumn("beds_open", F.col("beds_seen") - F.col("beds_occupied")))


def occupied_stays(bed_events: DataFrame, as_of, splits: DataFrame | None = None) -> DataFrame:
    """CHECKIN until the bed's next event (or as_of while still open).

    The per-bed ``lead`` runs per (bed, day) with the next day's first event
    carried back, so a bed with a huge history is still spread over tasks."""
    e = bed_events.select("project_id", "bed_id", "event_time", "event_id", "event_type")
    e = ordered_by_key(e, ["project_id", "bed_id"], ["event_time", "event_id"],
                       lead={"_next": "event_time"}, splits=splits)
    return (e.withColumn("stay_end", F.coalesce("_next", F.lit(as_of).cast("timestamp")))
            .filter((F.col("event_type") == "CHECKIN") & (F.col("stay_end") > F.col("event_time")))
            .select("project_id", "bed_id", F.col("event_time").alias("stay_start"), "stay_end"))


def bed_utilization_hourly(bed_events: DataFrame, as_of) -> DataFrame:
    """Per project and hour: distinct beds occupied at any time in the hour / beds seen.

    Sweep line, not a bed x hour expansion.  Each stay adds +1 at its first
    hour and -1 after its last.  A bed's stays never overlap in time, so two
    of them can share only a boundary hour, and only if they are consecutive:
    each such touching pair subtracts its shared hour once, which makes the
    sum count every bed once per hour.  A running sum per project over the
    change points gives the occupied count, and only occupied segments are
    expanded to hours — the intermediate grows with stays, the output with
    project-hours.
    """
    hour = F.expr("INTERVAL 1 HOUR")
    splits = hot_splits(bed_events, ["project_id", "bed_id"], "event_time")
    stays = (occupied_stays(bed_events, as_of, splits)
             .withColumn("hs", F.date_trunc("hour", "stay_start"))
             .withColumn("he", F.date_trunc("hour", F.col("stay_end") - F.expr("INTERVAL 1 MICROSECOND"))))
    stays = ordered_by_key(stays, ["project_id", "bed_id"], ["stay_start"], lag={"_prev_he": "he"}, splits=splits)
    touch = stays.filter(F.col("_prev_he") == F.col("hs"))
    edges = (stays.select("project_id", F.col("hs").alias("hour"), F.lit(1).alias("d"))
             .unionByName(stays.select("project_id", (F.col("he") + hour).alias("hour"), F.lit(-1).alias("d")))
             .unionByName(touch.select("project_id", F.col("hs").alias("hour"), F.lit(-1).alias("d")))
             .unionByName(touch.select("project_id", (F.col("hs") + hour).alias("hour"), F.lit(1).alias("d"))))
    deltas = edges.groupBy("project_id", "hour").agg(F.sum("d").alias("d"))
    level = ordered_by_key(deltas, ["project_id"], ["hour"], running_sum={"occupied_beds": "d"},
                           lead={"_next": "hour"})
    occ = (level.filter(F.col("occupied_beds") > 0)
           .select("project_id", F.explode(F.sequence("hour", F.col("_next") - hour, hour)).alias("hour"),
                   "occupied_beds"))
    seen = bed_events.groupBy("project_id").agg(F.count_distinct("bed_id").alias("beds_seen"))
    return (occ.join(seen, "project_id", "inner")
            .withColumn("utilization", F.round(F.col("occupied_beds") / F.col("beds_seen"), 6)))
