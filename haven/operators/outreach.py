"""Street-outreach analytics: underserved zones, sessions, chronic encounters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haven.functions.privacy import hash_id
from haven.operators.sequence import hot_splits, ordered_by_key

SESSION_GAP = "30 minutes"
CHRONIC_MIN_DAYS = 4
CHRONIC_WINDOW_DAYS = 30


def underserved_zones_hourly(outreach: DataFrame, first_hour, last_hour) -> DataFrame:
    """Every zone x every hour in range (zeros kept), ranked fewest-first per hour.

    The zone list comes from the data; each zone row expands its own hour
    sequence, so the dense grid needs no cross join.
    """
    counts = (outreach.withColumn("hour", F.date_trunc("hour", "event_time"))
              .groupBy("zone", "hour").agg(F.count_distinct("event_id").alias("n_events")))
    hours = F.sequence(F.lit(first_hour).cast("timestamp"), F.lit(last_hour).cast("timestamp"),
                       F.expr("INTERVAL 1 HOUR"))
    grid = outreach.select("zone").distinct().select("zone", F.explode(hours).alias("hour"))
    w = Window.partitionBy("hour").orderBy("n_events", "zone")
    return (grid.join(counts, ["zone", "hour"], "left")
            .withColumn("n_events", F.coalesce("n_events", F.lit(0)).cast("bigint"))
            .withColumn("underserved_rank", F.rank().over(w)))


def known_clients(outreach: DataFrame) -> DataFrame:
    """Encounters with a client id, id hashed (anonymous rows excluded)."""
    return (outreach.filter(F.col("client_id").isNotNull())
            .withColumn("client_id_hash", hash_id("client_id")).drop("client_id"))


def outreach_sessions(outreach: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """Contact episodes per client: events closer than ``gap`` chain together.

    Same result as ``session_window(event_time, gap)`` (end = last event +
    gap), computed as lag -> new-session flag -> running session number
    with day buckets (cut further where hot), then a plain aggregate per (client, session): a client
    with a huge history is spread over tasks and combined map-side.
    """
    k = known_clients(outreach).select("client_id_hash", "event_time", "event_id")
    splits = hot_splits(k, ["client_id_hash"], "event_time")
    k = ordered_by_key(k, ["client_id_hash"], ["event_time", "event_id"], lag={"_prev": "event_time"}, splits=splits)
    new = F.col("_prev").isNull() | (F.col("event_time") >= F.col("_prev") + F.expr(f"INTERVAL {gap}"))
    k = ordered_by_key(k.withColumn("_new", new.cast("int")), ["client_id_hash"], ["event_time", "event_id"],
                       running_sum={"_session": "_new"}, splits=splits)
    return (k.groupBy("client_id_hash", "_session")
            .agg(F.min("event_time").alias("session_start"),
                 (F.max("event_time") + F.expr(f"INTERVAL {gap}")).alias("session_end"),
                 F.count(F.lit(1)).alias("n_events"))
            .drop("_session"))


def outreach_sessions_stream(parsed: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """Streaming form: native session windows under the stream's watermark."""
    return (parsed.filter(F.col("client_id_hash").isNotNull())
            .groupBy("client_id_hash", F.session_window("event_time", gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select("client_id_hash", F.col("s.start").alias("session_start"),
                    F.col("s.end").alias("session_end"), "n_events"))


def chronic_encounters(outreach: DataFrame, min_days: int = CHRONIC_MIN_DAYS,
                       window_days: int = CHRONIC_WINDOW_DAYS) -> DataFrame:
    """Clients seen on >= min_days distinct days within any window_days span.

    Distinct (client, day) first: the per-client window then holds at most
    one row per calendar day, whatever the client's event volume.
    """
    days = (known_clients(outreach)
            .select("client_id_hash", F.to_date("event_time").alias("day")).distinct()
            .withColumn("dn", F.unix_date("day")))
    w = Window.partitionBy("client_id_hash").orderBy("dn").rangeBetween(-(window_days - 1), 0)
    per = days.withColumn("days_in_window", F.count(F.lit(1)).over(w))
    return (per.groupBy("client_id_hash")
            .agg(F.count(F.lit(1)).alias("n_days"),
                 F.max("days_in_window").alias("max_days_in_window"),
                 F.min("day").alias("first_day"), F.max("day").alias("last_day"))
            .filter(F.col("max_days_in_window") >= min_days))
