"""Operational KPIs and service-mix aggregates over the gold fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haven.functions.geo import grid_cell

RECENT_WINDOW = "2 hours"
HOTSPOT_CELL_DEG = 0.01


def latest_value(df: DataFrame, col: str):
    """The input's own 'now': max of a time column (one scalar to the driver).

    Returned as a literal so later filters become static predicates the
    Parquet reader can use for row-group pruning.
    """
    return df.agg(F.max(col)).first()[0]


def lit_ts(value: dt.datetime | None) -> Column:
    return F.lit(value).cast("timestamp")


def recent(df: DataFrame, as_of: dt.datetime, window: str = RECENT_WINDOW,
           col: str = "event_time") -> DataFrame:
    """Rows in (as_of - window, as_of]."""
    lo = lit_ts(as_of) - F.expr(f"INTERVAL {window}")
    return df.filter((F.col(col) > lo) & (F.col(col) <= lit_ts(as_of)))


def service_mix_qty(fact: DataFrame) -> DataFrame:
    return fact.groupBy("service_type").agg(F.sum("qty").cast("bigint").alias("total_qty"))


def service_mix_counts(fact: DataFrame) -> DataFrame:
    """Frequency of each service type, nulls excluded, most frequent first."""
    return (fact.filter(F.col("service_type").isNotNull())
            .groupBy("service_type").agg(F.count(F.lit(1)).alias("n_services"))
            .orderBy(F.desc("n_services"), "service_type"))


def fa_total(fact: DataFrame) -> DataFrame:
    return fact.agg(F.sum("financial_assistance").cast("decimal(18,2)").alias("total_fa"),
                    F.count(F.lit(1)).alias("n_services"))


def services_daily(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("service_date", "service_type")
            .agg(F.count(F.lit(1)).alias("n_services"),
                 F.sum("financial_assistance").cast("decimal(18,2)").alias("total_fa")))


def daily_volume_by_type(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("service_date", "project_type")
            .agg(F.count(F.lit(1)).alias("n_services"),
                 F.sum("qty").cast("bigint").alias("total_qty")))


def length_of_stay_days(fact: DataFrame) -> DataFrame:
    """Mean over enrollments of (last - first service day)."""
    per = (fact.filter(F.col("service_date").isNotNull())
           .groupBy("enrollment_id")
           .agg(F.datediff(F.max("service_date"), F.min("service_date")).alias("days")))
    return per.agg(F.round(F.avg("days"), 6).alias("avg_length_of_stay_days"),
                   F.count(F.lit(1)).alias("n_enrollments"))


def first_service_per_client(fact: DataFrame) -> DataFrame:
    """Every fact row with its client's first-ever service date.

    Aggregate-then-join rather than a window over the client: the min is
    combined map-side, and a hot client in the join back is split by AQE's
    skew-join handling instead of sorting in one task.
    """
    firsts = (fact.groupBy("client_id_hash")
              .agg(F.min("service_date").alias("first_service_date")))
    return fact.join(firsts, "client_id_hash", "left")


def ops_kpis(fact: DataFrame, outreach: DataFrame, today, outreach_as_of) -> DataFrame:
    """Services today, distinct clients and projects, outreach contacts (2 h)."""
    f = fact.agg(
        F.count_if(F.col("service_date") == F.lit(today)).alias("services_today"),
        F.count_distinct("client_id_hash").alias("active_clients"),
        F.count_distinct("project_id").alias("active_projects"),
        F.count(F.lit(1)).alias("n_services"),
    )
    o = recent(outreach, outreach_as_of).agg(F.count(F.lit(1)))
    return f.withColumn("outreach_2h", o.scalar())


def outreach_center(outreach: DataFrame) -> DataFrame:
    return outreach.agg(F.round(F.avg("lat"), 6).alias("center_lat"),
                        F.round(F.avg("lon"), 6).alias("center_lon"),
                        F.count(F.lit(1)).alias("n_points"))


def outreach_hotspots(outreach: DataFrame, cell: float = HOTSPOT_CELL_DEG) -> DataFrame:
    """Grid-cell heat map: count and mean position per cell."""
    return (outreach.withColumn("cell_lat", grid_cell(F.col("lat"), cell))
            .withColumn("cell_lon", grid_cell(F.col("lon"), cell))
            .groupBy("cell_lat", "cell_lon")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.round(F.avg("lat"), 6).alias("mean_lat"),
                 F.round(F.avg("lon"), 6).alias("mean_lon")))


def outreach_needs_mix(outreach: DataFrame) -> DataFrame:
    """Multi-label needs: one count per need across all encounters."""
    needs = F.from_json("needs", "array<string>")
    return (outreach.select(F.explode(needs).alias("need"))
            .groupBy("need").agg(F.count(F.lit(1)).alias("n_encounters")))
