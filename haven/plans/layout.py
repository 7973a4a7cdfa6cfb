"""Sources, sinks and table-layout queries: each writes real files under the
shared folder, reads them back, and returns what a reader would see."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from haven import contracts as C
from haven.functions.dates import day_range
from haven.operators import conform
from haven.operators.metrics import latest_value
from haven.operators.upsert import write_partitioned
from haven.plans.context import Ctx
from haven.plans.oracle_base import sql
from haven.plans.registry import query
from haven.session import job_dir
from haven.sources import batch, schema_log

SCHEMA_CHANGE_DATE = "1998-01-01"
_SERVICE_SEED = StructType(C.SERVICES.fields + [StructField("_tie1", LongType()), StructField("_tie2", LongType())])


@query("bronze_ingest", sql(
    "SELECT ServiceID, EnrollmentID, PersonalID, DateProvided, ServiceType, QuantityOfServices, FAAmount, "
    "_tie1, _tie2, false AS is_corrupt, true AS has_provenance FROM services", "services"))
def bronze_ingest(spark, sf_dir):
    """JSON-lines seed -> schema-on-read bronze with ingest time and source file."""
    root = job_dir(spark, "seed")
    batch.write_seed(Ctx(spark, sf_dir).raw.services, f"{root}/services")
    b = batch.read_bronze(spark, f"{root}/services", _SERVICE_SEED)
    return b.select(*[f.name for f in _SERVICE_SEED.fields],
                    F.col(batch.CORRUPT).isNotNull().alias("is_corrupt"),
                    (F.col("_source_file").isNotNull() & F.col("_ingest_ts").isNotNull()).alias("has_provenance"))


@query("schema_evolution_union", sql(
    "SELECT EnrollmentID, PersonalID, ProjectID, EntryDate, ExitDate, Destination, LivingSituation, "
    f"RelationshipToHoH, CASE WHEN EntryDate < DATE '{SCHEMA_CHANGE_DATE}' THEN NULL ELSE DisablingCondition END "
    "AS DisablingCondition FROM enrollments", "enrollments"))
def schema_evolution_union(spark, sf_dir):
    """Two appends to one table; the second load adds DisablingCondition.

    Older files read the new column as NULL; the schema comes from the log
    beside the data, so no reader opens a footer to learn it."""
    e = Ctx(spark, sf_dir).raw.enrollments
    path = job_dir(spark, "bronze-enrollments")
    old = F.col("EntryDate") < F.lit(SCHEMA_CHANGE_DATE).cast("date")
    schema_log.append(e.filter(old).drop("DisablingCondition"), path)
    schema_log.append(e.filter(~old), path)
    return schema_log.read(spark, path)


@query("partition_overwrite_roundtrip", sql("SELECT * FROM fact", "fact"))
def partition_overwrite_roundtrip(spark, sf_dir):
    """Fact written partitioned by service_date, then the last 30 days rewritten
    with dynamic partition overwrite: only those partitions are replaced, so
    the read-back equals the fact (no loss, no doubles)."""
    f = Ctx(spark, sf_dir).fact
    path = job_dir(spark, "fact-partitioned")
    write_partitioned(f, path, "service_date", mode="errorifexists")
    last = latest_value(f, "service_date")
    write_partitioned(f.filter(F.col("service_date") > F.lit(last - dt.timedelta(days=30))), path,
                      "service_date", mode="overwrite")
    return spark.read.parquet(path).select(*f.columns)


@query("landing_to_lake", sql(
    "SELECT *, count(*) OVER () AS rows_written FROM silver_clients", "silver_clients"))
def landing_to_lake(spark, sf_dir):
    """Landing JSON -> hashed, PII-free clients -> Parquet partitioned by year of birth."""
    root = job_dir(spark, "landing")
    batch.write_seed(Ctx(spark, sf_dir).raw.clients, f"{root}/clients")
    n = batch.landing_to_lake(spark, f"{root}/clients", C.CLIENTS, f"{root}/lake",
                              conform.conform_clients, "YearOfBirth")
    lake = spark.read.parquet(f"{root}/lake")
    return lake.select(*conform.SILVER_CLIENT_COLS).withColumn("rows_written", F.lit(n).cast("bigint"))


@query("daily_extract", sql(
    "SELECT event_id, event_type, sha256(client_id) AS client_id_hash, project_id, bed_id, "
    "event_time AS updated_at, CAST(event_time AS DATE) AS extract_date FROM bed_events "
    "WHERE event_time >= CAST((SELECT max(CAST(event_time AS DATE)) FROM bed_events) AS TIMESTAMP) "
    "AND event_time < CAST((SELECT max(CAST(event_time AS DATE)) FROM bed_events) + 1 AS TIMESTAMP)",
    "bed_events"))
def daily_extract(spark, sf_dir):
    """Business-date slice of a source table into a date-partitioned extract.

    The slice is a half-open timestamp range, so it reaches the scan as a
    pushed filter; the load is replayed twice to show it is idempotent."""
    src = (Ctx(spark, sf_dir).raw.bed_events.withColumnRenamed("event_time", "updated_at")
           .withColumn("client_id_hash", F.sha2("client_id", 256)).drop("client_id"))
    day = latest_value(src, "updated_at").date()
    part = src.filter(day_range("updated_at", day.isoformat())).withColumn("extract_date", F.to_date("updated_at"))
    path = job_dir(spark, "extract-bed_events")
    for _ in range(2):
        write_partitioned(part, path, "extract_date")
    return spark.read.parquet(path).select("event_id", "event_type", "client_id_hash", "project_id",
                                           "bed_id", "updated_at", "extract_date")


@query("copy_by_name", sql(
    "SELECT service_id, client_id_hash, enrollment_id, project_id, CAST(NULL AS INTEGER) AS project_type, "
    "service_type, service_date, qty, financial_assistance FROM fact", "fact"))
def copy_by_name(spark, sf_dir):
    """Parquet whose columns are upper-cased and reordered, one missing and one
    extra, loaded onto the fact contract by case-insensitive name."""
    f = Ctx(spark, sf_dir).fact
    cols = [c for c in reversed(f.columns) if c != "project_type"]
    src = f.select(*[F.col(c).alias(c.upper()) for c in cols], F.lit("pipe").alias("_LOADED_BY"))
    path = job_dir(spark, "copy-stage")
    src.write.parquet(path)
    return batch.load_by_name(spark.read.parquet(path), C.FACT_SERVICE_EVENT)


@query("partition_discovery", sql(
    "SELECT CAST(event_time AS DATE) AS ingest_date, count(*) AS n_events, count(DISTINCT bed_id) AS n_beds "
    "FROM bed_events GROUP BY 1", "bed_events"))
def partition_discovery(spark, sf_dir):
    """Landing folders ingest_date=... registered as an external partitioned
    table; MSCK REPAIR discovers the partitions."""
    ev = Ctx(spark, sf_dir).raw.bed_events.withColumn("ingest_date", F.to_date("event_time"))
    path = job_dir(spark, "landing-bed_events")
    write_partitioned(ev, path, "ingest_date", mode="errorifexists")
    name = f"bed_events_landing_{uuid.uuid4().hex[:8]}"
    t = batch.register_partitioned_table(
        spark, name, path,
        "event_id STRING, event_type STRING, client_id STRING, project_id STRING, bed_id STRING, "
        "event_time TIMESTAMP, ingest_date DATE", "ingest_date")
    return t.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n_events"),
                                        F.count_distinct("bed_id").alias("n_beds"))
