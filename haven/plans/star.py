"""Silver conform and gold star-schema queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from haven.operators import star
from haven.plans.context import Ctx
from haven.plans.oracle_base import sql
from haven.plans.registry import query


@query("silver_clients", sql("SELECT * FROM silver_clients", "silver_clients"))
def silver_clients(spark, sf_dir):
    return Ctx(spark, sf_dir).silver_clients


@query("silver_enrollments", sql("SELECT * FROM silver_enrollments", "silver_enrollments"))
def silver_enrollments(spark, sf_dir):
    return Ctx(spark, sf_dir).silver_enrollments


@query("silver_services", sql("SELECT * FROM silver_services", "silver_services"))
def silver_services(spark, sf_dir):
    return Ctx(spark, sf_dir).silver_services


@query("silver_projects", sql("SELECT * FROM silver_projects", "silver_projects"))
def silver_projects(spark, sf_dir):
    return Ctx(spark, sf_dir).silver_projects


@query("fact_service_event", sql("SELECT * FROM fact", "fact"))
def fact_service_event(spark, sf_dir):
    return Ctx(spark, sf_dir).fact


@query("fact_orphan_projects", sql(
    "SELECT project_id, CAST(count(*) AS BIGINT) AS n_services, "
    "CAST(count(DISTINCT enrollment_id) AS BIGINT) AS n_enrollments "
    "FROM fact WHERE project_type IS NULL GROUP BY project_id", "fact"))
def fact_orphan_projects(spark, sf_dir):
    """Services whose enrollment points at a project missing from dim_project."""
    f = Ctx(spark, sf_dir).fact
    return (f.filter(F.col("project_type").isNull())
            .groupBy("project_id")
            .agg(F.count(F.lit(1)).alias("n_services"),
                 F.count_distinct("enrollment_id").alias("n_enrollments")))


@query("top5_project_types", sql(
    "SELECT project_type, CAST(sum(qty) AS BIGINT) AS total_qty FROM fact "
    "WHERE project_type IS NOT NULL GROUP BY project_type "
    "ORDER BY total_qty DESC, project_type LIMIT 5", "fact"))
def top5_project_types(spark, sf_dir):
    """Top-5 program types by services delivered (the limit is the feature)."""
    f = Ctx(spark, sf_dir).fact
    return (f.filter(F.col("project_type").isNotNull())
            .groupBy("project_type").agg(F.sum("qty").cast("bigint").alias("total_qty"))
            .orderBy(F.desc("total_qty"), F.asc("project_type")).limit(5))


@query("dim_project", sql(
    "SELECT p.ProjectID AS project_id, p.ProjectName AS project_name, "
    "p.ProjectType AS project_type, t.ProjectTypeDesc AS project_type_desc, "
    "p.OrganizationID AS organization_id, p.TargetPopulation AS target_population, "
    "p.Latitude AS latitude, p.Longitude AS longitude, "
    "CAST(row_number() OVER (ORDER BY p.ProjectID) - 1 AS BIGINT) AS project_key "
    "FROM silver_projects p LEFT JOIN project_types t ON p.ProjectType = t.ProjectType",
    "silver_projects", "project_types"))
def dim_project(spark, sf_dir):
    ctx = Ctx(spark, sf_dir)
    return star.dim_project(ctx.silver_projects, ctx.raw.project_types)


@query("dim_client", sql(
    "SELECT ClientID_hash AS client_id_hash, Gender AS gender, Race AS race, "
    "Ethnicity AS ethnicity, VeteranStatus AS veteran_status, YearOfBirth AS year_of_birth, "
    "CAST(('0x' || substr(ClientID_hash, 1, 15)) AS BIGINT) AS client_key, "
    "TIMESTAMP '1970-01-01 00:00:00' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, "
    "TRUE AS is_current FROM silver_clients", "silver_clients"))
def dim_client(spark, sf_dir):
    return star.dim_client(Ctx(spark, sf_dir).silver_clients)


_CAL = ("CAST(strftime(service_date, '%Y%m%d') AS INT) AS date_key, "
        "CAST(year(service_date) AS INT) AS year, CAST(quarter(service_date) AS INT) AS quarter, "
        "CAST(month(service_date) AS INT) AS month, CAST(day(service_date) AS INT) AS day")


@query("dim_date", sql(
    f"SELECT service_date, {_CAL} FROM (SELECT DISTINCT service_date FROM fact "
    "WHERE service_date IS NOT NULL) d", "fact"))
def dim_date(spark, sf_dir):
    return star.dim_date(Ctx(spark, sf_dir).fact)


@query("dim_date_dense", sql(
    f"SELECT service_date, {_CAL} FROM (SELECT CAST(unnest(generate_series(min(service_date), "
    "max(service_date), INTERVAL 1 DAY)) AS DATE) AS service_date FROM fact) d", "fact"))
def dim_date_dense(spark, sf_dir):
    return star.dim_date_dense(Ctx(spark, sf_dir).fact)


@query("dim_program_type", sql(
    "SELECT t.ProjectType AS project_type, t.ProjectTypeDesc AS project_type_desc, "
    "CAST(count(p.ProjectID) AS BIGINT) AS n_projects FROM project_types t "
    "LEFT JOIN silver_projects p ON p.ProjectType = t.ProjectType "
    "GROUP BY t.ProjectType, t.ProjectTypeDesc", "project_types", "silver_projects"))
def dim_program_type(spark, sf_dir):
    """Program-type lookup with how many projects of the given data use each code."""
    ctx = Ctx(spark, sf_dir)
    counts = ctx.silver_projects.groupBy("ProjectType").agg(F.count(F.lit(1)).alias("n"))
    return (star.dim_program_type(ctx.raw.project_types)
            .join(counts, F.col("project_type") == F.col("ProjectType"), "left")
            .select("project_type", "project_type_desc",
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n_projects")))
