"""Gold star schema: fact_service_event and its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haven.functions.dates import date_key
from haven.functions.privacy import packed, unpacked
from haven.operators.keys import dense_key, hex_key


def fact_service_event(services: DataFrame, enrollments: DataFrame,
                       projects: DataFrame) -> DataFrame:
    """services ⋈ enrollments (inner) ⟕ projects.

    The project id comes from the enrollment, so a service of an unknown
    project keeps its id (with a NULL type) and shows up in the FK check.
    """
    e = enrollments.select("EnrollmentID", "ProjectID")
    p = projects.select("ProjectID", "ProjectType")
    services = services.withColumn("PersonalID_hash", packed("PersonalID_hash"))
    return (services.join(e, "EnrollmentID", "inner")
            .join(p, "ProjectID", "left")
            .select(F.col("ServiceID").alias("service_id"),
                    unpacked("PersonalID_hash").alias("client_id_hash"),
                    F.col("EnrollmentID").alias("enrollment_id"),
                    F.col("ProjectID").alias("project_id"),
                    F.col("ProjectType").alias("project_type"),
                    F.col("ServiceType").alias("service_type"),
                    F.col("DateProvided").alias("service_date"),
                    F.col("QuantityOfServices").cast("int").alias("qty"),
                    F.col("FAAmount").cast("decimal(12,2)").alias("financial_assistance")))


def dim_project(projects: DataFrame, project_types: DataFrame) -> DataFrame:
    """Projects with type description and a dense key in ProjectID order."""
    d = (projects.join(project_types, "ProjectType", "left")
         .select(F.col("ProjectID").alias("project_id"),
                 F.col("ProjectName").alias("project_name"),
                 F.col("ProjectType").alias("project_type"),
                 F.col("ProjectTypeDesc").alias("project_type_desc"),
                 F.col("OrganizationID").alias("organization_id"),
                 F.col("TargetPopulation").alias("target_population"),
                 F.col("Latitude").alias("latitude"),
                 F.col("Longitude").alias("longitude")))
    return dense_key(d, ["project_id"], "project_key")


def dim_client(silver_clients: DataFrame, as_of: str = "1970-01-01 00:00:00") -> DataFrame:
    """Snapshot client dimension with SCD2 columns; stable content key."""
    return silver_clients.select(
        F.col("ClientID_hash").alias("client_id_hash"),
        F.col("Gender").alias("gender"), F.col("Race").alias("race"),
        F.col("Ethnicity").alias("ethnicity"),
        F.col("VeteranStatus").alias("veteran_status"),
        F.col("YearOfBirth").alias("year_of_birth"),
        hex_key("ClientID_hash").alias("client_key"),
        F.lit(as_of).cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def calendar_columns(df: DataFrame, col: str = "service_date") -> DataFrame:
    return df.select(col,
                     date_key(col).alias("date_key"),
                     F.year(col).alias("year"),
                     F.quarter(col).alias("quarter"),
                     F.month(col).alias("month"),
                     F.dayofmonth(col).alias("day"))


def dim_date(fact: DataFrame) -> DataFrame:
    """Distinct non-null service dates (no gaps filled)."""
    d = fact.select("service_date").filter(F.col("service_date").isNotNull()).distinct()
    return calendar_columns(d)


def dim_date_dense(fact: DataFrame) -> DataFrame:
    """Every day between the first and last service date."""
    bounds = fact.agg(F.min("service_date").alias("lo"), F.max("service_date").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("service_date"))
    return calendar_columns(days)


def dim_program_type(project_types: DataFrame) -> DataFrame:
    return project_types.select(F.col("ProjectType").alias("project_type"),
                                F.col("ProjectTypeDesc").alias("project_type_desc"))
