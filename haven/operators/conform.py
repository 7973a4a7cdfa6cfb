"""Silver layer: conform types, hash personal ids, drop PII, dedupe by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haven.functions.dates import as_date
from haven.functions.privacy import hash_id, name_hash, packed, unpacked
from haven.operators.keys import first_by_key, first_by_key_dealt

SILVER_CLIENT_COLS = ["ClientID_hash", "SSN_hash", "Name_hash", "YearOfBirth",
                      "Gender", "Race", "Ethnicity", "VeteranStatus"]


def conform_clients(clients: DataFrame, salt: str | None = None) -> DataFrame:
    """Three hashes, year of birth; raw ClientID and all PII dropped."""
    dob = as_date(clients, "DOB")
    out = clients.select(
        hash_id("ClientID", salt).alias("ClientID_hash"),
        hash_id("SSN", salt).alias("SSN_hash"),
        name_hash("FirstName", "LastName", salt).alias("Name_hash"),
        F.year(dob).alias("YearOfBirth"),
        "Gender", "Race", "Ethnicity",
        F.col("VeteranStatus").cast("int").alias("VeteranStatus"),
    )
    return first_by_key(out.filter(F.col("ClientID_hash").isNotNull()), ["ClientID_hash"])


def conform_enrollments(enrollments: DataFrame, salt: str | None = None, first=first_by_key) -> DataFrame:
    """``first`` picks the row of an id, as ``keys.first_by_key`` does."""
    out = enrollments.select(
        "EnrollmentID", "ProjectID",
        as_date(enrollments, "EntryDate").alias("EntryDate"),
        as_date(enrollments, "ExitDate").alias("ExitDate"),
        "Destination", "LivingSituation", "RelationshipToHoH",
        F.col("DisablingCondition").cast("int").alias("DisablingCondition"),
        packed(hash_id("PersonalID", salt)).alias("PersonalID_hash"),
    )
    return first(out, ["EnrollmentID"], ["EntryDate"]).withColumn("PersonalID_hash", unpacked("PersonalID_hash"))


def conform_services(services: DataFrame, salt: str | None = None) -> DataFrame:
    """Dedupe on ServiceID, first by (_tie1, _tie2, DateProvided) when present."""
    ties = [c for c in ("_tie1", "_tie2") if c in services.columns]
    out = services.select(
        "ServiceID", "EnrollmentID",
        as_date(services, "DateProvided").alias("DateProvided"),
        "ServiceType",
        F.col("QuantityOfServices").try_cast("int").alias("QuantityOfServices"),
        F.col("FAAmount").try_cast("decimal(12,2)").alias("FAAmount"),
        packed(hash_id("PersonalID", salt)).alias("PersonalID_hash"),
        *ties,
    )
    one = first_by_key_dealt(out, "ServiceID", ties + ["DateProvided"]).drop(*ties)
    return one.withColumn("PersonalID_hash", unpacked("PersonalID_hash"))


def conform_projects(projects: DataFrame) -> DataFrame:
    """Projects are deduped too: appending bronze twice must not double facts."""
    out = projects.select(
        "ProjectID", "ProjectName", F.col("ProjectType").cast("int").alias("ProjectType"),
        as_date(projects, "OperatingStartDate").alias("OperatingStartDate"),
        "OrganizationID", "TargetPopulation",
        F.col("Latitude").cast("double").alias("Latitude"),
        F.col("Longitude").cast("double").alias("Longitude"),
    )
    return first_by_key(out, ["ProjectID"])
