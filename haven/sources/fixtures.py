"""HMIS input tables derived from the benchmark's TPC-H-style tables.

The given data has no HMIS tables, so each HMIS input is a pure column mapping
of one (or, for services, two joined) given tables.  Everything is a lazy
DataFrame: the scans prune to the columns each query needs and filters reach
the Parquet reader.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haven import contracts as C


# The codes the mapped tables use, out of the published lists.
EXITS = ["Permanent housing", "Rental with subsidy", "Emergency shelter", "Other/unknown", "Transitional housing"]
LIVED = ["Place not meant for habitation", "Emergency shelter", "Staying with family", "Jail/prison"]


def pick(index: Column, values: list) -> Column:
    """values[index] as a JVM expression (0-based)."""
    return F.try_element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def padded(prefix: str, key: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))


def dec(text: str) -> Column:
    return F.lit(Decimal(text))


class Hmis:
    """Lazily built HMIS inputs over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A given table; how many splits it has is left to its files and
        ``spark.sql.files.maxPartitionBytes``, so a plan is the same on any machine."""
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def clients(self) -> DataFrame:
        c = self.table("customer")
        k = F.col("c_custkey")
        return c.select(
            padded("C", k, 8).alias("ClientID"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("FirstName"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("LastName"),
            F.lpad(k.cast("string"), 9, "0").alias("SSN"),
            F.date_add(F.lit("1945-01-01").cast("date"), ((k * 37) % 20000).cast("int")).alias("DOB"),
            pick(k % 7, C.GENDERS).alias("Gender"),
            pick(F.col("c_nationkey") % 6, C.RACES).alias("Race"),
            F.when(F.col("c_mktsegment").isin("HOUSEHOLD", "BUILDING"), "Hispanic/Latino")
             .otherwise("Non-Hispanic").alias("Ethnicity"),
            F.when(k % 10 == 0, 1).otherwise(0).alias("VeteranStatus"),
            F.concat(F.lower("c_name"), F.lit("@example.org")).alias("PersonalEmail"),
        )

    @cached_property
    def projects(self) -> DataFrame:
        n = F.col("n_nationkey")
        codes = [code for code, _ in C.PROJECT_TYPES]
        return self.table("nation").select(
            padded("P", n, 4).alias("ProjectID"),
            F.col("n_name").alias("ProjectName"),
            pick(n % 13, codes).cast("int").alias("ProjectType"),
            F.date_add(F.lit("1992-01-01").cast("date"), (n * 30).cast("int")).alias("OperatingStartDate"),
            padded("O", F.col("n_regionkey"), 3).alias("OrganizationID"),
            F.coalesce(pick(F.col("n_regionkey"), C.TARGET_POPULATIONS[:4]),
                       F.lit(C.TARGET_POPULATIONS[4])).alias("TargetPopulation"),
            (dec("33.6") + n * dec("0.0125")).cast("double").alias("Latitude"),
            (dec("-84.5") + n * dec("0.0125")).cast("double").alias("Longitude"),
        )

    @cached_property
    def enrollments(self) -> DataFrame:
        k = F.col("o_orderkey")
        status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
        entry = F.col("o_orderdate").cast("date")
        return self.table("orders").select(
            padded("E", k, 9).alias("EnrollmentID"),
            padded("C", F.col("o_custkey"), 8).alias("PersonalID"),
            F.when(k % 50 == 49, F.lit("P9999")).otherwise(padded("P", k % 25, 4)).alias("ProjectID"),
            entry.alias("EntryDate"),
            F.when(status != "O", F.date_add(entry, (1 + k % 180).cast("int"))).alias("ExitDate"),
            F.when(status == "O", F.lit(None).cast("string"))
             .when(prio == "1-URGENT", EXITS[0])
             .when(prio == "2-HIGH", EXITS[1])
             .when(prio == "3-MEDIUM", EXITS[2])
             .when(prio == "4-NOT SPECIFIED", EXITS[3])
             .otherwise(EXITS[4]).alias("Destination"),
            pick(k % 4, LIVED).alias("LivingSituation"),
            pick(k % 4, C.RELATIONSHIPS).alias("RelationshipToHoH"),
            F.when(k % 10 < 4, 1).otherwise(0).alias("DisablingCondition"),
        )

    @cached_property
    def services(self) -> DataFrame:
        """Services with their dedupe tie-break columns ``_tie1``, ``_tie2``."""
        li = self.table("lineitem")
        o = self.table("orders").select("o_orderkey", "o_custkey")  # the small, broadcast side
        k = F.col("l_orderkey")
        return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
            F.concat(padded("S", k, 9), F.col("l_linenumber").cast("string")).alias("ServiceID"),
            padded("E", k, 9).alias("EnrollmentID"),
            padded("C", F.col("o_custkey"), 8).alias("PersonalID"),
            F.col("l_shipdate").cast("date").alias("DateProvided"),
            pick(F.col("l_partkey") % 8, C.SERVICE_TYPES).alias("ServiceType"),
            F.col("l_quantity").cast("int").alias("QuantityOfServices"),
            F.col("l_extendedprice").cast(C.MONEY).alias("FAAmount"),
            F.col("l_partkey").alias("_tie1"),
            F.col("l_suppkey").alias("_tie2"),
        )

    def _events(self, *types: str) -> DataFrame:
        return self.table("events").filter(F.col("event_type").isin(*types))

    @cached_property
    def bed_events(self) -> DataFrame:
        e = F.col("event_id")
        return self._events("signup", "purchase").select(
            F.concat(F.lit("BE-"), e.cast("string")).alias("event_id"),
            F.when(F.col("event_type") == "signup", "CHECKIN").otherwise("CHECKOUT").alias("event_type"),
            padded("C", F.col("user_id"), 8).alias("client_id"),
            padded("P", e % 25, 4).alias("project_id"),
            padded("B", 1 + e % 500, 4).alias("bed_id"),
            F.col("ts").cast("timestamp").alias("event_time"),
        )

    @cached_property
    def outreach(self) -> DataFrame:
        e = F.col("event_id")
        return self._events("click", "view").select(
            F.concat(F.lit("OE-"), e.cast("string")).alias("event_id"),
            padded("Z", e % 20, 2).alias("zone"),
            F.when(e % 10 < 3, F.lit(None).cast("string"))
             .otherwise(padded("C", F.col("user_id"), 8)).alias("client_id"),
            F.when(F.col("event_type") == "click", "NEW_CONTACT").otherwise("REPEAT_CONTACT").alias("encounter_type"),
            pick(e % 3, C.NEEDS_SETS).alias("needs"),
            (dec("33.6") + (e % 300) * dec("0.001")).cast("double").alias("lat"),
            (dec("-84.5") + (e % 300) * dec("0.001")).cast("double").alias("lon"),
            F.col("ts").cast("timestamp").alias("event_time"),
        )

    @cached_property
    def case_updates(self) -> DataFrame:
        e = F.col("event_id")
        return self._events("error").select(
            F.concat(F.lit("CU-"), e.cast("string")).alias("event_id"),
            F.when(e % 10 == 0, "c").otherwise("u").alias("op"),
            padded("C", F.col("user_id"), 8).alias("client_id"),
            padded("E", e, 9).alias("enrollment_id"),
            pick(e % 4, C.CASE_FIELDS).alias("field_changed"),
            pick(e % 5, C.CASE_VALUES).alias("new_value"),
            F.col("ts").cast("timestamp").alias("event_time"),
        )

    @cached_property
    def project_types(self) -> DataFrame:
        return self.spark.createDataFrame(C.PROJECT_TYPES, "ProjectType int, ProjectTypeDesc string")

    @cached_property
    def grants(self) -> DataFrame:
        n = self.table("nation")
        return n.filter(F.col("n_regionkey") < 4).select(
            F.concat(F.lit("user_"), F.col("n_regionkey").cast("string")).alias("user_name"),
            padded("P", F.col("n_nationkey"), 4).alias("project_id"),
        )


def hmis(spark: SparkSession, sf_dir: str) -> Hmis:
    return Hmis(spark, sf_dir)
