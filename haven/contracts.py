"""Table contracts (explicit StructTypes) and the domain's fixed values."""

from __future__ import annotations

from pyspark.sql.types import (DateType, DecimalType, DoubleType, IntegerType, StringType,
                               StructField, StructType, TimestampType)

MONEY = DecimalType(12, 2)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


def ddl(schema: StructType) -> str:
    """Schema as a DDL column list, e.g. for ``spark.read.schema``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


# --- raw (bronze) inputs -------------------------------------------------------
CLIENTS = _s(("ClientID", StringType()), ("FirstName", StringType()),
             ("LastName", StringType()), ("SSN", StringType()), ("DOB", DateType()),
             ("Gender", StringType()), ("Race", StringType()),
             ("Ethnicity", StringType()), ("VeteranStatus", IntegerType()),
             ("PersonalEmail", StringType()))

PROJECTS = _s(("ProjectID", StringType()), ("ProjectName", StringType()),
              ("ProjectType", IntegerType()), ("OperatingStartDate", DateType()),
              ("OrganizationID", StringType()), ("TargetPopulation", StringType()),
              ("Latitude", DoubleType()), ("Longitude", DoubleType()))

ENROLLMENTS = _s(("EnrollmentID", StringType()), ("PersonalID", StringType()),
                 ("ProjectID", StringType()), ("EntryDate", DateType()),
                 ("ExitDate", DateType()), ("Destination", StringType()),
                 ("LivingSituation", StringType()), ("RelationshipToHoH", StringType()),
                 ("DisablingCondition", IntegerType()))

SERVICES = _s(("ServiceID", StringType()), ("EnrollmentID", StringType()),
              ("PersonalID", StringType()), ("DateProvided", DateType()),
              ("ServiceType", StringType()), ("QuantityOfServices", IntegerType()),
              ("FAAmount", MONEY))

# --- stream topics ---------------------------------------------------------------
BED_EVENTS = _s(("event_id", StringType()), ("event_type", StringType()),
                ("client_id", StringType()), ("project_id", StringType()),
                ("bed_id", StringType()), ("event_time", TimestampType()))

OUTREACH = _s(("event_id", StringType()), ("zone", StringType()),
              ("client_id", StringType()), ("encounter_type", StringType()),
              ("needs", StringType()), ("lat", DoubleType()), ("lon", DoubleType()),
              ("event_time", TimestampType()))

CASE_UPDATES = _s(("event_id", StringType()), ("op", StringType()),
                  ("client_id", StringType()), ("enrollment_id", StringType()),
                  ("field_changed", StringType()), ("new_value", StringType()),
                  ("event_time", TimestampType()))

TOPICS = {
    "bed_events": BED_EVENTS,
    "outreach": OUTREACH,
    "case_updates": CASE_UPDATES,
}

# Common envelope of the raw event table.
EVENT_ENVELOPE = _s(("event_id", StringType()), ("event_type", StringType()),
                    ("client_id_hash", StringType()), ("project_id", StringType()),
                    ("event_time", TimestampType()), ("payload", StringType()))

# --- gold --------------------------------------------------------------------------
FACT_SERVICE_EVENT = _s(("service_id", StringType()), ("client_id_hash", StringType()),
                        ("enrollment_id", StringType()), ("project_id", StringType()),
                        ("project_type", IntegerType()), ("service_type", StringType()),
                        ("service_date", DateType()), ("qty", IntegerType()),
                        ("financial_assistance", MONEY))

# =====================================================================================
# FIXED VALUES — must equal the source domain's code lists for results to agree.
# =====================================================================================

# HMIS project type codes and descriptions (code 5 is not used).
PROJECT_TYPES = [
    (1, "Emergency Shelter"),
    (2, "Transitional Housing"),
    (3, "PH - Permanent Supportive Housing"),
    (4, "Street Outreach"),
    (6, "Services Only"),
    (7, "Other"),
    (8, "Safe Haven"),
    (9, "PH - Housing Only"),
    (10, "PH - Housing with Services"),
    (11, "Day Shelter"),
    (12, "Homelessness Prevention"),
    (13, "PH - Rapid Re-Housing"),
    (14, "Coordinated Entry"),
]

GENDERS = ["Female", "Male", "Trans Female", "Trans Male", "Gender non-conforming",
           "Client doesn't know", "Client refused"]
RACES = ["AmIndAKNative", "Asian", "BlackAfAmerican", "NativeHIPacific", "White",
         "Multiracial"]
ETHNICITIES = ["Hispanic/Latino", "Non-Hispanic"]
DESTINATIONS = ["Permanent housing", "Rental by client (no subsidy)", "Rental with subsidy",
                "Staying with family (permanent)", "Hotel/motel (no voucher)", "Emergency shelter",
                "Transitional housing", "Place not meant for habitation", "Deceased", "Other/unknown"]
LIVING_SITUATIONS = ["Place not meant for habitation", "Emergency shelter", "Safe Haven",
                     "Transitional housing", "Hospital", "Jail/prison", "Substance abuse facility",
                     "Psychiatric facility", "Hotel/motel (no voucher)", "Foster care",
                     "Staying with family", "Staying with friends", "Rental by client", "Owned by client"]
RELATIONSHIPS = ["Self", "Child", "Spouse", "Other"]
SERVICE_TYPES = ["Bed-night", "Meal", "Case management", "Clinic visit",
                 "Transportation", "Hygiene kit", "Mental health session",
                 "Housing search"]
TARGET_POPULATIONS = ["All", "Domestic violence", "Veterans", "Youth",
                      "Families with children"]
BED_EVENT_TYPES = ["CHECKIN", "CHECKOUT"]
ENCOUNTER_TYPES = ["NEW_CONTACT", "REPEAT_CONTACT", "REFERRAL_OFFERED", "REFERRAL_ACCEPTED"]
CASE_FIELDS = ["DisablingCondition", "HousingStatus", "IncomeAmount", "ContactStatus"]
CASE_OPS = ["c", "u"]
NEEDS_SETS = ['["food"]', '["medical","water"]', '["housing","hygiene","food"]']
CASE_VALUES = ["1", "0", "stable", "engaged", "lost_contact"]

# Destinations that count as a permanent exit.
PERMANENT_DESTINATIONS = ["Permanent housing", "Rental by client (no subsidy)", "Rental with subsidy",
                          "Staying with family (permanent)"]

# Raw personal data that must never leave bronze.
PII_COLUMNS = ["FirstName", "LastName", "SSN", "DOB", "PersonalEmail"]
FORBIDDEN_DOWNSTREAM = ["FirstName", "LastName", "SSN", "DOB", "PersonalEmail",
                        "PersonalID", "ClientID", "client_id"]

# Access roles of the masking policy.
ROLE_CASEWORKER = "R_HMIS_CASEWORKER"
ROLE_ANALYST = "R_HMIS_ANALYST"
ROLE_HUD = "R_HMIS_HUD_REPORTING"

# Tolerances.
RECONCILE_TOLERANCE = 0.01
WATERMARK_DELAY = "15 minutes"
MAX_OFFSETS_PER_TRIGGER = 5000
RETURN_WINDOW_DAYS = 180
