"""Oracle-side SQL: the HMIS inputs as CTEs over the given tables.

The input mappings are dialect-neutral (Spark SQL and DuckDB); the silver and
gold CTEs restate the conform and star rules in plain SQL so each oracle query
is independent of the DataFrame code it checks.
"""

from __future__ import annotations

INPUTS = {
    "clients": (
        "SELECT 'C' || lpad(CAST(c_custkey AS STRING), 8, '0') AS ClientID, split_part(c_name, '#', 1) "
        "AS FirstName, split_part(c_name, '#', 2) AS LastName, lpad(CAST(c_custkey AS STRING), 9, '0') "
        "AS SSN, DATE '1945-01-01' + CAST((c_custkey * 37) % 20000 AS INT) AS DOB, CASE c_custkey % 7 "
        "WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' WHEN 2 THEN 'Trans Female' WHEN 3 THEN 'Trans Male' "
        "WHEN 4 THEN 'Gender non-conforming' WHEN 5 THEN 'Client doesn''t know' ELSE 'Client refused' "
        "END AS Gender, CASE c_nationkey % 6 WHEN 0 THEN 'AmIndAKNative' WHEN 1 THEN 'Asian' WHEN 2 "
        "THEN 'BlackAfAmerican' WHEN 3 THEN 'NativeHIPacific' WHEN 4 THEN 'White' ELSE 'Multiracial' "
        "END AS Race, CASE WHEN c_mktsegment IN ('HOUSEHOLD','BUILDING') THEN 'Hispanic/Latino' ELSE "
        "'Non-Hispanic' END AS Ethnicity, CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS "
        "VeteranStatus, lower(c_name) || '@example.org' AS PersonalEmail FROM customer"
    ),
    "projects": (
        "SELECT 'P' || lpad(CAST(n_nationkey AS STRING), 4, '0') AS ProjectID, n_name AS ProjectName, "
        'CAST(CASE n_nationkey % 13 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN '
        '6 WHEN 5 THEN 7 WHEN 6 THEN 8 WHEN 7 THEN 9 WHEN 8 THEN 10 WHEN 9 THEN 11 WHEN 10 THEN 12 WHEN '
        "11 THEN 13 ELSE 14 END AS INT) AS ProjectType, DATE '1992-01-01' + CAST(n_nationkey * 30 AS "
        "INT) AS OperatingStartDate, 'O' || lpad(CAST(n_regionkey AS STRING), 3, '0') AS "
        "OrganizationID, CASE n_regionkey WHEN 0 THEN 'All' WHEN 1 THEN 'Domestic violence' WHEN 2 THEN "
        "'Veterans' WHEN 3 THEN 'Youth' ELSE 'Families with children' END AS TargetPopulation, "
        'CAST(33.6 + n_nationkey * 0.0125 AS DOUBLE) AS Latitude, CAST(-84.5 + n_nationkey * 0.0125 AS '
        'DOUBLE) AS Longitude FROM nation'
    ),
    "enrollments": (
        "SELECT 'E' || lpad(CAST(o_orderkey AS STRING), 9, '0') AS EnrollmentID, 'C' || "
        "lpad(CAST(o_custkey AS STRING), 8, '0') AS PersonalID, CASE WHEN o_orderkey % 50 = 49 THEN "
        "'P9999' ELSE 'P' || lpad(CAST(o_orderkey % 25 AS STRING), 4, '0') END AS ProjectID, "
        "CAST(o_orderdate AS DATE) AS EntryDate, CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate "
        "AS DATE) + CAST(1 + o_orderkey % 180 AS INT) END AS ExitDate, CASE WHEN o_orderstatus = 'O' "
        "THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'Permanent housing' WHEN o_orderpriority = "
        "'2-HIGH' THEN 'Rental with subsidy' WHEN o_orderpriority = '3-MEDIUM' THEN 'Emergency shelter' "
        "WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Other/unknown' ELSE 'Transitional housing' END "
        "AS Destination, CASE o_orderkey % 4 WHEN 0 THEN 'Place not meant for habitation' WHEN 1 THEN "
        "'Emergency shelter' WHEN 2 THEN 'Staying with family' ELSE 'Jail/prison' END AS "
        "LivingSituation, CASE o_orderkey % 4 WHEN 0 THEN 'Self' WHEN 1 THEN 'Child' WHEN 2 THEN "
        "'Spouse' ELSE 'Other' END AS RelationshipToHoH, CASE WHEN o_orderkey % 10 < 4 THEN 1 ELSE 0 "
        'END AS DisablingCondition FROM orders'
    ),
    "services": (
        "SELECT 'S' || lpad(CAST(l_orderkey AS STRING), 9, '0') || CAST(l_linenumber AS STRING) AS "
        "ServiceID, 'E' || lpad(CAST(l_orderkey AS STRING), 9, '0') AS EnrollmentID, 'C' || "
        "lpad(CAST(o_custkey AS STRING), 8, '0') AS PersonalID, CAST(l_shipdate AS DATE) AS "
        "DateProvided, CASE l_partkey % 8 WHEN 0 THEN 'Bed-night' WHEN 1 THEN 'Meal' WHEN 2 THEN 'Case "
        "management' WHEN 3 THEN 'Clinic visit' WHEN 4 THEN 'Transportation' WHEN 5 THEN 'Hygiene kit' "
        "WHEN 6 THEN 'Mental health session' ELSE 'Housing search' END AS ServiceType, CAST(l_quantity "
        'AS INT) AS QuantityOfServices, CAST(l_extendedprice AS DECIMAL(12,2)) AS FAAmount, l_partkey '
        'AS _tie1, l_suppkey AS _tie2 FROM lineitem JOIN orders ON l_orderkey = o_orderkey'
    ),
    "bed_events": (
        "SELECT 'BE-' || CAST(event_id AS STRING) AS event_id, CASE event_type WHEN 'signup' THEN "
        "'CHECKIN' ELSE 'CHECKOUT' END AS event_type, 'C' || lpad(CAST(user_id AS STRING), 8, '0') AS "
        "client_id, 'P' || lpad(CAST(event_id % 25 AS STRING), 4, '0') AS project_id, 'B' || "
        "lpad(CAST(1 + event_id % 500 AS STRING), 4, '0') AS bed_id, CAST(ts AS TIMESTAMP) AS "
        "event_time FROM events WHERE event_type IN ('signup','purchase')"
    ),
    "outreach": (
        "SELECT 'OE-' || CAST(event_id AS STRING) AS event_id, 'Z' || lpad(CAST(event_id % 20 AS "
        "STRING), 2, '0') AS zone, CASE WHEN event_id % 10 < 3 THEN NULL ELSE 'C' || lpad(CAST(user_id "
        "AS STRING), 8, '0') END AS client_id, CASE event_type WHEN 'click' THEN 'NEW_CONTACT' ELSE "
        '\'REPEAT_CONTACT\' END AS encounter_type, CASE event_id % 3 WHEN 0 THEN \'["food"]\' WHEN 1 THEN '
        '\'["medical","water"]\' ELSE \'["housing","hygiene","food"]\' END AS needs, CAST(33.6 + (event_id '
        '% 300) * 0.001 AS DOUBLE) AS lat, CAST(-84.5 + (event_id % 300) * 0.001 AS DOUBLE) AS lon, '
        "CAST(ts AS TIMESTAMP) AS event_time FROM events WHERE event_type IN ('click','view')"
    ),
    "case_updates": (
        "SELECT 'CU-' || CAST(event_id AS STRING) AS event_id, CASE WHEN event_id % 10 = 0 THEN 'c' "
        "ELSE 'u' END AS op, 'C' || lpad(CAST(user_id AS STRING), 8, '0') AS client_id, 'E' || "
        "lpad(CAST(event_id AS STRING), 9, '0') AS enrollment_id, CASE event_id % 4 WHEN 0 THEN "
        "'DisablingCondition' WHEN 1 THEN 'HousingStatus' WHEN 2 THEN 'IncomeAmount' ELSE "
        "'ContactStatus' END AS field_changed, CASE event_id % 5 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 "
        "THEN 'stable' WHEN 3 THEN 'engaged' ELSE 'lost_contact' END AS new_value, CAST(ts AS "
        "TIMESTAMP) AS event_time FROM events WHERE event_type = 'error'"
    ),
    "project_types": (
        "SELECT ProjectType, ProjectTypeDesc FROM (VALUES (1,'Emergency Shelter'),(2,'Transitional "
        "Housing'),(3,'PH - Permanent Supportive Housing'),(4,'Street Outreach'),(6,'Services "
        "Only'),(7,'Other'),(8,'Safe Haven'),(9,'PH - Housing Only'),(10,'PH - Housing with "
        "Services'),(11,'Day Shelter'),(12,'Homelessness Prevention'),(13,'PH - Rapid "
        "Re-Housing'),(14,'Coordinated Entry')) AS t(ProjectType, ProjectTypeDesc)"
    ),
    "user_project_grants": (
        "SELECT 'user_' || CAST(n_regionkey AS STRING) AS user_name, 'P' || lpad(CAST(n_nationkey AS "
        "STRING), 4, '0') AS project_id FROM nation WHERE n_regionkey < 4"
    ),
}
