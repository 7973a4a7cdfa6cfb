"""Compose oracle SQL: ``sql(body, needs...)`` -> ``WITH <ctes> <body>``."""

from __future__ import annotations

from haven.plans.sql_inputs import INPUTS

# Silver and gold restated in SQL (window dedupe instead of our aggregate).
DERIVED = {
    "silver_services": (
        "SELECT ServiceID, EnrollmentID, DateProvided, ServiceType, QuantityOfServices, FAAmount, "
        "sha256(PersonalID) AS PersonalID_hash FROM (SELECT *, row_number() OVER "
        "(PARTITION BY ServiceID ORDER BY _tie1, _tie2, DateProvided) AS rn FROM services) t "
        "WHERE rn = 1"),
    "silver_enrollments": (
        "SELECT EnrollmentID, ProjectID, EntryDate, ExitDate, Destination, LivingSituation, "
        "RelationshipToHoH, DisablingCondition, sha256(PersonalID) AS PersonalID_hash FROM "
        "(SELECT *, row_number() OVER (PARTITION BY EnrollmentID ORDER BY EntryDate, ProjectID, "
        "PersonalID) AS rn FROM enrollments) t WHERE rn = 1"),
    "silver_projects": (
        "SELECT ProjectID, ProjectName, ProjectType, OperatingStartDate, OrganizationID, "
        "TargetPopulation, Latitude, Longitude FROM (SELECT *, row_number() OVER "
        "(PARTITION BY ProjectID ORDER BY ProjectName) AS rn FROM projects) t WHERE rn = 1"),
    "silver_clients": (
        "SELECT DISTINCT sha256(ClientID) AS ClientID_hash, sha256(SSN) AS SSN_hash, "
        "sha256(FirstName || chr(31) || LastName) AS Name_hash, CAST(year(DOB) AS INT) AS YearOfBirth, "
        "Gender, Race, Ethnicity, VeteranStatus FROM clients"),
    "fact": (
        "SELECT s.ServiceID AS service_id, s.PersonalID_hash AS client_id_hash, "
        "s.EnrollmentID AS enrollment_id, e.ProjectID AS project_id, p.ProjectType AS project_type, "
        "s.ServiceType AS service_type, s.DateProvided AS service_date, "
        "s.QuantityOfServices AS qty, s.FAAmount AS financial_assistance "
        "FROM silver_services s JOIN silver_enrollments e ON s.EnrollmentID = e.EnrollmentID "
        "LEFT JOIN silver_projects p ON e.ProjectID = p.ProjectID"),
}

DEPS = {
    "silver_services": ["services"],
    "silver_enrollments": ["enrollments"],
    "silver_projects": ["projects"],
    "silver_clients": ["clients"],
    "fact": ["silver_services", "silver_enrollments", "silver_projects"],
}


def _resolve(names: tuple[str, ...]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in DEPS.get(n, []):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def sql(body: str, *needs: str) -> str:
    ctes = []
    for n in _resolve(needs):
        text = INPUTS.get(n) or DERIVED[n]
        ctes.append(f"{n} AS ({text})")
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        # the body brings its own CTEs: append them after the inputs
        ctes.append(stripped[5:])
        return "WITH " + ",\n".join(ctes)
    head = ("WITH " + ",\n".join(ctes) + "\n") if ctes else ""
    return head + body
