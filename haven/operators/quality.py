"""Data quality, reconciliation and PII checks — each a single pass per table.

A suite is a list of ``Rule(name, column, bad)`` where ``bad`` is a boolean
column true for offending rows.  All scalar rules of one table are computed by
one aggregate (one scan), then unpivoted into one row per rule.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from haven import contracts as C
from haven.operators.keys import count_by_key

HEX64 = "^[a-f0-9]{64}$"
RAW_SSN = "^[0-9]{9}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$"
RAW_EMAIL = "^[^@ ]+@[^@ ]+[.][A-Za-z]+$"


class QualityError(RuntimeError):
    """A table failed a check that its job depends on."""


def require(results: DataFrame, name: str) -> None:
    """Stop the job unless every check passed: (rule, status) rows, or rows of a rule suite."""
    if "passed" in results.columns:
        results = results.select(F.concat_ws(" ", "rule", "column_name").alias("rule"),
                                 F.when(F.col("passed"), "OK").otherwise("FAIL").alias("status"))
    label = "rule" if "rule" in results.columns else results.columns[0]
    failed = results.filter("status <> 'OK' or status is null").select(F.col(label).cast("string")).collect()
    if failed:
        raise QualityError(f"{name}: " + ", ".join(sorted(str(r[0]) for r in failed)))


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    bad: Column | None = None      # row-level offence; None for a uniqueness rule
    unique: bool = False


def not_null(col: str) -> Rule:
    return Rule("not_null", col, F.col(col).isNull())


def matches(col: str, pattern: str) -> Rule:
    """Nulls pass, as in expectation suites."""
    return Rule("match_regex", col, F.col(col).isNotNull() & ~F.col(col).rlike(pattern))


def in_set(col: str, values: list) -> Rule:
    return Rule("in_set", col, F.col(col).isNotNull() & ~F.col(col).isin(*values))


def between(col: str, lo, hi) -> Rule:
    return Rule("between", col, F.col(col).isNotNull() & ~F.col(col).between(lo, hi))


def unique(col: str) -> Rule:
    return Rule("unique", col, unique=True)


def run_suite(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """(table_name, rule, column_name, n_rows, n_bad, passed) — one scan."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, r in enumerate(rules):
        if r.unique:
            # rows with a value minus distinct values = surplus copies
            aggs.append((F.count(r.column) - F.count_distinct(r.column)).alias(f"r{i}"))
        else:
            aggs.append(F.count_if(r.bad).alias(f"r{i}"))
    one = df.agg(*aggs)
    args = ", ".join(f"'{r.name}', '{r.column}', CAST(r{i} AS BIGINT)" for i, r in enumerate(rules))
    return one.select(
        F.lit(table).alias("table_name"),
        F.col("n_rows"),
        F.expr(f"stack({len(rules)}, {args}) AS (rule, column_name, n_bad)"),
    ).withColumn("passed", F.col("n_bad") == 0)


def fact_rules() -> list[Rule]:
    """Expectation suite of the gold fact (plus the mart's unique/not-null tests)."""
    return [
        not_null("service_id"), unique("service_id"), not_null("service_date"),
        not_null("client_id_hash"), not_null("project_id"),
        between("qty", 1, 100), between("financial_assistance", 0, 100000),
        matches("client_id_hash", HEX64),
    ]


def client_rules() -> list[Rule]:
    """Expectation suite of silver clients."""
    return [
        not_null("ClientID_hash"), unique("ClientID_hash"), matches("ClientID_hash", HEX64),
        not_null("SSN_hash"), matches("SSN_hash", HEX64), in_set("VeteranStatus", [0, 1]),
    ]


def bronze_rules() -> dict[str, list[Rule]]:
    """Shape checks of the raw inputs (ids, code lists, quantities)."""
    return {
        "clients": [not_null("ClientID"), unique("ClientID"), matches("ClientID", "^C[0-9]{8}$"),
                    in_set("VeteranStatus", [0, 1]), in_set("Gender", C.GENDERS), in_set("Race", C.RACES),
                    in_set("Ethnicity", C.ETHNICITIES)],
        "enrollments": [not_null("EnrollmentID"), unique("EnrollmentID"), not_null("PersonalID"),
                        in_set("Destination", C.DESTINATIONS), in_set("LivingSituation", C.LIVING_SITUATIONS),
                        in_set("RelationshipToHoH", C.RELATIONSHIPS)],
        "services": [not_null("ServiceID"), not_null("EnrollmentID"), between("QuantityOfServices", 1, 1_000_000),
                     in_set("ServiceType", C.SERVICE_TYPES)],
        "bed_events": [not_null("event_id"), unique("event_id"), in_set("event_type", C.BED_EVENT_TYPES)],
        "outreach": [not_null("event_id"), unique("event_id"), in_set("encounter_type", C.ENCOUNTER_TYPES)],
        "case_updates": [not_null("event_id"), unique("event_id"), in_set("op", C.CASE_OPS),
                         in_set("field_changed", C.CASE_FIELDS)],
    }


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str) -> DataFrame:
    """Non-null child keys with no parent row: (fk_name, key_value, n_rows)."""
    # a key's rows are counted where they lie: one row a key and task meets the parents, and an
    # anti join needs no distinct parents
    return (child.filter(F.col(fk).isNotNull())
            .groupBy(fk).agg(F.count(F.lit(1)).alias("n_rows"))
            .join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
            .select(F.lit(name).alias("fk_name"), F.col(fk).alias("key_value"), "n_rows"))


def duplicate_keys(df: DataFrame, key: str, table: str) -> DataFrame:
    """Keys held by more than one row: (table_name, key_value, n_copies)."""
    return (count_by_key(df, key, "n_copies")
            .filter(F.col("n_copies") > 1)
            .select(F.lit(table).alias("table_name"), F.col(key).alias("key_value"), "n_copies"))


def _raw_pii(v: Column) -> Column:
    """Whether a value looks like a raw SSN or email.  Each pattern is tried only where it can match:
    an SSN begins with a digit and is 9 to 14 bytes long with a line end, an email holds an @."""
    ssn = (v >= "0") & (v < ":") & F.octet_length(v).between(9, 14) & v.rlike(RAW_SSN)
    return ssn | (F.contains(v, F.lit("@")) & v.rlike(RAW_EMAIL))


def _pii_counts(df: DataFrame) -> tuple[list[str], list[Column]]:
    """The string columns, and per such column the count of values that look like raw personal data (p0, p1, ...)."""
    cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return cols, [F.count_if(_raw_pii(F.col(c))).alias(f"p{i}") for i, c in enumerate(cols)]


def pii_scan(df: DataFrame, table: str) -> DataFrame:
    """Per string column: forbidden name? values that look like raw SSN/email?

    One aggregate over the table; output (table_name, column_name,
    forbidden_name, n_rows, n_raw_pii).
    """
    cols, counts = _pii_counts(df)
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    args = ", ".join(
        f"'{c}', {str(c in C.FORBIDDEN_DOWNSTREAM).lower()}, CAST(p{i} AS BIGINT)"
        for i, c in enumerate(cols))
    return one.select(F.lit(table).alias("table_name"), "n_rows",
                      F.expr(f"stack({len(cols)}, {args}) AS (column_name, forbidden_name, n_raw_pii)"))


def reconcile_counts(table: str, bronze: DataFrame, key: str, silver: DataFrame,
                     tolerance: float = C.RECONCILE_TOLERANCE) -> DataFrame:
    """Bronze rows, bronze distinct keys, silver rows; drift on distinct keys.

    Raw duplicates are reported separately, so a re-run of an append-only
    bronze does not fail the gate by design.
    """
    silver_rows = silver.agg(F.count(F.lit(1))).scalar()
    b = bronze.agg(F.count(F.lit(1)).alias("bronze_rows"),
                   F.count_distinct(key).alias("bronze_keys"))
    drift = F.abs(F.col("bronze_keys") - F.col("silver_rows")) / F.greatest(F.col("bronze_keys"), F.lit(1))
    return (b.select(F.lit(table).alias("table_name"), "bronze_rows", "bronze_keys",
                     silver_rows.alias("silver_rows"))
            .withColumn("raw_duplicates", F.col("bronze_rows") - F.col("bronze_keys"))
            .withColumn("drift", F.round(drift, 6))
            .withColumn("status", F.when(F.col("drift") <= tolerance, "OK").otherwise("FAIL")))


#: Relative error of the mergeable key count that is taken while a layer is written.
KEY_COUNT_ERROR = 0.005


def observed_input(bronze: DataFrame, key: str) -> tuple[DataFrame, Observation]:
    """The input, counted as it flows into the layer's own write: rows and, by a
    mergeable sketch, distinct keys.  No second scan and no shuffle by key."""
    seen = Observation(f"input-{uuid.uuid4().hex[:8]}")
    return bronze.observe(seen, F.count(F.lit(1)).alias("bronze_rows"),
                          F.approx_count_distinct(key, KEY_COUNT_ERROR).alias("bronze_keys")), seen


def observed_gate(table: str, seen: Observation, silver: DataFrame, tolerance: float = C.RECONCILE_TOLERANCE) -> DataFrame:
    """(rule, status) of a silver table whose input was observed: its rows against
    the input's keys (the sketch's own error is allowed for), and personal data."""
    keys = seen.get["bronze_keys"]
    return _gate(silver, [], keys, tolerance + 4 * KEY_COUNT_ERROR)


def gold_gate(fact: DataFrame, services: DataFrame, tolerance: float = C.RECONCILE_TOLERANCE) -> DataFrame:
    """(rule, status) of the fact about to be published: one pass for the rules that
    every row must keep, its rows against silver's (counted from file footers), and
    personal data."""
    rules = [not_null("service_id"), not_null("enrollment_id"), matches("client_id_hash", HEX64)]
    return _gate(fact, rules, services.count(), tolerance)


def _gate(table: DataFrame, rules: list[Rule], rows: int, tolerance: float) -> DataFrame:
    """(rule, status) of row rules, the number of rows against an expected one, and personal data: one scan."""
    cols, counts = _pii_counts(table)
    one = table.agg(F.count(F.lit(1)).alias("n_rows"),
                    *[F.count_if(r.bad).alias(f"r{i}") for i, r in enumerate(rules)], *counts)
    drift = F.abs(F.lit(rows) - F.col("n_rows")) / max(rows, 1)
    passed = [(f"{r.name} {r.column}", F.col(f"r{i}") == 0) for i, r in enumerate(rules)]
    passed.append(("reconcile counts", drift <= tolerance))
    passed += [(f"personal data in {c}", F.lit(c not in C.FORBIDDEN_DOWNSTREAM) & (F.col(f"p{i}") == 0))
               for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.when(ok, "OK").otherwise("FAIL").alias("status")) for name, ok in passed])))


def silver_gate(table: str, bronze: DataFrame, key: str, silver: DataFrame) -> DataFrame:
    """(rule, status) of a silver table: its rows against the exact number of
    distinct keys of its input, and personal data in any string column."""
    counts = reconcile_counts(table, bronze, key, silver).select(F.lit("reconcile counts").alias("rule"), "status")
    return counts.unionByName(_leaks(table, silver))


def _leaks(table: str, silver: DataFrame) -> DataFrame:
    return pii_scan(silver, table).select(
        F.concat(F.lit("personal data in "), F.col("column_name")).alias("rule"),
        F.when(F.col("forbidden_name") | (F.col("n_raw_pii") > 0), "FAIL").otherwise("OK").alias("status"))


def checksum(df: DataFrame, side: str) -> DataFrame:
    """Order-free content checksum of a fact copy."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum("qty").cast("bigint").alias("total_qty"),
                  F.sum("financial_assistance").cast("decimal(18,2)").alias("total_fa"),
                  F.count_distinct("service_id").alias("n_keys"),
                  F.min("service_date").alias("min_date"),
                  F.max("service_date").alias("max_date")).select(F.lit(side).alias("side"), "*")


def content_checksum(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: count of rows and the sum of their hashes over ``columns``.  Order
    and partitioning don't matter; a changed value, or a value moved to another
    column, does.  Nulls are values (a null's place is hashed too)."""
    parts = [p for c in columns for p in (F.col(c).isNull(), F.col(c))]
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.coalesce(F.sum(F.xxhash64(*parts).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("content"))


def reconcile_copies(lake: DataFrame, copy: DataFrame,
                     tolerance: float = C.RECONCILE_TOLERANCE) -> DataFrame:
    lake_rows = lake.agg(F.count(F.lit(1))).scalar()
    both = checksum(lake, "lake").unionByName(checksum(copy, "warehouse"))
    drift = F.abs(F.col("n_rows") - lake_rows) / F.greatest(lake_rows, F.lit(1))
    return (both.withColumn("drift", F.round(drift, 6))
            .withColumn("status", F.when(F.col("drift") <= tolerance, "OK").otherwise("FAIL")))
