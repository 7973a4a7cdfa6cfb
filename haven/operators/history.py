"""Slowly changing client history (SCD2) from case-update change events, and
the as-of join of events onto that history.

Rules: ops 'c' and 'u' only; several updates of one field at the same
instant collapse to the last by event_id; an update equal to the field's
previous value is a no-op; versions are half-open [valid_from, valid_to).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haven import contracts as C
from haven.operators.keys import hex_key, last_by_key
from haven.operators.sequence import hot_splits, ordered_by_key

EPOCH = "1970-01-01 00:00:00"
FIELDS = C.CASE_FIELDS


def collapse(case_updates: DataFrame) -> DataFrame:
    """The change log: valid ops, one event per (client, field, instant),
    the last by event_id.  This (not the effective changes) is what a merge
    must keep, since a backdated event can turn a dropped no-op into a change."""
    cu = case_updates.filter(F.col("op").isin(*C.CASE_OPS)).select(
        "client_id_hash", "field_changed", "event_time", "event_id", "new_value", "op")
    return last_by_key(cu, ["client_id_hash", "field_changed", "event_time"], ["event_id"])


def effective(log: DataFrame) -> DataFrame:
    """Drop updates equal to the field's previous value."""
    keyed = ordered_by_key(log, ["client_id_hash", "field_changed"], ["event_time", "event_id"],
                           lag={"prev_value": "new_value"})
    return (keyed.filter(F.col("prev_value").isNull() | (F.col("prev_value") != F.col("new_value")))
            .select("client_id_hash", "field_changed", "new_value", "prev_value", "event_time", "event_id"))


def client_changes(case_updates: DataFrame) -> DataFrame:
    """Effective changes: (client_id_hash, field_changed, new_value, prev_value,
    event_time, event_id)."""
    return effective(collapse(case_updates))


def history_from_changes(base: DataFrame, changes: DataFrame) -> DataFrame:
    """Versions per client: a base row valid from the epoch, then one per instant
    with an effective change; case fields forward-filled.

    base: silver clients (ClientID_hash + attributes).  Changes of clients
    missing from base are left out (they have no dimension row to version).
    """
    attrs = base.select(F.col("ClientID_hash").alias("client_id_hash"),
                        F.col("Gender").alias("gender"), F.col("Race").alias("race"),
                        F.col("Ethnicity").alias("ethnicity"),
                        F.col("VeteranStatus").alias("veteran_status"),
                        F.col("YearOfBirth").alias("year_of_birth"))
    wide = changes.groupBy("client_id_hash", F.col("event_time").alias("valid_from")).agg(
        *[F.max(F.when(F.col("field_changed") == f, F.col("new_value"))).alias(f) for f in FIELDS])
    base_rows = attrs.select("client_id_hash", F.lit(EPOCH).cast("timestamp").alias("valid_from"),
                             *[F.lit(None).cast("string").alias(f) for f in FIELDS])
    versions = base_rows.unionByName(wide.join(attrs.select("client_id_hash"), "client_id_hash", "left_semi"))
    filled = ordered_by_key(versions, ["client_id_hash"], ["valid_from"], ffill=FIELDS,
                            lead={"valid_to": "valid_from"}, row_number="version")
    filled = filled.select("client_id_hash", "valid_from", *FIELDS, "valid_to",
                           F.col("version").cast("int").alias("version"))
    return with_version_key(filled.join(attrs, "client_id_hash", "inner")
                            .withColumn("is_current", F.col("valid_to").isNull()))


def scd2_history(base: DataFrame, case_updates: DataFrame) -> DataFrame:
    return history_from_changes(base, client_changes(case_updates))


def merge_history(history: DataFrame, log: DataFrame, base: DataFrame,
                  new_updates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fold a new batch of updates (possibly backdated) into a stored history.

    Only clients touched by the batch are rebuilt, from their stored change
    log plus the new events; every other client's versions are kept as-is.
    Returns (new_history, new_log).
    """
    touched = new_updates.select("client_id_hash").distinct()
    cols = ["client_id_hash", "field_changed", "event_time", "event_id", "new_value", "op"]
    replay = log.select(*cols).join(touched, "client_id_hash", "left_semi").unionByName(
        new_updates.select(*cols))
    touched_log = collapse(replay)
    touched_base = base.join(touched.withColumnRenamed("client_id_hash", "ClientID_hash"),
                             "ClientID_hash", "left_semi")
    rebuilt = history_from_changes(touched_base, effective(touched_log))
    kept = history.join(touched, "client_id_hash", "left_anti")
    new_log = log.select(*cols).join(touched, "client_id_hash", "left_anti").unionByName(touched_log)
    return kept.unionByName(rebuilt), new_log


def with_version_key(history: DataFrame) -> DataFrame:
    """The history with a surrogate key per version: the same client and start give the same key in every run."""
    start = F.unix_micros("valid_from").cast("string")
    return history.withColumn("client_version_key", hex_key(F.sha2(F.concat_ws("|", "client_id_hash", start), 256)))


def as_of_rows(history: DataFrame, ts) -> DataFrame:
    """The dimension as it stood at ``ts``: valid_from <= ts < valid_to."""
    t = F.lit(ts).cast("timestamp")
    return history.filter((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


def as_of_join(events: DataFrame, history: DataFrame, key: str = "client_id_hash",
               time_col: str = "event_time", carry: list[str] | None = None) -> DataFrame:
    """Attach to each event the history version valid at its time.

    Events and versions are merged into one time-ordered stream per key and
    the version columns are carried forward (last non-null), so no event is
    ever paired with more than its own version.  Versions sort before events
    at the same instant (valid_from is inclusive).  Events before the first
    version, or of unknown keys, are dropped.
    """
    carry = carry or ["version"]
    others = [c for c in events.columns if c != key]
    etypes = {f.name: f.dataType for f in events.schema.fields}
    v = history.select(key, F.col("valid_from").alias("_t"), F.lit(0).alias("_kind"),
                       F.struct(*carry).alias("_ver"),
                       *[F.lit(None).cast(etypes[c]).alias(c) for c in others])
    e = events.select(key, F.col(time_col).cast("timestamp").alias("_t"), F.lit(1).alias("_kind"),
                      F.lit(None).cast(v.schema["_ver"].dataType).alias("_ver"), *others)
    # every row needs a total order within the key: time, versions first, then event id
    merged = v.unionByName(e).withColumn("_cur", F.col("_ver")).withColumn(
        "_id", F.coalesce(F.col("event_id").cast("string"), F.lit("")))
    # events make a key hot; its versions follow its events' parts
    splits = hot_splits(e.select(key, "_t"), [key], "_t")
    filled = ordered_by_key(merged, [key], ["_t", "_kind", "_id"], ffill=["_cur"], splits=splits)
    return (filled.filter((F.col("_kind") == 1) & F.col("_cur").isNotNull())
            .select(key, *others, *[F.col(f"_cur.{c}").alias(c) for c in carry]))
