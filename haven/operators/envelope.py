"""Common raw-event envelope over the three topics, and the dead-letter split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haven.functions.events import first_present, is_json_object
from haven.functions.privacy import hash_id

ENVELOPE_COLS = ["event_id", "event_type", "client_id_hash", "project_id", "event_time",
                 "payload"]

PAYLOAD_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def payload_json(df: DataFrame, drop: tuple[str, ...] = ("client_id",)) -> F.Column:
    """Raw payload as JSON text with every field as a string, ids redacted."""
    fields = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        c = F.col(f.name)
        if f.name == "event_time":
            c = F.date_format(c, PAYLOAD_TIME_FORMAT)
        fields.append(c.cast("string").alias(f.name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def to_envelope(df: DataFrame) -> DataFrame:
    """event_type falls back to encounter_type (empty string counts as missing)."""
    cols = df.columns
    present = [c for c in ("event_type", "encounter_type") if c in cols]
    etype = first_present(*present) if present else F.lit(None).cast("string")
    return df.select(
        F.col("event_id"),
        etype.alias("event_type"),
        (hash_id("client_id") if "client_id" in cols else F.lit(None).cast("string")).alias("client_id_hash"),
        (F.col("project_id") if "project_id" in cols else F.lit(None).cast("string")).alias("project_id"),
        F.col("event_time").cast("timestamp").alias("event_time"),
        payload_json(df).alias("payload"),
    )


def union_envelopes(*topics: DataFrame) -> DataFrame:
    out = None
    for t in topics:
        e = to_envelope(t)
        out = e if out is None else out.unionByName(e)
    return out


def split_dead_letters(raw: DataFrame, text_col: str = "raw", required: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, dead) by whether the text is valid UTF-8 and a JSON object, with a
    value in the field ``required`` where one is named.

    ``from_json`` alone would turn junk into an all-NULL row; the dead side keeps
    the raw text and the reason so nothing is lost.
    """
    utf8 = F.is_valid_utf8(F.col(text_col))
    obj = is_json_object(F.col(text_col))
    reason = (F.when(~utf8, "invalid_utf8")
              .when(F.col(text_col).isNull() | F.trim(F.col(text_col)).eqNullSafe(""), "empty")
              .when(F.try_parse_json(F.col(text_col)).isNull(), "malformed_json")
              .when(~obj, "not_an_object"))
    if required:
        reason = reason.when(F.get_json_object(text_col, f"$.{required}").isNull(), f"no_{required}")
    tagged = raw.withColumn("_reason", reason)
    good = tagged.filter(F.col("_reason").isNull()).drop("_reason")
    dead = tagged.filter(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return good, dead
