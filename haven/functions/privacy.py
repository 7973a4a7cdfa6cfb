"""Hashing, column masking and row scoping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haven import contracts as C


#: U+001F, the unit separator.
NAME_SEPARATOR = "\x1f"


def hash_id(col: str | Column, salt: str | None = None) -> Column:
    """SHA-256 lower hex of the text value; null stays null.

    Unsalted by default so ids join across batch and stream layers; a salt,
    when used, must be applied to every layer at once.
    """
    c = F.col(col) if isinstance(col, str) else col
    c = c.cast("string")
    if salt:
        c = F.concat(F.lit(salt), c)
    return F.sha2(c, 256)


def name_hash(first: str | Column, last: str | Column, salt: str | None = None) -> Column:
    """Hash of first and last name with a separator no name holds between them, so that
    two people's names never run together alike; null only when both parts are null."""
    f = F.col(first) if isinstance(first, str) else first
    la = F.col(last) if isinstance(last, str) else last
    return F.when(f.isNull() & la.isNull(), F.lit(None).cast("string")).otherwise(
        hash_id(F.concat(F.coalesce(f.cast("string"), F.lit("")), F.lit(NAME_SEPARATOR), F.coalesce(la.cast("string"), F.lit(""))), salt))


def packed(col: str | Column) -> Column:
    """A lower-hex hash as its bytes: half as long where rows are shuffled or grouped, in the same order."""
    return F.unhex(col)


def unpacked(col: str | Column) -> Column:
    """The lower-hex text of ``packed`` bytes."""
    return F.lower(F.hex(col))


def mask_for_role(col: str | Column, role: str) -> Column:
    """Column masking policy: full value, 8-char token, 'AGG' or NULL by role."""
    c = F.col(col) if isinstance(col, str) else col
    if role == C.ROLE_CASEWORKER:
        return c
    if role == C.ROLE_ANALYST:
        return F.concat(F.left(c, F.lit(8)), F.lit("..."))
    if role == C.ROLE_HUD:
        return F.lit("AGG")
    return F.lit(None).cast("string")


def hash_and_drop_client(df: DataFrame, col: str = "client_id", salt: str | None = None) -> DataFrame:
    """Hash + drop the id only where the schema carries it."""
    if col not in df.columns:
        return df
    return df.withColumn(f"{col}_hash", hash_id(col, salt)).drop(col)
