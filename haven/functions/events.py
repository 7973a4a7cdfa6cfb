"""Event envelope, JSON validity and field fallbacks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_present(*cols: str | Column) -> Column:
    """First value that is neither NULL nor the empty string."""
    return F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cols])


def is_json_object(text: Column) -> Column:
    """True only for text that parses to a JSON object (not scalar, array or junk)."""
    return F.json_object_keys(text).isNotNull()
