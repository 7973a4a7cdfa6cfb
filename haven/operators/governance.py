"""Column masking and row access applied by the query layer.

Role and user are explicit arguments (the session's identity), not ambient
state, so the same plan can be checked for every role.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haven import contracts as C
from haven.functions.privacy import mask_for_role


def mask(df: DataFrame, role: str, col: str = "client_id_hash") -> DataFrame:
    return df.withColumn(col, mask_for_role(col, role))


def scope(df: DataFrame, grants: DataFrame, user: str, role: str,
          project_col: str = "project_id") -> DataFrame:
    """HUD reporting sees every row; any other role only its granted projects.

    A user with no grants gets an empty result, not an error.
    """
    if role == C.ROLE_HUD:
        return df
    mine = (grants.filter(F.col("user_name") == F.lit(user))
            .select(F.col("project_id").alias(project_col)).distinct())
    return df.join(mine, project_col, "left_semi")


def secure_view(df: DataFrame, grants: DataFrame, user: str, role: str) -> DataFrame:
    """Row scope, then column mask — both policies of the fact table."""
    return mask(scope(df, grants, user, role), role)
