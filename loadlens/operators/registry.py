"""Registry filters and the user x appliance-type grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.keys import provider_id


def active_users(registry: DataFrame) -> DataFrame:
    return registry.filter(F.col("is_active") == 1).select("user")


def users_with_provider(registry: DataFrame, allowed: DataFrame) -> DataFrame:
    """Active users with ser_id = provider prefix, kept when ser_id is allowed.

    ``allowed`` has one column ``ser_id``; it is a semi join, so Spark picks
    a broadcast only when the allow-list is measured small.
    """
    users = active_users(registry).select("user", provider_id("user").alias("ser_id"))
    return users.join(allowed.select("ser_id").distinct(), "ser_id", "left_semi")


def user_app_grid(users: DataFrame, app_types: list[str], user_col: str = "user") -> DataFrame:
    """Every user paired with every configured type (a generator, not a join)."""
    return users.select(F.col(user_col).alias("user_id"), F.explode(F.lit(list(app_types))).alias("app_type_id"))
