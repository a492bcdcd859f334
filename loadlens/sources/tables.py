"""Parquet table access."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None when that path does not exist.

    Nothing else counts as "no table": an unreadable, empty or foreign folder
    fails, so a job never starts over because of a passing fault.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
