"""User registry: (user, is_active)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def registry_from_customer(customer: DataFrame) -> DataFrame:
    """Registry view of a customer table: user = '<nation>_<custkey>'."""
    return customer.select(
        F.concat(F.col("c_nationkey").cast("string"), F.lit("_"),
                 F.col("c_custkey").cast("string")).alias("user"),
        (F.col("c_acctbal") > 0).cast("int").alias("is_active"),
    )


def read_registry_jdbc(spark: SparkSession, url: str, table: str, id_column: str,
                       lower: int, upper: int, num_partitions: int = 5,
                       properties: dict | None = None) -> DataFrame:
    """Partitioned JDBC scan of the registry (parallel range reads on ``id_column``)."""
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("partitionColumn", id_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()
