"""Partitioned sinks and schema-enforced re-loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.operators.commits import committed


def write_partitioned_json(df: DataFrame, path: str, partition_cols=("ser_id", "partition")) -> None:
    """JSON lines under ``ser_id=/partition=`` folders.

    Rows are rebalanced by folder first, so a folder gets a few files of even
    size (more when it is large) instead of one from every task.
    """
    df.hint("rebalance", *partition_cols).write.mode("overwrite").partitionBy(*partition_cols).json(path)


def write_partitioned_text(df: DataFrame, text_col: str, path: str,
                           partition_cols=("ser_id", "partition")) -> None:
    (df.select(text_col, *partition_cols).hint("rebalance", *partition_cols)
     .write.mode("overwrite").partitionBy(*partition_cols).text(path))


def _checked(value: Column, dtype: T.DataType, path: str) -> Column:
    """The value, or an error that names the level, where a required field is missing in it."""
    if isinstance(dtype, T.ArrayType):
        return F.when(value.isNotNull(), F.transform(value, lambda x: _checked(x, dtype.elementType, f"{path}[]")))
    if not isinstance(dtype, T.StructType):
        return value
    fields = []
    for f in dtype.fields:
        field, name = value[f.name], f"{path}.{f.name}".lstrip(".")
        if not f.nullable and not isinstance(f.dataType, T.ArrayType):  # a repeated field may be absent
            field = F.when(field.isNull(), F.raise_error(F.lit(f"required field is missing: {name}")).cast(f.dataType)).otherwise(field)
        fields.append(_checked(field, f.dataType, name).alias(f.name))
    return F.when(value.isNotNull(), F.struct(*fields))


def with_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows whose required (non-nullable) fields are there on every level; any other row fails the job.

    Readers give every field of a file as nullable, so the check is a step of its own.
    """
    record = F.struct(*[F.col(f.name) for f in schema.fields])
    others = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(_checked(record, schema, "").alias("_r"), *others).select("_r.*", *others)


def load_with_schema(spark: SparkSession, path: str, schema: T.StructType,
                     partition_cols: dict | None = None) -> DataFrame:
    """Re-read JSON text with a declared schema; malformed records and missing required fields fail the job.

    ``partition_cols`` maps partition column names to types so that folder
    values are not type-inferred.
    """
    full = T.StructType(list(schema.fields))
    for name, dtype in (partition_cols or {}).items():
        full = full.add(name, dtype, True)
    rows = spark.read.schema(full).option("mode", "FAILFAST").json(path)
    # records of ingest runs count once their run is committed
    return with_required(committed(rows, path) if "batch" in full.fieldNames() else rows, schema)


def _missing(value: Column, dtype: T.DataType, path: str) -> Column:
    """Name of the first required field that is missing in the value, on any level; null when none is."""
    if isinstance(dtype, T.ArrayType):
        return F.get(F.filter(F.transform(value, lambda x: _missing(x, dtype.elementType, f"{path}[]")), lambda x: x.isNotNull()), F.lit(0))
    if not isinstance(dtype, T.StructType):
        return F.lit(None).cast("string")
    found = []
    for f in dtype.fields:
        field, name = value[f.name], f"{path}.{f.name}".lstrip(".")
        if not f.nullable and not isinstance(f.dataType, T.ArrayType):  # a repeated field may be absent
            found.append(F.when(value.isNotNull() & field.isNull(), F.lit(name)))
        if isinstance(f.dataType, (T.ArrayType, T.StructType)):
            found.append(_missing(field, f.dataType, name))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def parse_with_reasons(spark: SparkSession, path: str, schema: T.StructType, partition_cols: dict | None = None) -> DataFrame:
    """One row per non-blank JSON line: the schema's fields, ``partition_cols``, ``_text``, ``_file`` and ``_reason``.

    ``_reason`` is null for a good record, else what is wrong with it.
    """
    folders = T.StructType([T.StructField("value", T.StringType())])
    for name, dtype in (partition_cols or {}).items():
        folders = folders.add(name, dtype, True)
    lines = spark.read.schema(folders).text(path).select("*", F.col("_metadata.file_path").alias("_file")).filter(F.trim("value") != "")
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = lines.withColumn("_r", F.from_json("value", full, options))
    missing = _missing(F.col("_r"), schema, "")
    reason = (F.when(F.col("_r").isNull() | F.col("_r._bad").isNotNull(), F.lit("malformed record"))
              .when(missing.isNotNull(), F.concat(F.lit("required field is missing: "), missing)))
    return parsed.select(*[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields], *(partition_cols or {}), F.col("value").alias("_text"),
                         "_file", reason.alias("_reason"))


class TooManyRejected(Exception):
    """The rejected share of a load is over its limit; the rejected rows are in quarantine, the table is untouched."""


def load_with_quarantine(spark: SparkSession, path: str, schema: T.StructType, table: str, quarantine: str,
                         partition_cols: dict | None = None, most_share: float = 0.01, partition_col: str = "partition") -> tuple[int, int]:
    """Load the good records into ``table`` and put the others, with reason and file, into ``quarantine``; returns both counts.

    Two passes over the text and nothing held in between: the first writes the
    rejected rows and counts all of them on the way, the second writes the good
    ones, unless more than ``most_share`` of the records were rejected, which
    fails the load before the table is touched.
    """
    from pyspark.sql import Observation

    rows = parse_with_reasons(spark, path, schema, partition_cols)
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("all"), F.count("_reason").alias("rejected"))
    (counted.filter(F.col("_reason").isNotNull()).select("_text", "_reason", "_file", *(partition_cols or {}))
     .write.mode("overwrite").parquet(quarantine))
    n, rejected = seen.get["all"], seen.get["rejected"]
    if rejected > most_share * n:
        raise TooManyRejected(f"{rejected} of {n} records rejected, over the limit of {most_share:.2%}; see {quarantine}")
    good = rows.filter(F.col("_reason").isNull()).drop("_text", "_file", "_reason")
    load_into_table(good, table, partition_col)
    return n - rejected, rejected


def load_into_table(df: DataFrame, path: str, partition_col: str = "partition") -> None:
    """Write a loaded dataset as parquet, one folder per day partition."""
    (df.hint("rebalance", partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
