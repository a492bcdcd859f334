"""Per-user watermark snapshots (user_id, commited_at) partitioned by et_hr."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.operators.commits import Commit, IngestLog, newest_folder
from loadlens.sources.files import Folder
from loadlens.sources.tables import read_if_exists


def latest_snapshot(history: DataFrame) -> DataFrame:
    """Rows of the newest ``et_hr`` partition, distinct.

    The newest partition id is a one-row aggregate; joining on it lets a
    partitioned table prune every other partition at run time.
    """
    newest = history.agg(F.max("et_hr").alias("et_hr"))
    return history.join(newest, "et_hr", "left_semi").select("user_id", "commited_at").distinct()


def merge_watermarks(new: DataFrame, old: DataFrame) -> DataFrame:
    """The greatest commited_at per user of both sides.

    Users absent from ``new`` carry over, and a payload that lands late can
    not take a user's watermark back, which would ingest a span twice.
    """
    both = new.select("user_id", "commited_at").unionByName(old.select("user_id", "commited_at"))
    return both.groupBy("user_id").agg(F.max("commited_at").alias("commited_at"))


def write_snapshot(df: DataFrame, path: str, et_hr: int) -> None:
    """Write one snapshot into its own et_hr partition (dynamic overwrite).

    Written by as many tasks as the input has partitions: the snapshot has
    one row per user and is not funnelled through a single task.
    """
    (df.select("user_id", "commited_at", F.lit(et_hr).cast("int").alias("et_hr"))
     .hint("rebalance", "et_hr").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("et_hr").parquet(path))


def newest_partition(history: DataFrame, col: str = "et_hr") -> int | None:
    """Largest value of a partition column.

    Only that column is read, which Spark takes from the folder names: no data
    column is opened and no file list is brought to the driver.
    """
    return history.agg(F.max(col)).first()[0]


def plain_newest(spark: SparkSession, path: str) -> int | None:
    """The newest et_hr of a snapshot table, by its folder names; None when ``path`` does not exist or is empty."""
    newest = newest_folder(Folder(spark, path), "et_hr")
    if newest is None:
        t = read_if_exists(spark, path)    # anything but a snapshot table fails here
        newest = None if t is None else newest_partition(t)
    return newest


def read_latest_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame, int] | None:
    """The newest snapshot and its et_hr; None when there is none.

    With commit markers it is the one that the newest marker names, otherwise
    the greatest et_hr folder.  Only that folder is listed and read.
    """
    last = IngestLog(spark, path).newest()
    if last is None:
        newest = plain_newest(spark, path)
        last = None if newest is None else Commit(0, None, None, [], f"et_hr={newest}", newest)
    t = None if last is None else read_snapshot(spark, path, last)
    return None if t is None else (t, last.et_hr)


def read_snapshot(spark: SparkSession, path: str, commit: Commit) -> DataFrame | None:
    """The snapshot that a commit names; None when it names none."""
    if commit.snapshot is None:
        return None
    return spark.read.parquet(f"{path.rstrip('/')}/{commit.snapshot}").select("user_id", "commited_at").distinct()


def stage_snapshot(df: DataFrame, path: str, et_hr: int) -> str:
    """Write a snapshot into a folder of its own below its et_hr; returns the folder, for a commit marker to name."""
    folder = f"et_hr={et_hr}/snap={uuid.uuid4().hex}"
    df.select("user_id", "commited_at").hint("rebalance").write.parquet(f"{path.rstrip('/')}/{folder}")
    return folder
