"""Metric cell store with versioned upserts, partitioned by month, family, label day and run.

A cell is (user_id, app_type_id, ymd, family, col, value, version).  The
newest version per key wins; of equal versions the greatest value.  The
reduction is ``max(struct(version, value))``, never a sort of a key's versions.

Any number of writers may work at once: ``append_cells`` writes a run folder of
its own and reads nothing, readers take the newest cell of all runs, and
``compact_store`` merges the runs of a label day into one.  A run folder is
written once and never changed, so compaction removes exactly what it has
read, and as reading newest cells twice changes nothing, a reader, a writer
or a second compaction at the same time loses and doubles nothing.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions.keys import row_key
from loadlens.functions.time import yyyymm
from loadlens.session import shared_dir
from loadlens.sources.files import Folder
from loadlens.sources.tables import read_if_exists

CELL_KEY = ["user_id", "app_type_id", "ymd", "family", "col"]


def latest_cells(cells: DataFrame) -> DataFrame:
    """Newest (value, version) per cell key."""
    best = cells.groupBy(*CELL_KEY).agg(F.max(F.struct("version", "value")).alias("b"))
    return best.select(*CELL_KEY, F.col("b.value").alias("value"), F.col("b.version").alias("version"))


def upsert(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    cols = CELL_KEY + ["value", "version"]
    return latest_cells(existing.select(*cols).unionByName(incoming.select(*cols)))


def lookup_cells(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """Newest cell for every requested key (an equi-join, not point reads)."""
    return latest_cells(cells.join(keys.distinct(), [c for c in keys.columns], "left_semi"))


def with_row_key(cells: DataFrame) -> DataFrame:
    return cells.withColumn("row_key", row_key("user_id", "ymd", "app_type_id"))


def with_month(cells: DataFrame) -> DataFrame:
    return cells.withColumn("yyyymm", yyyymm("ymd"))


DAY_FOLDER = ["yyyymm", "family", "ymd"]
PARTITION = [*DAY_FOLDER, "run"]
SUPERSEDED = "_superseded"


def _raw(spark: SparkSession, path: str) -> DataFrame | None:
    """The cells of all runs, or None when ``path`` does not exist; ymd is a long, whatever the folders suggest."""
    t = read_if_exists(spark, path)
    if t is None:
        return None
    if "run" not in t.columns and "ymd" in t.columns:
        raise ValueError(f"{path} has no run folders; write its cells into a new store with convert_store")
    return t.withColumn("ymd", F.col("ymd").cast("long"))


def stored_cells(spark: SparkSession, path: str, parts: int | None = None) -> DataFrame | None:
    """The newest cell of every key and its yyyymm, or None when ``path`` does not exist.

    Rows are dealt by (user, type) once, to ``parts`` partitions when given; the reduction and what callers group
    or window by these keys need no further exchange.  Filters on month,
    family, day and column reach the scan.
    """
    t = _raw(spark, path)
    if t is None:
        return None
    by_key = t.repartition(*([] if parts is None else [parts]), "user_id", "app_type_id")
    best = (by_key.groupBy(*CELL_KEY, "yyyymm")
            .agg(F.max(F.struct("version", "value")).alias("b")))
    return best.select(*CELL_KEY, F.col("b.value").alias("value"), F.col("b.version").alias("version"), "yyyymm")


def _of_months(cells: DataFrame, months: list[int] | None) -> DataFrame:
    """The cells with their month; a cell of a month that the caller may not write fails the job."""
    inc = with_month(latest_cells(cells.select(*CELL_KEY, "value", "version")))
    if months is None:
        return inc
    allowed = F.col("yyyymm").isin([int(m) for m in months])
    message = F.concat(F.lit("cell of a month that this run may not write: "), F.col("yyyymm").cast("string"))
    return inc.withColumn("yyyymm", F.when(allowed, F.col("yyyymm")).otherwise(F.raise_error(message).cast("int")))


def _write(cells: DataFrame, path: str, run: str) -> None:
    """Dynamic overwrite works in a staging folder of its own, so writers do not see each other's unfinished files."""
    (cells.withColumn("run", F.lit(run)).hint("rebalance", *DAY_FOLDER).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION).parquet(path))


def append_cells(spark: SparkSession, path: str, incoming: DataFrame, months: list[int] | None = None) -> str:
    """Add cells as a run of its own; returns the run's name.

    Nothing that is stored is read or replaced, so jobs may write the same
    family and day at once.  A run that fails while its folders are being moved into
    place may leave some of its cells; running it again with a newer version settles them.
    """
    run = f"r{uuid.uuid4().hex}"
    _write(_of_months(incoming, months), path, run)
    return run


def _day_runs(t: DataFrame, months: list[int] | None) -> dict[tuple, list[str]]:
    """Names of the run folders of each (month, family, day): partition columns only, no data column is read."""
    some = t if months is None else t.filter(F.col("yyyymm").isin([int(m) for m in months]))
    out: dict[tuple, list[str]] = {}
    for r in some.select(*PARTITION).distinct().collect():
        out.setdefault((r["yyyymm"], r["family"], r["ymd"]), []).append(r["run"])
    return out


def compact_store(spark: SparkSession, path: str, months: list[int] | None = None, grace: float = 3600.0) -> int:
    """Merge the runs of every label day that has several into one run; returns how many days were merged.

    The merged run is written first.  The folders it replaces are then named in
    a marker, and those named at least ``grace`` seconds ago are removed, so
    readers that began before can finish.
    """
    t = _raw(spark, path)
    days = {} if t is None else {k: v for k, v in _day_runs(t, months).items() if len(v) > 1}
    superseded = named_superseded(spark, path)
    days = {k: v for k, v in days.items() if len([r for r in v if _folder(k, r) not in superseded]) > 1}
    if days:
        ids = spark.createDataFrame([(*k, r) for k, runs in days.items() for r in runs], "yyyymm int, family string, ymd long, run string")
        chosen = t.join(ids, PARTITION, "left_semi")
        run = f"c{uuid.uuid4().hex}"
        _write(with_month(latest_cells(chosen)), path, run)
        gone = [_folder(k, r) for k, runs in days.items() for r in runs]
        Folder(spark, path).write_new(f"{SUPERSEDED}/{run}.json", json.dumps(gone))
    remove_superseded(spark, path, time.time() - grace)
    return len(days)


def _folder(day: tuple, run: str) -> str:
    return f"yyyymm={day[0]}/family={day[1]}/ymd={day[2]}/run={run}"


def named_superseded(spark: SparkSession, path: str) -> set[str]:
    """Run folders that wait to be removed."""
    folder = Folder(spark, path)
    markers = [n for n in folder.names(SUPERSEDED) if n.endswith(".json")]
    return {f for n in markers for f in json.loads(folder.read_text(f"{SUPERSEDED}/{n}"))}


def remove_superseded(spark: SparkSession, path: str, before: float) -> int:
    """Remove the run folders that markers older than ``before`` (epoch s) name, then the markers."""
    folder, removed = Folder(spark, path), 0
    for name in folder.names(SUPERSEDED):
        marker = f"{SUPERSEDED}/{name}"
        if name.endswith(".json") and folder.modified(marker) <= before:
            for f in json.loads(folder.read_text(marker)):
                removed += folder.delete(f)
            folder.delete(marker)
    return removed


COVERED = "_covered"


def mark_covered(spark: SparkSession, path: str, kind: str, lo: int, hi: int) -> None:
    """Note that the cells of ``kind`` are complete for the data days lo..hi, by the name of an empty marker file."""
    Folder(spark, path).write_new(f"{COVERED}/{kind}.{lo}.{hi}", "")


def covered_spans(spark: SparkSession, path: str, kind: str) -> list[tuple[int, int]]:
    """The (first, last) data days of every marker of ``kind``, sorted."""
    return sorted((int(a), int(b)) for k, a, b in (n.split(".") for n in Folder(spark, path).names(COVERED) if not n.startswith((".", "_"))) if k == kind)


def spans_cover(spans: list[tuple[int, int]], lo: int, hi: int) -> bool:
    for a, b in sorted(spans):
        if a <= lo <= b:
            lo = b + 1
    return lo > hi


def is_covered(spark: SparkSession, path: str, kind: str, lo: int, hi: int) -> bool:
    """Whether markers cover every data day of lo..hi, so that a day without cells is known to be an idle one."""
    return spans_cover(covered_spans(spark, path, kind), lo, hi)


def convert_store(spark: SparkSession, old: str, new: str) -> None:
    """Write the cells of a store without run folders into a new one."""
    append_cells(spark, new, read_if_exists(spark, old).withColumn("ymd", F.col("ymd").cast("long")))


def upsert_table(spark: SparkSession, path: str, incoming: DataFrame, months: list[int] | None = None) -> None:
    """Merge ``incoming`` into the table at ``path`` in place, as its only writer.

    Only the label days that ``incoming`` has cells for are read and replaced;
    all other files stay as they are.  ``months`` is what the caller may
    write: a cell of any other month fails the job before anything is written.
    The (month, family, day) ids -- one per label day and family -- semi-join
    the stored table on its partition columns, so Spark prunes the scan at run
    time.  The merged cells are checkpointed in the shared folder before the
    dynamic partition overwrite, so the write never reads what it replaces.
    Jobs that may run beside others use ``append_cells``.
    """
    shared_dir(spark)   # checkpoint() below needs the shared checkpoint folder
    inc = _of_months(incoming, months).checkpoint(eager=True)
    existing = _raw(spark, path)
    if existing is not None:
        touched = inc.select(*DAY_FOLDER).distinct()
        kept = existing.select(*CELL_KEY, "value", "version", "yyyymm").join(touched, DAY_FOLDER, "left_semi")
        # partition folders lose a column's type: take the incoming ones
        kept = kept.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in inc.schema.fields if f.name != "yyyymm"])
        inc = with_month(upsert(kept, inc)).checkpoint(eager=True)
    _write(inc, path, "merged")
