"""Commit markers of the ingest: points, records and the watermark become visible together.

A run writes its points and records under a batch name of its own and its
watermark snapshot into a folder of its own.  None of these counts until the
run has created one marker file, ``<watermark>/_commits/<number>.json``,
which names all of them.  The file is created whole or not at all, and only
if its number is free, so a run that stops anywhere before leaves nothing that
a reader takes, and of two runs that end at once the second merges its
watermark into the first one's and tries the next number.

Every output folder holds a pointer ``_log`` to the markers, written before
anything else, with the batches that lay there before the log began.  A run
name that is committed again replaces its earlier batch.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.sources.files import Folder

LOG, POINTER, DIGITS = "_commits", "_log", 12


@dataclass(frozen=True)
class Commit:
    number: int
    run: str | None                  # None: what lay there when the log began
    batch: str | None
    outputs: list[str] = field(default_factory=list)
    snapshot: str | None = None      # folder below the watermark table
    et_hr: int | None = None


def _name(number: int) -> str:
    return f"{LOG}/{number:0{DIGITS}d}.json"


def newest_folder(folder: Folder, column: str) -> int | None:
    """Greatest integer value of a partition column, by the folder names: no file is listed below them or opened."""
    values = [int(v) for v in folder.partition_values(column) if v.isdigit()]
    return max(values, default=None)


class IngestLog:
    """The commit markers beside one watermark table."""

    def __init__(self, spark: SparkSession, watermark_dir: str):
        self.spark, self.folder = spark, Folder(spark, watermark_dir)

    def numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.folder.names(LOG) if n.endswith(".json") and n[0].isdigit())

    def begun(self) -> bool:
        return bool(self.numbers())

    def read(self, number: int) -> Commit:
        return Commit(**json.loads(self.folder.read_text(_name(number))))

    def newest(self) -> Commit | None:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def commits(self) -> list[Commit]:
        """All commits in order: one small row for each run, read by Spark from the marker files."""
        schema = "number int, run string, batch string, outputs array<string>, snapshot string, et_hr int"
        rows = self.spark.read.schema(schema).option("mode", "FAILFAST").json(f"{self.folder.path}/{LOG}/[0-9]*.json").collect()
        return sorted((Commit(**r.asDict()) for r in rows), key=lambda c: c.number)

    def committed(self, run: str) -> bool:
        return any(c.run == run for c in self.commits())

    def start(self, outputs: list[str], et_hr: int | None) -> None:
        """Begin the log (with the snapshot ``et_hr`` that lay there) and point every output to it."""
        if not self.begun():
            first = Commit(0, None, None, [], None if et_hr is None else f"et_hr={et_hr}", et_hr)
            self.folder.write_new(_name(0), json.dumps(asdict(first)))
        for path in outputs:
            out = Folder(self.spark, path)
            if not out.exists(POINTER):
                out.write_new(POINTER, json.dumps({"watermark": self.folder.path, "before": out.partition_values("batch")}))
            there = json.loads(out.read_text(POINTER))["watermark"]
            if there != self.folder.path:
                raise ValueError(f"{path} is committed with the watermark {there}, not {self.folder.path}")

    def commit(self, run: str, batch: str, outputs: list[str], snapshot: str, et_hr: int, after: int) -> bool:
        """Create the marker that follows ``after``; False when another run took that number first."""
        marker = Commit(after + 1, run, batch, [Folder(self.spark, p).path for p in outputs], snapshot, et_hr)
        return self.folder.write_new(_name(after + 1), json.dumps(asdict(marker)))


def batch_name(run: str) -> str:
    """A batch of a run's own for each attempt."""
    return f"{run}~{uuid.uuid4().hex[:12]}"


def visible_batches(spark: SparkSession, path: str) -> list[str] | None:
    """Names of the committed batches of an output folder (one per run); None when it has no log.

    Each run name counts with its newest commit.
    """
    out = Folder(spark, path)
    if not out.exists(POINTER):
        return None
    pointer = json.loads(out.read_text(POINTER))
    runs = {name: name for name in pointer["before"]}
    for c in IngestLog(spark, pointer["watermark"]).commits():
        if c.run is not None and out.path in c.outputs:
            runs[c.run] = c.batch
    return list(runs.values())


def committed(df: DataFrame, path: str) -> DataFrame:
    """The rows of ``df``, read from ``path``, that belong to committed batches.

    ``batch`` is a partition column, so folders of other batches are not opened.
    """
    batches = visible_batches(df.sparkSession, path)
    if batches is None:
        return df
    return df.filter(F.col("batch").cast("string").isin(batches)) if batches else df.filter(F.lit(False))


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table as its readers see it: plain, written by ingest runs, or ``ser_id=`` folders of either kind."""
    folder = Folder(spark, path)
    if folder.exists(POINTER):
        return committed(spark.read.parquet(path), path)
    inner = [n for n in folder.names() if n.startswith("ser_id=") and folder.exists(f"{n}/{POINTER}")]
    if not inner:
        return spark.read.parquet(path)
    plain = [n for n in folder.names() if n.startswith("ser_id=") and n not in inner]
    parts = [committed(spark.read.option("basePath", path).parquet(f"{path}/{n}"), f"{path}/{n}") for n in inner]
    if plain:
        parts.append(spark.read.option("basePath", path).parquet(*[f"{path}/{n}" for n in plain]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def remove_abandoned(spark: SparkSession, path: str, older_than: float) -> list[str]:
    """Delete batches of an output folder that no commit names and that were last changed before ``older_than`` (epoch s).

    The age keeps the batches of runs that are still at work.
    """
    batches = visible_batches(spark, path)
    if batches is None:
        return []
    out = Folder(spark, path)
    gone = [v for v in out.partition_values("batch") if v not in batches and out.modified(f"batch={v}") < older_than]
    for v in gone:
        out.delete(f"batch={v}")
    return gone
