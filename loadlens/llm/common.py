"""Small helpers of the operators: inputs, run-time sizes, shared folder."""

from __future__ import annotations

import gc
import os
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def importable(docs: DataFrame) -> None:
    """Python workers that are not given this package's place by the cluster look for it where the driver has it."""
    docs.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, so that no other column's name can clash."""
    importable(docs)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the session's shared checkpoint folder and read it from there.

    A folder is set here only where the session names none, as in local tests.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The session's shared checkpoint folder."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
        context.setCheckpointDir(base)
    return spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs left: their shuffle files go once the driver has collected its garbage.

    Spark's listeners hold the last query they were told of, with its shuffles; so they are
    told of a small one first, which they hear of a little later.
    """
    gc.collect()
    spark.range(1).count()
    time.sleep(1)
    spark.sparkContext._jvm.System.gc()


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the decimal text of doc_id, modulo a small number."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def keep_rows(docs: DataFrame, judge: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows, every column kept, whose texts the judge keeps (a mask for each Arrow batch).

    The decision is taken row by row, so null or repeated doc_ids need no join.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            yield batch.filter(pa.array(judge(batch.column(batch.schema.get_field_index("text")))))

    importable(docs)
    return docs.mapInArrow(batches, docs.schema)
