"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint's 64 bits are given random non-zero codes of r + 1 bits.  For
each non-zero vector v of r + 1 bits one table keeps the fingerprint bits whose
code has odd product with v.  Whatever r or fewer bits two fingerprints differ
in, some v has even product with all of their codes, so the pair agrees on
everything that table keeps: all pairs within the radius meet, with certainty.

Fingerprints, not documents, are linked: equal ones are one node.  Inside a
bucket only a spanning forest of the links is emitted, never all pairs.

Defined cases: a null or empty text, or one without words, has fingerprint 0
and is linked like any other; a component's id is its least doc_id that is not
null (null if there is none); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loadlens.llm import textbuf as B
from loadlens.llm.common import cut, texts
from loadlens.llm.components import components

SHINGLE = 4
RADIUS = 4
HASH_SEED = 42
BIG = 20_000  # members of a bucket above which it is split by a second covering family


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text's word shingles, repeats included."""
    words = text.lower().split()  # of bytes: A-Z alone are lowered, and only 0x20 and 0x09 to 0x0D separate
    n = len(words) - shingle + 1
    if not words:
        return 0
    line = b" ".join(words)
    if n <= 1:
        return xxhash.xxh64_intdigest(line, HASH_SEED)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    digest = xxhash.xxh64_intdigest
    cuts = zip((end - length)[:n].tolist(), end[shingle - 1 :].tolist())
    hashes = np.fromiter((digest(line[a:b], HASH_SEED) for a, b in cuts), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 8192):
        part = hashes[i : i + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and its fingerprint (the 64 bits as a signed long)."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            data, offsets = B.raw(batch.column(1))
            whole = memoryview(data)
            marks = np.array([fingerprint(bytes(whole[a:b]), shingle) for a, b in zip(offsets[:-1], offsets[1:])], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks.view(np.int64))], names=["doc_id", "fp"])

    return texts(docs).mapInArrow(batches, "doc_id long, fp long")


def covering_masks(radius: int, seed: int = 8) -> list[int]:
    """2**(radius + 1) - 1 masks of 64 bits, as signed numbers; any pair within radius agrees under one."""
    size = 1 << (radius + 1)
    codes = np.arange(64) % (size - 1) + 1
    codes = np.random.default_rng(seed).permutation(codes)
    odd = np.bitwise_count(codes[None, :] & np.arange(1, size)[:, None]) % 2
    return [int(np.packbits(row.astype(np.uint8), bitorder="little").view("<i8")[0]) for row in odd]


def distance(a: np.ndarray, b) -> np.ndarray:
    """Differing bits; counted unsigned, as numpy counts those of a negative number's absolute value."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(marks: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what the links within radius connect: at most one less than there are marks.

    Breadth first; each step compares one mark with those not reached yet.
    """
    links, left = [], marks.copy()
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = distance(left, at) <= radius
            if near.any():
                reached = left[near]
                links += [(int(at), int(x)) for x in reached]
                front += list(reached)
                left = left[~near]
    return links


def bucket_links(marks: np.ndarray, radius: int, again: list[int]) -> list[tuple[int, int]]:
    """forest(), for a bucket of any size: a big one is split by a second covering family first."""
    if len(marks) <= BIG:
        return forest(marks, radius)
    links = []
    for mask in np.array(again, np.int64):
        keys = marks & mask
        order = np.argsort(keys, kind="stable")
        edges = np.flatnonzero(np.diff(keys[order])) + 1
        for part in np.split(marks[order], edges):
            if len(part) > 1:
                links += forest(part, radius)
    return links


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all pairs within radius."""
    masks, again = covering_masks(radius), covering_masks(radius, seed=80)
    table = F.explode(F.array(*[F.struct(F.lit(t).cast("short").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                                for t, m in enumerate(masks)])).alias("x")
    spread = fps.select("fp").distinct().select(table, "fp").select("x.t", "x.key", "fp")
    ordered = spread.repartition("t", "key").sortWithinPartitions("t", "key")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found):
            a, b = zip(*found)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        kept = [np.zeros(0, np.int64)] * 3  # the bucket that the last batch ended in
        for batch in source:
            t, key, fp = (np.concatenate([k, c.to_numpy().astype(np.int64)]) for k, c in zip(kept, batch.columns))
            edges = np.concatenate([[0], np.flatnonzero((np.diff(t) != 0) | (np.diff(key) != 0)) + 1])
            kept = [t[edges[-1] :], key[edges[-1] :], fp[edges[-1] :]]
            size = np.diff(edges)
            two = edges[:-1][size == 2]
            near = two[distance(fp[two], fp[two + 1]) <= radius]
            found = list(zip(fp[near].tolist(), fp[near + 1].tolist()))
            for a, n in zip(edges[:-1][size > 2], size[size > 2]):
                found += bucket_links(fp[a : a + n], radius, again)
            if found:
                yield out(found)
        if len(kept[2]) > 1 and (found := bucket_links(kept[2], radius, again)):
            yield out(found)

    return ordered.mapInArrow(batches, "a long, b long")


def groups(marks: DataFrame, radius: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of marks (doc_id, fp)."""
    least = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = cut(components(links(marks, radius)))
    linked = roots.join(least, roots["node"] == least["fp"]).select("fp", "root", "least")
    ids = linked.groupBy("root").agg(F.min("least").alias("cid"))
    return least.join(linked.join(ids, "root").select(F.col("fp").alias("node"), "root", "cid"), F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("cid")).alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    marks = cut(fingerprints(docs, shingle))
    of = cut(groups(marks, radius))  # read back with no partitioning of its own, so that a skewed join can be split
    return marks.join(of, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each group, every column kept: that of the least doc_id (any one of repeated rows)."""
    marks = cut(fingerprints(docs, shingle))
    of = cut(groups(marks, radius)).select(*(F.col(c).alias(f"__{c}") for c in ("fp", "root", "component_id")))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            data, offsets = B.raw(batch.column(batch.schema.get_field_index("text")))
            whole = memoryview(data)
            fps = np.array([fingerprint(bytes(whole[a:b]), shingle) for a, b in zip(offsets[:-1], offsets[1:])], np.uint64)
            yield batch.append_column("__fp", pa.array(fps.view(np.int64)))

    marked = docs.mapInArrow(batches, StructType([*docs.schema.fields, StructField("__fp", LongType())]))
    first = marked.join(of, "__fp").where(F.col("doc_id").cast("long").eqNullSafe(F.col("__component_id")))
    return first.dropDuplicates(["__root"]).select(*docs.columns)
