"""Vector code compression by member-resident Lloyd.

A vector's components become integers floor(scale * x) and are cut into equal
consecutive parts; each part position has a codebook of at most ``entries``
rows, and a vector's code is the index of the nearest row at each position.

The codebooks are found by Lloyd rounds over resident members.  Equal parts
are folded into one member with a weight, so no group of copies is larger than
one row.  Members live in partitions by (position, entry, salt), an entry
having as many salts as its weight asks for.  In a round every owner adds up
its own members where they lie; the codebooks, of bounded size, are renewed
from these sums; then every owner looks for its members' nearest entry, keeps
those that stay, and only members that change entry go into the next shuffle.
Stays and arrivals share a partitioner, so their union moves nothing.

What stays between rounds is cached on the executors with its lineage back to
the table, and let go when the next round stands; a lost executor's members
are computed again.  The driver holds codebooks and entry sums alone.

Defined cases: rows whose vector is null, or holds a null, a NaN, an infinite
component or one of magnitude RANGE / scale or more (whose squares fit no long)
are dropped, as are those whose length is not the commonest one of the rest
(of equally common lengths, the longest); a length that the parts do not divide
is cut short to the next multiple by leaving the last components out; null
vec_ids count as the largest; among equal vec_ids the lesser vector comes first;
repeated rows each get a row; null labels form one group; an empty table gives
no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import cut, importable

#: Components after scaling are below this in magnitude, so a part of up to 128 of them has a distance below 2^63.
RANGE = 2**27
#: Rows whose distances to all entries are held at a time.
STEP = 4096
#: Bytes of members that a task gathers by owner before it sends them on.
GATHER_BYTES = 32 << 20
#: Partitions that add up the owners' sums.
SUM_PARTS = 16


@dataclass(frozen=True)
class Codebooks:
    """``rows[p]`` is the (entries, width) integer codebook of position p."""

    rows: tuple[np.ndarray, ...]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for book in self.rows for x in book.ravel().tolist()).encode()).hexdigest()


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest entry (ties: the lower), and the squared distance."""
    index, error = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    if not len(parts) or not book.shape[1]:
        return index, error
    book = book.astype(np.int64)
    norms = (book * book).sum(1)
    # sums of products below 2^53 are exact in doubles, for which numpy multiplies matrices fast
    most = float(np.abs(parts).max()) + float(np.abs(book).max())
    exact = book.shape[1] * most * most < 2.0**53
    for a in range(0, len(parts), STEP):
        p = parts[a:a + STEP].astype(np.int64)
        if exact:
            cross = (p.astype(np.float64) @ book.T.astype(np.float64)).astype(np.int64)
        else:
            cross = p @ book.T
        d = norms[None, :] - 2 * cross
        best = d.argmin(1)
        index[a:a + STEP] = best
        error[a:a + STEP] = d[np.arange(len(p)), best] + (p * p).sum(1)
    return index, error


def integers(source: DataFrame, scale: int) -> DataFrame:
    """vec_id, label, ints of the rows that are kept, whatever their length."""
    importable(source)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            vectors = batch.column(2)
            lengths = np.diff(vectors.offsets.to_numpy()).astype(np.int64)
            flat = vectors.flatten()
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(all="ignore"):
                scaled = np.floor(values * scale)
                bad = ~(np.abs(scaled) < RANGE)   # NaN, nulls and infinities too
            has = np.add.reduceat(np.append(bad, False).astype(np.int64), np.append(0, np.cumsum(lengths))[:-1]) if len(lengths) else lengths
            keep = (np.asarray(vectors.is_valid()) & ((has == 0) | (lengths == 0)))
            scaled[bad] = 0
            ints = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(scaled.astype(np.int32)))
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ints], names=["vec_id", "label", "ints"])
            yield out.filter(pa.array(keep))

    rows = source.select(source["vec_id"].cast("long").alias("vec_id"), source["label"].cast("long").alias("label"),
                         source["embedding"].cast("array<double>").alias("embedding"))
    return rows.mapInArrow(batches, "vec_id long, label long, ints array<int>")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a list column as rows, all of them at least ``width`` long."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))[:, :width]


def distinct_parts(kept: DataFrame, parts: int, width: int) -> DataFrame:
    """position, part (int32 bytes), weight of every different part, and a hash of the part."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            values = matrix(batch.column(0), parts * width).astype("<i4")
            raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * width), len(values) * parts, [None, pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(parts, dtype=np.int32), len(values))), raw], names=["position", "part"])

    cut_up = kept.select("ints").mapInArrow(batches, "position int, part binary")
    return cut_up.groupBy("position", "part").agg(F.count(F.lit(1)).alias("weight")).withColumn("h", F.xxhash64("part"))


class Gather:
    """Members by owner, sent on as blocks (weights, hashes, parts) whenever enough are held."""

    def __init__(self):
        self.held, self.size = {}, 0

    def add(self, owners: np.ndarray, weights: np.ndarray, hashes: np.ndarray, members: np.ndarray):
        order = np.argsort(owners, kind="stable")
        at = np.flatnonzero(np.diff(owners[order], prepend=-1))
        for own, rows in zip(owners[order][at], np.split(order, at[1:])):
            self.held.setdefault(int(own), []).append((weights[rows], hashes[rows], members[rows]))
        self.size += members.nbytes + weights.nbytes + hashes.nbytes

    def blocks(self, all_of_them: bool = False):
        if self.size >= GATHER_BYTES or all_of_them:
            for own, pieces in self.held.items():
                yield own, tuple(np.concatenate(x) for x in zip(*pieces))
            self.held, self.size = {}, 0


@dataclass(frozen=True)
class Owners:
    """Owner numbers: each (position, entry) has a run of as many numbers as it has salts."""

    first: np.ndarray
    salts: np.ndarray
    entries: int

    def of(self, position, entry, hashes):
        slot = position * self.entries + entry
        return self.first[slot] + hashes.astype(np.uint64).astype(np.int64) % self.salts[slot]

    def slot(self, owner: int) -> int:
        return int(np.searchsorted(self.first, owner, side="right")) - 1


def owners_for(weights: np.ndarray, entries: int, partitions: int) -> Owners:
    """As many salts for a slot as keep an owner below a quarter of an even partition."""
    target = max(1, int(weights.sum()) // max(1, 4 * partitions))
    salts = np.maximum(1, -(-weights // target)).astype(np.int64)
    return Owners(np.cumsum(salts) - salts, salts, entries)


def first_members(members: DataFrame, books: Codebooks, width: int) -> np.ndarray:
    """Distinct members of each (position, entry) under the first codebooks."""
    entries, slots = len(books.rows[0]), len(books.rows) * len(books.rows[0])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int64)
        for batch in rows:
            position, parts = batch.column(0).to_numpy(), members_of(batch.column(1), width)
            for p in np.unique(position):
                total += np.bincount(p * entries + nearest(parts[position == p], books.rows[p])[0], minlength=slots)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["slot", "n"])

    out = np.zeros(slots, np.int64)
    for r in members.select("position", "part").mapInArrow(batches, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        out[r["slot"]] = r["n"]
    return out


def members_of(column: pa.Array, width: int) -> np.ndarray:
    """Parts of int32 bytes as rows."""
    flat = np.frombuffer(b"".join(column.to_pylist()), "<i4")
    return flat.reshape(len(column), width)


def settle(members: DataFrame, books: Codebooks, owners: Owners, width: int, partitions: int) -> RDD:
    """The first residents: every member at an owner of its nearest entry."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gather = Gather()

        def out(everything):
            done = [(own, w.tobytes(), h.tobytes(), m.tobytes()) for own, (w, h, m) in gather.blocks(everything)]
            if done:
                own, w, h, m = zip(*done)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), *(pa.array(x, pa.binary()) for x in (w, h, m))], names=["owner", "w", "h", "m"])

        for batch in rows:
            position, parts = batch.column(0).to_numpy(), members_of(batch.column(1), width)
            weights, hashes = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for p in np.unique(position):
                here = position == p
                entry = nearest(parts[here], books.rows[p])[0]
                gather.add(owners.of(p, entry, hashes[here]), weights[here], hashes[here], parts[here])
            yield from out(False)
        yield from out(True)

    def block(row):
        return row["owner"], (np.frombuffer(row["w"], "<i8"), np.frombuffer(row["h"], "<i8"), np.frombuffer(row["m"], "<i4").reshape(-1, width))

    packed = members.select("position", "part", "weight", "h").mapInArrow(batches, "owner long, w binary, h binary, m binary")
    return packed.rdd.map(block).partitionBy(partitions, plain)


def plain(owner: int) -> int:
    """Owners are dealt in turn, so the salts of one entry lie in different partitions."""
    return owner


def migrate(residents: RDD, books: Codebooks, owners: Owners, partitions: int) -> tuple[RDD, RDD]:
    """What a round's owners hold (stays, and leavers with their destination), and the next residents.

    Leavers are gathered by destination over a whole partition, under any key of it.
    """

    def look(rows):
        gather, here = Gather(), None
        for own, (weights, hashes, members) in rows:
            here = own
            slot = owners.slot(own)
            position, entry = divmod(slot, owners.entries)
            best = nearest(members, books.rows[position])[0]
            stay = best == entry
            if stay.any():
                yield own, (None, weights[stay], hashes[stay], members[stay])
            if not stay.all():
                go = ~stay
                gather.add(owners.of(position, best[go], hashes[go]), weights[go], hashes[go], members[go])
                for to, block in gather.blocks():
                    yield here, (to, *block)
        for to, block in gather.blocks(True):
            yield here, (to, *block)

    tagged = residents.mapPartitions(look, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
    stays = tagged.filter(lambda x: x[1][0] is None).mapValues(lambda v: v[1:])
    arrivals = tagged.filter(lambda x: x[1][0] is not None).map(lambda x: (x[1][0], x[1][1:])).partitionBy(partitions, plain)
    return tagged, stays.union(arrivals)


def entry_sums(residents: RDD, owners: Owners, width: int) -> dict[int, tuple[int, np.ndarray]]:
    """Weight and component sums of each entry: owners add up in place, then a row per entry and task meets."""

    def add(rows):
        total = {}
        for own, (weights, _, members) in rows:
            slot = owners.slot(own)
            n, s = int(weights.sum()), (members.astype(np.int64) * weights[:, None]).sum(0)
            old = total.get(slot)
            total[slot] = (n, s) if old is None else (old[0] + n, old[1] + s)
        return iter(total.items())

    return dict(residents.mapPartitions(add).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), SUM_PARTS).collect())


def renewed(books: Codebooks, sums: dict[int, tuple[int, np.ndarray]]) -> Codebooks:
    entries = len(books.rows[0])
    rows = [book.copy() for book in books.rows]
    for slot, (n, s) in sums.items():
        rows[slot // entries][slot % entries] = s // n   # floors
    return Codebooks(tuple(rows))


def train(kept: DataFrame, start: Codebooks, rounds: int, partitions: int) -> Codebooks:
    """The codebooks after ``rounds`` rounds of assignment and renewal over all kept vectors."""
    parts, (entries, width) = len(start.rows), start.rows[0].shape
    if not entries or not width or not rounds:
        return start
    members = distinct_parts(kept, parts, width)
    owners = owners_for(first_members(members, start, width), entries, partitions)
    residents, books, held = settle(members, start, owners, width, partitions), start, None
    try:
        for k in range(rounds):
            tagged = None
            if k:
                tagged, residents = migrate(residents, books, owners, partitions)
            books = renewed(books, entry_sums(residents, owners, width))
            if held is not None:
                held.unpersist()
            held = tagged
    finally:
        if held is not None:
            held.unpersist()
    return books


def first_codebooks(kept: DataFrame, parts: int, entries: int, width: int) -> Codebooks:
    """The parts of the vectors with the smallest ids, in ascending order."""
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    values = np.array([r["ints"][:parts * width] for r in rows], np.int64).reshape(len(rows), parts * width)
    return Codebooks(tuple(values[:, p * width:(p + 1) * width] for p in range(parts)))


def encode(kept: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hex digits a part), error of every kept vector: a map over the rows."""
    width = books.rows[0].shape[1] if books.rows else 0

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            values = matrix(batch.column(2), len(books.rows) * width)
            codes, error = np.zeros((len(values), len(books.rows)), np.uint8), np.zeros(len(values), np.int64)
            for p, book in enumerate(books.rows):
                index, far = nearest(values[:, p * width:(p + 1) * width], book)
                codes[:, p] = index
                error += far
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)],
                                             names=["vec_id", "label", "code", "error"])

    return kept.mapInArrow(batches, "vec_id long, label long, code string, error long")


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
             partitions: int | None = None) -> tuple[DataFrame, Codebooks]:
    """vec_id, label, code, error, label_error of every kept vector, and the codebooks.

    ``entries`` may not exceed 256, as a code has a byte for each part.
    """
    if not 0 < entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    spark = vectors.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = integers(vectors, scale)
    length = every.groupBy(F.size("ints").alias("n")).count().agg(F.max(F.struct("count", "n")).alias("m")).first()["m"]
    dims = length["n"] if length else 0
    width = dims // parts
    kept = every.where(F.size("ints") == dims)
    books = train(kept, first_codebooks(kept, parts, entries, width), rounds, partitions)
    rows = cut(encode(kept, books))
    # a row per label, so that the join's one large side can be split where a label is hot
    errors = cut(rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")))
    return (rows.join(errors, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "label", "code", "error", "label_error")), books
