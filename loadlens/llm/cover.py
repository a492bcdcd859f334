"""Repeated windows of a corpus, found from a difference-cover sample.

This is op3's search; op2's suffix order (``suffix_dedup``) uses its first round,
its chunks and its way of asking, with rounds of its own.

A document is a sequence of units (bytes or words).  Two windows of ``length``
units at any places i and j have a shift d < period with i + d and j + d both
in the cover, so equal windows hold an equal, shorter slice at such places: an
anchor.  Every window that holds no repeated slice is settled at once.  The
work is four rounds of one exchange ("ask"):

1. names of the slices at cover places; the repeated ones are the anchors;
2. names of some windows that hold an anchor, chosen by their own first slice,
   so that equal windows are chosen alike; the repeated ones settle the inside of
   long repeats;
3. names of the anchors again, each with the shifts at which a window around it
   still holds a unit that is not covered; every place that has the anchor is
   told those shifts;
4. names of the windows at those shifts, from every place that has the anchor:
   the borders of repeats, and short ones.

Two equal windows share an anchor and the shift to it, so if either still has
an uncovered unit after round 2, both are named in round 4 and found equal.

In an ask, each chunk of documents sends its distinct names, sorted and cut to
the bytes that a corpus of this size needs, to buckets by their leading bits.  A
bucket is sorted alone and answers with one bit a name: it occurs in another
chunk too.  (What occurs twice in one chunk the chunk sees itself.)  A name that
a third of all rows share arrives once from each chunk, however often it occurs.

Chunks are runs of whole documents as they are read, packed and compressed; they
are exchanged once and kept on the executors' disks, where Spark restores a lost
one from its lineage.  Answers are written to the shared checkpoint folder after
each round.  Nothing passes through the driver.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame

from loadlens.llm import textbuf as B
from loadlens.llm.common import cut, release, text_bytes, texts

CHUNK_BYTES = 4 << 20
BUCKET_NAMES = 1 << 21
MOST_BUCKET_BITS = 30  # of 2 million names each: some 10**15 sampled units
ZSTD_LEVEL = 3
U = np.uint64
PACKED = "chunk long, blob binary"
ASK = "bucket int, chunk long, names binary"
ANSWER = "bucket int, chunk long, ask int, bits binary, more binary"

#: Perfect difference sets modulo their period (every non-zero
#: difference occurs exactly once), the sparsest covers there are.
DIFFERENCE_SETS = {
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    133: (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109),
}


@dataclass(frozen=True)
class Scheme:
    """A window of ``length`` units and the cover it is anchored by."""

    length: int
    period: int
    every: int  # one in so many windows is named in round 2; a power of two

    @property
    def slice(self) -> int:
        return self.length - self.period + 1

    @property
    def cover(self) -> np.ndarray:
        return np.array(DIFFERENCE_SETS[self.period])

    def samples(self, bounds: np.ndarray) -> np.ndarray:
        """Cover places with room for a slice, in documents with room for a window."""
        n = np.diff(bounds)
        places = np.sort((np.arange(0, max(n.max(initial=0), 1) + self.period, self.period)[:, None] + self.cover).ravel())
        counts = np.where(n >= self.length, np.searchsorted(places, n - self.slice, side="right"), 0)
        return places[B.ranges(np.zeros(len(n), np.int64), counts)] + np.repeat(bounds[:-1], counts)


@dataclass
class Units:
    """The units of a chunk: each document's bounds, slice names and window names."""

    bounds: np.ndarray
    slice_names: Callable[[np.ndarray], np.ndarray]
    window_names: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Width:
    """How a name is sent: bucket bits, bytes of its first and second part, bytes of what goes with it."""

    bits: int
    first: int
    second: int = 0
    more: int = 0

    def short(self, first: np.ndarray, second: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
        return first >> U(64 - self.bits - 8 * self.first), None if not self.second else second >> U(64 - 8 * self.second)

    def bucket(self, first: np.ndarray) -> np.ndarray:
        return (first >> U(8 * self.first)).astype(np.int64) if self.bits else np.zeros(len(first), np.int64)

    def to_bytes(self, first: np.ndarray, second: np.ndarray | None, more: np.ndarray | None) -> np.ndarray:
        part = lambda x, n: np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :n]
        columns = [part(first, self.first)]
        if self.second:
            columns.append(part(second, self.second))
        if self.more:
            columns.append(more)
        return np.concatenate(columns, 1)

    def of_bytes(self, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = np.frombuffer(blob, np.uint8).reshape(-1, self.first + self.second + self.more)
        whole = lambda x: np.ascontiguousarray(np.pad(x, ((0, 0), (0, 8 - x.shape[1])))).reshape(-1).view("<u8").astype(U)
        return whole(rows[:, : self.first]), whole(rows[:, self.first : self.first + self.second]), rows[:, self.first + self.second :]


def widths(units: int, bits: int) -> dict[int, Width]:
    """By round.  A slice's name may rarely clash, which costs time only; a window's has bits
    enough that two different windows of the corpus clash with a chance of a millionth."""
    size = math.log2(max(units, 2))
    first = min(6, (64 - bits) // 8)
    slice_ = min(first, max(4, math.ceil((size + 10 - bits) / 8)))
    second = min(8, max(2, math.ceil((2 * size + 20 - 8 * first - bits) / 8)))
    return {1: Width(bits, slice_), 2: Width(bits, first, second), 3: Width(bits, first, more=2), 4: Width(bits, first, second)}


def bucket_bits(names: float, bucket_names: int) -> int:
    """Leading bits by which so many names make buckets of about bucket_names."""
    return min(MOST_BUCKET_BITS, max(0, math.ceil(math.log2(max(1.0, names / bucket_names)))))


def _equal_before(first: np.ndarray, second: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorting order of the names; which sorted name equals the one before it."""
    order = np.argsort(first)
    same = np.zeros(len(first), bool)
    same[1:] = first[order][1:] == first[order][:-1]
    if second is not None:
        alike = np.flatnonzero(same)
        if (second[order[alike]] != second[order[alike - 1]]).any():  # names that share their first part alone: rare
            order = np.lexsort((second, first))
            same[1:] = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
    return order, same


class Names:
    """The names of one round of one chunk: distinct, sorted, cut by bucket."""

    def __init__(self, width: Width, first: np.ndarray, second: np.ndarray | None = None):
        self.width = width
        first, second = width.short(first, second)
        order, same = _equal_before(first, second)
        self.of = np.empty(len(first), np.int64)  # each name's place among the distinct ones
        self.of[order] = np.cumsum(~same) - 1
        self.some = order[~same]  # a name's place for each distinct one
        self.first, self.second = first[self.some], None if second is None else second[self.some]
        self.twice = np.bincount(self.of, minlength=len(self.first)) > 1
        self.bucket = width.bucket(self.first)

    def rows(self, chunk: int, more: np.ndarray | None = None, sent: np.ndarray | None = None) -> pa.Table:
        """What goes to each bucket: the names and ``more``, or ``sent`` in their place (a row of bytes for each name)."""
        ids, at = np.unique(self.bucket, return_index=True)
        ends = np.append(at[1:], len(self.bucket))
        if sent is None and len(ids):
            sent = self.width.to_bytes(self.first, self.second, more)
        return pa.table({"bucket": pa.array(ids, pa.int32()), "chunk": pa.array(np.full(len(ids), chunk), pa.int64()),
                         "names": pa.array([sent[a:b].tobytes() for a, b in zip(at, ends)], pa.binary())})

    def read(self, answers: pa.Table, ask: int) -> tuple[np.ndarray, bytes]:
        """The answer's bit for every distinct name, and what came with the set ones."""
        bit, more = np.zeros(len(self.first), bool), []
        rows = sorted((r["bucket"], r["bits"], r["more"]) for r in answers.to_pylist() if r["ask"] == ask)
        for bucket, bits, extra in rows:
            a, b = np.searchsorted(self.bucket, [bucket, bucket + 1])
            bit[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
            more.append(extra)
        return bit, b"".join(more)

    def again(self, answers: pa.Table, ask: int) -> np.ndarray:
        """For every name that was asked: it occurs more than once."""
        bit, _ = self.read(answers, ask)
        return (bit | self.twice)[self.of]


def answer(ask: int, width: Width):
    """The work on one bucket of a round: sort its names, answer each chunk."""

    def names_again(group: pa.Table) -> pa.Table:
        first, second, more = width.of_bytes(b"".join(group.column("names").to_pylist()))
        order, same = _equal_before(first, second if width.second else None)
        hit, extra = np.zeros(len(first), bool), None
        if width.more:  # the span of open shifts of an anchor, over all chunks that have it
            heads = np.flatnonzero(~same)
            low = np.minimum.reduceat(more[order, 0], heads) if len(heads) else more[:0, 0]
            high = np.maximum.reduceat(more[order, 1], heads) if len(heads) else more[:0, 1]
            of = np.empty(len(first), np.int64)
            of[order] = np.cumsum(~same) - 1
            hit = (low <= high)[of]
            extra = np.column_stack([low, high])[of]
        else:
            hit[order[same]] = True
            hit[order[np.flatnonzero(same) - 1]] = True
        return answers_of(group, ask, width.first + width.second + width.more, hit, extra)

    return names_again


def answers_of(group: pa.Table, ask: int, size: int, hit: np.ndarray, extra: np.ndarray | None = None) -> pa.Table:
    """A bucket's answers: to each chunk the bits of its names (``size`` bytes each) and, of the set ones, the extra bytes."""
    ends = np.cumsum([len(x) // size for x in group.column("names").to_pylist()])
    starts = np.concatenate([[0], ends[:-1]])
    rows = [k for k, (a, b) in enumerate(zip(starts, ends)) if hit[a:b].any()]
    out = group.select(["bucket", "chunk"]).take(pa.array(rows, pa.int64()))
    bits = [np.packbits(hit[starts[k] : ends[k]]).tobytes() for k in rows]
    with_it = [b"" if extra is None else extra[starts[k] : ends[k]][hit[starts[k] : ends[k]]].tobytes() for k in rows]
    return (out.append_column("ask", pa.array(np.full(len(rows), ask), pa.int32()))
            .append_column("bits", pa.array(bits, pa.binary())).append_column("more", pa.array(with_it, pa.binary())))


class Chunk:
    """What a chunk asks in each round, worked out again from its texts and the answers so far."""

    ROUNDS = (1, 2, 3, 4)
    SOME, OPEN, BORDER = 2, 3, 4  # the rounds of some windows, of open shifts, and of the other windows

    @staticmethod
    def widths(scheme: Scheme, size: int, bucket_names: int) -> dict[int, Width]:
        return widths(size, bucket_bits(size * len(scheme.cover) / scheme.period, bucket_names))

    @staticmethod
    def answer(ask: int, width: Width):
        return answer(ask, width)

    def __init__(self, units: Units, scheme: Scheme, width: dict[int, Width]):
        self.units, self.scheme, self.width = units, scheme, width
        self.n = int(units.bounds[-1])

    def slices(self) -> tuple[np.ndarray, Names]:
        places = self.scheme.samples(self.units.bounds)
        return places, Names(self.width[1], self.units.slice_names(places))

    def anchors(self, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Cover places with a repeated slice, and the slice's name."""
        places, names = self.slices()
        places = places[names.again(answers, 1)]
        return places, self.units.slice_names(places)

    def reach(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last start of the windows that hold each anchor's slice."""
        bounds, length = self.units.bounds, self.scheme.length
        doc = np.searchsorted(bounds, anchors, side="right") - 1
        return np.maximum(bounds[doc], anchors - (length - self.scheme.slice)), np.minimum(anchors, bounds[doc + 1] - length)

    @staticmethod
    def starts(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """All places in some [low, high]; low ascends."""
        low, end = B.merged(low, high + 1)
        return B.ranges(low, end - low)

    def windows(self, places: np.ndarray, chosen: bool, ask: int) -> tuple[np.ndarray, Names]:
        """Those of the windows that round 2 names (chosen by their first slice), or the others."""
        pick = ((self.units.slice_names(places) & U(self.scheme.every - 1)) == 0) == chosen
        places = places[pick]
        return places, Names(self.width[ask], *self.units.window_names(places))

    def some_windows(self, anchors: np.ndarray) -> tuple[np.ndarray, Names]:
        return self.windows(self.starts(*self.reach(anchors)), True, self.SOME)

    def inside(self, anchors: np.ndarray, answers: pa.Table) -> np.ndarray:
        places, names = self.some_windows(anchors)
        return places[names.again(answers, self.SOME)]

    def open_shifts(self, anchors: np.ndarray, names: Names, confirmed: np.ndarray) -> np.ndarray:
        """For each distinct anchor the least and most shift of a window that is not covered yet (255 and 0: none)."""
        low, high = self.reach(anchors)
        places = self.starts(low, high)
        heads, ends = B.merged(confirmed, confirmed + self.scheme.length)
        ends = np.append(ends, -1)  # for places before the first covered run
        places = places[ends[np.searchsorted(heads, places, side="right") - 1] < places + self.scheme.length]
        a, b = np.searchsorted(places, low), np.searchsorted(places, high, side="right") - 1
        some = a <= b
        spans = np.tile(np.array([255, 0], np.uint8), (len(names.first), 1))
        np.minimum.at(spans[:, 0], names.of[some], (anchors[some] - places[b[some]]).astype(np.uint8))
        np.maximum.at(spans[:, 1], names.of[some], (anchors[some] - places[a[some]]).astype(np.uint8))
        return spans

    def border_windows(self, anchors: np.ndarray, slices: np.ndarray, answers: pa.Table) -> tuple[np.ndarray, Names]:
        names = Names(self.width[self.OPEN], slices)
        bit, more = names.read(answers, self.OPEN)
        spans = np.zeros((len(bit), 2), np.int64)
        spans[bit] = np.frombuffer(more, np.uint8).reshape(-1, 2)
        here = bit[names.of]
        anchors, span = anchors[here], spans[names.of[here]]
        low, high = self.reach(anchors)
        low, high = np.maximum(low, anchors - span[:, 1]), np.minimum(high, anchors - span[:, 0])
        able = low <= high
        order = np.argsort(low[able], kind="stable")
        return self.windows(self.starts(low[able][order], high[able][order]), False, self.BORDER)

    def covered(self, answers: pa.Table) -> np.ndarray:
        """A mask of the units that some repeated window covers."""
        anchors, slices = self.anchors(answers)
        confirmed = self.inside(anchors, answers)
        places, names = self.border_windows(anchors, slices, answers)
        return B.unions(np.concatenate([confirmed, places[names.again(answers, self.BORDER)]]), self.scheme.length, self.n)

    def ask(self, ask: int, chunk: int, answers: pa.Table | None) -> pa.Table:
        if ask == 1:
            return self.slices()[1].rows(chunk)
        anchors, slices = self.anchors(answers)
        if ask == self.OPEN:
            names = Names(self.width[self.OPEN], slices)
            return names.rows(chunk, self.open_shifts(anchors, names, self.inside(anchors, answers)))
        return self.sent(chunk, *(self.some_windows(anchors) if ask == self.SOME else self.border_windows(anchors, slices, answers)))

    def sent(self, chunk: int, places: np.ndarray, names: Names) -> pa.Table:
        """What is sent of windows."""
        return names.rows(chunk)


def packed(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """Runs of whole documents as compressed Arrow streams.

    A chunk's number is a hash of its place (partition and order) and content,
    so chunks of repeated rows stay apart and go to different tasks.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = itertools.count()
        for batch in source:
            _, offsets = B.raw(batch.column(1))
            for i, j in B.pieces(offsets, chunk_bytes):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=ZSTD_LEVEL))) as out:
                    out.write_batch(batch.slice(i, j - i))
                blob = sink.getvalue().to_pybytes()
                salt = b"%d:%d" % (TaskContext.get().partitionId(), next(place))
                chunk = int.from_bytes(hashlib.blake2b(blob, digest_size=8, key=salt).digest(), "little", signed=True)
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int64()), "blob": pa.array([blob], pa.binary())})

    return texts(docs).mapInArrow(batches, PACKED)


def unpacked(group: pa.Table) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in group.column("blob").to_pylist()]).combine_chunks()


def remove_repeats(docs: DataFrame, scheme: Scheme, units: Callable[[np.ndarray, np.ndarray], Units],
                   result: Callable[[pa.Array, np.ndarray, np.ndarray, np.ndarray], pa.Table], schema: str,
                   chunk_bytes: int = CHUNK_BYTES, bucket_names: int = BUCKET_NAMES, kind: type[Chunk] = Chunk) -> DataFrame:
    """result(doc_ids, bytes, offsets, covered mask) of every chunk of documents.

    ``docs`` should be a table as it is read: a lost chunk is cut again from the
    same rows in the same order.  Rows that come out of a shuffle may change
    their order, so write them first.
    """
    size = text_bytes(docs)
    width = kind.widths(scheme, size, bucket_names)
    parts = max(1, math.ceil(size / (2 * chunk_bytes)))
    # the answers' side of each co-group is dealt alike, so the chunks move once
    chunks = packed(docs, chunk_bytes).repartition(parts, "chunk").persist(StorageLevel.DISK_ONLY)
    chunks.count()
    grouped = chunks.groupBy("chunk")

    def open_chunk(group: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, Chunk]:
        rows = unpacked(group)
        data, offsets = B.raw(rows.column("text"))
        return rows, data, offsets, kind(units(data, offsets), scheme, width)

    def ask(k: int):
        def first(group: pa.Table) -> pa.Table:
            return open_chunk(group)[3].ask(1, group.column("chunk")[0].as_py(), None)

        def later(group: pa.Table, answers: pa.Table) -> pa.Table:
            if not len(group):
                return pa.table({"bucket": pa.array([], pa.int32()), "chunk": pa.array([], pa.int64()), "names": pa.array([], pa.binary())})
            return open_chunk(group)[3].ask(k, group.column("chunk")[0].as_py(), answers)

        return first if k == 1 else later

    def final(group: pa.Table, answers: pa.Table) -> pa.Table:
        rows, data, offsets, chunk = open_chunk(group)
        return result(rows.column("doc_id"), data, offsets, chunk.covered(answers))

    answers = None
    for k in kind.ROUNDS:
        asked = (grouped if answers is None else grouped.cogroup(answers.groupBy("chunk"))).applyInArrow(ask(k), ASK)
        told = cut(asked.groupBy("bucket").applyInArrow(kind.answer(k, width[k]), ANSWER))
        answers = told if answers is None else answers.union(told)
        del asked, told
        release(docs.sparkSession)
    out = cut(grouped.cogroup(answers.groupBy("chunk")).applyInArrow(final, schema))
    chunks.unpersist()
    return out
