"""Repeated byte strings by a difference-cover suffix order, a bucket at a time.

Suffixes are told apart to a depth of ``length`` bytes, which is what removal
needs.  Cover places modulo ``period`` are the sample.  The slices of
``length - period + 1`` bytes there are ranked first (equal slices, one rank).
Any two suffixes have a shift, less than the period, at which both have a cover
place, so a suffix is known whole by its first and last ``period - 1`` bytes and
the ranks at its cover places: the ranks stand for all bytes between.

Then suffixes are sorted one bucket at a time, a bucket being those whose first
``length`` bytes have a hash with the same leading bits: by the bytes at both
ends, and ties by the ranks at the shared place.  A bucket holds some 25 bytes a
suffix, however long the texts or the ties, and never a text.  Suffixes that a
sample settles are not sent at all.  The rounds of ``cover`` carry this out:

1. slices at places of a sparse cover: suffixes without a repeated one are alone;
2. the ranks of the sample places of the others; a rank of 0 says that the slice
   occurs once, and where all ranks of a suffix are 0 it is alone;
3. the order of some suffixes, chosen by content: the inside of long repeats;
4. the shifts at which sample places still have an uncovered unit around them;
5. the order of the suffixes at those shifts.

A rank numbers the repeated slices in the order of their names in their bucket,
not of the alphabet: which are equal is what counts.  Names have as many bits as
keep the chance of one clash in the whole corpus near a millionth.

Defined cases: a null text is an empty one; a text shorter than ``length``
loses nothing, and texts of any length are taken whole (a text of over a chunk's
size is a chunk); repeated rows are copies of each other; an empty table gives no
rows; columns other than doc_id and text are not read; no row is dropped.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loadlens.llm import textbuf as B
from loadlens.llm.cover import Chunk, Names, Scheme, Units, Width, answer, answers_of, bucket_bits, remove_repeats, widths
from loadlens.llm.cover import _equal_before as equal_before

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
SPARSE_PERIOD = 133  # of round 1's cover
LOCAL_BITS = 24      # a rank's bits beside its bucket's
U = np.uint64


@dataclass(frozen=True)
class Depth(Scheme):
    """A scheme whose cover places are the ranked sample, and the sparse one that precedes it."""

    sparse_period: int = SPARSE_PERIOD

    @property
    def sparse(self) -> Scheme:
        return Scheme(self.length, self.sparse_period, self.every)

    @property
    def ends(self) -> int:
        """Bytes at a suffix's head, and as many at its depth, that ranks may leave open."""
        return self.period - 1

    def places_of_class(self) -> np.ndarray:
        """For each class (place modulo the period) and shift: which of the class's cover places it is, or -1."""
        inside = np.isin((np.arange(self.period)[:, None] + np.arange(self.period)) % self.period, self.cover)
        return np.where(inside, np.cumsum(inside, 1) - 1, -1)


@dataclass
class Suffixes(Units):
    """The bytes of a chunk, the names of its sparse slices, and the two names of each sample slice."""

    data: np.ndarray
    sparse_names: object
    sample_names: object


def byte_units(scheme: Depth):
    def units(data: np.ndarray, offsets: np.ndarray) -> Suffixes:
        prefix = B.Windows(B.BYTE_VALUES[0][data])

        def two(length: int):
            def names(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                front, back = prefix.names(at, at + length // 2), prefix.names(at + length // 2 - 1, at + length)
                return B.mix64(front ^ B.mix64(back)), B.mix64(back + B.mix64(~front))

            return names

        def one(length: int):
            return lambda at: prefix.names(at, at + length)

        return Suffixes(offsets, one(scheme.slice), two(scheme.length), data, one(scheme.sparse.slice), two(scheme.slice))

    return units


@dataclass(frozen=True)
class Layout:
    """A suffix as its bucket gets it: its class, the bytes at both ends, its ranks."""

    scheme: Depth
    rank_bytes: int

    @property
    def size(self) -> int:
        return 1 + 2 * self.scheme.ends + len(self.scheme.cover) * self.rank_bytes

    def write(self, data: np.ndarray, places: np.ndarray, classes: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """rank holds the rank of every place that is a cover place, else 0."""
        s, out = self.scheme, np.empty((len(places), self.size), np.uint8)
        out[:, 0] = classes
        for k in range(s.ends):
            out[:, 1 + k], out[:, 1 + s.ends + k] = data[places + k], data[places + s.slice + k]
        shifts = np.argsort(s.places_of_class() < 0, axis=1, kind="stable")[:, : len(s.cover)]
        for k in range(len(s.cover)):
            at = 1 + 2 * s.ends + k * self.rank_bytes
            whole = np.ascontiguousarray(rank[places + shifts[classes, k]].astype("<u8")).view(np.uint8).reshape(-1, 8)
            out[:, at : at + self.rank_bytes] = whole[:, : self.rank_bytes]
        return out

    def read(self, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Classes, bytes at both ends, ranks."""
        s, rows = self.scheme, np.frombuffer(blob, np.uint8).reshape(-1, self.size)
        ranks = np.zeros((len(rows), len(s.cover), 8), np.uint8)
        ranks[:, :, : self.rank_bytes] = rows[:, 1 + 2 * s.ends :].reshape(-1, len(s.cover), self.rank_bytes)
        return rows[:, 0].astype(np.int64), rows[:, 1 : 1 + 2 * s.ends], ranks.view("<u8")[:, :, 0].astype(U)


def equal_suffixes(scheme: Depth, classes: np.ndarray, ends: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Which suffixes of a bucket equal another one to the scheme's depth.

    They are sorted by the bytes at both ends.  Ties are settled by the ranks at a
    shared cover place: for each shift, among the suffixes with a cover place there.
    """
    wide = np.zeros((len(ends), -(-ends.shape[1] // 8) * 8), np.uint8)
    wide[:, : ends.shape[1]] = ends
    columns = wide.view(">u8").astype(U)
    order = np.lexsort(columns.T[::-1])
    new = np.ones(len(order), bool)
    new[1:] = (columns[order][1:] != columns[order][:-1]).any(axis=1)
    tie = np.empty(len(order), np.int64)
    tie[order] = np.cumsum(new) - 1
    tied = np.bincount(tie, minlength=1)[tie] > 1
    hit = np.zeros(len(order), bool)
    for which in scheme.places_of_class().T:
        here = np.flatnonzero(tied & (which[classes] >= 0))
        rank = ranks[here, which[classes[here]]]
        here, rank = here[rank > 0], rank[rank > 0]
        group = tie[here].astype(U)
        if len(here) and max(int(rank.max()), int(group.max())) < 1 << 32:
            order, same = equal_before(group << U(32) | rank, None)
        else:
            order, same = equal_before(group, rank)
        hit[here[order[same]]] = True
        hit[here[order[np.flatnonzero(same) - 1]]] = True
    return hit


def ranks_of(ask: int, width: Width):
    """The work on one bucket of sample slices: sort their names, number those that occur again."""

    def ranked(group: pa.Table) -> pa.Table:
        first, second, twice = width.of_bytes(b"".join(group.column("names").to_pylist()))
        order, same = equal_before(first, second)
        of = np.empty(len(first), np.int64)
        of[order] = np.cumsum(~same) - 1
        again = np.bincount(of, weights=1 + twice[:, 0]) > 1
        rank = np.cumsum(again) - 1
        if len(rank) and rank[-1] >= 1 << LOCAL_BITS:
            raise OverflowError(f"{rank[-1] + 1} ranks in a bucket; use a smaller bucket_names")
        extra = rank[of].astype("<u4").view(np.uint8).reshape(-1, 4)
        return answers_of(group, ask, width.first + width.second + width.more, again[of], extra)

    return ranked


def order_of(ask: int, layout: Layout):
    """The work on one bucket of suffixes."""

    def ordered(group: pa.Table) -> pa.Table:
        return answers_of(group, ask, layout.size, equal_suffixes(layout.scheme, *layout.read(b"".join(group.column("names").to_pylist()))))

    return ordered


@dataclass(frozen=True)
class SuffixWidth(Width):
    """How suffixes are told apart in their chunk and dealt to buckets, and what is sent of them."""

    layout: Layout | None = None


class SuffixChunk(Chunk):
    """A chunk's part in the suffix order."""

    ROUNDS = (1, 2, 3, 4, 5)
    SOME, OPEN, BORDER = 3, 4, 5

    @staticmethod
    def widths(scheme: Depth, size: int, bucket_names: int) -> dict[int, Width]:
        share = lambda s: size * len(s.cover) / s.period
        sparse = widths(size, bucket_bits(share(scheme.sparse), bucket_names))[1]
        bits = bucket_bits(share(scheme), bucket_names)
        pair, opened = (widths(size, bits)[k] for k in (2, 3))
        layout = Layout(scheme, math.ceil((bits + LOCAL_BITS + 1) / 8))

        def suffixes(names: float) -> SuffixWidth:
            bits = bucket_bits(names, bucket_names)
            width = widths(size, bits)[2]
            return SuffixWidth(bits, width.first, min(8, width.second + 1), layout=layout)

        return {1: sparse, 2: Width(bits, pair.first, pair.second, more=1), 3: suffixes(size / scheme.every), 4: opened, 5: suffixes(size)}

    @staticmethod
    def answer(ask: int, width: Width):
        return ranks_of(ask, width) if ask == 2 else order_of(ask, width.layout) if isinstance(width, SuffixWidth) else answer(ask, width)

    def __init__(self, units: Suffixes, scheme: Depth, width: dict[int, Width]):
        super().__init__(units, scheme, width)
        self.sparse = Chunk(Units(units.bounds, units.sparse_names, units.window_names), scheme.sparse, width)
        self.rank = np.zeros(self.n + scheme.period, U)

    def class_of(self, places: np.ndarray) -> np.ndarray:
        """Places of their document modulo the period; places ascend or not."""
        doc = np.searchsorted(self.units.bounds, places, side="right") - 1
        return (places - self.units.bounds[doc]) % self.scheme.period

    def sample(self, answers: pa.Table) -> tuple[np.ndarray, Names]:
        """Cover places of the suffixes that round 1 did not settle."""
        low, high = self.sparse.reach(self.sparse.anchors(answers)[0])
        places = self.starts(low, high + self.scheme.period - 1)
        places = places[np.isin(self.class_of(places), self.scheme.cover)]
        return places, Names(self.width[2], *self.units.sample_names(places))

    def anchors(self, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Sample places with a rank, and their slices' names; their ranks are noted."""
        places, names = self.sample(answers)
        again, more = names.read(answers, 2)
        rank = np.zeros(len(again), U)
        local = np.frombuffer(more, "<u4").astype(U)
        rank[again] = (local << U(self.width[2].bits) | names.bucket[again].astype(U)) + U(1)
        self.rank[places] = rank[names.of]
        places = places[self.rank[places] > 0]
        return places, self.units.slice_names(places)

    def windows(self, places: np.ndarray, chosen: bool, ask: int) -> tuple[np.ndarray, Names]:
        """Suffixes of one class that are equal to the depth go once from a chunk."""
        places = places[((self.units.slice_names(places) & U(self.scheme.every - 1)) == 0) == chosen]
        first, second = self.units.window_names(places)
        bits = U(self.scheme.period.bit_length())
        return places, Names(self.width[ask], first, second >> bits | self.class_of(places).astype(U) << (U(64) - bits))

    def sent(self, chunk: int, places: np.ndarray, names: Names) -> pa.Table:
        places = places[names.some]
        return names.rows(chunk, sent=names.width.layout.write(self.units.data, places, self.class_of(places), self.rank))

    def ask(self, ask: int, chunk: int, answers: pa.Table | None) -> pa.Table:
        if ask == 1:
            return self.sparse.ask(1, chunk, answers)
        if ask == 2:
            names = self.sample(answers)[1]
            return names.rows(chunk, names.twice.astype(np.uint8)[:, None])
        return super().ask(ask, chunk, answers)


def digest(doc_ids: pa.Array, data: np.ndarray, offsets: np.ndarray, covered: np.ndarray) -> pa.Table:
    """Per document: sizes, removed runs and the hash of what is left."""
    begins = covered.copy()
    begins[1:] &= ~covered[:-1]
    heads = offsets[:-1][offsets[1:] > offsets[:-1]]
    begins[heads] = covered[heads]
    n_removed = B.per_doc(covered, offsets)
    kept = [hashlib.sha256(data[a:b] if not gone else data[a:b][~covered[a:b]]).hexdigest()
            for a, b, gone in zip(offsets[:-1], offsets[1:], n_removed)]
    return pa.table({"doc_id": doc_ids, "n_bytes": np.diff(offsets), "n_removed": n_removed,
                     "n_spans": B.per_doc(begins, offsets), "kept_sha256": kept})


def texts_kept(doc_ids: pa.Array, data: np.ndarray, offsets: np.ndarray, covered: np.ndarray) -> pa.Table:
    """Per document: the bytes that are left."""
    return pa.table({"doc_id": doc_ids, "kept": pa.array([data[a:b][~covered[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())})


def remove(docs: DataFrame, length: int = 200, period: int = 7, result=digest, schema: str = SCHEMA, sparse_period: int = SPARSE_PERIOD,
           **sizes) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts anywhere else."""
    scheme = Depth(length, period, 16, sparse_period)
    return remove_repeats(docs, scheme, byte_units(scheme), result, schema, kind=SuffixChunk, **sizes)
