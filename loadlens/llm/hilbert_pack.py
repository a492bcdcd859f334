"""Packing along a space-filling curve.

A document's token ids, hashed to fixed directions and summed, give a vector
of three coordinates; its place on a Hilbert curve through their cube is its
sort key.  Documents in key order form one stream of tokens, which is cut every
``length`` tokens, so neighbours on the curve share sequences and only the
stream's last sequence is short.

The curve is split into cells; cells that hold many rows are split by further
bits of the key, so the stream is in key order at any size.  Only rows of one
equal key (copies) are dealt by a hash of the document.  A running sum over the
small table of the cells' tokens gives each its place in the stream.  Then every
cell is ordered and cut by itself.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm import textbuf as B
from loadlens.llm.common import cut, texts

LENGTH = 2048
END_ID = 1
DIMENSIONS = 3
BITS = 16             # of each coordinate
CELL_BITS = 12        # leading key bits of a cell
STEP_BITS = 3         # further bits by which a large cell is split, as often as it takes
CELL_ROWS = 4_096     # rows of a cell, or of a part of one key's rows
CACHE_WORDS = 700_000  # parts of words kept per Python worker, some 150 MB; when full, it starts anew
PIECE_BYTES = 4 << 20
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "padding long, hilbert_key long")


def _byte_characters() -> dict[int, int]:
    """The character by which a byte-level vocabulary writes each byte: itself where it prints, else from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {b: b for b in prints} | {b: 256 + k for k, b in enumerate(rest)}


BYTE_CHARACTERS = _byte_characters()


#: Punctuation that is a piece of its own after a letter.
TAIL = np.isin(np.arange(256), list(b".,;:!?"))
LETTER = (np.arange(256) >= 97) & (np.arange(256) <= 122)
#: Second bytes, after 0xC3, of the Latin-1 letters (all but the signs of times and division).
SECOND = (np.arange(256) >= 0x80) & (np.arange(256) <= 0xBF) & ~np.isin(np.arange(256), (0x97, 0xB7))


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the parts of every word (its stem, and the punctuation after its last letter), and
    each document's first part."""
    start, end, first = B.words(data, offsets)
    stem = end.copy()
    for _ in range(3):
        stem -= (stem - 1 > start) & TAIL[data[stem - 1]]
    last, before = data[stem - 1], data[np.maximum(stem - 2, 0)]
    cut_here = (stem < end) & (LETTER[last] | ((before == 0xC3) & SECOND[last] & (stem - 2 >= start)))
    at = np.cumsum(1 + cut_here) - 1 - cut_here
    n = int(at[-1]) + 1 + int(cut_here[-1]) if len(at) else 0
    head, tail = np.empty(n, np.int64), np.empty(n, np.int64)
    head[at], tail[at] = start, np.where(cut_here, stem, end)
    head[at[cut_here] + 1], tail[at[cut_here] + 1] = stem[cut_here], end[cut_here]
    return head, tail, np.append(at, n)[first]


class Words:
    """Token ids of the parts of words, encoded once per Python worker.

    The vocabulary lowers letters, drops white space and never joins across it,
    nor a letter with the punctuation after it; so a text's ids are those of its
    parts in order.  The ids of part number k lie in one array, between
    ``ends`` of the number before and its own.
    """

    opened: dict[str, "Words"] = {}

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    @classmethod
    def of(cls, path: str) -> "Words":
        if path not in cls.opened:
            cls.opened[path] = cls(path)
        return cls.opened[path]

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.ends = np.zeros(1 << 16, np.uint16), np.zeros(1 << 16, np.int64)

    def _coded(self, parts: list[bytes]) -> list[bytes]:
        """Ids of each part, two bytes each.  A part of Latin-1 letters is one piece, so the merges are asked directly."""
        merge, out, other = self.tokenizer.model.tokenize, [], []
        for k, part in enumerate(parts):
            text = part.decode()
            if text.isalpha() and max(text) < "\u0100" and text == text.lower():
                out.append(array("H", [t.id for t in merge(part.decode("latin-1").translate(BYTE_CHARACTERS))]).tobytes())
            else:
                out.append(b"")
                other.append((k, text))
        for (k, _), e in zip(other, self.tokenizer.encode_batch_fast([t for _, t in other], add_special_tokens=False) if other else ()):
            out[k] = array("H", e.ids).tobytes()
        return out

    def _add(self, parts: list[bytes]) -> None:
        n, coded = len(self.known), self._coded(parts)
        used = int(self.ends[n - 1]) if n else 0
        ends = np.cumsum([len(c) for c in coded]) // 2 + used
        while len(self.ends) < n + len(parts):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while len(self.ids) < ends[-1]:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ends[n : n + len(parts)] = ends
        self.ids[used : ends[-1]] = np.frombuffer(b"".join(coded), np.uint16)
        self.known.update(zip(parts, range(n, n + len(parts))))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a piece of text, each document closed by END_ID, and the documents' bounds."""
        raw = data.tobytes()
        if b"<|" not in raw:  # else a special token, which counts in lower case only, may be meant
            data = B.LOWER[data]
            raw = data.tobytes()
        head, tail, first = units(data, offsets)
        _, at, of = np.unique(B.word_values(data, head, tail), return_index=True, return_inverse=True)
        parts = [raw[a:b] for a, b in zip(head[at].tolist(), tail[at].tolist())]
        if len(self.known) > CACHE_WORDS:
            self.clear()
        if new := [x for x in parts if x not in self.known]:
            self._add(new)
        codes = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        begin = np.where(codes > 0, self.ends[codes - 1], 0)
        counts = (self.ends[codes] - begin)[of]
        before = np.concatenate([[0], np.cumsum(counts)])
        bounds = before[first] + np.arange(len(first))
        out = np.full(int(bounds[-1]), END_ID, np.uint16)
        inside = np.ones(len(out), bool)
        inside[bounds[1:] - 1] = False
        out[inside] = self.ids[B.ranges(begin[of], counts)]
        return out, bounds


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (one row each), by Gray-code undoing from the top bit down."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0]) ^ swap
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def directions(size: int) -> np.ndarray:
    """A fixed direction in DIMENSIONS for every token id."""
    u = B.draws(size * DIMENSIONS, 10).reshape(size, DIMENSIONS)
    return (u >> B.U(11)).astype(np.float64) / 2**52 - 1.0


def keys(ids: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hilbert key of each document: mean direction of its tokens, scaled by its length, squashed to the cube."""
    size = np.diff(bounds)
    mean = np.add.reduceat(table[ids], bounds[:-1], axis=0) / size[:, None] if len(size) else np.zeros((0, DIMENSIONS))
    unit = 1.0 / (1.0 + np.exp(-mean * 40.0))
    return hilbert(np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, Hilbert key, token count and token ids (two bytes each) of every document."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table = Words.of(path), directions(1 << 16)
        for batch in source:
            data, offsets = B.raw(batch.column(1))
            for i, j in B.pieces(offsets, PIECE_BYTES):
                ids, bounds = words.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(keys(ids, bounds, table)), pa.array(np.diff(bounds)),
                     pa.array([ids[a:b].astype("<u2").tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())],
                    names=["doc_id", "hkey", "n", "ids"])

    return texts(docs).mapInArrow(batches, "doc_id long, hkey long, n long, ids binary")


def in_cells(coded: DataFrame, cell_bits: int, cell_rows: int) -> DataFrame:
    """The rows with their cell, named by its least key, and the number of parts (over 1 where one key has many rows).

    The rows below each prefix of the keys are counted, in large cells at every
    level; a row's cell is that of the first level that is not large.  So there
    are rows / cell_rows large prefixes of a level at most.
    """
    width = DIMENSIONS * BITS
    shifts = [*range(width - cell_bits, 0, -STEP_BITS), 0]
    by_key = cut(coded.groupBy("hkey").agg(F.count(F.lit(1)).alias("rows")))
    first = F.shiftright("hkey", shifts[0])
    outer = by_key.groupBy(first.alias("cell")).agg(F.sum("rows").alias("rows")).where(F.col("rows") > cell_rows).select("cell")
    levels = [F.shiftright("hkey", k).alias(f"at{k}") for k in shifts]
    counted = (by_key.join(F.broadcast(outer), first == F.col("cell"), "leftsemi").rollup(*levels).agg(F.sum("rows").alias("rows"))
               .where((F.col("rows") > cell_rows) & F.col(f"at{shifts[0]}").isNotNull()))
    finest = F.coalesce(*(F.when(F.col(f"at{k}").isNotNull(), F.struct(F.lit(k).alias("shift"), F.col(f"at{k}").alias("prefix"))) for k in reversed(shifts)))
    large = cut(counted.select(finest.alias("at"), "rows").select("at.shift", "at.prefix", "rows"))
    out = coded.withColumns({"shift": F.lit(shifts[0]), "parts": F.lit(1)})
    for k in sorted((r["shift"] for r in large.select("shift").distinct().collect()), reverse=True):
        split = large.where(F.col("shift") == k).select("prefix", F.ceil(F.col("rows") / cell_rows).cast("int").alias("many"))
        out = out.join(F.broadcast(split), F.shiftright("hkey", k) == F.col("prefix"), "left")
        name, value = ("shift", F.lit(shifts[shifts.index(k) + 1])) if k else ("parts", F.col("many"))
        out = out.withColumn(name, F.when(F.col("prefix").isNotNull(), value).otherwise(F.col(name))).drop("prefix", "many")
    return out.withColumn("cell", F.expr("shiftleft(shiftright(hkey, shift), shift)")).drop("shift")


def pack(docs: DataFrame, path: str, length: int = LENGTH, cell_bits: int = CELL_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per piece: where in its document it starts, and where it lies in which sequence."""
    coded = cut(encoded(docs, path))
    dealt = in_cells(coded, cell_bits, cell_rows).withColumn("part", F.pmod(F.xxhash64("doc_id", "n", "hkey"), "parts").cast("int")).drop("parts")
    counts = dealt.groupBy("cell", "part").agg(F.sum("n").alias("tokens"))
    along = Window.partitionBy().orderBy("cell", "part").rowsBetween(Window.unboundedPreceding, -1)
    places = cut(counts.select("cell", "part", F.coalesce(F.sum("tokens").over(along), F.lit(0)).alias("place"),
                               F.sum("tokens").over(Window.partitionBy()).alias("total")))
    order = (Window.partitionBy("cell", "part").orderBy("hkey", "doc_id", "n", "ids").rowsBetween(Window.unboundedPreceding, -1))
    ordered = (dealt.select("doc_id", "hkey", "n", "ids", "cell", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
               .join(places, ["cell", "part"])
               .select("doc_id", "hkey", "n", "ids", (F.col("place") + F.col("before")).alias("at"), "total"))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            n, at = (batch.column(k).to_numpy() for k in (2, 4))
            if not len(n):
                continue
            total = batch.column(5)[0].as_py()
            data, bounds = B.raw(batch.column(3))
            counts = (at + n - 1) // length - at // length + 1
            doc = np.repeat(np.arange(len(n)), counts)
            sequence = np.repeat(at // length, counts) + B.ranges(np.zeros(len(n), np.int64), counts)
            begin = np.maximum(sequence * length, at[doc])
            stop = np.minimum((sequence + 1) * length, (at + n)[doc])
            start = begin - at[doc]
            ids = data.view("<u2").astype("<u4")
            origin = bounds[:-1][doc] // 2
            wide = memoryview(ids.view(np.uint8))
            crc = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip((origin + start).tolist(), (origin + start + stop - begin).tolist())]
            used = np.minimum(total - sequence * length, length)
            padding = np.where((used & (used - 1)) == 0, 0, length - used)
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [pc.take(batch.column(0), rows), pa.array(start), pa.array(stop - begin), pa.array(crc, pa.int64()), pc.take(batch.column(2), rows),
                 pa.array(sequence), pa.array(begin - sequence * length), pa.array(padding), pc.take(batch.column(1), rows)],
                names=[f.split()[0] for f in SCHEMA.split(", ")])

    return ordered.mapInArrow(batches, SCHEMA)
