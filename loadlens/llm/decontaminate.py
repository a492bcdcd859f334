"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are taken in blocks of bounded size; each block goes to every task,
and each task matches its own documents, so no row is shuffled.  A copy that
reaches the score shares a least number of the item's n-grams, whatever was
changed, added or left out (``shared``).  Over all documents every n-gram of an
item is counted; the commonest are left out, fewer than that least number, and
the rest are the item's seeds.  So each copy hits the others of its least number,
however common they are, and no copy is lost.  Passages with so many hits, and
with enough of the item's words, are aligned with the item word by word.

Defined cases: null or empty texts and items without a word match nothing; an
item too short for a pair that every copy shares has single words for seeds;
repeated rows and repeated items are reported each; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import textbuf as B
from loadlens.llm.common import keep_rows, texts

GRAM = 3             # the longest seeds
SCORE = 0.6          # of an exact copy's alignment score
MATCH, MISS, GAP = 2, -1, -1
BLOCK_BYTES = 4 << 20  # text of the items that are broadcast at once
U = np.uint64
SCHEMA = "doc_id long, item_id long, score double, start_word long, end_word long"


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A fingerprint of every token, and each document's first token number."""
    data = B.lowered(data)
    start, end, first = B.words(data, offsets, B.IS_BREAK)
    return B.word_values(data, start, end), first


def grams(values: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the n-grams inside documents, and their names."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    at = B.ranges(first[:-1], counts)
    return at, B.Windows(values).names(at, at + n)


def least_score(size: np.ndarray, score: float) -> np.ndarray:
    """The least alignment score of items of so many words that is reported."""
    return np.ceil(MATCH * score * size - 1e-9).astype(np.int64)


def shared(size: np.ndarray, score: float, n: int) -> np.ndarray:
    """So many n-grams at least has any reported copy in common with its item; 0 or less: perhaps none.

    Of w words that match, each edit costs 1, so there are MATCH * w - least_score
    edits at most, and one run more; a run lacks n - 1 n-grams of its words.  For
    n over 1 that is least where all words match.
    """
    least = least_score(size, score)
    return -(-least // MATCH) if n == 1 else size - (n - 1) * (1 + MATCH * size - least)


@dataclass
class Items:
    """A block of test items: token values, and seeds sorted by name."""

    ids: np.ndarray
    values: np.ndarray
    first: np.ndarray
    names: np.ndarray   # of all n-grams, sorted
    item: np.ndarray    # each one's item
    place: np.ndarray   # and place in it
    lengths: list[int]  # of the n-grams: an item has the longest that every reported copy shares
    least: np.ndarray   # of each item, the least score that is reported,
    common: np.ndarray  # the number of commonest n-grams that are no seeds,
    need: np.ndarray    # and the number of seeds that a reported copy hits

    @classmethod
    def of(cls, rows: list, gram: int, score: float) -> "Items":
        column = pa.array([r["text"] or "" for r in rows], pa.string())
        values, first = tokens(*B.raw(column))
        size = np.diff(first)
        length, need = np.ones(len(size), np.int64), shared(size, score, 1)
        for n in range(2, gram + 1):
            some = shared(size, score, n)
            length, need = np.where(some > 0, n, length), np.where(some > 0, some, need)
        names, item, place, lengths = [], [], [], []
        for n in range(1, gram + 1):
            at, name = grams(values, first, n)
            of = np.searchsorted(first, at, side="right") - 1
            use = length[of] == n
            if use.any():
                lengths.append(n)
                names.append(name[use])
                item.append(of[use])
                place.append(at[use] - first[of[use]])
        names, item, place = (np.concatenate([np.zeros(0, t), *x]) for x, t in ((names, U), (item, np.int64), (place, np.int64)))
        order = np.argsort(names, kind="stable")
        return cls(np.array([r["item_id"] for r in rows], object), values, first, names[order], item[order], place[order], lengths,
                   least_score(size, score), need // 2, np.maximum(need - need // 2, 1))

    def keep(self, chosen: np.ndarray) -> "Items":
        return replace(self, names=self.names[chosen], item=self.item[chosen], place=self.place[chosen])

    def seeds(self, names: np.ndarray, counts: np.ndarray) -> "Items":
        """Of each item all n-grams but its commonest, as far as they occur in the corpus at all (names, ascending)."""
        at = np.searchsorted(names, self.names)
        known = at < len(names)
        known[known] = names[at[known]] == self.names[known]
        count = np.zeros(len(at), np.int64)
        count[known] = counts[at[known]]
        order = np.lexsort((self.place, count, self.item))
        item = self.item[order]
        chosen = np.zeros(len(order), bool)
        chosen[order] = np.arange(len(order)) < np.searchsorted(item, item, side="right") - self.common[item]
        return self.keep(chosen & known)

    def hits(self, values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token place, seed number) for every n-gram of the documents that is a seed."""
        sieve = np.zeros(1 << 20, bool)
        sieve[self.names >> U(44)] = True
        found = []
        for n in self.lengths:
            at, name = grams(values, first, n)
            may = sieve[name >> U(44)]
            at, name = at[may], name[may]
            low, high = (np.searchsorted(self.names, name, side=s) for s in ("left", "right"))
            found.append((np.repeat(at, high - low), B.ranges(low, high - low)))
        return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


def align(passages: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair and the passage place where it ends.

    All pairs advance together, one passage token a step; a row's horizontal
    gaps are a running maximum.
    """
    wide = max(map(len, items))
    item = np.zeros((len(items), wide), U)
    real = np.zeros((len(items), wide), bool)
    for k, x in enumerate(items):
        item[k, : len(x)], real[k, : len(x)] = x, True
    ramp = -GAP * np.arange(wide)
    row = np.zeros((len(items), wide), np.int64)
    best, end = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
    for t in range(max(map(len, passages))):
        live = np.array([t < len(p) for p in passages])
        token = np.array([p[t] if t < len(p) else 0 for p in passages], U)
        step = np.where((item == token[:, None]) & real, MATCH, MISS)
        diagonal = np.concatenate([np.zeros((len(items), 1), np.int64), row[:, :-1]], 1) + step
        new = np.maximum(np.maximum(diagonal, row + GAP), 0)
        new = np.maximum.accumulate(new + ramp, 1) - ramp
        row = np.where(live[:, None], new, row)
        top = np.where(real, row, 0).max(1)
        better = live & (top > best)
        best, end = np.where(better, top, best), np.where(better, t, end)
    return best, end


def passages(items: Items, places: np.ndarray, seeds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows (document, item, from, to): places around hits of one item that may belong to one copy.

    A copy has as many edits at most as its score may lack, so its hits begin so
    near to one another, and no word of it lies further off.
    """
    doc, item = np.searchsorted(first, places, side="right") - 1, items.item[seeds]
    begin = places - items.place[seeds]
    order = np.lexsort((begin, item, doc))
    doc, item, begin = doc[order], item[order], begin[order]
    size = np.diff(items.first)
    slack = (MATCH * size - items.least)[item]
    if not len(doc):
        return np.zeros((0, 4), np.int64)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
    along = np.cumsum(new) * (begin.max() - begin.min() + slack.max() + 1) + begin  # ascends; pairs lie further apart than any slack
    stop = np.searchsorted(along, along + slack, side="right")
    full = np.flatnonzero(stop - np.arange(len(doc)) >= items.need[item])
    steps = np.zeros(len(doc) + 1, np.int64)
    np.add.at(steps, full, 1)
    np.add.at(steps, stop[full], -1)
    some = np.cumsum(steps[:-1]) > 0
    doc, item, begin, slack, along = doc[some], item[some], begin[some], slack[some], along[some]
    if not len(doc):
        return np.zeros((0, 4), np.int64)
    heads = np.flatnonzero(np.append(True, np.diff(along) > slack[1:]))
    tails = np.append(heads[1:], len(doc)) - 1
    return np.column_stack([doc[heads], item[heads], np.maximum(begin[heads] - slack[heads], first[doc[heads]]),
                            np.minimum(begin[tails] + size[item[heads]] + slack[heads], first[doc[heads] + 1])])


def matches(items: Items, data: np.ndarray, offsets: np.ndarray, score: float) -> list[tuple]:
    """(document, item, score, first word, end) of the best passage of each contaminated pair."""
    values, first = tokens(data, offsets)
    found = passages(items, *items.hits(values, first), first)
    words = -(-items.least // MATCH)
    found = found[[np.isin(items.values[items.first[i] : items.first[i + 1]], values[a:b]).sum() >= words[i] for _, i, a, b in found.tolist()]]
    found = found[np.argsort(found[:, 3] - found[:, 2], kind="stable")]
    best: dict[tuple[int, int], tuple] = {}
    for k in range(0, len(found), 256):
        part = found[k : k + 256]
        texts_, sizes = [values[a:b] for _, _, a, b in part], np.diff(items.first)[part[:, 1]]
        tests = [items.values[items.first[i] : items.first[i + 1]] for i in part[:, 1]]
        top, end = align(texts_, tests)
        share = top / (MATCH * sizes)
        some = np.flatnonzero(share >= score)
        if len(some):
            _, back = align([texts_[i][: end[i] + 1][::-1] for i in some], [tests[i][::-1] for i in some])
            for i, b in zip(some, back):
                d, item, a, _ = part[i]
                start = a + end[i] - b - first[d]
                row = (share[i], start, a + end[i] + 1 - first[d])
                if (d, item) not in best or (-row[0], row[1]) < (-best[d, item][0], best[d, item][1]):
                    best[d, item] = row
    return [(d, item, *row) for (d, item), row in best.items()]


def blocks_of(docs: DataFrame, benchmark: DataFrame, gram: int, score: float, block_bytes: int) -> Iterator[Items]:
    """The items in blocks of about block_bytes of text, each with its seeds chosen by their counts in docs."""
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = size // block_bytes + 1
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        yield seeded(docs, Items.of(rows, gram, score))


def seeded(docs: DataFrame, items: Items) -> Items:
    """The items with their seeds: one pass that counts the block's n-grams over all documents."""
    every = items.keep(np.flatnonzero(np.append(True, items.names[1:] != items.names[:-1])) if len(items.names) else slice(0))

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(every.names), np.int64)
        for batch in source:
            data, offsets = B.raw(batch.column(0))
            for i, j in B.pieces(offsets):
                _, seeds = every.hits(*tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                total += np.bincount(seeds, minlength=len(total))
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"name": every.names[k].view(np.int64), "n": total[k]})

    counted = texts(docs).select("text").mapInArrow(count, "name long, n long").groupBy("name").agg(F.sum("n").alias("n")).toArrow()
    names = counted.column("name").to_numpy().view(U)
    order = np.argsort(names)
    return items.seeds(names[order], counted.column("n").to_numpy()[order])


def contaminated(docs: DataFrame, benchmark: DataFrame, gram: int = GRAM, score: float = SCORE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, score and place of every document that holds a copy or edited copy of a test item."""
    docs = texts(docs)
    found = [_pairs(docs, items, score) for items in blocks_of(docs, benchmark, gram, score, block_bytes)]
    return reduce(DataFrame.union, found)


def _pairs(docs: DataFrame, items: Items, score: float) -> DataFrame:
    def find(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            data, offsets = B.raw(batch.column(1))
            ids = batch.column(0)
            for i, j in B.pieces(offsets):
                found = matches(items, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], score)
                if found:
                    d, item, share, a, b = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(np.array(d) + i)), pa.array([items.ids[x] for x in item], pa.int64()), pa.array(share, pa.float64()),
                         pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["doc_id", "item_id", "score", "start_word", "end_word"])

    return docs.mapInArrow(find, SCHEMA)


def clean(docs: DataFrame, benchmark: DataFrame, gram: int = GRAM, score: float = SCORE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, every column kept, that hold no copy of a test item."""
    blocks = list(blocks_of(docs, benchmark, gram, score, block_bytes))

    def judge(items: Items):
        def of(column: pa.Array) -> np.ndarray:
            data, offsets = B.raw(column)
            keep = np.ones(len(column), bool)
            for i, j in B.pieces(offsets):
                found = matches(items, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], score)
                keep[[i + int(x[0]) for x in found]] = False
            return keep

        return of

    for items in blocks:
        docs = keep_rows(docs, judge(items))
    return docs
