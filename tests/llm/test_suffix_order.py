"""The suffix order of op2: ranks settle ties, long and hot repeats, and equality with a plain comparison."""

import numpy as np
import pytest

from loadlens.llm import cover, suffix_dedup
from loadlens.llm.suffix_dedup import Depth, Layout, equal_suffixes
from tests.llm import brute

COLUMNS = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def check(spark, texts, **options):
    got = suffix_dedup.remove(table(spark, texts), **options).orderBy("doc_id").select(*COLUMNS).collect()
    assert [tuple(r) for r in got] == brute.byte_result(texts, options.get("length", 200))


def true_ranks(data, scheme):
    """Rank of the slice at every cover place of one document, from the slices themselves; 0: it occurs once."""
    at = [p for p in range(len(data) - scheme.slice + 1) if p % scheme.period in scheme.cover]
    slices = [bytes(data[p:p + scheme.slice]) for p in at]
    order = {s: k + 1 for k, s in enumerate(sorted(set(slices)))}
    rank = np.zeros(len(data) + scheme.period, np.uint64)
    rank[at] = [order[s] if slices.count(s) > 1 else 0 for s in slices]
    return rank


@pytest.mark.parametrize("period", [7, 13, 21])
def test_bucket_equals_plain_comparison(period):
    scheme = Depth(40, period, 4)
    rng = np.random.default_rng(period)
    base = rng.integers(97, 99, 60, dtype=np.uint8)
    data = np.concatenate([base, rng.integers(97, 99, 200, dtype=np.uint8), base[:50], base[5:], base[:45], np.full(90, 97, np.uint8)])
    places = np.arange(len(data) - scheme.length + 1)
    layout = Layout(scheme, 4)
    sent = layout.write(data, places, places % period, true_ranks(data, scheme))
    hit = equal_suffixes(scheme, *layout.read(sent.tobytes()))
    windows = [bytes(data[p:p + 40]) for p in places]
    assert hit.tolist() == [windows.count(w) > 1 for w in windows] and hit.any() and not hit.all()


def test_ranks_decide_ties():
    scheme = Depth(200, 7, 16)
    which = scheme.places_of_class()
    classes, ends = np.array([0, 1]), np.full((2, 12), 97, np.uint8)
    shared = [d for d in range(7) if which[0, d] >= 0 and which[1, d] >= 0]
    assert len(shared) == 1  # the set is perfect: one shared place for two classes
    ranks = np.array([[11, 12, 13], [14, 15, 16]], np.uint64)
    assert not equal_suffixes(scheme, classes, ends, ranks).any()
    ranks[1, which[1, shared[0]]] = ranks[0, which[0, shared[0]]]
    assert equal_suffixes(scheme, classes, ends, ranks).all()
    ends[1, 11] = 98  # the byte at the depth
    assert not equal_suffixes(scheme, classes, ends, ranks).any()
    ends[1, 11] = 97
    assert equal_suffixes(scheme, classes, ends, ranks + np.uint64(1 << 40)).all()  # ranks of over 32 bits
    assert not equal_suffixes(scheme, classes, ends, np.zeros_like(ranks)).any()  # no rank, no match


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 15_000, "bucket_names": 300}])
def test_long_repeats_and_edges(spark, sizes):
    rng = np.random.default_rng(2)
    word = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    long, edge = word(10_000), word(200)
    check(spark, [word(50) + long + word(31), long, word(7) + long[3:] + word(2), edge, "z" + edge, edge[:199], edge[1:] + "q",
                  "ab" * 700, "a" * 1_500, None, "", " " * 400 + edge], **sizes)


def test_widths_grow_without_a_cap():
    scheme = Depth(200, 7, 16)
    for size in (1, 10**6, 10**9, 10**12, 10**14):
        width = suffix_dedup.SuffixChunk.widths(scheme, size, cover.BUCKET_NAMES)
        for k, w in width.items():
            assert w.bits + 8 * w.first <= 64 and w.second <= 8
        assert size / 2 ** width[5].bits <= cover.BUCKET_NAMES  # suffixes of a bucket, were none settled
        assert size * 3 / 7 / 2 ** width[2].bits <= cover.BUCKET_NAMES
