"""Substring deduplication by difference-cover anchors on words.

Windows are hashed only where their place modulo the period is in the cover.
Any two equal passages of ``length`` words share an aligned anchor; passages
around anchors that occur twice are extended to whole windows, compared by
128-bit names, and every word of a window that starts anywhere else is removed.

Defined cases: a null text has no words; a text of fewer words than ``length``
loses nothing; repeated rows are copies of each other; no row is dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loadlens.llm import textbuf as B
from loadlens.llm.cover import Scheme, Units, remove_repeats

SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def word_units(scheme: Scheme):
    def units(data: np.ndarray, offsets: np.ndarray) -> Units:
        start, end, first = B.words(data, offsets)
        a, b = (B.Windows(B.word_values(data, start, end, f), f) for f in (0, 1))
        return Units(first, lambda at: a.names(at, at + scheme.slice),
                     lambda at: (a.names(at, at + scheme.length), b.names(at, at + scheme.length)))

    return units


def kept_words(data: np.ndarray, offsets: np.ndarray, covered: np.ndarray) -> list[bytes]:
    """Each document's words that are left, joined by one space."""
    start, end, first = B.words(data, offsets)
    whole = memoryview(data)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        keep = ~covered[a:b]
        out.append(b" ".join(whole[s:e] for s, e in zip(start[a:b][keep].tolist(), end[a:b][keep].tolist())))
    return out


def digest(doc_ids: pa.Array, data: np.ndarray, offsets: np.ndarray, covered: np.ndarray) -> pa.Table:
    first = B.words(data, offsets)[2]
    return pa.table({"doc_id": doc_ids, "n_words": np.diff(first), "n_removed": B.per_doc(covered, first),
                     "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept_words(data, offsets, covered)]})


def texts_kept(doc_ids: pa.Array, data: np.ndarray, offsets: np.ndarray, covered: np.ndarray) -> pa.Table:
    return pa.table({"doc_id": doc_ids, "kept": pa.array([x.decode() for x in kept_words(data, offsets, covered)], pa.string())})


def remove(docs: DataFrame, length: int = 35, period: int = 21, result=digest, schema: str = SCHEMA, **sizes) -> DataFrame:
    """Remove every word covered by a ``length``-word window that also starts anywhere else."""
    scheme = Scheme(length, period, every=4)
    return remove_repeats(docs, scheme, word_units(scheme), result, schema, **sizes)
