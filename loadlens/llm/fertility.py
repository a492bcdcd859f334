"""Quality rules from tokeniser fertility.

Public vocabularies, used as they are, show text that does not look like a
language: few characters per token, many byte-fallback pieces, or a token
distribution of too little or too much entropy for the text's length.  Each
script has its own rejection bands.

Defined cases: a null or empty text has no words, all counts 0 and fails the
base rule; repeated rows are judged alike; no row is dropped; a text may be of
any length and hold white space or a word of any length; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from loadlens.llm import textbuf as B
from loadlens.llm.common import texts

#: Fixed rejection bands, by script: least and most code points per token of
#: the byte-level vocabulary, most share of byte-fallback pieces in the piece
#: vocabulary, least normalised token entropy.  Texts of fewer tokens than
#: MIN_TOKENS are judged by the base rule alone: their figures are noise.
BANDS = {
    "latin": (1.5, 7.0, 0.10, 0.70),
    "greek": (0.45, 6.0, 0.10, 0.55),
    "cyrillic": (0.45, 6.0, 0.10, 0.55),
    "arabic": (0.45, 6.0, 0.15, 0.55),
    "cjk": (0.30, 4.0, 0.60, 0.50),
    "other": (0.25, 6.0, 0.80, 0.50),
}
MIN_TOKENS = 20
#: Entropy is divided by the most that a text of so many tokens (or its own,
#: if fewer) can have: a language's entropy levels off in longer texts.
ENTROPY_TOKENS = 256
#: First and last code point of the letters that mark a script.
SCRIPTS = (
    ("latin", ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF))),
    ("cjk", ((0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7AF))),
)
SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
CACHE_WORDS = 1_000_000  # words kept per Python worker; when full, it starts anew
CACHE_CHARS = 64  # longer words are not kept, so the cache's bytes are bounded too
#: White space of the vocabulary's pattern.  Its look-ahead recurses along a run, which a very long one does not survive.
LONG_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")
REPEAT_WORDS = 8

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, script string, n_tokens long, chars_per_token double, "
          "byte_share double, token_entropy double")


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks: the key is found twice or more; the key is equal to an earlier one."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return again, later


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of the base rule for every document of a piece of text."""
    docs = np.arange(len(offsets) - 1)
    start, end, first = B.words(data, offsets)
    lead = ((data & 0xC0) != 0x80) & ~B.IS_SEPARATOR[data]
    by_bytes = B.Windows(B.BYTE_VALUES[0][data])
    # lines: from a document's start or a line feed to the next, or to its end
    feeds = np.flatnonzero(data == 0x0A)
    heads, tails = np.sort(np.concatenate([offsets[:-1], feeds + 1])), np.sort(np.concatenate([feeds, offsets[1:]]))
    doc_of_line = np.repeat(docs, np.diff(np.searchsorted(feeds, offsets)) + 1)
    filled = np.concatenate([[0], np.cumsum(~B.IS_SEPARATOR[data])])
    has_word = filled[tails] > filled[heads]
    heads, tails, doc_of_line = heads[has_word], tails[has_word], doc_of_line[has_word]
    _, later = _repeats(B.mix64(by_bytes.names(heads, tails) + doc_of_line.astype(B.U) * B.U(0x9E3779B97F4A7C15)))
    # words inside windows that are found twice or more in their document
    values = by_bytes.names(start, end)
    n_words = np.diff(first)
    at = B.ranges(first[:-1], np.maximum(n_words - REPEAT_WORDS + 1, 0))
    doc_of_window = np.repeat(docs, np.maximum(n_words - REPEAT_WORDS + 1, 0))
    names = B.Windows(values).names(at, at + REPEAT_WORDS)
    again, _ = _repeats(B.mix64(names + doc_of_window.astype(B.U) * B.U(0x9E3779B97F4A7C15)))
    inside = B.unions(at[again], REPEAT_WORDS, len(values))
    return {
        "n_words": n_words, "word_chars": B.per_doc(lead, offsets), "n_symbols": B.per_doc(SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(doc_of_line[later], minlength=len(docs)), "n_repeat_words": B.per_doc(inside, first),
    }


def script_of(text: str) -> str:
    """The script of most letters of the text (ties: the first in SCRIPTS)."""
    if text.isascii():
        return "latin"
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    counts = [sum(int(((points >= a) & (points <= b)).sum()) for a, b in spans) for _, spans in SCRIPTS]
    return SCRIPTS[int(np.argmax(counts))][0] if max(counts) else "other"


class Vocabularies:
    """The public vocabularies, opened once per Python worker."""

    opened: dict[tuple[str, str], "Vocabularies"] = {}

    def __init__(self, ranks_path: str, pieces_path: str):
        import public_tokenizers as public
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_bpe = tiktoken.Encoding("ranks", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.is_byte = np.array([self.pieces.IsByte(i) for i in range(self.pieces.GetPieceSize())])
        self.known: dict[str, int] = {}  # word -> pieces * 2**32 + byte-fallback pieces

    @classmethod
    def of(cls, ranks_path: str, pieces_path: str) -> "Vocabularies":
        if (ranks_path, pieces_path) not in cls.opened:
            cls.opened[ranks_path, pieces_path] = cls(ranks_path, pieces_path)
        return cls.opened[ranks_path, pieces_path]

    def byte_share(self, split: list[list[str]]) -> list[float]:
        """Share of byte-fallback pieces in each list of words."""
        new = list({w for ws in split for w in ws if w not in self.known})
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = list({w for ws in split for w in ws})
        long = []
        for word, ids in zip(new, self.pieces.encode(new, num_threads=1) if new else ()):
            self.known[word] = (len(ids) << 32) + int(self.is_byte[ids].sum() if not word.isascii() else 0)
            if len(word) > CACHE_CHARS:
                long.append(word)
        sums = [sum(map(self.known.__getitem__, ws)) for ws in split]
        for word in long:
            del self.known[word]
        return [(s & 0xFFFFFFFF) / (s >> 32) if s >> 32 else 0.0 for s in sums]

    def ids(self, text: str) -> list[int]:
        """Byte-level ids of the whole text.

        Of a run of white space the pattern makes one piece, without its last
        character where text follows; very long runs are cut out at these
        places and merged as the one piece they are.
        """
        out, at = [], 0
        for run in LONG_WHITE.finditer(text):
            end = run.end() - (run.end() < len(text))
            out += self.bytes_bpe.encode_ordinary(text[at:run.start()])
            out += self.bytes_bpe._encode_single_piece(text[run.start():end].encode())
            at = end
        return out + self.bytes_bpe.encode_ordinary(text[at:]) if at else self.bytes_bpe.encode_ordinary(text)

    def entropy(self, text: str) -> tuple[int, float]:
        """Tokens of the byte-level vocabulary; their entropy over the most that many tokens could have."""
        ids = np.array(self.ids(text), np.int64)
        if len(ids) < 2:
            return len(ids), 1.0
        counts = np.bincount(ids)
        p = counts[counts > 0] / len(ids)
        return len(ids), float(-(p * np.log2(p)).sum() / np.log2(min(len(ids), ENTROPY_TOKENS)))


def measure(docs: DataFrame, ranks_path: str, pieces_path: str, bands: dict = BANDS, min_tokens: int = MIN_TOKENS,
            least_words: int = 20, repeat_percent: int = 30) -> DataFrame:
    """One row per document: base counts, fertility figures and the verdict.

    A map over the rows; nothing is shuffled and a task holds one Arrow batch.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = Vocabularies.of(ranks_path, pieces_path)
        for batch in source:
            data, offsets = B.raw(batch.column(1))
            for i, j in B.pieces(offsets):
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                counts = base_counts(part, at)
                some = [t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]
                figures = [vocabularies.entropy(t) for t in some]
                tokens, entropy = np.array([x[0] for x in figures]), np.array([x[1] for x in figures])
                chars = np.array([len(t) for t in some])
                share = np.array(vocabularies.byte_share([t.split() for t in some]))
                scripts = [script_of(t) for t in some]
                band = np.array([bands[s] for s in scripts])
                per_token = chars / np.maximum(tokens, 1)
                failed = (counts["n_words"] < least_words) | (100 * counts["n_repeat_words"] > repeat_percent * counts["n_words"])
                good = (per_token >= band[:, 0]) & (per_token <= band[:, 1]) & (share <= band[:, 2]) & (entropy >= band[:, 3])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *(pa.array(np.asarray(counts[k], np.int64)) for k in
                     ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                     pa.array(failed), pa.array(~failed & (good | (tokens < min_tokens))), pa.array(scripts),
                     pa.array(tokens.astype(np.int64)), pa.array(per_token), pa.array(share), pa.array(entropy)],
                    names=[f.split()[0] for f in SCHEMA.split(", ")])

    return texts(docs).mapInArrow(batches, SCHEMA)
