"""Personal data by a character-level bidirectional LSTM with CRF transitions, in numpy.

The tagger is trained from labelled spans: windows of a bounded number of
documents, labelled by the base patterns, and drawn examples of written forms
that those patterns miss.  Long stretches are read in overlapping windows; a
character takes its tag from the window in which it lies most central, and the
spans are read from that one sequence over the whole text.

Only stretches around a digit or an @ are read by the tagger: each of its
kinds needs one.  Around an @ a stretch runs on to the next white space, and a
tagged address to the end of its letters, as it may be longer than a window.  Spans
it finds are added where they hold a letter or digit outside the base spans, also
beside a base span that they contain; base spans stay as they are.

Defined cases: a null or empty text has no spans; very long texts are read
window by window; repeated rows are tagged alike; without documents the
tagger learns from the drawn examples alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import importable, texts
from loadlens.llm.pii_rules import KINDS, NOT_DIGIT, TRIGGER, base_spans

WINDOW, STRIDE, MARGIN = 64, 32, 16
RUN = re.compile(r"\S+")
#: What may stand before and after the tagged part of an address: as in the base pattern, with the letters of Latin, Greek and Cyrillic.
_LETTER = "0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u052f"
BEFORE = re.compile(f"[{_LETTER}._%+-]")
AFTER = re.compile(f"(?:[{_LETTER}-]|[.](?=[{_LETTER}]))*")
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
EMBED, HIDDEN = 12, 20
FIT_DOCS = 400     # about so many documents lend their windows to a fit
FIT_WINDOWS = 900  # bound of those windows
DRAWN = 900        # drawn examples
EPOCHS, BATCH, RATE = 14, 50, 0.01
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

#: Character classes: each printable ASCII character (digits share one, and
#: letters of a case share one but for those of common host names), other
#: letters, other white space, the rest; 0 pads.
_TABLE = np.full(128, 1, np.int64)
for _c in range(33, 127):
    _ch = chr(_c)
    _TABLE[_c] = 2 if _ch.isdigit() else 3 if _ch.islower() else 4 if _ch.isupper() else _c
_TABLE[32] = 5
CLASSES = 128


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    return np.where(points < 128, _TABLE[np.minimum(points, 127)], 6)


def tags_of(length: int, spans: list[tuple[int, int, str]]) -> np.ndarray:
    out = np.zeros(length, np.int64)
    for a, b, kind in spans:
        k = 1 + 2 * KINDS.index(kind)
        if not out[max(a, 0) : b].any():
            out[max(a, 0) : b] = k + 1
            if 0 <= a < length:
                out[a] = k
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the text around its digits and @ signs, with the whole run of other than white space that holds an @."""
    parts = [(max(m.start() - MARGIN, 0), min(m.end() + MARGIN, len(text))) for m in TRIGGER.finditer(text)]
    if "@" in text:
        parts = sorted([*parts, *(m.span() for m in RUN.finditer(text) if "@" in m[0])])
    out: list[list[int]] = []
    for a, b in parts:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def windows(stretch: tuple[int, int]) -> list[tuple[int, int]]:
    a, b = stretch
    starts = list(range(a, max(a + 1, b - WINDOW + STRIDE), STRIDE))
    return [(s, min(s + WINDOW, b)) for s in starts]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tagger:
    """Parameters: embedding, two LSTMs, the emission layer and the transitions."""

    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, seed: int = 7) -> "Tagger":
        rng = np.random.default_rng(seed)
        p = {"embed": rng.normal(0, 0.3, (CLASSES, EMBED)), "out": rng.normal(0, 0.2, (2 * HIDDEN, TAGS)), "out_b": np.zeros(TAGS),
             "move": np.zeros((TAGS, TAGS)), "begin": np.zeros(TAGS)}
        for d in "fb":
            p[f"w{d}"] = rng.normal(0, 1 / np.sqrt(EMBED + HIDDEN), (EMBED + HIDDEN, 4 * HIDDEN))
            p[f"b{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        return cls(p)

    def _lstm(self, x: np.ndarray, mask: np.ndarray, d: str):
        """States of one direction over (steps, batch, embed); keeps what the way back needs."""
        w, b = self.p[f"w{d}"], self.p[f"b{d}"]
        h, c = np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN))
        states, memo = np.zeros((*x.shape[:2], HIDDEN)), []
        from_x = x @ w[:EMBED] + b
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            gate = from_x[t] + h @ w[EMBED:]
            s = _sigmoid(gate[:, : 3 * HIDDEN])
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            g = np.tanh(gate[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = f * c + i * g
            squashed = np.tanh(new)
            memo.append((t, h, c, i, f, o, g, squashed, m))
            c, h = np.where(m, new, c), np.where(m, o * squashed, h)
            states[t] = h
        return states, memo

    def _lstm_back(self, x: np.ndarray, grad: np.ndarray, memo: list, d: str, g_: dict) -> np.ndarray:
        w = self.p[f"w{d}"]
        dh, dc = np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN))
        dx = np.zeros_like(x)
        for t, h, c, i, f, o, g, squashed, m in reversed(memo):
            dh = dh + grad[t]
            on = dh * m
            dn = dc * m + on * o * (1 - squashed**2)
            gate = np.concatenate([dn * g * i * (1 - i), dn * c * f * (1 - f), on * squashed * o * (1 - o), dn * i * (1 - g**2)], 1)
            g_[f"w{d}"] += np.concatenate([x[t], h], 1).T @ gate
            g_[f"b{d}"] += gate.sum(0)
            both = gate @ w.T
            dx[t] = both[:, :EMBED]
            dh = np.where(m, 0, dh) + both[:, EMBED:]
            dc = np.where(m, dn * f, dc)
        return dx

    def emit(self, chars: np.ndarray):
        """Scores of every tag at every step; chars is (steps, batch), 0 pads at the end."""
        mask = chars > 0
        x = self.p["embed"][chars]
        forward, memo_f = self._lstm(x, mask, "f")
        backward, memo_b = self._lstm(x, mask, "b")
        states = np.concatenate([forward, backward], 2)
        return states @ self.p["out"] + self.p["out_b"], (x, mask, states, memo_f, memo_b)

    def learn(self, chars: np.ndarray, gold: np.ndarray) -> tuple[float, dict]:
        """Negative log likelihood of the gold tags and its gradient."""
        p, (score, (x, mask, states, memo_f, memo_b)) = self.p, self.emit(chars)
        g_ = {k: np.zeros_like(v) for k, v in p.items()}
        steps, batch = chars.shape
        ids = np.arange(batch)
        lse = lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
        alpha, beta = np.zeros((steps, batch, TAGS)), np.zeros((steps, batch, TAGS))
        alpha[0] = p["begin"] + score[0]
        for t in range(1, steps):
            new = lse(alpha[t - 1][:, :, None] + p["move"], 1) + score[t]
            alpha[t] = np.where(mask[t][:, None], new, alpha[t - 1])
        for t in range(steps - 2, -1, -1):
            new = lse(p["move"] + (score[t + 1] + beta[t + 1])[:, None, :], 2)
            beta[t] = np.where(mask[t + 1][:, None], new, beta[t + 1])
        total = lse(alpha[-1], 1)
        d_score = np.exp(alpha + beta - total[None, :, None]) * mask[:, :, None]
        g_["begin"] += d_score[0].sum(0)
        loss = total.sum() - (p["begin"][gold[0]] + score[0, ids, gold[0]]).sum()
        np.add.at(g_["begin"], gold[0], -1)
        for t in range(1, steps):
            on = mask[t]
            pair = np.exp(alpha[t - 1][:, :, None] + p["move"] + (score[t] + beta[t])[:, None, :] - total[:, None, None])
            g_["move"] += pair[on].sum(0)
            np.add.at(g_["move"], (gold[t - 1][on], gold[t][on]), -1)
            loss -= (p["move"][gold[t - 1], gold[t]] + score[t, ids, gold[t]])[on].sum()
        at = np.nonzero(mask)
        d_score[at[0], at[1], gold[at]] -= 1
        g_["out"] += np.einsum("tbh,tbk->hk", states, d_score)
        g_["out_b"] += d_score.sum((0, 1))
        d_states = d_score @ p["out"].T
        dx = self._lstm_back(x, d_states[:, :, :HIDDEN], memo_f, "f", g_) + self._lstm_back(x, d_states[:, :, HIDDEN:], memo_b, "b", g_)
        np.add.at(g_["embed"], chars, dx)
        return float(loss) / batch, {k: v / batch for k, v in g_.items()}

    def decode(self, chars: np.ndarray) -> np.ndarray:
        """The best tag sequence of every window, by Viterbi over the transitions."""
        score, (_, mask, *_rest) = self.emit(chars)
        steps, batch = chars.shape
        best, back = self.p["begin"] + score[0], np.zeros((steps, batch, TAGS), np.int8)
        for t in range(1, steps):
            step = best[:, :, None] + self.p["move"]
            back[t] = np.where(mask[t][:, None], step.argmax(1), np.arange(TAGS))
            best = np.where(mask[t][:, None], step.max(1) + score[t], best)
        tags = np.zeros((steps, batch), np.int64)
        tags[-1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t, np.arange(batch), tags[t]]
        return np.where(mask, tags, 0)


def batch_of(parts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((max(map(len, parts)), len(parts)), np.int64)
    for k, x in enumerate(parts):
        out[: len(x), k] = x
    return out


def drawn(n: int, seed: int = 70) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Labelled examples: written forms of each kind inside invented words, and numbers that are none."""
    rng = np.random.default_rng(seed)
    digits = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    letters = lambda a, b: "".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(a, b)))
    prose = lambda k: " ".join(letters(2, 9) for _ in range(k))

    def card() -> str:
        body = [int(c) for c in "4" + digits(14)]
        total = sum(d * 2 - 9 * (d > 4) if k % 2 == 0 else d for k, d in enumerate(reversed(body)))
        number = "".join(map(str, body)) + str(-total % 10)
        return [number, " ".join(number[i : i + 4] for i in (0, 4, 8, 12)), "-".join(number[i : i + 4] for i in (0, 4, 8, 12))][rng.integers(3)]

    makers = {
        "email": lambda: f"{letters(2, 9)}{['.', '_', ''][rng.integers(3)]}{digits(rng.integers(0, 3))}{letters(1, 4)}@{letters(3, 8)}"
                         f"{digits(rng.integers(0, 2))}.{['com', 'org', 'example.com', 'net'][rng.integers(4)]}",
        "ip": lambda: ".".join(str(rng.integers(0, 256)) for _ in range(4)),
        "card": card,
        "phone": lambda: [f"+{rng.integers(1, 99)} ({digits(3)}) {digits(3)}-{digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}",
                          f"{digits(3)}-{digits(3)}-{digits(4)}", f"+{rng.integers(1, 99)} {digits(3)} {digits(3)} {digits(4)}",
                          f"00{rng.integers(1, 99)} {digits(3)} {digits(7)}"][rng.integers(5)],
    }
    others = [lambda: f"Version {rng.integers(1, 9)}.{rng.integers(0, 9)}", lambda: str(rng.integers(1900, 2100)), lambda: digits(rng.integers(1, 7)),
              lambda: f"{letters(3, 9)}={digits(6)}{letters(2, 8)}{digits(5)}", lambda: f"{rng.integers(0, 100)}.{digits(2)}%",
              lambda: f"{letters(1, 3).upper()}{digits(4)}{letters(2, 6).upper()}{digits(3)}", lambda: f"@{letters(3, 8)}",
              lambda: f"{digits(4)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}", lambda: f"{digits(1)}.{digits(1)}.{digits(2)}"]
    out = []
    for k in range(n):
        before, after = prose(int(rng.integers(1, 4))) + " ", [" ", ", ", ". ", ".\n"][rng.integers(4)] + prose(int(rng.integers(1, 4)))
        if k % 3 == 2:
            out.append((before + others[rng.integers(len(others))]() + after, []))
        else:
            kind = KINDS[rng.integers(len(KINDS))]
            value = makers[kind]()
            out.append((before + value + after, [(len(before), len(before) + len(value), kind)]))
    return out


def fit(examples: list[tuple[str, list]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 71) -> Tagger:
    """Adam on the windows of the labelled examples."""
    parts = []
    for text, spans in examples:
        code, tags = classes(text), tags_of(len(text), spans)
        parts += [(code[a:b], tags[a:b]) for s in stretches(text) for a, b in windows(s)]
    tagger, rng = Tagger.new(), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    v = {k: np.zeros_like(x) for k, x in tagger.p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(parts))
        for i in range(0, len(order), BATCH):
            some = [parts[k] for k in order[i : i + BATCH]]
            _, grad = tagger.learn(batch_of([c for c, _ in some]), batch_of([t for _, t in some]))
            step += 1
            for k, g in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                tagger.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return tagger


def plausible(kind: str, value: str) -> bool:
    """What a tagged span must at least look like."""
    n = len(NOT_DIGIT.sub("", value))
    if kind == "email":
        name, _, host = value.partition("@")
        return bool(name) and "." in host.strip(".") and "@" not in host
    if kind == "ip":
        parts = value.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    return 13 <= n <= 19 if kind == "card" else 7 <= n <= 15


def whole(text: str, span: tuple[int, int, str]) -> tuple[int, int, str]:
    """The span; a tagged address with the rest of its local part and host, without a dot after it."""
    a, b, kind = span
    if kind != "email" or "@" not in text[a:b]:
        return span
    while a and BEFORE.match(text, a - 1):
        a -= 1
    b = AFTER.match(text, b).end()
    return a, a + len(text[a:b].rstrip(".")), kind


def tag(tagger: Tagger, texts_: list[str], batch: int = 512) -> list[list[tuple[int, int, str]]]:
    """Spans of each text, from windows decoded together and reconciled over the whole text."""
    where, parts = [], []
    for k, text in enumerate(texts_):
        code = None
        for s in stretches(text):
            for a, b in windows(s):
                parts.append(classes(text[a:b]))
                where.append((k, a, b))
    order = np.argsort([len(p) for p in parts], kind="stable")
    decoded: list[np.ndarray | None] = [None] * len(parts)
    for i in range(0, len(order), batch):
        some = order[i : i + batch]
        tags = tagger.decode(batch_of([parts[k] for k in some]))
        for column, k in enumerate(some):
            decoded[k] = tags[: len(parts[k]), column]
    chosen: list[dict[int, tuple[int, int]]] = [{} for _ in texts_]  # place -> (distance to a window's border, tag)
    for (k, a, b), tags in zip(where, decoded):
        for j, t in enumerate(tags.tolist()):
            rank = min(j, b - a - 1 - j)
            if a + j not in chosen[k] or rank > chosen[k][a + j][0]:
                chosen[k][a + j] = (rank, t)
    out = []
    for text, at in zip(texts_, chosen):
        spans, open_, last = [], None, -2
        for place in sorted(at):
            t = at[place][1]
            kind = (t - 1) // 2 if t else -1
            if open_ is not None and place == last + 1 and kind == open_[1] and t == 2 + 2 * kind:
                open_[2] = place + 1
            else:
                if open_ is not None:
                    spans.append((open_[0], open_[2], KINDS[open_[1]]))
                open_ = [place, kind, place + 1] if t else None
            last = place
        if open_ is not None:
            spans.append((open_[0], open_[2], KINDS[open_[1]]))
        spans = dict.fromkeys(whole(text, s) for s in spans)
        out.append([s for s in spans if plausible(s[2], text[s[0] : s[1]])])
    return out


def beside(text: str, span: tuple[int, int, str], base: list[tuple[int, int, str]]) -> bool:
    """Whether the span holds a letter or digit outside the base spans, which ascend."""
    at, end, _ = span
    for a, b, _ in base:
        if a < end and at < b:
            if any(map(str.isalnum, text[at:a])):
                return True
            at = b
    return any(map(str.isalnum, text[at:end]))


def find(tagger: Tagger, texts_: list[str]) -> list[tuple[list, list]]:
    """(base spans, added spans) of each text; an added span holds a letter or digit that no base span holds."""
    base = [base_spans(t) if TRIGGER.search(t) else [] for t in texts_]
    some = [k for k, t in enumerate(texts_) if TRIGGER.search(t)]
    added: list[list] = [[] for _ in texts_]
    for k, spans in zip(some, tag(tagger, [texts_[k] for k in some]) if some else ()):
        added[k] = [s for s in spans if beside(texts_[k], s, base[k])]
    return list(zip(base, added))


def train(docs: DataFrame, fit_docs: int = FIT_DOCS, fit_windows: int = FIT_WINDOWS, n_drawn: int = DRAWN) -> Tagger:
    """Fit on windows of about fit_docs different documents that hold a digit or an @, and on drawn examples.

    The documents are chosen by a hash of their text at a rate that their
    approximate number gives; their windows are cut and labelled on the
    executors, and fit_windows of them at most reach the driver.
    """
    some = texts(docs).where(F.col("text").rlike("[0-9@]")).select(F.xxhash64("text").alias("h"), "text")
    n = some.agg(F.approx_count_distinct("h")).first()[0]
    if n > fit_docs:
        some = some.where(F.pmod("h", F.lit(10**9)) < int(10**9 * fit_docs / n))

    def cut_windows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows = [(h, k, text[a:b]) for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for k, (a, b) in enumerate(stretches(text)) if b - a <= 4 * WINDOW]
            h, k, part = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(k, pa.int32()), pa.array(part, pa.string())], names=["h", "k", "part"])

    windows_ = (some.groupBy("h").agg(F.first("text").alias("text")).mapInArrow(cut_windows, "h long, k int, part string")
                .orderBy(F.xxhash64("part", "h"), "k").limit(fit_windows).collect())
    return fit(drawn(n_drawn) + [(r["part"], base_spans(r["part"])) for r in windows_])


def joined(spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in ordered)


def personal_data(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """Base counts, the hash of the base spans, and all spans of every document."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                found = find(tagger, [t or "" for t in part.column(1).to_pylist()])
                counts = [[sum(s[2] == k for s in base) for base, _ in found] for k in KINDS]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, pa.int64()) for c in counts),
                     pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]),
                     pa.array([joined(base + added) for base, added in found]), pa.array([len(added) for _, added in found], pa.int64())],
                    names=[f.split()[0] for f in SCHEMA.split(", ")])

    return texts(docs).mapInArrow(batches, SCHEMA)


def masked(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """The documents, every column kept, with each span of text replaced by its kind in brackets.

    n_chars, where there is such a column, counts the new text.
    """
    schema = docs.schema

    def hide(text: str | None, spans: list) -> str | None:
        if not spans:
            return text
        out, last = [], 0
        for a, b, kind in sorted(spans):
            if a >= last:
                out += [text[last:a], f"[{kind.upper()}]"]
            last = max(last, b)
        return "".join([*out, text[last:]])

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            k = batch.schema.get_field_index("text")
            old = batch.column(k).to_pylist()
            found = find(tagger, [t or "" for t in old])
            new = [hide(t, base + added) for t, (base, added) in zip(old, found)]
            columns = list(batch.columns)
            columns[k] = pa.array(new, batch.schema.field(k).type)
            n = batch.schema.get_field_index("n_chars")
            if n >= 0:
                kept = columns[n].to_pylist()
                columns[n] = pa.array([len(b) if a != b else c for a, b, c in zip(old, new, kept)], batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    importable(docs)
    return docs.mapInArrow(batches, schema)
