"""Plain versions of the operators' contracts, for small inputs."""

import collections
import hashlib
import itertools
import math
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rule_counts(text):
    words = WORD.findall(text)
    grams = collections.Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
    inside = {p for k in range(len(words) - 7) if grams[tuple(words[k:k + 8])] > 1 for p in range(k, k + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside)


def removed(sequences, length):
    """A mask per sequence: units inside a window that starts anywhere else too."""
    starts = collections.Counter(tuple(s[k:k + length]) if not isinstance(s, bytes) else s[k:k + length]
                                 for s in sequences for k in range(len(s) - length + 1))
    out = []
    for s in sequences:
        mask = [False] * len(s)
        for k in range(len(s) - length + 1):
            w = s[k:k + length] if isinstance(s, bytes) else tuple(s[k:k + length])
            if starts[w] > 1:
                mask[k:k + length] = [True] * length
        out.append(mask)
    return out


def byte_result(texts, length=200):
    texts = [(t or "").encode() for t in texts]
    rows = []
    for t, m in zip(texts, removed(texts, length)):
        kept = bytes(b for b, x in zip(t, m) if not x)
        spans = sum(x and (k == 0 or not m[k - 1]) for k, x in enumerate(m))
        rows.append((len(t), sum(m), spans, hashlib.sha256(kept).hexdigest()))
    return rows


def word_result(texts, length=35):
    words = [WORD.findall(t or "") for t in texts]
    return [(len(w), sum(m), hashlib.sha256(" ".join(x for x, gone in zip(w, m) if not gone).encode()).hexdigest())
            for w, m in zip(words, removed(words, length))]


def simhash(text, n=4):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[k:k + n]) for k in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_ids(ids, marks, radius=4):
    root = list(range(len(ids)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(ids)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for k, d in enumerate(ids):
        groups[find(k)].append(d)
    return [min((d for d in groups[find(k)] if d is not None), default=None) for k in range(len(ids))]


def personal(text):
    """(start, end, kind) by the patterns as they are written in the contract."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        doubled = [x if k % 2 == 0 else x * 2 - (9 if x > 4 else 0) for k, x in enumerate(reversed(d))]
        if 14 <= len(d) <= 19 and sum(doubled) % 10 == 0:
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return [(a, b, k) for a, _, b, k in sorted(out)]


def lloyd(rows, parts=4, entries=256, rounds=4, scale=1024):
    """rows of (vec_id, vector, label): [(vec_id, code, error, label_error)], codebooks' sha256, in plain loops of integers."""
    kept = []
    for v, x, label in rows:
        if x is not None and all(c is not None and math.isfinite(c) for c in x):
            kept.append((v, [math.floor(scale * c) for c in x], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts if kept else 0
    cut = [[x[p * width:(p + 1) * width] for p in range(parts)] for _, x, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = collections.defaultdict(list)
            for c in cut:
                held[best(c[p], books[p])[1]].append(c[p])
            for k, members in held.items():
                books[p][k] = [sum(x) // len(members) for x in zip(*members)]
    out, by_label = [], collections.Counter()
    for (v, _, label), c in zip(kept, cut):
        found = [best(c[p], books[p]) for p in range(parts)]
        out.append((v, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        by_label[label] += out[-1][2]
    text = ",".join(str(x) for book in books for e in book for x in e)
    return [(v, code, e, by_label[label]) for v, code, e, label in out], hashlib.sha256(text.encode()).hexdigest()


def filter_steps(docs, labels):
    """docs of (doc_id, text, lang), labels of (doc_id, quality, toxic): the audit's rows by applying every order."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    parts = collections.defaultdict(list)
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    for d, t, lang in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": d is not None and t in least and least[t] < d}
        parts[lang or ""].append(({k for k, x in fails.items() if x}, d in good, d in toxic))
    out = []
    for part, rows in parts.items():
        removals = collections.Counter()
        steps = []
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[0]]
                left = [r for r in left if name not in r[0]]
                removals[name] += len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), sum(name in r[0] for r in rows) - len(gone),
                              sum(r[0] == {name} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone), name))
        out += [(*s[:-1], removals[s[-1]]) for s in steps]
    return out
