"""The ten operators against plain versions, on whole sf0.001 and on awkward rows."""

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loadlens.llm import textbuf as B
from loadlens.llm import (anchor_dedup, cover, decontaminate, fertility, ftrl, hash_tree, hilbert_pack, oracle, pii_rules, pii_tagger,
                          queries, rff_quality, simhash, suffix_dedup)
from tests.llm import brute

SF = "/root/testdata/sf0.001"
rng = random.Random(3)
_PASSAGE = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(80))
_LONG = " ".join("".join(rng.choice("aeioust") for _ in range(rng.randint(1, 9))) for _ in range(6000))
#: null and empty texts, ties, repeated rows, a null id, very long texts, odd white space, other scripts
AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (4, "one"), (None, "two words"), (5, _PASSAGE), (6, "before " + _PASSAGE + " after"),
    (7, _PASSAGE), (8, _LONG), (9, _LONG[:9000] + " changed " + _LONG[9000:]), (10, "word " * 400), (11, "ab" * 300), (12, "é" * 150 + "日本語 テキスト"),
    (13, "x y z \x1c a\x0bb\x0cc"), (14, "A@b.co +1 (555) 123-4567, 10.0.0.256 10.0.0.25; 4111 1111 1111 1111"), (15, "<|endoftext|> it's 123 Ñandú ΑΣ"),
    (16, _PASSAGE.upper()), (17, "Aa " + _PASSAGE), (18, "1" * 5000), (19, "a@" * 500 + "a.b"), (20, "+" * 300 + "1" * 12),
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(d, t, "s", 7, 0.5) for d, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, chunk string, shard int, score double")


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def same(df, columns, expected):
    got = sorted(map(repr, (tuple(r) for r in df.select("doc_id", *columns).collect())))
    assert got == sorted(map(repr, expected))


def vocabularies():
    return queries.tokenizer_path("byte_bpe_50k.tiktoken"), queries.tokenizer_path("piece_bpe_32k.model")


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_fertility_counts(which, request):
    df = request.getfixturevalue(which)
    expected = []
    for d, t in rows_of(df):
        n = brute.rule_counts(t or "")
        expected.append((d, *n, n[0] < 20 or 100 * n[4] > 30 * n[0]))
    same(fertility.measure(df, *vocabularies()), ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"], expected)


def test_fertility_verdict(docs, spark):
    out = fertility.measure(docs, *vocabularies())
    assert out.where("kept AND base_failed").count() == 0
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = out.join(labels, "doc_id").where("quality = 1 AND NOT base_failed")
    assert good.where("NOT kept").count() == 0
    odd = spark.createDataFrame([(1, " ".join(chr(0x12000 + k) + chr(0x12007 + k) for k in range(60))), (2, " ".join(f"zq{k}xj{k * 7}" for k in range(99)))],
                                "doc_id long, text string")
    got = {r["doc_id"]: r for r in fertility.measure(odd, *vocabularies()).collect()}
    assert not got[1]["kept"] and got[1]["byte_share"] > 0.8


@pytest.mark.parametrize("which", ["docs", "awkward"])
@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 20_000, "bucket_names": 500}])
def test_suffix_dedup(which, sizes, request):
    df = request.getfixturevalue(which)
    data = rows_of(df)
    expected = [(d, *r) for (d, _), r in zip(data, brute.byte_result([t for _, t in data]))]
    same(suffix_dedup.remove(df, **sizes), ["n_bytes", "n_removed", "n_spans", "kept_sha256"], expected)


@pytest.mark.parametrize("which", ["docs", "awkward"])
@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 20_000, "bucket_names": 500}])
def test_anchor_dedup(which, sizes, request):
    df = request.getfixturevalue(which)
    data = rows_of(df)
    expected = [(d, *r) for (d, _), r in zip(data, brute.word_result([t for _, t in data]))]
    same(anchor_dedup.remove(df, **sizes), ["n_words", "n_removed", "kept_sha256"], expected)


def test_dedup_texts(awkward):
    kept = {r["doc_id"]: r["kept"] for r in anchor_dedup.remove(awkward, result=anchor_dedup.texts_kept, schema="doc_id long, kept string").collect()}
    assert kept[6] == "before after" and kept[5] == "" and kept[1] == ""
    raw = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove(awkward, result=suffix_dedup.texts_kept, schema="doc_id long, kept binary").collect()}
    assert raw[5] == b"" and raw[4] == b"one"


@pytest.mark.parametrize("period", sorted(cover.DIFFERENCE_SETS))
def test_difference_sets(period):
    members = cover.DIFFERENCE_SETS[period]
    assert {(a - b) % period for a in members for b in members} == set(range(period))


def test_packed_names():
    r = np.random.default_rng(1)
    first, second = r.integers(0, 2**64, (2, 1000), dtype=np.uint64)
    for bits in (0, 5, 16):
        for width in cover.widths(10**9, bits).values():
            a, b = width.short(first, second)
            more = r.integers(0, 255, (1000, width.more)).astype(np.uint8)
            x, y, z = width.of_bytes(width.to_bytes(a, b, more).tobytes())
            low = np.uint64(2 ** (8 * width.first) - 1)
            assert (x == a & low).all() and (z == more).all() and (not width.second or (y == b).all())
            assert ((width.bucket(a).astype(np.uint64) << np.uint64(8 * width.first) | x) == a).all()


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_simhash(which, request):
    df = request.getfixturevalue(which)
    data = rows_of(df)
    marks = [brute.simhash(t) for _, t in data]
    ids = brute.component_ids([d for d, _ in data], marks)
    same(simhash.near_duplicates(df), ["fingerprint", "component_id"], [(d, f"{m:016x}", c) for (d, _), m, c in zip(data, marks, ids)])


def test_covering_masks_guarantee():
    r = np.random.default_rng(2)
    masks = np.array(simhash.covering_masks(4), np.int64)
    assert len(masks) == 31
    for _ in range(3000):
        a, flip = r.integers(-2**63, 2**63), np.int64(0)
        for b in r.choice(64, r.integers(0, 5), replace=False):
            flip ^= np.int64(np.uint64(1 << int(b)).astype(np.int64))
        assert ((a & masks) == ((a ^ flip) & masks)).any()


def test_forest_links_what_all_pairs_link():
    r = np.random.default_rng(6)
    marks = r.integers(-2**63, 2**63, 30)
    for _ in range(4):  # flips of every bit, the sign bit too
        marks = np.unique(np.concatenate([marks, (marks.view(np.uint64) ^ (np.uint64(1) << r.integers(0, 64, len(marks)).astype(np.uint64))).view(np.int64)]))
    marks = np.concatenate([marks, ~marks[:20], -marks[:20]])
    marks = np.unique(marks)
    ids = brute.component_ids(list(range(len(marks))), [int(m) & (2**64 - 1) for m in marks])
    at = {int(m): k for k, m in enumerate(marks)}
    root = list(range(len(marks)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in simhash.forest(marks, 4):
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 4
        root[find(at[a])] = find(at[b])
    groups = [find(k) for k in range(len(marks))]
    assert len(set(groups)) == len(set(ids)) and len({*zip(groups, ids)}) == len(set(ids))


def test_big_buckets_keep_every_link(monkeypatch):
    monkeypatch.setattr(simhash, "BIG", 10)
    r = np.random.default_rng(4)
    marks = r.integers(-2**63, 2**63, 40)
    for _ in range(3):
        marks = np.unique(np.concatenate([marks, marks ^ (np.int64(1) << r.integers(0, 62, len(marks)))]))
    links = simhash.bucket_links(marks, 4, simhash.covering_masks(4, 80))
    root = {int(m): int(m) for m in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 4
        root[find(a)] = find(b)
    whole = simhash.forest(marks, 4)
    assert len({find(int(m)) for m in marks}) == len(marks) - len(whole)


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 101), (102, 101), (5, 200), (7, 7)]
    from loadlens.llm.components import components
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in [*range(61), 200]) and got[100] == got[101] == got[102] == 100
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / max(1, pos.sum() * (~pos).sum())


@pytest.mark.parametrize("name, label, modulus, held", [("op4_rff_quality", "quality", 5, 0), ("op5_ftrl_toxicity", "toxic", 3, 1)])
def test_classifiers_on_held_out_rows(spark, name, label, modulus, held):
    sf = "/root/testdata/sf0.1"
    out = queries.QUERIES[name](spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    got = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(d).encode()) % modulus == held) for d, h in zip(got.doc_id, got.held_out))
    got = got[got.held_out]
    assert got.score.between(0, 1).all()
    assert auc(got.score.to_numpy(), got[label].to_numpy()) > 0.95
    assert (got.predicted == got[label]).mean() > 0.95


def test_classifiers_read_no_held_out_label(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r["doc_id"]: r["score"] for r in rff_quality.quality(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in rff_quality.quality(docs, turned).collect()}
    assert a == pytest.approx(b)


def test_classifiers_awkward(spark, awkward, empty):
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for f in (rff_quality.quality, ftrl.toxicity):
        got = f(awkward, none).collect()
        assert len(got) == len(AWKWARD) and all(r["score"] == 0.5 for r in got)
        assert f(empty, none).count() == 0
    some = spark.createDataFrame([(5, 1, 0), (5, 0, 1), (6, 0, 1), (8, 1, 0), (9, 1, 0), (10, 0, 0), (11, 0, 0)], "doc_id long, quality int, toxic int")
    for f in (rff_quality.quality, ftrl.toxicity):
        assert all(0 <= r["score"] <= 1 for r in f(awkward, some).collect())


def test_isotonic():
    x, w, t = np.arange(6.0), np.array([1, 2, 1, 1, 3, 1.0]), np.array([0, 2, 0, 1, 2, 1.0])
    at, value = rff_quality.isotonic(x, w, t)
    assert (np.diff(value) >= 0).all() and math.isclose((np.interp(x, at, value) * w).sum(), t.sum(), rel_tol=0.25)


def test_ftrl_is_sparse(spark):
    rows = [(k, " ".join(rng.choice(["sun", "tree", "stone", "river", "cloud", "grass"]) for _ in range(30)) + (" vile" if k % 3 == 0 else "")) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)], "doc_id long, toxic int")
    got = ftrl.toxicity(docs, labels).toPandas()
    assert ((got.score > 0.7) == (got.doc_id % 3 == 0)).all()
    model = ftrl.fit(docs, labels.select("doc_id", F.col("toxic").alias("y")))
    assert len(model.index) < 200


def smith_waterman(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        best, row = max(best, *new), new
    return best


def test_alignment():
    pairs = [([rng.randrange(8) for _ in range(rng.randint(1, 40))], [rng.randrange(8) for _ in range(rng.randint(1, 25))]) for _ in range(60)]
    got, _ = decontaminate.align([np.array(a, np.uint64) + np.uint64(1) for a, _ in pairs], [np.array(b, np.uint64) + np.uint64(1) for _, b in pairs])
    assert got.tolist() == [smith_waterman(a, b) for a, b in pairs]


def test_decontamination(spark, docs, awkward, empty):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs, bench).collect()}
    token = lambda t: [w for w in __import__("re").split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t.lower()) if w]
    items = {i: token(t) for i, t in [tuple(r) for r in bench.select("item_id", "text").collect()]}
    strong = set()
    for d, t in rows_of(docs):
        words = token(t)
        seen = set(words)
        for i, item in items.items():
            if sum(w in seen for w in item) >= 0.6 * len(item):
                s = smith_waterman(words, item) / (2 * len(item))
                if (d, i) in got:
                    assert got[d, i]["score"] == pytest.approx(s)
                if s >= 0.75:
                    strong.add((d, i))
                if s < 0.6:
                    assert (d, i) not in got
    assert strong and strong <= set(got)
    tests = spark.createDataFrame([(1, _PASSAGE), (2, None), (3, ""), (4, "two words"), (1, _PASSAGE)], "item_id long, text string")
    found = [(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(awkward, tests).collect()]
    assert sorted(x for x, i in found if i == 1 and x) == [5, 5, 6, 6, 7, 7, 16, 16, 17, 17] and (None, 4) in found
    assert decontaminate.contaminated(empty, tests).count() == decontaminate.contaminated(awkward, tests.limit(0)).count() == 0


def test_decontamination_of_edited_copies_in_blocks(spark):
    r = random.Random(9)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    items = [[r.choice(vocabulary) for _ in range(36)] for _ in range(30)]
    rows = []
    for k, item in enumerate(items):
        edited = [w if r.random() > 0.12 else r.choice(vocabulary) for w in item]
        rows.append((k, " ".join([r.choice(vocabulary) for _ in range(200)] + edited + [r.choice(vocabulary) for _ in range(90)])))
        rows.append((1000 + k, " ".join(r.choice(vocabulary) for _ in range(300))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tests = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.contaminated(docs, tests, score=0.5, block_bytes=2000).collect()}
    assert got == {(k, k) for k in range(30)}


def made_items(n, size, seed):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(4000)]
    return r, vocabulary, [[r.choice(vocabulary) for _ in range(size)] for _ in range(n)]


def inside(copy, r, vocabulary):
    return " ".join([r.choice(vocabulary) for _ in range(40)] + copy + [r.choice(vocabulary) for _ in range(40)])


def test_decontamination_of_an_exact_and_an_edited_copy(spark):
    r, vocabulary, items = made_items(80, 36, 12)
    rows = []
    for k, item in enumerate(items):
        edited = list(item)
        for place in range(4, 36, 5) if k % 2 else r.sample(range(36), 8):
            edited[place] = r.choice(vocabulary)
        rows += [(k, inside(item, r, vocabulary)), (1000 + k, inside(edited, r, vocabulary))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tests = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.contaminated(docs, tests).collect()}
    assert got == {(d, k) for k in range(80) for d in (k, 1000 + k)}


def test_decontamination_of_dense_insertions_and_short_items(spark):
    r, vocabulary, items = made_items(6, 40, 13)
    items += [i[:k] for i, k in zip(items, (2, 3, 4, 5, 6, 20))]
    rows = []
    for k, item in enumerate(items):
        every = 1 if len(item) < 6 else 2  # a word is put in after so many
        edited = [x for j, w in enumerate(item) for x in ([w, r.choice(vocabulary)] if (j + 1) % every == 0 and j + 1 < len(item) else [w])]
        rows.append((k, inside(edited, r, vocabulary)))
        moved = item[: len(item) // 2] + [r.choice(vocabulary) for _ in range(int(0.8 * len(item)))] + item[len(item) // 2 :]
        rows.append((100 + k, inside(moved, r, vocabulary)))
    token = {d: t.split() for d, t in rows}
    expected = {(d, k) for d, t in token.items() for k, i in enumerate(items) if smith_waterman(t, i) >= 1.2 * len(i) - 1e-9}
    assert {(d, k) for k in range(12) for d in (k, 100 + k)} <= expected
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tests = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["score"] for x in decontaminate.contaminated(docs, tests).collect()}
    assert set(got) == expected
    assert got == pytest.approx({(d, k): smith_waterman(token[d], items[k]) / (2 * len(items[k])) for d, k in expected})


@pytest.fixture(scope="module")
def tagger(docs):
    return pii_tagger.train(docs)


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_pii_base(which, request, tagger):
    df = request.getfixturevalue(which)
    expected = []
    for d, t in rows_of(df):
        spans = brute.personal(t or "")
        counts = [sum(k == s[2] for s in spans) for k in ("email", "ip", "card", "phone")]
        expected.append((d, *counts, hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()))
    out = pii_tagger.personal_data(df, tagger)
    same(out, ["n_email", "n_ip", "n_card", "n_phone", "base_sha256"], expected)
    base = {d: {f"{k}:{a}:{b}" for a, b, k in brute.personal(t or "")} for d, t in rows_of(df)}
    assert all(base[r["doc_id"]] <= set(r["spans"].split(",")) for r in out.collect())


def test_pii_patterns_on_random_strings():
    r = random.Random(5)
    for _ in range(4000):
        t = "".join(r.choice("ab1290@@..--+ ()%_") for _ in range(r.randint(0, 60)))
        assert pii_rules.base_spans(t) == brute.personal(t), t


def test_pii_tagger_learns(tagger):
    found = good = wanted = 0
    for text, spans in pii_tagger.drawn(300, seed=123):
        got = pii_tagger.tag(tagger, [text])[0]
        found, good, wanted = found + len(got), good + len(set(got) & set(spans)), wanted + len(spans)
    assert good / found > 0.9 and good / wanted > 0.9


def test_pii_gradient():
    text, spans = pii_tagger.drawn(1, seed=3)[0]
    model = pii_tagger.Tagger.new(1)
    chars, gold = pii_tagger.batch_of([pii_tagger.classes(text), pii_tagger.classes(text)[:9]]), pii_tagger.batch_of(
        [pii_tagger.tags_of(len(text), spans), pii_tagger.tags_of(len(text), spans)[:9]])
    _, grad = model.learn(chars, gold)
    r = np.random.default_rng(0)
    for name, value in model.p.items():
        for _ in range(3):
            at = tuple(r.integers(0, n) for n in value.shape)
            if name == "embed":
                at = (int(chars[0, 0]), at[1])
            old = value[at]
            value[at] = old + 1e-5
            up, _ = model.learn(chars, gold)
            value[at] = old - 1e-5
            down, _ = model.learn(chars, gold)
            value[at] = old
            assert grad[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-4)


def test_pii_masked(spark, awkward, tagger):
    got = {r["doc_id"]: r for r in pii_tagger.masked(awkward.withColumn("n_chars", F.length("text").cast("long")), tagger).collect()}
    assert got[14]["text"].startswith("[EMAIL] [PHONE]") and "4111" not in got[14]["text"]
    assert got[14]["n_chars"] == len(got[14]["text"]) and got[14]["chunk"] == "s" and got[1]["text"] is None


def test_pii_long_spans_cross_windows(tagger):
    text = "word " * 40 + "user.name99@mail7.example.com and 192.168.10.77 " + "7" * 300
    assert pii_rules.base_spans(text)[0][2] == "email"
    assert len(pii_tagger.find(tagger, [text])[0][0]) == 2


def test_pii_long_addresses_are_tagged_and_masked_whole(spark, tagger):
    addresses = ["info@bäckerei-schwarzwald.de", "maximilian.großmann@firma.de", "geschäftsleitungssekretariat@firma.de",
                 "müller.hans@gärtnerei-niederösterreich.example.com", "søren.kierkegård@universitet.dk", "info@straßenverkehrsgenossenschaft.de",
                 "größte." + "abteilung." * 9 + "leitung@firma.de", "max.muster@" + "hauptabteilung-" * 6 + "süd.example.com"]
    rows = [(k, f"please write to {a} about it") for k, a in enumerate(addresses)]
    for (_, text), a, (base, added) in zip(rows, addresses, pii_tagger.find(tagger, [t for _, t in rows])):
        at = text.index(a)
        assert base == brute.personal(text) and added == [(at, at + len(a), "email")], a
    got = pii_tagger.masked(spark.createDataFrame(rows, "doc_id long, text string"), tagger).collect()
    assert {r["text"] for r in got} == {"please write to [EMAIL] about it"}
    long = "x" * 20_000 + "@" + "y" * 20_000
    assert pii_tagger.stretches("one " + long + " two") == [(4, 4 + len(long))]


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_hilbert_packing(which, request, spark):
    from tokenizers import Tokenizer

    df = request.getfixturevalue(which)
    path = queries.tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    expected = sorted([*tok.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows_of(df))
    for sizes in ({}, {"cell_rows": 3, "cell_bits": 6}):
        out = hilbert_pack.pack(df, path, **sizes).toPandas()
        assert len(out) >= len(expected)
        total = sum(map(len, expected))
        assert out.length.sum() == total and out.sequence_id.max() == (total - 1) // 2048
        for s, g in out.sort_values("offset").groupby("sequence_id"):
            assert (g.offset == np.concatenate([[0], np.cumsum(g.length)[:-1]])).all() and g.length.sum() <= 2048
            assert g.length.sum() == 2048 or s == out.sequence_id.max()
        ids = {}
        for d, t in rows_of(df):
            ids.setdefault(d, []).append([*tok.encode(t or "", add_special_tokens=False).ids, 1])
        for d, group in out.groupby("doc_id", dropna=False):
            own = ids[None if d != d else int(d)]
            assert group.length.sum() == sum(map(len, own))
            for r in group.itertuples():
                crcs = {zlib.crc32(np.array(x[r.start:r.start + r.length], "<u4").tobytes()) for x in own if len(x) == r.doc_tokens}
                assert r.ids_crc32 in crcs


def test_hilbert_packing_keeps_key_order_in_large_cells(docs, awkward):
    path = queries.tokenizer_path("word_bpe_49k.json")
    many = docs.select("doc_id", "text").union(awkward.select("doc_id", "text")).union(awkward.select("doc_id", "text"))
    for sizes in ({"cell_rows": 3, "cell_bits": 1}, {"cell_rows": 1, "cell_bits": 12}, {"cell_rows": 7, "cell_bits": 2}):
        out = hilbert_pack.pack(many, path, **sizes).toPandas().sort_values(["sequence_id", "offset"])
        assert out.hilbert_key.is_monotonic_increasing and (out.start == 0).sum() == many.count()


def test_words_encode_as_whole_texts():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    whole, words = Tokenizer.from_file(path), hilbert_pack.Words(path)
    r = random.Random(8)
    texts = ["".join(r.choice("aAbB\u00c9\u00e9\u00df\u0130\u03a3'.,!?;:-19 \n\t\u00a0\u0301_\U0001f600\u4e2d<|>") for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["end.", "...", "it's.", "<|endoftext|>.", "e\u0301.", "\u0301.", "A.B.", "x.,", "9.", ".a"]
    texts += ["<|EndOfText|>", "<|ENDOFTEXT|>.", "<|startoftext|>A"]
    for part in (texts, [t for t in texts if "<|" not in t]):
        ids, bounds = words.encode(*B.raw(pa.array(part)))
        check_ids(whole, part, ids, bounds)


def check_ids(whole, texts, ids, bounds):
    for t, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert [*whole.encode(t, add_special_tokens=False).ids, 1] == ids[a:b].tolist(), repr(t)


def test_hilbert_curve_is_a_curve():
    points = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = hilbert_pack.hilbert(points, 3)
    assert sorted(key.tolist()) == list(range(512))
    steps = np.abs(np.diff(points[np.argsort(key)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_hash_tree_oracle_and_law(spark, awkward, empty):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel = con.sql(oracle.ORACLE["op9_hash_tree_shards"])
    out = queries.op9_hash_tree_shards(spark, SF)
    assert sorted(map(repr, map(tuple, out.select(*rel.columns).collect()))) == sorted(map(repr, rel.fetchall()))
    tree = hash_tree.even_tree(2, 2, 2)
    got = hash_tree.assign(awkward, tree, hash_tree.with_shard(tree, 8), bin_rows=4).toPandas()
    assert len(got) == len(AWKWARD)
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert ((got.shard == got.grown_shard) | (got.grown_shard == 8)).all()
    assert hash_tree.assign(empty, tree).count() == 0


def test_hash_tree_bins_agree_with_sql(spark):
    """Over many bins too, which whole small tables never fill."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel = con.sql(oracle.ORACLE["op9_hash_tree_shards"].replace(f"// {hash_tree.BIN_ROWS} ", "// 9 "))
    tree = hash_tree.even_tree(2, 2, 2)
    out = hash_tree.assign(spark.read.parquet(f"{SF}/documents.parquet"), tree, hash_tree.with_shard(tree, 8), bin_rows=9)
    assert sorted(map(repr, map(tuple, out.select(*rel.columns).collect()))) == sorted(map(repr, rel.fetchall()))


def test_hash_tree_hot_ids_and_repeated_rows_are_spread(spark):
    """One id with many texts fills many bins; many copies of one row are unfolded by many tasks."""
    rows = (spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
            .unionByName(spark.range(50000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))))
    out = hash_tree.assign(rows, hash_tree.even_tree(2, 2, 2), bin_rows=500)
    got = out.withColumn("task", F.spark_partition_id()).toPandas()
    assert len(got) == 53000 and got.shard.nunique() <= 2
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    copies = got[got.doc_id.isna()].sort_values("slot")
    assert (np.diff(copies.slot) == 1).all()                               # one run
    assert copies.groupby("task").size().max() < len(copies) / 2
    many = got[got.doc_id == 7].sort_values("slot")
    assert (np.diff(many.text_crc32) < 0).sum() > 20                       # sorted within some hundred bins, not in one


def test_hash_tree_weights(spark):
    rows = spark.range(40000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    node = hash_tree.Node
    heavy = node("root", (node("a", (node("a.0", shard=0, own_weight=3.0), node("a.1", shard=1))), node("b", (node("b.0", shard=2),))))
    lighter = node("root", (node("a", (node("a.0", shard=0, own_weight=1.0), node("a.1", shard=1))), node("b", (node("b.0", shard=2),))))
    got = hash_tree.assign(rows, heavy, lighter).toPandas()
    share = got.groupby("shard").size() / len(got)
    assert abs(share[0] - 0.6) < 0.02 and abs(share[1] - 0.2) < 0.02
    moved = got[got.shard != got.grown_shard]
    assert len(moved) and (moved.shard < 2).all() and (moved.grown_shard > 0).all()


def test_empty_tables(empty):
    path = queries.tokenizer_path("word_bpe_49k.json")
    for df in (fertility.measure(empty, *vocabularies()), suffix_dedup.remove(empty), anchor_dedup.remove(empty), simhash.near_duplicates(empty),
               hilbert_pack.pack(empty, path), pii_tagger.personal_data(empty, pii_tagger.Tagger.new())):
        assert df.count() == 0


def test_lowered():
    text = "ÀÉÞ×÷ßÿAz Ωж İŸ"
    assert B.lowered(np.frombuffer(text.encode(), np.uint8)).tobytes().decode() == "àéþ×÷ßÿaz Ωж İŸ"
