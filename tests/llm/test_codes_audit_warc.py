"""Vector codes, filter audit and WARC archives: plain versions, SQL, awkward rows, skew and damaged archives."""

import collections
import gzip
import hashlib
import io
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens.llm import filter_audit, oracle, queries, vector_codes, warc
from tests.llm import brute

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
TABLES = ["documents", "embeddings", "pages", "labels"]
NAMES = ["op11_resident_lloyd", "op12_filter_audit", "op13_warc"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    got = sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
    sql = con.execute(oracle.ORACLE[name])
    columns = [d[0] for d in sql.description]
    at = [columns.index(c) for c in sorted(columns)]
    assert sorted(columns) == sorted(df.columns)
    assert got == sorted(repr(tuple(r[k] for k in at)) for r in sql.fetchall())


@pytest.mark.parametrize("name", NAMES)
def test_no_all_pairs(spark, capsys, name):
    df = queries.QUERIES[name](spark, SF)
    df.explain()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", capsys.readouterr().out)


# --- vector codes

def vectors(spark, rows):
    return spark.createDataFrame([(v, x, label, 1, "a") for v, x, label in rows],
                                 "vec_id long, embedding array<float>, label int, ints int, code string")


def codes(spark, rows, **sizes):
    df, books = vector_codes.compress(vectors(spark, rows), **sizes)
    return sorted(map(repr, map(tuple, df.select("vec_id", "code", "error", "label_error").collect()))), books.sha256()


def expected(rows, **sizes):
    out, sha = brute.lloyd(rows, **sizes)
    return sorted(map(repr, out)), sha


def drawn(n, dims, seed):
    r = random.Random(seed)
    return [[float(np.float32(r.gauss(k % 3, 0.4))) for k in range(dims)] for _ in range(n)]


def test_codes_against_loops(spark):
    rows = [(7 * k % 331, x, k % 4) for k, x in enumerate(drawn(330, 8, 1))]
    sizes = {"entries": 20, "rounds": 4}
    assert codes(spark, rows, **sizes) == expected(rows, **sizes)
    assert codes(spark, rows, partitions=13, **sizes) == expected(rows, **sizes)


def test_codes_awkward_rows(spark):
    x = drawn(12, 8, 2)
    rows = [(1, x[0], 1), (1, x[0], 1), (1, x[1], None), (None, x[2], 2), (2, None, 1), (3, [1.0] * 7 + [NAN], 1), (4, [INF] + [0.0] * 7, 1),
            (5, [None] + [0.0] * 7, 2), (6, [-0.0] * 8, None), (7, [-1e-7] * 8, 3), (8, [1000.5, -1000.5] * 4, 3), (9, x[3], 3)]
    rows += [(20 + k, x[4 + k], k % 2) for k in range(8)]
    for sizes in ({"entries": 4}, {"entries": 256}, {"entries": 1, "rounds": 1}, {"entries": 3, "rounds": 0}):
        assert codes(spark, rows, **sizes) == expected(rows, **sizes)
    # what no long can hold, and other lengths, are left out
    odd = [*rows, (50, [3e38] * 8, 1), (51, [1.0] * 4, 1), (52, [], 1)]
    assert codes(spark, odd, entries=4) == expected(rows, entries=4)


def test_codes_of_an_empty_table(spark):
    for rows in ([], [(1, None, 1)], [(1, [NAN] * 8, 1)]):
        got, sha = codes(spark, rows)
        assert got == [] and sha == hashlib.sha256(b"").hexdigest()
    got, _ = codes(spark, [(1, [], 1), (2, [], 1)])
    assert len(got) == 2


def test_codes_of_large_components(spark):
    rows = [(k, [float(np.float32(c * 30_000)) for c in x], 0) for k, x in enumerate(drawn(60, 8, 3))]
    assert codes(spark, rows, entries=6) == expected(rows, entries=6)


def test_hot_vector_is_one_member(spark):
    rows = [(k, [0.5] * 8, 0) for k in range(3000)] + [(5000 + k, x, 1) for k, x in enumerate(drawn(100, 8, 4))]
    assert codes(spark, rows, entries=9) == expected(rows, entries=9)
    kept = vector_codes.integers(vectors(spark, rows), 1024)
    assert vector_codes.distinct_parts(kept, 4, 2).where("weight >= 3000").count() == 4


def test_hot_entry_is_salted():
    weights = np.array([10_000] + [10] * 99)
    owners = vector_codes.owners_for(weights, 100, 8)
    assert owners.salts[0] >= 8 and owners.salts[1:].max() == 1
    hashes = np.random.default_rng(0).integers(-2**63, 2**63 - 1, 10_000)
    own = owners.of(0, np.zeros(10_000, np.int64), hashes)
    spread = np.bincount(own % 8, minlength=8)
    assert spread.max() < 2 * spread.min()
    assert {owners.slot(int(x)) for x in np.unique(own)} == {0}
    assert all(owners.slot(int(owners.first[k])) == k for k in range(100))


def test_only_members_that_change_entry_migrate(spark):
    rows = [(k, x, 0) for k, x in enumerate(drawn(600, 8, 5))]
    kept = vector_codes.integers(vectors(spark, rows), 1024)
    books = vector_codes.first_codebooks(kept, 4, 12, 2)
    members = vector_codes.distinct_parts(kept, 4, 2)
    owners = vector_codes.owners_for(vector_codes.first_members(members, books, 2), 12, 5)
    first = vector_codes.settle(members, books, owners, 2, 5)
    renewed = vector_codes.renewed(books, vector_codes.entry_sums(first, owners, 2))
    tagged, second = vector_codes.migrate(first, renewed, owners, 5)

    def where(rdd):
        return {(owners.slot(own) // 12, tuple(m)): (part, own) for part, own, m in
                rdd.mapPartitionsWithIndex(lambda k, it: [(k, own, m) for own, (_, _, ms) in it for m in ms.tolist()]).collect()}

    before, after = where(first), where(second)
    assert second.partitioner == first.partitioner and set(before) == set(after)
    assert all(part == own % 5 for part, own in after.values())
    changed = {k for k in before if owners.slot(before[k][1]) != owners.slot(after[k][1])}
    sent = tagged.filter(lambda x: x[1][0] is not None).map(lambda x: len(x[1][1])).sum()
    assert 0 < len(changed) == sent < len(before)
    assert all(before[k] == after[k] for k in before if k not in changed)
    # one shuffle lineage for the arrivals alone: the stays' side is a narrow dependency
    assert "PartitionerAwareUnionRDD" in second.toDebugString().decode()
    tagged.unpersist()


# --- filter audit

def audited(df, labels):
    return sorted(map(repr, map(tuple, filter_audit.audit(df, labels).collect())))


def test_audit_against_every_order(spark):
    words = [f"w{k}" for k in range(400)]
    r = random.Random(6)
    long = " ".join(words[:260])
    docs = [(k, " ".join(r.choices(words, k=r.choice([5, 250, 300]))) + r.choice(["", " #", " " + "AB" * 60]), r.choice(["en", "de", None])) for k in range(60)]
    docs += [(100 + k, long, "en") for k in range(9)] + [(90, long, "fr"), (90, long, "fr"), (90, long + " x", "fr"), (None, long, "en"), (None, None, "de"),
             (200, None, "de"), (201, "", "de"), (202, "  \t\n", ""), (203, "ÄÖ" * 500 + " É", "de"), (204, "a\x1cb " * 300, "de")]
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 210, 2)] + [(4, 0, 0), (4, 1, 1), (None, 1, 1), (100, None, None)]
    labels = [(d, q, None if t is None else int(t)) for d, q, t in labels]
    df = spark.createDataFrame([(*d, 0, "x", 3) for d in docs], "doc_id long, text string, lang string, bits int, h string, n int")
    marks = spark.createDataFrame([(*x, 1) for x in labels], "doc_id long, quality int, toxic int, n int")
    want = sorted(map(repr, brute.filter_steps(docs, labels)))
    assert audited(df, marks) == want and len(want) == 600 * len({d[2] or "" for d in docs})
    assert audited(df.limit(0), marks) == []
    assert audited(df, marks.limit(0)) == sorted(map(repr, brute.filter_steps(docs, [])))


def test_audit_whole_table(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    want = brute.filter_steps([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert audited(docs, labels) == sorted(map(repr, want))


def test_audit_of_long_texts_and_many_copies(spark):
    docs = [(k, "same text", "en") for k in range(4000)] + [(9000, "A" * 3_000_000, "en"), (9001, " " * 3_000_000, "en"), (9002, "w " * 700_000, "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audited(df, labels) == sorted(map(repr, brute.filter_steps(docs, [])))


def test_audit_of_other_filters(spark):
    df = spark.createDataFrame([(1, "a b", "en"), (2, "a b", "en"), (3, "long enough text", "en")], "doc_id long, text string, lang string")
    out = filter_audit.audit(df, spark.createDataFrame([], "doc_id long, quality int, toxic int"), {"S": F.size("words") < 3, "E": None})
    rows = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in out.collect()}
    assert rows == {("SE", 1): (1, 2, 0, 1, 3), ("SE", 2): (1, 0, 1, 0, 1), ("ES", 1): (2, 1, 0, 0, 1), ("ES", 2): (1, 1, 1, 1, 3)}


# --- WARC

def plain_pages(pages, least=1000):
    top = {}
    for p, html in pages:
        top[html or ""] = max(top.get(html or "", -1), -1 if p is None else p)
    out = []
    for p, html in pages:
        html = html or ""
        data, first = html.encode(), top[html]
        again = len(data) >= least and p != first and not (p is None and first == -1)
        out.append((p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(map(repr, out))


def read_back(df):
    return sorted(map(repr, map(tuple, df.select("key", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())))


LARGE = "<p>é" * 400
PAGES = [(1, "http://a", LARGE), (2, "http://b", LARGE), (3, None, LARGE), (4, "http://a", "small"), (5, "http://c", "small"), (6, "", None), (7, "x\r\ny: z", ""),
         (None, "n", LARGE), (None, "n", "m" * 1000), (8, "r", "s" * 2000), (8, "r", "s" * 2000), (9, "crlf", "\r\n\r\n" * 600 + "WARC/1.1\r\n"), (10, "long", "z y " * 1_200_000)]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, "q", 1) for p in PAGES], "page_id long, url string, html string, key string, size int")


def test_warc_round_trip(pages, spark):
    out = warc.round_trip(pages, "page_id", "url", "html")
    assert read_back(out) == plain_pages([(p, h) for p, _, h in PAGES])
    assert warc.round_trip(pages.limit(0), "page_id", "url", "html").count() == 0


def test_warc_hot_payload(spark):
    rows = [(k, "u", LARGE) for k in range(2000)] + [(5000 + k, "u", LARGE + str(k)) for k in range(50)]
    out = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"), "page_id", "url", "html")
    assert read_back(out) == plain_pages([(p, h) for p, _, h in rows])


def test_archives_are_standard(pages, spark, tmp_path):
    manifest = warc.write(pages, "page_id", "url", "html", str(tmp_path / "w"), archive_bytes=2000).collect()
    assert sum(m["records"] for m in manifest) == len(PAGES) and len(manifest) > 2
    kinds = collections.Counter()
    for m in manifest:
        data = open(m["path"], "rb").read()
        assert len(data) == m["bytes"]
        whole = gzip.decompress(data)   # concatenated members are one valid gzip file
        members = []
        while data:   # and every member is exactly one record
            inflate = warc.zlib.decompressobj(31)
            members.append(inflate.decompress(data))
            data = inflate.unused_data
        assert b"".join(members) == whole and len(members) == m["records"]
        for r in members:
            assert r.startswith(b"WARC/1.1\r\nWARC-Type: ") and r.endswith(b"\r\n\r\n")
            kinds[re.search(rb"WARC-Type: (\w+)", r)[1]] += 1
    assert kinds[b"revisit"] == 3   # of LARGE: 1, 2 and the null page


def test_records_of_any_block_size():
    data = b"".join(warc.member(warc.record(k, "u", p.encode(), hashlib.sha1(p.encode()).digest(), len(p.encode()))) for k, p in enumerate(["", "a", LARGE, "\x00" * 300_000]))
    want = [(0, ""), (1, "a"), (2, LARGE), (3, "\x00" * 300_000)]
    for block in (1, 7, 1000, 1 << 20):
        if block == 1:
            part = b"".join(warc.member(warc.record(k, "u", b"x", hashlib.sha1(b"x").digest(), 1)) for k in range(3))
            assert [r.payload for r in warc.records_of(io.BytesIO(part), 1)] == [b"x"] * 3
            continue
        got = list(warc.records_of(io.BytesIO(data), block))
        assert [(int(r.headers["x-row-key"]), r.payload.decode()) for r in got] == want and not any(r.problem for r in got)
        assert [r.offset for r in got] == sorted(r.offset for r in got) and got[0].offset == 0
        for r in got:   # offsets are where members begin
            assert next(iter(warc.records_of(io.BytesIO(data[r.offset:])))).payload == r.payload


def problems(data):
    return [r.problem for r in warc.records_of(io.BytesIO(data), 64)]


def test_damaged_archives():
    body = b"payload" * 50
    raw = warc.record(1, "u", body, hashlib.sha1(body).digest(), len(body))
    good = warc.member(raw)
    assert problems(good + good) == [None, None] and problems(b"") == []
    assert problems(good + good[:-4]) == [None, "archive ends inside a member"]
    assert problems(good + b"garbage")[1].startswith("not a gzip member")
    assert problems(good[:-8] + bytes(4) + good[-4:] + good)[0].startswith("not a gzip member")
    assert problems(warc.member(raw.replace(b"payloadpayload", b"payloadPAYLOAD", 1)) + good) == ["block digest differs", None]
    assert problems(warc.member(raw[:-6] + b"\r\n\r\n") + good) == ["Content-Length does not frame the record", None]
    assert problems(warc.member(raw + b"x") + good) == ["Content-Length does not frame the record", None]
    assert problems(warc.member(b"nothing") + good) == ["no WARC header", None]
    wrong = warc.record(1, "u", body, hashlib.sha1(b"other").digest(), len(body))
    assert problems(warc.member(wrong)) == ["payload digest differs"]


def test_damage_fails_the_job_and_is_listed(spark, tmp_path):
    body = b"payload" * 50
    raw = warc.record(1, "u", body, hashlib.sha1(body).digest(), len(body))
    path = tmp_path / "a.warc.gz"
    path.write_bytes(warc.member(raw) + warc.member(raw.replace(b"payloadpayload", b"payloadPAYLOAD", 1)) + warc.member(raw))
    records = warc.read_archives(spark.createDataFrame([(f"file://{path}",)], "path string"))
    assert [r["problem"] for r in records.orderBy("offset").collect()] == [None, "block digest differs", None]
    with pytest.raises(Exception, match="bad WARC record in .* block digest differs"):
        warc.resolved(records).collect()
    orphan = tmp_path / "b.warc.gz"
    orphan.write_bytes(warc.member(warc.record(1, "u", None, hashlib.sha1(body).digest(), len(body), refers_to=2, revisit=True)))
    with pytest.raises(Exception, match="revisit without its response"):
        warc.resolved(warc.read_archives(spark.createDataFrame([(str(orphan),)], "path string"))).collect()


def test_other_archives(spark, tmp_path):
    """Records of other writers: warcinfo, resource, several header forms."""
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\ncontent-length: 3\r\n\r\na:b\r\n\r\n"
    page = b"WARC/1.0\r\nWARC-Type:resource\r\nWARC-Target-URI:  http://x/\r\nContent-Type: text/plain\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    path = tmp_path / "o.warc.gz"
    path.write_bytes(gzip.compress(info) + gzip.compress(page))
    rows = warc.read_archives(spark.createDataFrame([(str(path),), (None,)], "path string")).orderBy("offset").collect()
    assert [(r["warc_type"], bytes(r["payload"]), r["problem"], r["target_uri"]) for r in rows] == [
        ("warcinfo", b"a:b", None, None), ("resource", b"hi", None, "http://x/")]
