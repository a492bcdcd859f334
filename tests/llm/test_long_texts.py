"""Very long runs of one kind: ids equal to the whole-text tokeniser below its limit, and no crash beyond it."""

import random

import pytest

from loadlens.llm import fertility, queries

RUNS = {"spaces": " ", "line feeds": "\n", "one word": "a", "digits": "7", "cjk": "語", "wide spaces": "　", "marks": "^"}


@pytest.fixture(scope="module")
def paths():
    return queries.tokenizer_path("byte_bpe_50k.tiktoken"), queries.tokenizer_path("piece_bpe_32k.model")


def test_ids_of_runs_equal_the_whole_text(paths):
    v = fertility.Vocabularies(*paths)
    white, r = "\t\n\x0b\x0c\r \x85\xa0       　", random.Random(1)
    for n in (9_999, 10_000, 10_001, 30_000):
        for c in white:
            for text in (c * n, f"a{c * n}", f"{c * n}b 'll", f"x y{c * n}é 12{c * n} {c * n}"):
                assert v.ids(text) == v.bytes_bpe.encode_ordinary(text)
    for _ in range(20):
        text = "".join(r.choice(["word", " it's", "7 ", "".join(r.choices(white, k=r.choice([3, 12_000])))]) for _ in range(9))
        assert v.ids(text) == v.bytes_bpe.encode_ordinary(text)


def test_texts_of_five_megabytes(spark, paths):
    rows = [(k, c * (5_000_000 // len(c.encode()))) for k, c in enumerate(RUNS.values())] + [(50, "two words" + "\n" * 2_000_000 + "end"), (51, " \n" * 1_000_000)]
    out = {r["doc_id"]: r for r in fertility.measure(spark.createDataFrame(rows, "doc_id long, text string"), *paths).collect()}
    assert set(out) == {k for k, _ in rows}
    assert [out[k]["n_words"] for k in range(5)] == [0, 0, 1, 1, 1] and out[50]["n_words"] == 3
    assert all(r["n_tokens"] > 0 and r["base_failed"] and not r["kept"] for r in out.values())


def test_long_words_are_not_kept(paths):
    v = fertility.Vocabularies(*paths)
    words = ["short", "語" * 4000]
    first = v.byte_share([words])
    assert list(v.known) == ["short"] and v.byte_share([words]) == first


def test_chunks_of_repeated_rows_stay_apart(spark):
    """One row repeated: its equal chunks have numbers of their own, so no group holds them all; the cache is let go."""
    from loadlens.llm import cover, suffix_dedup
    docs = spark.createDataFrame([(7, "the same row again and again " * 9)], "doc_id long, text string").selectExpr("doc_id", "text", "explode(sequence(1, 4000)) AS n").drop("n").repartition(4)
    chunks = cover.packed(docs, 20_000).select("chunk").collect()
    assert len(chunks) > 20 and len({r["chunk"] for r in chunks}) == len(chunks)
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    rows = suffix_dedup.remove(docs, chunk_bytes=20_000, bucket_names=500).select("n_bytes", "n_removed").distinct().collect()
    assert [(r["n_bytes"], r["n_removed"]) for r in rows] == [(261, 261)]
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before
