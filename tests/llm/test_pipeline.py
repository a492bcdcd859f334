"""The pipeline's stages, each against a plain version, and on awkward rows."""

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from loadlens.llm import decontaminate, pii_rules, rff_quality
from loadlens.llm.common import cut, read
from loadlens.llm.queries import QUERIES, tokenizer_path
from tests.llm import brute
from tests.llm.test_operators import AWKWARD

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The input and every stage's result."""
    out = [read(spark, SF, "documents")]
    for _, f in C.STAGES:
        out.append(cut(f(spark, out[-1], SF)))
    return out


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_names_and_registration():
    assert len(C.STAGES) == 5 and E.queries()["pipeline"] is C.run
    assert set(QUERIES) <= set(E.queries()) and sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_columns_and_narrowing(stages):
    for before, after in zip(stages, stages[1:-1]):
        assert after.schema.names == before.schema.names
        assert {r[0] for r in after.select("doc_id").collect()} <= {r[0] for r in before.select("doc_id").collect()}


def test_quality_stage(spark, stages):
    out = rff_quality.quality(stages[0], read(spark, SF, "labels"))
    assert {r[0] for r in out.where("predicted = 1").select("doc_id").collect()} == set(rows(stages[1]))


def test_near_duplicate_stage(stages):
    before = list(rows(stages[1]).items())
    ids = brute.component_ids([d for d, _ in before], [brute.simhash(t) for _, t in before])
    assert set(rows(stages[2])) == set(ids)


def test_benchmark_stage(spark, stages):
    hit = {r["doc_id"] for r in decontaminate.contaminated(stages[2], read(spark, SF, "benchmark")).collect()}
    assert set(rows(stages[3])) == set(rows(stages[2])) - hit and hit


def test_personal_data_stage(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    for d, t in after.items():
        assert not pii_rules.base_spans(t)
        spans = brute.personal(before[d])
        if not spans:
            assert t == before[d]
        assert sum(t.count(f"[{k}]") for k in ("EMAIL", "IP", "CARD", "PHONE")) >= len(spans)
    assert all(r["n_chars"] == len(r["text"]) for r in stages[4].collect())


def test_packing_stage_and_run(spark, stages):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    sizes = {d: len(tok.encode(t, add_special_tokens=False).ids) + 1 for d, t in rows(stages[4]).items()}
    got = stages[5].toPandas()
    assert got.groupby("doc_id").length.sum().to_dict() == sizes
    run = C.run(spark, SF).toPandas()
    order = ["sequence_id", "offset"]
    assert run.sort_values(order).reset_index(drop=True).equals(got.sort_values(order).reset_index(drop=True))


def test_stages_take_awkward_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp long, score double, __x string"
    data = [(d, t, None, "s", len(t or ""), 1, None, "x") for d, t in AWKWARD]
    docs = spark.createDataFrame(data, schema)
    counts = []
    for source in (docs, docs.limit(0)):
        now = source
        for k, (_, f) in enumerate(C.STAGES):
            now = cut(f(spark, now, SF))
            if k < 4:
                assert now.columns == source.columns
            counts.append(now.count())
    assert counts[5:] == [0] * 5 and counts[1] > 0
    only = cut(C.near_duplicates(spark, docs, SF)).collect()
    marks = [brute.simhash(t) for _, t in AWKWARD]
    ids = brute.component_ids(list(range(len(AWKWARD))), marks)
    assert len(only) == len(set(ids))
    assert np.isin([r["doc_id"] for r in only if r["doc_id"] is not None], [d for d, _ in AWKWARD if d is not None]).all()
    assert sum(r["doc_id"] == 4 for r in only) <= 1
