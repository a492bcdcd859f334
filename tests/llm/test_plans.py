"""Plan shapes: what runs natively, and what moves documents."""

import re

import pytest

from loadlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(spark, name, capsys):
    df = QUERIES[name](spark, SF)
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def test_sharding_is_native(spark, capsys):
    text = plan(spark, "op9_hash_tree_shards", capsys)
    assert not re.search("Python|Pandas|Arrow", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_sharding_reads_the_texts_once(spark):
    df = QUERIES["op9_hash_tree_shards"](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


@pytest.mark.parametrize("name", ["op1_fertility_rules", "op5_ftrl_toxicity", "op6_seed_align_decontamination", "op7_pii_tagger"])
def test_scoring_moves_no_document(spark, capsys, name):
    text = plan(spark, name, capsys)
    assert "Exchange" not in text and re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", text)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_all_pairs(spark, capsys, name):
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(spark, name, capsys))
