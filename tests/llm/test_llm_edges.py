"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names: a defined result everywhere."""

from __future__ import annotations

from collections import Counter

import pytest
from llm_cases import AWKWARD, awkward, nothing, words

from roadlens.llm.knn_join import knn_join, scaled
from roadlens.llm.mixing import mix_documents
from roadlens.llm.near_dedup import near_duplicates
from roadlens.llm.packing import pack_documents
from roadlens.llm.quality_classifier import quality_classifier
from roadlens.llm.quality_rules import quality_rules
from roadlens.llm.sharding import shard_documents
from roadlens.llm.suffix_tree import suffix_tree_scores
from roadlens.llm.token_counts import token_counts
from roadlens.llm.toxicity import toxicity

LABELS = "doc_id long, quality int, toxic int, text string"
IDS = Counter(i for i, _ in AWKWARD)


def _labels(spark):
    rows = [(i, 1 if i % 2 else 0, 1 if i % 3 == 0 else 0, "clash") for i in range(1, 15)]
    return spark.createDataFrame([*rows, (None, 1, 1, ""), (4, None, None, ""), (5, 0, 1, ""), (99, 1, 0, "")], LABELS)


def _no_labels(spark):
    return spark.createDataFrame([], LABELS)


ROWS = {
    "rules": lambda s, d, lab: quality_rules(d, lab),
    "classifier": lambda s, d, lab: quality_classifier(d, lab),
    "toxicity": lambda s, d, lab: toxicity(d, lab),
    "near": lambda s, d, lab: near_duplicates(d),
    "suffix": lambda s, d, lab: suffix_tree_scores(d),
    "shards": lambda s, d, lab: shard_documents(d),
    "tokens": lambda s, d, lab: token_counts(d),
    "mixing": lambda s, d, lab: mix_documents(d),
}


@pytest.mark.parametrize("name", ROWS)
@pytest.mark.parametrize("labels", [_labels, _no_labels])
def test_one_row_for_each_document(spark, name, labels):
    if labels is _no_labels and name not in ("rules", "classifier", "toxicity"):
        pytest.skip("takes no labels")
    out = ROWS[name](spark, awkward(spark), labels(spark))
    assert len(set(out.columns)) == len(out.columns)
    assert Counter(r["doc_id"] for r in out.collect()) == IDS


@pytest.mark.parametrize("name", ROWS)
def test_no_documents_no_rows(spark, name):
    assert ROWS[name](spark, nothing(spark), _labels(spark)).collect() == []


def test_packing_of_awkward_documents(spark):
    pieces = pack_documents(awkward(spark)).collect()
    assert {p["doc_id"] for p in pieces} == set(IDS)
    for i in (1, 2, 3, 12):  # the end alone
        assert [(p["start"], p["length"], p["doc_tokens"], p["ids"]) for p in pieces if p["doc_id"] == i] == [
            (0, 1, 1, b"\x01\x00\x00\x00")]
    assert pack_documents(nothing(spark)).collect() == []


def test_rules_results(spark):
    got = {r["doc_id"]: r for r in quality_rules(awkward(spark), _no_labels(spark)).collect()}
    for i, text in AWKWARD:
        if IDS[i] == 1:
            assert got[i]["n_words"] == len(words(text)) and got[i]["word_chars"] == sum(map(len, words(text)))
    assert got[1]["base_failed"] and not got[1]["kept"]
    assert got[11]["n_dup_lines"] == 2 and got[13]["n_symbols"] == 8 and got[13]["n_repeat_words"] == 4
    assert got[6]["base_failed"]  # repeats itself


def test_one_class_gives_a_constant(spark):
    ones = spark.createDataFrame([(i, 1, 0, "") for i in range(1, 15)], LABELS)
    docs = awkward(spark)
    assert {r["score"] for r in quality_classifier(docs, ones).collect()} == {1.0}
    assert {r["score"] for r in toxicity(docs, ones).collect()} == {0.0}
    assert {r["score"] for r in quality_classifier(docs, _no_labels(spark)).collect()} == {0.5}
    held = {r["doc_id"]: r["held_out"] for r in toxicity(docs, ones).collect()}
    assert held[None] is None and set(held.values()) == {True, False, None}


def test_near_duplicates_results(spark):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(awkward(spark)).collect()]
    by_id = {g[0]: g for g in got}
    for i in (1, 2, 3, 12):  # nothing to link
        assert by_id[i] == (i, 0, i, True)
    assert by_id[5] == (5, 1, 4, False)  # "one" and "One"
    assert by_id[7][2:] == (6, False) and by_id[6][1] == 5
    assert by_id[None] == (None, 3, None, True)


def test_shards_results(spark):
    got = shard_documents(awkward(spark)).collect()
    assert {(r["size"], r["text_crc32"]) for r in got if r["doc_id"] in (1, 2)} == {(1, 0)}
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (None, [1.0, 1.0]), (1, None), (2, []), (3, [None, 1.0]),
            (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (6, [1e30, 0.0]), (7, [0.5, 0.5]), (7, [0.5, 0.5]),
            (8, [1.0, 1.0, 1.0]), (0, [1.0, 0.0]), (100, [0.5, 0.0])]
    table = spark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<float>, score int")
    v = scaled(table)
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in knn_join(v, v.where("vec_id % 50 = 0")).collect()]
    half, one = 128, 256
    want = [(0, 1, 7, half * one), (0, 2, 7, half * one), (0, 3, 100, half * one), (0, 4, 50, 0),
            (50, 1, 7, half * one), (50, 2, 7, half * one), (50, 3, 0, 0), (50, 4, 0, 0), (50, 5, 100, 0),
            (100, 1, 0, half * one), (100, 2, 0, half * one), (100, 3, 7, half * half), (100, 4, 7, half * half),
            (100, 5, 50, 0)]
    assert sorted(got) == want
    none = scaled(table.where("false"))
    assert knn_join(none, none).collect() == []
    alone = scaled(table.where("vec_id = 50"))
    assert knn_join(alone, alone).collect() == []
