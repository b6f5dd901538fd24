"""Verdicts and scores of the fitted operators, and the pipeline's stages as wired, recomputed in plain Python."""

from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from llm_cases import awkward, nothing, prose, words

import corpus_pipeline
from roadlens.llm import quality_classifier as qc
from roadlens.llm import quality_rules as qr
from roadlens.llm.mixing import mix_documents
from roadlens.llm.textstats import column_stats
from roadlens.llm.topics import term_counts


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents and labels in a folder, with bad ones that the rules and the classifier can learn."""
    import tempfile

    rng = random.Random(21)
    docs, labels = [], []
    for i in range(500):
        good = rng.random() < 0.6
        junk = " ".join(rng.choice(["!!!", "BUY", "$$", "x", "go"]) for _ in range(rng.randint(40, 140)))
        text = prose(rng, rng.randint(60, 160), 800) + "." if good else junk
        docs.append((i, text, rng.choice(["en", "de"]), f"src{i % 3}", len(text)))
        labels.append((i, int(good), 0))
    docs += [(500, None, "en", "src0", 0), (501, "", "en", "src0", 0)]
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, {d[0]: d[1] for d in docs}, {i: q for i, q, _ in labels}


def walk(trees, x):
    """The raw score of one document: down each tree, node by node."""
    total = trees.bias
    for root in trees.roots.tolist():
        at = root
        while trees.left[at] != at:
            at = trees.left[at] if x[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
        total += trees.value[at]
    return total


def test_verdict_of_the_rules(spark, corpus):
    folder, texts, _ = corpus
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    trees = qr.fit_rules(docs, labels)
    got = {r["doc_id"]: r for r in qr.quality_rules(docs, labels).collect()}
    for i, text in texts.items():
        w = words(text)
        at = defaultdict(list)
        for k in range(len(w) - 2):
            at[tuple(w[k:k + 3])].append(k)
        repeated = len({k + j for found in at.values() if len(found) > 1 for k in found for j in range(3)})
        failed = len(w) < 50 or 100 * repeated > 50 * len(w)
        score = 1 / (1 + math.exp(-walk(trees, column_stats(pa.array([text], pa.string()))[1][0])))
        assert got[i]["base_failed"] == failed and math.isclose(got[i]["score"], score, rel_tol=1e-9)
        assert got[i]["kept"] == (not failed and score >= qr.KEEP_FROM)


def classifier_by_hand(texts, labels):
    """Random features, ridge and isotonic steps over the whole sample at once, in numpy."""
    learnt = sorted(i for i, t in texts.items() if i in labels and zlib.crc32(str(i).encode()) % 5)
    x = np.concatenate([column_stats(pa.array([texts[i]], pa.string()))[1] for i in learnt])
    y = np.array([labels[i] for i in learnt], dtype=float)
    rng = np.random.default_rng(qc.SEED)
    omega, phase = rng.normal(size=(x.shape[1], qc.N_COSINES)) / qc.KERNEL_WIDTH, rng.uniform(0, 2 * np.pi, qc.N_COSINES)
    return x, y, omega, phase, x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)


def test_scores_of_the_classifier(spark, corpus):
    folder, texts, labels = corpus
    docs, marks = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = qc.fit_classifier(docs, marks)
    x, y, omega, phase, mean, spread = classifier_by_hand(texts, labels)
    assert np.allclose(model.mean, mean) and np.allclose(model.spread, spread)
    assert np.allclose(model.omega, omega) and np.allclose(model.phase, phase)
    got = {r["doc_id"]: r for r in qc.quality_classifier(docs, marks).collect()}
    bins = model.bin(x)
    ones, totals = np.bincount(bins, y, qc.BINS), np.bincount(bins, minlength=qc.BINS).astype(float)
    steps = qc.isotonic(ones, totals)
    for i, text in texts.items():
        score = steps[model.bin(column_stats(pa.array([text], pa.string()))[1])[0]]
        assert math.isclose(got[i]["score"], score, abs_tol=1e-9) and got[i]["predicted"] == int(score >= qc.PREDICT_FROM)
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i]["predicted"] == labels[i] for i in held]) > 0.95
    # the weights solve the ridge equations of the whole sample
    z = np.cos((x - mean) / spread @ omega + phase) * math.sqrt(2 / qc.N_COSINES)
    z = np.concatenate((z, np.ones((len(z), 1))), axis=1)
    penalty = qc.RIDGE * np.eye(z.shape[1])
    penalty[-1, -1] = 0
    assert np.allclose(model.weights, np.linalg.solve(z.T @ z + penalty, z.T @ y), atol=1e-6)


def test_stages_keep_what_their_operators_say(spark, corpus):
    """Rules, classifier and packing as wired: the rows of each stage from the whole of its input."""
    folder, texts, labels = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    marks = spark.read.parquet(f"{folder}/labels.parquet")
    kept = {r["doc_id"] for r in qr.quality_rules(docs, marks).where("kept").collect()}
    after = corpus_pipeline.rules(spark, docs, folder)
    assert {r["doc_id"] for r in after.collect()} == kept and after.columns == docs.columns
    assert {i for i in kept if labels.get(i)} == {i for i, q in labels.items() if q and len(words(texts[i])) >= 50}
    good = {r["doc_id"] for r in qc.quality_classifier(docs, marks).where("predicted = 1").collect()}
    second = corpus_pipeline.classifier(spark, after, folder)
    assert {r["doc_id"] for r in second.collect()} == kept & good
    packed = corpus_pipeline.packing(spark, second, folder).collect()
    own = defaultdict(list)
    for p in packed:
        own[p["doc_id"]].append((p["start"], p["length"], p["doc_tokens"]))
    assert set(own) == kept & good
    for found in own.values():
        at = 0
        for start, length, n in sorted(found):
            assert start == at
            at += length
        assert at == found[0][2]


def test_pipeline_on_awkward_and_empty_tables(spark):
    import tempfile

    for make in (awkward, nothing):
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        make(spark).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(i, 1, 0) for i in range(1, 15)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == awkward(spark).columns
        pieces = corpus_pipeline.run(spark, folder)
        assert {r["doc_id"] for r in pieces.collect()} <= {r["doc_id"] for r in awkward(spark).collect()}


def test_run_leaves_only_its_result(spark):
    import os

    from roadlens.session import Scratch, shared_dir

    folders = lambda: set(os.listdir(shared_dir(spark).removeprefix("file:")))
    before = folders()
    pieces = corpus_pipeline.run(spark, SF_SMALL)
    assert len(folders() - before) == 1 and pieces.count() > 0
    with Scratch(spark):
        corpus_pipeline.run(spark, SF_SMALL)
    assert len(folders() - before) == 1


@pytest.mark.parametrize("values", [[], [0], [255, 256, 3], [1 << 40, 0, 7], list(range(1000))])
def test_squeezed_numbers_come_back(values):
    from roadlens.llm.suffix_tree import squeeze, unsqueeze

    assert unsqueeze(squeeze(np.array(values, dtype=np.int64))).tolist() == values
    assert len(squeeze(np.zeros(100_000))) < 200


def test_suffix_tree_over_many_pieces_and_buckets(spark, monkeypatch):
    """Any number of buckets gives the same scores; with repeated ids, nulls and long texts."""
    from roadlens.llm import suffix_tree

    rng = random.Random(4)
    rows = [(i % 70, prose(rng, rng.randint(0, 80), 60)) for i in range(120)] + [(None, "w1 w2 w3"), (200, None), (201, "w1 " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).cache()
    key = lambda found: sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 9), round(r["score"], 7)) for r in found)
    want = key(suffix_tree.suffix_tree_scores(docs).collect())
    for bucket_bytes, hot in ((2_000, suffix_tree.HOT), (500, 20)):
        monkeypatch.setattr(suffix_tree, "BUCKET_BYTES", bucket_bytes)
        assert key(suffix_tree.suffix_tree_scores(docs, hot).collect()) == want


def test_pieces_that_change_between_passes_are_told(spark):
    from roadlens.llm import suffix_tree

    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(5)], "doc_id long, text string").coalesce(1)
    texts = suffix_tree._texts(docs)
    answers = suffix_tree.answer_tokens(suffix_tree.ask_tokens(texts.where("doc_id < 4"), 1), 1).toArrow()
    pieces = suffix_tree._texts_by_piece(texts).toArrow()
    run = suffix_tree._recorded(1, 10, 5, 100, suffix_tree._arrow_schema(docs, suffix_tree._PARTS.format(id="bigint")))
    for given in (answers, answers.slice(0, 0)):
        with pytest.raises(RuntimeError, match="changed between two passes"):
            run(pieces, given)


def test_mixing_stage_learns_topics_from_all_documents(spark, monkeypatch):
    """Of more texts than the 5,000 that were sampled before, word rarities are those of all."""
    given = []
    monkeypatch.setattr(corpus_pipeline, "mix_documents", lambda docs, topics: given.append(topics) or mix_documents(docs, topics=topics))
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(5)) for _ in range(5600)]
    docs = spark.createDataFrame([(i, t, "en", "src0") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    assert corpus_pipeline.mixing(spark, docs, SF_SMALL).count() > 0
    found = (term_counts(pa.array(texts))[1] > 0).sum(axis=0)
    assert np.allclose(given[0].rarity, np.log((len(texts) + 1) / (found + 1)) + 0.1)
