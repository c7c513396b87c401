"""Operators do the whole job: nothing is cut once there is more of it."""

import os
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import pii, setjoin, toxicity
from tests.llm import brute


def test_toxicity_counts_all_grams(spark, monkeypatch):
    """More distinct grams than the 2^21 that the models once held; rare words are joined."""
    rng = np.random.default_rng(1)
    letters = rng.integers(97, 123, (300_000, 12)).astype(np.uint8)
    words = [w.decode() for w in letters.view("S12").ravel()]
    rows = [(i, " ".join(words[300 * i : 300 * i + 300]), int(i % 10 == 0)) for i in range(1000)]
    docs = spark.createDataFrame([(a, b) for a, b, _ in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, toxic int")
    model, calibration = toxicity.train(docs, labels)
    train = docs.where(toxicity.fold("doc_id") != 1).select("doc_id").collect()
    own = np.concatenate([letters[300 * r["doc_id"] : 300 * r["doc_id"] + 300] for r in train]).astype(np.int64)
    marked = np.column_stack([np.ones(len(own), np.int64), own, np.full(len(own), 2)])
    grams = np.unique(np.concatenate([sum(marked[:, a + j] << (8 * (5 - j)) for j in range(6)) for a in range(marked.shape[1] - 5)]))
    held = model.table.where(F.shiftright("key", 56) == 6).count()
    assert held == len(grams) and model.table.where(F.shiftright("key", 56) <= 6).count() > 1 << 21
    few = docs.where("doc_id < 40")
    scores = lambda: {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(few, model, calibration).collect()}
    want = scores()  # the model in every task
    monkeypatch.setattr(toxicity, "IN_TASKS", 0)
    joined = scores()
    assert len(want) == 40 and all(abs(joined[d] - x) < 1e-9 for d, x in want.items())
    monkeypatch.setattr(toxicity, "HEAD", 5)
    assert scores() == joined


def test_toxicity_against_plain_models(spark):
    """Word ratios and the kept share of toxic text equal plain interpolated Kneser-Ney models of byte grams."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join("".join(rng.choice(list("abcé"), rng.integers(1, 9))) for _ in range(30)), int(i % 3 == 0)) for i in range(60)]
    docs, labels = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string"), spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, toxic int")
    model, _ = toxicity.train(docs, labels)
    counts = [Counter(w for d, t, y in rows if y == c and zlib.crc32(str(d).encode()) % 3 != 1 for w in t.split()) for c in (1, 0)]
    plain = brute.KneserNey(counts, toxicity.ORDER, toxicity.SHARED)
    scorer = toxicity._Scorer(*model.arrays())
    for word in ["abca", "b", "éé", "cabcabca", "zq", "abé"]:
        data = np.frombuffer(word.encode(), np.uint8)
        got = scorer._new(data, np.array([0]), np.array([len(data)]))[0]
        assert abs(got - (plain.log_chance(0, word) - plain.log_chance(1, word))) < 1e-4, word


def test_links_inside_components(spark, monkeypatch):
    """Every link of drifting near copies counts, copies included; blocks so small that all are split."""
    monkeypatch.setattr(setjoin, "BLOCK", 2)
    rng = np.random.default_rng(2)
    rows = [(0, None), (1, "")]
    for family in range(3):
        words = [f"f{family}x{i}" for i in rng.integers(0, 10**6, 90)]
        for _ in range(12):
            rows += [(len(rows) + c, " ".join(words)) for c in range(rng.integers(1, 3))]
            for at in rng.integers(0, 90, 2):
                words[at] = f"e{rng.integers(10**6)}"
    want = brute.links(rows)
    got = {r["doc_id"]: r["n_links"] for r in setjoin.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == want and max(want.values()) > 3


def test_short_texts_with_a_common_passage(spark, monkeypatch):
    """Thousands of short texts share 30 to 74 % of their words and one cluster of near copies is large: links are exact and the bound keeps the opened rows few."""
    rng = np.random.default_rng(4)
    passage = [f"p{i}" for i in range(40)]
    base = [f"c{i}" for i in range(120)]
    rows = []
    for i in range(1500):
        own = [f"o{x}" for x in rng.integers(0, 10**9, rng.integers(14, 94))]
        rows.append((i, " ".join([*own[: len(own) // 2], *passage, *own[len(own) // 2 :]])))
    for i in range(1500, 1900):
        words = list(base)
        for at in rng.integers(0, 120, 2):
            words[at] = f"e{rng.integers(10**9)}"
        rows.append((i, " ".join(words)))
    shipped, blocks = [], setjoin._blocks
    monkeypatch.setattr(setjoin, "_blocks", lambda *a: shipped.append((out := blocks(*a)).count()) or out)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in setjoin.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    want, links = brute.components(rows), brute.links(rows)
    assert got == {d: (*want[d], links[d]) for d in want} and max(links.values()) > 100
    assert shipped[0] < 20 * 400  # all pairs of the cluster alone would be 80,000


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the generated tables")
def test_telling_terms_occur(spark):
    """The method adds spans beside the base patterns on the given documents."""
    out = pii.op4_personal_data(spark, "/root/testdata/sf0.1")
    assert out.where("spans LIKE '%term:%'").count() > 100
