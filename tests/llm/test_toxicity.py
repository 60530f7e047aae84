"""Toxicity: held-out quality, the label model, and edge cases."""

import zlib

import numpy as np

from stationlake.llm import toxicity

DIR = "/root/testdata/sf0.1"


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    return (rank[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * n0)


def test_query_held_out_quality(spark):
    got = {r.doc_id: r for r in toxicity.op10_toxicity(spark, DIR).collect()}
    assert len(got) == spark.read.parquet(f"{DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    lab = [(r.toxic, got[r.doc_id]) for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()]
    y = np.array([t for t, r in lab if r.held_out])
    s = np.array([r.score for _, r in lab if r.held_out])
    assert auc(y, s) > 0.95
    assert (s[y == 0] >= 0.5).mean() < 0.02 and (s[y == 1] >= 0.5).mean() > 0.8


def test_label_model_shares_one_signal_between_copies():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.3
    good = np.where(truth, rng.random(4000) < 0.7, rng.random(4000) < 0.05)
    other = np.where(truth, rng.random(4000) < 0.5, rng.random(4000) < 0.1)
    label = np.where(rng.random(4000) < 0.03, ~truth, truth)
    votes = np.stack([good, good, good, other, label], 1)
    post, model = toxicity.label_model(votes, np.ones(4000), np.where(label, 0.9, 0.1))
    assert model["share"][0] > 2 and model["share"][3] < 1.5
    # wrong labels blur the classes a little
    assert abs(model["hit"][1, 0] - 0.7) < 0.1 and abs(model["hit"][0, 3] - 0.1) < 0.1
    assert ((post >= 0.5) == truth).mean() > 0.96


def test_edges(spark):
    docs = spark.createDataFrame([(i, f"nice text number {i}" if i % 2 else f"you stupid idiot {i}", "s") for i in range(40)]
                                 + [(100, None, "s"), (101, "", "s"), (101, "", "s"), (None, "STUPID idiot " * 100_000, "s")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)] + [(None, 1), (5, None), (999, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score_toxicity(docs, model).collect()
    assert len(got) == 44
    assert all(r.predicted == (r.doc_id % 2 == 0) for r in got if r.doc_id is not None and r.doc_id < 40)
    assert len({r.score for r in got if r.doc_id in (100, 101)}) == 1
    assert [r.predicted for r in got if r.doc_id is None] == [1]
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0
    for few in (labels.limit(0), labels.where("toxic = 0"), labels.where("toxic = 1")):
        assert toxicity.score_toxicity(docs, toxicity.train(docs, few)).count() == 44


def test_one_row_of_a_picked_document_teaches(spark, monkeypatch):
    """A document that repeats thousands of times, and one with many labels, reach the fit once."""
    many = [(i, f"nice text number {i}" if i % 2 else f"you stupid idiot {i}") for i in range(40)]
    docs = spark.createDataFrame(many + [(0, "you stupid idiot 0")] * 3000 + [(1, "another text under this id")] * 500, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)] + [(2, 0)] * 5 + [(4, 0), (4, 1)], "doc_id long, toxic int")
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda ids, counts, patterns, words, y, shares: seen.update(rows=len(y), toxic=int(y.sum()), shares=shares))
    toxicity.train(docs, labels)
    assert seen == {"rows": 40, "toxic": 19, "shares": (21, 19)}  # most of document 2's labels say clean


def test_label_model_and_scores_against_plain_loops(spark):
    """EM written with loops over rows and voters, and the score as a sum over a text's distinct words."""
    rng = np.random.default_rng(5)
    votes = rng.random((60, 4)) < 0.4
    weight, start = rng.random(60) + 0.5, np.where(votes[:, -1], 0.9, 0.1)
    got, model = toxicity.label_model(votes, weight, start, rounds=3)
    post, share = list(start), [1.0] * 4
    for n in range(3):
        hit = [[0.0] * 4, [0.0] * 4]
        for c in (0, 1):
            w = [weight[i] * (post[i] if c else 1 - post[i]) for i in range(60)]
            for j in range(4):
                hit[c][j] = (sum(w[i] for i in range(60) if votes[i, j]) + 0.5) / (sum(w) + 1)
        if n == 0:
            dev = [[votes[i, j] - post[i] * hit[1][j] - (1 - post[i]) * hit[0][j] for j in range(4)] for i in range(60)]
            cov = [[sum(weight[i] * dev[i][j] * dev[i][k] for i in range(60)) / sum(weight) for k in range(4)] for j in range(4)]
            for j in range(4):
                corr = [cov[j][k] / (cov[j][j] * cov[k][k]) ** 0.5 for k in range(4) if k != j]
                share[j] = 1 + sum(x for x in corr if x > 0.1)
        share[-1], hit[0][-1], hit[1][-1] = 1.0, toxicity.LABEL_ERROR, 1 - toxicity.LABEL_ERROR
        for i in range(60):
            z = sum(np.log(hit[1][j] / hit[0][j]) / share[j] for j in range(4) if votes[i, j])
            z -= 0 if votes[i, -1] else np.log(hit[1][-1] / hit[0][-1])
            post[i] = 1 / (1 + np.exp(-z))
    assert np.allclose(got, post)
    texts = ["You STUPID idiot, stupid!", "a nice day", "", None, "idiots and idiotic things " * 50]
    m = toxicity.Model(rng.normal(size=toxicity.SPACE).astype(np.float32), -0.3, 0.2)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.score_toxicity(docs, m).collect():
        words = {toxicity._EDGE.sub("", c) for c in (texts[r.doc_id] or "").lower().split()} - {""}
        z = m.bias + m.per_word * np.log(1 + len(words)) + sum(float(m.weights[f]) for w in words for f in toxicity._word_features(w))
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-4 and r.predicted == int(r.score >= 0.5)
