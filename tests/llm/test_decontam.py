"""Benchmark decontamination: exhaustive BM25 and overlap as brute force."""

import math
import re
from collections import Counter

import numpy as np

from stationlake.llm import decontam as D

DIR = "/root/testdata/sf0.001"


def words(text):
    return [w for w in (re.sub(r"[\W_]+", "", c) for c in (text or "").lower().split()) if w]


def placed(ws, q, window):
    """Word by word: whether it stands where some shared run of five words puts it."""
    k = min(5, len(ws))
    offsets = {p - i for i in range(len(ws) - k + 1) for p in range(len(window) - k + 1) if ws[i:i + k] == window[p:p + k]}
    mask = [any(0 <= i + d < len(window) and window[i + d] == w for d in offsets) for i, w in enumerate(ws)]
    for lo, hi in ((0, q), (q, len(ws))):  # a short part whole beside its place
        if 0 < hi - lo < 5 and any(lo + d >= 0 and window[lo + d:hi + d] == ws[lo:hi] for o in offsets for d in range(o - 4, o + 5)):
            mask[lo:hi] = [True] * (hi - lo)
    return mask


def brute(docs, bench, threshold=D.RETRIEVE):
    """Score every passage of every document against every item, without any index."""
    items = [(i, words(t), t) for i, t in bench if words(t)]
    df = Counter(w for _, ws, _ in items for w in set(ws))
    mean = sum(len(ws) for _, ws, _ in items) / max(1, len(items))

    def parts(ws):
        tf = Counter(ws)
        return {w: math.log(1 + (len(items) - df[w] + 0.5) / (df[w] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(ws) / mean))
                for w, n in tf.items()}

    out = set()
    for doc, text in docs:
        seq = words(text)
        for item, ws, raw in items:
            longest = 1 << max(D.SMALLEST_CLASS, math.ceil(math.log2(len(ws))))
            own = parts(ws)
            for at in range(0, max(1, len(seq)), longest):
                window = seq[at:at + 2 * longest]
                have = set(window)
                if sum(s for w, s in own.items() if w in have) < threshold * sum(own.values()) - 1e-9:
                    continue
                q = D.answer_start(raw)
                mask = np.array(placed(ws, q, window), bool)
                both = [m.mean() if len(m) else 1.0 for m in (mask[:q], mask[q:])]
                if mask.mean() >= D.OVERLAP and min(both) >= D.PART_OVERLAP:
                    out.add((doc, item))
    return out


def pairs(df):
    return {(r.doc_id, r.item_id) for r in df.collect()}


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    got = pairs(D.op8_decontaminate(spark, DIR))
    assert got == brute(docs, bench)
    assert {(d, i) for d, t in docs for i, b in bench if b in t} <= got and got


def planted():
    rng = np.random.default_rng(7)
    vocab = ["".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 7)))) for _ in range(300)]
    some = lambda n: " ".join(vocab[int(i)] for i in np.minimum(rng.zipf(1.3, n) - 1, 299))
    bench = [(i, some(int(rng.integers(1, 150))).capitalize() + ".\n" + some(int(rng.integers(1, 9)))) for i in range(60)]
    docs = []
    for i in range(80):
        text = some(int(rng.integers(0, 500)))
        if i % 2:
            ws = bench[i % 60][1].split()
            if i % 4 == 1 and len(ws) > 12:  # a changed word
                ws[len(ws) // 2] = "changed"
            if i % 8 == 3:  # only a part
                ws = ws[: len(ws) // 2]
            text = f"{text} {' '.join(ws).upper()}, {some(int(rng.integers(0, 300)))}"
        docs.append((i, text))
    return docs, bench


def test_planted_passages_against_brute_force(spark, monkeypatch):
    docs, bench = planted()
    want = brute(docs, bench)
    assert len(want) > 20
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    assert pairs(D.find_leaks(d, b)) == want
    monkeypatch.setattr(D, "SHARD_WORDS", 400)  # many shards
    monkeypatch.setattr(D, "BLOCKS", 3)
    assert pairs(D.find_leaks(d, b)) == want


def test_edges(spark):
    item = "what is the answer to this long question about rare things?\nthe answer is forty two"
    docs = [(1, None), (2, ""), (3, item), (3, item), (None, "x " + item.upper() + " y"), (4, "a " * 300_000 + item), (5, "!!! ..."),
            (6, "what is the answer to this long question about rare things?"), (7, "something else entirely")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "'s' AS score")
    bench = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, "?!")], "item_id long, text string")
    got = D.find_leaks(df, bench)
    assert sorted((r.doc_id or 0, r.item_id) for r in got.collect()) == [(0, 10), (3, 10), (3, 10), (4, 10)]
    assert all(r.question_overlap == r.answer_overlap == 1.0 and r.score > 0.99 for r in got.collect())
    assert D.find_leaks(df.limit(0), bench).count() == 0
    assert D.find_leaks(df, bench.limit(0)).count() == 0
    assert D.find_leaks(df, bench.where("item_id > 10")).count() == 0


def test_search_equals_full_scores():
    docs, bench = planted()
    df = Counter(w for _, t in bench for w in set(words(t)))
    index = D.build_index(bench, df, len(bench), 60.0, 256)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, len(index.top), int(rng.integers(1, 120)))) for _ in range(50)]
    sets += [np.unique(w) for w in index.words[:20]]
    p, i, s = D.search(index, np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.concatenate(sets),
                       np.ones((len(sets), D.BLOCKS), bool), 0.3)
    got = {(a, b): c for a, b, c in zip(p.tolist(), i.tolist(), s.tolist())}
    want = {}
    for a, terms in enumerate(sets):
        for t in terms:
            for k in range(index.ptr[t], index.ptr[t + 1]):
                key = (a, int(index.item[k]))
                want[key] = want.get(key, 0) + index.share[k]
    want = {k: v for k, v in want.items() if v >= 0.3}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_stage_drops_only_leaks(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    leaks = {d for d, _ in brute([(r.doc_id, r.text) for r in docs.collect()], bench)}
    kept = D.stage(spark, docs, DIR)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - leaks


def test_an_intact_short_answer_beside_a_changed_word_counts(spark):
    q = [f"word{i}" for i in range(41)]
    item = " ".join(q) + "?\nred green blue grey"
    changed = " ".join([*q[:40], "other"])
    docs = [(1, f"before {changed} red green blue grey after"), (2, f"before {changed} answer: red green blue grey after"),
            (3, f"before {changed} one two three four after"), (4, f"before {changed} after " + "x " * 60 + "red green blue grey"),
            (5, f"before {' '.join(q)} red green other grey after"),
            # a short question before a long answer
            (6, "is it so now other " + " ".join(f"reply{i}" for i in range(1, 41)))]
    bench = [(10, item), (11, "is it so now?\n" + " ".join(f"reply{i}" for i in range(41)))]
    got = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert pairs(got) == {(1, 10), (2, 10), (5, 10), (6, 11)}
    assert all(r.answer_overlap == 1.0 for r in got.collect() if r.doc_id in (1, 2))


def test_recall_of_changed_items(spark):
    """Every item with one word changed, at every place, and with two words changed: at least 95 of 100 are found, and
    every one that the exhaustive search finds."""
    bench = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    rng = np.random.default_rng(6)
    docs, made = [], {1: [], 2: []}
    for item, text in bench:
        cut = re.split(r"(\s+)", text)
        at = [i for i in range(0, len(cut), 2) if words(cut[i])]
        picks = [[a] for a in at] + [sorted(rng.choice(at, 2, replace=False).tolist()) for _ in range(12)]
        for pick in picks:
            new = list(cut)
            for i in pick:
                new[i] = "qqxyz" + new[i][-1:]
            made[len(pick)].append((len(docs), item))
            docs.append((len(docs), "some words stand before " + "".join(new) + " and some after it"))
    got = pairs(D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")))
    recall = {n: sum(x in got for x in m) / len(m) for n, m in made.items()}
    print(recall, {n: len(m) for n, m in made.items()})
    assert recall[1] >= 0.95 and recall[2] >= 0.95


def test_documents_are_read_once_for_all_length_classes(spark):
    bench = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(3 ** i))) for i in range(1, 7)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = D.find_leaks(docs, bench)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 1


def test_items_with_other_white_space_are_found_whole(spark):
    item = "".join(f"w{i}" + ("\u00a0", "\u2009", "\u3000")[i % 3] for i in range(200)) + "end"
    bench = spark.createDataFrame([(10, item), (11, "a short one\nof two lines")], "item_id long, text string")
    docs = spark.createDataFrame([(i, "x " * (37 * i) + item + " y" * 90) for i in range(8)], "doc_id long, text string")
    assert pairs(D.find_leaks(docs, bench)) == {(i, 10) for i in range(8)}
