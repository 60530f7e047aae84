"""Importance resampling: oracle, brute force with longer runs, head and tail, edges."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stationlake.llm import resample as R
from stationlake.llm.queries import oracle_sql
from tests.oracle_compare import compare, duck_connect

DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def features(text, max_run):
    w = WORD.findall(lower(text))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) for n in range(1, max_run + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, max_run=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    per_doc = [(i, *features(t, max_run)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, fs in per_doc:
        s.update(f % buckets for f in fs)
    for text in target:
        t.update(f % buckets for f in features(text, max_run)[1])
    size_s, size_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (size_s + buckets) / ((s[b] + 1) * (size_t + buckets)))) for b in range(buckets)]
    rows = []
    for i, n_words, fs in per_doc:
        weight = sum(gain[f % buckets] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n_words, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    long = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = long[:len(long) * percent // 100]
    out = [(r[0], *r[2:], k) for k, r in enumerate(drawn, 1)] + [(r[0], *r[2:], None) for r in long[len(drawn):]]
    return sorted(out + [(r[0], *r[2:], None) for r in rows if r[1] < min_words], key=str)


def corpus():
    import random

    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["Élan", "ÉLAN", "naïve", "数据", "don't", "A-B", "x1y2", " ", "a\u0000b"]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "!!! ... ???"), (None, "word " * 30), (None, "word " * 30), (7, "again " * 25), (7, docs[7][1]), (7, docs[7][1]),
             (203, "long " * 400_000), (204, "y" * 300_000), (205, "one\ttwo\nthree-four_five")]
    target = [" ".join(rng.choice(vocabulary[:12]) for _ in range(30)) for _ in range(20)] + [None, ""]
    return docs, target


@pytest.mark.parametrize("max_run,percent,head_words,head_pairs", [(1, 10, 50_000, 0), (1, 100, 5, 0), (2, 33, 7, 9), (3, 50, 0, 0), (3, 50, 500, 500)])
def test_against_brute_force(spark, max_run, percent, head_words, head_pairs):
    docs, target = corpus()
    if max_run > 1:
        docs = [d for d in docs if d[0] != 203]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, weight int, rank int")
    got = R.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), max_run=max_run, percent=percent,
                     buckets=997, head_words=head_words, head_pairs=head_pairs)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, target, max_run, 997, percent=percent)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    docs = spark.createDataFrame([(1, "a b c " * 10)], "doc_id long, text string")
    assert R.resample(none, docs).count() == 0
    assert [tuple(r) for r in R.resample(docs, none, percent=100).collect()] == brute([(1, "a b c " * 10)], [], percent=100)


def test_words_across_blocks(monkeypatch):
    text = " ".join(["alpha", "b" * 50, "Γάμμα", "d"] * 20) + "!" * 40 + "end"
    want = [w.encode() for w in WORD.findall(lower(text))]
    for block in (1, 2, 3, 7, 16, 64, 1 << 22):
        monkeypatch.setattr(R, "BLOCK", block)
        assert [w for found in R.words(text) for w in found] == want
        for run in (1, 2, 3):
            got = np.concatenate(list(R.Features("t", {}, {}, run, 1009).of(text)))
            assert Counter(got.tolist()) == Counter(f % 1009 for f in features(text, run)[1])


def test_head_holds_the_frequent_and_changes_nothing(spark):
    docs = spark.createDataFrame([(i, "common pair " * 5 + f"rare{i}") for i in range(50)], "doc_id long, text string")
    head, pairs = R.head_vocabulary(docs, 2, 101, head_words=400, head_pairs=1)
    assert {b"common", b"pair"} <= set(head) and all(state == zlib.crc32(w) for w, state in head.items())
    assert pairs == {(b"common", b"pair"): zlib.crc32(b"common pair") % 101}


def test_rank_of_a_hot_row(spark):
    rows = spark.createDataFrame([(1, 5)] * 700 + [(i, i % 9) for i in range(2, 300)], "doc_id long, score long")
    from pyspark.sql import functions as F

    got = sorted(r["rank"] for r in R.ranked(rows, [F.desc("score"), F.asc("doc_id")]).collect())
    assert got == list(range(1, 999))
    assert {r["rank"] for r in R.ranked(rows, [F.desc("score"), F.asc("doc_id")]).where("score = 8").collect()} == set(range(1, 34))


def test_query_matches_oracle(spark):
    ok, n, _, detail = compare(spark, duck_connect(DIR), "op13", R.op13_importance_resampling,
                               oracle_sql()["op13_importance_resampling"], DIR)
    assert ok and n > 0, detail
