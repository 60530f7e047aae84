"""SimHash near-dedup against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stationlake.llm import simhash
from stationlake.llm.components import components

DIR = "/root/testdata/sf0.001"


def brute_fingerprint(text, words=3):
    toks = [t for t in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).translate(
        {i: " " for i in range(9, 14)}).split(" ") if t]
    if not toks:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(toks[i:i + words]).encode(), 42) for i in range(max(1, len(toks) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, max_bits=3):
    parent = {i: i for i in range(len(ids))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                parent[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        low[find(i)] = min(low.get(find(i), d), d)
    return {d: low[find(i)] for i, d in enumerate(ids)}


def as_dict(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    comp = brute_components([r.doc_id for r in rows], fps)
    got = as_dict(simhash.op1_simhash(spark, DIR))
    assert got == {r.doc_id: (f"{f:016x}", comp[r.doc_id]) for r, f in zip(rows, fps)}


def near_values(rng, n):
    """Random values plus balls of close neighbours, so crowded nodes must be opened."""
    out = set(int(x) for x in rng.integers(0, 1 << 63, n, dtype=np.uint64))
    for centre in list(out)[:5]:
        for _ in range(n // 5):
            v = centre
            for b in rng.integers(0, 64, int(rng.integers(0, 9))):
                v ^= 1 << int(b)
            out.add(v)
    return sorted(out)


@pytest.mark.parametrize("leaf", [20_000, 40])
def test_links_find_every_component(spark, leaf):
    vals = near_values(np.random.default_rng(5), 150)
    want = brute_components(list(range(len(vals))), vals)
    signed = [int(np.uint64(v).view(np.int64)) for v in vals]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r.node: r.root for r in components(simhash.trie_links(df, 3, leaf)).collect()}
    groups, expect = {}, {}
    for i, v in enumerate(signed):
        groups.setdefault(got.get(v, v), set()).add(i)
        expect.setdefault(want[i], set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_forest_between_two_nodes_equals_all_pairs():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 12, 300).astype(np.uint64))
    b = np.unique(rng.integers(1 << 12, 1 << 13, 300).astype(np.uint64))
    m, r = simhash.trie_forest(a, b, 2)
    adj = (np.bitwise_count(a[:, None] ^ b[None, :]) <= 2)
    vals = np.concatenate([a, b])
    label = np.arange(len(vals))
    while True:  # plain label propagation
        new = label.copy()
        for i, j in zip(*np.nonzero(adj)):
            k = min(new[i], new[len(a) + j])
            new[i] = new[len(a) + j] = k
        if (new == label).all():
            break
        label = new
    root = dict(zip(m.tolist(), r.tolist()))
    assert [root.get(v, v) for v in vals.tolist()] == vals[label].tolist()


def test_edge_cases(spark):
    rows = [(5, None, 1), (3, "", 2), (9, " \t\n", 3), (7, "One two", 4), (8, "oNE \n TWO", 5), (None, "one two", 6),
            (11, "É é", 7), (12, "é é", 8), (7, "One two", 9), (20, "w " * 200_000, 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int").withColumn("_fp", F.lit("x"))
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[5].fingerprint == by[3].fingerprint == by[9].fingerprint == "0" * 16
    assert by[5].component_id == by[3].component_id == 3
    assert by[7].component_id == by[8].component_id == by[None].component_id == 7
    assert by[7].fingerprint == f"{brute_fingerprint('One two'):016x}"
    assert by[11].fingerprint != by[12].fingerprint  # only A-Z are lower-cased
    assert by[20].fingerprint == f"{brute_fingerprint('w ' * 10):016x}"
    empty = simhash.near_duplicates(df.limit(0))
    assert empty.count() == 0


def test_stage_keeps_one_of_each_group(spark):
    df = spark.createDataFrame([(2, "a b c d", "x"), (1, "a b c d", "y"), (3, "other words here", "z")],
                               "doc_id long, text string, source string")
    assert sorted(r.doc_id for r in simhash.stage(spark, df, DIR).collect()) == [1, 3]
