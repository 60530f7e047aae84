"""SimHash near-dedup: 64-bit fingerprints, linked by a binary-trie self-join, grouped by reachability.

Fingerprints: per document, the majority vote of the 64 bits of its word shingles' XXH64 hashes.

Links: distinct fingerprints form a binary trie of 64 levels; the self-join descends it by *pairs* of
nodes, adds up the levels at which the two sides differ and drops a pair once that exceeds the
budget. To spread it over tasks the trie is read in ``max_bits + 1`` rotations, each putting another
block of bits first. Two fingerprints within the budget agree on at least one block, so it is enough
to start, in each rotation, from the pairs (node, node) below that block, where no bit differs yet.
A node with more than ``leaf`` fingerprints is not given to one task: it is replaced by the pairs of
its descendants ``SPLIT`` levels down that are still within budget, repeatedly, until the pairs are
small. Each task returns a spanning forest of the links it finds, never the links themselves, so a
dense group costs one row per member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import NO_ID, doc_key, staged, table, worker_state
from stationlake.llm.components import components, sized

BITS = 64
SPLIT = 6                  # trie levels a crowded node is opened by at a time
LEAF = 20_000              # fingerprints below a node pair that one task joins
_SEED = 42


# ---- fingerprints -----------------------------------------------------------------------------


def text_fingerprint(text: str | None, words: int = 3) -> int:
    """Bit i is set if it is set in over half of the shingle hashes; no words: zero."""
    # bytes.lower / bytes.split are exactly A-Z and [\x20\x09-\x0D]
    toks = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not toks:
        return 0
    n = max(1, len(toks) - words + 1)
    joined = b" ".join(toks)
    ends = np.cumsum([len(t) + 1 for t in toks]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(words, len(toks)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory on very long texts
        h = np.fromiter([digest(joined[a:b], _SEED) for a, b in zip(starts[at:at + (1 << 16)], stops[at:at + (1 << 16)])],
                        np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, _d, _fp): one row per row of ``docs``; the fingerprint as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = np.array([text_fingerprint(t, words) for t in pdf["text"]], np.uint64)
            worker_state("simhash", object)  # nothing is kept, and what another operator kept goes
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "_d": pdf["_d"], "_fp": fp.view(np.int64)})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", doc_key().alias("_d"), "text").mapInPandas(run, f"doc_id {id_type}, _d long, _fp long")


# ---- trie self-join ---------------------------------------------------------------------------


def _rotated(fp: F.Column, turn: int) -> F.Column:
    return fp if turn == 0 else F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, BITS - turn))


def _find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Roots of ``x`` (a parent is never larger than its child), with the paths halved on the way."""
    while True:
        up = parent[x]
        if (up == x).all():
            return x
        parent[x] = parent[up]
        x = parent[x]


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of every pair; ties in one round are settled in the next."""
    while len(a):
        a, b = _find(parent, a), _find(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def trie_forest(left: np.ndarray, right: np.ndarray, max_bits: int, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between ``left`` and ``right``: (member, root) values.

    Both are sorted distinct uint64: the same array, joined with itself below each of its nodes at
    ``depth``, or the members of two different nodes. The frontier holds node pairs as intervals of
    the two arrays; one step splits both nodes at the next level and keeps the child pairs whose
    common levels differ in no more than the budget.
    """
    same = left is right
    values = left if same else np.concatenate([left, right])
    base = 0 if same else len(left)
    parent = np.arange(len(values), dtype=np.int64)
    if same:
        l0 = np.flatnonzero(np.concatenate(([True], ((left[1:] ^ left[:-1]) & _prefix_mask(depth)) != 0)))
        l1 = np.append(l0[1:], len(left))
        stack = [(l0, l1, l0, l1, depth)]
    else:
        stack = [(np.array([0]), np.array([len(left)]), np.array([0]), np.array([len(right)]), 0)]
    small = 32
    while stack:
        l0, l1, r0, r1, level = stack.pop()
        if len(l0) > (1 << 15):  # bounded frontier: the rest waits
            half = len(l0) // 2
            stack.append((l0[half:], l1[half:], r0[half:], r1[half:], level))
            l0, l1, r0, r1 = l0[:half], l1[:half], r0[:half], r1[:half]
        # all members of a node agree above ``level``, so the first ones tell how many levels differ
        keep = _popcount((left[l0] ^ right[r0]) & _prefix_mask(level)) <= max_bits
        keep &= ~((l1 - l0 == 1) & (l0 == r0)) if same else True  # a value is not paired with itself
        l0, l1, r0, r1 = l0[keep], l1[keep], r0[keep], r1[keep]
        leaf = ((l1 - l0) * (r1 - r0) <= small) | (level == BITS)
        if leaf.any():
            _leaf_links(parent, left, right, base, l0[leaf], l1[leaf], r0[leaf], r1[leaf], max_bits)
            l0, l1, r0, r1 = l0[~leaf], l1[~leaf], r0[~leaf], r1[~leaf]
        if not len(l0):
            continue
        lm, rm = _split(left, l0, l1, level), _split(right, r0, r1, level)
        kids = [(l0, lm, r0, rm), (lm, l1, rm, r1), (l0, lm, rm, r1), (lm, l1, r0, rm)]
        if same:  # a pair (node, node) opens into its two children and one cross pair
            twin = (l0 == r0) & (l1 == r1)
            kids[3] = tuple(x[~twin] for x in kids[3])
        nxt = [np.concatenate([k[i] for k in kids]) for i in range(4)]
        full = (nxt[0] < nxt[1]) & (nxt[2] < nxt[3])
        if full.any():
            stack.append((*(x[full] for x in nxt), level + 1))
    root = _find(parent, np.arange(len(values)))
    moved = root != np.arange(len(values))
    return values[moved], values[root[moved]]


def _prefix_mask(level: int) -> np.uint64:
    return np.uint64(0) if level == 0 else np.uint64(((1 << level) - 1) << (BITS - level))


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def _split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, level: int) -> np.ndarray:
    """Where, in each interval of one node, the child with bit ``level`` set begins."""
    bit = np.uint64(1) << np.uint64(BITS - 1 - level)
    first = (values[lo] & _prefix_mask(level)) | bit
    return np.clip(np.searchsorted(values, first), lo, hi)


def _leaf_links(parent, left, right, base, l0, l1, r0, r1, max_bits) -> None:
    """Compare the members of small pairs one by one and unite those within budget."""
    n = (l1 - l0) * (r1 - r0)
    pair = np.repeat(np.arange(len(n)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    width = (r1 - r0)[pair]
    i, j = l0[pair] + k // width, r0[pair] + k % width
    near = _popcount(left[i] ^ right[j]) <= max_bits
    _unite(parent, i[near], j[near] + base)


def _unrotated(turn: int, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    if turn:
        a, b = ((x >> np.uint64(turn)) | (x << np.uint64(BITS - turn)) for x in (a, b))
    return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


def _join_shard(key: tuple, pdf: pd.DataFrame, max_bits: int, depth: int) -> pd.DataFrame:
    """Every node of a shard with itself."""
    v = np.sort(pdf["v"].to_numpy().view(np.uint64))
    return _unrotated(int(key[0]), *trie_forest(v, v, max_bits, depth))


def _join_pair(key: tuple, pdf: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """One node pair: key is (turn, node a, node b)."""
    v, side = pdf["v"].to_numpy().view(np.uint64), pdf["side"].to_numpy()
    left = np.sort(v if key[1] == key[2] else v[side == 0])
    right = left if key[1] == key[2] else np.sort(v[side == 1])
    return _unrotated(int(key[0]), *trie_forest(left, right, max_bits))


def trie_links(distinct: DataFrame, max_bits: int = 3, leaf: int = LEAF) -> DataFrame:
    """``distinct`` (fp long) → links (a, b) whose components are those of all pairs within ``max_bits``."""
    spark = distinct.sparkSession
    width = BITS // (max_bits + 1)
    nodes = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(r * width).alias("turn"), _rotated(F.col("fp"), r * width).alias("v"))
        for r in range(max_bits + 1)])).alias("n")).select("n.turn", F.col("n.v").alias("v"))
    nodes = nodes.withColumn("node", F.shiftrightunsigned("v", BITS - width))
    crowded = staged(nodes.groupBy("turn", "node").count().where(F.col("count") > leaf).select("turn", "node"), "crowded")
    calm, opened = nodes, []
    if not crowded.isEmpty():
        calm = nodes.join(crowded, ["turn", "node"], "left_anti")
        busy = nodes.join(crowded, ["turn", "node"]).select(
            "turn", F.col("node").alias("na"), F.col("node").alias("nb"), F.lit(0).alias("side"), "v")
        opened = _open_crowded(busy, width, max_bits, leaf)
    # nodes of at most ``leaf`` members, spread by hash over shards of about that size
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), distinct.count() // leaf + 1)
    links = (calm.withColumn("shard", F.pmod(F.xxhash64("turn", "node"), F.lit(shards))).select("turn", "shard", "v")
             .groupBy("turn", "shard").applyInPandas(lambda k, p: _join_shard(k, p, max_bits, width), "a long, b long"))
    for part in opened:
        links = links.union(part)
    return links


def _open_crowded(busy: DataFrame, depth: int, max_bits: int, leaf: int) -> list[DataFrame]:
    """Open crowded node pairs ``SPLIT`` levels at a time until every pair fits a task.

    ``busy`` has one row per member and side of a crowded pair (turn, na, nb); a pair of a node with
    itself holds each member once. A member goes to the child pairs within budget, found from its
    own child node by flipping at most ``max_bits`` of the new bits of the other side.
    """
    out, keys = [], ["turn", "na", "nb"]
    while True:
        step = min(SPLIT, BITS - depth)
        depth += step
        flips = [m for m in range(1 << step) if m.bit_count() <= max_bits]
        low = F.lit((1 << step) - 1).cast("long")
        other = F.when(F.col("side") == 0, F.col("nb")).otherwise(F.col("na"))
        mate = F.shiftleft(other, step).bitwiseOR(F.col("own").bitwiseAND(low).bitwiseXOR(F.col("flip")))
        kids = (busy.withColumn("own", F.shiftrightunsigned("v", BITS - depth))
                .withColumn("flip", F.explode(F.array(*[F.lit(m).cast("long") for m in flips]))).withColumn("mate", mate)
                .where(F.bit_count(F.col("own").bitwiseXOR(F.col("mate"))) <= max_bits))
        # below a pair (node, node) the smaller child of a cross pair is side 0
        side = F.when(F.col("na") == F.col("nb"), (F.col("own") > F.col("mate")).cast("int")).otherwise(F.col("side"))
        kids = staged(kids.withColumn("side", side).select(
            "turn", F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("mate")).alias("na"),
            F.when(F.col("side") == 0, F.col("mate")).otherwise(F.col("own")).alias("nb"), "side", "v"), "node-pairs")
        sizes = kids.groupBy(*keys).agg(F.count("*").alias("n"), F.min("side").alias("s0"), F.max("side").alias("s1"))
        live = staged(sizes.where("na = nb OR s0 < s1").select(*keys, ((F.col("n") > leaf) & F.lit(depth < BITS)).alias("big")),
                      "live-pairs")
        members = kids.join(live, keys)
        out.append(members.where("NOT big").select(*keys, "side", "v").groupBy(*keys)
                   .applyInPandas(lambda k, p: _join_pair(k, p, max_bits), "a long, b long"))
        if live.where("big").isEmpty():
            return out
        busy = staged(members.where("big").drop("big"), "busy-pairs")


# ---- operator ---------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 3, leaf: int = LEAF) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs``.

    Null and empty texts and texts without words have fingerprint zero and are linked like any
    other. ``component_id`` is the smallest ``doc_id`` reachable over links of ``max_bits`` or fewer
    differing bits. Rows with a null ``doc_id`` take part as the largest id; a component of only
    such rows has a null ``component_id``. Repeated rows keep one output row each. Other columns of ``docs`` are not read.
    """
    prints = staged(fingerprints(docs, words), "fingerprints")
    classes = staged(prints.groupBy("_fp").agg(F.min("_d").alias("_first")), "fingerprint-classes")
    roots = components(trie_links(classes.select(F.col("_fp").alias("fp")), max_bits, leaf))
    # a fingerprint without links is a component of its own: only the linked ones meet their component's others
    smallest = (classes.join(roots, classes["_fp"] == roots["node"])
                .groupBy("root").agg(F.min("_first").alias("_component")))
    linked = staged(sized(roots.join(smallest, "root").select(F.col("node").alias("_fp"), "_component"), roots.count()),
                    "fingerprint-components")
    out = prints.join(classes.join(linked, "_fp", "left").select(
        "_fp", F.coalesce("_component", "_first").alias("_component")), "_fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
                      F.when(F.col("_component") < NO_ID, F.col("_component")).alias("component_id"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the document of smallest id of each component stays (rows of one id are one
    document; rows without an id stay if some such row is linked to no row with one)."""
    found = near_duplicates(docs).where("doc_id <=> component_id").select(F.col("doc_id").alias("_keep")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_keep"]), "left_semi").select(*docs.columns)
