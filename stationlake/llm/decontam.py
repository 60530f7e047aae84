"""Benchmark decontamination: a BM25 inverted index of the test items, searched with block-max WAND.

Every training text is cut into overlapping passages, each a query against the index. Scores are
relative: an item's BM25 score for a passage over its score for itself, so one threshold serves all
items. Postings carry their share of that score; each term knows its largest share (``top``), and
its largest share in each block of items (``block_top``). A passage whose block maxima over the
rarer terms, with the most that common terms make up in one item of the block, do not add up to the
threshold passes that block by; most passages pass by all of them. In what is left, the terms
of least ``top`` whose sum stays below the threshold cannot make a candidate on their own; only the
postings of the others are read. An item goes on while its score so far plus the ``block_top`` of
the skipped terms in its block reaches the threshold; what is left is scored in full.
Passages are worked off many at a time with numpy; no candidate is dropped that could reach the
threshold. Every item retrieved is verified: the words of its question and of its answer that stand
in the passage where a shared five-word shingle puts them. A changed word breaks every shingle over
it, but not the place of its neighbours.

Items are indexed by length class, since a passage is twice as long as the longest item of its
class; an item is whole in at least one passage. The index goes to the tasks in shards of at most
``SHARD_WORDS`` words, length classes together, so what is broadcast is bounded whatever the benchmark's
size; documents are read and cut into words once for all length classes of a shard.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import staged, table, worker_state

K1, B = 1.2, 0.75
RETRIEVE = 0.6             # share of an item's own score that retrieves it
SHINGLE = 5                # words
OVERLAP = 0.8              # share of the item's words in their place by a shared shingle, over the item as a whole
PART_OVERLAP = 0.5         # and at least, in the question and in the answer
SHARD_WORDS = 1_000_000    # words of test items in one index shard
COMMON = 16                # a term in more than this share of a shard's items counts as common
SMALLEST_CLASS = 6         # items of up to 2 ** 6 words are one length class, longer ones one per power of two
BLOCKS = 32                # blocks of items, each with its own maxima per term
CACHE_WORDS = 300_000      # chunks a worker remembers for each index
RUN_CHARS = 4_000_000      # texts worked off at once

_NOT_WORD = re.compile(r"[\W_]+")


def normal_words(text: str | None) -> list[str]:
    """Lower-cased words between white space, letters and digits only."""
    return [w for w in (_NOT_WORD.sub("", c) for c in (text or "").lower().split()) if w]


def answer_start(text: str) -> int:
    """Words of the question: all but the last line, or but the last sentence of a single line, or but
    the last third of a single sentence."""
    lines = [s for s in text.split("\n") if normal_words(s)]
    if len(lines) < 2:
        lines = [s for s in re.split(r"(?<=[.!?])\s+", text) if normal_words(s)]
    n = len(normal_words(text))
    return n - len(normal_words(lines[-1])) if len(lines) > 1 else n - n // 3


# ---- index ------------------------------------------------------------------------------------


@dataclass
class Index:
    """Inverted index of one shard of items of one length class."""

    terms: dict[str, int]
    ptr: np.ndarray          # postings of term t: ptr[t] to ptr[t + 1]
    item: np.ndarray         # item of a posting, ascending within a term
    share: np.ndarray        # its share of the item's score for itself
    top: np.ndarray          # per term: largest share
    block_top: np.ndarray    # per term and block of items: largest share
    rare_top: np.ndarray     # block_top without the terms that many items have
    common: np.ndarray       # per block: what those terms make up in one item at most
    per_block: int           # items of a block
    words: list[np.ndarray]  # term of every word of an item
    ids: list[int]
    question: list[int]      # words of the question
    window: int              # words of a passage


def build_index(items: list[tuple[int, str]], df: dict[str, int], n_items: int, mean_words: float, longest: int) -> Index:
    """``items`` (item_id, text) with the document frequencies ``df`` of their words over all items."""
    terms: dict[str, int] = {}
    words, ids, question, posts = [], [], [], []
    for item_id, text in sorted(items, key=lambda x: (len(x[1]), x[0])):
        ws = normal_words(text)
        if not ws:
            continue
        seq = np.array([terms.setdefault(w, len(terms)) for w in ws], np.int64)
        t, tf = np.unique(seq, return_counts=True)
        idf = np.array([math.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) for w in dict.fromkeys(sorted(ws, key=terms.get))])
        score = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ws) / mean_words))
        posts.append(np.stack([t.astype(float), np.full(len(t), len(ids), float), score / score.sum()]))
        words.append(seq)
        ids.append(item_id)
        question.append(answer_start(text))
    flat = np.concatenate(posts, axis=1) if posts else np.zeros((3, 0))
    flat = flat[:, np.lexsort((flat[1], flat[0]))]
    term, item, share = flat[0].astype(np.int64), flat[1].astype(np.int64), flat[2]
    per_block = max(1, -(-len(ids) // BLOCKS))
    block_top = np.zeros((len(terms), BLOCKS), np.float32)
    # rounded up, so that the maxima stay bounds in single precision
    np.maximum.at(block_top, (term, item // per_block), np.nextafter(share.astype(np.float32), np.float32(2)))
    top = np.zeros(len(terms))
    np.maximum.at(top, term, share)
    many = np.bincount(term, minlength=len(terms)) > max(4, len(ids) // COMMON)
    rare_top = np.where(many[:, None], np.float32(0), block_top)
    common = np.zeros(BLOCKS, np.float32)
    in_many = np.bincount(item[many[term]], share[many[term]], len(ids))
    np.maximum.at(common, np.arange(len(ids)) // per_block, in_many.astype(np.float32))
    return Index(terms, np.searchsorted(term, np.arange(len(terms) + 1)), item, share, top, block_top, rare_top, common, per_block,
                 words, ids, question, 2 * longest)


# ---- search -----------------------------------------------------------------------------------


def _spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every interval lo..hi its positions, and which interval each belongs to."""
    n = hi - lo
    which = np.repeat(np.arange(len(lo)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n), which


def search(index: Index, passage: np.ndarray, term: np.ndarray, open_blocks: np.ndarray,
           threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages given as distinct (passage, term) pairs, ascending → (passage, item, score) from the threshold on.

    ``open_blocks``: passage × block, whether an item of the block can reach the threshold at all.
    """
    none = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    if not len(passage):
        return none
    # terms of each passage by rising top; those whose running sum stays below the threshold are skipped
    order = np.lexsort((term, index.top[term], passage))
    passage, term = passage[order], term[order]
    start = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
    running = np.cumsum(index.top[term])
    running -= np.repeat(np.concatenate(([0.0], running))[start], np.diff(np.append(start, len(passage))))
    read = running >= threshold - 1e-9
    at, which = _spans(index.ptr[term[read]], index.ptr[term[read] + 1])
    n, holder, item = len(index.ids), passage[read][which], index.item[at]
    live = open_blocks[holder, item // index.per_block]
    pair, inverse = np.unique(holder[live] * n + item[live], return_inverse=True)
    score = np.bincount(inverse, index.share[at[live]], len(pair))
    if not len(pair):
        return none
    # the passage's skipped terms, for every pair left: first their maxima in the item's block
    p_skip, t_skip = passage[~read], term[~read]
    lo, hi = np.searchsorted(p_skip, pair // n), np.searchsorted(p_skip, pair // n, "right")
    at, which = _spans(lo, hi)
    bound = score + np.bincount(which, index.block_top[t_skip[at], (pair[which] % n) // index.per_block], len(pair))
    go = bound >= threshold - 1e-6
    pair, score, lo, hi = pair[go], score[go], lo[go], hi[go]
    # then their own postings
    at, which = _spans(lo, hi)
    post_key = np.repeat(np.arange(len(index.top)), np.diff(index.ptr)) * n + index.item
    score = score + np.bincount(which, _lookup(post_key, index.share, t_skip[at] * n + pair[which] % n), len(pair))
    go = score >= threshold - 1e-9
    return pair[go] // n, pair[go] % n, score[go]


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


def ordered(item: np.ndarray, q: int, passage: np.ndarray) -> np.ndarray:
    """Which words of ``item`` stand in ``passage`` where a shingle shared by both puts them.

    A shared shingle of ``SHINGLE`` words (the whole item, if shorter) lays the item over the passage at one offset;
    every word that agrees there counts, so a changed word costs itself and not the shingles around it,
    and words after an inserted or left-out one count by the offset of their own shingles. A question or
    answer (before and from word ``q``) shorter than a shingle also counts if it is whole up to
    ``SHINGLE`` - 1 words beside its place.
    """
    k = min(SHINGLE, len(item))
    at: dict[tuple[int, ...], list[int]] = {}
    known, seq = passage.tolist(), item.tolist()
    for p in range(len(known) - k + 1):
        at.setdefault(tuple(known[p:p + k]), []).append(p)
    offsets = {p - i for i in range(len(seq) - k + 1) for p in at.get(tuple(seq[i:i + k]), ())}
    mask = np.zeros(len(item), bool)
    pad = len(item) + SHINGLE
    padded = np.concatenate([np.full(pad, -1), passage, np.full(pad, -1)])
    for d in offsets:
        mask |= padded[pad + d:pad + d + len(item)] == item
    beside = sorted({d + shift for d in offsets for shift in range(1 - SHINGLE, SHINGLE)})
    for lo, hi in ((0, q), (q, len(item))):
        if 0 < hi - lo < SHINGLE and not mask[lo:hi].all():
            if any((padded[max(0, pad + d + lo):max(0, pad + d + hi)] == item[lo:hi]).all() for d in beside if pad + d + lo >= 0 and pad + d + hi <= len(padded)):
                mask[lo:hi] = True
    return mask


class _Terms(dict):
    """Chunk between white space → term of the index, -1 for a word outside it, -2 for no word."""

    def __init__(self, terms: dict[str, int]):
        super().__init__()
        self.terms = terms

    def __missing__(self, chunk: str) -> int:
        w = chunk if chunk.isalnum() else _NOT_WORD.sub("", chunk)
        got = self.terms.get(w, -1) if w else -2
        if len(chunk) <= 64:
            if len(self) > CACHE_WORDS:
                self.clear()
            self[chunk] = got
        return got


def match_texts(indexes: list[Index], texts: list[str | None], caches: list[_Terms], threshold: float) -> Iterator[tuple[int, int, float, float, float]]:
    """(text number, item id, score, question overlap, answer overlap) of every verified item of every index."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and size < RUN_CHARS:
            size += len(texts[stop] or "")
            stop += 1
        # Arrow cuts the texts and numbers their distinct chunks; each is normalised once a run and index
        cut = pc.utf8_split_whitespace(pa.array([(t or "").lower() for t in texts[at:stop]], pa.large_string()))
        chunks = cut.flatten().dictionary_encode()
        distinct, place = chunks.dictionary.to_pylist(), chunks.indices.to_numpy()
        text = np.repeat(np.arange(stop - at), np.diff(cut.offsets.to_numpy()))
        word = None
        for index, cache in zip(indexes, caches):
            term = np.fromiter(map(cache.__getitem__, distinct), np.int64, len(distinct))
            seq = term[place] if len(place) else np.empty(0, np.int64)
            if word is None:  # the same for every index
                word = seq != -2
                lengths = np.bincount(text[word], minlength=stop - at)
            yield from _match_run(index, seq[word], lengths, at, threshold)
        pa.default_memory_pool().release_unused()
        at = stop


def _match_run(index: Index, seq: np.ndarray, lengths: np.ndarray, base: int, threshold: float):
    """``seq``: the terms of texts of ``lengths`` words, one after the other."""
    stride = index.window // 2
    begin = np.cumsum(lengths) - lengths
    slots = np.maximum(1, -(-lengths // stride))                    # half passages of each text
    first = np.cumsum(slots) - slots
    text = np.repeat(np.arange(len(lengths)), lengths)
    half = first[text] + (np.arange(len(seq)) - begin[text]) // stride
    inside = seq >= 0
    half, term = half[inside], seq[inside]
    n, total = len(index.top), int(slots.sum())
    begins = np.zeros(total + 1, bool)
    begins[first] = True
    begins[total] = True
    # passage h is the halves h and h + 1 of one text; what the block maxima of its rare terms add up to,
    # repeats included, and what the common ones can add at most
    bound = np.zeros((total + 1, index.rare_top.shape[1]), np.float32)
    if len(half):
        starts = np.flatnonzero(np.concatenate(([True], half[1:] != half[:-1])))
        bound[half[starts]] = np.add.reduceat(index.rare_top[term], starts, axis=0)
    bound[:-1] += np.where(begins[1:, None], np.float32(0), bound[1:])
    open_blocks = bound[:-1] + index.common >= threshold - 1e-3
    live = open_blocks.any(axis=1)
    mine = live[half]
    before = ~begins[half] & live[half - 1]                         # a text's first half has none before it
    pairs = np.unique(np.concatenate([half[mine] * n + term[mine], (half[before] - 1) * n + term[before]]))
    p, i, score = search(index, pairs // n, pairs % n, open_blocks, threshold)
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for h, it, s in zip(p.tolist(), i.tolist(), score.tolist()):
        t = int(np.searchsorted(first, h, "right")) - 1
        at = int(begin[t]) + (h - int(first[t])) * stride
        q = index.question[it]
        mask = ordered(index.words[it], q, seq[at:min(at + index.window, int(begin[t] + lengths[t]))])
        parts = [float(m.mean()) if len(m) else 1.0 for m in (mask[:q], mask[q:])]
        if mask.mean() >= OVERLAP and min(parts) >= PART_OVERLAP:
            best[t, it] = max(best.get((t, it), (0.0, 0.0, 0.0)), (s, *parts))
    for (t, it), (s, q, a) in sorted(best.items()):
        yield base + t, index.ids[it], s, q, a


# ---- operator ---------------------------------------------------------------------------------


def _shards(benchmark: DataFrame) -> list[DataFrame]:
    """The items (item_id, text, n_words, cls) of every shard; a shard is bounded in words."""
    counted = F.pandas_udf(lambda texts: texts.map(lambda t: len(normal_words(t))), "long")
    items = staged(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
                   .withColumn("n_words", counted("text")).where("n_words > 0")
                   .withColumn("cls", F.greatest(F.lit(SMALLEST_CLASS), F.ceil(F.log2("n_words"))).cast("int")), "items")
    total = items.agg(F.sum("n_words")).first()[0] or 0
    n = math.ceil(total / (SHARD_WORDS / 2))  # hashed shards of half the bound on average
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [items.where(shard == k) for k in range(n)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = RETRIEVE) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): every document that holds a test item.

    One row per row of ``docs`` and item. Null and empty texts hold none; null and empty items are
    in none. Other columns are not read.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id long, score double, question_overlap double, answer_overlap double"

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"words": [len(normal_words(t)) for t in pdf["text"]],
                                "terms": [sorted(set(normal_words(t))) for t in pdf["text"]]})

    shards = _shards(benchmark)
    bags = staged(benchmark.select("text").mapInPandas(terms, "words long, terms array<string>").where("words > 0"), "item-terms")
    n_items, mean_words = bags.agg(F.count("*"), F.avg("words")).first()
    frequency = bags.select(F.explode("terms").alias("term")).groupBy("term").count()
    out = None
    for rows in shards:
        held = rows.select("item_id", "text", "cls").collect()  # bounded by SHARD_WORDS
        wanted = rows.select("text").mapInPandas(terms, "words long, terms array<string>").select(F.explode("terms").alias("term")).distinct()
        df = {r.term: r["count"] for r in frequency.join(wanted, "term").collect()}
        by_class: dict[int, list] = {}
        for r in held:
            by_class.setdefault(r.cls, []).append((r.item_id, r.text))
        shared = spark.sparkContext.broadcast(
            [build_index(items, df, n_items, mean_words, 1 << cls) for cls, items in sorted(by_class.items())])
        shard = uuid.uuid4().hex

        def run(batches: Iterator[pd.DataFrame], shared=shared, shard=shard) -> Iterator[pd.DataFrame]:
            indexes = shared.value
            caches = worker_state(("decontam", shard), lambda: [_Terms(index.terms) for index in indexes])
            for pdf in batches:
                ids = pdf["doc_id"].tolist()
                found = list(match_texts(indexes, pdf["text"].tolist(), caches, threshold)) if indexes else []
                yield pd.DataFrame({"doc_id": pd.Series([ids[f[0]] for f in found], dtype=pdf["doc_id"].dtype),
                                    **{c: pd.Series([f[k] for f in found], dtype=t) for k, (c, t) in enumerate(
                                        [("item_id", "int64"), ("score", "float64"), ("question_overlap", "float64"),
                                         ("answer_overlap", "float64")], 1)}})

        part = docs.select("doc_id", "text").mapInPandas(run, schema)
        out = part if out is None else out.union(part)
    return out if out is not None else spark.createDataFrame([], schema)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a test item go (rows without an id by the same rule)."""
    held = staged(find_leaks(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_leak")).distinct(), "leaks")
    return docs.join(held, docs["doc_id"].eqNullSafe(held["_leak"]), "left_anti").select(*docs.columns)
