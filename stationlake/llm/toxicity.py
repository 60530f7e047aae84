"""Toxicity by weak supervision.

Many weak *voters* look at a text: lexicon terms and word beginnings that the labelled rows show to
be telling, patterns of address and typography, and the given label itself. A generative model of
the votes is fitted by expectation-maximisation: a hidden class with a prior, and for each voter how
often it speaks up in either class (its accuracy). Voters that speak up together beyond what the
class explains are correlated, and share one say. The model's posterior labels train a logistic
classifier on hashed words and word beginnings, and that classifier scores every text.

Fitting uses a bounded sample of the labelled rows (``TOXIC_ROWS`` and ``CLEAN_ROWS``, weighted back
to the classes' real shares); scoring covers every row and whole texts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import table

TOXIC_ROWS = 1_500         # labelled rows of each class that the fit may see at most
CLEAN_ROWS = 3_000
SPACE = 1 << 18            # hashed features
STEMS = (4, 5, 6)          # lengths of the word beginnings used besides whole words
LEXICON = 60               # mined voters
LABEL_ERROR = 0.03         # how often a given label is taken to be wrong
CHANCE = 3.0               # standard errors by which a classifier feature must lean to either label
MIN_ROWS = 4               # rows a mined feature must occur in
CACHE_WORDS = 400_000      # words remembered by one Python worker

_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")
_PATTERNS = [
    re.compile(r"\b(?:you|u)\b(?:\W+\w+){0,4}\W+(?:idiot|moron|fool|loser|scum|trash)s?\b", re.I),
    re.compile(r"[!?]{2,}"),
    re.compile(r"\b(?:hate|kill|shut up|get lost)\b", re.I),
    re.compile(r"\b[A-Z]{4,}(?:\W+[A-Z]{4,})+\b"),
    re.compile(r"[@#$%&*]{3,}"),
]


# ---- features ---------------------------------------------------------------------------------


def _word_features(word: str) -> list[int]:
    """Hashed features of one word: the word itself and its beginnings."""
    out = [zlib.crc32(word.encode("utf-8", "surrogatepass")) % SPACE]
    return out + [zlib.crc32(b"^" + word[:n].encode("utf-8", "surrogatepass")) % SPACE for n in STEMS if len(word) > n]


class WordTable:
    """Chunk between spaces → its word (trimmed of non-letters), remembered per worker up to a bound."""

    def __init__(self):
        self.words: dict[str, str] = {}

    def words_of(self, text: str | None) -> set[str]:
        known, out = self.words, set()
        if len(known) > CACHE_WORDS:
            known.clear()
        for chunk in set((text or "").lower().split()):
            w = known.get(chunk)
            if w is None:
                w = _EDGE.sub("", chunk)
                if len(chunk) <= 64:
                    known[chunk] = w
            if w:
                out.add(w)
        return out


def text_features(table_: WordTable, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Feature ids, their counts over the distinct words, the votes of the patterns, the number of distinct words."""
    words = table_.words_of(text)
    ids = np.array([f for w in words for f in _word_features(w)], np.int64)
    ids, counts = np.unique(ids, return_counts=True) if len(ids) else (ids, ids)
    return ids, counts, np.array([p.search(text or "") is not None for p in _PATTERNS], bool), len(words)


# ---- label model ------------------------------------------------------------------------------


def label_model(votes: np.ndarray, weight: np.ndarray, start: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, dict]:
    """Posterior of class 1 per row of ``votes`` (rows × voters, True where a voter speaks up).

    EM over a hidden class: ``hit[c, j]`` is how often voter j speaks up in class c. A voter that is
    silent abstains, but for the last one, the given label, which speaks for either class and errs
    at the rate ``LABEL_ERROR``. The log odds of voters are divided by their *share*, one plus their
    positive correlations with other voters within the classes, so that copies of one signal count
    once. ``start`` are the first posteriors.
    """
    post, v = start.astype(float), votes.astype(float)
    share = np.ones(v.shape[1])
    for n in range(rounds):
        w1, w0 = weight * post, weight * (1 - post)
        prior = w1.sum() / weight.sum()
        hit = np.stack([(w0 @ v + 0.5) / (w0.sum() + 1), (w1 @ v + 0.5) / (w1.sum() + 1)])
        if n % 5 == 0:  # correlations within the classes
            dev = v - (post[:, None] * hit[1] + (1 - post)[:, None] * hit[0])
            cov = (dev * weight[:, None]).T @ dev / weight.sum()
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            corr = cov / sd / sd[:, None]
            np.fill_diagonal(corr, 0)
            share = 1 + np.where(corr > 0.1, corr, 0).sum(axis=1)
        hit[:, -1] = LABEL_ERROR, 1 - LABEL_ERROR
        share[-1] = 1
        speak = np.log(hit[1] / hit[0]) / share
        silent = np.zeros_like(speak)
        silent[-1] = -speak[-1]
        logit = v @ speak + (1 - v) @ silent
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - post).max() < 1e-4:
            post = new
            break
        post = new
    return post, {"prior": prior, "hit": hit, "share": share}


# ---- classifier -------------------------------------------------------------------------------


@dataclass
class Model:
    """Linear classifier: ``weights`` over the hashed features, ``per_word`` for the log of the length."""

    weights: np.ndarray
    bias: float
    per_word: float


def _fit_linear(ids, vals, ptr, size, target, weight, l2=0.3, steps=150) -> tuple[np.ndarray, float, float]:
    """Weighted logistic regression on soft targets, by Adam on the full sample."""
    rows = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    used, col = np.unique(ids, return_inverse=True)
    theta = np.zeros(len(used) + 2)
    theta[-2] = np.log((target @ weight + 1) / (weight.sum() - target @ weight + 1))
    m, s, total = np.zeros_like(theta), np.zeros_like(theta), weight.sum()
    for t in range(1, steps + 1):
        z = np.bincount(rows, vals * theta[col], len(target)) + theta[-2] + theta[-1] * size
        err = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / total
        grad = np.concatenate([np.bincount(col, vals * err[rows], len(used)) + l2 * theta[:-2] / total,
                               [err.sum(), err @ size]])
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad * grad
        theta -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-9)
    out = np.zeros(SPACE, np.float32)
    out[used] = theta[:-2]
    return out, float(theta[-2]), float(theta[-1])


def fit(ids: list[np.ndarray], counts: list[np.ndarray], patterns: np.ndarray, words: np.ndarray, labels: np.ndarray,
        shares: tuple[float, float]) -> Model:
    """Voters, label model, classifier from a labelled sample; ``shares``: real counts of labels 0 and 1."""
    if not len(labels):
        return Model(np.zeros(SPACE, np.float32), -3.0, 0.0)
    n1, n0 = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))
    real = max(1.0, shares[0] + shares[1])
    weight = np.where(labels == 1, shares[1] / real * len(labels) / n1, shares[0] / real * len(labels) / n0)
    if labels.min() == labels.max():
        return Model(np.zeros(SPACE, np.float32), 3.0 if labels[0] else -3.0, 0.0)
    ptr = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
    all_ids, all_counts = np.concatenate(ids).astype(np.int32), np.concatenate(counts).astype(np.int32)
    rows = np.repeat(np.arange(len(labels), dtype=np.int32), np.diff(ptr))
    df1 = np.bincount(all_ids, labels[rows] == 1, SPACE) / n1
    df0 = np.bincount(all_ids, labels[rows] == 0, SPACE) / n0
    seen = np.bincount(all_ids, minlength=SPACE)
    # lexicon voters: features whose presence says most about the label
    lean = np.where(seen >= MIN_ROWS, (df1 - df0) / np.sqrt(df1 + df0 + 5 / len(labels)), -1)
    lexicon = np.argsort(-lean, kind="stable")[:LEXICON]
    lexicon = lexicon[lean[lexicon] > 0]
    votes = np.zeros((len(labels), 2 * len(lexicon) + patterns.shape[1] + 1), bool)
    place = np.full(SPACE, -1)
    place[lexicon] = np.arange(len(lexicon))
    hit = place[all_ids] >= 0
    votes[rows[hit], place[all_ids[hit]]] = True
    often = hit & (all_counts > 1)  # a beginning shared by several distinct words is a voter of its own
    votes[rows[often], len(lexicon) + place[all_ids[often]]] = True
    votes[:, 2 * len(lexicon):-1] = patterns
    votes[:, -1] = labels == 1
    target, _ = label_model(votes, weight, np.where(labels == 1, 0.95, 0.05))
    # features whose presence differs between the labels by more than chance would have it
    share = np.clip((df1 * n1 + df0 * n0) / len(labels), 1e-9, 1 - 1e-9)
    apart = np.abs(df1 - df0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    keep = ((seen >= MIN_ROWS) & (apart >= CHANCE))[all_ids]
    kept_ptr = np.concatenate(([0], np.cumsum(np.bincount(rows[keep], minlength=len(labels)))))
    size = np.log1p(words)
    weights, bias, per_word = _fit_linear(all_ids[keep], all_counts[keep].astype(np.float32), kept_ptr, size - 5, target, weight)
    return Model(weights, bias - 5 * per_word, per_word)


class Scorer:
    """Scores texts with a model; a word's summed weight is remembered per worker."""

    def __init__(self, model: Model):
        self.model, self.table, self.of = model, WordTable(), {}

    def score(self, text: str | None) -> float:
        of, w = self.of, self.model.weights
        if len(of) > CACHE_WORDS:
            of.clear()
        total, n = 0.0, 0
        for word in self.table.words_of(text):
            known = of.get(word)
            if known is None:
                known = float(w[_word_features(word)].sum())
                if len(word) <= 64:
                    of[word] = known
            total += known
            n += 1
        z = total + self.model.bias + self.model.per_word * math.log1p(n)
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, z))))


# ---- operator ---------------------------------------------------------------------------------


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    """Fit on ``labels`` (doc_id, toxic 0/1) and the texts of ``docs``; null or other labels teach nothing.

    A label whose document is missing is ignored; a document with several labels has the one that most of them
    give (toxic if they are even), and of several texts under one id the one with the smallest hash teaches.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    shares = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.where("toxic = 1").orderBy(*order).limit(toxic_rows).union(
        known.where("toxic = 0").orderBy(*order).limit(clean_rows))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordTable()
        for pdf in batches:
            got = [text_features(words, t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "toxic": pdf["toxic"], "ids": [g[0].tolist() for g in got],
                                "counts": [g[1].tolist() for g in got], "patterns": [g[2].tolist() for g in got],
                                "words": [g[3] for g in got]})

    # the picked ids are bounded by the two parameters, so they may be broadcast; one row of each reaches the driver
    rows_of = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    sample = (rows_of.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
              .select("doc_id", "toxic", "text").mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, toxic int, ids array<int>, "
                                "counts array<int>, patterns array<boolean>, words int"))
    rows = sample.toArrow().combine_chunks().sort_by("doc_id")
    flat = lambda c: rows[c].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    n = rows["ids"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False) if len(rows) else np.empty(0, np.int64)
    cut = np.cumsum(n)[:-1]
    return fit(np.split(flat("ids"), cut) if len(rows) else [], np.split(flat("counts"), cut) if len(rows) else [],
               flat("patterns").reshape(len(rows), len(_PATTERNS)).astype(bool), rows["words"].to_numpy().astype(np.int64),
               rows["toxic"].to_numpy().astype(np.int64), (shares.get(0, 0), shares.get(1, 0)))


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on), replacing columns of those names.

    Null and empty texts get the score of a text without words.
    """
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for pdf in batches:
            score = np.array([scorer.score(t) for t in pdf["text"]])
            yield pdf.assign(score=score, predicted=(score >= 0.5).astype(np.int32))

    return docs.select(*[f"`{c}`" for c in keep]).mapInPandas(run, f"{schema}, score double, predicted int")


def held_out() -> Column:
    """Rows that never teach: crc32 of the id as text, modulo 5, is 0 (a null id's is not)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return score_toxicity(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")
