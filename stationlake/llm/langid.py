"""Language ID by hyperdimensional profiles.

Every letter has a random vector of ``DIM`` signs, drawn from its code point. A letter n-gram is
bound by multiplying its letters' vectors after rotating each by its place; a text's vector bundles
(adds) its n-gram vectors, a language's prototype bundles the unit vectors of its training texts,
and a text gets the language whose prototype has the largest cosine with its own vector.

Prototypes are sums, so they are built by partial sums in every task and a grouped sum; what reaches
the driver is one vector per language.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import table, worker_state

DIM = 1024                 # length of a hypervector
GRAM = 3                   # letters of an n-gram
SEED = 20_240_601
UNKNOWN = "und"
KEPT_GRAMS = 20_000        # n-gram vectors one worker remembers (one byte per sign)
REJECT_BELOW = 3 * DIM ** -0.5  # three standard deviations of the cosine of unrelated vectors
JUDGED_GRAMS = 40          # the cosine of a text with fewer distinct n-grams says nothing about it
LETTER_SHARE = 1e-5        # share of a language's letters from which a letter counts as learned
FOREIGN_SHARE = 0.5        # a text with more letters than this that no language has is foreign
SPACE = 0                  # one symbol for everything between words


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    """Code point → lower-cased letter's code point, 0 for what is not a letter."""
    table_ = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == "L":
            low = chr(c).lower()
            table_[c] = ord(low) if len(low) == 1 else c
    return table_


@lru_cache(maxsize=100_000)
def letter_vector(letter: int) -> np.ndarray:
    return np.random.default_rng((SEED, letter)).integers(0, 2, DIM, np.int8) * np.int8(2) - np.int8(1)


def gram_vector(gram: tuple[int, ...]) -> np.ndarray:
    """Product of the letters' vectors, the first rotated most."""
    out = np.ones(DIM, np.int8)
    for place, letter in enumerate(gram):
        out = out * np.roll(letter_vector(letter), GRAM - 1 - place)
    return out


def symbols(text: str | None) -> np.ndarray:
    """Lower-cased letters, each run of other characters as one ``SPACE``, a ``SPACE`` at both ends."""
    if not text:
        return np.empty(0, np.uint32)
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    s = np.concatenate(([SPACE], _letter_table()[raw], [SPACE])).astype(np.uint32)
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != SPACE) | (s[:-1] != SPACE)
    s = s[keep]
    return s if len(s) > 1 else np.empty(0, np.uint32)


class Profiler:
    """Text vectors, with the n-gram vectors of one worker remembered up to ``KEPT_GRAMS``."""

    def __init__(self):
        self.slot: dict[int, int] = {}
        self.vectors = np.empty((1024, DIM), np.int8)

    def _rows(self, grams: np.ndarray) -> np.ndarray:
        slot = self.slot
        if len(slot) + len(grams) > KEPT_GRAMS:
            slot.clear()
        rows = np.empty(len(grams), np.int64)
        for i, g in enumerate(grams.tolist()):
            at = slot.get(g)
            if at is None:
                at = slot[g] = len(slot)
                if at >= len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
                self.vectors[at] = gram_vector((g >> 42, g >> 21 & 0x1FFFFF, g & 0x1FFFFF))
            rows[i] = at
        return self.vectors[rows]

    def vector(self, text: str | None) -> np.ndarray | None:
        """Bundle of the text's n-grams as a unit vector; None if it has no letter."""
        return self.profile(symbols(text))[0]

    def profile(self, letters: np.ndarray) -> tuple[np.ndarray | None, int]:
        """The unit vector of a text's ``symbols``, and its number of distinct n-grams."""
        s = letters.astype(np.int64)
        if len(s) < GRAM:
            return None, 0
        grams, counts = np.unique((s[:-2] << 42) | (s[1:-1] << 21) | s[2:], return_counts=True)
        total = np.zeros(DIM, np.float32)
        for at in range(0, len(grams), 8192):
            total += counts[at:at + 8192].astype(np.float32) @ self._rows(grams[at:at + 8192]).astype(np.float32)
        norm = float(np.sqrt(total @ total))
        return (total / norm if norm else total), len(grams)


def _profiler() -> Profiler:
    return worker_state("langid", Profiler)


def train_prototypes(docs: DataFrame) -> dict[str, np.ndarray]:
    """``docs`` (text, lang) → unit prototype per language; rows without language or letter teach nothing."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        prof = _profiler()
        for pdf in batches:
            for text, lang in zip(pdf["text"], pdf["lang"]):
                v = prof.vector(text)
                if v is not None:
                    sums[lang] = sums[lang] + v if lang in sums else v.astype(np.float64)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "vec": [v.tolist() for v in sums.values()]})

    # element-wise sums: one row per language and element, partially aggregated in every task
    parts = (docs.where(F.col("lang").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
             .mapInPandas(partial, "lang string, vec array<double>"))
    sums = (parts.select("lang", F.posexplode("vec").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
            .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v")))
    out = {}
    for r in sums.orderBy("lang").collect():  # one vector per language
        v = np.array([e.x for e in r.v], np.float32)
        norm = float(np.sqrt(v @ v))
        if norm:
            out[r.lang] = v / norm
    return out


def predict_language(docs: DataFrame, prototypes: dict[str, np.ndarray], pred_col: str = "lang_pred",
                     score_col: str = "score") -> DataFrame:
    """``docs`` plus language and score (cosine, 0 to 1), which replace columns of those names.

    ``und`` with score 0 if the text is null or has no letter (or nothing was learned); equal cosines
    go to the language first in alphabetical order.
    """
    langs = sorted(prototypes)
    matrix = np.stack([prototypes[k] for k in langs]).astype(np.float32) if langs else np.zeros((0, DIM), np.float32)
    keep = [c for c in docs.columns if c not in (pred_col, score_col)]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        prof = _profiler()
        for pdf in batches:
            pred, score = [], []
            for text in pdf["text"]:
                v = prof.vector(text) if langs else None
                if v is None:
                    pred.append(UNKNOWN)
                    score.append(0.0)
                else:
                    cos = matrix @ v
                    best = int(np.argmax(cos))
                    pred.append(langs[best])
                    score.append(float(min(1.0, max(0.0, cos[best]))))
            yield pdf.assign(**{pred_col: pred, score_col: score})

    return docs.select(*[f"`{c}`" for c in keep]).mapInPandas(run, f"{schema}, `{pred_col}` string, `{score_col}` double")


def learned_letters(docs: DataFrame) -> np.ndarray:
    """``docs`` (text, lang) → code points of the letters that make up ``LETTER_SHARE`` of some language's letters.

    Letters are counted in every task and added up by language and letter, so what moves is bounded by
    the number of code points.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for text, lang in zip(pdf["text"], pdf["lang"]):
                have = sums.setdefault(lang, np.zeros(0x110000, np.int64))
                at = np.bincount(symbols(text), minlength=1)
                have[:len(at)] += at
        for lang, have in sums.items():
            have[SPACE] = 0
            some = np.flatnonzero(have)
            yield pd.DataFrame({"lang": lang, "letter": some, "n": have[some]})

    counts = (docs.where(F.col("lang").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
              .mapInPandas(count, "lang string, letter int, n long").groupBy("lang", "letter").agg(F.sum("n").alias("n")))
    per_lang: dict[str, list] = {}
    for r in counts.collect():  # one row per language and letter
        per_lang.setdefault(r.lang, []).append((r.letter, r.n))
    known = {letter for found in per_lang.values() for letter, n in found if n >= LETTER_SHARE * sum(m for _, m in found)}
    return np.array(sorted(known), np.uint32)


def readable(docs: DataFrame, prototypes: dict[str, np.ndarray], letters: np.ndarray) -> DataFrame:
    """The rows of ``docs`` in a learned language, as far as their ``text`` allows a judgement.

    A text goes if it has no letter (null and empty texts too), if more than ``FOREIGN_SHARE`` of its letters
    are not among the learned ``letters``, or if it has ``JUDGED_GRAMS`` distinct n-grams and its cosine with every
    language is below ``REJECT_BELOW``. Few n-grams, in a short text or in a long one that repeats itself, are
    no ground to drop it. If nothing was learned, every text goes.
    """
    langs = sorted(prototypes)
    matrix = np.stack([prototypes[k] for k in langs]).astype(np.float32) if langs else np.zeros((0, DIM), np.float32)
    known = np.zeros(0x110000, bool)
    known[letters] = True

    def kept(prof: Profiler, text: str | None) -> bool:
        s = symbols(text)
        if not langs or not len(s):
            return False
        only = s[s != SPACE]
        if np.count_nonzero(known[only]) < (1 - FOREIGN_SHARE) * len(only):
            return False
        v, n_grams = prof.profile(s)
        return n_grams < JUDGED_GRAMS or float((matrix @ v).max()) >= REJECT_BELOW

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        prof = _profiler()
        for pdf in batches:
            yield pdf[[kept(prof, text) for text in pdf["text"]]]

    return docs.mapInPandas(run, docs.schema)


def held_out() -> Column:
    """Rows that never teach: crc32 of the id as text, modulo 3, is 1 (a null id's is not)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = train_prototypes(docs.where(~held_out()))
    return predict_language(docs.select("doc_id", "text"), prototypes).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without any letter, or not in a learned language, go (see ``readable``)."""
    teach = docs.where(~held_out())
    return readable(docs, train_prototypes(teach), learned_letters(teach))
