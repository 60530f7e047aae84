"""Importance resampling towards a target corpus, by hashed n-gram features.

A feature is a run of words; its bucket is the CRC-32 of its bytes. The corpus and the target are counted
by bucket, a bucket's gain is the log ratio of its smoothed shares, a document's weight the mean
gain of its features, and the documents with the highest weight plus Gumbel noise are drawn, which
samples without replacement in proportion to the importance.

Text is split into *head* and *tail*. The head is a bounded vocabulary of the most frequent words and
word pairs, found by one pass and broadcast: the words with the exact state of the CRC after their
last byte (what a longer run goes on from) and the pairs with their buckets. A run that is not in the
head, the tail, takes its CRC from its bytes. Both give the same number, so the bucket totals are exact
whatever the head holds; it only decides how much is computed anew.

Totals are summed in every task over arrays of the size of the bucket space. Ranks come from a range
partitioning by score with the row counts of the partitions before, not from one sorted task.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlake.llm.common import NO_ID, staged, table, worker_state

BUCKETS = 10_000
MAX_RUN = 1                # words of a feature at most
MIN_WORDS = 20             # documents below are never drawn
DRAW_PERCENT = 10
SEED = 2024
HEAD_WORDS = 50_000        # frequent words whose state is broadcast
HEAD_PAIRS = 50_000        # frequent pairs whose bucket is broadcast
GROUPS = 64                # the head's words are chosen by groups of their hash
FLUSH = 1 << 20            # features counted at once
BLOCK = 1 << 22            # bytes of a text split at once

#: digits, lower-cased ASCII letters and every byte of a character beyond ASCII stay, the rest separates words
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text, by blocks so that a very long text is not held as one list."""
    data = (text or "").encode("utf-8", "surrogatepass")
    at = 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        block = data[at:end].translate(_WORDS)
        if end < len(data) and (cut := block.rfind(b" ")) >= 0:  # a word longer than the block: look on for its end
            block, end = block[:cut], at + cut + 1
        else:
            while end < len(data) and not block.endswith(b" "):
                more = data[end:end + BLOCK].translate(_WORDS)
                cut = more.find(b" ")
                block, end = block + (more if cut < 0 else more[:cut + 1]), end + (len(more) if cut < 0 else cut + 1)
        if found := block.split():
            yield found
        at = end


class Head(dict):
    """word → CRC-32 of its bytes; a word of the tail is computed when asked for, and not kept."""

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)


class Pairs(dict):
    """(word, word) → bucket of the pair, for frequent pairs; others go on from the state of their first word."""

    def __init__(self, pairs: dict, head: Head, buckets: int):
        super().__init__(pairs)
        self.head, self.buckets = head, buckets

    def __missing__(self, pair: tuple[bytes, bytes]) -> int:
        return zlib.crc32(b" " + pair[1], self.head[pair[0]]) % self.buckets


class Features:
    """Buckets of all runs of 1 to ``max_run`` words of a text."""

    def __init__(self, tag: str, head: dict[bytes, int], pairs: dict[tuple[bytes, bytes], int], max_run: int, buckets: int):
        self.tag, self.head, self.max_run, self.buckets = tag, Head(head), max_run, buckets
        self.pairs = Pairs(pairs, self.head, buckets)

    def of(self, text: str | None) -> Iterator[np.ndarray]:
        carry: list[bytes] = []
        for found in words(text):
            yield np.fromiter(map(self.head.__getitem__, found), np.uint32, len(found)) % np.uint32(self.buckets)
            if self.max_run > 1:
                yield from self._runs(carry, found)
                carry = (carry + found)[1 - self.max_run:]

    def _runs(self, carry: list[bytes], found: list[bytes]) -> Iterator[np.ndarray]:
        """Runs of two words and more that end in ``found``."""
        line, first = carry + found, len(carry)
        begin = max(first - 1, 0)
        yield np.fromiter(map(self.pairs.__getitem__, zip(line[begin:], line[begin + 1:])), np.int64, max(len(line) - begin - 1, 0))
        out = []
        for last in range(first, len(line)):
            for n in range(3, min(self.max_run, last + 1) + 1):
                state = self.head[line[last - n + 1]]
                for word in line[last - n + 2:last + 1]:
                    state = zlib.crc32(b" " + word, state)
                out.append(state % self.buckets)
        yield np.array(out, np.int64)


# ---- head vocabulary --------------------------------------------------------------------------


def _frequent(docs: DataFrame, run: int, keep: int) -> list[bytes]:
    """The most frequent words (``run`` 1) or pairs (2) of every hash group. A task keeps at most eight times ``keep`` candidates while it counts
    and passes on twice ``keep``, so nothing grows with the data; what is missed is served by the tail."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                before: list[bytes] = []
                for found in words(text):
                    line = before + found
                    seen.update(line if run == 1 else map(b" ".join, zip(line, line[1:])))
                    before = found[-1:] if run == 2 else []
                    if len(seen) > 8 * keep:
                        seen = Counter(dict(seen.most_common(4 * keep)))
        top = seen.most_common(2 * keep)
        if top:
            yield pd.DataFrame({"word": [w for w, _ in top], "n": [n for _, n in top]})

    counted = docs.select("text").mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # the first of each group, so that what the tasks send to the driver adds up to ``keep`` words
    groups = min(GROUPS, keep)
    best = Window.partitionBy(F.pmod(F.hash("word"), F.lit(groups))).orderBy(F.desc("n"), "word")
    return [bytes(r.word) for r in counted.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= keep // groups).collect()]


def head_vocabulary(docs: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS, head_words: int = HEAD_WORDS,
                    head_pairs: int = HEAD_PAIRS) -> tuple[dict[bytes, int], dict[tuple[bytes, bytes], int]]:
    """CRC states of the frequent words, and buckets of the frequent pairs if runs have two words."""
    head = {w: zlib.crc32(w) for w in (_frequent(docs, 1, head_words) if head_words else [])}
    pairs = {tuple(p.split(b" ")): zlib.crc32(p) % buckets
             for p in (_frequent(docs, 2, head_pairs) if max_run > 1 and head_pairs else [])}
    return head, pairs


# ---- counts, gains, weights -------------------------------------------------------------------


def bucket_totals(docs: DataFrame, features, buckets: int = BUCKETS) -> np.ndarray:
    """Features of every bucket over all ``docs``; ``features`` is a broadcast of ``Features`` arguments."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = worker_state(("resample", features.value[0]), lambda: Features(*features.value))
        total, waiting, held = np.zeros(buckets, np.int64), [], 0
        for pdf in batches:
            for text in pdf["text"]:
                for found in make.of(text):
                    waiting.append(found)
                    held += len(found)
                    if held >= FLUSH:
                        total += np.bincount(np.concatenate(waiting), minlength=buckets)
                        waiting, held = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=buckets)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": some, "n": total[some]})

    sums = docs.select("text").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # at most one row per bucket
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed share in the target over that in the source) per bucket."""
    size, s, t = len(source), source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size)))).astype(np.int64)


def weighed(docs: DataFrame, features, gain, max_run: int = MAX_RUN) -> DataFrame:
    """doc_id, n_words, n_features and weight (floored mean gain, 0 without features) per row."""

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = worker_state(("resample", features.value[0]), lambda: Features(*features.value))
        per_bucket = gain.value
        for pdf in batches:
            n_features, weight, n_words = [], [], []
            for text in pdf["text"]:
                n = total = 0
                for found in make.of(text):
                    n += len(found)
                    total += int(per_bucket[found].sum())
                n_features.append(n)
                weight.append(total // n if n else 0)
                n_words.append(n if max_run == 1 else sum(map(len, words(text))))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": n_words, "n_features": n_features, "weight": weight})

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")
    return rows.mapInPandas(weigh, "doc_id long, n_words long, n_features long, weight long").withColumn(
        "doc_id", F.when(F.col("doc_id") < NO_ID, F.col("doc_id")))


def gumbel(seed: int = SEED) -> Column:
    """floor(1000 × Gumbel noise) of a document, drawn from its id (no digits if it is null)."""
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(hexed, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(u))).cast("long")


def ranked(rows: DataFrame, by: list[Column]) -> DataFrame:
    """``rows`` plus ``rank`` 1, 2, 3 … in the order ``by``, without sorting all rows in one task.

    Equal rows become one with a count first (a partial aggregate), so no row can make a hot range. The
    ranges are numbered by the counts of those before them; one number per task reaches the driver.
    """
    spark, columns = rows.sparkSession, rows.columns
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = staged(rows.groupBy(*columns).agg(F.count("*").alias("_n")).repartitionByRange(tasks, *by)
                    .withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = sorted((r["_part"], r.n) for r in placed.groupBy("_part").agg(F.sum("_n").alias("n")).collect())
    before, offsets = 0, []
    for part, n in sizes:
        offsets.append((part, before))
        before += n
    order = Window.partitionBy("_part").orderBy(*by, *columns).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.sum("_n").over(order)
    first = F.broadcast(spark.createDataFrame(offsets, "_part int, _before long"))  # one row per task
    out = placed.withColumn("_upto", upto).join(first, "_part")
    return out.select(*columns, F.explode(F.sequence(F.col("_before") + F.col("_upto") - F.col("_n") + 1,
                                                     F.col("_before") + F.col("_upto"))).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, percent: int = DRAW_PERCENT, seed: int = SEED,
             head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """``docs`` (doc_id, text) and ``target`` (text) → doc_id, n_features, weight, score, rank per row of ``docs``.

    Of the N documents of at least ``min_words`` words, the floor(percent × N / 100) of highest score are
    drawn and ranked from 1, ties by smaller id (a null id last, then by the other columns); all
    others have a null rank. A null or empty text has no features and weight 0; repeated rows count and
    are ranked each; an empty target or corpus has totals of 0. Columns of other names are not read.
    """
    sc = docs.sparkSession.sparkContext
    features = sc.broadcast((uuid.uuid4().hex, *head_vocabulary(docs, max_run, buckets, head_words, head_pairs), max_run, buckets))
    gain = sc.broadcast(gains(bucket_totals(docs, features, buckets), bucket_totals(target, features, buckets)))
    scored = staged(weighed(docs, features, gain, max_run).withColumn("score", F.col("weight") + gumbel(seed)), "scores")
    long_enough = F.col("n_words") >= min_words
    drawn = scored.where(long_enough).count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    some = ranked(scored.where(long_enough).select(*columns), order).select(
        *columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return some.unionByName(scored.where(~long_enough).select(*columns, F.lit(None).cast("long").alias("rank")))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def words_sql(source: str) -> str:
    """DuckDB: one row per word of every text of ``source``, lower-cased in A-Z only."""
    return (f"select {'doc_id, ' if source == 'documents' else ''}unnest(regexp_extract_all(translate(coalesce(text, ''), "
            "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as w "
            f"from {source}")


#: SQL has no CRC-32, so its byte table is computed by rule; hashes are of distinct words
OP13_SQL = f"""
with steps as (select i, list_reduce([i::bigint] || range(8), lambda c, j:
                 case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from range(256) r(i)),
crc as (select list(v order by i) as v from steps),
doc_words as ({words_sql('documents')}),
test_words as ({words_sql('benchmark')}),
vocabulary as (select distinct w, hex(encode(w)) as h from (select w from doc_words union all select w from test_words)),
buckets as (
  select w, xor(list_reduce([4294967295::bigint] || list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint),
           lambda c, b: xor(c >> 8, v[xor(c & 255, b) + 1])), 4294967295) % {BUCKETS} as bucket from vocabulary, crc),
per_doc as (select doc_id, bucket, count(*) as n from doc_words join buckets using (w) group by all),
source as (select bucket, sum(n)::double as s from per_doc group by bucket),
target as (select bucket, count(*)::double as t from test_words join buckets using (w) group by bucket),
totals as (select (select coalesce(sum(s), 0) from source) as all_s, (select coalesce(sum(t), 0) from target) as all_t),
gains as (
  select source.bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (all_s + {BUCKETS}) / ((s + 1) * (all_t + {BUCKETS}))))::bigint as gain
  from source left join target using (bucket), totals),
weights as (select doc_id, sum(n)::bigint as n_features, sum(n * gain)::bigint as total from per_doc join gains using (bucket) group by doc_id),
scored as (
  select doc_id, coalesce(n_features, 0) as n_features,
         coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::bigint as weight,
         (('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double as u
  from documents left join weights using (doc_id)),
final as (select doc_id, n_features, weight, weight + floor(-1000 * ln(-ln(u)))::bigint as score from scored),
numbered as (select *, case when n_features >= {MIN_WORDS} then row_number() over (
               partition by n_features >= {MIN_WORDS} order by score desc, doc_id) end as place from final)
select doc_id, n_features, weight, score,
       case when place <= (select count(*) from final where n_features >= {MIN_WORDS}) * {DRAW_PERCENT} // 100 then place end as rank
from numbered"""
