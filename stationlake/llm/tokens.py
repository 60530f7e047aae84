"""Token-id output: directly addressable codes, in ascending document order.

Documents are range-partitioned by id, encoded, and written as *segments*: one row per segment in a
Parquet container that Spark writes, so the files land wherever the cluster's storage is. A
segment's ``data`` holds its ids as directly addressable codes: an id is split into chunks of
``CHUNK`` bits; level k keeps the k-th chunk of every id that has one, a bitmap telling which ids
go on to level k + 1, and a rank directory with the number of set bits before each block of
``BLOCK``. The position of an id at the next level is the rank of its bit, so any id, or any run of
ids, is read from a few bytes of each level without decoding what stands before it.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlake.llm.bpe import ChunkCache, byte_letters, encode_chunked, vocabulary_path
from stationlake.llm.common import NO_ID, doc_key, table, worker_state
from stationlake.session import shared_dir

CHUNK = 8                  # bits of an id kept at one level
BLOCK = 512                # bits covered by one entry of the rank directory
SEGMENT_TOKENS = 1 << 20   # a segment closes after the document that reaches this many ids
END_ID = 0
CACHE_WORDS = 1_600_000    # chunks remembered by one Python worker
RUN_CHARS = 10_000_000     # texts looked up at once
_MAGIC = 0x31434144        # "DAC1"

SEGMENT_SCHEMA = ("part int, seg int, part_start long, n_tokens long, doc_ids array<long>, "
                  "doc_starts array<long>, data binary")


# ---- codes ------------------------------------------------------------------------------------


def pack(ids: np.ndarray) -> bytes:
    """Unsigned 32-bit ids → one segment's bytes.

    Layout, little-endian: magic, number of levels; then for each level its number of chunks, the
    chunks (one byte each), the continuation bitmap and the rank directory (a 32-bit count per block).
    """
    rest = np.ascontiguousarray(ids, np.uint32)
    levels = []
    while len(rest) or not levels:
        more = rest >= (1 << CHUNK)
        bitmap = np.packbits(more, bitorder="little")
        per_block = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint32) if len(more) else more
        ranks = np.concatenate(([0], np.cumsum(per_block)))[:-1].astype("<u4") if len(more) else np.empty(0, "<u4")
        levels.append((len(rest), (rest & ((1 << CHUNK) - 1)).astype(np.uint8), bitmap, ranks))
        rest = rest[more] >> CHUNK
    out = [np.array([_MAGIC, len(levels)], "<u4").tobytes()]
    for n, chunks, bitmap, ranks in levels:
        out += [np.array([n], "<u4").tobytes(), chunks.tobytes(), bitmap.tobytes(), ranks.tobytes()]
    return b"".join(out)


class Codes:
    """Random access to the ids of one segment; nothing is decoded until asked for."""

    def __init__(self, data: bytes):
        head = np.frombuffer(data, "<u4", 2)
        if head[0] != _MAGIC:
            raise ValueError("not a token segment")
        at, self.levels = 8, []
        for _ in range(int(head[1])):
            n = int(np.frombuffer(data, "<u4", 1, at)[0])
            chunks = np.frombuffer(data, np.uint8, n, at + 4)
            bitmap = np.frombuffer(data, np.uint8, (n + 7) // 8, at + 4 + n)
            ranks = np.frombuffer(data, "<u4", -(-n // BLOCK), at + 4 + n + len(bitmap))
            at += 4 + n + len(bitmap) + ranks.nbytes
            self.levels.append((chunks, bitmap, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, level: int, i: int) -> int:
        """Ids of ``level`` before position ``i`` that go on to the next level."""
        chunks, bitmap, ranks = self.levels[level]
        if i >= len(chunks):
            return len(self.levels[level + 1][0]) if level + 1 < len(self.levels) else 0
        block = i // BLOCK
        first = block * BLOCK
        bits = np.unpackbits(bitmap[first // 8:(i + 7) // 8], bitorder="little")
        return int(ranks[block]) + int(bits[:i - first].sum())

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            value |= int(chunks[i]) << (CHUNK * level)
            if not bitmap[i // 8] >> (i % 8) & 1:
                break
            i = self._rank(level, i)
        return value

    def run(self, start: int, stop: int, level: int = 0) -> np.ndarray:
        """Ids ``start`` to ``stop``: the ids of a run that go on are a run at the next level too."""
        chunks, bitmap, _ = self.levels[level]
        out = chunks[start:stop].astype(np.uint32)
        if level + 1 < len(self.levels) and stop > start:
            bits = np.unpackbits(bitmap[start // 8:(stop + 7) // 8], bitorder="little")
            more = bits[start % 8:start % 8 + stop - start].astype(bool)
            first = self._rank(level, start)
            out[more] |= self.run(first, first + int(more.sum()), level + 1) << np.uint32(CHUNK)
        return out


# ---- writing ----------------------------------------------------------------------------------


class LibraryEncoder:
    """The tokenizers library over one vocabulary file, once per worker.

    Ids of a whole text are those of its chunks (see ``bpe``), so the library encodes each distinct
    chunk once and remembers it up to a bound. Chunks that start with a space are handed to it
    joined together, which is a text whose chunks they are, and cut apart again by the byte lengths
    of the tokens.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.cache = ChunkCache(self._fill, CACHE_WORDS, RUN_CHARS)
        letters = byte_letters()
        self.special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        self.width = np.zeros(self.tok.get_vocab_size(with_added_tokens=True), np.int64)
        for t, i in self.tok.get_vocab(with_added_tokens=True).items():
            self.width[i] = len(t.encode()) if t in self.special else sum(c in letters for c in t)
        marks = {t[0] for t in self.special if t}
        self.mark = re.compile("[{0}]".format("".join(map(re.escape, sorted(marks))))) if marks else None

    def _fill(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joint = [i for i, c in enumerate(chunks) if len(c) > 1 and c[0] == " " and not c[-1].isspace()
                 and not (self.mark and self.mark.search(c))]
        length = np.zeros(len(chunks), np.int64)
        parts: list[np.ndarray] = []
        for at in range(0, len(joint), 20_000):
            some = [chunks[i] for i in joint[at:at + 20_000]]
            ids = np.array(self.tok.encode("".join(some), add_special_tokens=False).ids, np.uint32)
            sizes = np.fromiter((len(c.encode()) for c in some), np.int64, len(some))
            last = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(sizes)) + 1
            length[joint[at:at + 20_000]] = np.diff(last, prepend=0)
            parts.append(ids)
        alone = np.ones(len(chunks), bool)
        alone[joint] = False
        alone = np.flatnonzero(alone).tolist()
        coded = self.tok.encode_batch_fast([chunks[i] for i in alone], add_special_tokens=False) if alone else []
        for i, e in zip(alone, coded):
            parts.append(np.array(e.ids, np.uint32))
            length[i] = len(e.ids)
        # back into the order of the chunks
        order = np.array(joint + alone, np.int64)
        begin = np.empty(len(chunks), np.int64)
        begin[order] = np.cumsum(length[order]) - length[order]
        ends = np.cumsum(length)
        flat = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        return flat[np.repeat(begin - ends + length, length) + np.arange(len(flat))], length

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of every whole text (null: none)."""
        return encode_chunked(texts, self.cache)


def library_ids(texts: list[str | None], path: str) -> Iterator[np.ndarray]:
    """Ids of every whole text, by this worker's encoder."""
    return worker_state(("library", path), lambda: LibraryEncoder(path)).encode(texts)


def write_tokens(docs: DataFrame, out: str, path: str | None = None, segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Write the ids of every document of ``docs`` (doc_id, text; other columns are ignored) to ``out``.

    Null texts count as empty; each document's ids end with id 0. Documents are in ascending order
    of id (rows of one id by their text's hash, rows without an id last).
    """
    path = path or vocabulary_path()
    end = np.array([END_ID], np.uint32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seg, part_start, ids, starts, coded, size = 0, 0, [], [], [], 0

        def segment() -> pd.DataFrame:
            return pd.DataFrame({"part": [part], "seg": [seg], "part_start": [part_start], "n_tokens": [size],
                                 "doc_ids": [ids], "doc_starts": [starts],
                                 "data": [pack(np.concatenate(coded))]})

        for pdf in batches:
            for doc, coded_text in zip(pdf["_d"].tolist(), library_ids(pdf["text"].tolist(), path)):
                ids.append(doc)
                starts.append(size)
                coded += [coded_text, end]
                size += len(coded_text) + 1
                if size >= segment_tokens:
                    yield segment()
                    seg, part_start, ids, starts, coded, size = seg + 1, part_start + size, [], [], [], 0
        if ids:
            yield segment()

    ordered = (docs.select(doc_key().alias("_d"), "text").withColumn("_h", F.xxhash64("text"))
               .repartitionByRange("_d", "_h").sortWithinPartitions("_d", "_h").select("_d", "text"))
    ordered.mapInPandas(run, SEGMENT_SCHEMA).write.option("compression", "uncompressed").parquet(out)


# ---- reading ----------------------------------------------------------------------------------


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The segments written to ``path``."""
    return spark.read.schema(SEGMENT_SCHEMA).parquet(path)


def document_digests(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                part, first, docs, at, data = (c[i] for c in batch.columns)
                codes = Codes(data.as_buffer())
                starts = np.append(at.values.to_numpy(), len(codes))
                ids = codes.run(0, len(codes)).astype("<u4")  # every document of the segment is wanted
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), starts[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(crc), part.as_py(), np.int32)), docs.values, pa.array(first.as_py() + starts[:-1]),
                     pa.array(np.diff(starts)), pa.array(crc, pa.int64())],
                    names=["part", "doc_id", "at", "n_tokens", "ids_crc32"])

    docs = segments.select("part", "part_start", "doc_ids", "doc_starts", "data").mapInArrow(
        run, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    # one row per write task: what stands before it is a running sum over that short table
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return docs.join(base, "part").select(
        F.when(F.col("doc_id") < NO_ID, F.col("doc_id")).alias("doc_id"),
        (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{shared_dir(spark, 'tokens')}/ids"
    write_tokens(table(spark, sf_dir, "documents"), out)
    return document_digests(read_tokens(spark, out))
