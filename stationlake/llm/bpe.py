r"""BPE encoding and decoding by a prefix-sharing trie traversal.

A byte string's encoding ends in exactly one token, and what stands before that token is the
encoding of the prefix it leaves (adjacent tokens of an encoding are pairs that merging the two
strings would give back). So the *last token* of every prefix is enough to write any encoding down
from its end. The distinct words of a batch are inserted into a trie (kept as the sorted words with
their common prefix lengths, which is its depth-first order); the traversal carries the last-token
state of the current path, so a prefix that many words share is computed once.

Texts are cut by the vocabulary's pattern into pieces, which are encoded on their own. Cutting first
before every space that follows a non-space character changes no piece (a piece holds such a space
only as its first character), so whole chunks between spaces serve as cache keys.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from stationlake.llm.common import table, worker_state

VOCABULARY = "byte_bpe_50k.json"
CACHE_WORDS = 700_000      # chunks remembered by one Python worker
CACHE_BYTES = 64 << 20     # and their bytes
KNOWN_PAIRS = 250_000      # token pairs remembered
SIGNS = 10_000             # runs of signs remembered
RUN_CHARS = 6_000_000      # texts looked up at once

#: cut before a space that follows a non-space character
_CHUNK = re.compile(r"(?<=\S)(?= )")
_RAGGED = re.compile(r"\s ")
#: a word and the signs after it
_WORD_SIGNS = r"^(?P<word>\pL+)(?P<signs>[\pP\pS]+)$"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary file → the byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TrieEncoder:
    """Encoder and decoder over one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        import public_tokenizers

        letters = byte_letters()
        to_bytes = lambda s: bytes(letters[c] for c in s)
        vocab = {to_bytes(t): i for t, i in spec["model"]["vocab"].items()
                 if t not in {a["content"] for a in spec["added_tokens"]}}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.id_of = vocab
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.bytes_of = {i: b for b, i in vocab.items()} | {i: t.encode() for t, i in self.added.items()}
        self.rank = {}
        for n, (a, b) in enumerate(merges):
            self.rank.setdefault((vocab[to_bytes(a)], vocab[to_bytes(b)]), (n, vocab[to_bytes(a + b)]))
        self.longest = max(map(len, vocab))
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.split_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.single = [vocab[bytes([b])] for b in range(256)]
        self.pairs: dict[int, bool] = {}             # left token << 20 | right token → compatible
        self.whole = bytearray(max(vocab.values()) + 1)  # 0 unknown, 1 the encoding of its own bytes, 2 not
        self.cache = ChunkCache(self._chunk_ids)

    def _merge(self, tokens: list[int]) -> list[int]:
        """Plain merging by rank, lowest first, leftmost first."""
        rank = self.rank
        while len(tokens) > 1:
            best = min((rank.get(p, (1 << 30,))[0], i) for i, p in enumerate(zip(tokens, tokens[1:])))
            if best[0] == 1 << 30:
                break
            i = best[1]
            tokens[i:i + 2] = [rank[tokens[i], tokens[i + 1]][1]]
        return tokens

    def _compatible(self, a: int, b: int) -> bool:
        """Whether merging the joint bytes of two tokens gives back just these two."""
        if len(self.pairs) > KNOWN_PAIRS:
            self.pairs.clear()
        got = self._merge([self.single[x] for x in self.bytes_of[a] + self.bytes_of[b]]) == [a, b]
        self.pairs[a << 20 | b] = got
        return got

    def _is_whole(self, token: int) -> bool:
        """Whether the token is the encoding of its own bytes."""
        if not self.whole[token]:
            self.whole[token] = 1 if self._merge([self.single[x] for x in self.bytes_of[token]]) == [token] else 2
        return self.whole[token] == 1

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Depth-first over the trie of ``words``: each node adds its last token, from its parents'."""
        out: dict[bytes, list[int]] = {}
        last: list[int] = []          # last[i]: last token of the first i + 1 bytes of the path
        path = b""
        id_of, pair, longest = self.id_of.get, self.pairs.get, self.longest
        for word in sorted(words):
            shared = 0
            for x, y in zip(path, word):
                if x != y:
                    break
                shared += 1
            del last[shared:]
            for end in range(shared + 1, len(word) + 1):
                for start in range(max(0, end - longest), end):
                    token = id_of(word[start:end])
                    if token is None:
                        continue
                    if start == 0:
                        fits = self._is_whole(token)
                    else:
                        fits = pair(last[start - 1] << 20 | token)
                        if fits is None:
                            fits = self._compatible(last[start - 1], token)
                    if fits:
                        last.append(token)
                        break
            path = word
            ids, end, of = [], len(word), self.bytes_of
            while end:
                token = last[end - 1]
                ids.append(token)
                end -= len(of[token])
            out[word] = ids[::-1]
        return out

    # ---- texts ----

    def _chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new chunks, one after the other, and their numbers: the distinct pieces go through one trie."""
        cuts: list[list] = []
        todo: set[bytes] = set()
        for c in chunks:
            if self.split_added is not None and "<" in c and self.split_added.search(c):
                cut = []
                for p in filter(None, self.split_added.split(c)):
                    cut += [self.added[p]] if p in self.added else [w.encode() for w in self.pattern.findall(p)]
                todo.update(w for w in cut if isinstance(w, bytes))
            else:
                cut = [w.encode() for w in self.pattern.findall(c)]
                todo.update(cut)
            cuts.append(cut)
        known = self.encode_words(todo)
        known.update((i, [i]) for i in self.added.values())
        ids = [[t for p in cut for t in known[p]] for cut in cuts]
        return np.array([t for x in ids for t in x], np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of every text (null: none)."""
        return list(encode_chunked(texts, self.cache))

    def decode(self, ids: np.ndarray) -> str:
        of = self.bytes_of
        return b"".join([of[i] for i in ids.tolist()]).decode("utf-8", "replace")


class ChunkCache:
    """Chunk → ids, for one worker: an Arrow array of keys and, in step, where their ids lie in a pool.

    ``fill`` takes a list of chunks and returns their ids one after the other and the number of each.
    """

    def __init__(self, fill, words: int = CACHE_WORDS, run_chars: int = RUN_CHARS):
        self.fill, self.words, self.run_chars = fill, words, run_chars
        self.forget()

    def forget(self) -> None:
        self.keys = pa.array([], pa.large_string())
        self.begin, self.length, self.pool = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.uint32)
        self.signs: dict[str, np.ndarray] = {}

    def lookup(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of each distinct key, the chunk after its leading space: a pool, where they begin in it, how many.

        A word followed by signs is two pieces whatever they are, so it is looked up as two.
        """
        parts = pc.extract_regex(keys, _WORD_SIGNS)
        two = parts.is_valid()
        words = pc.if_else(two, pc.struct_field(parts, 0), keys).dictionary_encode()
        begin, length = self._words(words.dictionary)
        of_word = words.indices.to_numpy()
        signs = pc.struct_field(parts, 1).dictionary_encode()
        tails = [self._signs(s) for s in signs.dictionary.to_pylist()]
        tail_length = np.array([0, *map(len, tails)])
        tail_begin = len(self.pool) + np.cumsum(tail_length) - tail_length
        of_tail = signs.indices.fill_null(-1).to_numpy() + 1
        pool = np.concatenate([self.pool, *tails]) if tails else self.pool
        runs = np.stack([length[of_word], tail_length[of_tail]], 1).ravel()
        joint = gather(pool, np.stack([begin[of_word], tail_begin[of_tail]], 1).ravel(), runs)
        total = runs[::2] + runs[1::2]
        return joint, np.cumsum(total) - total, total

    def _signs(self, signs: str) -> np.ndarray:
        got = self.signs.get(signs)
        if got is None:
            got = self.fill([signs])[0]
            if len(self.signs) < SIGNS and len(signs) < 32:
                self.signs[signs] = got
        return got

    def _words(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each distinct key lie in ``self.pool``."""
        at = pc.index_in(keys, value_set=self.keys)
        known = at.is_valid().to_numpy(zero_copy_only=False)
        new = keys.filter(pa.array(~known))
        ids, length = self.fill([" " + k for k in new.to_pylist()])
        at = at.fill_null(-1).to_numpy().astype(np.int64)
        if len(self.keys) + len(new) > self.words or self.keys.nbytes > CACHE_BYTES:
            # only what this run uses again is kept
            used = np.sort(at[known])
            at[known] = np.searchsorted(used, at[known])
            self.pool = gather(self.pool, self.begin[used], self.length[used])
            self.keys, self.length = self.keys.take(pa.array(used)), self.length[used]
            self.begin = np.cumsum(self.length, dtype=np.int64) - self.length
        at[~known] = len(self.keys) + np.arange(len(new))
        self.begin = np.concatenate([self.begin, len(self.pool) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length.astype(np.int32)])
        self.pool = np.concatenate([self.pool, ids])
        self.keys = pa.concat_arrays([self.keys, new])
        return self.begin[at], self.length[at]


def gather(pool: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs of ``pool`` that start at ``begin``, one after the other."""
    ends = np.cumsum(length, dtype=np.int64)
    return pool[np.repeat(begin - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)]


def encode_chunked(texts: list[str | None], cache: ChunkCache) -> Iterator[np.ndarray]:
    """Ids (unsigned 32-bit) of each text, in order.

    Runs of texts of bounded size are cut and their distinct chunks numbered by Arrow; each
    distinct chunk is looked up once a run, and the ids are gathered by its number.
    """
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and size < cache.run_chars:
            size += len(texts[stop] or "")
            stop += 1
        yield from _encode_run([t or "" for t in texts[at:stop]], cache)
        pa.default_memory_pool().release_unused()
        at = stop


def _encode_run(texts: list[str], cache: ChunkCache) -> Iterator[np.ndarray]:
    # every chunk but a text's first starts with a space, which is left out of its key
    ragged = {i: [c[1:] if k else c for k, c in enumerate(_CHUNK.split(t))] for i, t in enumerate(texts) if _RAGGED.search(t)}
    even = [i for i in range(len(texts)) if i not in ragged]
    cut = pc.split_pattern(pa.array([texts[i] for i in even], pa.large_string()), " ")
    parts = [cut.flatten(), *[pa.array(c, pa.large_string()) for c in ragged.values()]]
    counts = np.concatenate([np.diff(cut.offsets.to_numpy()), [len(c) for c in ragged.values()]]).astype(np.int64)
    coded = pa.concat_arrays(parts).dictionary_encode()
    number = coded.indices.to_numpy()
    starts = np.cumsum(counts) - counts
    first = pa.DictionaryArray.from_arrays(pa.array(number[starts]), coded.dictionary).cast(pa.large_string())
    first_ids, first_length = cache.fill(first.to_pylist())
    first_begin = np.cumsum(first_length) - first_length
    pool, begin, length = cache.lookup(coded.dictionary)
    out: list[np.ndarray] = [np.empty(0)] * len(texts)
    for k, i in enumerate([*even, *ragged]):
        rest = number[starts[k] + 1:starts[k] + counts[k]]
        head = first_ids[first_begin[k]:first_begin[k] + first_length[k]]
        out[i] = np.concatenate([head, gather(pool, begin[rest], length[rest])]) if len(rest) else head
    yield from out


def encoder(path: str) -> TrieEncoder:
    """One encoder per Python worker."""
    return worker_state(("bpe", path), lambda: TrieEncoder(path))


def encode_documents(docs: DataFrame, path: str | None = None, decode: bool = True) -> DataFrame:
    """``docs`` plus ``ids`` (binary, little-endian unsigned 32-bit) and, on request, ``decoded``.

    Null texts count as empty: no ids, empty decoded text. The added columns replace columns of the
    same names; all others pass through.
    """
    path = path or vocabulary_path()
    keep = [c for c in docs.columns if c not in ("ids", "decoded")]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in batches:
            ids = enc.encode(pdf["text"].tolist())
            pdf = pdf.assign(ids=[x.tobytes() for x in ids])
            yield pdf.assign(decoded=[enc.decode(x) for x in ids]) if decode else pdf

    return docs.select(*[f"`{c}`" for c in keep]).mapInPandas(run, f"{schema}, ids binary" + ", decoded string" * decode)


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, digested inside the task that encodes it."""
    path = path or vocabulary_path()
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in batches:
            ids = enc.encode(pdf["text"].tolist())
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"], "n_tokens": [len(x) for x in ids],
                "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(enc.decode(x).encode()).hexdigest() for x in ids]})

    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: every document with its token digests."""
    digests = token_digests(docs)
    return digests.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
