"""Fill-in-middle transformation by secondary sort.

A text is cut into a prefix, a middle and a suffix of units (code points, or the matches of a
pattern), which are put in another order between the signs ``<P>``, ``<S>`` and ``<M>``. Every section is
cut into pieces of at most ``CHUNK`` units, and a piece is a record keyed by its document and its
place in the output. ``repartitionAndSortWithinPartitions`` deals the records by document and sorts
them by place, so a task reads each output from its first piece to its last and joins or digests
it as it goes; however long a text is, its task holds a piece. For the restoration the same stream is
cut at the signs, each piece gets its place in the original, and a second
``repartitionAndSortWithinPartitions`` sorts by that. Its partitioner is the same, so nothing is
shuffled again: the resort is a local sort, which spills.

A record's document is its id, the hash of its text, the input task and the number of equal rows before
it there. So repeated ids are spread, and a task that is run again after a loss deals the same
records whatever order its rows come in.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import table

CHUNK = 65_536             # units of a piece at most
TASK_BYTES = 64 << 20      # text that one task assembles
SEED = 1                   # text before the document's id in the hash that decides cuts and form
PLAIN_FROM = 90            # percent of documents cut up; the rest stay plain
SPM_BELOW = 20             # percent of those with the suffix first
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: the order of the sections in the output, and their rank in the original
ORDER = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
RANK = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}

OUTPUT_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
DIGEST_SCHEMA = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, "
                 "output_sha256 string, restored_sha256 string")


# ---- one document -----------------------------------------------------------------------------


def unit_ends(text: str, unit: str | None) -> list[int] | range:
    """Where each unit ends: code points, or the matches of ``unit`` (what stands between two matches
    belongs to the later one, what follows the last match to the last one)."""
    if unit is None:
        return range(1, len(text) + 1)
    ends = [m.end() for m in re.finditer(unit, text) if m.end() > m.start()]
    return ends[:-1] + [len(text)] if ends else ([len(text)] if text else [])


def decide(doc_id: int | None, text: str, n: int, seed: int = SEED, plain_from: int = PLAIN_FROM,
           spm_below: int = SPM_BELOW) -> tuple[str, int, int]:
    """Form, and the units before the end of prefix and middle (0 for plain)."""
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in RANK) or h3 % 100 >= plain_from:
        return PLAIN, 0, 0
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return (SPM if h4 % 100 < spm_below else PSM), a, b


def output_pieces(text: str, form: str, a: int, b: int, ends: list[int] | range, chunk: int) -> Iterator[str]:
    """The output in pieces of at most ``chunk`` units, each section's sign at the head of its first one."""
    n = len(ends)
    spans = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, n)}
    for sign, (lo, hi) in ([("", (0, n))] if form == PLAIN else [(s, spans[s]) for s in ORDER[form]]):
        head = sign
        for at in range(lo, max(hi, lo + 1), chunk):
            upto = min(at + chunk, hi)
            yield head + (text[ends[at - 1] if at else 0:ends[upto - 1]] if upto > at else "")
            head = ""


def sections(form: str, pieces: Iterable[str]) -> Iterator[tuple[int, str]]:
    """(rank in the original, text) of an output read piece by piece: the inverse of ``output_pieces`` from
    the output and its form alone. Signs are found wherever the pieces were cut."""
    if form == PLAIN:
        yield from ((0, p) for p in pieces)
        return
    signs, rank, rest = list(ORDER[form]), None, ""
    for piece in pieces:
        rest += piece
        while signs and (at := rest.find(signs[0])) >= 0:
            if rank is not None and at:
                yield rank, rest[:at]
            elif rank is None and at:
                raise ValueError(f"output of form {form} does not begin with {signs[0]}")
            rest, rank = rest[at + len(signs[0]):], RANK[signs.pop(0)]
        keep = len(signs[0]) - 1 if signs else 0
        if rank is not None and len(rest) > keep:
            yield rank, rest[:len(rest) - keep]
            rest = rest[len(rest) - keep:]
    if signs:
        raise ValueError(f"output of form {form} lacks {signs[0]}")
    if rest:
        yield rank, rest


# ---- secondary sort ---------------------------------------------------------------------------


def _by_document(key: tuple) -> int:
    return zlib.crc32(key[0])


def _sorted_by_place(records: RDD, tasks: int) -> RDD:
    """((document, rank, place), value) records dealt by document, sorted by key in each task."""
    return records.repartitionAndSortWithinPartitions(tasks, _by_document)


def _tasks(docs: DataFrame, column: str) -> int:
    """Tasks to deal the records to: adaptive execution does not size what is dealt by key outside a query, so
    the text's bytes are summed first."""
    size = docs.agg(F.sum(F.octet_length(F.col(column).cast("string")).cast("long"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))


def _documents(task: int, rows: Iterator) -> Iterator[tuple[bytes, int | None, tuple]]:
    """Each row (doc_id, text, …) with its document key."""
    seen: Counter = Counter()
    for doc_id, text, *more in rows:
        text = text or ""
        same = xxhash.xxh3_128_digest(f"{doc_id}:{more}:".encode() + text.encode("utf-8", "surrogatepass"))
        key = same + struct.pack(">II", task, seen[same])
        seen[same] += 1
        yield key, doc_id, (text, *more)


def output_records(docs: DataFrame, unit: str | None = None, chunk: int = CHUNK, **rule) -> RDD:
    """((document, 0, place), value): place 0 holds (doc_id, n, form, prefix units, middle units), the others the
    output's pieces."""

    def cut(task: int, rows: Iterator) -> Iterator[tuple[tuple, object]]:
        for key, doc_id, (text,) in _documents(task, rows):
            ends = unit_ends(text, unit)
            form, a, b = decide(doc_id, text, len(ends), **rule)
            whole = form == PLAIN
            yield (key, 0, 0), (doc_id, len(ends), form, None if whole else a, None if whole else b - a)
            for place, piece in enumerate(output_pieces(text, form, a, b, ends, chunk), 1):
                yield (key, 0, place), piece

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _sorted_by_place(rows.rdd.map(tuple).mapPartitionsWithIndex(cut), _tasks(docs, "text"))


def _each(records: Iterator, use: Callable) -> Iterator:
    """``use(key, head, pieces)`` for every document of a sorted task; pieces are read as they are asked for."""
    for key, group in groupby(records, lambda r: r[0][0]):
        _, head = next(group)
        yield from use(key, head, (value for _, value in group))


# ---- operator ---------------------------------------------------------------------------------


def fill_in_middle(docs: DataFrame, unit: str | None = None, chunk: int = CHUNK, **rule) -> DataFrame:
    """``docs`` (doc_id, text) → doc_id, n, form, prefix_chars, middle_chars and the ``output`` text per row.

    ``unit`` is a pattern (None: code points), ``rule`` may hold ``seed``, ``plain_from`` and ``spm_below``. A null or
    empty text is plain with n = 0 and an empty output; a null id counts as no digits; repeated rows
    give a row each; an empty table gives none. Columns besides doc_id and text are not read.
    """
    def joined(records: Iterator) -> Iterator[tuple]:
        return _each(records, lambda key, head, pieces: [(*head, "".join(pieces))])

    return docs.sparkSession.createDataFrame(output_records(docs, unit, chunk, **rule).mapPartitions(joined),
                                             OUTPUT_SCHEMA, verifySchema=False)


def restore(outputs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``outputs`` (doc_id, output, form) → doc_id and the original ``text``, from output and form alone."""
    def cut(task: int, rows: Iterator) -> Iterator[tuple[tuple, object]]:
        for key, doc_id, (output, form) in _documents(task, rows):
            yield (key, -1, 0), (doc_id,)
            parts = (output[at:at + chunk] for at in range(0, len(output), chunk))
            for place, (rank, piece) in enumerate(sections(form, parts)):
                yield (key, rank, place), piece

    def joined(records: Iterator) -> Iterator[tuple]:
        return _each(records, lambda key, head, pieces: [(*head, "".join(pieces))])

    rows = outputs.select(F.col("doc_id").cast("long"), "output", "form")
    records = _sorted_by_place(rows.rdd.map(tuple).mapPartitionsWithIndex(cut), _tasks(outputs, "output"))
    return outputs.sparkSession.createDataFrame(records.mapPartitions(joined), "doc_id long, text string", verifySchema=False)


def fill_in_middle_digests(docs: DataFrame, unit: str | None = None, chunk: int = CHUNK, **rule) -> DataFrame:
    """As ``fill_in_middle``, with the digests of output and restored text in place of the texts, in one job that
    never joins a text: pieces go from the output's order to the original's by a local resort."""

    def digested(records: Iterator) -> Iterator[tuple[tuple, object]]:
        def use(key: bytes, head: tuple, pieces: Iterator[str]) -> Iterator[tuple[tuple, object]]:
            digest = hashlib.sha256()

            def read() -> Iterator[str]:
                for piece in pieces:
                    digest.update(piece.encode("utf-8", "surrogatepass"))
                    yield piece

            for place, (rank, piece) in enumerate(sections(head[2], read())):
                yield (key, rank, place), piece
            yield (key, -1, 0), (*head, digest.hexdigest())

        return _each(records, use)

    def restored(records: Iterator) -> Iterator[tuple]:
        def use(key: bytes, head: tuple, pieces: Iterator[str]) -> list[tuple]:
            digest = hashlib.sha256()
            for piece in pieces:
                digest.update(piece.encode("utf-8", "surrogatepass"))
            return [(*head, digest.hexdigest())]

        return _each(records, use)

    outputs = output_records(docs, unit, chunk, **rule)
    again = _sorted_by_place(outputs.mapPartitions(digested, preservesPartitioning=True), outputs.getNumPartitions())
    return docs.sparkSession.createDataFrame(again.mapPartitions(restored), DIGEST_SCHEMA, verifySchema=False)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle_digests(table(spark, sf_dir, "documents"))


OP11_SQL = f"""
with hashed as (
  select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n,
         sha256('{SEED}:' || coalesce(doc_id::varchar, '')) as h from documents),
drawn as (
  select *, ('0x' || substr(h, 1, 8))::bigint % (n + 1) as c1, ('0x' || substr(h, 9, 8))::bigint % (n + 1) as c2,
         ('0x' || substr(h, 17, 8))::bigint % 100 as h3, ('0x' || substr(h, 25, 8))::bigint % 100 as h4 from hashed),
formed as (
  select *, least(c1, c2) as a, greatest(c1, c2) as b,
         case when n = 0 or contains(text, '{PREFIX}') or contains(text, '{SUFFIX}') or contains(text, '{MIDDLE}')
                   or h3 >= {PLAIN_FROM} then '{PLAIN}'
              when h4 < {SPM_BELOW} then '{SPM}' else '{PSM}' end as form from drawn),
parts as (
  select *, substr(text, 1, a) as p, substr(text, a + 1, b - a) as m, substr(text, b + 1, n - b) as s from formed)
select doc_id, n, form, case when form <> '{PLAIN}' then a end as prefix_chars,
       case when form <> '{PLAIN}' then b - a end as middle_chars,
       sha256(case form when '{PLAIN}' then text when '{PSM}' then '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
              else '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m end) as output_sha256,
       sha256(p || m || s) as restored_sha256
from parts"""
