"""Line dedup: drop lines that other documents hold as well, keeping the first document's copy.

Lines are exploded, normalised and hashed to 128 bits; documents per hash are counted by their
smallest and largest id (a partial aggregate, so a line in a third of all documents costs each task
one row); the positions to drop come from a join on the hash, which adaptive execution splits where
one line is hot; and each text is reassembled from the slices between its dropped positions.
Only hashes, ids and positions are shuffled by line; the text moves once, by document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import doc_key, staged, table

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: F.Column) -> F.Column:
    """ASCII white space stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _lines() -> F.Column:
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)


def _text_hash() -> F.Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def line_dedup(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """All columns of ``docs`` with ``text`` deduplicated, plus ``n_lines`` and ``n_dropped``.

    A line whose key has at least ``min_chars`` code points and occurs in two or more documents
    stays only in the document of smallest id (there with all its repeats). Null and empty texts
    are one empty line (a null text becomes the empty text). Rows sharing a ``doc_id`` are one
    document; rows with a null ``doc_id`` are together the last document. Columns of any other name
    pass through; ``n_lines`` and ``n_dropped`` replace columns of those names.
    """
    docs = docs.drop("n_lines", "n_dropped")
    # the operator's own columns carry a prefix so that no column of the input can clash
    exploded = docs.select(doc_key().alias("_d"), _text_hash().alias("_t"), F.posexplode(_lines()).alias("_pos", "_line"))
    key = line_key(F.col("_line"))
    hashed = staged(exploded.withColumn("_key", key).where(F.char_length("_key") >= min_chars).select(
        "_d", "_t", "_pos", F.xxhash64(F.lit(0), "_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2")),
        "line-hashes")
    repeated = staged(hashed.groupBy("_h1", "_h2").agg(F.min("_d").alias("_first"), F.max("_d").alias("_last"))
                      .where(F.col("_first") < F.col("_last")).select("_h1", "_h2", "_first"), "repeated-lines")
    drops = (hashed.join(repeated, ["_h1", "_h2"]).where(F.col("_d") > F.col("_first"))
             .groupBy("_d", "_t").agg(F.array_sort(F.collect_set("_pos")).alias("_drop")))
    none = F.array().cast("array<int>")
    # built from the positions (4 bytes a line at most), so the texts stream past and are not sorted
    out = (docs.withColumns({"_d": doc_key(), "_t": _text_hash()}).join(drops.hint("shuffle_hash"), ["_d", "_t"], "left")
           .withColumn("_drop", F.coalesce("_drop", none)).withColumn("_all", _lines())
           .withColumn("_cut", F.concat(F.array(F.lit(-1)), F.col("_drop"), F.array(F.size("_all")))))
    # slices between neighbouring dropped positions: linear in the number of lines
    kept = F.expr("flatten(transform(sequence(1, size(_cut) - 1), "
                  "i -> slice(_all, _cut[i - 1] + 2, _cut[i] - _cut[i - 1] - 1)))")
    cols = [F.array_join(kept, "\n").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*cols, F.size("_all").cast("long").alias("n_lines"), F.size("_drop").cast("long").alias("n_dropped"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents with their repeated lines removed; a document that loses every
    line (nothing of its own is left) goes."""
    out = line_dedup(docs)
    gone = (F.col("n_dropped") > 0) & (F.col("n_dropped") == F.col("n_lines"))
    res = out.where(~gone)
    if "n_chars" in docs.columns:
        res = res.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return res.select(*docs.columns)


_KEY = ("translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), "
        f"'{UPPER}', '{LOWER}')")


def lines_sql(source: str, min_chars: int = 10) -> str:
    """DuckDB: one row per document of ``source`` (doc_id, text) with its kept lines joined."""
    return f"""
    with split_lines as (
      select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from {source}),
    keyed as (select *, {_KEY} as key from split_lines),
    repeated as (select key, min(doc_id) as first_id from keyed where length(key) >= {min_chars}
                 group by key having count(distinct doc_id) > 1),
    marked as (select k.*, r.key is not null and k.doc_id > r.first_id as gone
               from keyed k left join repeated r on k.key = r.key)
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
           coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '') as kept
    from marked group by doc_id"""


OP4_SQL = f"select doc_id, n_lines, n_dropped, sha256(kept) as kept_sha256 from ({lines_sql('documents')})"
