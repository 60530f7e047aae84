"""The corpus pipeline: documents in, clean and encoded documents out.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the last one
returns token counts and digests. Stage results are written to the shared folder and reread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationlake.llm import bpe, decontam, langid, lines, simhash
from stationlake.llm.common import staged, table

STAGES = [
    ("language_id", langid.stage),
    ("line_dedup", lines.stage),
    ("simhash_near_dedup", simhash.stage),
    ("decontamination", decontam.stage),
    ("bpe_encoding", bpe.stage),
]

#: SQL has neither the hash of the fingerprints nor the vocabulary; tests/llm/test_pipeline.py has a brute-force run
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in order over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
