"""The pipeline against the stages' brute-force versions, one after the other."""

import hashlib

import numpy as np

import corpus_pipeline
from stationlake.llm import bpe
from tests.llm import test_decontam, test_lines, test_simhash

DIR = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    from tokenizers import Tokenizer

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    docs = [(i, t) for i, t in docs if any(c.isalpha() for c in t or "")]
    docs = [(i, kept) for i, n, dropped, kept in test_lines.brute(docs) if dropped < n]
    groups = test_simhash.brute_components([i for i, _ in docs], [test_simhash.brute_fingerprint(t) for _, t in docs])
    docs = [(i, t) for i, t in docs if groups[i] == i]
    leaks = {d for d, _ in test_decontam.brute(docs, bench)}
    lib = Tokenizer.from_file(bpe.vocabulary_path())
    want = {}
    for i, t in docs:
        if i not in leaks:
            ids = lib.encode(t, add_special_tokens=False).ids
            want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, DIR).collect()}
    assert got == want and 100 < len(got) < 200


def test_stages_keep_the_columns_and_stand_empty_tables(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, DIR)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, DIR).count() == 0


def test_stages_with_null_and_odd_rows(spark):
    rows = [(None, "some words of a text without id", "en", None, None), (1, None, None, None, None), (2, "", None, "s", 0),
            (3, "the same " * 200_000, "en", "s", 1), (4, "the same text twice here", "en", "s", 1), (4, "the same text twice here", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, DIR), "odd")
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens) for r in docs.collect() if r.doc_id is not None)
    assert [g[1] for g in got] == [3, 4, 4]
    assert sum(r.doc_id is None for r in docs.collect()) == 1
