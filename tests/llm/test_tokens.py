"""Token output and BPE against the tokenizers library."""

import hashlib
import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlake.llm import bpe, tokens
from stationlake.session import shared_dir

os.environ["TOKENIZERS_PARALLELISM"] = "false"
DIR = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a  b", "  x", "\n \n x", "hello<|endoftext|> there  <|endoftext|>", "don't it's 'S  \t\n 123 4567,,, .. x  y",
       "日本語のテキスト 漢字", "\x1c x \x85 y", "😀😀 é", " leading", "trailing ", "x\x1f\x1f y", "two\n\n\nthree   \n",
       "=" * 700, "ab" * 5000, "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path())


def test_query_op2_against_library(spark, library):
    rows = sorted(spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect())
    want, at = {}, 0
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        want[r.doc_id] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokens.op2_token_output(spark, DIR).collect()}
    assert got == want


def test_query_op6_against_library(spark, library):
    rows = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in bpe.op6_bpe(spark, DIR).collect()}
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                 hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(library, text):
    enc = bpe.encoder(bpe.vocabulary_path())
    ids = library.encode(text or "", add_special_tokens=False).ids
    mine = enc.encode([text])[0]
    assert mine.tolist() == ids
    assert enc.decode(mine) == library.decode(ids, skip_special_tokens=False)
    assert next(tokens.library_ids([text], bpe.vocabulary_path())).tolist() == ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sabcTHEing.,!1"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    from tokenizers import Tokenizer

    lib = test_any_text.__dict__.setdefault("lib", Tokenizer.from_file(bpe.vocabulary_path()))
    assert bpe.encoder(bpe.vocabulary_path()).encode([text])[0].tolist() == lib.encode(text, add_special_tokens=False).ids


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
@settings(max_examples=60, deadline=None)
def test_codes_round_trip_and_random_access(ids):
    codes = tokens.Codes(tokens.pack(np.array(ids, np.uint32)))
    assert len(codes) == len(ids)
    assert codes.run(0, len(ids)).tolist() == ids
    for i in range(0, len(ids), 97):
        assert codes[i] == ids[i]
        assert codes.run(i, min(len(ids), i + 50)).tolist() == ids[i:i + 50]


def test_segments_edges(spark, library):
    rows = [(9, "b c"), (2, None), (2, "a"), (2, "a"), (None, "z"), (-5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS part", "'x' AS data")
    out = f"{shared_dir(spark, 'tok')}/t"
    tokens.write_tokens(df, out, segment_tokens=3)
    got = tokens.document_digests(tokens.read_tokens(spark, out)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [-5, 2, 2, 2, 9, None]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert got[0].n_tokens == 1 and got[0].ids_crc32 == zlib.crc32(bytes(4))
    empty = f"{shared_dir(spark, 'tok')}/e"
    tokens.write_tokens(df.limit(0), empty)
    assert tokens.document_digests(tokens.read_tokens(spark, empty)).count() == 0


def test_bpe_operator_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "a b", "old"), (None, None, "old")], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.encode_documents(df).collect()}
    assert got[1].decoded == "a b" and got[None].decoded == "" and got[None].ids == b""
    assert np.frombuffer(got[1].ids, "<u4").tolist() == [64, 275]
    assert bpe.encode_documents(df.limit(0)).count() == 0
