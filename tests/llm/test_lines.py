"""Line dedup: oracle, brute force on edge cases, native plan."""

import hashlib

import pytest

from stationlake.llm import lines
from stationlake.llm.queries import oracle_sql
from tests.oracle_compare import compare, duck_connect

DIR = "/root/testdata/sf0.001"


def test_query_matches_oracle(spark):
    ok, n, _, detail = compare(spark, duck_connect(DIR), "op4", lines.op4_line_dedup, oracle_sql()["op4_line_dedup"], DIR)
    assert ok and n > 0, detail


def brute(rows, min_chars=10):
    ws = " \t\n\x0b\x0c\r"
    key = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s.strip(ws))
    split = [(i, (t or "").split("\n")) for i, t in rows]
    holders = {}
    for i, ls in split:
        for s in ls:
            if len(key(s)) >= min_chars:
                holders.setdefault(key(s), set()).add(i)
    out = []
    for i, ls in split:
        kept = [s for s in ls if not (len(holders.get(key(s), ())) > 1 and i > min(holders[key(s)]))]
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_edges_against_brute_force(spark):
    rows = [(3, "  Same LINE here\nown line of three\n\n"), (1, "same line here \t\nsame line here"), (2, None), (4, ""),
            (5, "short\nshort"), (6, "short"), (7, "ÄÖÜäöü ÉÉÉ"), (8, "äöüäöü ééé"), (9, "\n".join(f"line number {i}" for i in range(5000))),
            (10, "\n".join(f"line number {i}" for i in range(0, 5000, 2)) + "\nlast one stays"), (11, "x" * 300_000), (12, "X" * 300_000),
            (5, "again a line of five"), (13, "again a line of five\r"), (14, "a" * 10), (15, "b" * 9), (16, "a" * 10), (17, "b" * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS _d", "7 AS n_lines", "'p' AS key")
    got = lines.line_dedup(df)
    assert got.columns == ["doc_id", "text", "_d", "key", "n_lines", "n_dropped"]
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()) == brute(rows)


def test_repeated_and_unnamed_rows(spark):
    rows = [(1, "a line that repeats"), (1, "a line that repeats"), (None, "a line that repeats\nown"), (None, "own")]
    got = sorted((r.doc_id or 99, r.text) for r in lines.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, "a line that repeats"), (1, "a line that repeats"), (99, "own"), (99, "own")]


def test_empty_table_and_stage(spark):
    docs = spark.createDataFrame([(1, "a line of text", "en", "s", 14), (2, "A line of text", "en", "s", 14), (3, None, "en", "s", 0)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert lines.line_dedup(docs.limit(0)).count() == 0
    out = lines.stage(spark, docs, DIR)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == [(1, "a line of text", 14), (3, "", 0)]


def test_plan_is_native(spark):
    plan = lines.op4_line_dedup(spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("text", ["abc", ""])
def test_digest_is_of_the_kept_text(spark, tmp_path, text):
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert lines.op4_line_dedup(spark, str(tmp_path)).first().kept_sha256 == hashlib.sha256(text.encode()).hexdigest()
