"""Fill-in-middle: brute force, round trips, edges, no second shuffle."""

import hashlib
import random

import pytest

from stationlake.llm import fim
from stationlake.llm.queries import oracle_sql
from tests.oracle_compare import compare, duck_connect

DIR = "/root/testdata/sf0.001"


def brute(doc_id, text, units=None):
    text = text or ""
    units = list(text) if units is None else units(text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


ROWS = [(None, "a text without an id"), (None, "a text without an id"), (None, None), (1, None), (2, ""), (3, "x"), (4, "two"),
        (5, "the sign <M> is in here"), (6, "<P"), (7, "ends with <S"), (8, "<<P <S P> >M>" * 9), (9, "é𝄞👩‍👩‍👧 combining é \u0000 \r\n"),
        (10, "long " * 100_000), (11, "line\n" * 50), (11, "line\n" * 50), (11, "another text of this id"),
        *[(i, "some words of document number %d" % i) for i in range(20, 140)]]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, output string, n int")


def key(r):
    return tuple((v is None, v) for v in r)


@pytest.mark.parametrize("chunk", [1 << 16, 7, 1])
def test_texts_and_round_trip(spark, chunk):
    rows = [(i, t) for i, t in ROWS if chunk > 7 or len(t or "") < 400]
    out = fim.fill_in_middle(frame(spark, rows), chunk=chunk)
    got = sorted((tuple(r) for r in out.collect()), key=key)
    assert got == sorted((brute(*r) for r in rows), key=key)
    back = sorted((tuple(r) for r in fim.restore(out, chunk=chunk).collect()), key=key)
    assert back == sorted(((i, t or "") for i, t in rows), key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_digests_equal_those_of_the_texts(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(*brute(*r)[:5], sha(brute(*r)[5]), sha(r[1] or "")) for r in ROWS]
    for chunk in (1 << 16, 1000):
        got = [tuple(r) for r in fim.fill_in_middle_digests(frame(spark, ROWS), chunk=chunk).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)
    assert fim.fill_in_middle_digests(frame(spark, ROWS).limit(0)).count() == 0


def test_other_units_and_rule(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i)) + "\n") for i in range(1, 60)]
    words = r"\S+\s*"
    out = fim.fill_in_middle(frame(spark, rows), unit=words, chunk=3, plain_from=100, spm_below=50)
    import re

    for r in out.collect():
        units = re.findall(words, dict(rows)[r.doc_id])
        assert r.n == len(units) and r.form in ("psm", "spm")
        at = {s: r.output.index(s) for s in ("<P>", "<M>")}
        middle = r.output[at["<M>"] + 3:]
        prefix = r.output[at["<P>"] + 3:r.output.index("<S>")] if r.form == "psm" else r.output[at["<P>"] + 3:at["<M>"]]
        assert prefix == "".join(units[:r.prefix_chars]) and middle == "".join(units[r.prefix_chars:r.prefix_chars + r.middle_chars])
    assert {tuple(r) for r in fim.restore(out).collect()} == set(rows)


def test_signs_are_found_across_pieces():
    rng = random.Random(5)
    for _ in range(300):
        p, m, s = ("".join(rng.choice("<PSM>ab") for _ in range(rng.randrange(6))) for _ in range(3))
        if any(x in p + m + s for x in ("<P>", "<S>", "<M>")):
            continue
        for form, output in (("psm", f"<P>{p}<S>{s}<M>{m}"), ("spm", f"<S>{s}<P>{p}<M>{m}")):
            if any(output.count(x) != 1 for x in ("<P>", "<S>", "<M>")):
                continue  # a section's end and the sign after it make another sign
            cut = sorted(rng.randrange(len(output) + 1) for _ in range(4))
            pieces = [output[a:b] for a, b in zip([0, *cut], [*cut, len(output)])]
            got = {0: "", 1: "", 2: ""}
            for rank, text in fim.sections(form, pieces):
                got[rank] += text
            assert (got[0], got[1], got[2]) == (p, m, s)
    with pytest.raises(ValueError):
        list(fim.sections("psm", ["<P>only a prefix<S>"]))


def test_resort_does_not_shuffle_again(spark):
    docs = frame(spark, ROWS)
    once = fim.output_records(docs)
    same = once.mapPartitions(lambda x: x, preservesPartitioning=True)
    again = fim._sorted_by_place(same, once.getNumPartitions())
    count = lambda rdd: rdd._jrdd.rdd().toDebugString().count("ShuffledRDD")
    assert count(again) == count(once) == 1


def test_query_matches_oracle(spark):
    ok, n, _, detail = compare(spark, duck_connect(DIR), "op11", fim.op11_fill_in_middle, oracle_sql()["op11_fill_in_middle"], DIR)
    assert ok and n > 0, detail
