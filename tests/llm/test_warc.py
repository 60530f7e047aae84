"""WARC archive: oracle, brute force, exact records, damage."""

import base64
import hashlib
import re
from pathlib import Path

import pytest

from stationlake.llm import warc
from stationlake.llm.queries import oracle_sql
from tests.oracle_compare import compare, duck_connect

DIR = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, payload string, header int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA)


ROWS = [(5, "http://a.example/x", "<p>same</p>"), (3, "http://b.example/", "<p>same</p>"), (9, None, "<p>same</p>"),
        (4, "http://c.example/a\r\nWARC-Type: fake", "own é𝄞\r\n\r\nWARC/1.1\r\n"), (6, "", None), (7, "u", ""), (8, "u", "x" * 2_000_000),
        (None, "http://no.id/", "<p>same</p>"), (3, "http://b.example/again", "<p>same</p>"), (None, "n", "only here, no id"), (10, "u", "short"),
        (11, "u", "short"), (-2, "u", "short")]


def brute(rows, min_bytes=0):
    by = {}
    big = lambda i: (i is None, i)
    for i, _, h in rows:
        by.setdefault((h or "").encode(), []).append(i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        first = min(by[data], key=big)
        later = len(data) >= min_bytes and big(i) > big(first)
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if later else "response", first if later else None))
    return sorted(out, key=str)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("min_bytes", [0, 6])
def test_records_against_brute_force(spark, workdir, min_bytes):
    path = f"{workdir}/archive"
    warc.write_archive(pages(spark, ROWS), path, min_bytes=min_bytes)
    got = warc.read_records(spark, path)
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str) == brute(ROWS, min_bytes)
    texts = sorted(((r.page_id, bytes(r.payload).decode()) for r in got.collect()), key=str)
    assert texts == sorted(((i, h or "") for i, _, h in ROWS), key=str)  # of revisits too
    assert spark.read.parquet(f"{path}/payloads").count() == len({(h or "") for _, _, h in ROWS})


def test_empty_table(spark, workdir):
    warc.write_archive(pages(spark, ROWS).limit(0), f"{workdir}/none")
    assert warc.read_records(spark, f"{workdir}/none").count() == 0


def test_exported_files_are_warc(spark, workdir):
    """A reader that goes by Content-Length alone finds every record, whatever stands in the payloads."""
    warc.write_archive(pages(spark, ROWS), f"{workdir}/archive")
    warc.export_warc(warc.read_records(spark, f"{workdir}/archive"), f"{workdir}/files")
    found = []
    for file in sorted(Path(workdir.removeprefix("file:")).glob("files/part-*")):
        data = file.read_bytes()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(x.split(": ", 1) for x in lines[1:])
            assert lines[0] == "WARC/1.1" and set(fields) >= {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"}
            size = int(fields["Content-Length"])
            block, data = rest[:size], rest[size:]
            assert data.startswith(b"\r\n\r\n")
            data = data[4:]
            http, _, payload = block.partition(b"\r\n\r\n")
            assert http.startswith(b"HTTP/1.1 200 OK\r\n")
            if fields["WARC-Type"] == "response":
                assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
                assert f"Content-Length: {len(payload)}".encode() in http
            else:
                assert payload == b"" and fields["WARC-Profile"] == warc.PROFILE
            found.append((re.sub(r"\D", "", fields["WARC-Record-ID"].replace("-2", "2")), fields["WARC-Type"]))
    assert sorted(t for _, t in found) == sorted(r[3] for r in brute(ROWS))


def test_url_cannot_add_a_field(spark, workdir):
    warc.write_archive(pages(spark, ROWS), f"{workdir}/archive")
    row = warc.read_records(spark, f"{workdir}/archive").where("page_id = 4").first()
    assert row.record_type == "response" and row.url == "http://c.example/a%0D%0AWARC-Type: fake"
    assert warc.read_records(spark, f"{workdir}/archive").where("page_id = 9").first().url is None


def test_damage_is_an_error(spark, workdir):
    path = f"{workdir}/archive"
    warc.write_archive(pages(spark, ROWS), path)
    stored = spark.read.parquet(f"{path}/payloads")
    broken = stored.selectExpr("payload_key", "CASE WHEN octet_length(payload) = 5 THEN binary('shorT') ELSE payload END AS payload")
    broken.write.parquet(f"{workdir}/broken/payloads")
    stored.where("octet_length(payload) <> 5").write.parquet(f"{workdir}/lacking/payloads")
    for name, text in (("broken", "damaged payload"), ("lacking", "no payload for record")):
        spark.read.parquet(f"{path}/records").write.parquet(f"{workdir}/{name}/records")
        with pytest.raises(Exception, match=text):
            warc.read_records(spark, f"{workdir}/{name}").select(*COLUMNS).collect()


def test_query_matches_oracle_and_shuffles_no_payload_on_reading(spark):
    ok, n, _, detail = compare(spark, duck_connect(DIR), "op12", warc.op12_warc, oracle_sql()["op12_warc"], DIR)
    assert ok and n > 0, detail
    plan = warc.op12_warc(spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join"):]
    assert "payload#" not in join.splitlines()[0] and "Python" not in plan
