import datetime as dt

from stationlake.sources.payload import decode_payloads, payload_rejects

HEAD = ('<wfs:FeatureCollection xmlns:wfs="http://www.opengis.net/wfs/2.0" xmlns:gml="http://www.opengis.net/gml/3.2" '
        'xmlns:gmlcov="http://www.opengis.net/gmlcov/1.0"><wfs:member>')
TAIL = "</wfs:member></wfs:FeatureCollection>"


def doc(pos, val):
    p = f"<gmlcov:positions>\n{pos}\n</gmlcov:positions>" if pos is not None else ""
    v = f"<gml:doubleOrNilReasonTupleList>\n{val}\n</gml:doubleOrNilReasonTupleList>" if val is not None else ""
    return HEAD + p + v + TAIL


def _df(spark, docs):
    return spark.createDataFrame([(str(100 + i), d) for i, d in enumerate(docs)], "station_id string, xml string")


def test_lines_pair_up_and_nan_and_short_lines(spark):
    d = doc("   60.17 24.94 1704103200  \n   60.17 24.94 1704103800  ",
            "  -3.5 91.0 3.2 180.0 1010.1 NaN 8.0 20000.0\n  -4.0 NaN 2.0")
    rows = decode_payloads(_df(spark, [d])).orderBy("timestamp").collect()
    assert len(rows) == 2
    assert rows[0]["timestamp"] == dt.datetime(2024, 1, 1, 10, 0) and rows[0]["precipitation"] is None
    assert rows[0]["visibility"] == 20000.0 and rows[0]["latitude"] == 60.17
    assert rows[1]["humidity"] is None and rows[1]["wind_speed"] == 2.0 and rows[1]["wind_direction"] is None
    latest = decode_payloads(_df(spark, [d]), latest_only=True).collect()
    assert len(latest) == 1 and latest[0]["timestamp"] == dt.datetime(2024, 1, 1, 10, 10)


def test_lines_are_paired_strictly(spark):
    pos = "60 24 1704103200\n60 24 1704103800\n60 24 1704104400"
    docs = [doc(pos, "1 11\n\n3 33"), doc(pos, "1 11\n3 33"), doc(pos.replace("1704103800", "9" * 17), "1\n2\n3")]
    rows = sorted((r["station_id"], r["timestamp"].minute, r["temperature"]) for r in decode_payloads(_df(spark, docs)).collect())
    assert rows == [(100, 0, 1.0), (100, 20, 3.0), (102, 0, 1.0), (102, 20, 3.0)]
    assert sorted(r["reject_reason"] for r in payload_rejects(_df(spark, docs)).collect()) == [
        "bad_position", "empty_values", "line_count_mismatch"]
    latest = decode_payloads(_df(spark, docs), latest_only=True).collect()
    assert sorted((r["station_id"], r["temperature"]) for r in latest) == [(100, 3.0), (101, 3.0), (102, 3.0)]


def test_comments_prefixes_references_and_cdata(spark):
    good = doc("60 24 1704103200", "1 2 3")
    docs = [good.replace("<gmlcov:positions>", "<!-- <gmlcov:positions>9 9 0</gmlcov:positions> --><gmlcov:positions>"),
            good.replace("gmlcov:", "c:").replace(":gmlcov=", ":c=").replace("gml:", "g:").replace(":gml=", ":g="),
            good.replace("60 24", "60&#32;24"), good.replace("60 24 1704103200", "<![CDATA[60 24 1704103200]]>"),
            good.replace("<gmlcov:positions>", '<positions xmlns="http://www.opengis.net/gmlcov/1.0">')
                .replace("</gmlcov:positions>", "</positions>").replace('xmlns:gmlcov="http://www.opengis.net/gmlcov/1.0"', ""),
            good.replace("http://www.opengis.net/gmlcov/1.0", "http://other")]
    rows = decode_payloads(_df(spark, docs)).collect()
    assert sorted(r["station_id"] for r in rows) == [100, 101, 102, 103, 104]
    assert {(r["latitude"], r["timestamp"], r["temperature"]) for r in rows} == {(60.0, dt.datetime(2024, 1, 1, 10), 1.0)}
    assert [r["reject_reason"] for r in payload_rejects(_df(spark, docs)).collect()] == ["missing_positions"]


def test_bad_payloads_are_rejected_with_reason(spark):
    docs = [doc("60 24 1704103200", None), doc(None, "1 2 3"), "<a><b>", "plain text", None,
            doc("60 24 notanumber", "1 2 3"), doc("60 24 1704103200", "1 2 3")]
    df = _df(spark, docs)
    assert decode_payloads(df).count() == 1
    reasons = sorted(r["reject_reason"] for r in payload_rejects(df).collect())
    assert reasons == ["bad_position", "malformed_xml", "malformed_xml", "malformed_xml", "missing_positions",
                       "missing_values"]


def test_prolog_comments_cdata_and_attributes(spark):
    head = ('<?xml version="1.0" encoding="UTF-8"?>\n<!-- c --><wfs:FeatureCollection x="1" '
            'xmlns:wfs="http://www.opengis.net/wfs/2.0" xmlns:gml="http://www.opengis.net/gml/3.2" '
            'xmlns:gmlcov="http://www.opengis.net/gmlcov/1.0"><wfs:member><gml:d><![CDATA[a < b]]></gml:d>')
    d = (head + '<gmlcov:positions srsDimension="3">\n 60.1 24.9 1704103200\n</gmlcov:positions>'
         '<gml:doubleOrNilReasonTupleList>\n 1.0 2.0\n</gml:doubleOrNilReasonTupleList></wfs:member></wfs:FeatureCollection>')
    rows = decode_payloads(_df(spark, [d, d.replace("</wfs:member>", "")])).collect()
    assert len(rows) == 1 and rows[0]["temperature"] == 1.0 and rows[0]["humidity"] == 2.0


GMLCOV, GML = "http://www.opengis.net/gmlcov/1.0", "http://www.opengis.net/gml/3.2"


def test_namespaces_go_by_scope(spark):
    good = doc("60 24 1704103200", "1 2 3")
    second = good.replace("<wfs:FeatureCollection ", f'<wfs:FeatureCollection xmlns:two="{GMLCOV}" ')
    pos = "<gmlcov:positions>\n60 24 1704103200\n</gmlcov:positions>"
    assert pos in good
    other = '<gmlcov:positions xmlns:gmlcov="http://other">9 9 0</gmlcov:positions>'
    decoded = [
        second, second.replace("gmlcov:positions", "two:positions"),                                  # either of two prefixes
        good.replace(pos, f'<positions xmlns="{GMLCOV}">60 24 1704103200</positions>'),               # default beside a prefix
        good.replace(pos, other + pos),                                                               # declared again, then out of scope
        good.replace(pos, f'<wfs:d xmlns:gmlcov="http://other"><gmlcov:positions>9 9 0</gmlcov:positions></wfs:d>{pos}'),
        good.replace(pos, f'<wfs:d xmlns:gmlcov="http://other">{pos.replace("gmlcov:", "inner:").replace("<inner:positions", f"<inner:positions xmlns:inner={chr(39)}{GMLCOV}{chr(39)}")}</wfs:d>'),
        good.replace("xmlns:gmlcov=", "xmlns:gmlcov = "), good.replace(f'"{GMLCOV}"', f"'{GMLCOV}'"),
        good.replace(pos, '<wfs:e a="x>y"/>' + other + pos),
        second.replace("<gmlcov:positions>\n60 24 1704103200\n", "<gmlcov:positions><![CDATA[60 24]]> 1704103200"),
        good.replace(pos, "<gmlcov:positions/>" + pos), second.replace(pos, "<gmlcov:positions />" + pos),
    ]
    wrong = [good.replace(pos, other), good.replace(pos, '<wfs:d xmlns:gmlcov="http://other">' + pos + "</wfs:d>"),
             good.replace(pos, "<positions>60 24 1704103200</positions>"),
             good.replace(pos, f'<wfs:d xmlns="{GMLCOV}"/><positions>60 24 1704103200</positions>')]
    df = _df(spark, decoded + wrong)
    rows = decode_payloads(df).collect()
    assert sorted(r["station_id"] for r in rows) == [100 + i for i in range(len(decoded))]
    assert {(r["latitude"], r["timestamp"], r["temperature"]) for r in rows} == {(60.0, dt.datetime(2024, 1, 1, 10), 1.0)}
    assert [r["reject_reason"] for r in payload_rejects(df).collect()] == ["missing_positions"] * len(wrong)


def test_payload_stream_equals_the_batch_and_survives_a_replay(spark, workdir):
    import shutil

    from stationlake.operators.lookup import producer_records
    from stationlake.sources.tables import read_raw, read_table
    from stationlake.schemas import RAW_COLUMNS
    from stationlake.streaming import payloads as P

    docs = [doc(f"60 24 {1704103200 + 600 * i}", f"{i} 2 3") for i in range(9)] + ["<broken", doc(None, "1")]
    df = _df(spark, docs)
    df.repartition(4).write.json(f"{workdir}/in")
    names = spark.createDataFrame([(100, "first"), (104, "fifth")], "station_id long, station_name string")

    def run():
        q = P.land_payloads(P.payload_stream(spark, f"{workdir}/in", max_per_trigger=1), names, f"{workdir}/raw", f"{workdir}/bad",
                            f"{workdir}/cp", "2024-02-01 00:00:00")
        q.awaitTermination()
        return q

    assert run().lastProgress["batchId"] >= 3
    want = producer_records(decode_payloads(df, latest_only=True), names, "2024-02-01 00:00:00")
    rows = lambda d: sorted((tuple(r) for r in d.select(*RAW_COLUMNS).collect()), key=str)
    bad = lambda: sorted((r.station, r.reject_reason) for r in read_table(spark, f"{workdir}/bad", P.REJECT_SCHEMA).collect())
    assert rows(read_raw(spark, f"{workdir}/raw")) == rows(want)
    assert bad() == [("109", "malformed_xml"), ("110", "missing_positions")]
    # the last batch was written but not committed: it is run again
    import glob

    last = sorted(glob.glob(f"{workdir}/cp/commits/[0-9]*"), key=lambda f: int(f.rsplit("/", 1)[1]))[-1]
    folder, number = last.rsplit("/", 1)
    shutil.move(last, f"{workdir}/moved-commit")
    shutil.move(f"{folder}/.{number}.crc", f"{workdir}/moved-crc")
    run()
    assert rows(read_raw(spark, f"{workdir}/raw")) == rows(want) and len(bad()) == 2


def test_long_sections_are_read_without_recursion(spark):
    n = 20_000
    d = doc("\n".join(f"60 24 {1704103200 + 60 * i}" for i in range(n)), "\n".join(f"{i % 50} 2 3" for i in range(n)))
    got = decode_payloads(_df(spark, [d])).selectExpr("count(*) AS n", "count(distinct timestamp) AS t", "sum(temperature) AS s").first()
    assert (got.n, got.t, got.s) == (n, n, sum(i % 50 for i in range(n)))


def test_tags_of_a_document_are_read_once_for_both_elements(spark):
    plan = decode_payloads(_df(spark, [doc("60 24 1704103200", "1 2 3")]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2  # prefixes and URIs
