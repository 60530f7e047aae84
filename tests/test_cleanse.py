import json

from stationlake.operators.cleanse import REJECT_REASONS, cleanse, reject_counts
from stationlake.sources.messages import decode_messages, encode_messages
from stationlake.sources.fixtures import raw_observations

from tests.conftest import SF_SMALL

GOOD = {"fmisid": 900971, "latitude": 60.2, "longitude": 24.9, "timestamp": "2026-01-01T10:00:00",
        "temperature": -3.5, "humidity": 91.0, "wind_speed": 3.2, "wind_direction": 180.0, "pressure": 1010.1,
        "precipitation": None, "cloud_cover": 8.0, "visibility": 20000.0,
        "ingestion_time": "2026-01-01T10:04:11.123456", "location": "Station A"}


def _msg(**changes):
    d = dict(GOOD)
    for k, v in changes.items():
        if v is _DROP:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


_DROP = object()


def _run(spark, values):
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "key string, value string")
    return cleanse(decode_messages(df))


def test_every_reject_reason(spark):
    cases = {
        "malformed_json": '{"fmisid": 1, "timestamp": ',
        "missing_required": _msg(timestamp=None),
        "blank_timestamp": _msg(timestamp="   "),
        "blank_ingestion_time": _msg(ingestion_time=" "),
        "bad_timestamp": _msg(timestamp="yesterday"),
        "bad_ingestion_time": _msg(ingestion_time=_DROP),
        "bad_station_id": _msg(fmisid="abc"),
    }
    assert set(cases) == set(REJECT_REASONS)
    keys = list(cases)
    accepted, rejected = _run(spark, [cases[k] for k in keys])
    assert accepted.count() == 0
    got = {int(r["key"]): r["reject_reason"] for r in rejected.collect()}
    assert {keys[i]: got[i] for i in got} == {k: k for k in keys}
    also = _run(spark, [_msg(fmisid=None), _msg(fmisid=""), None])[1]
    assert sorted(r[0] for r in reject_counts(also).select("reject_reason").collect()) == [
        "bad_station_id", "malformed_json", "missing_required"]


def test_kept_rows(spark):
    values = [
        _msg(temperature="warm"),                 # bad measure -> null, row kept
        _msg(humidity="NaN"),                     # NaN token -> null
        _msg(pressure=_DROP),                     # absent measure -> null
        _msg(extra_field={"a": 1}),               # unknown field ignored
        _msg(fmisid="900971"),                    # id sent as text
        _msg(timestamp="2026-01-01T10:00:00.250000"),  # with and without fraction in one batch
    ]
    accepted, rejected = _run(spark, values)
    assert rejected.count() == 0
    rows = accepted.orderBy("timestamp", "temperature").collect()
    assert len(rows) == 6
    assert sum(r["temperature"] is None for r in rows) == 1
    assert sum(r["humidity"] is None for r in rows) == 1
    assert sum(r["pressure"] is None for r in rows) == 1
    assert {r["station_id"] for r in rows} == {900971}
    assert rows[-1]["timestamp"].microsecond == 250000


def test_roundtrip_is_lossless(spark):
    raw = raw_observations(spark, SF_SMALL)
    accepted, rejected = cleanse(decode_messages(encode_messages(raw)))
    assert rejected.count() == 0
    assert sorted(map(tuple, accepted.drop("extra_fields", "extra_values").collect())) == sorted(map(tuple, raw.collect()))


def test_unknown_fields_kept_when_asked(spark):
    df = spark.createDataFrame([("1", _msg(extra_field={"a": 1}, gust=12.5)), ("2", _msg())], "key string, value string")
    accepted, _ = cleanse(decode_messages(df))
    got = [r["extra_fields"] for r in accepted.collect()]
    assert got == [{"extra_field": '{"a":1}', "gust": "12.5"}, None]
    assert "extra_fields" not in cleanse(decode_messages(df), keep_extra=False)[0].columns


def test_only_one_json_object_is_a_message(spark):
    good = _msg()
    bad = [good + good, good + " xx", good + "," + good, good + "] [" + good, good + ',"m":' + good, "5", "null", "", "[" + good + "]", good[:-1]]
    accepted, rejected = _run(spark, [f"  {good}\n", *bad])
    assert accepted.count() == 1
    assert sorted(int(r["key"]) for r in rejected.collect()) == list(range(1, len(bad) + 1))
    assert {r["reject_reason"] for r in rejected.collect()} == {"malformed_json"}


def test_ids_are_exact(spark):
    values = [_msg(fmisid=i) for i in ("9007199254740993.0", "9223372036854775807", "9223372036854775808", "5.5", "1e3")]
    accepted, rejected = _run(spark, values)
    assert sorted(r["station_id"] for r in accepted.collect()) == [1000, 9007199254740993, 9223372036854775807]
    assert sorted(r["key"] for r in rejected.collect()) == ["2", "3"]
