from stationlake.operators.cleanse import cleanse
from stationlake.operators.curate import hourly_latest
from stationlake.schemas import RAW_COLUMNS
from stationlake.sources.fixtures import messages_from_events, read_source
from stationlake.sources.messages import decode_messages, value_stream
from stationlake.sources.tables import read_raw
from stationlake.streaming import landing

from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _files(spark, workdir, n=6):
    msgs = messages_from_events(read_source(spark, SF_SMALL, "events"))
    msgs.select("value").repartition(n).write.text(f"{workdir}/in")
    return msgs, f"{workdir}/in"


def test_landing_equals_batch_cleanse_and_restart_adds_nothing(spark, workdir):
    msgs, src = _files(spark, workdir)
    q = landing.land_stream(value_stream(spark, "text", src, max_per_trigger=2), f"{workdir}/raw",
                            f"{workdir}/q", f"{workdir}/ck")
    q.awaitTermination()
    assert q.exception() is None
    raw = read_raw(spark, f"{workdir}/raw")
    assert raw.select("batch_id").distinct().count() == 3
    want, _ = cleanse(decode_messages(msgs))
    assert _rows(raw.select(*RAW_COLUMNS)) == _rows(want.select(*RAW_COLUMNS))
    q = landing.land_stream(value_stream(spark, "text", src, max_per_trigger=2), f"{workdir}/raw",
                            f"{workdir}/q", f"{workdir}/ck")
    q.awaitTermination()
    assert read_raw(spark, f"{workdir}/raw").count() == raw.count()


def test_replayed_batch_is_idempotent(spark, workdir):
    msgs = messages_from_events(read_source(spark, SF_SMALL, "events"))
    counts = landing.land_batch(msgs, 7, f"{workdir}/raw", f"{workdir}/q")
    n = read_raw(spark, f"{workdir}/raw").count()
    assert counts["accepted"] == n and counts["accepted"] + counts["rejected"] == msgs.count()
    assert counts == landing.land_batch(msgs, 7, f"{workdir}/raw", f"{workdir}/q")
    assert read_raw(spark, f"{workdir}/raw").count() == n


def _winners(spark, workdir, rule, files=6, per_trigger=2):
    msgs, src = _files(spark, workdir, files)
    stream = landing.cleansed_stream(value_stream(spark, "text", src, max_per_trigger=per_trigger))
    landing.keep_winners(stream, rule, f"{workdir}/out", f"{workdir}/ck").awaitTermination()
    accepted, _ = cleanse(decode_messages(msgs))
    return accepted.select(*RAW_COLUMNS), landing.read_winners(spark, f"{workdir}/out", rule)


def test_hourly_winners_equal_the_batch_rule_in_any_order(spark, workdir):
    # the files are shuffled, so rows of an hour come in several batches, hours late
    accepted, got = _winners(spark, workdir, hourly_latest)
    assert spark.read.parquet(f"{workdir}/out").select("batch_id").distinct().count() == 3
    assert _rows(got.select(*RAW_COLUMNS)) == _rows(hourly_latest(accepted).select(*RAW_COLUMNS))


def test_first_deliveries_keep_one_copy_per_observation(spark, workdir):
    accepted, got = _winners(spark, workdir, landing.first_deliveries)
    assert got.count() == accepted.select("station_id", "timestamp").distinct().count() > 0
    first = accepted.groupBy("station_id", "timestamp").agg({"ingestion_time": "min"}).withColumnRenamed(
        "min(ingestion_time)", "ingestion_time")
    assert got.join(first, ["station_id", "timestamp", "ingestion_time"], "left_anti").count() == 0


def test_a_late_row_changes_its_closed_hour(spark, workdir):
    row = lambda ts, t: (f'{{"fmisid": 5, "timestamp": "{ts}", "ingestion_time": "2024-01-01T23:00:00", "temperature": {t}}}',)
    run = lambda: landing.keep_winners(landing.cleansed_stream(value_stream(spark, "text", f"{workdir}/in/*")),
                                       hourly_latest, f"{workdir}/out", f"{workdir}/ck").awaitTermination()
    spark.createDataFrame([row("2024-01-01T10:10:00", 1.0), row("2024-01-01T20:00:00", 2.0)], "value string").write.text(f"{workdir}/in/1")
    run()
    assert _rows(landing.read_winners(spark, f"{workdir}/out", hourly_latest).select("temperature")) == [(1.0,), (2.0,)]
    spark.createDataFrame([row("2024-01-01T10:50:00", 3.0)], "value string").write.text(f"{workdir}/in/2")
    run()
    assert _rows(landing.read_winners(spark, f"{workdir}/out", hourly_latest).select("temperature")) == [(2.0,), (3.0,)]


def test_two_checkpoints_share_a_raw_table(spark, workdir):
    msgs, src = _files(spark, workdir, 2)
    for n in (0, 1):
        landing.land_stream(value_stream(spark, "text", src), f"{workdir}/raw", f"{workdir}/q", f"{workdir}/ck{n}").awaitTermination()
    want, _ = cleanse(decode_messages(msgs))
    assert read_raw(spark, f"{workdir}/raw").count() == 2 * want.count()
    assert read_raw(spark, f"{workdir}/raw").select("source_id").distinct().count() == 2


def test_batches_with_and_without_extra_fields_read_together(spark, workdir):
    msgs = messages_from_events(read_source(spark, SF_SMALL, "events"))
    landing.land_batch(msgs, 0, f"{workdir}/raw", f"{workdir}/q", keep_extra=False)
    landing.land_batch(msgs, 1, f"{workdir}/raw", f"{workdir}/q")
    merged = read_raw(spark, f"{workdir}/raw", merge_schema=True)
    assert "extra_fields" in merged.columns
    by_batch = {r["batch_id"]: r["n"] for r in merged.where("extra_fields is not null")
                .groupBy("batch_id").count().withColumnRenamed("count", "n").collect()}
    assert set(by_batch) == {1}
    assert merged.where("extra_fields['extra_field'] is not null").count() > 0


def test_new_files_after_a_drain_are_picked_up_once(spark, workdir):
    msgs = messages_from_events(read_source(spark, SF_SMALL, "events"))
    first, second = msgs.randomSplit([0.5, 0.5], seed=3)
    first.select("value").write.text(f"{workdir}/in/part=1")
    run = lambda: landing.land_stream(value_stream(spark, "text", f"{workdir}/in/*"), f"{workdir}/raw",
                                      f"{workdir}/q", f"{workdir}/ck").awaitTermination()
    run()
    n1 = read_raw(spark, f"{workdir}/raw").count()
    second.select("value").write.text(f"{workdir}/in/part=2")
    run()
    run()
    want, _ = cleanse(decode_messages(msgs))
    assert n1 < read_raw(spark, f"{workdir}/raw").count() == want.count()


def test_continuous_trigger_lands_then_stops(spark, workdir):
    msgs, src = _files(spark, workdir, 3)
    q = landing.land_stream(value_stream(spark, "text", src, max_per_trigger=1), f"{workdir}/raw", f"{workdir}/q",
                            f"{workdir}/ck", trigger="1 second", name="landing_test")
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    want, _ = cleanse(decode_messages(msgs))
    assert read_raw(spark, f"{workdir}/raw").count() == want.count()


def test_kafka_source_needs_only_the_connector(spark):
    import pytest

    # The connector jar is not installed here: the reader is configured and fails only at load.
    with pytest.raises(Exception, match="Failed to find data source: kafka"):
        value_stream(spark, "kafka", "localhost:9092", topic="observations", max_per_trigger=100)


def test_batches_without_rejects_or_rows(spark, workdir):
    good = ('{"fmisid": 5, "timestamp": "2024-01-01T10:00:00", "ingestion_time": "2024-01-01T10:01:00", '
            '"temperature": 1.0}')
    one = spark.createDataFrame([("5", good)], "key string, value string")
    assert landing.land_batch(one, 0, f"{workdir}/raw", f"{workdir}/q") == {"batch_id": 0, "accepted": 1, "rejected": 0}
    none = spark.createDataFrame([], "key string, value string")
    assert landing.land_batch(none, 1, f"{workdir}/raw", f"{workdir}/q") == {"batch_id": 1, "accepted": 0, "rejected": 0}
    assert read_raw(spark, f"{workdir}/raw").count() == 1


def test_compaction_folds_batches_without_changing_rows(spark, workdir):
    import datetime as dt
    import os

    from stationlake.sources.tables import compact_days

    msgs = messages_from_events(read_source(spark, SF_SMALL, "events"))
    parts = msgs.randomSplit([1.0, 1.0, 1.0], seed=11)
    for i, p in enumerate(parts):
        landing.land_batch(p, i, f"{workdir}/raw", f"{workdir}/q", keep_extra=(i == 2))
    plain = lambda: _rows(read_raw(spark, f"{workdir}/raw").select(*RAW_COLUMNS))
    extras = lambda: read_raw(spark, f"{workdir}/raw").where("extra_fields IS NOT NULL").count()
    before, kept = plain(), extras()
    day = "2024-01-15"
    folder = f"{workdir}/raw/observation_date={day}"
    batches = lambda: {f"{s}/{b}" for s in os.listdir(folder) if "=" in s for b in os.listdir(f"{folder}/{s}") if "=" in b}
    assert len(batches()) == 3
    for _ in range(2):  # the second run changes nothing
        counts = compact_days(spark, f"{workdir}/raw", [day], today=dt.date(2024, 2, 1))
        assert batches() == {"source_id=compacted/batch_id=-1"}
        assert plain() == before and counts[day] > 0 and extras() == kept > 0
    assert compact_days(spark, f"{workdir}/raw", ["2023-06-01"], today=dt.date(2024, 2, 1)) == {"2023-06-01": 0}
    assert not os.path.exists(f"{workdir}/raw/observation_date=2023-06-01")
    import pytest
    with pytest.raises(ValueError):
        compact_days(spark, f"{workdir}/raw", ["2024-01-31"], today=dt.date(2024, 2, 1))


def test_keyed_messages_keep_their_key(spark, workdir):
    from stationlake.sources.messages import encode_messages, write_messages
    from stationlake.sources.fixtures import raw_observations

    raw = raw_observations(spark, SF_SMALL)
    write_messages(encode_messages(raw), "json", f"{workdir}/m")
    back = spark.read.schema("key string, value string").json(f"{workdir}/m")
    assert back.where("key = get_json_object(value, '$.fmisid')").count() == raw.count()
    assert value_stream(spark, "json", f"{workdir}/m").columns == ["key", "value"]


def test_only_the_requested_days_are_listed_and_read_errors_are_raised(spark, workdir):
    import pytest
    from stationlake.sources.fixtures import raw_observations
    from stationlake.sources.tables import RAW_TABLE_SCHEMA, append_batch, read_day, read_days, read_table

    append_batch(raw_observations(spark, SF_SMALL), f"{workdir}/raw", 0)
    day = read_day(spark, f"{workdir}/raw", "2024-01-15", RAW_TABLE_SCHEMA)
    assert {f.split("observation_date=")[1][:10] for f in day.inputFiles()} == {"2024-01-15"}
    assert day.where("to_date(timestamp) <> DATE '2024-01-15'").count() == 0 < day.count()
    two = read_days(spark, f"{workdir}/raw", ["2024-01-15", "2024-01-16", "2030-01-01"], RAW_TABLE_SCHEMA)
    assert {f.split("observation_date=")[1][:10] for f in two.inputFiles()} == {"2024-01-15", "2024-01-16"}
    assert read_day(spark, f"{workdir}/raw", "2030-01-01", RAW_TABLE_SCHEMA).count() == 0
    (spark.createDataFrame([("not a parquet file",)], "value string").coalesce(1).write.text(f"{workdir}/broken"))
    with pytest.raises(Exception):
        read_table(spark, f"{workdir}/broken", RAW_TABLE_SCHEMA).count()


def test_registered_streams_deal_events_out_and_bound_their_micro_batches(spark, workdir, monkeypatch):
    from stationlake.plans import streams

    sf = f"{workdir}/sf"
    events = read_source(spark, SF_SMALL, "events")
    events.repartition(24).write.parquet(f"{sf}/events.parquet")
    monkeypatch.setattr(streams, "shared_dir", lambda _, name: f"{workdir}/{name}")
    assert streams._events(spark, SF_SMALL).rdd.getNumPartitions() == 8  # a single small file is a single split
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # every file is a task
    try:
        got = streams.q_stream_two_sources(spark, sf)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    per = read_raw(spark, f"{workdir}/two-sources/raw").select("source_id", "batch_id").distinct().groupBy("source_id").count().collect()
    assert len(per) == 2 and all(r["count"] <= streams.FEED_FILES // streams.FILES_PER_TRIGGER for r in per)
    want, _ = cleanse(decode_messages(messages_from_events(events)))
    assert _rows(got) == _rows(want.select(*RAW_COLUMNS))
