"""Table versions: a run killed after any step leaves the old or the new version, and a rerun ends it."""

import datetime as dt
import os
from pathlib import Path

import pytest

from stationlake.operators.curate import hourly_latest
from stationlake.plans.daily_job import HISTORY_TABLE_SCHEMA, Layout, run_days
from stationlake.plans.stored import Interrupted
from stationlake.schemas import RAW_COLUMNS
from stationlake.sources import versions
from stationlake.sources.fixtures import raw_observations
from stationlake.sources.tables import (
    RAW_TABLE_SCHEMA, append_batch, compact_days, merge_levels, read_day, read_days, read_raw, read_table, replace_days,
)

from tests.conftest import SF_SMALL

DAY, OTHER = "2024-01-15", "2024-01-16"
TODAY = dt.date(2024, 3, 1)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def stop_after(name):
    def step(at):
        if at == name:
            raise Interrupted(at)
    return step


def folders(path, day):
    return {str(p.relative_to(f"{path}/observation_date={day}")) for p in Path(f"{path}/observation_date={day}").glob("*/*") if "=" in p.name}


def two_days(spark):
    return raw_observations(spark, SF_SMALL).where(f"to_date(timestamp) IN (DATE '{DAY}', DATE '{OTHER}')")


@pytest.mark.parametrize("stop", ["marked", "written", "committed", "cleaned"])
def test_killed_compaction(spark, workdir, stop):
    raw = f"{workdir}/raw"
    rows = two_days(spark).cache()
    for n in range(3):
        append_batch(rows.where(f"pmod(xxhash64(station_id, timestamp, ingestion_time), 3) = {n}"), raw, n, source_id="s")
    plain = lambda: _rows(read_raw(spark, raw).select(*RAW_COLUMNS))
    want = _rows(rows.select(*RAW_COLUMNS))
    assert plain() == want
    with pytest.raises(Interrupted):
        compact_days(spark, raw, [DAY, OTHER], today=TODAY, step=stop_after(stop))
    assert plain() == want
    one = _rows(read_day(spark, raw, DAY, RAW_TABLE_SCHEMA).select(*RAW_COLUMNS))
    assert one == [r for r in want if str(r[0]).startswith(DAY)] or len(one) == rows.where(f"to_date(timestamp) = '{DAY}'").count()
    # rows that come between the kill and the next run
    late = rows.limit(3).withColumn("temperature", rows.temperature + 1)
    append_batch(late, raw, 3, source_id="s")
    want = sorted(want + [tuple(r) for r in late.select(*RAW_COLUMNS).collect()], key=str)
    assert plain() == want
    for _ in range(2):
        counts = compact_days(spark, raw, [DAY, OTHER], today=TODAY)
        assert plain() == want and sum(counts.values()) == len(want)
        assert all(len(folders(raw, d)) == 1 for d in (DAY, OTHER))
    # a replay of a folded batch is not read again
    append_batch(rows.where("pmod(xxhash64(station_id, timestamp, ingestion_time), 3) = 1"), raw, 1, source_id="s")
    assert plain() == want
    append_batch(late, raw, 1, source_id="another")  # the same number of another source is new
    assert len(plain()) == len(want) + 3
    rows.unpersist()


@pytest.mark.parametrize("stop", ["daily written", "daily committed", "history written", "history committed", "summary written"])
def test_killed_backfill(spark, workdir, stop):
    lay = Layout(workdir)
    append_batch(two_days(spark), lay.raw, 0)
    tables = lambda: {p: _rows(read_table(spark, p)) for p in (lay.daily, lay.summary, lay.report, lay.history)}
    run_days(spark, lay, DAY, OTHER, run_ts=dt.datetime(2024, 2, 1))
    old = tables()
    extra = two_days(spark).limit(20).selectExpr("* EXCEPT (ingestion_time)", "ingestion_time + INTERVAL 9 HOURS AS ingestion_time")
    append_batch(extra.select(*RAW_COLUMNS), lay.raw, 1)
    reference = Layout(f"{workdir}/reference")
    append_batch(two_days(spark), reference.raw, 0)
    append_batch(extra.select(*RAW_COLUMNS), reference.raw, 1)
    run_days(spark, reference, DAY, OTHER, run_ts=dt.datetime(2024, 2, 2))
    new = {lay.path(p.rsplit("/", 1)[1]): _rows(read_table(spark, p)) for p in (reference.daily, reference.summary, reference.report, reference.history)}
    with pytest.raises(Interrupted):
        run_days(spark, lay, DAY, OTHER, run_ts=dt.datetime(2024, 2, 2), step=stop_after(stop))
    for path, rows in tables().items():
        assert rows in (old[path], new[path]), path
    run_days(spark, lay, DAY, OTHER, run_ts=dt.datetime(2024, 2, 2))
    assert tables() == new
    run_days(spark, lay, DAY, OTHER, run_ts=dt.datetime(2024, 2, 2))
    for path in (lay.daily, lay.history):  # two versions stay, whatever was killed before
        assert all(len(os.listdir(f"{path}/observation_date={d}")) <= versions.RETAIN for d in (DAY, OTHER))


def test_a_reader_of_the_version_before_can_end(spark, workdir):
    path = f"{workdir}/t"
    day = lambda n: spark.createDataFrame([(n, dt.date(2024, 1, 1))], "x int, observation_date date")
    replace_days(day(1), path, "observation_date", ["2024-01-01"])
    reader = read_table(spark, path)
    replace_days(read_table(spark, path).selectExpr("x + 1 AS x", "observation_date"), path, "observation_date", ["2024-01-01"])
    assert [r.x for r in reader.collect()] == [1] and [r.x for r in read_table(spark, path).collect()] == [2]
    assert replace_days(day(3).where("false"), path, "observation_date", ["2024-01-01"]) == []
    assert read_table(spark, path).count() == 0 and read_day(spark, path, "2024-01-01").columns == ["x", "observation_date"]
    with pytest.raises(versions.ConcurrentCommit):
        versions.commit(spark, path, versions.current(spark, path))


def test_a_table_of_plain_day_folders_is_taken_over(spark, workdir):
    path = f"{workdir}/t"
    rows = spark.sql("SELECT id AS x, date_add(DATE '2024-01-01', CAST(id % 3 AS int)) AS observation_date FROM range(9)")
    rows.write.partitionBy("observation_date").parquet(path)
    replace_days(rows.where("observation_date = '2024-01-02'").selectExpr("x + 100 AS x", "observation_date"), path, "observation_date", ["2024-01-02"])
    schema = "x long, observation_date date"
    got = sorted(r.x for r in read_table(spark, path).collect())
    assert got == [0, 2, 3, 5, 6, 8, 101, 104, 107]
    assert sorted(r.x for r in read_days(spark, path, ["2024-01-01", "2024-01-02"], rows.schema).collect()) == [0, 3, 6, 101, 104, 107], schema
    for _ in range(3):
        replace_days(rows, path, "observation_date", ["2024-01-01", "2024-01-02", "2024-01-03"])
    assert sorted(r.x for r in read_table(spark, path).collect()) == list(range(9))
    assert not [f for f in Path(path).glob("observation_date=*/*.parquet")]


def test_winners_are_merged_by_levels(spark, workdir):
    path, rows = f"{workdir}/w", two_days(spark).cache()
    want = _rows(hourly_latest(rows.select(*RAW_COLUMNS)))
    n = 20
    for b in range(n):  # the last batches hold rows of hours long written
        append_batch(hourly_latest(rows.where(f"pmod(xxhash64(station_id, timestamp, ingestion_time), {n}) = {b}").select(*RAW_COLUMNS)), path, b, source_id="q")
        if b == 10:
            with pytest.raises(Interrupted):
                merge_levels(spark, path, [DAY, OTHER], hourly_latest, "q", 2, stop_after("written"))
        merge_levels(spark, path, [DAY, OTHER], hourly_latest, "q", 3)
        assert all(len(folders(path, d)) <= 2 * 3 + 2 for d in (DAY, OTHER))  # under three of each level
    assert _rows(hourly_latest(read_raw(spark, path).select(*RAW_COLUMNS))) == want
    stored = read_days(spark, path, [DAY], RAW_TABLE_SCHEMA)
    assert {f.split("observation_date=")[1][:10] for f in stored.inputFiles()} == {DAY}
    version = versions.current(spark, path)
    assert max(version.merged[DAY].values()) >= 2 and version.folded[DAY]["q"][0][0] == 0
    append_batch(rows, path, 0, source_id="elsewhere")  # batches of another query are left to it
    merge_levels(spark, path, [DAY], hourly_latest, "q", 2)
    assert ("elsewhere", 0) in versions.batches(spark, path, DAY)
    rows.unpersist()
