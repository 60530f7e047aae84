"""Physical-plan checks: pushdown, pruning, partial aggregation, no pairing joins, no Python."""

import contextlib
import io

import pytest

from stationlake.plans import queries as Q
from stationlake.plans.stored import STORED_QUERIES
from stationlake.plans.streams import STREAM_QUERIES
from tests.conftest import SF_SMALL

PURE = sorted(set(Q.queries()) - set(STREAM_QUERIES) - set(STORED_QUERIES))


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", PURE)
def test_no_pairing_joins_or_python(spark, name):
    p = plan(Q.queries()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, f"{name}: {bad}"


def test_day_filter_is_pushed_to_the_scan(spark):
    p = plan(Q.q_daily_observations_day(spark, SF_SMALL))
    scan = [line for line in p.splitlines() if line.strip().startswith("PushedFilters")]
    assert any("GreaterThanOrEqual(ts" in s and "LessThan(ts" in s for s in scan), scan


def test_scan_reads_only_needed_columns(spark):
    p = plan(Q.q_daily_summary(spark, SF_SMALL))
    schemas = [line for line in p.splitlines() if "ReadSchema" in line]
    assert schemas and all("event_id" not in s for s in schemas)


def test_top1_is_limited_before_the_shuffle(spark):
    p = plan(Q.q_latest_per_station_hour(spark, SF_SMALL))
    assert p.count("WindowGroupLimit") >= 2   # partial (map side) and final


def test_aggregations_are_partial_before_the_shuffle(spark):
    p = plan(Q.q_daily_summary(spark, SF_SMALL))
    assert "partial_avg" in p and "partial_stddev_samp" in p


def test_registered_queries_shuffle_no_source_round_robin(spark):
    for name in PURE:
        assert "RoundRobinPartitioning" not in plan(Q.queries()[name](spark, SF_SMALL)), name


def test_history_merge_prunes_by_constant_dates(spark, workdir):
    from stationlake.operators import history as hist

    daily = Q._daily(spark, SF_SMALL)
    rows = hist.history_rows(daily, "2024-02-01 01:00:00")
    rows.write.partitionBy("observation_date").parquet(f"{workdir}/h")
    old = spark.read.schema(rows.schema).parquet(f"{workdir}/h")
    p = plan(hist.merge_history(old, old, "2024-01-16", "2024-01-30"))
    filters = [line for line in p.splitlines() if "PartitionFilters" in line]
    assert len(filters) == 3 and all("2024-01-16" in f for f in filters)
    assert p.count("Exchange hashpartitioning") <= 2  # the upsert window alone (the plan is printed with its node list)
