"""End to end on the driver's test tables: messages → landing stream → nightly job → views and SQL.

Usage: python examples/end_to_end.py [sf_dir] [work_dir]
(work_dir defaults to a fresh folder under spark.checkpoint.dir)
"""

from __future__ import annotations

import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationlake import get_session, shared_dir  # noqa: E402
from stationlake.operators import views  # noqa: E402
from stationlake.plans.daily_job import Layout, register_views, run_days  # noqa: E402
from stationlake.sources.fixtures import messages_from_events, read_source  # noqa: E402
from stationlake.sources.messages import value_stream  # noqa: E402
from stationlake.sources.tables import read_raw  # noqa: E402
from stationlake.streaming.landing import land_stream  # noqa: E402


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 16)
    root = argv[1] if len(argv) > 1 else shared_dir(spark, "example")
    lay = Layout(root)

    # 1. a message feed: one JSON message per line, files in the order of arrival
    feed = lay.path("feed")
    messages_from_events(read_source(spark, sf_dir, "events"), arrival_ordered=True).select("value").write.text(feed)

    # 2. the consumer: land everything available, 2 files per micro-batch
    q = land_stream(value_stream(spark, "text", feed, max_per_trigger=2), lay.raw, lay.quarantine,
                    lay.path("_checkpoints/landing"))
    q.awaitTermination()
    print("landed", read_raw(spark, lay.raw).count(), "rows in", len(q.recentProgress), "micro-batches")

    # 3. the nightly job over every landed day
    done = run_days(spark, lay, run_ts=dt.datetime(2024, 2, 1, 1))
    print("nightly job:", len(done["days"]), "days,", done["rows"])

    # 4. a dashboard view and a SQL query over the stored tables
    day = "2024-01-15"
    latest = views.latest_by_station(read_raw(spark, lay.raw).where(f"observation_date = '{day}'"))
    views.overview_kpis(latest).show()
    register_views(spark, lay)
    spark.sql(f"""SELECT report_date, active_stations, total_observations, avg_completeness_score,
                         overall_quality_rating FROM quality_report
                  WHERE report_date = DATE '{day}'""").show()
    spark.sql("SELECT reject_reason, count(*) AS n FROM quarantine GROUP BY reject_reason ORDER BY n DESC").show()


if __name__ == "__main__":
    main(sys.argv[1:])
