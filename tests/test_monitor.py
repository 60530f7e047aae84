"""The listener's log, restarts, and giving up."""

import pytest

from stationlake.streaming import monitor


def rate(spark, workdir, n=3):
    for i in range(n):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.parquet(f"{workdir}/in/{i}")
    return spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{workdir}/in/*")


def starter(spark, workdir, write):
    stream = rate(spark, workdir)
    return lambda: stream.writeStream.option("checkpointLocation", f"{workdir}/cp").trigger(availableNow=True).foreachBatch(write).start()


@pytest.mark.parametrize("after", [True, False])
def test_a_failed_batch_is_tried_again_and_lands_once(spark, workdir, after):
    def put(df, n):
        df.write.mode("overwrite").parquet(f"{workdir}/out/batch={n}")

    seen = monitor.RunLog()
    spark.streams.addListener(seen)
    try:
        start = starter(spark, workdir, monitor.failing_once(put, [0, 2], after))
        assert monitor.supervise(start, attempts=3, wait_seconds=0, run_log=seen) == 2
    finally:
        spark.streams.removeListener(seen)
    assert sorted(r.id for r in spark.read.parquet(f"{workdir}/out").collect()) == list(range(30))
    log = seen.frame(spark).cache()
    assert [r.batch_id for r in log.where("event = 'progress' AND input_rows > 0").orderBy("batch_id").collect()] == [0, 1, 2]
    errors = [r.error for r in log.where("event = 'ended'").collect()]
    assert len(errors) == 3 and sum(e is not None for e in errors) == 2
    assert all("logOffset" in r.end_offset for r in log.where("event = 'progress' AND input_rows > 0").collect())
    n = seen.flush(spark, f"{workdir}/log")
    assert n == log.count() == spark.read.parquet(f"{workdir}/log").count() and seen.flush(spark, f"{workdir}/log") == 0


def test_giving_up_raises_the_error(spark, workdir):
    def never(df, n):
        raise monitor.Injected("always")

    with pytest.raises(Exception, match="always"):
        monitor.supervise(starter(spark, workdir, never), attempts=2, wait_seconds=0)
