"""Publishing through the outbox, and landing by the ledger: each message once, whatever is killed or replayed."""

import json
from pathlib import Path

import pytest

from stationlake.schemas import RAW_COLUMNS
from stationlake.sources import outbox
from stationlake.sources.messages import value_stream
from stationlake.sources.tables import read_raw
from stationlake.streaming import landing


class Killed(RuntimeError):
    pass


def killed_after(name):
    def step(at):
        if at == name:
            raise Killed(at)
    return step


def messages(spark, n, copies=1):
    rows = [(str(i), json.dumps({"fmisid": i, "timestamp": "2024-01-01T10:00:00", "ingestion_time": "2024-01-01T10:01:00"})) for i in range(n)]
    return spark.createDataFrame(rows * copies, "key string, value string")


def landed(spark, root):
    return sorted(r.station_id for r in read_raw(spark, f"{root}/raw").select(*RAW_COLUMNS).collect())


def drain(spark, root, files=2):
    q = landing.land_stream(value_stream(spark, "json", f"{root}/m", max_per_trigger=files, message_ids=True), f"{root}/raw", f"{root}/q", f"{root}/cp",
                            ledger=f"{root}/ledger")
    q.awaitTermination()


@pytest.mark.parametrize("stop", ["staged", "sent", "marked"])
def test_killed_publishing(spark, workdir, stop):
    (Path(workdir.removeprefix("file:")) / "m").mkdir(exist_ok=True)
    msgs = messages(spark, 12, copies=2)  # two equal messages are two messages
    with pytest.raises(Killed):
        outbox.publish(msgs, "json", f"{workdir}/m", f"{workdir}/o", "p", 0, step=killed_after(stop))
    drain(spark, workdir)  # what was sent so far
    # the rerun sees its source in another order, and rows that came since are not of this batch
    again = messages(spark, 15, copies=2).orderBy("value")
    assert outbox.publish(again, "json", f"{workdir}/m", f"{workdir}/o", "p", 0) == (stop != "marked")
    assert not outbox.publish(again, "json", f"{workdir}/m", f"{workdir}/o", "p", 0)
    drain(spark, workdir)
    assert landed(spark, workdir) == sorted(list(range(12)) * 2)


def test_a_retried_task_and_a_replayed_batch(spark, workdir):
    numbered = outbox.number_messages(messages(spark, 10), "p", 3)
    assert numbered.select("message_id").distinct().count() == 10
    assert sorted(r.message_id for r in numbered.collect()) == sorted(
        r.message_id for r in outbox.number_messages(messages(spark, 10).orderBy("key", ascending=False), "p", 3).collect())
    # the first half arrives twice in one micro-batch, and again in the next
    twice = numbered.union(numbered.limit(5))
    land = lambda df, n: landing.land_batch(df, n, f"{workdir}/raw", f"{workdir}/q", source_id="s", ledger=f"{workdir}/ledger")
    assert land(twice, 0)["accepted"] == 10 and land(numbered, 1)["accepted"] == 0
    assert landed(spark, workdir) == list(range(10))
    assert land(twice, 0)["accepted"] == 10  # a replay lands its own rows again, in their place
    assert landed(spark, workdir) == list(range(10))
    # the same messages of another batch are new, and messages without an id always land
    assert land(outbox.number_messages(messages(spark, 2), "p", 4), 2)["accepted"] == 2
    from pyspark.sql import functions as F

    assert land(messages(spark, 1, copies=2).withColumn("message_id", F.lit(None).cast("string")), 3)["accepted"] == 2
    with pytest.raises(ValueError):
        outbox.number_messages(messages(spark, 1), "a/b", 0)


def test_files_sent_do_not_grow_with_the_messages(spark, workdir):
    """A stream that takes some files a trigger needs no more micro-batches, each reading the ledger, for more messages."""
    (Path(workdir.removeprefix("file:")) / "m").mkdir(exist_ok=True)
    msgs = messages(spark, 60).repartition(6)
    staged = outbox.number_messages(msgs, "p", 0).repartition(6)
    staged.write.parquet(f"{workdir}/o/producer=p/batch=0/messages")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # every staged file is a task
    try:
        assert outbox.publish(msgs, "json", f"{workdir}/m", f"{workdir}/o", "p", 0, files=2)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert 1 <= len(list((Path(workdir.removeprefix("file:")) / "m").glob("part-*"))) <= 2
    drain(spark, workdir)
    assert landed(spark, workdir) == list(range(60))
