"""Watching and restarting streams.

``RunLog`` is a query listener: every micro-batch's rows, offsets and duration, and every end of a query with its
error, become rows of a log. ``supervise`` is the endless loop of a service: it starts a query, waits for
its end, and starts it again from its checkpoint when it failed, so the batch that failed is tried
again. ``failing_once`` makes a batch writer fail on demand, for tests of both.
"""

from __future__ import annotations

import json
import logging
import threading
import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)

LOG_SCHEMA = ("query string, run string, event string, batch_id long, at string, input_rows long, duration_ms long, "
              "start_offset string, end_offset string, error string")


class RunLog(StreamingQueryListener):
    """Progress, starts and ends of the queries of a session, in order of arrival.

    At most ``keep`` events are held; ``flush`` appends them to a table and forgets them.
    """

    def __init__(self, keep: int = 100_000):
        self.events: list[tuple] = []
        self.keep = keep
        self._ended: set[str] = set()
        self._lock = threading.Condition()

    def _add(self, *event) -> None:
        with self._lock:
            self.events.append(event)
            del self.events[:-self.keep]
            if event[2] == "ended":
                self._ended.add(event[1])
            self._lock.notify_all()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._add(str(event.id), str(event.runId), "started", None, event.timestamp, None, None, None, None, None)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        one = lambda which: json.dumps([getattr(s, which) for s in p.sources])
        self._add(str(p.id), str(p.runId), "progress", p.batchId, p.timestamp, p.numInputRows, p.batchDuration,
                  one("startOffset"), one("endOffset"), None)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        error = event.exception.split("\n")[0][:500] if event.exception else None
        self._add(str(event.id), str(event.runId), "ended", None, None, None, None, None, None, error)

    def wait_for(self, run: str, seconds: float = 30.0) -> bool:
        """Whether the end of a run has been reported; listeners hear of it a little after the query knows."""
        with self._lock:
            return self._lock.wait_for(lambda: run in self._ended, seconds)

    def frame(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            return spark.createDataFrame(list(self.events), LOG_SCHEMA)

    def flush(self, spark: SparkSession, path: str) -> int:
        """Append what is held to the log table at ``path``."""
        with self._lock:
            held, self.events = self.events, []
        if held:
            spark.createDataFrame(held, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        return len(held)


def supervise(start: Callable[[], StreamingQuery], attempts: int | None = None, wait_seconds: float = 5.0,
              run_log: RunLog | None = None) -> int:
    """Run a query to its end, starting it again from its checkpoint after each failure; the number of failures.

    ``attempts`` limits the failures in a row without any new batch between (None: goes on for ever); the last error
    is raised. A stopped query ends the loop.
    """
    failures = in_a_row = 0
    last_batch = None
    while True:
        query = start()
        try:
            query.awaitTermination()
            return failures
        except Exception as error:
            failures += 1
            progress = query.lastProgress
            batch = progress["batchId"] if progress else None
            in_a_row = 1 if batch != last_batch and batch is not None else in_a_row + 1
            last_batch = batch
            log.warning("query %s failed (%s in a row): %s", query.id, in_a_row, str(error).split("\n")[0][:300])
            if attempts is not None and in_a_row >= attempts:
                raise
            time.sleep(wait_seconds)
        finally:
            if run_log is not None:
                run_log.wait_for(str(query.runId))


class Injected(RuntimeError):
    """An error made on demand."""


def failing_once(write: Callable[[DataFrame, int], None], batches: Iterable[int], after: bool = True) -> Callable[[DataFrame, int], None]:
    """A batch writer that fails the first time for each of ``batches``, after writing (the batch is not committed) or
    before."""
    left = set(batches)

    def run(batch: DataFrame, batch_id: int) -> None:
        fail = batch_id in left
        left.discard(batch_id)
        if fail and not after:
            raise Injected(f"batch {batch_id}")
        write(batch, batch_id)
        if fail:
            raise Injected(f"batch {batch_id}")

    return run
