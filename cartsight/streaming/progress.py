"""What a running query did, batch by batch, and an orderly stop."""

import time
from collections.abc import Callable
from datetime import datetime
from queue import Empty, SimpleQueue
from threading import Event

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cartsight.streaming.tables import write_batch

PROGRESS = "run_id STRING, started TIMESTAMP, n_input BIGINT, duration_ms BIGINT, phase_ms MAP<STRING, BIGINT>"
#: Seconds that a stop waits for the batch under way, and for the last events after the end.
GRACE, LAST_EVENTS = 600.0, 30.0
POLL = 0.5


class BatchProgress(StreamingQueryListener):
    """Collects the batches of one run of one query; idle triggers and other queries do not count."""

    def __init__(self, query: StreamingQuery):
        self.run_id = str(query.runId)
        self.waiting: SimpleQueue = SimpleQueue()
        self.ended = Event()

    def add(self, progress) -> None:
        if str(progress.runId) == self.run_id and "addBatch" in progress.durationMs:
            self.waiting.put(progress)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.add(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.ended.set()

    def write(self, spark: SparkSession, table: str) -> int:
        """Write a row for each batch that waits; how many there were.

        The rows are written by the thread that waits for the query, so that a
        failure reaches it and the event thread is not held up.  A batch that is
        reported twice, or replayed, overwrites its row.
        """
        written = 0
        while True:
            try:
                p = self.waiting.get_nowait()
            except Empty:
                return written
            row = (str(p.runId), datetime.fromisoformat(p.timestamp), p.numInputRows, p.batchDuration, dict(p.durationMs))
            write_batch(spark.createDataFrame([row], PROGRESS), table, p.batchId)
            written += 1


def stop_after_batch(query: StreamingQuery, grace: float = GRACE) -> None:
    """Stop between two batches.

    After ``grace`` seconds, or where batches follow without a pause, the one under
    way is interrupted; the next start replays it, and it overwrites what it wrote.
    """
    until = time.monotonic() + grace
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(POLL / 10)
    query.stop()


def run_logged(
    spark: SparkSession, query: StreamingQuery, table: str, until: Callable[[int], bool] | None = None, timeout: float | None = None
) -> bool:
    """Wait for ``query`` and write ``PROGRESS`` of each of its batches to ``table``; whether it ended.

    Once ``until``, given the number of batches so far, is true, the query is
    stopped after the batch under way.  After ``timeout`` seconds the query goes
    on and this returns False.  A failure of the query is raised, after its
    batches are written.
    """
    log, batches = BatchProgress(query), 0
    limit = None if timeout is None else time.monotonic() + timeout
    spark.streams.addListener(log)
    try:
        for progress in query.recentProgress:  # batches that were done before the listener came
            log.add(progress)
        ended = False
        while not ended and (limit is None or time.monotonic() < limit):
            try:
                ended = bool(query.awaitTermination(POLL))
            finally:
                if not query.isActive:
                    log.ended.wait(LAST_EVENTS)
                batches += log.write(spark, table)
            if not ended and until is not None and until(batches):
                stop_after_batch(query)
        return ended
    finally:
        spark.streams.removeListener(log)
