"""What each batch of a stream read, as a table of its own."""

from __future__ import annotations

import threading
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from netsift.sinks.tables import write_batch

SCHEMA = "rows bigint, malformed bigint, missing_src_ip bigint, rejected bigint, input_rows bigint, millis bigint"


class ProgressLog(StreamingQueryListener):
    """Stores the observed metrics of every batch, and tells of batches that it could not store.

    Spark calls a listener on the thread that serves all of them, so the rows are
    written on a thread of this log's own. A batch owns its folder below that of its
    query (``query``, ``batch_id``), so a batch that is replayed leaves one row, and a
    stream with a new checkpoint leaves the old rows alone. Triggers without data
    observe nothing and leave none.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "flows"):
        self.spark, self.path, self.name = spark, path, name
        self.pool = ThreadPoolExecutor(1)
        self.tasks: list[Future] = []
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        seen = (progress.observedMetrics or {}).get(self.name)
        if seen is not None and seen["rows"]:
            counts = [seen[c] for c in ("rows", "malformed", "missing_src_ip", "rejected")]
            row = (*counts, progress.numInputRows, progress.batchDuration)
            self.tasks.append(self.pool.submit(self._store, row, str(progress.id), progress.batchId))

    def _store(self, row: tuple, query: str, batch_id: int) -> None:
        rows = self.spark.createDataFrame([row], SCHEMA)
        write_batch(rows, f"{self.path}/query={query}", batch_id, dated=False, small=True)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.set()

    def close(self, timeout: float = 120.0) -> None:
        """Wait for the end of the query and for all rows; raises what went wrong with any of them."""
        if not self.ended.wait(timeout):
            raise TimeoutError("the query has not told of its end")
        for task in self.tasks:
            task.result(timeout)
        self.pool.shutdown()
