"""What a running stream holds and drops: its state as a table, and a table of its progress.

* :func:`state_rows` reads the windows that a checkpointed query still keeps,
  with their partial sums, through Spark's state data source.
* :class:`ProgressLog` is a ``StreamingQueryListener`` that keeps every progress
  event (``recentProgress`` keeps the last 100) and writes them to a table:
  watermark, input rows, and rows dropped behind the watermark.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..config import DEFAULT, AlertSettings
from ..operators.windows import sum_type


def state_rows(
    spark: SparkSession,
    checkpoint: str,
    settings: AlertSettings = DEFAULT,
    by_sensor: bool = False,
    value: T.DataType | None = None,
    batch_id: int | None = None,
) -> DataFrame:
    """Windows in the state of an averages query: ``window, [sensor_id], sum_<m>, count_<m>...``, as of its last batch.

    ``value`` is the type of the readings' values (INT by default), ``batch_id``
    an earlier batch whose state is still kept. Partitions of the state are read
    in parallel; the query itself need not run.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    kind = sum_type(value or T.IntegerType())
    if kind.startswith("DECIMAL"):
        kind = "DECIMAL(30, 0)"  # what a sum of it is
    # the buffers come in the order of the aggregates, under Spark's own names
    fields = ", ".join(f"sum_{m}: {kind}, count_{m}: BIGINT" for m in settings.measures)
    key = ["window", *(["sensor_id"] if by_sensor else [])]
    types = "window: STRUCT<start: TIMESTAMP, end: TIMESTAMP>" + (", sensor_id: INT" if by_sensor else "")
    raw = reader.load(checkpoint).selectExpr(f"CAST(key AS STRUCT<{types}>) AS key", f"CAST(value AS STRUCT<{fields}>) AS value")
    return raw.selectExpr(*[f"key.{k}" for k in key], "value.*")


PROGRESS_SCHEMA = (
    "run_id string, batch_id long, watermark timestamp, input_rows long, dropped_rows long, state_rows long, millis long"
)


class ProgressLog(StreamingQueryListener):
    """Every progress event of the queries it watches, written to ``path`` in pieces of ``every`` events.

    Use as a context around the queries' start and end::

        with ProgressLog(spark, path) as log:
            start(...).awaitTermination()
        log.table()

    Only queries whose name or id is in ``watch`` are logged (all without).
    """

    def __init__(self, spark: SparkSession, path: str, watch: set[str] | None = None, every: int = 1_000):
        self.spark, self.path, self.watch, self.every = spark, path, watch, every
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.watch is not None and not self.watch & {p.name, str(p.id)}:
            return
        mark = (p.eventTime or {}).get("watermark")
        ops = p.stateOperators
        row = (
            str(p.runId), p.batchId, mark, p.numInputRows,
            sum(o.numRowsDroppedByWatermark for o in ops), sum(o.numRowsTotal for o in ops), p.batchDuration,
        )
        with self._lock:
            self._rows.append(row)
            full = self._rows if len(self._rows) >= self.every else None
            if full:
                self._rows = []
        if full:
            self._write(full)

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))

    def _write(self, rows: list[tuple]) -> None:
        text = PROGRESS_SCHEMA.replace("watermark timestamp", "watermark string")
        table = self.spark.createDataFrame(rows, text).selectExpr(
            "run_id", "batch_id", "CAST(watermark AS TIMESTAMP) AS watermark", "input_rows", "dropped_rows", "state_rows", "millis"
        )
        table.coalesce(1).write.mode("append").parquet(self.path)

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the events of an ended query are here: Spark delivers them in order, behind the query's end."""
        until = time.monotonic() + seconds
        while str(query.runId) not in self._ended:
            if time.monotonic() > until:
                raise TimeoutError(f"no end of query run {query.runId} within {seconds} s")
            time.sleep(0.02)

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self._write(rows)

    def table(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)

    def __enter__(self) -> "ProgressLog":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self.flush()
