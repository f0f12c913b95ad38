"""Flight payloads normalised as they arrive: usable ones and rejects, each stored once.

Every micro-batch writes both tables under its number. A batch that ran before, wholly or in part,
replaces what it wrote then, so a restart neither loses nor repeats a record.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener
from pyspark.sql.types import IntegerType, StructField, StructType

from skyledger.operators.landing import judged, normalize_flights

FLIGHTS, REJECTED = "flights", "rejected"


def normalized_sink(
    stream: DataFrame, folder: str, checkpoint: str, with_delay: bool = True,
) -> DataStreamWriter:
    """Writer of both tables below `folder`; rejects keep all columns of the stream."""
    def store(batch: DataFrame, number: int) -> None:
        # the source is read, and a payload parsed, once for both tables
        kept = judged(batch, with_delay).persist()
        try:
            for name, rows in zip((FLIGHTS, REJECTED), normalize_flights(batch, with_delay),
                                  strict=True):
                rows.write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")
        finally:
            kept.unpersist()

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def stored(spark: SparkSession, folder: str, name: str, schema: StructType) -> DataFrame:
    """One of the two tables, with the number of the batch that stored a row."""
    with_batch = StructType([*schema.fields, StructField("batch", IntegerType())])
    return spark.read.schema(with_batch).parquet(f"{folder}/{name}")


@dataclass(frozen=True)
class Progress:
    """What the engine reported of one micro-batch that had rows."""

    query: str
    batch: int
    rows_in: int


class ProgressLog(StreamingQueryListener):
    """Keeps the progress of batches and how each query ended."""

    def __init__(self) -> None:
        self.batches: list[Progress] = []
        self._ended: dict[str, str | None] = {}
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        if progress.numInputRows:
            self.batches.append(
                Progress(str(progress.id), progress.batchId, progress.numInputRows))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._changed:
            self._ended[str(event.runId)] = event.exception
            self._changed.notify_all()

    def wait_for_end(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until the end of a run was reported; events come in order, so all progress is in."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError("the end of the query was not reported")


def drain(writer: DataStreamWriter, log: ProgressLog | None = None) -> StreamingQuery:
    """Run a query until all records that were there are stored, then stop it between batches.

    With a log, its progress is complete when this returns.
    """
    query = writer.trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    if log is not None:
        log.wait_for_end(query)
    return query


def run_batches(writer: DataStreamWriter, batches: int) -> StreamingQuery:
    """Run so many batches, each as large as the source allows, and stop between two of them."""
    for _ in range(batches):
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    return query
