"""Starting live jobs and letting them run to the end of the data."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from millrace.session import work_dir
from millrace.sinks.files import show_item


def writer(items: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> DataStreamWriter:
    """A stream writer whose progress and state live in the shared folder.

    Give the same `checkpoint` again to go on after a stop; without one the job is a new one.
    """
    folder = checkpoint or work_dir(items.sparkSession, f"{name}-progress")
    return items.writeStream.outputMode(mode).option("checkpointLocation", folder)


def run_to_end(sink: DataStreamWriter) -> StreamingQuery:
    """Work off everything that is there, then stop. A failure is raised here."""
    query = sink.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_live(sink: DataStreamWriter, every: str = "1 second") -> StreamingQuery:
    """Keep going by processing time until `query.stop()`."""
    return sink.trigger(processingTime=every).start()


def run_until_idle(sink: DataStreamWriter, idle_seconds: float = 0, every: str = "100 milliseconds", longest: float = 600) -> StreamingQuery:
    """Work off everything that is there micro-batch by micro-batch, then stop; a failure is raised here.

    For sources that `availableNow` asks only once, and for jobs with timers: with `idle_seconds` the job goes on
    until a micro-batch without items began that long after the last one with items, so whatever falls due by
    then has come out. Longer than `longest` seconds without items in sight of an end is an error.
    """
    query = run_live(sink, every)
    try:
        if not idle_seconds:
            query.processAllAvailable()
            return query
        last, seen, until = None, -1, time.monotonic() + longest
        while True:
            if query.exception() is not None:
                raise query.exception()
            for progress in query.recentProgress:
                if progress["batchId"] < seen:
                    continue
                began = datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")).timestamp()
                if progress["numInputRows"]:
                    last, seen = began, progress["batchId"]
                    until = time.monotonic() + longest
                elif last is not None and began > last + idle_seconds:
                    return query
            if time.monotonic() > until:
                raise TimeoutError(f"not idle after {longest} s")
            time.sleep(0.05)
    finally:
        query.stop()


def live_tap(items: DataFrame, prefix: str) -> DataFrame:
    """Pass live items through and count them under `prefix`; a `TapCounts` adds them up."""
    return items.observe(prefix, F.count(F.lit(1)).alias("items"))


class TapCounts(StreamingQueryListener):
    """Adds up what live taps saw, batch by batch, from when it is listened to.

    Progress is heard as it happens, so totals do not depend on how many reports a query keeps. A
    batch that is reported again counts once.
    """

    def __init__(self, spark: SparkSession):
        self._seen: dict[tuple[str, str], dict[int, int]] = {}
        self._spark = spark
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for prefix, row in event.progress.observedMetrics.items():
            self._seen.setdefault((str(event.progress.id), prefix), {})[event.progress.batchId] = row["items"]

    def total(self, query: StreamingQuery, prefix: str, wait: float = 30.0) -> int:
        """Items that passed a tap of a query up to its last report."""
        last, until = query.lastProgress, time.monotonic() + wait
        while last is not None and prefix in last["observedMetrics"]:
            seen = self._seen.get((str(query.id), prefix), {})
            if last["batchId"] in seen:
                return sum(seen.values())
            if time.monotonic() > until:
                raise TimeoutError(f"no report of batch {last['batchId']} after {wait} s")
            time.sleep(0.05)
        return sum(self._seen.get((str(query.id), prefix), {}).values())

    def close(self) -> None:
        self._spark.streams.removeListener(self)


def print_live(items: DataFrame, show: Callable[[Row], None] = show_item) -> DataStreamWriter:
    """Print every item, on the output of the executor that holds it."""
    return writer(items, "print").foreach(show)


def preview_live(items: DataFrame, count: int = 20) -> DataStreamWriter:
    """Print only the first items of each micro-batch, on the driver."""
    return writer(items, "print").format("console").option("numRows", count).option("truncate", False)
