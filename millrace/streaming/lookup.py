"""Looking live items up in a side table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.lookup import Measured, lookup, measured, service_side
from millrace.streaming.routing import BatchSink
from millrace.streaming.run import writer


class Snapshot:
    """A service as it was when it last changed: read, measured and, if it is small, kept once."""

    def __init__(self, service: Callable[[], DataFrame], key: str, take: Sequence[str]):
        self._service, self._key, self._take = service, key, list(take)
        self._mark: tuple | None = None
        self._held: tuple[DataFrame, Measured] | None = None
        #: How often the service was read.
        self.readings = 0

    def _files(self, found: DataFrame) -> tuple | None:
        """Names, sizes and times of the service's files; None if it is not made of files alone."""
        names: list[str] = []
        leaves = found._jdf.queryExecution().analyzed().collectLeaves()  # what is cached does not show here
        for place in range(leaves.size()):
            try:
                names += leaves.apply(place).relation().location().inputFiles()
            except Exception:  # a leaf that is no table of files has none of these
                return None
        spark = found.sparkSession
        conf, path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
        states = []
        for name in sorted(names):
            status = path(name).getFileSystem(conf).getFileStatus(path(name))
            states.append((name, status.getLen(), status.getModificationTime()))
        return tuple(states)

    def now(self) -> tuple[DataFrame, Measured]:
        """The service's side of a lookup and its measure, made anew only if a file has changed."""
        found = self._service()
        mark = self._files(found)
        if mark is None or mark != self._mark or self._held is None:
            self.forget()
            side = service_side(found, self._key, self._take)
            size = measured(side, "_service_key")
            self.readings += 1
            if mark is not None and size.fits():
                side = side.persist(StorageLevel.MEMORY_AND_DISK)
            self._mark, self._held = mark, (side, size)
        return self._held

    def forget(self) -> None:
        if self._held is not None:
            self._held[0].unpersist()
        self._mark, self._held = None, None


def lookup_reset(
    items: DataFrame,
    service: Callable[[], DataFrame],
    key: str,
    service_key: str,
    take: Sequence[str],
    sink: BatchSink,
    checkpoint: str | None = None,
    snapshot: Snapshot | None = None,
) -> DataStreamWriter:
    """Look up each micro-batch in a service, so that a changed table is seen from the next batch on.

    Before each batch `service()` is asked for its table, and the names, sizes and times of its files are
    compared. Only if they differ, or the table is not made of files alone, is it read and measured again.
    """
    snapshot = snapshot or Snapshot(service, service_key, take)

    def deliver(batch: DataFrame, number: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            side, size = snapshot.now()
            sink(lookup(kept, side, key, "_service_key", take, size=size), number)
        finally:
            kept.unpersist()

    return writer(items, "lookup", checkpoint=checkpoint).foreachBatch(deliver)
