"""Where items end up."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from millrace.operators.routing import QUEUE

ITEMS_PER_FILE = 5_000_000


def write_json(items: DataFrame, path: str, keys: Sequence[str] | None = None) -> None:
    """Write items, or only some keys of them, as JSON lines."""
    chosen = items.select(*keys) if keys else items
    chosen.write.mode("overwrite").option("maxRecordsPerFile", ITEMS_PER_FILE).json(path)


def write_queues(labelled: DataFrame, path: str) -> None:
    """Write every queue of a labelled stream to its own folder, reading the input once.

    Each task writes its own rows, so a queue that holds most of them needs no shuffle.
    """
    writer = labelled.write.mode("overwrite").option("maxRecordsPerFile", ITEMS_PER_FILE)
    writer.partitionBy(QUEUE).parquet(path)


def show_item(row: Row) -> None:
    print(row.asDict(), flush=True)


def print_items(items: DataFrame, show: Callable[[Row], None] = show_item) -> None:
    """Print every item, where it is: on the output of the executor that holds it."""
    items.foreach(show)


def preview_items(items: DataFrame, count: int = 20) -> None:
    """Print only the first items, on the driver."""
    items.show(count, truncate=False)


def collect_items(items: DataFrame, at_most: int) -> list[Row]:
    """Bring items to the driver; more than `at_most` of them is an error rather than a cut."""
    found = items.limit(at_most + 1).collect()
    if len(found) > at_most:
        raise ValueError(f"more than {at_most} items to collect")
    return found


def run_terminal(items: DataFrame) -> None:
    """Run a chain only for its side effects; nothing is kept."""
    items.write.format("noop").mode("overwrite").save()


@dataclass
class Written(WriterCommitMessage):
    name: str
    items: int


@dataclass
class Piece(InputPartition):
    """A committed file."""

    name: str


def _commits(files: pafs.FileSystem, root: str) -> list[str]:
    """The commit lists of all write jobs; each names the files of its own job."""
    found = files.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    return sorted(info.path for info in found if info.base_name.startswith("_committed-"))


def _listed(files: pafs.FileSystem, commit: str) -> list[tuple[str, int]]:
    with files.open_input_stream(commit) as found:
        lines = found.read().decode().splitlines()
    return [(name, int(count)) for name, count in (line.split(" ") for line in lines)]


class ItemWriter(DataSourceArrowWriter):
    """One write job: its files carry the job's id, and count once its commit list is there."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = pafs.FileSystem.from_uri(self.path)
        files.create_dir(root, recursive=True)
        task = TaskContext.get()
        name = f"part-{self.job}-{task.partitionId():05d}-{task.taskAttemptId()}.arrow"
        count, sink = 0, None
        try:
            for batch in iterator:
                if sink is None:
                    stream = files.open_output_stream(f"{root}/{name}")
                    sink = pa.ipc.new_stream(stream, batch.schema)
                sink.write_batch(batch)
                count += batch.num_rows
        except BaseException:
            if sink is not None:
                stream.close()
                files.delete_file(f"{root}/{name}")
            raise
        if sink is None:
            return Written("", 0)
        sink.close()
        stream.close()
        return Written(name, count)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = pafs.FileSystem.from_uri(self.path)
        files.create_dir(root, recursive=True)
        before = _commits(files, root) if self.overwrite else []
        listed = [f"{done.name} {done.items}" for done in messages if done and done.name]
        with files.open_output_stream(f"{root}/_committed-{self.job}") as out:
            out.write("\n".join(listed).encode())
        for commit in before:  # what an overwrite replaces stops counting before its files go
            names = [name for name, _ in _listed(files, commit)]
            files.delete_file(commit)
            for name in names:
                files.delete_file(f"{root}/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        files, root = pafs.FileSystem.from_uri(self.path)
        for done in messages:
            if done and done.name:
                files.delete_file(f"{root}/{done.name}")


class ItemReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Piece]:
        return [Piece(name) for name in committed_counts(self.path)]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(self.path)
        if partition is None or not partition.name:
            return
        with files.open_input_stream(f"{root}/{partition.name}") as stream:
            yield from pa.ipc.open_stream(stream)


class ItemSink(DataSource):
    """A sink written in Python: Arrow files, and for each write job a list of those that count.
    Option: `path`, a URI that all executors share. Subclass it for a sink of your own."""

    @classmethod
    def name(cls) -> str:
        return "millrace_sink"

    def writer(self, schema, overwrite: bool) -> ItemWriter:
        return ItemWriter(self.options["path"], overwrite)

    def reader(self, schema) -> ItemReader:
        return ItemReader(self.options["path"])


def write_custom(items: DataFrame, sink: type[DataSource], mode: str = "append", **options: object) -> None:
    """Write items with a Python sink class: added to what is there, or in its place (`overwrite`)."""
    items.sparkSession.dataSource.register(sink)
    items.write.format(sink.name()).mode(mode).options(**options).save()


def read_written(spark: SparkSession, sink: type[DataSource], schema: str, **options: object) -> DataFrame:
    """The items that a sink class has committed; `schema` is that of the items written."""
    spark.dataSource.register(sink)
    return spark.read.format(sink.name()).schema(schema).options(**options).load()


def committed_counts(path: str) -> dict[str, int]:
    """Files of an `ItemSink` that count, with their items."""
    files, root = pafs.FileSystem.from_uri(path)
    return {name: count for commit in _commits(files, root) for name, count in _listed(files, commit)}
