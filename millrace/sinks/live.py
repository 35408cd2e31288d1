"""A live sink with code of one's own: each micro-batch counts once, under its number."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter
from pyspark.sql.streaming import DataStreamWriter

from millrace.sinks.files import ItemSink, ItemWriter, Written, _listed
from millrace.streaming.run import writer


class LiveItemWriter(DataSourceStreamArrowWriter):
    """Files of one job's micro-batches. A batch counts by a list named after the job and the batch number,
    so a batch that is delivered again replaces what it wrote before."""

    def __init__(self, path: str, job: str):
        self.path, self.job = path, job
        self._pieces = ItemWriter(path, overwrite=False)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self._pieces.write(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        files, root = pafs.FileSystem.from_uri(self.path)
        files.create_dir(root, recursive=True)
        name = f"{root}/_committed-{self.job}-{batchId:012d}"
        before = _listed(files, name) if files.get_file_info(name).is_file else []
        done = {m.name: m.items for m in messages if m and m.name}
        draft = f"{root}/_draft-{self.job}-{batchId:012d}"
        with files.open_output_stream(draft) as out:
            out.write("\n".join(f"{piece} {items}" for piece, items in done.items()).encode())
        files.move(draft, name)  # one step: either list counts, never both
        for piece, _ in before:
            if piece not in done and files.get_file_info(f"{root}/{piece}").is_file:
                files.delete_file(f"{root}/{piece}")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._pieces.abort(messages)


class LiveItemSink(ItemSink):
    """`ItemSink` for streams. Options: `path`, a URI that all executors share, and `job`, a name that stays the
    same when the job goes on. Subclass it for a sink of your own."""

    @classmethod
    def name(cls) -> str:
        return "millrace_live_sink"

    def streamWriter(self, schema, overwrite: bool) -> LiveItemWriter:
        return LiveItemWriter(self.options["path"], self.options["job"])


def write_custom_live(items: DataFrame, sink: type[DataSource], checkpoint: str | None = None, **options: object) -> DataStreamWriter:
    """A stream writer into a Python sink class; `read_written` gives what has been committed."""
    items.sparkSession.dataSource.register(sink)
    return writer(items, "custom-sink", checkpoint=checkpoint).format(sink.name()).options(**options)
