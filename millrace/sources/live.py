"""A live source with code of one's own: an `ItemSource` over files that keep arriving in a folder.

The driver plans batches: the names of the files of batch n are written down before the batch is read, and
the stream's offset is n. A batch that was not committed is read again from the same files, so a restart
loses and repeats nothing.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.sources.sharded import ItemSource

MAX_FILES = 1_000


@dataclass
class Arrived(InputPartition):
    """One file of a planned batch."""

    name: str


class Plan:
    """The files of each batch, one small list per batch, in a folder that outlives the job."""

    def __init__(self, folder: str):
        self._files, self._root = pafs.FileSystem.from_uri(folder)
        self._files.create_dir(self._root, recursive=True)

    def _name(self, batch: int) -> str:
        return f"{self._root}/{batch:012d}.json"

    def batches(self) -> list[int]:
        found = self._files.get_file_info(pafs.FileSelector(self._root))
        return sorted(int(info.base_name[:-5]) for info in found if info.base_name.endswith(".json"))

    def read(self, batch: int) -> list[str]:
        with self._files.open_input_stream(self._name(batch)) as stream:
            return json.loads(stream.read())

    def write(self, batch: int, names: list[str]) -> None:
        """Whole or not at all: the list gets its name when it is complete."""
        draft = self._name(batch) + ".draft"
        with self._files.open_output_stream(draft) as stream:
            stream.write(json.dumps(names).encode())
        self._files.move(draft, self._name(batch))


class LiveReader(DataSourceStreamReader):
    """Offsets are numbers of planned batches."""

    def __init__(self, source: type[ItemSource], arguments: Mapping[str, object], options: Mapping[str, str], schema: StructType):
        self._source, self._arguments, self._schema = source, dict(arguments), schema
        self._path, self._plan_folder = options["path"], options["plan"]
        self._max_files = int(options.get("max_files", MAX_FILES))
        self._seen: set[str] | None = None
        self._last = 0

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def latestOffset(self) -> dict:
        """Plan one more batch if files wait. Called once before each batch."""
        plan = Plan(self._plan_folder)
        if self._seen is None:
            known = plan.batches()
            self._last = max(known, default=0)
            self._seen = {name for batch in known for name in plan.read(batch)}
        waiting = [name for name in arrived(self._path) if name not in self._seen][: self._max_files]
        if waiting:
            self._last += 1
            plan.write(self._last, waiting)
            self._seen.update(waiting)
        return {"batch": self._last}

    def partitions(self, start: dict, end: dict) -> list[Arrived]:
        plan = Plan(self._plan_folder)
        return [Arrived(name) for batch in range(start["batch"] + 1, end["batch"] + 1) for name in plan.read(batch)]

    def read(self, partition: Arrived) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(self._path)
        target = to_arrow_schema(self._schema)
        instance = self._source(**self._arguments)
        instance.init(TaskContext.get().partitionId())
        with files.open_input_file(f"{root}/{partition.name}") as stream:
            for batch in pq.ParquetFile(stream).iter_batches(columns=target.names):
                found = instance.items(batch)
                yield pa.RecordBatch.from_arrays([found.column(f.name).cast(f.type) for f in target], schema=target)


def arrived(path: str) -> list[str]:
    """The parquet files of a folder, the oldest first; names with _ or . in front are not looked at."""
    files, root = pafs.FileSystem.from_uri(path)
    found = files.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    whole = [i for i in found if i.is_file and i.base_name.endswith(".parquet") and i.base_name[0] not in "_."]
    return [i.base_name for i in sorted(whole, key=lambda i: (i.mtime_ns or 0, i.base_name))]


def read_custom_live(
    spark: SparkSession,
    source: type[ItemSource],
    path: str,
    schema: StructType | str,
    plan: str,
    max_files: int = MAX_FILES,
    **arguments: object,
) -> DataFrame:
    """Items of a Python source class over a growing folder of parquet files, without end.

    `path` and `plan` are folders that driver and executors share; `plan` belongs to one job and must be given
    again when the job goes on. A micro-batch takes in at most `max_files` files, after a restart at most
    one planned batch more. `arguments` go to the class, one instance of which reads each file.
    Run it with `run_live` or `run_until_idle`: the trigger `availableNow` asks a Python source only once.
    """

    class Live(DataSource):
        @classmethod
        def name(cls) -> str:
            return f"millrace_live_{source.__name__.lower()}"

        def streamReader(self, schema: StructType) -> LiveReader:
            return LiveReader(source, arguments, self.options, schema)

    spark.dataSource.register(Live)
    reader = spark.readStream.format(Live.name()).schema(schema)
    return reader.options(path=path, plan=plan, max_files=max_files).load()
