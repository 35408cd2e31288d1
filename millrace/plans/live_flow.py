"""A `Flow` over live streams: the same processes, planned into streaming queries.

Column steps stay part of a query's plan. A `Keyed` step keeps what it carries in the state store. A `CreateId`
step ends a stage: a query of its own numbers each micro-batch from where the batch before it ended and
publishes it as a folder, and what follows reads those folders as its stream. All queues and outputs that are
asked for leave the last stage in one query.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.operators.routing import QUEUE
from millrace.plans.flow import CreateId, Flow, Keyed
from millrace.streaming.keyed import keyed_live
from millrace.streaming.numbering import numbered_stage, stage_items
from millrace.streaming.run import run_live, writer


@dataclass
class Stage:
    """A query that ends in a table which later stages read."""

    name: str
    start: Callable[[], DataStreamWriter]


class LiveFlow(Flow):
    """Named live streams of one job.

    Declare processes as on a `Flow`. `path` is the job's own folder below the shared one: progress, state and
    stages lie there, and the same processes over the same `path` go on where the job stopped. `groups`
    is the number of groups that keys are dealt into; it stays for the job's life.
    """

    def __init__(
        self,
        streams: dict[str, DataFrame],
        path: str,
        queues: str = "",
        services: dict[str, DataFrame] | None = None,
        groups: int = 64,
    ):
        super().__init__(streams, queues, services)
        still = [name for name, items in streams.items() if not items.isStreaming]
        if still:
            raise ValueError(f"{still} are no streams: give tables as services")
        self.path, self._groups = path.rstrip("/"), groups
        self.stages: list[Stage] = []

    def _keyed(self, items: DataFrame, key: str, order: list[str], step: Keyed) -> DataFrame:
        return keyed_live(items, key, order, step.process, step.schema, step.carries, self._groups)

    def _numbered(self, process: str, items: DataFrame, step: CreateId) -> DataFrame:
        name = f"{len(self.stages):02d}-{process}"
        place, progress = f"{self.path}/{name}", f"{self.path}/{name}-progress"
        self.stages.append(Stage(name, lambda: numbered_stage(items, step.order, place, step.name, progress)))
        return stage_items(items, place, step.name)

    def sink(self, process: str) -> DataStreamWriter:
        """Everything a process wrote to declared queues, each queue to its own folder below `path`/queues, exactly
        once; all in one query."""
        labelled = writer(self.written(process), "queues", checkpoint=f"{self.path}/{process}-queues-progress")
        return labelled.format("parquet").partitionBy(QUEUE).option("path", self.queue_folder(process))

    def queue_folder(self, process: str) -> str:
        return f"{self.path}/{process}-queues"

    def run_to_end(self, *sinks: DataStreamWriter) -> None:
        """Work off everything that is there, stage by stage, then stop. A failure is raised here.

        While a stage works off its source, later ones already take in what it has published.
        """
        waiting = [stage.start() for stage in self.stages] + list(sinks)
        later = [run_live(sink, "0 seconds") for sink in waiting[1:]]
        try:
            first = waiting[0].trigger(availableNow=True).start()
            first.awaitTermination()
            for query in later:
                query.processAllAvailable()
        finally:
            for query in later:
                query.stop()

    def run_live(self, *sinks: DataStreamWriter, every: str = "1 second") -> list[StreamingQuery]:
        """Start all stages and keep going until the queries are stopped."""
        return [run_live(query, every) for query in [*(stage.start() for stage in self.stages), *sinks]]


def read_queues(spark: SparkSession, flow: LiveFlow, process: str) -> DataFrame:
    """What the queues of a process hold so far, labelled."""
    shape = flow.written(process).schema
    return spark.read.schema(shape).parquet(flow.queue_folder(process))
