"""Jobs as plain Python: named streams, and processes that read one and publish others.

A `Flow` only keeps names. Everything it holds is a lazy DataFrame, so what no sink asks for is
never read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import merge_streams
from millrace.operators.chain import Step
from millrace.operators.copies import parse_copies, with_copies
from millrace.operators.keyed import ROWS_PER_SEGMENT, Carry, group_by_key, keyed_apply
from millrace.operators.ordering import create_id
from millrace.operators.routing import emit, empty_queue, enqueue


@dataclass(frozen=True)
class Enqueue:
    """A chain step that writes the items, as they are at this point, to queues.

    `queues` is one name or several with commas; `when` a test, none for all items. The item goes
    on to the next step.
    """

    queues: str
    when: Column | str | None = None

    @property
    def names(self) -> list[str]:
        return [name.strip() for name in self.queues.split(",") if name.strip()]


@dataclass(frozen=True)
class Keyed:
    """A chain step that works on the items of each key in their order; needs `group_by` and `order`.

    `process`, `schema` and `carries` are those of `keyed_apply`: with `carries` a key too big for one
    task is cut and its state carried on, without them such a key is refused.
    """

    process: Callable[[pd.DataFrame], pd.DataFrame]
    schema: str
    carries: Mapping[str, Carry] | None = None
    rows_per_segment: int = ROWS_PER_SEGMENT


@dataclass(frozen=True)
class CreateId:
    """A chain step that puts a running number, from 0, on the items along `order`, whose columns are
    unique together. On a live stream micro-batches follow one another, and `order` holds inside each."""

    order: str | tuple[str, ...]
    name: str = "id"


class Flow:
    """Named streams of one job."""

    def __init__(
        self, streams: dict[str, DataFrame], queues: str = "", services: dict[str, DataFrame] | None = None
    ):
        if not streams:
            raise ValueError("at least one source is needed")
        self._streams = dict(streams)
        self._services = dict(services or {})
        self._written: dict[str, list] = {}
        self._queues = {name.strip() for name in queues.split(",") if name.strip()}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._streams:
            raise KeyError(f"no stream {name!r}; known: {sorted(self._streams)}")
        return self._streams[name]

    def __contains__(self, name: str) -> bool:
        return name in self._streams

    def service(self, name: str) -> DataFrame:
        """A side table of the job, for `lookup`."""
        if name not in self._services:
            raise KeyError(f"no service {name!r}; known: {sorted(self._services)}")
        return self._services[name]

    def process(
        self,
        name: str,
        *steps: Step | Enqueue | Keyed | CreateId,
        input: str | None = None,
        output: str = "",
        group_by: str | None = None,
        order: list[str] | None = None,
        copies: object = None,
    ) -> DataFrame:
        """Run a chain and publish what it gives.

        Reads `input`, or the stream published under the process's own name. A name that is
        published again replaces the stream for later processes; nothing is merged silently. Queues
        that were not declared stay empty. With `output` (names with commas) the items are published
        unsplit: the results, and after them everything written to declared queues; they replace a
        queue of the same name. `group_by` needs a unique `order`; it brings the items of a key together
        in one instance and in that order, and `Keyed` steps get them so. `copies` spreads the work
        over so many instances, which costs a shuffle. Returns the results, for processes that only
        feed a sink.
        """
        items = self[input or name]
        key = (group_by or "").strip()
        if key and not order:
            raise ValueError("group_by needs an order")
        if any(isinstance(step, Keyed) for step in steps) and not key:
            raise ValueError("a keyed step needs group_by")
        leading = next((step for step in steps if not isinstance(step, CreateId)), None)
        if key and not isinstance(leading, Keyed):
            items = group_by_key(items, key, order, None if copies is None else parse_copies(copies))
        elif copies is not None and not key:
            items = with_copies(items, copies)
        written: dict[str, list[DataFrame]] = {}
        points: list[tuple[DataFrame, list[tuple[str, Column | str | None]]]] = []
        self._written[name] = points
        for step in steps:
            if isinstance(step, Keyed):
                items = self._keyed(items, key, order, step)
                continue
            if isinstance(step, CreateId):
                items = self._numbered(name, items, step)
                continue
            if not isinstance(step, Enqueue):
                items = items.transform(step)
                continue
            if not points or points[-1][0] is not items:
                points.append((items, []))
            for queue in step.names:
                known = queue in self._queues
                branch = enqueue(items, queue, step.when) if known else empty_queue(items, queue)
                written.setdefault(queue, []).append(branch)
                if known:
                    points[-1][1].append((queue, step.when))
        # Queues first: an output of the same name replaces the queue.
        for queue, branches in written.items():
            self._streams[queue] = merge_streams(*branches)
        outputs = [out.strip() for out in output.split(",") if out.strip()]
        if outputs:
            published = self._unsplit(items, points)
            self._streams.update(dict.fromkeys(outputs, published))
        return items

    def _keyed(self, items: DataFrame, key: str, order: list[str], step: Keyed) -> DataFrame:
        options = {"carries": step.carries, "rows_per_segment": step.rows_per_segment}
        return keyed_apply(items, key, order, step.process, step.schema, **options)

    def _numbered(self, process: str, items: DataFrame, step: CreateId) -> DataFrame:
        return create_id(items, step.order, step.name)

    @staticmethod
    def _unsplit(results: DataFrame, points: list) -> DataFrame:
        """Results and queued items as one stream, in one pass if the queues were written last."""
        points = [(items, rules) for items, rules in points if rules]
        if not points:
            return results
        last, rules = points[-1]
        if len(points) == 1 and last is results and len(dict(rules)) == len(rules):
            return emit(results, dict(rules), output=True)
        queued = [enqueue(items, queue, when) for items, rules in points for queue, when in rules]
        return merge_streams(results, *queued)

    def written(self, process: str) -> DataFrame:
        """Everything a process wrote to declared queues as one labelled stream, for a sink that
        takes all queues in one pass."""
        streams = [
            emit(items, dict(rules))
            if len(dict(rules)) == len(rules)
            else merge_streams(*[enqueue(items, queue, when) for queue, when in rules])
            for items, rules in self._written[process]
            if rules
        ]
        if not streams:
            raise KeyError(f"process {process!r} wrote to no declared queue")
        return merge_streams(*streams)

    def gather(self, *names: str, tag: str) -> DataFrame:
        """Items of several named streams with the name under `tag`. A stream that was published
        under several of the names is read once."""
        groups: list[tuple[DataFrame, list[str]]] = []
        for name in names:
            for items, shared in groups:
                if items is self[name]:
                    shared.append(name)
                    break
            else:
                groups.append((self[name], [name]))
        return merge_streams(
            *[items.withColumn(tag, F.explode(F.array(*map(F.lit, shared)))) for items, shared in groups]
        )
