"""Typed state against dictionaries, with a store that counts the calls it gets."""

from __future__ import annotations

import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import types as T

from millrace.plans import live_queries as q
from millrace.sources.tables import read_live
from millrace.streaming import typed
from millrace.streaming.run import run_until_idle, writer


class Store:
    """State of one key as the handles of Spark give it."""

    def __init__(self):
        self.calls, self.held = 0, {}

    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return 0

    def getValueState(self, name, shape):  # noqa: N802
        return Variable(self, name)

    def getMapState(self, name, names, rows):  # noqa: N802
        return Variable(self, name)


    def registerTimer(self, at):  # noqa: N802
        self.calls += 1

    def listTimers(self):  # noqa: N802
        self.calls += 1
        return iter([])

    def getExpiryTimeInMs(self):  # noqa: N802
        return 2_000


class Variable:
    def __init__(self, store, name):
        self.store, self.name = store, name

    def _call(self):
        self.store.calls += 1
        return self.store.held.setdefault(self.name, {})

    def exists(self):
        return bool(self._call())

    def get(self):
        return self._call().get(())

    def update(self, value):
        self._call()[()] = value

    def containsKey(self, name):  # noqa: N802
        return name in self._call()

    def getValue(self, name):  # noqa: N802
        return self._call().get(name)

    def updateValue(self, name, value):  # noqa: N802
        self._call()[name] = value

    def removeKey(self, name):  # noqa: N802
        self._call().pop(name, None)

    def clear(self):
        self._call().clear()


EVENT = T.StructType().add("event_type", "string")
USER = T.StructType().add("user", "string")
COUNT = T.StructType().add("n", "long")


def test_a_map_costs_a_call_for_a_page_and_not_for_an_entry():
    store, last = Store(), {}

    def run(*pieces):
        keyed = typed._Keyed(q.count_users, ["event_type", "user"], EVENT, {}, {"users": (USER, COUNT)}, None, 0)
        keyed.init(store)
        for out in keyed.handleInputRows((0,), iter([piece.assign(group=0) for piece in pieces]), store):
            last.update({user: n for _, user, n in out.itertuples(index=False)})

    rows = pd.DataFrame({"event_type": "view", "user": [str(i) for i in range(5_000)] * 2})
    for _ in range(3):
        run(rows[:7_000], rows[7_000:])
    assert last == {str(i): 6 for i in range(5_000)}
    assert store.calls < 1_000
    store.calls = 0
    run(pd.DataFrame({"event_type": ["view"], "user": ["17"]}))
    assert store.calls <= 6


def test_keys_cost_a_call_for_a_page_and_not_for_a_key():
    """`live_finish`, with keys that close in one call."""
    store, ends = Store(), {}
    rows = pd.DataFrame({"user": [str(i) for i in range(5_000)] * 2, "group": 0})
    for _ in range(3):
        keyed = typed._Keyed(q.add_up, ["user"], USER, {"n": COUNT}, {}, q.last_count, 2_000)
        keyed.init(store)
        assert list(keyed.handleInputRows((0,), iter([rows[:7_000], rows[7_000:]]), store)) == []
    keyed.init(store)
    found = list(keyed.handleExpiredTimer((0,), store, store))
    for out in found:
        ends |= dict(out.itertuples(index=False))
    assert ends == {str(i): 6 for i in range(5_000)} and len(found) == 1
    assert store.calls < 1_000
    keyed.init(store)
    assert list(keyed.handleExpiredTimer((0,), store, store)) == []


NAMES = {
    "string, long": (T.StructType().add("a", "string").add("b", "long"), lambda r: (r.choice(["é", "", None, "\ud800"]), np.int64(r.randrange(200)))),
    "double": (T.StructType().add("a", "double"), lambda r: (r.choice([0.0, -0.0, float("nan"), r.randrange(300) / 7]),)),
    "float": (T.StructType().add("a", "float"), lambda r: (r.randrange(300) / 7,)),
    "decimal": (T.StructType().add("a", "decimal(9,2)"), lambda r: (Decimal(r.randrange(300)),)),
    "binary": (T.StructType().add("a", "binary"), lambda r: (bytes([r.randrange(256)]),)),
    "boolean": (T.StructType().add("a", "boolean"), lambda r: (r.choice([True, False, None]),)),
}


def stored_like_spark(kind):
    """What the store gives back for a name."""
    if isinstance(kind, T.FloatType):
        return lambda v: float(np.float32(v))
    if isinstance(kind, T.DecimalType):
        return lambda v: v.quantize(Decimal("0.01"))
    return bytearray if isinstance(kind, T.BinaryType) else lambda v: v


@pytest.mark.parametrize("kind", NAMES)
@pytest.mark.parametrize("held", [2, 4_096])
def test_pages_are_a_dictionary(kind, held, monkeypatch):
    names, one = NAMES[kind]
    monkeypatch.setattr(typed, "PAGE", 4)
    monkeypatch.setattr(typed, "HELD_PAGES", held)
    store, chance, want = Store(), random.Random(7), {}
    size = [None, 0, 0]
    back = [stored_like_spark(f.dataType) for f in names]
    for _ in range(6):
        pages = Variable(store, "pages")
        for page, columns in store.held.get("pages", {}).items():
            whole = [[None if v is None else f(v) for v in column] for f, column in zip(back, columns)]
            store.held["pages"][page] = (*whole, *columns[len(names) :])
        entries = typed.Entries(lambda pages=pages: typed.Pages(pages, names, 2), 1)
        entries.start((), size)
        for i in range(400):
            name = one(chance)
            key = repr(entries._open().name(name))
            if chance.random() < 0.3:
                entries.remove(name)
                want.pop(key, None)
            else:
                entries.set(name, (i, [i, None]))
                want[key] = (i, [i, None])
            other = one(chance)
            assert entries.get(other) == want.get(repr(entries._open().name(other)))
            assert (other in entries) == (repr(entries._open().name(other)) in want)
        assert {repr(name): row for name, row in entries.items()} == want
        entries.close()
        entries.flush()
    assert size[2] == len(want)
    entries.start((), size)
    entries.clear()
    assert list(entries.items()) == [] and entries.get(one(chance), 5) == 5
    entries.close()
    assert store.held["pages"] == {} and size[1:] == [0, 0]


def test_results_of_other_types_stay_apart():
    big = 2**60 + 1
    outs = [pd.DataFrame({"n": [big]}), None, pd.DataFrame({"n": [big, 3]}), pd.DataFrame({"n": [float("nan")]}), pd.DataFrame({"n": []})]
    assert [list(out["n"].fillna(-1)) for out in typed.joined(iter(outs))] == [[big, big, 3], [-1]]


def test_keys_of_several_columns_with_maps_over_batches(spark, tmp_path):
    """Against a plain count: nulls in keys, few groups, maps larger than a page, and each key told once."""
    chance, source, out = random.Random(3), str(tmp_path / "source"), str(tmp_path / "out")
    rows = [(chance.choice([None, 2**40, 5]), chance.choice([None, "", "é", "x"]), chance.randrange(300)) for _ in range(6_000)]
    shape = "a long, b string, v long"
    for i in range(3):
        spark.createDataFrame(rows[i::3], shape).coalesce(2).write.mode("append").parquet(source)

    def process(key, rows, state):
        for v in rows["v"]:
            state.maps["seen"].set(int(v), state.maps["seen"].get(int(v), 0) + 1)
        state.values["n"].set(state.values["n"].get(0) + len(rows))
        assert list(rows.columns) == ["a", "b", "v"]

    def finish(key, state):
        entries = list(state.maps["seen"].items())
        n = state.values["n"].get()
        return pd.DataFrame({"a": [str(key[0])], "b": [str(key[1])], "n": [n], "kinds": [len(entries)], "sum": [sum(v * n for (v,), (n,) in entries)]})

    live = read_live(spark, source, shape, max_files=2)
    values, maps = {"n": "n long"}, {"seen": ("v long", "n long")}
    found = typed.typed_state(live, ["a", "b"], process, "a string, b string, n long, kinds long, sum long", values, maps, finish, 8, groups=2)
    run_until_idle(writer(found, "x").format("parquet").option("path", out), 8)
    want = {}
    for a, b, v in rows:
        want.setdefault((str(a), str(b)), []).append(v)
    got = sorted(map(tuple, spark.read.parquet(out).select("a", "b", "n", "kinds", "sum").collect()))
    assert got == sorted((*k, len(vs), len(set(vs)), sum(vs)) for k, vs in want.items())
