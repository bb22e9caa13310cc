"""How often the stream operators call the state."""

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Row
from pyspark.sql import types as T

from sigweave.streaming.keyed import KeyedRules, Throttle
from sigweave.streaming.steps import PreviousStep
from sigweave.streaming.windows import WindowSpec, _Windows


class Store:
    """A map state and its handle in one, with a count of calls."""

    def __init__(self):
        self.held, self.calls = {}, Counter()

    def getMapState(self, *args):
        return self

    def registerTimer(self, at):
        self.calls["timer"] += 1

    def exists(self):
        self.calls["exists"] += 1
        return bool(self.held)

    def containsKey(self, key):
        self.calls["get"] += 1
        return key in self.held

    def getValue(self, key):
        self.calls["get"] += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls["update"] += 1
        self.held[key] = value


class Clock:
    def getCurrentWatermarkInMs(self):
        return 0


def test_a_window_meets_the_state_once_however_many_parts_its_rows_come_in():
    store, spec = Store(), WindowSpec(1000)
    windows = _Windows(spec, ["k"], ["v"])
    windows.init(store)
    at = np.arange(300) % 200 * 10
    parts = [pd.DataFrame({"k": "a", "t": at[i::50], "v": 1.0}) for i in range(50)]
    assert list(windows.handleInputRows(("a",), iter(parts), Clock())) == []
    assert store.held == {(0,): (1000, 200, 200.0), (1000,): (2000, 100, 100.0)}
    assert store.calls["update"] == 2


KEYS = T.StructType([T.StructField("who", T.StringType())])
ROWS = [("b", 5, "y"), ("a", 9, "z"), (None, 1, "n"), ("a", 2, "x"), ("b", 1, None)]


def test_rules_take_the_keys_of_a_bucket_in_one_call():
    store, shape = Store(), Row("who", "t", "imei", "_bucket")
    given = ["who", "t", "imei"]
    rules = KeyedRules(KEYS, [PreviousStep("imei")], ["t"], [[True]], given, [*given, "last"], None)
    rules.init(store)
    store.held[("z",)] = ("old",)
    found = [tuple(r) for r in rules.handleInputRows((0,), [shape(*r, 0) for r in ROWS], None)]
    assert found == [
        (None, 1, "n", ""), ("a", 2, "x", ""), ("a", 9, "z", "x"), ("b", 1, None, ""), ("b", 5, "y", ""),
    ]
    assert store.held == {("z",): ("old",), (None,): ("n",), ("a",): ("z",), ("b",): ("y",)}
    assert store.calls == {"exists": 1, "get": 3, "update": 3}


def test_throttle_takes_the_keys_of_a_bucket_in_one_call():
    store, shape = Store(), Row("who", "t", "imei", "_gap", "_bucket")
    given = ["who", "t", "imei", "_gap"]
    throttle = Throttle(KEYS, ["t"], "t", "_gap", None, None, given, None)
    throttle.init(store)
    for last in ((), (4,)):
        store.held = {("a",): last} if last else {}
        store.calls.clear()
        found = [tuple(r) for r in throttle.handleInputRows((0,), [shape(*r, 4, 0) for r in ROWS], None)]
        times = [(r[0], r[1]) for r in found]
        assert times == [(None, 1), *([] if last else [("a", 2)]), ("a", 9), ("b", 1), ("b", 5)]
        assert store.held == {(None,): (1,), ("a",): (9,), ("b",): (5,)}
        assert store.calls == {"exists": 1, "update": 3, **({"get": 3} if last else {})}
