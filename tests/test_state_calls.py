"""Event-time processors call their state per key, not per row: each call is a message to the executor."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Row

from rillstone.streaming import ordered


class Times:
    def __init__(self, mark):
        self.mark = mark

    def getCurrentWatermarkInMs(self):
        return self.mark

    def getCurrentProcessingTimeInMs(self):
        return 1

    def getExpiryTimeInMs(self):
        return self.mark


class Handle:
    """State of one key in this process, with a count of the calls."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def getValueState(self, name, schema):
        return Value(self)

    def getMapState(self, name, key, value):
        return Map(self)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


class Value:
    def __init__(self, handle):
        self.handle, self.value = handle, None

    def get(self):
        self.handle.calls += 1
        return self.value

    def exists(self):
        self.handle.calls += 1
        return self.value is not None

    def update(self, value):
        self.handle.calls += 1
        self.value = value

    def clear(self):
        self.update(None)


class Map:
    def __init__(self, handle):
        self.handle, self.value = handle, {}

    def keys(self):
        self.handle.calls += 1
        return iter(list(self.value))

    def containsKey(self, key):
        self.handle.calls += 1
        return key in self.value

    def getValue(self, key):
        self.handle.calls += 1
        return self.value.get(key)

    def updateValue(self, key, value):
        self.handle.calls += 1
        self.value[key] = value

    def removeKey(self, key):
        self.handle.calls += 1
        del self.value[key]


def played(processor, batches, delay_ms=0):
    """The rows given out, as Spark runs batches: rows first, then timers once the watermark has moved."""
    handle, mark, out = Handle(), 0, []
    processor.init(handle)
    for batch in batches:
        out += processor.handleInputRows(("k",), iter(batch), Times(mark))
        mark = max(mark, max(r["timestamp"] for r in batch) * 1000 - delay_ms)
        for at in sorted(t for t in handle.timers if t <= mark):
            handle.timers.remove(at)
            out += processor.handleExpiredTimer(("k",), Times(mark), Times(at))
    return out, handle.calls


def batches(n=400, parts=4):
    pick = random.Random(5)
    made = [(i // 2 * 3 + pick.randrange(20), float(pick.randrange(20, 40)), i) for i in range(n)]
    size = n // parts
    cut = [made[i : i + size] for i in range(0, n, size)] + [[(10_000, 0.0, -1)]]
    return [[Row(timestamp=t, temperature=v, seq=s, arrival_ms=s, window_end=t * 1000 // 60_000 * 60_000 + 60_000) for t, v, s in part] for part in cut]


PROCESSORS = {
    "frames": lambda: ordered.OverRowsByTime(2),
    "rises": lambda: ordered.RisingAlertByTime(4),
    "timers": lambda: ordered.ElementTimersByTime(10, 5),
    "versions": lambda: ordered.LatenessVersions(30_000),
}


@pytest.mark.parametrize("name", PROCESSORS)
def test_calls_follow_the_keys(name):
    out, calls = played(PROCESSORS[name](), batches())
    assert len(out) > 10
    assert calls <= 12 * 5


@pytest.mark.parametrize("name", ["frames", "rises", "timers"])
def test_keys_with_many_waiting_rows_give_the_same(name, monkeypatch):
    want, _ = played(PROCESSORS[name](), batches(), 15_000)
    monkeypatch.setattr(ordered, "HELD_ROWS", 30)
    monkeypatch.setattr(ordered, "FLUSH_ROWS", 7)
    got, _ = played(PROCESSORS[name](), batches(), 15_000)
    if name == "timers":
        want, got = ([r.asDict() | {"watermark": 0} for r in rows] for rows in (want, got))
    assert got == want
