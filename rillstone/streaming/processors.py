"""Keyed state machines for `transformWithState`.

A key's rows may reach `handleInputRows` in any order inside one micro-batch, so each
processor sorts them by arrival number first; what it sorts is bounded by the source's
per-trigger limit. State per key is a few values, never the key's history.

Null readings follow the batch twins: sums, averages and maxima skip them, counts of rows include
them, and a comparison with one neither alerts nor falls nor rises.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def in_order(rows: Iterator[Row]) -> list[Row]:
    return sorted(rows, key=lambda r: r["seq"])


class StateKinds(StatefulProcessor):
    """Per row: count (value), last n arrival numbers (list), sum of its kind (map), maximum (reduced)."""

    output = ("id string, seq bigint, kind string, n bigint, kind_sum double, max_temp double, "
              "last_seqs string")

    def __init__(self, n: int = 3):
        self.keep = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n bigint")
        self.recent = handle.getListState("recent", "seq bigint")
        self.sums = handle.getMapState("sums", "kind string", "total double")
        self.highest = handle.getValueState("highest", "temp double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n = self.count.get()[0] if self.count.exists() else 0
        recent = [r[0] for r in self.recent.get()] if self.recent.exists() else []
        highest = self.highest.get()[0] if self.highest.exists() else None
        for row in in_order(rows):
            n += 1
            recent = [*recent, row["seq"]][-self.keep:]
            kind = (row["kind"],)
            total = self.sums.getValue(kind)[0] if self.sums.containsKey(kind) else None
            value = row["temperature"]
            if value is not None:
                total = value if total is None else total + value
                highest = value if highest is None else max(highest, value)
            self.sums.updateValue(kind, (total,))
            yield Row(id=key[0], seq=row["seq"], kind=row["kind"], n=n, kind_sum=total,
                      max_temp=highest, last_seqs=",".join(map(str, recent)))
        self.count.update((n,))
        self.recent.put([(s,) for s in recent])
        self.highest.update((highest,))

    def close(self) -> None:
        pass


class JumpAlert(StatefulProcessor):
    """(id, seq, last, current) when consecutive values differ by the threshold or more."""

    output = "id string, seq bigint, last_temp double, cur_temp double"

    def __init__(self, threshold: float = 10.0):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "temp double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        for row in in_order(rows):
            current = row["temperature"]
            if last is not None and current is not None and abs(current - last) >= self.threshold:
                yield Row(id=key[0], seq=row["seq"], last_temp=last, cur_temp=current)
            last = current
        self.last.update((last,))

    def close(self) -> None:
        pass


class RunningCount(StatefulProcessor):
    """0- or 1-based running number per key, the key being e.g. a source shard."""

    output = "shard int, seq bigint, n bigint"

    def __init__(self, start: int = 0):
        self.start = start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n = self.count.get()[0] if self.count.exists() else self.start
        for row in in_order(rows):
            yield Row(shard=key[0], seq=row["seq"], n=n)
            n += 1
        self.count.update((n,))

    def close(self) -> None:
        pass


class OverRows(StatefulProcessor):
    """Count and average over each row and the `preceding` rows before it."""

    output = "id string, seq bigint, rt_ms bigint, cnt bigint, avg_temp double"

    def __init__(self, preceding: int = 2):
        self.preceding = preceding

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", "temp double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        recent = [r[0] for r in self.recent.get()] if self.recent.exists() else []
        for row in in_order(rows):
            frame = [*recent, row["temperature"]]
            known = [v for v in frame if v is not None]
            yield Row(id=key[0], seq=row["seq"], rt_ms=row["timestamp"] * 1000, cnt=len(frame),
                      avg_temp=sum(known) / len(known) if known else None)
            recent = frame[-self.preceding:]
        self.recent.put([(v,) for v in recent])

    def close(self) -> None:
        pass


class Changelog(StatefulProcessor):
    """An updating (avg, count) per key as deletions and additions."""

    output = "id string, seq bigint, op boolean, avg_temp double, cnt bigint"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "total double, seen bigint, n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        total, seen, n = tuple(self.acc.get()) if self.acc.exists() else (0.0, 0, 0)
        for row in in_order(rows):
            if n:
                yield Row(id=key[0], seq=row["seq"], op=False, avg_temp=total / seen if seen else None, cnt=n)
            if row["temperature"] is not None:
                total, seen = total + row["temperature"], seen + 1
            n += 1
            yield Row(id=key[0], seq=row["seq"], op=True, avg_temp=total / seen if seen else None, cnt=n)
        self.acc.update((total, seen, n))

    def close(self) -> None:
        pass


class LateSplit(StatefulProcessor):
    """Tags rows on time, allowed late or too late against the shard's own watermark.

    Spark drops late rows without a trace, so they are told apart before any watermark.
    """

    output = "shard int, id string, seq bigint, window_end bigint, late_class string"

    def __init__(self, size_ms: int, bound_ms: int, lateness_ms: int):
        self.size_ms, self.bound_ms, self.lateness_ms = size_ms, bound_ms, lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        latest = self.latest.get()[0] if self.latest.exists() else None
        for row in sorted(rows, key=lambda r: (r["arrival_ms"], r["seq"])):
            time_ms = row["timestamp"] * 1000
            end = time_ms - time_ms % self.size_ms + self.size_ms
            mark = None if latest is None else latest - self.bound_ms
            if mark is None or end > mark:
                tag = "on_time"
            else:
                tag = "allowed" if end + self.lateness_ms > mark else "late"
            yield Row(shard=key[0], id=row["id"], seq=row["seq"], window_end=end, late_class=tag)
            latest = time_ms if latest is None else max(latest, time_ms)
        self.latest.update((latest,))

    def close(self) -> None:
        pass


class ElementTimers(StatefulProcessor):
    """Per row a timer at `t + after` seconds, and the deletion of the one at `t + deleted_after`.

    Rows give (id, 'row', row time, length of id, watermark); fired timers (id, 'timer', ...).
    """

    output = "id string, what string, at_ms bigint, len int, watermark bigint"

    def __init__(self, after: int = 10, deleted_after: int = 100):
        self.after, self.deleted_after = after, deleted_after

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        for row in in_order(rows):
            self.handle.registerTimer((row["timestamp"] + self.after) * 1000)
            self.handle.deleteTimer((row["timestamp"] + self.deleted_after) * 1000)
            yield Row(id=key[0], what="row", at_ms=row["timestamp"] * 1000, len=len(key[0]),
                      watermark=mark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield Row(id=key[0], what="timer", at_ms=expiredTimerInfo.getExpiryTimeInMs(),
                  len=len(key[0]), watermark=timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


class RisingAlert(StatefulProcessor):
    """An alert when values have not fallen for `interval` seconds since the first rise.

    Equal values keep the timer; a fall clears it, also one at exactly the firing time.
    Timers fire only after a micro-batch's rows, so a row later than the key's due timer
    first fires it here: results don't depend on where batches are cut.

    `first_counts` lets a positive first value count as a rise.
    """

    output = "id string, start bigint, fire bigint"

    def __init__(self, interval: int = 10, first_counts: bool = False):
        self.interval, self.first_counts = interval, first_counts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "temp double")
        self.due = handle.getValueState("due", "sec bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        begun = self.last.exists()
        last = self.last.get()[0] if begun else None
        due = self.due.get()[0] if self.due.exists() else None
        held = due
        for row in sorted(rows, key=lambda r: (r["timestamp"], r["seq"])):
            now, value = row["timestamp"], row["temperature"]
            if due is not None and now > due:
                yield Row(id=key[0], start=due - self.interval, fire=due)
                due = None
            before = 0.0 if self.first_counts and not begun else last
            begun = True
            if value is not None and before is not None:
                if value > before and due is None:
                    due = now + self.interval
                elif value < before:
                    due = None
            last = value
        self.last.update((last,))
        if due != held:
            if held is not None:
                self.handle.deleteTimer(held * 1000)
            if due is not None:
                self.handle.registerTimer(due * 1000)
        if due is None:
            self.due.clear()
        else:
            self.due.update((due,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        fire = expiredTimerInfo.getExpiryTimeInMs() // 1000
        if self.due.exists() and self.due.get()[0] == fire:
            self.due.clear()
            yield Row(id=key[0], start=fire - self.interval, fire=fire)

    def close(self) -> None:
        pass


class TopNPerWindow(StatefulProcessor):
    """The n most counted items of a window, sent when its timer fires one ms after its end.

    Only the n best so far are held, and the window's state is cleared once it is sent. The key's first part is
    the window's end; a second one may deal a window's items to several tasks, whose best are ranked again.
    """

    output = "window_end bigint, itemId bigint, cnt bigint, row_num int"

    def __init__(self, n: int = 5):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", "cnt bigint, item bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = [tuple(b) for b in self.best.get()] if self.best.exists() else []
        for row in rows:
            best.append((row["cnt"], row["itemId"]))
            if len(best) > 4 * self.n:
                best = self.cut(best)
        self.best.put(self.cut(best))
        self.handle.registerTimer(key[0] + 1)
        return iter(())

    def cut(self, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        return sorted(best, key=lambda b: (-b[0], b[1]))[: self.n]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        best = self.cut([tuple(b) for b in self.best.get()])
        self.best.clear()
        for rank, (count, item) in enumerate(best, 1):
            yield Row(window_end=key[0], itemId=item, cnt=count, row_num=rank)

    def close(self) -> None:
        pass
