"""Keyed state that sees the rows of a key in the order of their times, whatever the order they came in."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

SECOND = 1_000_000
#: Rows of a part, and rows that are put in order before they are cut into parts.
PART_ROWS, ORDERED_ROWS = 2_000, 50_000


class InTimeOrder(StatefulProcessor):
    """Rows wait until the watermark has passed their time: then no earlier one can come.

    Those that come together wait as parts, each of rows next to each other in time, under the time of its first: a few
    calls to the state for a key and batch, however many rows. A batch reads the parts of which some row is due, and of those
    only. Subclasses name the columns of a row (the first is its time in microseconds, the second tells rows of one time
    apart) and of a result, and say what is done with those that are due.
    """

    FIELDS: dict[str, str]
    RESULT: dict[str, str]

    @classmethod
    def result_schema(cls) -> str:
        return ", ".join(f"{n} {t}" for n, t in cls.RESULT.items())

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "first long, part long", ", ".join(f"{n} array<{t}>" for n, t in self.FIELDS.items()))
        # The timer that is set, and the number of the next part.
        self.clock = handle.getValueState("clock", "at long, part long")

    def judge_due(self, key, due: list[tuple], upto: int) -> tuple[list[tuple], int | None]:
        """Result for the rows that are due, in order, where ``upto`` is the time up to which all are known; and a time at
        which to be called again though nothing is due. Called more than once, the later rows later, for a key of many rows."""
        raise NotImplementedError

    def _read_clock(self) -> tuple[int | None, int]:
        return self.clock.get() or (None, 0)

    def _set_clock(self, old: int | None, at: int | None, part: int) -> None:
        """A timer in the first whole millisecond after a time, when the watermark is beyond it; one at a time."""
        wake = old if at is None else at // 1000 + 1 if old is None else min(old, at // 1000 + 1)
        if wake != old:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(wake)
        self.clock.update((wake, part))

    def wake(self, at: int) -> None:
        old, part = self._read_clock()
        self._set_clock(old, at, part)

    def _keep(self, rows: list[tuple], part: int) -> int:
        """Store rows in order of their times, and return the number of the next part."""
        for i in range(0, len(rows), PART_ROWS):
            own = rows[i : i + PART_ROWS]
            self.waiting.updateValue((own[0][0], part), tuple(list(c) for c in zip(*own, strict=True)))
            part += 1
        return part

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old, part = self._read_clock()
        first, come = None, []

        def store() -> int:
            come.sort(key=lambda r: r[0])
            return self._keep(come, part)

        for row in rows:
            come.append(tuple(row[n] for n in self.FIELDS))
            if len(come) >= ORDERED_ROWS:
                part = store()
                first = come[0][0] if first is None else min(first, come[0][0])
                come = []
        if come:
            part = store()
            first = come[0][0] if first is None else min(first, come[0][0])
        if first is not None:
            self._set_clock(old, first, part)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        _, part = self._read_clock()
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        parts = sorted(tuple(k) for k in self.waiting.keys())
        ready = [p for p in parts if p[0] <= passed]
        held: list[tuple] = []
        found = Row(*self.RESULT)
        enough, again = ORDERED_ROWS, None
        for i, p in enumerate(ready):
            held += zip(*self.waiting.getValue(p), strict=True)
            self.waiting.removeKey(p)
            if len(held) < enough and i + 1 < len(ready):
                continue
            # Rows before the first of the next part are all here.
            upto = passed if i + 1 == len(ready) else ready[i + 1][0] - 1
            held.sort(key=lambda r: r[:2])
            n = bisect_right(held, upto, key=lambda r: r[0])
            due, held = held[:n], held[n:]
            enough = len(held) + ORDERED_ROWS
            out, again = self.judge_due(key, due, upto)
            yield from (found(*r) for r in out)
        if not ready:
            out, again = self.judge_due(key, [], passed)
            yield from (found(*r) for r in out)
        ahead = [p[0] for p in parts[len(ready) : len(ready) + 1]]
        if held:
            part = self._keep(held, part)
            ahead.append(held[0][0])
        if again is not None:
            ahead.append(again)
        self._set_clock(None, min(ahead, default=None), part)

    def close(self) -> None:
        pass
