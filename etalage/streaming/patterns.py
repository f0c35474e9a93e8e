"""Sequences of events in a stream: keyed state driven by the steps of a pattern (see ``operators.patterns``)."""

from __future__ import annotations

import json
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

from etalage.operators.patterns import Pattern
from etalage.streaming.in_order import SECOND, InTimeOrder

# The pattern goes to the Python workers with the state, and these need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[Pattern.__module__])

Run = tuple[int, int] | None


def advance(state: list[Run], done: list[bool], ends: bool, strict: bool, at: int, number: int) -> tuple[list[Run], Run]:
    """One event: the state after it (when the latest run with so many steps began), and the run that it ends.

    ``done``: the steps whose condition the event meets; ``ends``: it ends all runs and is no step.
    """
    if ends:
        return [None] * len(state), None
    run = state[-1] if done[-1] else None
    after = [None] * len(state) if strict else list(state)
    for i in range(len(state) - 1, 0, -1):
        if done[i] and state[i - 1] is not None:
            after[i] = state[i - 1]
    if done[0]:
        after[0] = (at, number)
    return after, run


class PatternState(InTimeOrder):
    """The runs of one pattern for one key.

    State besides what waits: for each number of steps the latest run, dropped when it can no longer end in time;
    the values that the next event is compared with; for an absent step the first steps that still wait for it.
    """

    FIELDS = {"at": "long", "number": "long", "done": "long", "ends": "boolean", "compared": "string"}
    RESULT = {"key": "long", "number": "long", "started": "long", "ended": "long"}

    def __init__(self, pattern: Pattern):
        self.pattern = pattern

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.runs = handle.getValueState("runs", "at array<long>, number array<long>")
        self.before = handle.getValueState("before", "compared array<string>")
        self.open = handle.getValueState("open", "at array<long>, number array<long>")

    def judge_due(self, key, due: list[tuple], upto: int) -> tuple[list[tuple], int | None]:
        within = self.pattern.within * SECOND
        found: list[tuple[int, int, int]] = []
        again = (self._absent if self.pattern.absent else self._present)(due, upto, within, found)
        return [(int(key[0]), *r) for r in found], again

    def _present(self, due: list[tuple], upto: int, within: int, found: list) -> int | None:
        steps, compared = self.pattern.steps, self.pattern.compared
        held = self.runs.get()
        state: list[Run] = [None] * (len(steps) - 1)
        if held:
            state = [None if a is None else (int(a), int(b)) for a, b in zip(*held, strict=True)]
        kept = self.before.get() if compared and due else None
        before = list(kept[0]) if kept else None
        for at, number, done, ends, values in due:
            values = json.loads(values)
            moved = {c: before is not None and a is not None and b is not None and a != b for c, a, b in zip(compared, before or values, values, strict=True)}
            hits = [bool(done >> i & 1) and all(moved[c] for c in s.changed) for i, s in enumerate(steps)]
            state, run = advance(state, hits, bool(ends), self.pattern.strict, int(at), int(number))
            if run is not None and at - run[0] <= within:
                found.append((int(number), run[0], int(at)))
            before = values
        if due and compared:
            self.before.update((before,))
        state = [r if r is not None and r[0] + within >= upto else None for r in state]
        if any(state):
            self.runs.update(([r and r[0] for r in state], [r and r[1] for r in state]))
            return max(r[0] for r in state if r) + within
        if held:
            self.runs.clear()
        return None

    def _absent(self, due: list[tuple], upto: int, within: int, found: list) -> int | None:
        held = self.open.get()
        waits = list(zip(*held, strict=True)) if held else []

        def run_out(before: int) -> None:
            late = [r for r in waits if r[0] + within < before]
            found.extend((r[1], r[0], r[0] + within) for r in late)
            del waits[: len(late)]

        for at, number, done, _, _ in due:
            run_out(at)
            if done & 2:
                waits.clear()
            if done & 1:
                waits.append((int(at), int(number)))
        run_out(upto + 1)
        if waits:
            self.open.update(tuple(list(c) for c in zip(*waits, strict=True)))
            return waits[0][0] + within
        if held:
            self.open.clear()
        return None


def live_matches(events: DataFrame, key: str, ts: str, order: str, pattern: Pattern, delay: str = "10 minutes") -> DataFrame:
    """key, ``order``, started and ended as ``operators.patterns.matches`` gives them, for a stream.

    Events may come in any order within the watermark. An absent step is told when the watermark has passed its time.
    Events without a time or a key are left out.
    """
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp")).where(F.col("_ts").isNotNull() & F.col(key).isNotNull())
    rows = timed.withWatermark("_ts", delay).select(
        F.col(key).alias("_key"),
        "_ts",
        F.unix_micros("_ts").alias("at"),
        F.col(order).cast("bigint").alias("number"),
        sum((F.coalesce(F.expr(s.where), F.lit(False)).cast("long") * (1 << i) for i, s in enumerate(pattern.steps)), F.lit(0)).alias("done"),
        (F.coalesce(F.expr(pattern.unless), F.lit(False)) if pattern.unless else F.lit(False)).alias("ends"),
        F.to_json(F.array(*[F.col(c).cast("string") for c in pattern.compared]).cast("array<string>")).alias("compared"),
    )
    # Events that no step and no comparison looks at need not travel. They move the watermark all the same: a condition
    # on its column is not pushed below it.
    if not pattern.strict and not pattern.compared:
        rows = rows.where((F.col("done") > 0) | F.col("ends") | F.col("_ts").isNull())
    found = rows.groupBy("_key").transformWithState(
        statefulProcessor=PatternState(pattern),
        outputStructType=PatternState.result_schema(),
        outputMode="Append",
        timeMode="EventTime",
    )
    return found.select(
        F.col("key").alias(key), F.col("number").alias(order), F.timestamp_micros("started").alias("started"), F.timestamp_micros("ended").alias("ended")
    )
