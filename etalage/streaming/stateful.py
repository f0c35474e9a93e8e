"""Per-customer rules with keyed state that a table of the past can seed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

from etalage.functions.columns import micros
from etalage.streaming.in_order import SECOND, InTimeOrder

#: An alert, its time in microseconds.
ALERT = {"payment_id": "long", "customer_id": "long", "at": "long", "rule": "string"}
#: What is kept of an attempt until it is judged, and of the last ones as context.
ATTEMPT = {
    "at": "long",
    "payment_id": "long",
    "amount": "double",
    "result": "string",
    "device_id": "string",
    "ip_hash": "string",
    "payment_country": "string",
    "customer_country": "string",
}
DAY = 24 * 3600
#: The rules look back over so many attempts and so many failures, and no further than a day.
VELOCITY_LIMIT, FAILED_LIMIT, AMOUNT_LIMIT = 5, 3, 100.0
ROWS_BACK, FAILURES_BACK = VELOCITY_LIMIT + 1, FAILED_LIMIT


def judge(rows: list[tuple], n_before: int, had_success: bool) -> dict[str, np.ndarray]:
    """Which rules each attempt of one customer breaks, from the ``n_before``-th on.

    ``rows`` are attempts as in ATTEMPT in order of time and number. Those before are the context: the last ROWS_BACK
    attempts and FAILURES_BACK failures decide every rule that looks back. ``had_success``: one of the past, also if
    it is not among the rows.
    """
    at, _, amount, result, device, ip, paid, home = (list(c) for c in zip(*rows, strict=True))
    at = np.array(at, np.int64)
    amount = np.array([np.nan if x is None else x for x in amount], np.float64)
    failed = np.array([x == "failed" for x in result])
    success = np.array([x == "success" for x in result])
    upto = np.searchsorted(at, at, side="right")
    so_far = np.r_[0, np.cumsum(failed)]

    def since(seconds: int) -> np.ndarray:
        return np.searchsorted(at, at - seconds * SECOND, side="left")

    def moved(column: list) -> np.ndarray:
        pairs = zip(column, column[1:], strict=False)
        return np.array([False, *[a is not None and b is not None and a != b for a, b in pairs]])

    gap = np.full(len(at), np.inf)
    gap[1:] = np.diff(at)
    hour = at // (3600 * SECOND) % 24
    successes = np.r_[0, np.cumsum(success)[:-1]]
    three_back = np.full(len(at), -np.inf)
    three_back[3:] = at[:-3]
    after_failures = np.zeros(len(at), bool)
    after_failures[3:] = failed[2:-1] & failed[1:-2] & failed[:-3]
    found = {
        "high_amount": (amount > AMOUNT_LIMIT) & (successes == 0) & (not had_success),
        "country_mismatch": np.array([a is not None and b is not None and a != b for a, b in zip(home, paid, strict=True)]),
        "velocity": upto - since(600) > VELOCITY_LIMIT,
        "device_change": moved(device) & moved(ip) & (gap < 3600 * SECOND),
        "time_anomaly": (hour >= 3) & (hour < 6),
        "many_failed_attempts": failed & (so_far[upto] - so_far[since(DAY)] >= FAILED_LIMIT),
        "rapid_attempts": gap < 600 * SECOND,
        "fail_then_success": success & after_failures & (at - three_back <= DAY * SECOND),
    }
    return {rule: hit[n_before:] for rule, hit in found.items()}


def context_of(rows: list[tuple]) -> list[tuple]:
    """Of attempts in order, those that later ones are judged by: a few, however many there are."""
    failures = [r for r in rows if r[3] == "failed"][-FAILURES_BACK:]
    last = rows[-ROWS_BACK:]
    return [f for f in failures if f not in last] + last


class AttemptRules(InTimeOrder):
    """The rules over the attempts of one customer. State besides what waits: the first success (for good) and the few
    last attempts (for a day after the last). What a table of the past knows comes in once, as initial state."""

    FIELDS, RESULT = ATTEMPT, ALERT

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.first = handle.getValueState("first", "at long, payment_id long")
        self.last = handle.getValueState("last", ", ".join(f"{n} array<{t}>" for n, t in ATTEMPT.items()))

    def handleInitialState(self, key, initialState: Row, timerValues) -> Iterator[Row]:
        if initialState["first_at"] is not None:
            self.first.update((initialState["first_at"], initialState["first_id"]))
        last = [tuple(r[n] for n in ATTEMPT) for r in initialState["last"]]
        if last:
            self._put_last(last)
            self.wake(max(r[0] for r in last) + DAY * SECOND)
        return iter([])

    def _put_last(self, rows: list[tuple]) -> None:
        self.last.update(tuple(list(c) for c in zip(*rows, strict=True)))

    def judge_due(self, key, due: list[tuple], upto: int) -> tuple[list[tuple], int | None]:
        held = self.last.get()
        before = list(zip(*held, strict=True)) if held else []
        out: list[tuple] = []
        if due:
            had_success = self.first.get() is not None
            found = judge([*before, *due], len(before), had_success)
            good = next((r for r in due if r[3] == "success"), None)
            if not had_success and good:
                self.first.update((good[0], good[1]))
            out = [(due[i][1], key[0], due[i][0], rule) for rule, hit in found.items() for i in np.flatnonzero(hit).tolist()]
            before = context_of([*before, *due])
        if before and before[-1][0] + DAY * SECOND < upto:
            if held:
                self.last.clear()
            return out, None
        if due:
            self._put_last(before)
        return out, before[-1][0] + DAY * SECOND if before else None


def past_of(attempts: DataFrame) -> DataFrame:
    """The state of each customer after the attempts of a table: first success, and the last attempts in order.

    Only the newest few of a customer travel, and its first success as one row a task.
    """
    attempts = attempts.where("ts is not null and customer_id is not null")
    rows = attempts.withColumns({"at": micros("ts"), "amount": F.col("amount").cast("double")}).select("customer_id", *ATTEMPT)
    newest = [F.col("at").desc(), F.col("payment_id").desc()]
    last = rows.withColumn("nth", F.row_number().over(Window.partitionBy("customer_id").orderBy(*newest)))
    failures = rows.where("result = 'failed'").withColumn("nth", F.row_number().over(Window.partitionBy("customer_id").orderBy(*newest)))
    kept = last.where(F.col("nth") <= ROWS_BACK).unionByName(failures.where(F.col("nth") <= FAILURES_BACK)).drop("nth")
    kept = kept.groupBy("customer_id").agg(F.array_sort(F.collect_set(F.struct(*ATTEMPT))).alias("last"))
    first = rows.where("result = 'success'").groupBy("customer_id").agg(F.min(F.struct("at", "payment_id")).alias("first"))
    return kept.join(first, "customer_id", "left").select(
        "customer_id", F.col("first.at").alias("first_at"), F.col("first.payment_id").alias("first_id"), "last"
    )


def attempt_alerts(payments: DataFrame, delay: str = "10 minutes", past: DataFrame | None = None) -> DataFrame:
    """Alerts of all rules, and of a success after three failures, for a stream of attempts.

    ``payments`` has payment_id, customer_id, ts, amount, result, device_id, ip_hash and both countries. Attempts may
    come in any order within the watermark. ``past`` (of ``past_of``) is taken in when the stream first starts; what
    the customer did before the stream then counts. Attempts without a time or a customer are left out.
    """
    timed = payments.withColumn("ts", F.col("ts").cast("timestamp")).where("ts is not null and customer_id is not null")
    rows = timed.withWatermark("ts", delay).withColumns({"at": F.unix_micros("ts"), "amount": F.col("amount").cast("double")})
    found = rows.select("customer_id", "ts", *ATTEMPT).groupBy("customer_id").transformWithState(
        statefulProcessor=AttemptRules(),
        outputStructType=AttemptRules.result_schema(),
        outputMode="Append",
        timeMode="EventTime",
        initialState=past.groupBy("customer_id") if past is not None else None,
    )
    return found.select("payment_id", "customer_id", F.timestamp_micros("at").alias("ts"), "rule")
