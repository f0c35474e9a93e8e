"""Sequences of events, over the table and over a stream of it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from etalage.functions.columns import micros
from etalage.operators.ordered import DAY
from etalage.operators.patterns import Pattern, Step, matches
from etalage.plans.registry import query
from etalage.plans.streams import ROCKSDB, state_settings
from etalage.session import together
from etalage.sources import streams
from etalage.streaming.patterns import live_matches

_FAILED, _HOP = Step("result = 'failed'"), Step(changed=("device_id",))
FAILURE_SUCCESS = Pattern("failure_success", (_FAILED, _FAILED, _FAILED, Step("result = 'success'")), DAY, strict=True)
DEVICE_HOP = Pattern("device_hop", (_HOP, _HOP), 7 * DAY, strict=True)
CLICK_ONLY = Pattern("click_without_purchase", (Step("event_type = 'click'"), Step("event_type = 'purchase'")), 6 * 3600, absent=True)

_ROW = "customer_id:l event_id:l started:t ended:t"
_FAILURE_SQL = """
    SELECT customer_id, payment_id AS event_id, began AS started, attempt_ts AS ended FROM (
        SELECT *, lag(result, 1) OVER w AS r1, lag(result, 2) OVER w AS r2, lag(result, 3) OVER w AS r3,
               lag(attempt_ts, 3) OVER w AS began
        FROM s_payments WINDOW w AS (PARTITION BY customer_id ORDER BY attempt_ts, payment_id))
    WHERE result = 'success' AND r1 = 'failed' AND r2 = 'failed' AND r3 = 'failed' AND attempt_ts - began <= INTERVAL 24 HOUR"""
_HOP_SQL = """
    SELECT customer_id, payment_id AS event_id, began AS started, attempt_ts AS ended FROM (
        SELECT *, lag(hop) OVER w AS hop_before, lag(attempt_ts) OVER w AS began FROM (
            SELECT *, coalesce(device_id <> lag(device_id) OVER w, FALSE) AS hop
            FROM s_payments WINDOW w AS (PARTITION BY customer_id ORDER BY attempt_ts, payment_id))
        WINDOW w AS (PARTITION BY customer_id ORDER BY attempt_ts, payment_id))
    WHERE hop AND hop_before AND attempt_ts - began <= INTERVAL 7 DAY"""


def _click_sql(upto: str) -> str:
    return f"""
    SELECT customer_id, event_id, ts AS started, ts + INTERVAL 6 HOUR AS ended FROM (
        SELECT *, min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (PARTITION BY customer_id ORDER BY ts, event_id
            ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS bought FROM s_events)
    WHERE event_type = 'click' AND (bought IS NULL OR bought - ts > INTERVAL 6 HOUR) AND ts + INTERVAL 6 HOUR <= {upto}"""


def _attempts(shop):
    return shop.attempts.select("customer_id", F.col("payment_id").alias("event_id"), F.col("attempt_ts").alias("ts"), "result", "device_id")


@query("pattern_failure_success", _ROW, _FAILURE_SQL)
def pattern_failure_success(shop):
    """A success after three failures in a row, all in a day."""
    return matches(_attempts(shop), "customer_id", "ts", "event_id", FAILURE_SUCCESS)


@query("pattern_device_hop", _ROW, _HOP_SQL)
def pattern_device_hop(shop):
    """Two attempts in a row, each from another device than the one before, in a week."""
    return matches(_attempts(shop), "customer_id", "ts", "event_id", DEVICE_HOP)


@query("pattern_click_without_purchase", _ROW, _click_sql("(SELECT max(ts) FROM s_events)"))
def pattern_click_without_purchase(shop):
    """Clicks that no purchase of the customer follows in six hours, where the log goes on for so long."""
    upto = shop.events.agg(F.max(micros("ts"))).first()[0]
    return matches(shop.events, "customer_id", "ts", "event_id", CLICK_ONLY, F.lit(upto))


_PASSED = "(SELECT date_trunc('milliseconds', max({1})) - INTERVAL 10 MINUTE FROM {0})"


@query(
    "stream_patterns",
    f"pattern:s {_ROW}",
    f"""
    SELECT 'failure_success' AS pattern, * FROM ({_FAILURE_SQL}) WHERE ended <= {_PASSED.format('s_payments', 'attempt_ts')}
    UNION ALL SELECT 'device_hop', * FROM ({_HOP_SQL}) WHERE ended <= {_PASSED.format('s_payments', 'attempt_ts')}
    UNION ALL SELECT 'click_without_purchase', * FROM ({_click_sql(_PASSED.format('s_events', 'ts'))})""",
)
def stream_patterns(shop):
    """The three patterns over the event stream, up to the watermark; no stream waits for another."""
    events = shop.shape_events(streams.table_stream(shop.spark, shop.path, "events"))
    attempts = shop.shape_attempts(events).select(
        "customer_id", F.col("payment_id").alias("event_id"), F.col("attempt_ts").alias("ts"), "result", "device_id"
    )
    sources = {FAILURE_SUCCESS: attempts, DEVICE_HOP: attempts, CLICK_ONLY: events}
    with state_settings(shop, spark__sql__streaming__stateStore__providerClass=ROCKSDB):
        found = together(
            {
                p.name: lambda p=p, source=source: streams.run_to_table(live_matches(source, "customer_id", "ts", "event_id", p), p.name)
                for p, source in sources.items()
            }
        )
    return reduce(lambda a, b: a.unionByName(b), [df.select(F.lit(name).alias("pattern"), "*") for name, df in found.items()])
