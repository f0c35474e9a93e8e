"""Streaming queries, run over the given events until all that has arrived is processed."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from etalage.functions import values as v
from etalage.functions.columns import micros
from etalage.plans.registry import query
from etalage.session import fresh_dir, settings, together, write_through
from etalage.sources import streams
from etalage.streaming import jobs, stateful

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# The watermark after the last event: windows that end later are still open.
_CLOSED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM s_events)"


def state_settings(shop, **more: str):
    """State is laid out once, when a query first starts: as many partitions as there are cores."""
    cores = str(shop.spark.sparkContext.defaultParallelism)
    return settings(shop.spark, spark__sql__shuffle__partitions=cores, **more)


def _events(shop):
    return shop.shape_events(streams.table_stream(shop.spark, shop.path, "events"))


def _split(df, *bounds: str):
    """Cut a table by time: before the first bound, between each two, from the last on."""
    cuts = [F.lit(b).cast("timestamp_ntz") for b in bounds]
    ts = F.col("ts")
    parts = [df.where(ts < cuts[0])]
    parts += [df.where((ts >= a) & (ts < b)) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [*parts, df.where(ts >= cuts[-1])]


@query(
    "stream_replay",
    "event_type:s n:l value:m first_ts:t last_ts:t",
    """
    SELECT event_type, count(*) AS n, sum(value) AS value, min(ts) AS first_ts, max(ts) AS last_ts
    FROM s_events GROUP BY 1""",
)
def stream_replay(shop):
    """The event log replayed in three arrivals, in time order."""
    parts = _split(shop.events, "2024-01-10", "2024-01-20")
    out, _ = streams.replay(shop.spark, parts, lambda s: s, "replayed")
    return out.groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.sum("value").alias("value"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


@query(
    "stream_bronze_append",
    "day:d n:l digest:l",
    """
    SELECT CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(CAST(('0x' || substr(md5(concat_ws('|',
        event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), user_id, event_type, CAST(value AS DECIMAL(18, 2)), props)), 1, 8)) AS BIGINT)) AS BIGINT)
        AS digest
    FROM events GROUP BY 1""",
)
def stream_bronze_append(shop):
    """Raw events appended to the bronze layer, one folder per day."""
    spark = shop.spark
    path = fresh_dir(spark, "bronze/events")
    stream = streams.table_stream(spark, shop.path, "events").withColumn("day", F.to_date("ts"))
    streams.finish(streams.append_to(stream, path, fresh_dir(spark, "bronze-checkpoint"), by="day"))
    row = F.concat_ws(
        "|",
        F.col("event_id").cast("string"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.col("user_id").cast("string"),
        "event_type",
        F.col("value").cast("decimal(18,2)").cast("string"),
        "props",
    )
    # Columns that change places change the sum.
    digest = F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("bigint")
    return spark.read.parquet(path).groupBy("day").agg(F.count("*").alias("n"), F.sum(digest).alias("digest"))


@query(
    "stream_tumbling_5min",
    "window_start:t event_type:s n:l",
    f"""
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS n FROM s_events
    GROUP BY 1, 2 HAVING time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= {_CLOSED}""",
)
def stream_tumbling_5min(shop):
    with state_settings(shop):
        return streams.run_to_table(jobs.tumbling_counts(_events(shop)), "tumbling")


@query(
    "stream_sessions",
    "customer_id:l session_start:t session_end:t n_events:l",
    f"SELECT * FROM s_sessions WHERE session_end + INTERVAL 30 MINUTE <= {_CLOSED}",
)
def stream_sessions(shop):
    with state_settings(
        shop, spark__sql__streaming__sessionWindow__merge__sessions__in__local__partition="true"
    ):
        return streams.run_to_table(jobs.session_counts(_events(shop)), "sessions")


@query(
    "stream_velocity_sliding",
    "customer_id:l window_start:t attempts:l",
    f"""
    SELECT customer_id, window_start, count(*) AS attempts FROM (
        SELECT customer_id, ts, time_bucket(INTERVAL 1 MINUTE, ts) - to_minutes(CAST(i AS BIGINT)) AS window_start
        FROM s_events, range(11) r(i) WHERE event_type IN ('purchase', 'error'))
    WHERE ts < window_start + INTERVAL 10 MINUTE AND window_start + INTERVAL 10 MINUTE <= (
        SELECT max(ts) - INTERVAL 10 MINUTE FROM s_events WHERE event_type IN ('purchase', 'error'))
    GROUP BY 1, 2 HAVING count(*) >= 2""",
)
def stream_velocity_sliding(shop):
    """Ten-minute windows, one per minute, with two or more attempts of a customer."""
    attempts = _events(shop).where(F.col("event_type").isin("purchase", "error"))
    with state_settings(shop):
        return streams.run_to_table(jobs.sliding_attempts(attempts, at_least=2), "velocity")


@query(
    "stream_late_drop",
    "window_start:t event_type:s n:l",
    f"""
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM s_events
    WHERE NOT (event_type = 'error' AND ts < TIMESTAMP '2024-01-10')
    GROUP BY 1, 2 HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= {_CLOSED}""",
)
def stream_late_drop(shop):
    """Failed attempts of the first days arrive last, behind the watermark, and are left out."""
    late = (F.col("event_type") == "error") & (
        F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")
    )
    first, rest = _split(shop.events, "2024-01-10")
    arrivals = [first.where(~late), rest, shop.events.where(late)]
    with state_settings(shop):
        out, _ = streams.replay(
            shop.spark, arrivals, lambda s: jobs.tumbling_counts(s, minutes=60), "late"
        )
    return out


@query(
    "stream_dedup",
    "event_type:s n:l events:l",
    "SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS events FROM s_events GROUP BY 1",
)
def stream_dedup(shop):
    """Two deliveries that share a day; each event counts once."""
    ts = F.col("ts")
    first = shop.events.where(ts < F.lit("2024-01-16").cast("timestamp_ntz"))
    second = shop.events.where(ts >= F.lit("2024-01-15").cast("timestamp_ntz"))
    with state_settings(shop):
        out, _ = streams.replay(shop.spark, [first, second], jobs.unique_events, "unique")
    return out.groupBy("event_type").agg(
        F.count("*").alias("n"), F.countDistinct("event_id").alias("events")
    )


@query(
    "stream_late_counts",
    "arrival:l came:l late:l",
    """
    SELECT 0 AS arrival, count(*) FILTER (ts >= TIMESTAMP '2024-01-10') AS came, 0 AS late FROM s_events
    UNION ALL
    SELECT 1, count(*) FILTER (ts < TIMESTAMP '2024-01-10'), count(*) FILTER (ts < TIMESTAMP '2024-01-10'
        AND ts <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 DAY FROM s_events)) FROM s_events""",
)
def stream_late_counts(shop):
    """Two deliveries in the wrong order: how much of each came, and how much of it was behind the watermark."""
    first, second = _split(shop.events, "2024-01-10")
    with state_settings(shop):
        _, progress = streams.replay(shop.spark, [second, first], jobs.unique_events, "late-counts")
    logged = streams.progress_rows(shop.spark, progress)
    # A run's batches follow each other; the second delivery is the second batch that reads anything.
    arrival = F.sum((F.col("input_rows") > 0).cast("long")).over(Window.orderBy("batch_id")) - 1
    return (
        logged.withColumn("arrival", arrival)
        .groupBy("arrival")
        .agg(F.sum("input_rows").alias("came"), F.sum("late_rows").alias("late"))
    )


@query(
    "stream_enrich",
    "country:s event_type:s n:l value:m",
    """
    SELECT country, event_type, count(*) AS n, sum(value) AS value
    FROM s_events e LEFT JOIN s_customers c ON e.customer_id = c.customer_id GROUP BY 1, 2""",
)
def stream_enrich(shop):
    rich = streams.run_to_table(jobs.enrich(_events(shop), shop.customers), "enriched")
    return rich.groupBy("country", "event_type").agg(
        F.count("*").alias("n"), F.sum("value").alias("value")
    )


def _minutes(kind: str, name: str) -> str:
    return f"""SELECT customer_id, time_bucket(INTERVAL 1 MINUTE, ts) AS at, count(*) AS {name} FROM s_events
    WHERE event_type = '{kind}' GROUP BY 1, 2
    HAVING time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE <= (
        SELECT least(max(ts) FILTER (event_type = 'click'), max(ts) FILTER (event_type = 'purchase'))
               - INTERVAL 10 MINUTE FROM s_events)"""


@query(
    "stream_interval_join",
    "customer_id:l click_minute:t purchase_minute:t clicks:l purchases:l",
    f"""
    SELECT c.customer_id, c.at AS click_minute, p.at AS purchase_minute, clicks, purchases
    FROM ({_minutes('click', 'clicks')}) c JOIN ({_minutes('purchase', 'purchases')}) p
      ON c.customer_id = p.customer_id AND p.at >= c.at AND p.at <= c.at + INTERVAL 30 MINUTE""",
)
def stream_interval_join(shop):
    clicks = _events(shop).where("event_type = 'click'")
    purchases = _events(shop).where("event_type = 'purchase'")
    with state_settings(shop):
        return streams.run_to_table(jobs.click_to_purchase(clicks, purchases), "pairs")


# Attempts are judged when the watermark, in whole milliseconds, has passed them.
_JUDGED = "(SELECT date_trunc('milliseconds', max(attempt_ts)) - INTERVAL 10 MINUTE FROM s_payments)"
_RULES = " UNION ALL ".join(
    f"SELECT payment_id, customer_id, attempt_ts AS ts, '{r}' AS rule FROM s_flags WHERE {r}" for r in v.RULES
)
_LIVE = f"""
    SELECT * FROM ({_RULES} UNION ALL
        SELECT payment_id, customer_id, attempt_ts, 'fail_then_success' FROM (
            SELECT *, lag(result, 1) OVER w AS r1, lag(result, 2) OVER w AS r2, lag(result, 3) OVER w AS r3,
                   lag(attempt_ts, 3) OVER w AS first_failure
            FROM s_payments WINDOW w AS (PARTITION BY customer_id ORDER BY attempt_ts, payment_id))
        WHERE result = 'success' AND r1 = 'failed' AND r2 = 'failed' AND r3 = 'failed'
          AND attempt_ts - first_failure <= INTERVAL 24 HOUR)
    WHERE ts <= {_JUDGED}"""
#: The attempts before this day come to a first run of the job, the others to one that goes on from a table of its past.
_SEEDED_UPTO = "2024-01-10"


def _live_attempts(shop, attempts):
    return shop.with_countries(attempts).withColumnRenamed("attempt_ts", "ts")


@query("stream_rules_stateful", "payment_id:l customer_id:l ts:t rule:s", _LIVE)
def stream_rules_stateful(shop):
    """The whole log by two runs of the job, each from a state of its own. The first begins with nothing and takes the
    attempts before a day. The second is seeded by the attempts that the first has judged, and takes all others: two
    arrivals cut inside a day, the rows of the first waiting for those of the second."""
    attempts = _live_attempts(shop, shop.attempts).where("ts is not null and customer_id is not null")
    past, _ = _split(attempts, _SEEDED_UPTO)
    # The watermark at the end of the first run, in whole milliseconds.
    latest = shop.attempts.where(F.col("attempt_ts") < F.lit(_SEEDED_UPTO).cast("timestamp_ntz")).where("customer_id is not null")
    reached = latest.agg((F.floor(F.max(micros("attempt_ts")) / 1000) - 600_000).alias("ms")).first().ms
    judged = F.lit(False) if reached is None else micros("ts") <= F.lit(reached * 1000)
    arrivals = _split(attempts.where(~judged), "2024-01-15 12:00:00")
    with state_settings(shop, spark__sql__streaming__stateStore__providerClass=ROCKSDB):
        seed = write_through(stateful.past_of(attempts.where(judged)), "past")
        runs = together(
            {
                "past": lambda: streams.replay(shop.spark, [past], stateful.attempt_alerts, "past-alerts")[0],
                "live": lambda: streams.replay(shop.spark, arrivals, lambda s: stateful.attempt_alerts(s, past=seed), "alerts")[0],
            }
        )
    return runs["past"].unionByName(runs["live"])


@query(
    "stream_alert_fanout",
    "sink:s rule:s n:l payments:l",
    f"""
    SELECT sink, rule, count(*) AS n, count(DISTINCT payment_id) AS payments
    FROM ({_LIVE}), (VALUES ('table'), ('topic')) s(sink) GROUP BY sink, rule""",
)
def stream_alert_fanout(shop):
    """The live job from an empty state: attempts, all rules and the pattern, to a table and to a topic."""
    spark = shop.spark
    table, topic = fresh_dir(spark, "alerts"), fresh_dir(spark, "fraud-alerts")
    attempts = _live_attempts(shop, shop.shape_attempts(_events(shop)))
    with state_settings(shop, spark__sql__streaming__stateStore__providerClass=ROCKSDB):
        streams.finish(
            stateful.attempt_alerts(attempts)
            .writeStream.foreachBatch(jobs.write_twice(table, topic))
            .option("checkpointLocation", fresh_dir(spark, "fanout-checkpoint"))
        )
    stored = spark.read.parquet(table).select(F.lit("table").alias("sink"), "rule", "payment_id")
    sent = spark.read.parquet(topic).select(
        F.lit("topic").alias("sink"),
        F.get_json_object("value", "$.rule").alias("rule"),
        F.col("key").cast("bigint").alias("payment_id"),
    )
    return stored.unionByName(sent).groupBy("sink", "rule").agg(
        F.count("*").alias("n"), F.countDistinct("payment_id").alias("payments")
    )
