"""Streaming jobs: windows, sessions, joins, deduplication, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELAY = "10 minutes"


def timed(events: DataFrame) -> DataFrame:
    """Event time as a zoned timestamp, which watermarks need."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling_counts(events: DataFrame, minutes: int = 5, delay: str = DELAY) -> DataFrame:
    """Events per window and type; each task adds up its own before the shuffle."""
    w = F.window("ts", f"{minutes} minutes")
    counts = (
        timed(events).withWatermark("ts", delay).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"))
    )
    return counts.select(F.col("w.start").alias("window_start"), "event_type", "n")


def session_counts(events: DataFrame, gap: str = "30 minutes", delay: str = DELAY) -> DataFrame:
    """Sessions per customer, emitted once the watermark has passed their end.

    Set spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition to merge the rows of a
    session inside each task before the shuffle.
    """
    w = F.session_window("ts", gap)
    out = (
        timed(events)
        .withWatermark("ts", delay)
        .groupBy(w.alias("w"), "customer_id")
        .agg(F.max("ts").alias("session_end"), F.count("*").alias("n_events"))
    )
    return out.select(
        "customer_id", F.col("w.start").alias("session_start"), "session_end", "n_events"
    )


def sliding_attempts(
    payments: DataFrame,
    at_least: int,
    length: str = "10 minutes",
    slide: str = "1 minute",
    delay: str = DELAY,
) -> DataFrame:
    """Windows in which a customer made at least so many attempts."""
    w = F.window("ts", length, slide)
    counts = (
        timed(payments)
        .withWatermark("ts", delay)
        .groupBy(w.alias("w"), "customer_id")
        .agg(F.count("*").alias("attempts"))
    )
    return counts.where(F.col("attempts") >= at_least).select(
        "customer_id", F.col("w.start").alias("window_start"), "attempts"
    )


def unique_events(events: DataFrame, key: str = "event_id", delay: str = "2 days") -> DataFrame:
    """Drop events seen again within the delay."""
    return timed(events).withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def enrich(events: DataFrame, customers: DataFrame) -> DataFrame:
    """Events with their customer; the table is read anew for each batch."""
    return events.join(customers.select("customer_id", "country", "segment"), "customer_id", "left")


def _per_minute(events: DataFrame, count: str, at: str, who: str, delay: str) -> DataFrame:
    w = F.window("ts", "1 minute")
    counts = (
        timed(events)
        .withWatermark("ts", delay)
        .groupBy(w.alias("w"), F.col("customer_id").alias(who))
        .agg(F.count("*").alias(count))
    )
    return counts.select(who, F.window_time("w").alias(at), count)


def click_to_purchase(
    clicks: DataFrame, purchases: DataFrame, minutes: int = 30, delay: str = DELAY
) -> DataFrame:
    """Minutes with purchases and the minutes with clicks of the same customer up to ``minutes`` before.

    Both streams are counted per customer and minute before they meet, so that a customer has at most
    one row per minute on either side and ``minutes`` + 1 matches per row, however busy.
    """
    c = _per_minute(clicks, "clicks", "click_at", "customer_id", delay)
    p = _per_minute(purchases, "purchases", "purchase_at", "buyer", delay)
    near = (
        (F.col("customer_id") == F.col("buyer"))
        & (F.col("purchase_at") >= F.col("click_at"))
        & (F.col("purchase_at") <= F.col("click_at") + F.expr(f"interval {minutes} minutes"))
    )
    return c.join(p, near).select(
        "customer_id",
        F.date_trunc("minute", "click_at").alias("click_minute"),
        F.date_trunc("minute", "purchase_at").alias("purchase_minute"),
        "clicks",
        "purchases",
    )


def write_twice(table: str, topic: str):
    """foreachBatch writer to a table and a topic folder.

    Each batch owns one folder per sink and replaces it, so a batch that is run again leaves no
    row twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
            message = batch.select(
                F.col("payment_id").cast("string").alias("key"),
                F.to_json(F.struct(*batch.columns)).alias("value"),
            )
            message.write.mode("overwrite").parquet(f"{topic}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write
