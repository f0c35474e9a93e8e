"""Stream sources and sinks over files."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from etalage.schemas import STAR
from etalage.session import fresh_dir


def table_stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One table of a folder of Parquet files as a stream."""
    return (
        spark.readStream.schema(STAR[table])
        .option("pathGlobFilter", f"{table}.parquet")
        .parquet(folder)
    )


def folder_stream(spark: SparkSession, folder: str, schema: StructType, **options) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    return spark.readStream.schema(schema).options(**options).parquet(folder)


def external_stream(spark: SparkSession, format: str, **options: str) -> DataFrame:
    """Any other stream source (``kafka``); its jar must be on the class path."""
    return spark.readStream.format(format).options(**options).load()


def finish(writer: DataStreamWriter) -> list[dict]:
    """Run a query over all that has arrived, then stop; returns the progress of its batches."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return [p if isinstance(p, dict) else p.jsonValue for p in query.recentProgress]


#: One row for each batch of a query.
PROGRESS = "query string, batch_id long, started timestamp, input_rows long, late_rows long, state_rows long"


def progress_row(progress: dict) -> tuple:
    """How much came in, how much of it was too late and dropped, how much is held in state."""
    operators = progress["stateOperators"]
    return (
        progress["name"] or str(progress["id"]),
        int(progress["batchId"]),
        datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")),
        int(progress["numInputRows"]),
        sum(int(o["numRowsDroppedByWatermark"]) for o in operators),
        sum(int(o["numRowsTotal"]) for o in operators),
    )


def progress_rows(spark: SparkSession, progress: list[dict]) -> DataFrame:
    return spark.createDataFrame([progress_row(p) for p in progress], PROGRESS)


class ProgressLog(StreamingQueryListener):
    """Appends a row for each batch of the session's queries to a table; ``spark.streams.addListener(...)``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = json.loads(event.progress.json)
        progress_rows(self.spark, [found]).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def keep_running(writer: DataStreamWriter, every: str = "15 minutes") -> StreamingQuery:
    """Start a query that takes in what is new at an interval, until it is stopped."""
    return writer.trigger(processingTime=every).start()


def append_to(stream: DataFrame, path: str, checkpoint: str, by: str | None = None) -> DataStreamWriter:
    """Exactly-once append: the file sink's log and the checkpoint together."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return writer.partitionBy(by) if by else writer


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Process what is there into a fresh table and read it back."""
    spark = stream.sparkSession
    path = fresh_dir(spark, name)
    finish(append_to(stream, path, fresh_dir(spark, f"{name}-checkpoint")))
    return spark.read.schema(stream.schema).parquet(path)


def replay(
    spark: SparkSession,
    arrivals: list[DataFrame],
    build: Callable[[DataFrame], DataFrame],
    name: str,
) -> tuple[DataFrame, list[dict]]:
    """Let ``arrivals`` come in one after the other, running the query after each.

    This is how a scheduled micro-batch works: one checkpoint, every run takes on the files that are
    new and goes on from the state of the run before.
    """
    inbox, path = fresh_dir(spark, f"{name}-inbox"), fresh_dir(spark, name)
    checkpoint = fresh_dir(spark, f"{name}-checkpoint")
    progress: list[dict] = []
    schema = None
    for arrival in arrivals:
        arrival.write.mode("append").parquet(inbox)
        out = build(folder_stream(spark, inbox, arrival.schema))
        schema = out.schema
        progress += finish(append_to(out, path, checkpoint))
    return spark.read.schema(schema).parquet(path), progress
