"""Tables of the lake kept up to date and laid out for their joins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from etalage.session import fresh_dir
from etalage.sources.streams import finish


def refresh_days(
    spark: SparkSession, bronze: str, schema: StructType, gold: str, build: Callable[[DataFrame], DataFrame], checkpoint: str, by: str = "day"
) -> list[dict]:
    """Build the days anew that files of the bronze layer have come in for since the last call; the others stay as
    they lie.

    Both layers have a folder for each ``by``, a calendar column. A stream over the bronze files tells which are new,
    once each; their days are read whole, with what was there before, and replaced in one write (dynamic partition
    overwrite), so a run that is repeated changes nothing. ``build`` makes rows of a day from rows of that day only.
    """
    days: list = []

    def replace(batch: DataFrame, batch_id: int) -> None:
        # A calendar column: the list is short.
        found = [r[0] for r in batch.select(by).distinct().collect()]
        days.append(sorted(map(str, found)))
        touched = F.col(by).isin([d for d in found if d is not None])
        if None in found:
            touched = F.coalesce(touched, F.lit(False)) | F.col(by).isNull()
        whole = batch.sparkSession.read.schema(schema).parquet(bronze).where(touched)
        build(whole).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(gold)

    stream = spark.readStream.schema(schema).parquet(bronze)
    finish(stream.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint))
    return days


def bucketed(df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
    """``df`` as a table whose files are dealt by a hash of ``by`` and sorted by it.

    Tables of as many buckets join and group on ``by`` where they lie, without a shuffle. A bucket is read by one task, so
    there should be as many as keep it to some 100 MB, and ``by`` a key that no value holds much of (an order, not a
    customer). One file a bucket: rows are dealt alike before the write.
    """
    spark = df.sparkSession
    table = f"etalage_{name}_{uuid.uuid4().hex[:12]}"
    writer = df.repartition(buckets, by).write.bucketBy(buckets, by).sortBy(by).format("parquet")
    writer.option("path", fresh_dir(spark, name)).saveAsTable(table)
    return spark.table(table)
