"""Exact deduplication with a stateful stream.

Digests of the texts arrive as a stream. Keyed state on disk (RocksDB), which never expires, holds
for each digest the identifier of the row that stays, the place of its content (file and row) and
the number of rows. A digest seen before is a hit; the full bytes behind hits are then compared
with the content at the place the state names, so that two texts with one digest stay apart.

Of equal texts the row with the largest key stays, then the last place. Null text counts as empty.
A null key is smaller than any other; repeated rows are a group of which one row stays. An empty
table gives an empty table.

With a ``folder`` the state lasts: a further feed goes on from it, its rows meet all that came before, and a row that
has stayed is not driven out by a later feed. The files of earlier feeds must still be there, as the state holds places
and no texts.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from etalage.llm.common import in_files, located
from etalage.session import fresh_dir, settings, write_through

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def text_digest(text: Column) -> Column:
    """SHA-256 of the text's UTF-8 bytes, in lower-case hex."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def keep_state(rows: DataFrame, files_per_batch: int = 10_000, folder: str | None = None) -> DataFrame:
    """digest, keeper (key and place) and n of each digest: the state after all of ``rows`` has streamed in.

    ``rows`` has digest, turn (less the number of the feed), key and place. Rows of a digest are summed up in their task before the shuffle, so a digest that a third of the
    rows share sends one row from each task. ``files_per_batch`` bounds a micro-batch.
    """
    spark = rows.sparkSession
    inbox, checkpoint = (f"{folder}/{n}" if folder else fresh_dir(spark, n) for n in ("digests", "dedup-state"))
    rows.write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_batch).parquet(inbox)
    state = stream.groupBy("digest").agg(F.max(F.struct("turn", "key", "_loc")).alias("keeper"), F.count("*").alias("n"))
    with settings(
        spark,
        spark__sql__streaming__stateStore__providerClass=ROCKSDB,
        spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage="true",
        spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB="200",
        spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
        # A partition's store is closed when its task is done: open ones cost memory and disk.
        spark__sql__streaming__stateStore__unloadOnCommit="true",
    ):
        writer = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
        held = spark.read.format("statestore").load(checkpoint)
        keeper, n = (f"value.{c}" for c in held.schema["value"].dataType.names)
        stays = F.struct(*[F.col(f"{keeper}.{c}").alias(c) for c in ("key", "_loc")])
        return write_through(held.select("key.digest", stays.alias("keeper"), F.col(n).alias("n")), "state")


def earlier_feeds(spark: SparkSession, folder: str | None) -> DataFrame | None:
    """digest, turn, key and place of all rows that came before; None before the first feed."""
    try:
        return spark.read.parquet(f"{folder}/digests") if folder else None
    except AnalysisException:
        return None


def contents(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` (with ``_loc``) with the text at their places, read from the files that the places name."""
    files = [r[0] for r in rows.select("_loc.file").distinct().collect()]
    if not files:
        return rows.withColumn("text", F.lit("")).where("false")
    found = located(rows.sparkSession.read.parquet(*files), [F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")])
    return rows.join(found, "_loc")


def only_hits(texts: DataFrame, hits: DataFrame, most_sent: int = 1_000_000) -> DataFrame:
    """The rows whose digest is in ``hits``, and no others that matter.

    Up to ``most_sent`` hits, 8 bytes of hash of each are sent to every task, so that no text moves; a row
    let through by an equal hash is compared for nothing. Beyond, the texts meet the hits in a shuffle.
    """
    marks = write_through(hits.select(F.xxhash64("digest").alias("mark")), "hits")
    if marks.count() <= most_sent:
        marks = F.broadcast(marks)
    return texts.join(marks, F.xxhash64("digest") == F.col("mark"), "left_semi")


def exact_duplicates(
    docs: DataFrame, key: Column, text: str = "text", digest=text_digest, files_per_batch: int = 10_000, folder: str | None = None
) -> DataFrame:
    """key, _loc (the row's place), digest, keeper (key and place of the row that stays), n (rows of the
    group) and kept, for every row. ``digest`` makes the digest column from the text column.

    ``folder`` holds the state from feed to feed; the keeper can then be a row of an earlier one, and n counts all.
    """
    content = F.col(f"`{text}`")
    texts = located(
        in_files(docs),
        [key.alias("key"), F.coalesce(content, F.lit("")).alias("text"), digest(content).alias("digest")],
    )
    before = earlier_feeds(docs.sparkSession, folder)
    turn = 0 if before is None else (before.agg(F.min("turn")).first()[0] or 0) - 1
    rows = write_through(texts.select("digest", F.lit(turn).alias("turn"), "key", "_loc"), "digested")
    # Places are pinned before this feed is added to them.
    before = None if before is None else write_through(before.join(rows.select("digest"), "digest", "left_semi"), "met")
    state = keep_state(rows, files_per_batch, folder)
    hits = state.where("n > 1")
    if before is not None:
        hits = hits.join(rows.select("digest"), "digest", "left_semi")
    # Full bytes: the different texts behind each hit, each sent once by a task. Where a digest has one text
    # only, all its rows equal the content that the state points to.
    behind = only_hits(texts, hits.select("digest")).select("digest", "text")
    if before is not None:
        held = before.join(hits.select("digest", "keeper._loc"), ["digest", "_loc"], "left_semi").select("digest", "_loc")
        behind = behind.unionByName(contents(held, text).select("digest", "text"))
    behind = behind.groupBy("digest", "text").agg(F.count("*").alias("n"))
    collided = write_through(behind.groupBy("digest").count().where("count > 1").select("digest"), "collided")
    found = rows.join(state, "digest").drop("turn")
    if not collided.isEmpty():
        # Groups of these digests are made from the texts themselves.
        apart = texts.join(collided, "digest", "left_semi").withColumn("turn", F.lit(turn))
        whole = apart
        if before is not None:
            whole = whole.unionByName(contents(before.join(collided, "digest", "left_semi"), text))
        groups = whole.groupBy("digest", "text").agg(F.max(F.struct("turn", "key", "_loc")).alias("keeper"), F.count("*").alias("n"))
        groups = groups.withColumn("keeper", F.col("keeper").dropFields("turn"))
        split = apart.join(groups, ["digest", "text"]).select("digest", "key", "_loc", "keeper", "n")
        found = found.join(collided, "digest", "left_anti").unionByName(split)
    return found.withColumn("kept", F.col("_loc") == F.col("keeper._loc"))
