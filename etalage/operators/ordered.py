"""Ordered per-key work that does not put a whole key into one task.

A window over ``partitionBy(customer)`` sends every row of a customer to one task, so one busy
customer holds the job up. The functions here place rows by range of (key, time) and write the
placement out. A piece of it holds as many rows as any other, whoever they belong to. Work is done
inside (key, piece). Only the last key of a piece can go on in the next one, so what is passed on
is at most one summary row for each piece.

The bounds of the pieces are sampled by Spark; their number follows from the size of the input.
(Rows of one key at the very same time are the one thing that stays together.)
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.functions.columns import micros
from etalage.session import write_through

HOUR = 3600
DAY = 24 * HOUR
#: Rows of a piece; one key and piece is sorted in one task.
PIECE_ROWS = 2_000_000


def piece_count(df: DataFrame) -> int:
    """As many pieces as the rows need, and no fewer than the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(df.count() / PIECE_ROWS))


def placed(df: DataFrame, key: str, at: Column, pieces: int | None = None) -> DataFrame:
    """``df`` with ``_piece``, placed by key and ``at`` and written, so that the placement is the same
    wherever it is used. Rows of one key and time are in one piece."""
    n = pieces or piece_count(df)
    spread = df.withColumn("_at_", at).repartitionByRange(n, key, "_at_").drop("_at_")
    return write_through(spread.withColumn("_piece", F.spark_partition_id()), "placed")


def crossings(rows: DataFrame, key: str) -> DataFrame:
    """``_key``, ``_piece`` and ``_next`` of each piece whose last key goes on in the next piece: a row for
    each piece at most."""
    ends = rows.groupBy("_piece").agg(
        F.min(F.struct(F.col(key).alias("_key"))).alias("_first"), F.max(F.struct(F.col(key).alias("_key"))).alias("_last")
    )
    # One row per piece.
    line = Window.orderBy("_piece")
    following = ends.select(
        "_piece", "_last", F.lead("_piece").over(line).alias("_next"), F.lead("_first").over(line).alias("_then")
    )
    goes_on = F.col("_next").isNotNull() & F.col("_last._key").eqNullSafe(F.col("_then._key"))
    return write_through(following.where(goes_on).select("_last._key", "_piece", "_next"), "crossings")


def at_edges(rows: DataFrame, key: str, cross: DataFrame) -> DataFrame:
    """The rows that are carried on: those of each piece's last key, where it goes on. With ``_next``."""
    # At most a row for each piece is sent to all tasks.
    edge = F.broadcast(cross.withColumnRenamed("_piece", "_edge"))
    here = (F.col("_piece") == F.col("_edge")) & F.col(key).eqNullSafe(F.col("_key"))
    return rows.join(edge, here).drop("_edge", "_key")


def joined(rows: DataFrame, key: str, carried: DataFrame, how: str = "left") -> DataFrame:
    """``rows`` with what is carried into their key and piece; ``carried`` has a row for each piece at most."""
    other = F.broadcast(carried.withColumnRenamed(key, "_key").withColumnRenamed("_next", "_into"))
    here = (F.col("_piece") == F.col("_into")) & F.col(key).eqNullSafe(F.col("_key"))
    return rows.join(other, here, how).drop("_key", "_into")


def carried_on(summary: DataFrame, key: str, sums: list[str], lasts: list[str]) -> DataFrame:
    """Summaries of the edges added up over the pieces of a key: key, ``_next`` and the values carried there."""
    upto = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, 0)
    return summary.select(
        key,
        "_next",
        *[F.sum(n).over(upto).alias(n) for n in sums],
        *[F.last(n, ignorenulls=True).over(upto).alias(n) for n in lasts],
    )


def trailing(
    df: DataFrame,
    key: str,
    ts: str,
    counts: dict[str, tuple[Column, int]],
    totals: dict[str, Column] | None = None,
    previous: dict[str, str] | None = None,
    order: str | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Counts over the closed range [t - seconds, t], sums over all earlier rows, the row before.

    ``counts`` maps a name to (condition, seconds). Each row becomes an entry mark at t (+1) and one
    leave mark per count just after t + seconds (-1); the running sum of the marks is the count, at
    linear cost however many rows a range holds. ``totals`` maps a name to the column to add up over
    the rows before, ``previous`` maps a new name to the column whose value on the row before is
    wanted; before means by ts, then ``order``. All of it takes one large shuffle. A row without a
    time is kept, counts for no other, and has nulls for all of these.
    """
    totals, previous = totals or {}, previous or {}
    columns = [c for c in df.columns if c != key]
    payload = F.struct(*columns)
    shape = df.select(payload.alias("p"), *[c.alias(n) for n, c in totals.items()]).schema
    empty = F.lit(None).cast(shape["p"].dataType)
    tie = F.col(order) if order else F.lit(0)
    dated = F.col(ts).isNotNull()
    hits = {n: F.when(dated & cond, 1).otherwise(0) for n, (cond, _) in counts.items()}
    adds = {n: F.when(dated, c) for n, c in totals.items()}
    t = micros(ts)

    def mark(at: Column, row: Column, steps: dict[str, Column], sums: dict[str, Column]) -> Column:
        return F.struct(
            at.alias("_at"),
            tie.alias("_tie"),
            row.alias("_row"),
            *[c.alias(n) for n, c in steps.items()],
            *[c.alias(n) for n, c in sums.items()],
        )

    none = {n: F.lit(None).cast(shape[n].dataType) for n in totals}
    # Rule by rule only what is asked for: no counts, no leave marks.
    leaving = [
        F.when(
            hits[n] == 1,
            mark(
                (t + F.lit(seconds * 1_000_000)) * 2 + 1,
                empty,
                {m: F.lit(-1 if m == n else 0) for m in counts},
                none,
            ),
        )
        for n, (_, seconds) in counts.items()
    ]
    entering = mark(t * 2, payload, hits, adds)

    # The marks, not the rows, are what a piece holds: place by their times.
    marks = [entering, *leaving]
    swept = df.select(key, F.inline(F.array(*marks))).where("_at is not null or _row is not null")
    swept = placed(swept, key, F.col("_at"), pieces)

    # What an edge passes on: the sums of its marks, and its last row.
    sums = [*counts, *totals]
    passed = [F.sum(n).alias(f"_s_{n}") for n in sums]
    wanted = F.when(
        F.col("_row").isNotNull() & F.col("_at").isNotNull(),
        F.struct(*[F.col(f"_row.{c}").alias(n) for n, c in previous.items()]),
    )
    if previous:
        last_at = F.when(
            F.col("_row").isNotNull() & F.col("_at").isNotNull(), F.struct("_at", "_tie")
        )
        passed.append(F.max_by(wanted, last_at).alias("_last"))
    edges = at_edges(swept, key, crossings(swept, key))
    carried = carried_on(
        edges.groupBy(key, "_piece", "_next").agg(*passed), key, [f"_s_{n}" for n in sums], ["_last"] if previous else []
    )

    # Inside a piece.
    here = Window.partitionBy(key, "_piece")
    before = here.orderBy("_at", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    upto = here.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = swept
    if totals or previous:
        found = [F.sum(n).over(before).alias(n) for n in totals]
        if previous:
            found.append(F.last(wanted, ignorenulls=True).over(before).alias("_before"))
        inside = inside.select(key, "_piece", "_at", "_row", *counts, *found)
    inside = inside.select(
        key,
        "_piece",
        "_row",
        *[F.sum(n).over(upto).alias(n) for n in counts],
        *totals,
        *(["_before"] if previous else []),
    ).where("_row is not null")

    zero = F.lit(0)

    had_time = F.col(f"_row.{ts}").isNotNull()

    def added(n: str) -> Column:
        return F.when(had_time, F.coalesce(n, zero) + F.coalesce(f"_s_{n}", zero))

    out = joined(inside, key, carried)
    if previous:
        out = out.withColumn("_before", F.when(had_time, F.coalesce("_before", "_last")))
    return out.select(
        key,
        "_row.*",
        *[added(n).cast("bigint").alias(n) for n in counts],
        *[added(n).alias(n) for n in totals],
        *[f"_before.{n}" for n in previous],
    )


def with_rows_before(
    df: DataFrame, key: str, ts: str, order: str, rows: int, pieces: int | None = None
) -> DataFrame:
    """Add ``_piece`` and ``_live``, and give each piece the last ``rows`` rows before it as context.

    A window over (key, _piece) then sees up to ``rows`` rows back from every live row. Only the last
    rows of a piece's last key travel; the list carried to a piece is at most ``rows`` long.
    """
    all_rows = placed(df, key, F.col(ts), pieces)
    newest = Window.partitionBy(key, "_piece").orderBy(F.col(ts).desc(), F.col(order).desc())
    tails = (
        at_edges(all_rows, key, crossings(all_rows, key))
        .withColumn("_back", F.row_number().over(newest))
        .where(F.col("_back") <= rows)
    )
    line = Window.partitionBy(key).orderBy("_piece", F.col("_back").desc())
    carried = (
        tails.withColumn("_before", F.collect_list(F.struct(*df.columns)).over(line.rowsBetween(1 - rows, 0)))
        .where("_back = 1")
        .select(F.col("_next").alias("_piece"), F.inline("_before"))
    )
    return all_rows.withColumn("_live", F.lit(True)).unionByName(carried.withColumn("_live", F.lit(False)))


def with_history(
    df: DataFrame,
    key: str,
    ts: str,
    order: str,
    totals: dict[str, Column] | None = None,
    latest: dict[str, tuple[Column, Column]] | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Sums over, and last values of, all earlier rows of the key.

    ``totals`` maps a name to the column to add up; ``latest`` maps a name to (value, condition).
    Inside a piece these are windows; a key that began in an earlier piece starts from what is carried in.
    """
    totals = totals or {}
    latest = latest or {}
    rows = placed(df, key, F.col(ts), pieces)
    at = F.struct(F.col(ts), F.col(order))
    edges = at_edges(rows, key, crossings(rows, key)).groupBy(key, "_piece", "_next").agg(
        *[F.sum(c).alias(f"_s_{n}") for n, c in totals.items()],
        *[
            F.max_by(F.when(cond, F.struct(v.alias("v"))), F.when(cond, at)).alias(f"_l_{n}")
            for n, (v, cond) in latest.items()
        ],
    )
    carried = carried_on(edges, key, [f"_s_{n}" for n in totals], [f"_l_{n}" for n in latest])
    inside = (
        Window.partitionBy(key, "_piece")
        .orderBy(ts, order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    found = rows.select(
        *df.columns,
        "_piece",
        *[F.sum(c).over(inside).alias(n) for n, c in totals.items()],
        *[
            F.last(F.when(cond, F.struct(v.alias("v"))), ignorenulls=True).over(inside).alias(n)
            for n, (v, cond) in latest.items()
        ],
    )
    zero = F.lit(0)
    return joined(found, key, carried).select(
        *df.columns,
        *[(F.coalesce(n, zero) + F.coalesce(f"_s_{n}", zero)).alias(n) for n in totals],
        *[F.coalesce(n, f"_l_{n}")["v"].alias(n) for n in latest],
    )


def sessionize(
    df: DataFrame,
    key: str,
    ts: str,
    gap: int,
    sums: dict[str, Column] | None = None,
    firsts: dict[str, Column] | None = None,
    order: str | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Sessions per key: a new one starts when the gap to the row before is longer than ``gap`` s.

    ``sums`` are added up per session, ``firsts`` taken from its first row (by ts, then ``order``).
    Sessions are built inside each piece; only the last of a piece whose key goes on, and the first of
    the piece it goes on in, are looked at again: two for each piece at most.
    """
    sums = {"n_events": F.lit(1), **(sums or {})}
    firsts = firsts or {}
    gap_us = F.lit(gap * 1_000_000)
    rows = df.select(
        key,
        F.col(ts).alias("_ts"),
        (F.col(order) if order else F.lit(0)).alias("_tie"),
        *[c.cast("bigint").alias(n) for n, c in sums.items()],
        *[c.alias(n) for n, c in firsts.items()],
    )
    rows = placed(rows, key, F.col("_ts"), pieces)
    cross = crossings(rows, key)
    inside = Window.partitionBy(key, "_piece").orderBy("_ts")
    gap_before = micros("_ts") - micros(F.lag("_ts").over(inside))
    parts = (
        rows.withColumn("_new", (F.coalesce(gap_before, gap_us + 1) > gap_us).cast("int"))
        .withColumn("_part", F.sum("_new").over(inside))
        .groupBy(key, "_piece", "_part")
        .agg(
            F.min("_ts").alias("session_start"),
            F.max("_ts").alias("session_end"),
            *[F.sum(n).alias(n) for n in sums],
            *[F.min_by(n, F.struct("_ts", "_tie")).alias(n) for n in firsts],
        )
        .withColumn("_last", F.max("_part").over(Window.partitionBy(key, "_piece")))
    )
    out_of = cross.select(F.col("_key").alias(key), F.col("_piece").alias("_next"), F.lit(True).alias("_goes_on"))
    into = cross.select(F.col("_key").alias(key), "_next", F.lit(True).alias("_came_in"))
    parts = joined(joined(parts, key, out_of), key, into)
    at_edge = F.coalesce(
        (F.col("_goes_on") & (F.col("_part") == F.col("_last"))) | (F.col("_came_in") & (F.col("_part") == 1)), F.lit(False)
    )
    parts = parts.withColumn("_edge", at_edge)
    cols = [key, "session_start", "session_end", *sums, *firsts]
    inner = parts.where("not _edge").select(cols)
    line = Window.partitionBy(key).orderBy("session_start")
    since = micros("session_start") - micros(F.lag("session_end").over(line))
    edges = (
        parts.where("_edge")
        .withColumn("_new", (F.coalesce(since, gap_us + 1) > gap_us).cast("int"))
        .withColumn("_session", F.sum("_new").over(line))
        .groupBy(key, "_session")
        .agg(
            *[F.min_by(n, "session_start").alias(n) for n in firsts],
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            *[F.sum(n).alias(n) for n in sums],
        )
        .select(cols)
    )
    return inner.unionByName(edges)


def global_row_number(
    df: DataFrame, order: list[Column], name: str = "rn", partitions: int | None = None
) -> DataFrame:
    """Exact 1..n over the whole table without sorting it in one task.

    Rows are placed by range, sorted and numbered where they lie, and written (so that the placement
    cannot change on recomputation); a row's number is its place in its piece plus the rows of the
    pieces before. One shuffle. ``order`` must end in a unique column.
    """
    n = partitions or piece_count(df)
    numbered = write_through(
        # The id has the partition in its high bits and the place in the partition in its low 33.
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_piece", F.shiftright("_id", 33))
    # One row per piece.
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_piece")
        .agg(F.count("*").alias("_rows"))
        .select("_piece", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col("_id").bitwiseAND((1 << 33) - 1) + 1
    return (
        numbered.join(F.broadcast(offsets), "_piece")
        .withColumn(name, (place + F.col("_offset")).cast("bigint"))
        .drop("_piece", "_id", "_offset")
    )


def ntile_of(rn: str | Column, rows: Column, tiles: int) -> Column:
    """The NTILE number of row ``rn`` among ``rows``: the first ``rows % tiles`` tiles hold one more."""
    r = F.col(rn) if isinstance(rn, str) else rn
    size = F.floor(rows / F.lit(tiles)).cast("bigint")
    big = rows % F.lit(tiles)
    in_big = r <= big * (size + 1)
    return F.when(
        in_big, F.floor((r - 1) / (size + 1)) + 1
    ).otherwise(
        big + F.floor((r - 1 - big * (size + 1)) / F.greatest(size, F.lit(1))) + 1
    ).cast("bigint")
