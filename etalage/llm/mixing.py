"""Mixing sources to target weights over a time-varying curriculum.

A source's share of the mix comes from its weight; no source gives more than ``most`` times what it
has, and what is over is shared out again by weight. Its demand then runs over the training from 0
to 1 along a shape (a piecewise linear density): the integral of the shape, times the target, is
what has been asked of the source up to a time. The documents of a source lie on a tape in the
order of a hash of their keys, and the tape is run through again where more is asked than there is.
The place of a document on the tape is a cumulative demand; inverting the integral gives its
training position, and the documents are range-sorted by position.

Null text has no words and is never taken, like a text without words. A null source is a source of
its own, after all others. A null key counts as empty in the order. Equal rows are each placed. An
empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.operators.ordered import global_row_number
from etalage.session import write_through

#: A shape: (time, density) knots from time 0 to time 1, linear between them.
Shape = list[tuple[float, float]]
FLAT: Shape = [(0.0, 1.0), (1.0, 1.0)]


def targets(sizes: DataFrame, weights: list[int], most: int, shapes: int) -> DataFrame:
    """source_key, source_size, target and shape of every source of ``sizes`` (source, source_key, source_size).

    Sources in the order of their code points, null last, take the weights (and the shapes) in turn.
    """
    ranked = write_through(
        global_row_number(sizes, [F.col("source").isNull(), F.col("source")], "rank"), "sources"
    )
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * most
    table = ranked.withColumns({"weight": weight, "cap": cap, "_at": cap / weight})
    # A row a source. In the order in which a rising level reaches their caps, each says which level is left if all
    # before it are at theirs; the first that is under its cap at that level tells the level of all.
    total = F.sum("source_size").over(Window.partitionBy())
    line = Window.orderBy("_at", "rank")
    given = F.coalesce(F.sum("cap").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(line.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = table.withColumn("_level", (total - given).cast("double") / open_weight.cast("double")).withColumn("_nth", F.row_number().over(line))
    levels = write_through(levels.drop("_at"), "levels")
    under = F.col("_level") * F.col("weight") <= F.col("cap")
    level = levels.where(under).agg(F.min_by("_level", "_nth")).first()[0] or 0.0
    return levels.select(
        "source_key",
        "source_size",
        F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")).alias("target"),
        ((F.col("rank") - 1) % shapes).cast("int").alias("shape"),
    )


def inverse(share: Column, shape: Shape) -> Column:
    """The time at which ``share`` (0 to 1) of the shape's integral has passed."""
    pieces, passed = [], 0.0
    for (t0, d0), (t1, d1) in zip(shape, shape[1:], strict=False):
        after = passed + (d0 + d1) / 2 * (t1 - t0)
        pieces.append((t0, d0, (d1 - d0) / (t1 - t0), passed, after))
        passed = after
    out = F.lit(1.0)
    for t0, d0, slope, before, after in reversed(pieces):
        # d0 x + slope x^2 / 2 = rest, solved for x in the form that also holds for a slope of zero.
        rest = share * F.lit(passed) - F.lit(before)
        root = F.sqrt(F.greatest(F.lit(d0 * d0) + F.lit(2 * slope) * rest, F.lit(0.0)))
        time = F.lit(t0) + F.coalesce(F.try_divide(F.lit(2.0) * rest, F.lit(d0) + root), F.lit(0.0))
        out = F.when(share * F.lit(passed) < F.lit(after), time).otherwise(out)
    return out


def mix(
    docs: DataFrame,
    key: Column,
    source: Column,
    size: Column,
    weights: list[int],
    shapes: list[Shape] | None = None,
    most: int = 3,
    order_by: Column | None = None,
    rows_per_slice: int = 20_000,
) -> DataFrame:
    """key, size, source_size, target, shape, start (the row's place on its source's tape, in words), copies
    (times the mix takes the row) and position: when its first copy comes, null if it is not taken.

    ``order_by`` is hashed for the order of a tape; if not given, the key is. The tapes are cut into slices of
    about ``rows_per_slice`` rows, so that a source with a third of all rows is as many tasks, also where many rows share
    a key or have none; sums of slices say where each begins.
    """
    shapes = shapes or [FLAT]
    hashed = F.md5(F.coalesce((key if order_by is None else order_by).cast("string"), F.lit("")).cast("binary"))
    rows = write_through(
        docs.select(
            key.alias("key"), size.cast("bigint").alias("size"), source.alias("source"), hashed.alias("order")
        ).select(
            "key",
            "size",
            # One that is never null, so that joins and windows hash it alike.
            F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("s"), F.col("source"))).alias("source_key"),
            "order",
            F.monotonically_increasing_id().alias("_row"),
        ),
        "sizes",
    )
    # Slices by range: of as many rows each, whoever has no key or shares one. Written, so that a row's slice is the
    # same wherever it is used.
    slices = max(1, math.ceil(rows.count() / rows_per_slice))
    along = ["source_key", "order", "size", "key", "_row"]
    rows = write_through(rows.repartitionByRange(slices, *along).withColumn("slice", F.spark_partition_id()), "tape")
    sums = write_through(
        rows.groupBy("source_key", "slice").agg(F.sum("size").alias("words")), "slices"
    )
    named = F.when(F.col("source_key") != "", F.expr("substring(source_key, 2)"))
    sizes = sums.groupBy("source_key").agg(F.sum("words").alias("source_size")).withColumn("source", named)
    wanted = targets(sizes, weights, most, len(shapes))
    earlier = Window.partitionBy("source_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select("source_key", "slice", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("source_key", "slice").orderBy("order", "size", "key", "_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(begins.join(wanted, "source_key"), ["source_key", "slice"])
        .withColumn("start", F.col("begin") + F.col("inside"))
    )
    # A copy is taken if its middle lies before the target.
    passes = [
        (F.col("start") * 2 + F.col("source_size") * (2 * p) + F.col("size")).cast("double") <= F.col("target") * 2
        for p in range(most)
    ]
    copies = sum((F.when(taken, 1).otherwise(0) for taken in passes), F.lit(0))
    placed = placed.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0).cast("int"))
    return placed.select(
        "key", "size", "source_size", "target", "shape", "start", "copies", position(F.lit(0), shapes).alias("position")
    )


def position(turn: Column, shapes: list[Shape]) -> Column:
    """The training position (0 to 1) of a row's copy on the ``turn``-th run of its tape; null if there is none."""
    share = F.try_divide((F.col("start") + F.col("source_size") * turn).cast("double"), F.col("target"))
    time = F.lit(None).cast("double")
    for i, shape in enumerate(shapes):
        time = F.when(F.col("shape") == i, inverse(share, shape)).otherwise(time)
    return F.when(F.col("copies") > turn, time)


def in_order(mixed: DataFrame, shapes: list[Shape] | None = None) -> DataFrame:
    """A row for each copy of each row of :func:`mix` (with whatever has been joined to it), range-sorted
    by the copy's position."""
    turns = F.sequence(F.lit(0), F.col("copies") - 1)
    copies = mixed.where("copies > 0").withColumn("turn", F.explode(turns))
    timed = copies.withColumn("position", position(F.col("turn"), shapes or [FLAT]))
    return timed.repartitionByRange("position", "key").sortWithinPartitions("position", "key")
