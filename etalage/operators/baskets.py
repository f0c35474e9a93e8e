"""Things that occur together, by counting the pairs of common items."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etalage.session import write_through

#: Items of a basket that are paired in one row; a longer basket is as many rows as it has pairs of such spans.
SPAN = 1000
#: Pairs that one task adds up before they move.
PAIRS_A_TASK = 2_000_000


def _paired(baskets: DataFrame, span: int, tasks: int) -> DataFrame:
    """a, b (a before b) for each pair of items of a basket. ``items`` are sorted.

    Baskets are dealt evenly over the tasks, long ones in pairs of spans.
    """
    last = F.ceil(F.size("items") / span).cast("int") - 1
    spans = baskets.select("items", F.explode(F.sequence(F.lit(0), last)).alias("i"), last.alias("last"))
    spans = spans.select("items", "i", F.explode(F.sequence("i", "last")).alias("j"))
    # The second span is left out where it is the first.
    cut = spans.select(
        F.slice("items", F.col("i") * span + 1, F.lit(span)).alias("left"),
        F.when(F.col("j") > F.col("i"), F.slice("items", F.col("j") * span + 1, F.lit(span))).alias("right"),
    )
    one = cut.repartition(tasks).select("left", "right", F.posexplode("left").alias("at", "a"))
    others = F.coalesce("right", F.slice("left", F.col("at") + 2, F.lit(span)))
    return one.select("a", F.explode(others).alias("b"))


def frequent_pairs(rows: DataFrame, basket: str, item: Column, least: int, span: int = SPAN) -> DataFrame:
    """a, b (a before b), baskets, baskets_a, baskets_b, confidence both ways, lift: pairs of items in ``least`` baskets
    or more.

    Only pairs are counted, whatever larger sets are as frequent. Items below the support are taken out first, so that a
    basket of any length is cut to what can be in an answer. Rows without a basket or an item are left out; an item
    counts once a basket.
    """
    items = rows.select(F.col(basket).alias("basket"), item.alias("item")).where("basket is not null and item is not null").distinct()
    items = write_through(items, "items")
    common = items.groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    common = write_through(common, "common-items")
    baskets = items.join(common.select("item"), "item", "left_semi").groupBy("basket").agg(F.sort_array(F.collect_list("item")).alias("items"))
    baskets = write_through(baskets.where(F.size("items") > 1).select("items"), "baskets")
    n = items.select("basket").distinct().count()
    size = F.size("items").cast("double")
    made = baskets.agg(F.sum(size * (size - 1) / 2)).first()[0]
    kind = rows.select(item.alias("item")).schema["item"].dataType.simpleString()
    if not made:
        schema = f"a {kind}, b {kind}, baskets long, baskets_a long, baskets_b long, confidence_ab double, confidence_ba double, lift double"
        return rows.sparkSession.createDataFrame([], schema)
    least_tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = _paired(baskets, span, max(least_tasks, math.ceil(made / PAIRS_A_TASK)))
    pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("baskets")).where(F.col("baskets") >= least)
    ab = F.col("baskets").cast("double")
    return (
        pairs.join(common.select(F.col("item").alias("a"), F.col("n").alias("baskets_a")), "a")
        .join(common.select(F.col("item").alias("b"), F.col("n").alias("baskets_b")), "b")
        .select(
            "a",
            "b",
            "baskets",
            "baskets_a",
            "baskets_b",
            (ab / F.col("baskets_a")).alias("confidence_ab"),
            (ab / F.col("baskets_b")).alias("confidence_ba"),
            (ab * F.lit(float(n)) / (F.col("baskets_a") * F.col("baskets_b"))).alias("lift"),
        )
    )


def traits(payments: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Payments as baskets of their traits (``name=value``); a trait that is null or false is none."""
    named = [F.concat(F.lit(f"{n}="), c.cast("string")) for n, c in columns.items()]
    listed = F.filter(F.array(*named), lambda x: x.isNotNull() & ~x.endswith("=false"))
    return payments.select("payment_id", F.explode(listed).alias("trait"))
