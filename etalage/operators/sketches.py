"""Reports from sketches that can be merged: value distributions (KLL) and distinct customers (theta).

A sketch is a row of bounded size, however many rows it stands for, and sketches of days add up to those of any span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a value sketch: exact up to about as many values; beyond, ranks are off by some 0.1 % (k = 4096).
VALUES_K = 4096
#: Log of the size of a distinct sketch: exact up to 16,384 customers; beyond, the standard error is 0.8 %.
DISTINCT_LG = 14


def value_sketches(df: DataFrame, value: str, by: list[str], k: int = VALUES_K) -> DataFrame:
    """One sketch of the values for each combination of ``by``; nulls are left out of it. Tasks add up their own."""
    x = F.col(value).cast("double")
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"), F.count(x).alias("n"))


#: Shares at which a sketch is read: the middles of so many equal parts.
PARTS = 200
SHARES = [(2 * i - 1) / (2 * PARTS) for i in range(1, PARTS + 1)]


def _rank(values: str, x: Column) -> Column:
    """Share of the values read from a sketch that are not above ``x``."""
    return F.size(F.filter(values, lambda y: y <= x)) / F.lit(PARTS)


def drift(sketches: DataFrame, by: list[str], is_base: Column, buckets: int = 10) -> DataFrame:
    """Each sketch against the merged ones of the base period of its group: the population stability index over the
    base's quantile buckets, and the Kolmogorov-Smirnov distance.

    Both sketches are read at PARTS shares; ranks are counted among these values, so a distance is right to
    1 / PARTS. The buckets' edges are quantiles of the base; equal edges are one. Half a row is added to each bucket, so that
    none is empty. Groups without values in the base, and periods without values, give no row.
    """
    sketches = sketches.where("n > 0")
    base = sketches.where(is_base).groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("base"), F.sum("n").alias("base_n"))
    at = F.array(*[F.lit(q) for q in SHARES])
    read = {"_base": F.kll_sketch_get_quantile_double("base", at), "_now": F.kll_sketch_get_quantile_double("sketch", at)}
    both = sketches.where(~is_base).join(base, by).withColumns(read)
    edges = F.array(*[F.col("_base")[PARTS * i // buckets - 1] for i in range(1, buckets)])
    both = both.withColumn("_edges", F.array_distinct(edges))
    far = F.transform(F.concat("_base", "_now"), lambda x: F.abs(_rank("_base", x) - _rank("_now", x)))

    def shares(values: str, n: str) -> Column:
        ranks = F.concat(F.array(F.lit(0.0)), F.transform("_edges", lambda x: _rank(values, x)), F.array(F.lit(1.0)))
        size = F.size("_edges") + 1
        return F.zip_with(
            F.slice(ranks, 1, size), F.slice(ranks, 2, size), lambda a, b: ((b - a) * F.col(n) + 0.5) / (F.col(n) + 0.5 * size)
        )

    both = both.withColumns({"_p": shares("_base", "base_n"), "_q": shares("_now", "n"), "ks": F.array_max(far)})
    terms = F.zip_with("_p", "_q", lambda p, q: (q - p) * F.ln(q / p))
    return both.withColumn("psi", F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)).drop(
        "sketch", "base", "_base", "_now", "_edges", "_p", "_q"
    )


def daily_audience(events: DataFrame, who: str, ts: str, by: list[str], lg: int = DISTINCT_LG) -> DataFrame:
    """The gold table of audiences: a sketch of the distinct ``who`` for each day and combination of ``by``.

    Rows without a time are in no day, rows without ``who`` in no sketch.
    """
    dated = events.where(F.col(ts).isNotNull() & F.col(who).isNotNull())
    return dated.groupBy(F.to_date(ts).alias("day"), *by).agg(F.theta_sketch_agg(who, F.lit(lg)).alias("who"))


def audience(daily: DataFrame, period: Column, by: list[str], lg: int = DISTINCT_LG) -> DataFrame:
    """Sketches of any span from those of its days: ``period`` and ``by``."""
    return daily.groupBy(period.alias("period"), *by).agg(F.theta_union_agg("who", F.lit(lg)).alias("who"))


def sizes(sketches: DataFrame) -> DataFrame:
    return sketches.withColumn("customers", F.theta_sketch_estimate("who")).drop("who")


def returning(weekly: DataFrame, by: list[str], weeks: list[int]) -> DataFrame:
    """Customers of a week, and how many of them are there again so many weeks later: an intersection of sketches."""
    later = weekly.select(*by, F.col("period").alias("_later"), F.col("who").alias("_again"))
    asked = weekly.withColumn("weeks_later", F.explode(F.array(*[F.lit(i) for i in weeks])))
    asked = asked.withColumn("_later", F.date_add("period", F.col("weeks_later") * 7))
    both = asked.join(later, [*by, "_later"])
    return both.select(
        "period",
        *by,
        "weeks_later",
        F.theta_sketch_estimate("who").alias("customers"),
        F.theta_sketch_estimate(F.theta_intersection("who", "_again")).alias("again"),
    )
