"""Data-quality checks: each returns a small table of counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etalage.functions.columns import share
from etalage.operators import reports


def _report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """All checks of a table in one scan, one row per check."""
    row = df.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(n) for n, c in checks.items()])
    entries = [
        F.struct(F.lit(n).alias("check_name"), F.col("rows"), F.col(f"`{n}`").alias("failed"))
        for n in checks
    ]
    return row.select(F.inline(F.array(*entries)))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    return _report(df, {f"{table}.{c}": F.col(c).isNull() for c in columns})


def accepted_values(df: DataFrame, table: str, allowed: dict[str, list]) -> DataFrame:
    """Nulls pass, as they do in a CHECK constraint."""
    return _report(
        df, {f"{table}.{c}": F.coalesce(~F.col(c).isin(vals), F.lit(False)) for c, vals in allowed.items()}
    )


def in_range(df: DataFrame, table: str, conditions: dict[str, Column]) -> DataFrame:
    return _report(
        df, {f"{table}.{n}": F.coalesce(~ok, F.lit(False)) for n, ok in conditions.items()}
    )


def well_formed(df: DataFrame, table: str, rules: dict[str, tuple[int, str]]) -> DataFrame:
    """Text columns longer than their limit or not matching their pattern (limit, pattern)."""
    checks = {}
    for c, (limit, pattern) in rules.items():
        bad = (F.length(c) > limit) | ~F.col(c).rlike(pattern)
        checks[f"{table}.{c}"] = F.coalesce(bad, F.lit(False))
    return _report(df, checks)


def unique(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Keys met more than once, and the rows over."""
    per_key = df.groupBy(*key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.count("*").alias("keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"),
    ).select(F.lit(f"{table}({','.join(key)})").alias("check_name"), "*")


def drift_psi(
    df: DataFrame, value: str, ts: str, start: str, width: float, buckets: int
) -> DataFrame:
    """Share of rows per value bucket before and from ``start``, and the population stability index."""
    b = F.least(F.floor(F.col(value) / width), F.lit(buckets - 1))
    later = F.col(ts) >= F.lit(start).cast("timestamp_ntz")
    # One scan: two counts per bucket, half a row added to each so that none is empty.
    row = df.agg(
        *[(F.count_if((b == i) & ~later) + 0.5).alias(f"base_{i}") for i in range(buckets)],
        *[(F.count_if((b == i) & later) + 0.5).alias(f"now_{i}") for i in range(buckets)],
    )
    before = sum((F.col(f"base_{i}") for i in range(1, buckets)), F.col("base_0"))
    after = sum((F.col(f"now_{i}") for i in range(1, buckets)), F.col("now_0"))
    entries = []
    for i in range(buckets):
        q, p = F.col(f"base_{i}") / before, F.col(f"now_{i}") / after
        entries.append(
            F.struct(
                F.lit(i).alias("bucket"),
                F.col(f"base_{i}").alias("base"),
                F.col(f"now_{i}").alias("now"),
                ((p - q) * F.log(p / q)).alias("psi"),
            )
        )
    return row.select(F.inline(F.array(*entries)))


def profile(df: DataFrame, value: str, period: Column) -> DataFrame:
    """Rows, null share, mean and standard deviation of a money column per period.

    Sums are exact decimals, so that the figures do not hang on the order of the rows.
    """
    x = F.col(value).cast("decimal(18,2)")
    n = F.count(x)
    total = F.sum(x).cast("double")
    squares = F.sum((x * x).cast("decimal(28,4)")).cast("double")
    mean = total / n
    return df.groupBy(period.alias("period")).agg(
        F.count("*").alias("rows"),
        share(F.count("*") - n, F.count("*")).alias("null_share"),
        mean.alias("mean"),
        F.sqrt(F.greatest(squares / n - mean * mean, F.lit(0.0))).alias("stddev"),
    )


def reconcile(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Order totals against the sum of their lines, counted by outcome."""
    lines = items.groupBy("order_id").agg(F.sum("subtotal").alias("lines_total"))
    outcome = (
        F.when(F.col("lines_total").isNull(), "no_lines")
        .when(F.col("total_amount").isNull(), "no_order")
        .when(F.col("lines_total") == F.col("total_amount"), "equal")
        .otherwise("differs")
    )
    return (
        orders.select("order_id", "total_amount")
        .join(lines, "order_id", "full_outer")
        .groupBy(outcome.alias("outcome"))
        .agg(
            F.count("*").alias("n"),
            F.sum(
                F.coalesce("total_amount", F.lit(0)) - F.coalesce("lines_total", F.lit(0))
            ).alias("difference"),
        )
    )


def only_in_one(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one source that the other lacks, duplicates counted."""
    a = left.exceptAll(right).agg(F.count("*").alias("n")).select(F.lit("left_only").alias("side"), "n")
    b = right.exceptAll(left).agg(F.count("*").alias("n")).select(F.lit("right_only").alias("side"), "n")
    return a.unionByName(b)


def validation_report(
    tables: dict[str, DataFrame],
    links: dict[str, tuple[DataFrame, DataFrame, str]],
    orders: DataFrame,
    items: DataFrame,
    sales: DataFrame,
    payments: DataFrame,
) -> DataFrame:
    """Row counts, orphans and business totals as (check_name, value, ok)."""
    cols = ["check_name", "value", "ok"]
    counts = reports.table_counts(tables).select(
        F.concat(F.lit("rows_"), "table").alias("check_name"),
        F.col("rows").cast("double").alias("value"),
        (F.col("rows") > 0).alias("ok"),
    )
    orphans = reports.orphan_counts(links).select(
        F.concat(F.lit("orphans_"), "link").alias("check_name"),
        F.col("orphans").cast("double").alias("value"),
        (F.col("orphans") == 0).alias("ok"),
    )

    def figure(df: DataFrame, name: Column, value: str) -> DataFrame:
        return df.select(
            name.alias("check_name"), F.col(value).cast("double").alias("value"), F.lit(True).alias("ok")
        )

    figures = [
        figure(reports.paid_total(orders, sales), F.col("measure"), "value"),
        figure(reports.mean_basket(orders), F.lit("avg_basket"), "avg_basket"),
        figure(reports.fraud_rate(payments), F.lit("fraud_rate"), "fraud_rate"),
        figure(reports.items_per_order(items), F.lit("avg_items_per_order"), "avg_items"),
    ]
    return union_all([counts, orphans, *figures]).select(cols)
