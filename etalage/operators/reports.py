"""The report views and figures over orders, lines and payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etalage.functions.columns import share


def daily_revenue(orders: DataFrame, status: str = "paid", ordered: bool = True) -> DataFrame:
    """Orders, revenue and mean order value per day, newest first unless not ``ordered``."""
    revenue = F.sum("total_amount")
    n = F.count("*")
    daily = (
        orders.where(F.col("status") == status)
        .groupBy(F.to_date("order_date").alias("date"))
        .agg(
            n.alias("nb_orders"),
            revenue.alias("revenue"),
            (revenue.cast("double") / n).alias("avg_order_value"),
        )
    )
    return daily.orderBy(F.col("date").desc()) if ordered else daily


def sales_by_product(items: DataFrame) -> DataFrame:
    """Priced lines added up per product. Done before any join, so a best-seller is one row after it."""
    return items.groupBy("product_id").agg(
        F.count("*").alias("nb_sales"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("subtotal").alias("total_revenue"),
    )


def sales_from_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """The same from lines without a price: quantities are added up first, then priced per product."""
    sold = lines.groupBy("product_id").agg(
        F.count("*").alias("nb_sales"), F.sum("quantity").alias("total_quantity")
    )
    revenue = (F.col("total_quantity") * F.col("price")).cast("decimal(28,2)")
    return sold.join(products.select("product_id", "price"), "product_id").select(
        "product_id", "nb_sales", "total_quantity", revenue.alias("total_revenue")
    )


def top_products(products: DataFrame, sales: DataFrame) -> DataFrame:
    """Every product with its sales; products never sold come first (null revenue), as stored order has it."""
    return (
        products.select("product_id", "name", "category")
        .join(sales, "product_id", "left")
        .withColumn("nb_sales", F.coalesce("nb_sales", F.lit(0)))
        .orderBy(F.col("total_revenue").desc_nulls_first(), "product_id")
    )


def top_categories(products: DataFrame, sales: DataFrame, n: int = 5) -> DataFrame:
    return (
        products.select("product_id", "category")
        .join(sales, "product_id")
        .groupBy("category")
        .agg(F.sum("nb_sales").alias("nb_sales"), F.sum("total_revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "category")
        .limit(n)
    )


def suspicious_payments(
    payments: DataFrame, orders: DataFrame, customers: DataFrame, alerts: DataFrame | None = None
) -> DataFrame:
    """Payments with a fraud label or an alert, with the order's customer and the number of alerts: ``nb_alerts``
    of the payments, or else counted in ``alerts``."""
    if alerts is not None:
        per_payment = alerts.groupBy("payment_id").agg(F.count("*").alias("nb_alerts"))
        payments = payments.join(per_payment, "payment_id", "left").withColumn("nb_alerts", F.coalesce("nb_alerts", F.lit(0)))
    people = customers.select("customer_id", F.col("country").alias("customer_country"))
    return (
        payments.drop("customer_id", "customer_country")
        .where("is_fraudulent or nb_alerts > 0")
        .join(orders.select("order_id", "customer_id"), "order_id")
        .join(people, "customer_id")
        .orderBy(F.col("payment_date").desc(), "payment_id")
    )


def suspicious_scored(
    payments: DataFrame, orders: DataFrame, customers: DataFrame, threshold: float = 70
) -> DataFrame:
    """Payments scored above ``threshold`` (0-100) or labelled as fraud."""
    return (
        payments.where((F.col("fraud_score") > threshold) | F.col("is_fraudulent"))
        .drop("customer_id")
        .join(orders.select("order_id", "customer_id"), "order_id")
        .join(customers.select("customer_id", "email"), "customer_id")
    )


def orders_details(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their customer and number of lines."""
    n = items.groupBy("order_id").agg(F.count("*").alias("items_count"))
    # By order first: where both sides are dealt by order, nothing moves for it.
    return (
        orders.join(n, "order_id", "left")
        .join(customers, "customer_id")
        .withColumn("items_count", F.coalesce("items_count", F.lit(0)))
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def paid_total(orders: DataFrame, sales: DataFrame) -> DataFrame:
    """Paid revenue and total value of the lines, 0 when there are none."""
    zero = F.lit(0).cast("decimal(18,2)")
    paid = orders.where("status = 'paid'").agg(
        F.coalesce(F.sum("total_amount"), zero).alias("value")
    )
    lines = sales.agg(F.coalesce(F.sum("total_revenue"), zero).alias("value"))
    return paid.select(F.lit("paid_revenue").alias("measure"), "value").union(
        lines.select(F.lit("items_value").alias("measure"), "value")
    )


def mean_basket(orders: DataFrame) -> DataFrame:
    n = F.count("*")
    return orders.agg(
        n.alias("nb_orders"),
        share(F.sum("total_amount"), n).alias("avg_basket"),
    )


def fraud_rate(payments: DataFrame) -> DataFrame:
    """Labelled payments in percent; 0 when there are no payments."""
    bad, n = F.count_if("is_fraudulent"), F.count("*")
    return payments.agg(
        bad.alias("fraudulent"), n.alias("payments"), (share(bad, n) * 100).alias("fraud_rate")
    )


def items_per_order(items: DataFrame) -> DataFrame:
    per_order = items.groupBy("order_id").agg(F.count("*").alias("n"))
    return per_order.agg(
        F.count("*").alias("nb_orders"),
        F.sum("n").alias("nb_items"),
        share(F.sum("n"), F.count("*")).alias("avg_items"),
    )


def orphan_counts(links: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Rows whose key is not in the parent, per named link (child, parent, key); no key is no orphan.

    Child rows are counted per key before the anti-join: a key met a billion times is one row.
    """
    out = None
    for name, (child, parent, key) in links.items():
        per_key = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        part = (
            per_key.join(parent.select(key), key, "left_anti")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))
            .select(F.lit(name).alias("link"), "orphans")
        )
        out = part if out is None else out.unionByName(part)
    return out


def revenue_grains(orders: DataFrame) -> DataFrame:
    """Paid revenue per day, week and month in one pass: days first, the coarser grains from them."""
    daily = (
        orders.where("status = 'paid'")
        .groupBy(F.to_date("order_date").alias("day"))
        .agg(F.count("*").alias("nb_orders"), F.sum("total_amount").alias("revenue"))
    )
    periods = {
        "day": F.col("day"),
        "week": F.to_date(F.date_trunc("week", "day")),
        "month": F.to_date(F.date_trunc("month", "day")),
    }
    grains = F.array(
        *[F.struct(F.lit(g).alias("grain"), p.alias("period")) for g, p in periods.items()]
    )
    return (
        daily.select("nb_orders", "revenue", F.inline(grains))
        .groupBy("grain", "period")
        .agg(F.sum("nb_orders").alias("nb_orders"), F.sum("revenue").alias("revenue"))
    )
