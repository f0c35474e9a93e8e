"""Business marts over orders, lines, sessions and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from etalage.functions.columns import age_years, micros, share
from etalage.operators.ordered import (
    global_row_number,
    ntile_of,
    sessionize,
    trailing,
    with_history,
)
from etalage.operators.reports import daily_revenue, revenue_grains
from etalage.session import write_through


def kpi_summary(orders: DataFrame) -> DataFrame:
    paid = F.col("status") == "paid"
    revenue = F.sum(F.when(paid, F.col("total_amount")))
    return orders.agg(
        revenue.alias("revenue"),
        F.count("*").alias("nb_orders"),
        F.count_if(paid).alias("paid_orders"),
        F.count_distinct("customer_id").alias("customers"),
        share(revenue, F.count_if(paid)).alias("mean_basket"),
    )


def revenue_growth(orders: DataFrame) -> DataFrame:
    """Growth on the period before, per week and month. The window holds calendar periods only."""
    by_grain = Window.partitionBy("grain").orderBy("period")
    return (
        revenue_grains(orders)
        .where("grain <> 'day'")
        .withColumn("previous", F.lag("revenue").over(by_grain))
        .withColumn(
            "growth",
            (F.col("revenue") - F.col("previous")).cast("double") / F.col("previous").cast("double"),
        )
    )


def _outliers(daily: DataFrame, measure: str) -> DataFrame:
    """Days well below (half) or above (double) the mean of the seven rows before; exact arithmetic."""
    # One row per day: the calendar bounds this window.
    before = Window.partitionBy("measure").orderBy("date").rowsBetween(-7, -1)
    value, total = F.col("value"), F.col("total7")
    return (
        daily.withColumn("measure", F.lit(measure))
        .withColumns({"total7": F.sum("value").over(before), "days": F.count("*").over(before)})
        .withColumn(
            "kind",
            F.when(F.col("days") < 7, None)
            .when(14 * value < total, "drop")
            .when(7 * value > 2 * total, "peak"),
        )
        .where("kind is not null")
        .select("measure", "date", F.col("value").cast("double").alias("value"), "kind")
    )


def kpi_anomalies(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Revenue drops and peaks, and days with unusually many labelled frauds."""
    # Sorted below by the window itself: the view's own order is left out.
    revenue = daily_revenue(orders, ordered=False).select("date", F.col("revenue").alias("value"))
    frauds = payments.groupBy(F.to_date("attempt_ts").alias("date")).agg(
        F.count_if("is_fraudulent").alias("value")
    )
    return _outliers(revenue, "revenue").unionByName(
        _outliers(frauds, "frauds").where("kind = 'peak'")
    )


def top_per_category(products: DataFrame, sales: DataFrame, n: int = 3) -> DataFrame:
    """Best n products of each category; each task keeps n per category before the shuffle."""
    w = Window.partitionBy("category").orderBy(F.col("total_revenue").desc(), "product_id")
    return (
        sales.join(products.select("product_id", "name", "category"), "product_id")
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= n)
    )


def low_stock(products: DataFrame, items: DataFrame, stock: int, below: int) -> DataFrame:
    sold = items.groupBy("product_id").agg(F.sum("quantity").alias("sold"))
    left = F.lit(stock) - F.coalesce("sold", F.lit(0))
    return (
        products.join(sold, "product_id", "left")
        .select("product_id", "name", F.coalesce("sold", F.lit(0)).alias("sold"), left.alias("stock_left"))
        .where(F.col("stock_left") < below)
    )


def rfm(orders: DataFrame) -> DataFrame:
    """Recency, frequency and monetary quintiles per customer, and a segment from their sum."""
    last_day = orders.agg(F.max("order_date")).first()[0]
    today = F.lit(last_day.date() if last_day else None).cast("date")
    people = orders.groupBy("customer_id").agg(
        F.datediff(today, F.to_date(F.max("order_date"))).cast("bigint").alias("recency"),
        F.count("*").alias("frequency"),
        F.sum("total_amount").alias("monetary"),
    )
    people = write_through(people, "customers")
    n = F.lit(people.count())
    for column, best_last in (
        ("recency", F.col("recency").desc()),
        ("frequency", F.col("frequency")),
        ("monetary", F.col("monetary")),
    ):
        people = global_row_number(people, [best_last, F.col("customer_id")], "_rn")
        people = people.withColumn(f"{column[0]}_score", ntile_of("_rn", n, 5)).drop("_rn")
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return people.withColumn(
        "segment",
        F.when(total >= 13, "champions")
        .when(total >= 10, "loyal")
        .when(total >= 7, "regular")
        .otherwise("at_risk"),
    )


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Distinct active customers per month of first order and months since."""
    active = orders.select(
        "customer_id", F.to_date(F.date_trunc("month", "order_date")).alias("month")
    ).distinct()
    # Months per customer only: the calendar bounds this window.
    by_customer = Window.partitionBy("customer_id")
    offset = (F.year("month") - F.year("cohort")) * 12 + F.month("month") - F.month("cohort")
    return (
        active.withColumn("cohort", F.min("month").over(by_customer))
        .groupBy("cohort", offset.alias("month_offset"))
        .agg(F.count("*").alias("customers"))
    )


def lifetime_value(orders: DataFrame) -> DataFrame:
    """Observed revenue, orders and active days per customer."""
    daily = orders.where("status = 'paid'").groupBy(
        "customer_id", F.to_date("order_date").alias("day")
    ).agg(F.count("*").alias("n"), F.sum("total_amount").alias("revenue"))
    return daily.groupBy("customer_id").agg(
        F.sum("n").alias("nb_orders"),
        F.sum("revenue").alias("revenue"),
        F.count("*").alias("active_days"),
        F.datediff(F.max("day"), F.min("day")).alias("span_days"),
    )


def conversion_funnel(events: DataFrame, steps: list[str]) -> DataFrame:
    """Customers reaching each step, every step after the first time of the one before.

    The firsts of each step stay beside those of the steps before, so the events are read once a step.
    """
    at = F.struct("ts", "event_id")
    reached = None
    for i, step in enumerate(steps):
        hits = events.where(F.col("event_type") == step).select("customer_id", at.alias("_at"))
        if reached is not None:
            known = reached.select("customer_id", F.col(f"_at{i - 1}").alias("_before")).where("_before is not null")
            hits = hits.join(known, "customer_id").where("_at > _before")
        first = hits.groupBy("customer_id").agg(F.min("_at").alias(f"_at{i}"))
        reached = first if reached is None else reached.join(first, "customer_id", "left")
    counts = reached.agg(*[F.count(f"_at{i}").alias(f"_n{i}") for i in range(len(steps))])
    rows = [
        F.struct(F.lit(i + 1).alias("step_no"), F.lit(s).alias("step"), F.col(f"_n{i}").alias("customers"))
        for i, s in enumerate(steps)
    ]
    return counts.select(F.inline(F.array(*rows)))


def cart_abandonment(events: DataFrame, gap: int) -> DataFrame:
    spans = sessionize(
        events,
        "customer_id",
        "ts",
        gap,
        sums={
            "n_clicks": (F.col("event_type") == "click").cast("int"),
            "n_purchases": (F.col("event_type") == "purchase").cast("int"),
        },
    )
    cart = F.col("n_clicks") > 0
    left = cart & (F.col("n_purchases") == 0)
    return spans.agg(
        F.count("*").alias("sessions"),
        F.count_if(cart).alias("with_cart"),
        F.count_if(left).alias("abandoned"),
        share(F.count_if(left), F.count_if(cart)).alias("abandonment_rate"),
    )


def utm_attribution(events: DataFrame) -> DataFrame:
    """Purchases and revenue by the source of the customer's first and of the last event before."""
    at = F.struct("ts", "event_id")
    first = events.groupBy("customer_id").agg(
        F.min(at).alias("_first_at"), F.min_by("utm_source", at).alias("_first_source")
    )
    steps = with_history(
        events.select("customer_id", "ts", "event_id", "event_type", "value", "utm_source"),
        "customer_id",
        "ts",
        "event_id",
        latest={"_last_source": (F.col("utm_source"), F.lit(True))},
    )
    bought = steps.where("event_type = 'purchase'").join(first, "customer_id")
    touches = F.array(
        F.struct(
            F.lit("first").alias("touch"),
            F.coalesce(F.when(F.col("_first_at") < at, F.col("_first_source")), F.lit("none")).alias(
                "source"
            ),
        ),
        F.struct(
            F.lit("last").alias("touch"), F.coalesce("_last_source", F.lit("none")).alias("source")
        ),
    )
    return (
        bought.select("value", F.inline(touches))
        .groupBy("touch", "source")
        .agg(F.count("*").alias("purchases"), F.sum("value").alias("revenue"))
    )


def session_metrics(sessions: DataFrame) -> DataFrame:
    """Sessions, length and bounces per source."""
    seconds = F.floor((micros("session_end") - micros("session_start")) / 1_000_000)
    n = F.count("*")
    bounced = F.count_if(F.col("n_events") == 1)
    return sessions.groupBy("utm_source").agg(
        n.alias("sessions"),
        F.sum("n_events").alias("events"),
        F.sum(seconds).alias("seconds"),
        share(F.sum(seconds), n).alias("mean_seconds"),
        share(bounced, n).alias("bounce_rate"),
    )


def customer_360(customers: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One profile per customer: totals of orders and payments as structs, and the last order.

    Orders name their payment (``payment_id``); the payment's result joins on that key.
    """
    at = F.struct("order_date", "order_id")
    totals = orders.groupBy("customer_id").agg(
        F.struct(
            F.count("*").alias("nb_orders"),
            F.sum(F.when(F.col("status") == "paid", F.col("total_amount"))).alias("revenue"),
            F.max("order_date").alias("last_order"),
            F.max_by("order_id", at).alias("last_order_id"),
        ).alias("orders")
    )
    paid_for = (
        orders.select("customer_id", "payment_id")
        .join(payments.select("payment_id", "result"), "payment_id")
        .groupBy("customer_id")
        .agg(
            F.struct(
                F.count("*").alias("linked"),
                F.count_if(F.col("result") == "failed").alias("failed"),
            ).alias("linked_payments")
        )
    )
    attempts = payments.groupBy("customer_id").agg(
        F.struct(
            F.count("*").alias("attempts"),
            F.count_if(F.col("result") == "failed").alias("failed"),
            F.count_if("is_fraudulent").alias("frauds"),
        ).alias("payments")
    )
    out = customers.select("customer_id", "name", "country", "segment")
    for part in (totals, paid_for, attempts):
        out = out.join(part, "customer_id", "left")
    return out


def revenue_by_country(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per customer first, then by country: no shuffle of single orders to a country."""
    per_customer = (
        orders.where("status = 'paid'")
        .groupBy("customer_id")
        .agg(F.count("*").alias("n"), F.sum("total_amount").alias("revenue"))
    )
    return (
        per_customer.join(customers.select("customer_id", "country"), "customer_id")
        .groupBy("country")
        .agg(
            F.count("*").alias("customers"),
            F.sum("n").alias("nb_orders"),
            F.sum("revenue").alias("revenue"),
        )
    )


def seasonality(events: DataFrame) -> DataFrame:
    return (
        events.where("event_type = 'purchase'")
        .groupBy(F.month("ts").alias("month"), F.dayofweek("ts").alias("dow"), F.hour("ts").alias("hour"))
        .agg(F.count("*").alias("purchases"), F.sum("value").alias("revenue"))
    )


def category_pairs(lines: DataFrame, products: DataFrame, min_orders: int = 1) -> DataFrame:
    """Categories bought together: orders with both, and the lift. Exact, whatever the size of an order.

    An order has at most as many entries as there are categories, so its pairs stay few; pairs of single
    products would grow with the square of an order's lines.
    """
    kinds = products.select("product_id", "category")
    basket = lines.select("order_id", "product_id").join(kinds, "product_id").select("order_id", "category").distinct()
    per_order = basket.groupBy("order_id").agg(F.array_sort(F.collect_set("category")).alias("c"))
    per_order = write_through(per_order.select("c"), "baskets")
    n = F.col("n")
    support = per_order.select(F.explode("c").alias("category")).groupBy("category").agg(F.count("*").alias("n"))
    both = F.flatten(
        F.transform("c", lambda x, i: F.transform(F.slice("c", i + 2, F.size("c")), lambda y: F.struct(x.alias("a"), y.alias("b"))))
    )
    pairs = per_order.select(F.inline(both)).groupBy("a", "b").agg(F.count("*").alias("orders")).where(F.col("orders") >= min_orders)
    total = F.lit(per_order.count()).cast("double")
    return (
        pairs.join(support.select(F.col("category").alias("a"), n.alias("orders_a")), "a")
        .join(support.select(F.col("category").alias("b"), n.alias("orders_b")), "b")
        .withColumn("lift", F.col("orders") * total / (F.col("orders_a") * F.col("orders_b")))
    )


def restricted_to_minors(
    items: DataFrame, products: DataFrame, orders: DataFrame, customers: DataFrame, years: int = 18
) -> DataFrame:
    """Lines of age-restricted products ordered by a customer under age at the order date."""
    restricted = products.where("is_adult_restricted").select("product_id")
    young = orders.join(customers.select("customer_id", "birthdate"), "customer_id").withColumn(
        "age", age_years("birthdate", F.to_date("order_date"))
    )
    return items.join(restricted, "product_id", "left_semi").join(
        young.where(F.col("age") < years).select("order_id", "customer_id", "order_date", "age"), "order_id"
    )


def cross_device(events: DataFrame) -> DataFrame:
    """Devices per customer; at most one entry per kind of device."""
    used = events.groupBy("customer_id", "device").agg(F.count("*").alias("n"))
    return used.groupBy("customer_id").agg(
        F.count("*").alias("devices"),
        F.sum("n").alias("events"),
        F.max_by("device", F.struct("n", "device")).alias("main_device"),
    )


def fraud_patterns(flagged: DataFrame, rules: list[str]) -> DataFrame:
    """Combinations of rules that ever fired for a customer, by number of customers."""
    ever = flagged.groupBy("customer_id").agg(*[F.max(r).alias(r) for r in rules])
    names = F.filter(
        F.array(*[F.when(F.col(r), F.lit(r)) for r in sorted(rules)]), lambda x: x.isNotNull()
    )
    return (
        ever.select(F.array_join(names, "+").alias("pattern"))
        .where("pattern <> ''")
        .groupBy("pattern")
        .agg(F.count("*").alias("customers"))
    )


def clicks_before_purchase(events: DataFrame, seconds: int) -> DataFrame:
    """Purchases at most ``seconds`` after a click of the same customer, with the number of clicks.

    One row per purchase, from running values over the customer's rows; no click-purchase pairs.
    """
    steps = events.where(F.col("event_type").isin("click", "purchase")).select(
        "customer_id", "ts", "event_id", "event_type", "value"
    )
    counted = trailing(
        steps,
        "customer_id",
        "ts",
        counts={"clicks": (F.col("event_type") == "click", seconds)},
    )
    return counted.where("event_type = 'purchase' and clicks > 0")


def within_retention(df: DataFrame, ts: str, as_of: str, months: int = 24) -> DataFrame:
    limit = F.add_months(F.lit(as_of).cast("date"), -months).cast("timestamp_ntz")
    return df.where(F.col(ts) >= limit)


def tumbling(events: DataFrame, minutes: int) -> DataFrame:
    w = F.window("ts", f"{minutes} minutes")
    return events.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), "event_type", "n"
    )
