"""Curation: input files -> the shop's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.functions import values as v
from etalage.functions.columns import age_years, flag, id_number, id_text, is_adult, mapped
from etalage.operators.ordered import global_row_number

EMAIL_DOMAIN = "shop.example"


def customers(raw: DataFrame, email_domain: str = EMAIL_DOMAIN) -> DataFrame:
    n = id_number("customer_id", "C")
    text = n.cast("string")
    byte = (n % 256).cast("string")
    return raw.select(
        "customer_id",
        F.concat(F.lit(v.EMAIL_NAME), text, F.lit("@" + email_domain)).alias("email"),
        F.concat(F.lit(v.FIRST_NAME), text).alias("first_name"),
        F.concat(F.lit(v.LAST_NAME), text).alias("last_name"),
        id_text(v.PHONE_PREFIX, n, 3).alias("phone"),
        F.col("birthdate").alias("date_of_birth"),
        "country",
        F.concat(F.lit(v.IP_PREFIX), byte, F.lit("."), byte).alias("registration_ip"),
        F.col("signup_ts").alias("created_at"),
    )


def customers_with_contact(raw: DataFrame, email_domain: str = EMAIL_DOMAIN) -> DataFrame:
    """The earlier customer form: e-mail from the id text, adults counted as verified."""
    digits = F.expr("substring(customer_id, 2)")
    return raw.select(
        F.concat(F.lower("customer_id"), F.lit("@" + email_domain)).alias("email"),
        F.concat(F.lit(v.CONTACT_FIRST_NAME), digits).alias("first_name"),
        F.concat(F.lit(v.CONTACT_LAST_NAME), digits).alias("last_name"),
        F.lit(None).cast("string").alias("phone"),
        F.col("birthdate").alias("date_of_birth"),
        (F.col("is_minor") == 0).alias("identity_verified"),
    )


def products(raw: DataFrame) -> DataFrame:
    return raw.select(
        id_number("product_id", "P").alias("product_id"),
        "name",
        "category",
        F.col("category").alias("subcategory"),
        F.col("unit_price").alias("price"),
        F.lit(v.DEFAULT_STOCK).alias("stock_quantity"),
        F.concat(F.lit(v.BRAND_PREFIX), "category").alias("brand"),
        F.concat(F.lit(v.DESCRIPTION_PREFIX), "name").alias("description"),
        flag("is_adult_restricted").alias("is_adult_only"),
        "created_at",
    )


def sessions(raw: DataFrame, customers: DataFrame, keep_anonymous: bool = False) -> DataFrame:
    known = raw.join(customers.select("customer_id"), "customer_id", "left_semi")
    if keep_anonymous:
        known = known.unionByName(raw.where("customer_id is null"))
    return known.select(
        "session_id",
        "customer_id",
        "start_ts",
        "end_ts",
        "device",
        "ip_hash",
        "utm_source",
        "utm_campaign",
        F.col("start_ts").alias("created_at"),
    )


def addresses(customers: DataFrame) -> DataFrame:
    """One default address per customer, without its number."""
    return customers.select(
        "customer_id",
        F.lit(v.DEFAULT_STREET).alias("street"),
        F.lit(v.DEFAULT_CITY).alias("city"),
        F.lit(v.DEFAULT_POSTCODE).alias("postal_code"),
        "country",
        F.lit(v.DEFAULT_ADDRESS_TYPE).alias("address_type"),
        "created_at",
    )


def append_addresses(existing: DataFrame, customers: DataFrame) -> DataFrame:
    """Add addresses for customers who have none, numbered on from the highest number in use."""
    new = addresses(customers).join(existing, "customer_id", "left_anti")
    top = existing.agg(F.max("address_id")).first()[0] or 0
    numbered = global_row_number(new, [F.col("customer_id")], "address_id")
    numbered = numbered.withColumn("address_id", F.col("address_id") + F.lit(top))
    return existing.unionByName(numbered.select(existing.columns))


def latest_address(addresses: DataFrame) -> DataFrame:
    """One address per customer: the one numbered last."""
    return addresses.groupBy("customer_id").agg(F.max("address_id").alias("address_id"))


def orders(raw: DataFrame, customers: DataFrame, address: DataFrame) -> DataFrame:
    """Orders of known customers; ``address`` holds one address per customer."""
    known = raw.join(customers.select("customer_id"), "customer_id", "left_semi")
    return known.join(address.select("customer_id", "address_id"), "customer_id").select(
        id_number("order_id", "O").alias("order_id"),
        "customer_id",
        F.col("order_ts").alias("order_date"),
        "total_amount",
        "status",
        F.col("address_id").alias("shipping_address_id"),
        F.col("address_id").alias("billing_address_id"),
        F.col("order_ts").alias("created_at"),
    )


def order_items(raw: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Lines of known orders and products, priced from the product."""
    return price_lines(
        raw.select(
            id_number("order_id", "O").alias("order_id"),
            id_number("product_id", "P").alias("product_id"),
            F.col("qty").alias("quantity"),
        ).join(orders.select("order_id"), "order_id", "left_semi"),
        products,
    )


def price_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Price by product. No hint: Spark broadcasts the products while they are small, else shuffles."""
    prices = products.select("product_id", F.col("price").alias("unit_price"))
    return lines.join(prices, "product_id").withColumn(
        "subtotal", (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)")
    )


def price_lines_by_name(raw: DataFrame, products: DataFrame) -> DataFrame:
    """Price through the product name written from the digits of the id text."""
    name = F.concat(F.lit("Product "), F.replace("product_id", F.lit("P"), F.lit("")))
    keyed = raw.select(
        id_number("order_id", "O").alias("order_id"), name.alias("name"), F.col("qty").alias("quantity")
    )
    found = products.select("name", "product_id", F.col("price").alias("unit_price"))
    return keyed.join(found, "name").select("order_id", "product_id", "quantity", "unit_price")


def link_nearest(
    payments: DataFrame, orders: DataFrame, reach: int = 4, numbers: DataFrame | None = None
) -> DataFrame:
    """Payment number -> order number: the same, else the smallest within ``reach``; unlinked left out.

    The near search is an equi-join on the listed neighbours, not a range condition. Only numbers are
    joined to find the links; the payments themselves move once, at the end. ``numbers`` may name a
    cheaper table with the payments' numbers.
    """
    numbers = (payments if numbers is None else numbers).select("payment_id").distinct()
    same = orders.select(F.col("order_id").alias("payment_id"))
    exact = numbers.join(same, "payment_id", "left_semi").select(
        "payment_id", F.col("payment_id").alias("order_id"), F.lit("exact").alias("link")
    )
    neighbours = F.sequence(F.col("payment_id") - F.lit(reach), F.col("payment_id") + F.lit(reach))
    near = (
        numbers.join(same, "payment_id", "left_anti")
        .select("payment_id", F.explode(neighbours).alias("order_id"))
        .join(orders.select("order_id"), "order_id")
        .groupBy("payment_id")
        .agg(F.min("order_id").alias("order_id"))
        .withColumn("link", F.lit("near"))
    )
    return payments.join(exact.unionByName(near), "payment_id")


def link_by_position(
    left: DataFrame, left_order: str, right: DataFrame, right_order: str
) -> DataFrame:
    """i-th row of the left with the i-th of the right; what is over on either side falls away."""
    a = global_row_number(left, [F.col(left_order)], "position")
    b = global_row_number(right, [F.col(right_order)], "position")
    return a.join(b, "position")


def lookup_first(df: DataFrame, on: str, dim: DataFrame, value: str) -> DataFrame:
    """Left join against one value per key (the smallest), as a LIMIT 1 sub-query finds it."""
    first = dim.groupBy(on).agg(F.min(value).alias(value))
    return df.join(first, on, "left")


def payments(raw: DataFrame, orders: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """Payments linked to an order; the last four of the card number prefix, as text. For ``numbers`` see
    :func:`link_nearest`."""
    parsed = raw.select(
        id_number("payment_id", "PAY").alias("payment_id"),
        F.col("attempt_ts").alias("payment_date"),
        "amount",
        F.col("method").alias("payment_method"),
        F.right("card_bin", F.lit(4)).alias("card_bin_last4"),
        F.col("result").alias("payment_status"),
        F.col("payment_id").alias("transaction_id"),
        F.col("ip_hash").alias("ip_address"),
        "device_id",
        "payment_country",
        flag("is_fraud_label").alias("is_fraudulent"),
        F.col("attempt_ts").alias("created_at"),
    )
    return link_nearest(parsed.where("payment_id is not null"), orders, numbers=numbers).drop("link")


def payments_scored(raw: DataFrame) -> DataFrame:
    """The earlier payment form: stored method and status names, score on the 0-100 scale."""
    return raw.select(
        F.col("payment_id").alias("transaction_id"),
        mapped("method", v.PAYMENT_METHOD, v.DEFAULT_PAYMENT_METHOD).alias("payment_method"),
        "amount",
        F.when(F.col("result") == "success", "completed").otherwise("failed").alias("status"),
        flag("is_fraud_label").alias("is_fraudulent"),
        fraud_score(flag("is_fraud_label")).alias("fraud_score"),
        F.col("attempt_ts").alias("payment_date"),
    )


def fraud_score(is_fraud: Column) -> Column:
    return F.when(is_fraud, F.lit(v.FRAUD_SCORE)).otherwise(F.lit(v.CLEAN_SCORE))


def alerts(raw: DataFrame, payments: DataFrame) -> DataFrame:
    """Alerts on known payments, with score, action, severity and status."""
    label = flag("is_fraud_label")
    rule = F.col("rule_triggered")
    return (
        raw.withColumn("payment_id", id_number("payment_id", "PAY"))
        .join(payments.select("payment_id"), "payment_id", "left_semi")
        .select(
            "alert_id",
            "payment_id",
            F.col("alert_ts").alias("alert_date"),
            rule.alias("alert_type"),
            mapped(rule, v.RISK_SCORES, v.DEFAULT_RISK_SCORE).alias("risk_score"),
            F.when(label, "blocked").otherwise("reviewed").alias("action_taken"),
            mapped(rule, v.SEVERITIES, v.DEFAULT_SEVERITY).alias("severity"),
            F.concat(F.lit(v.ALERT_PREFIX), rule).alias("description"),
            F.when(label, "resolved").otherwise("false_positive").alias("status"),
        )
    )


def split_rejects(raw: DataFrame, ids: dict[str, tuple[str, str]]) -> DataFrame:
    """Parse id columns; ``reject`` names the first one that would not parse, null for a good row.

    ``ids`` maps the new column to (source column, prefix).
    """
    parsed = raw.select("*", *[id_number(src, p).alias(n) for n, (src, p) in ids.items()])
    bad = F.coalesce(*[F.when(F.col(n).isNull(), F.lit(src)) for n, (src, _) in ids.items()])
    return parsed.withColumn("reject", bad)


def adults(customers: DataFrame, as_of: str, born: str = "date_of_birth") -> DataFrame:
    return customers.withColumns(
        {"age": age_years(born, as_of), "is_adult": is_adult(born, as_of)}
    )


def upsert(
    current: DataFrame, incoming: DataFrame, key: str, columns: list[str], stamp: str
) -> DataFrame:
    """Merge ``incoming`` into ``current``; ``updated_at`` moves only on rows that changed or are new."""
    old = current.select(key, "updated_at", *[F.col(c).alias(f"_old_{c}") for c in columns])
    new = incoming.select(key, F.lit(True).alias("_in"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    both = old.withColumn("_was", F.lit(True)).join(new, key, "full_outer")
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}"))
    arrived = F.col("_in").isNotNull()
    changed = arrived & differs
    now = F.lit(stamp).cast("timestamp_ntz")
    return both.select(
        key,
        *[F.when(arrived, F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c) for c in columns],
        F.when(F.col("_was").isNull() | changed, now).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(F.col("_was").isNull(), "inserted")
        .when(changed, "updated")
        .otherwise("kept")
        .alias("change"),
    )


def dedup_latest(df: DataFrame, key: list[str], latest: list[Column]) -> DataFrame:
    """One row per key, the first in ``latest`` order.

    Spark limits each key to one row before the shuffle, so a key with many copies stays small.
    """
    w = Window.partitionBy(*key).orderBy(*latest)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
