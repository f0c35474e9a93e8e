"""Queries behind the report views, figures and list pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from etalage.functions.columns import id_number, share
from etalage.operators import curate, fraud, quality, reports
from etalage.operators.ordered import sessionize
from etalage.plans.registry import query
from etalage.session import together


def _sales(shop):
    return reports.sales_from_lines(shop.lines, shop.products)


def _linked(shop):
    """Payments with the order they are linked to."""
    return curate.link_nearest(shop.attempts, shop.orders)


def tables(shop) -> dict:
    """The curated tables by name."""
    return {
        "customers": shop.people,
        "products": shop.products,
        "sessions": shop.sessions,
        "orders": shop.orders,
        "order_items": shop.lines,
        "payments": shop.attempts,
        "fraud_alerts": shop.alerts,
        "addresses": shop.people,
    }


@query(
    "daily_revenue",
    "date:d nb_orders:l revenue:m avg_order_value:f",
    """
    SELECT CAST(order_date AS DATE) AS date, count(*) AS nb_orders, sum(total_amount) AS revenue,
           CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_order_value
    FROM s_orders WHERE status = 'paid' GROUP BY 1""",
)
def daily_revenue(shop):
    return reports.daily_revenue(shop.orders)


_TOP = """
    SELECT p.product_id, p.name, p.category, count(i.product_id) AS nb_sales,
           sum(i.quantity) AS total_quantity, sum(i.subtotal) AS total_revenue
    FROM s_products p LEFT JOIN s_items i ON p.product_id = i.product_id GROUP BY 1, 2, 3"""
_TOP_COLUMNS = "product_id:l name:s category:s nb_sales:l total_quantity:l total_revenue:m"


@query("top_products", _TOP_COLUMNS, _TOP)
def top_products(shop):
    return reports.top_products(shop.products, _sales(shop))


@query(
    "top_products_limit",
    _TOP_COLUMNS,
    f"SELECT * FROM ({_TOP}) WHERE total_revenue IS NOT NULL ORDER BY total_revenue DESC, product_id LIMIT 10",
)
def top_products_limit(shop):
    """The ten best-sellers."""
    best = _sales(shop).orderBy(F.col("total_revenue").desc(), "product_id").limit(10)
    return best.join(shop.products.select("product_id", "name", "category"), "product_id")


@query(
    "top_categories",
    "category:s nb_sales:l revenue:m",
    """
    SELECT category, count(*) AS nb_sales, sum(i.subtotal) AS revenue
    FROM s_items i JOIN s_products p ON i.product_id = p.product_id
    GROUP BY category ORDER BY revenue DESC, category LIMIT 5""",
)
def top_categories(shop):
    return reports.top_categories(shop.products, _sales(shop))


@query(
    "suspicious_payments",
    "payment_id:l payment_date:t amount:m payment_method:s is_fraudulent:b customer_id:l customer_country:s"
    " nb_alerts:l",
    """
    SELECT p.payment_id, p.attempt_ts AS payment_date, p.amount, p.method AS payment_method, p.is_fraudulent,
           c.customer_id, c.country AS customer_country, count(a.alert_id) AS nb_alerts
    FROM s_payments p JOIN s_links l ON p.payment_id = l.payment_id
    JOIN s_orders o ON l.order_id = o.order_id JOIN s_customers c ON o.customer_id = c.customer_id
    LEFT JOIN s_alerts a ON p.payment_id = a.payment_id
    WHERE p.is_fraudulent OR a.alert_id IS NOT NULL GROUP BY ALL""",
)
def suspicious_payments(shop):
    return reports.suspicious_payments(suspects(shop), shop.orders, shop.customers)


def suspects(shop):
    """Linked payments with a label or an alert, straight from the rules' flags; a payment has as many alerts as it
    breaks rules."""
    renamed = {"attempt_ts": "payment_date", "method": "payment_method", "n_rules": "nb_alerts"}
    flagged = fraud.score(shop.flagged).where("is_fraudulent or n_rules > 0")
    return curate.link_nearest(flagged, shop.orders, numbers=shop.attempts).withColumnsRenamed(renamed)


@query(
    "suspicious_payments_scored",
    "payment_id:l order_id:l amount:m status:s fraud_score:f is_fraudulent:b customer_id:l email:s",
    """
    SELECT p.payment_id, l.order_id, p.amount,
           CASE WHEN p.result = 'success' THEN 'completed' ELSE 'failed' END AS status,
           CASE WHEN p.is_fraudulent THEN 90.0 ELSE 10.0 END AS fraud_score, p.is_fraudulent, o.customer_id,
           concat('customer', o.customer_id, '@shop.example') AS email
    FROM s_payments p JOIN s_links l ON p.payment_id = l.payment_id
    JOIN s_orders o ON l.order_id = o.order_id
    WHERE CASE WHEN p.is_fraudulent THEN 90.0 ELSE 10.0 END > 70 OR p.is_fraudulent""",
)
def suspicious_payments_scored(shop):
    payments = _linked(shop).select(
        "payment_id",
        "order_id",
        "amount",
        F.when(F.col("result") == "success", "completed").otherwise("failed").alias("status"),
        curate.fraud_score(F.col("is_fraudulent")).alias("fraud_score"),
        "is_fraudulent",
    )
    people = shop.people.select(
        "customer_id",
        F.concat(F.lit("customer"), F.col("customer_id").cast("string"), F.lit("@shop.example")).alias(
            "email"
        ),
    )
    return reports.suspicious_scored(payments, shop.orders, people)


@query(
    "orders_details",
    "order_id:l order_date:t status:s total_amount:m customer_id:l name:s country:s items_count:l",
    """
    SELECT o.order_id, o.order_date, o.status, o.total_amount, c.customer_id, c.name, c.country,
           count(i.l_orderkey) AS items_count
    FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id
    LEFT JOIN lineitem i ON o.order_id = i.l_orderkey GROUP BY ALL""",
)
def orders_details(shop):
    return reports.orders_details(
        shop.orders, shop.customers.select("customer_id", "name", "country"), shop.lines
    )


_COUNTS = """
    SELECT 'customers' AS "table", count(*) AS "rows" FROM s_customers
    UNION ALL SELECT 'products', count(*) FROM s_products
    UNION ALL SELECT 'sessions', count(*) FROM s_sessions
    UNION ALL SELECT 'orders', count(*) FROM s_orders
    UNION ALL SELECT 'order_items', count(*) FROM lineitem
    UNION ALL SELECT 'payments', count(*) FROM s_payments
    UNION ALL SELECT 'fraud_alerts', count(*) FROM s_alerts
    UNION ALL SELECT 'addresses', count(*) FROM s_customers"""


@query("table_counts", "table_name:s row_count:l", f"SELECT * FROM ({_COUNTS}) AS t(table_name, row_count)")
def table_counts(shop):
    return reports.table_counts(tables(shop)).toDF("table_name", "row_count")


@query(
    "paid_revenue_total",
    "measure:s value:m",
    """
    SELECT 'paid_revenue' AS measure, coalesce(sum(total_amount), 0) AS value FROM s_orders WHERE status = 'paid'
    UNION ALL SELECT 'items_value', coalesce(sum(subtotal), 0) FROM s_items""",
)
def paid_revenue_total(shop):
    return reports.paid_total(shop.orders, _sales(shop))


@query(
    "avg_basket",
    "nb_orders:l avg_basket:f",
    "SELECT count(*) AS nb_orders, CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_basket FROM s_orders",
)
def avg_basket(shop):
    return reports.mean_basket(shop.orders)


@query(
    "fraud_rate",
    "fraudulent:l payments:l fraud_rate:f",
    """
    SELECT count(*) FILTER (is_fraudulent) AS fraudulent, count(*) AS payments,
           CAST(count(*) FILTER (is_fraudulent) AS DOUBLE) / count(*) * 100 AS fraud_rate FROM s_payments""",
)
def fraud_rate(shop):
    return reports.fraud_rate(shop.attempts)


@query(
    "avg_items_per_order",
    "nb_orders:l nb_items:l avg_items:f",
    """
    SELECT count(*) AS nb_orders, sum(n) AS nb_items, CAST(sum(n) AS DOUBLE) / count(*) AS avg_items
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)""",
)
def avg_items_per_order(shop):
    return reports.items_per_order(shop.lines)


@query(
    "distinct_categories",
    "categories:l brands:l",
    "SELECT count(DISTINCT category) AS categories, count(DISTINCT brand) AS brands FROM s_products",
)
def distinct_categories(shop):
    return shop.products.agg(
        F.countDistinct("category").alias("categories"), F.countDistinct("brand").alias("brands")
    )


@query(
    "orphan_counts",
    "link:s orphans:l",
    """
    SELECT 'orders_customers' AS link, count(*) AS orphans FROM s_orders
    WHERE customer_id NOT IN (SELECT customer_id FROM s_customers)
    UNION ALL SELECT 'order_items_products', count(*) FROM lineitem
    WHERE l_partkey NOT IN (SELECT product_id FROM s_products)
    UNION ALL SELECT 'order_items_orders', count(*) FROM lineitem
    WHERE l_orderkey NOT IN (SELECT order_id FROM s_orders)
    UNION ALL SELECT 'payments_customers', count(*) FROM s_payments
    WHERE customer_id NOT IN (SELECT customer_id FROM s_customers)
    UNION ALL SELECT 'payments_orders', count(*) FROM s_payments
    WHERE payment_id NOT IN (SELECT order_id FROM s_orders WHERE status = 'paid')
    UNION ALL SELECT 'alerts_payments', count(*) FROM s_alerts
    WHERE payment_id NOT IN (SELECT payment_id FROM s_payments)
    UNION ALL SELECT 'sessions_customers', count(*) FROM s_sessions
    WHERE customer_id NOT IN (SELECT customer_id FROM s_customers)
    UNION ALL SELECT 'addresses_customers', count(*) FROM s_people
    WHERE customer_num NOT IN (SELECT customer_id FROM s_customers)
    UNION ALL SELECT 'orders_shipping_address', count(*) FROM s_orders
    WHERE customer_id NOT IN (SELECT customer_num FROM s_people)
    UNION ALL SELECT 'orders_billing_address', count(*) FROM s_orders
    WHERE customer_id NOT IN (SELECT customer_num FROM s_people)
    UNION ALL SELECT 'documents_customers', count(*) FROM s_people
    WHERE customer_num NOT IN (SELECT customer_id FROM s_customers)""",
)
def orphan_counts(shop):
    """The customer's number stands for the number of their one address, which orders are sent and billed to;
    documents are named by it."""
    together({"sessions": lambda: shop.sessions, "alerts": lambda: shop.alerts})
    number = id_number("customer_id", "C")
    homes = curate.addresses(curate.customers(shop.raw("customers"))).select(
        number.alias("customer_id"), number.alias("address_id")
    )
    sent = shop.orders.select(F.col("customer_id").alias("shipping_address_id"), F.col("customer_id").alias("billing_address_id"))
    documents = shop.raw("identity_labels").select(
        F.regexp_extract("file", "([0-9]+)", 1).cast("bigint").alias("customer_id")
    )
    more = {
        "sessions_customers": (shop.sessions, shop.people, "customer_id"),
        "addresses_customers": (homes, shop.people, "customer_id"),
        "orders_shipping_address": (sent, homes.withColumnRenamed("address_id", "shipping_address_id"), "shipping_address_id"),
        "orders_billing_address": (sent, homes.withColumnRenamed("address_id", "billing_address_id"), "billing_address_id"),
        "documents_customers": (documents, shop.people, "customer_id"),
        "alerts_payments": (shop.alerts, shop.attempts, "payment_id"),
    }
    return reports.orphan_counts(orphan_links(shop) | more)


def orphan_links(shop) -> dict:
    """Links of the tables that are always there; alerts come with their own."""
    paid = shop.orders.where("status = 'paid'")
    by_number = shop.attempts.select(F.col("payment_id").alias("order_id"))
    return {
        "orders_customers": (shop.orders, shop.people, "customer_id"),
        "order_items_products": (shop.lines, shop.products, "product_id"),
        "order_items_orders": (shop.lines, shop.orders, "order_id"),
        "payments_customers": (shop.attempts, shop.people, "customer_id"),
        "payments_orders": (by_number, paid, "order_id"),
    }


@query(
    "orders_by_status_page",
    "order_id:l customer_id:l order_date:t total_amount:m",
    """
    SELECT order_id, customer_id, order_date, total_amount FROM s_orders WHERE status = 'paid'
    ORDER BY order_date DESC, order_id LIMIT 100""",
)
def orders_by_status_page(shop):
    """GET orders?status=paid&limit=100, newest first."""
    return _page(
        shop.orders.where("status = 'paid'"), [F.col("order_date").desc(), F.col("order_id")], 100
    )


@query(
    "orders_keyset_page",
    "order_id:l customer_id:l order_date:t total_amount:m",
    """
    SELECT order_id, customer_id, order_date, total_amount FROM s_orders WHERE order_id > 999
    ORDER BY order_id LIMIT 1000""",
)
def orders_keyset_page(shop):
    """The page after order 999; the key condition reaches the scan, nothing is skipped over."""
    return _page(shop.orders.where("order_id > 999"), [F.col("order_id")], 1000)


def _page(df, order: list, n: int):
    """One page. A page has at most 1000 rows; to ask for more is an error, not a shorter page."""
    if n > 1000:
        raise ValueError("a page has at most 1000 rows; ask for the next one by the last key")
    return df.orderBy(*order).limit(n)


@query(
    "payments_by_fraud_label",
    "payment_id:l customer_id:l attempt_ts:t amount:m method:s",
    """
    SELECT payment_id, customer_id, attempt_ts, amount, method FROM s_payments WHERE is_fraudulent""",
)
def payments_by_fraud_label(shop):
    """GET payments?is_fraudulent=true."""
    return shop.attempts.where("is_fraudulent")


@query(
    "revenue_since",
    "date:d nb_orders:l revenue:m",
    """
    SELECT CAST(order_date AS DATE) AS date, count(*) AS nb_orders, sum(total_amount) AS revenue
    FROM s_orders WHERE status = 'paid' AND order_date >= DATE '1999-01-01' GROUP BY 1""",
)
def revenue_since(shop):
    since = F.col("order_date") >= F.lit("1999-01-01").cast("timestamp_ntz")
    return reports.daily_revenue(shop.orders.where(since))


@query(
    "revenue_grains",
    "grain:s period:d nb_orders:l revenue:m",
    """
    SELECT grain, period, count(*) AS nb_orders, sum(total_amount) AS revenue FROM (
        SELECT 'day' AS grain, CAST(order_date AS DATE) AS period, total_amount FROM s_orders WHERE status = 'paid'
        UNION ALL SELECT 'week', CAST(date_trunc('week', order_date) AS DATE), total_amount
        FROM s_orders WHERE status = 'paid'
        UNION ALL SELECT 'month', CAST(date_trunc('month', order_date) AS DATE), total_amount
        FROM s_orders WHERE status = 'paid') GROUP BY 1, 2""",
)
def revenue_grains(shop):
    return reports.revenue_grains(shop.orders)


@query(
    "conversion_rates",
    "sessions:l payments:l orders:l items:l payments_per_session:f success_rate:f items_per_order:f",
    """
    SELECT sessions, payments, orders, items, CAST(payments AS DOUBLE) / sessions AS payments_per_session,
           CAST(ok AS DOUBLE) / payments AS success_rate, CAST(items AS DOUBLE) / orders AS items_per_order
    FROM (SELECT count(*) AS sessions FROM s_sessions),
         (SELECT count(*) AS payments, count(*) FILTER (result = 'success') AS ok FROM s_payments),
         (SELECT count(*) AS orders FROM s_orders), (SELECT count(*) AS items FROM lineitem)""",
)
def conversion_rates(shop):
    # Four counts, one row each, folded into one row by a single aggregate.
    parts = {
        "sessions": shop.sessions.agg(F.count("*").alias("n")),
        "payments": shop.attempts.agg(F.count("*").alias("n")),
        "ok": shop.attempts.where("result = 'success'").agg(F.count("*").alias("n")),
        "orders": shop.orders.agg(F.count("*").alias("n")),
        "items": shop.lines.agg(F.count("*").alias("n")),
    }
    out = None
    for name, df in parts.items():
        one = df.select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    total = out.agg(*[F.sum(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in parts])
    return total.withColumns(
        {
            "payments_per_session": share(F.col("payments"), F.col("sessions")),
            "success_rate": share(F.col("ok"), F.col("payments")),
            "items_per_order": share(F.col("items"), F.col("orders")),
        }
    )


@query(
    "payment_success_by_method",
    "method:s attempts:l successes:l success_rate:f",
    """
    SELECT method, count(*) AS attempts, count(*) FILTER (result = 'success') AS successes,
           CAST(count(*) FILTER (result = 'success') AS DOUBLE) / count(*) AS success_rate
    FROM s_payments GROUP BY method""",
)
def payment_success_by_method(shop):
    ok = F.count_if(F.col("result") == "success")
    return shop.attempts.groupBy("method").agg(
        F.count("*").alias("attempts"),
        ok.alias("successes"),
        share(ok, F.count("*")).alias("success_rate"),
    )


@query(
    "sessions_per_day",
    "day:d sessions:l views:l customers:l",
    """
    SELECT CAST(session_start AS DATE) AS day, count(*) AS sessions, sum(n_views) AS views,
           count(DISTINCT customer_id) AS customers
    FROM s_sessions GROUP BY 1""",
)
def sessions_per_day(shop):
    spans = sessionize(
        shop.events,
        "customer_id",
        "ts",
        1800,
        sums={"n_views": (F.col("event_type") == "view").cast("int")},
    )
    return spans.groupBy(F.to_date("session_start").alias("day")).agg(
        F.count("*").alias("sessions"),
        F.sum("n_views").alias("views"),
        F.countDistinct("customer_id").alias("customers"),
    )


@query(
    "validation_report",
    "check_name:s value:f ok:b",
    f"""
    SELECT concat('rows_', "table") AS check_name, CAST("rows" AS DOUBLE) AS value, "rows" > 0 AS ok
    FROM ({_COUNTS})
    UNION ALL
    SELECT 'orphans_orders_customers', CAST(count(*) AS DOUBLE), count(*) = 0 FROM s_orders
    WHERE customer_id NOT IN (SELECT customer_id FROM s_customers)
    UNION ALL
    SELECT 'orphans_order_items_products', CAST(count(*) AS DOUBLE), count(*) = 0 FROM lineitem
    WHERE l_partkey NOT IN (SELECT product_id FROM s_products)
    UNION ALL
    SELECT 'orphans_payments_orders', CAST(count(*) AS DOUBLE), count(*) = 0 FROM s_payments
    WHERE payment_id NOT IN (SELECT order_id FROM s_orders WHERE status = 'paid')
    UNION ALL
    SELECT 'paid_revenue', CAST(sum(total_amount) AS DOUBLE), TRUE FROM s_orders WHERE status = 'paid'
    UNION ALL
    SELECT 'items_value', CAST(sum(subtotal) AS DOUBLE), TRUE FROM s_items
    UNION ALL
    SELECT 'avg_basket', CAST(sum(total_amount) AS DOUBLE) / count(*), TRUE FROM s_orders
    UNION ALL
    SELECT 'fraud_rate', CAST(count(*) FILTER (is_fraudulent) AS DOUBLE) / count(*) * 100, TRUE FROM s_payments
    UNION ALL
    SELECT 'avg_items_per_order', CAST(sum(n) AS DOUBLE) / count(*), TRUE
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)""",
)
def validation_report(shop):
    links = orphan_links(shop)
    return quality.validation_report(
        tables(shop),
        {k: links[k] for k in ("orders_customers", "order_items_products", "payments_orders")},
        shop.orders,
        shop.lines,
        _sales(shop),
        shop.attempts,
    )
