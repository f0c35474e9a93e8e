"""Queries that go through files: scans, conversion, loads, layers, topics.

Each writes the given tables in the wanted form to the shared folder and reads them back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from etalage.functions.columns import id_number
from etalage.functions.values import TOPICS
from etalage.operators import curate, documents, reports
from etalage.operators.privacy import row_checksum
from etalage.plans.registry import query
from etalage.plans.reports import suspects
from etalage.schemas import FILES
from etalage.session import fresh_dir, together
from etalage.sources import files, gold
from etalage.sources.load import full_load

_TABLES = ["customers", "products", "orders", "order_items", "payments"]


def _inputs(shop, names) -> str:
    folder = fresh_dir(shop.spark, "inputs")
    together({name: lambda name=name: files.write_input(shop.raw(name), folder, name) for name in names})
    return folder


@query(
    "csv_scan",
    "table_name:s row_count:l amount:m",
    """
    SELECT 'customers' AS table_name, count(*) AS row_count, NULL AS amount FROM s_customers
    UNION ALL SELECT 'products', count(*), sum(price) FROM s_products
    UNION ALL SELECT 'orders', count(*), sum(total_amount) FROM s_orders
    UNION ALL SELECT 'order_items', count(*), sum(CAST(l_quantity AS BIGINT)) FROM lineitem
    UNION ALL SELECT 'payments', count(*), sum(amount) FROM s_payments""",
)
def csv_scan(shop):
    folder = _inputs(shop, _TABLES)
    amounts = {
        "customers": F.lit(None),
        "products": F.sum("unit_price"),
        "orders": F.sum("total_amount"),
        "order_items": F.sum("qty"),
        "payments": F.sum("amount"),
    }
    out = None
    for name in _TABLES:
        df = files.read_input(shop.spark, folder, name)
        part = df.agg(
            F.count("*").alias("row_count"), amounts[name].cast("decimal(28,2)").alias("amount")
        ).select(F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "jsonl_scan",
    "event_type:s n:l with_product:l with_payment:l cart_value:m",
    """
    SELECT CASE WHEN k = 13 THEN 'corrupt' ELSE event_type END AS event_type, count(*) AS n,
           count(*) FILTER (k <> 13 AND event_type = 'view') AS with_product,
           count(*) FILTER (k <> 13 AND event_type IN ('purchase', 'error')) AS with_payment,
           CAST(sum(value) FILTER (k <> 13 AND event_type = 'click') AS DECIMAL(28, 2)) AS cart_value
    FROM s_events GROUP BY 1""",
)
def jsonl_scan(shop):
    """Events as JSON lines, the lines of one kind cut short."""
    path = fresh_dir(shop.spark, "events.jsonl")
    line = F.to_json(F.struct(*FILES["events"].names))
    cut = F.when(F.col("k") == 13, F.substring(line, 1, 20)).otherwise(line)
    shop.events_as_input("k").select(cut.alias("value")).write.text(path)
    back = files.read_jsonl(shop.spark, path)
    kind = F.when(F.col(files.CORRUPT).isNotNull(), "corrupt").otherwise(F.col("event_type"))
    return back.groupBy(kind.alias("event_type")).agg(
        F.count("*").alias("n"),
        F.count("product_id").alias("with_product"),
        F.count("payment_id").alias("with_payment"),
        F.sum(F.col("cart_value").cast("decimal(18,2)")).alias("cart_value"),
    )


def _digest(columns: str) -> str:
    return f"sum(CAST(concat('0x', substr(md5(concat_ws('|', {columns})), 1, 8)) AS BIGINT))"


# The columns that are summed up by a digest of each row, so that a swap or a lost cell shows.
_SUMMED = {
    "customers": ["customer_id", "country", "birthdate"],
    "products": ["product_id", "name", "category", "unit_price"],
    "orders": ["order_id", "customer_id", "total_amount", "status"],
    "order_items": ["order_id", "product_id", "qty"],
    "payments": ["payment_id", "customer_id", "method", "amount", "result"],
    "events": ["event_id", "event_type", "customer_id", "device", "utm_source"],
}


@query(
    "convert_roundtrip",
    "table_name:s row_count:l checksum:l",
    f"""
    SELECT 'customers' AS table_name, count(*) AS row_count,
           {_digest("printf('C%05d', customer_id), country, birthdate")} AS checksum FROM s_customers
    UNION ALL SELECT 'products', count(*),
           {_digest("printf('P%04d', product_id), printf('Product %04d', product_id), category, price")} FROM s_products
    UNION ALL SELECT 'orders', count(*),
           {_digest("printf('O%07d', order_id), printf('C%05d', customer_id), total_amount, status")} FROM s_orders
    UNION ALL SELECT 'order_items', count(*),
           {_digest("printf('O%07d', l_orderkey), printf('P%04d', l_partkey), CAST(l_quantity AS BIGINT)")} FROM lineitem
    UNION ALL SELECT 'payments', count(*),
           {_digest("printf('PAY%07d', payment_id), printf('C%05d', customer_id), method, amount, result")} FROM s_payments
    UNION ALL SELECT 'events', count(*),
           {_digest("event_id, event_type, printf('C%05d', customer_id), device, utm_source")} FROM s_events""",
)
def convert_roundtrip(shop):
    """Inputs that are there become Parquet; the absent ones are passed over."""
    folder = _inputs(shop, [*_TABLES, "events"])
    out = fresh_dir(shop.spark, "parquet")
    done = files.convert_to_parquet(shop.spark, folder, out)
    total = None
    for name in done:
        part = shop.spark.read.parquet(f"{out}/{name}").agg(
            F.count("*").alias("row_count"), row_checksum(_SUMMED[name]).alias("checksum")
        ).select(F.lit(name).alias("table_name"), "*")
        total = part if total is None else total.unionByName(part)
    return total


@query(
    "full_refresh_counts",
    "table_name:s row_count:l",
    """
    SELECT 'customers' AS table_name, count(*) AS row_count FROM s_customers
    UNION ALL SELECT 'products', count(*) FROM s_products
    UNION ALL SELECT 'sessions', count(*) FROM s_sessions WHERE customer_id IN (SELECT customer_id FROM s_customers)
    UNION ALL SELECT 'addresses', count(*) FROM s_customers
    UNION ALL SELECT 'orders', count(*) FROM s_orders
    UNION ALL SELECT 'order_items', count(*) FROM lineitem
    UNION ALL SELECT 'payments', count(*) FROM s_links WHERE order_id IS NOT NULL
    UNION ALL SELECT 'fraud_alerts', count(*) FROM s_alerts
    WHERE payment_id IN (SELECT payment_id FROM s_links WHERE order_id IS NOT NULL)""",
)
def full_refresh_counts(shop):
    """Load all input files into empty tables."""
    folder = _inputs(shop, [*_TABLES, "sessions", "fraud_alerts"])
    tables, _ = full_load(shop.spark, folder, fresh_dir(shop.spark, "tables"))
    return reports.table_counts(tables).toDF("table_name", "row_count")


@query(
    "load_rejects",
    "table_name:s read:l accepted:l unreadable:l unlinked:l",
    """
    WITH spoilt AS (
        SELECT *, order_id % 13 = 0 AS unreadable,
               order_id % 11 = 0 OR customer_id NOT IN (SELECT customer_id FROM s_customers) AS unlinked FROM s_orders),
    lines AS (
        SELECT coalesce(l_orderkey IN (SELECT order_id FROM spoilt WHERE NOT unreadable AND NOT unlinked)
                        AND l_partkey IN (SELECT product_id FROM s_products), FALSE) AS ok FROM lineitem)
    SELECT 'customers' AS table_name, count(*) AS "read", count(*) AS accepted, 0 AS unreadable, 0 AS unlinked FROM s_customers
    UNION ALL SELECT 'products', count(*), count(*), 0, 0 FROM s_products
    UNION ALL SELECT 'orders', count(*), count(*) FILTER (NOT unreadable AND NOT unlinked),
        count(*) FILTER (unreadable), count(*) FILTER (unlinked AND NOT unreadable) FROM spoilt
    UNION ALL SELECT 'order_items', count(*), count(*) FILTER (ok), 0, count(*) FILTER (NOT ok) FROM lines""",
)
def load_rejects(shop):
    """A load of files in which some orders have no readable amount and some name no known customer."""
    folder = _inputs(shop, [*(t for t in _TABLES if t != "orders"), "sessions", "fraud_alerts"])
    n = id_number("order_id", "O")
    spoilt = shop.raw("orders").withColumns(
        {
            "total_amount": F.when(n % 13 == 0, "abc").otherwise(F.col("total_amount").cast("string")),
            "customer_id": F.when(n % 11 == 0, "nobody").otherwise(F.col("customer_id")),
        }
    )
    files.write_input(spoilt, folder, "orders")
    _, counts = full_load(shop.spark, folder, fresh_dir(shop.spark, "tables"))
    return counts.where(F.col("table_name").isin("customers", "products", "orders", "order_items"))


@query(
    "medallion_gold_daily",
    "date:d nb_orders:l revenue:m avg_order_value:f",
    """
    SELECT CAST(order_date AS DATE) AS date, count(*) AS nb_orders, sum(total_amount) AS revenue,
           CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_order_value
    FROM s_orders WHERE status = 'paid' GROUP BY 1""",
)
def medallion_gold_daily(shop):
    """Bronze: orders as delivered. Silver: typed, unique, by month. Gold: revenue per day."""
    lake = fresh_dir(shop.spark, "lake")
    bronze = files.write_layer(shop.raw("orders"), lake, "bronze", "orders")
    typed = bronze.select(
        id_number("order_id", "O").alias("order_id"),
        "customer_id",
        F.col("order_ts").alias("order_date"),
        "total_amount",
        "status",
        F.date_format("order_ts", "yyyy-MM").alias("month"),
    ).where("order_id is not null")
    unique = curate.dedup_latest(
        typed, ["order_id"], [F.col("order_date").desc(), "customer_id", "total_amount", "status"]
    )
    silver = files.write_layer(
        unique, lake, "silver", "orders", by="month", spread=["order_date", "order_id"]
    )
    return files.write_layer(reports.daily_revenue(silver), lake, "gold", "daily_revenue")


@query(
    "medallion_gold_tables",
    "table_name:s row_count:l",
    """
    SELECT 'daily_revenue' AS table_name, count(DISTINCT CAST(order_date AS DATE)) AS row_count
    FROM s_orders WHERE status = 'paid'
    UNION ALL SELECT 'top_products', count(*) FROM s_products
    UNION ALL SELECT 'fraud_stats', count(*) FROM (
        SELECT DISTINCT CAST(alert_date AS DATE), alert_type, is_fraudulent FROM s_alerts)
    UNION ALL SELECT 'customer_lifetime_value', count(DISTINCT customer_id) FROM s_orders WHERE status = 'paid'""",
)
def medallion_gold_tables(shop):
    """Silver tables written first, the gold ones from them."""
    lake = fresh_dir(shop.spark, "lake")
    orders = files.write_layer(shop.orders, lake, "silver", "orders")
    products = files.write_layer(shop.products, lake, "silver", "products")
    lines = files.write_layer(shop.lines, lake, "silver", "order_items")
    alerts = files.write_layer(shop.alerts, lake, "silver", "fraud_alerts")
    gold = files.write_gold(lake, orders, products, reports.sales_from_lines(lines, products), alerts)
    return reports.table_counts(gold).toDF("table_name", "row_count")


@query(
    "silver_layers",
    "table_name:s bronze:l silver:l checksum:l",
    f"""
    SELECT 'customers' AS table_name, count(*) + count(*) FILTER (customer_id % 7 = 0) AS bronze, count(*) AS silver,
           {_digest("printf('C%05d', customer_id), country, birthdate")} AS checksum FROM s_customers
    UNION ALL SELECT 'payments', count(*) + count(*) FILTER (payment_id % 7 = 0), count(*),
           {_digest("printf('PAY%07d', payment_id), printf('C%05d', customer_id), method, amount, result")} FROM s_payments""",
)
def silver_layers(shop):
    """Customers and payments as delivered, some of them twice, and the unique, readable ones."""
    lake = fresh_dir(shop.spark, "lake")
    total = None
    for name, key, prefix, at in (("customers", "customer_id", "C", "signup_ts"), ("payments", "payment_id", "PAY", "attempt_ts")):
        number = id_number(key, prefix)
        delivered = shop.raw(name)
        bronze = files.write_layer(delivered.unionByName(delivered.where(number % 7 == 0)), lake, "bronze", name)
        others = [c for c in bronze.columns if c not in (key, at)]
        unique = curate.dedup_latest(bronze.where(number.isNotNull()), [key], [F.col(at).desc(), *others])
        silver = files.write_layer(unique, lake, "silver", name)
        part = silver.agg(F.count("*").alias("silver"), row_checksum(_SUMMED[name]).alias("checksum")).select(
            F.lit(name).alias("table_name"), F.lit(bronze.count()).alias("bronze"), "silver", "checksum"
        )
        total = part if total is None else total.unionByName(part)
    return total


@query(
    "retention_drop",
    "day:s n:l",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM s_events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
    GROUP BY 1""",
)
def retention_drop(shop):
    """Events by day, the days before a date deleted."""
    lake = fresh_dir(shop.spark, "lake")
    daily = shop.events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    files.write_layer(daily, lake, "bronze", "events", by="day", spread=["ts"])
    files.drop_partitions(shop.spark, f"{lake}/bronze/events", "day", "2024-01-15")
    left = shop.spark.read.parquet(f"{lake}/bronze/events")
    return left.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


@query(
    "route_topics",
    "topic:s event_type:s n:l",
    """
    SELECT CASE event_type WHEN 'view' THEN 'user-events' WHEN 'signup' THEN 'user-events'
                WHEN 'click' THEN 'cart-events' WHEN 'purchase' THEN 'orders' WHEN 'error' THEN 'payments'
                ELSE 'unrouted' END AS topic, event_type, count(*) AS n
    FROM s_events GROUP BY 1, 2""",
)
def route_topics(shop):
    """One folder per topic; within a topic rows are placed by customer."""
    routed = shop.events.withColumn("topic", files.topic_of("event_type", TOPICS))
    back = files.write_layer(
        routed, fresh_dir(shop.spark, "lake"), "topics", "events", by="topic", spread=["customer_id", "ts"]
    )
    return back.groupBy("topic", "event_type").agg(F.count("*").alias("n"))


@query(
    "gold_daily_refresh",
    "day:d event_type:s n:l value:m",
    "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, sum(value) AS value FROM s_events GROUP BY 1, 2",
)
def gold_daily_refresh(shop):
    """Events of all days, then the purchases of two days that come late: gold is built once, then for two days."""
    spark = shop.spark
    bronze, gold_path, seen = (fresh_dir(spark, n) for n in ("bronze-events", "gold-events", "gold-seen"))
    events = shop.events.select("event_id", "event_type", "value", F.to_date("ts").alias("day"))
    late = (F.col("event_type") == "purchase") & F.col("day").isin("2024-01-05", "2024-01-12")

    def daily(rows):
        return rows.groupBy("day", "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))

    for arrival in (events.where(~late), events.where(late)):
        arrival.write.mode("append").partitionBy("day").parquet(bronze)
        gold.refresh_days(spark, bronze, events.schema, gold_path, daily, seen)
    return spark.read.parquet(gold_path)


@query(
    "documents_extracted",
    "customer_id:l status:s doc_type:s number:s expiry:d birth:d score:f adult:b",
    """
    WITH seen AS (
        SELECT customer_id, CASE WHEN extracted_data IS NULL THEN 'missing' WHEN json_valid(extracted_data) THEN 'ok' ELSE 'unreadable' END AS status,
            CASE WHEN json_valid(extracted_data) THEN CAST(extracted_data AS JSON) END AS j FROM s_extracted
    )
    SELECT customer_id, status, json_extract_string(j, '$.document.type') AS doc_type, json_extract_string(j, '$.document.number') AS number,
        TRY_CAST(json_extract_string(j, '$.document.expiry') AS DATE) AS expiry, TRY_CAST(json_extract_string(j, '$.person.birth.date') AS DATE) AS birth,
        CAST(json_extract(j, '$.scores[0]') AS DOUBLE) AS score, TRY_CAST(json_extract_string(j, '$.adult') AS BOOLEAN) AS adult
    FROM seen""",
)
def documents_extracted(shop):
    """What was read from identity documents, by path; parts that are missing, null or of another type are null."""
    wanted = {
        "doc_type": ("$.document.type", "string"),
        "number": ("$.document.number", "string"),
        "expiry": ("$.document.expiry", "date"),
        "birth": ("$.person.birth.date", "date"),
        "score": ("$.scores[0]", "double"),
        "adult": ("$.adult", "boolean"),
    }
    return documents.fields(documents.read_variant(shop.extracted, "extracted_data"), "extracted_data", wanted)


@query(
    "documents_shape",
    "source:s key:s kind:s n:l",
    """
    WITH objects AS (
        SELECT 'extracted_data' AS source, CAST(extracted_data AS JSON) AS j FROM s_extracted WHERE json_valid(extracted_data)
        UNION ALL SELECT 'props', CAST(props AS JSON) FROM events
    ), pairs AS (SELECT source, unnest(json_keys(j)) AS key, j FROM objects),
    kinds AS (SELECT source, key, json_type(j, concat('$.', key)) AS t FROM pairs)
    SELECT source, key, CASE WHEN t IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN 'number' WHEN t = 'VARCHAR' THEN 'string' ELSE lower(t) END AS kind,
        count(*) AS n FROM kinds GROUP BY ALL""",
)
def documents_shape(shop):
    """The keys and kinds of values of both semi-structured columns, found from the rows."""
    read = documents.read_variant(shop.extracted, "extracted_data")
    props = documents.read_variant(shop.table("events"), "props")
    found = {"extracted_data": documents.shape(read, "extracted_data"), "props": documents.shape(props, "props")}
    parts = [df.select(F.lit(n).alias("source"), "key", "kind", "n") for n, df in found.items()]
    return parts[0].unionByName(parts[1])


@query(
    "orders_details_bucketed",
    "order_id:l order_date:t status:s total_amount:m customer_id:l name:s country:s items_count:l",
    """
    SELECT o.order_id, o.order_date, o.status, o.total_amount, o.customer_id, c.name, c.country, count(i.order_id) AS items_count
    FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id LEFT JOIN s_items i ON i.order_id = o.order_id GROUP BY ALL""",
)
def orders_details_bucketed(shop):
    """Orders and lines dealt by order: counted and joined where they lie."""
    orders = gold.bucketed(shop.orders, "orders", "order_id", 8)
    lines = gold.bucketed(shop.lines, "order_items", "order_id", 8)
    return reports.orders_details(orders, shop.customers, lines)


@query(
    "suspicious_payments_bucketed",
    "payment_id:l payment_date:t amount:m payment_method:s is_fraudulent:b customer_id:l customer_country:s nb_alerts:l",
    """
    SELECT p.payment_id, p.attempt_ts AS payment_date, p.amount, p.method AS payment_method, p.is_fraudulent,
           o.customer_id, c.country AS customer_country, count(a.alert_id) AS nb_alerts
    FROM s_payments p JOIN s_links l ON p.payment_id = l.payment_id
    JOIN s_orders o ON l.order_id = o.order_id JOIN s_customers c ON o.customer_id = c.customer_id
    LEFT JOIN s_alerts a ON p.payment_id = a.payment_id
    WHERE p.is_fraudulent OR a.alert_id IS NOT NULL GROUP BY ALL""",
)
def suspicious_payments_bucketed(shop):
    """Linked payments and orders dealt by order: joined where they lie."""
    payments = gold.bucketed(suspects(shop), "payments", "order_id", 8)
    orders = gold.bucketed(shop.orders, "orders", "order_id", 8)
    return reports.suspicious_payments(payments, orders, shop.customers)
