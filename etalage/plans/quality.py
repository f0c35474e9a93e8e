"""Queries for data quality, identity and privacy."""

from __future__ import annotations

from pyspark.sql import functions as F

from etalage.domain import AS_OF
from etalage.functions.columns import id_number, id_text
from etalage.functions import values as v
from etalage.operators import curate, documents, privacy, quality, sketches
from etalage.plans.registry import query
from etalage.session import fresh_dir, together

_CHECK = "check_name:s rows:l failed:l"


def _sql_checks(parts: list[tuple[str, str, str]]) -> str:
    """(check name, table, condition that fails) -> one row per check."""
    return " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, count(*) AS \"rows\", count(*) FILTER ({c}) AS failed FROM {t}"
        for n, t, c in parts
    )


@query(
    "dq_unique",
    "check_name:s keys:l repeated_keys:l extra_rows:l",
    " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, count(*) AS keys, count(*) FILTER (n > 1) AS repeated_keys,"
        f" coalesce(sum(n - 1), 0) AS extra_rows FROM (SELECT count(*) AS n FROM {t} GROUP BY {k})"
        for n, t, k in [
            ("customers(customer_id)", "s_customers", "customer_id"),
            ("products(product_id)", "s_products", "product_id"),
            ("products(name)", "s_products", "name"),
            ("orders(order_id)", "s_orders", "order_id"),
            ("order_items(l_orderkey,l_linenumber)", "lineitem", "l_orderkey, l_linenumber"),
            ("payments(payment_id)", "s_payments", "payment_id"),
            ("payments(transaction_id)", "s_payments", "printf('PAY%07d', payment_id)"),
            ("customers(email)", "s_customers", "concat('customer', customer_id, '@shop.example')"),
        ]
    ),
)
def dq_unique(shop):
    return quality.union_all(
        [
            quality.unique(shop.people, "customers", ["customer_id"]),
            quality.unique(shop.products, "products", ["product_id"]),
            quality.unique(shop.products, "products", ["name"]),
            quality.unique(shop.orders, "orders", ["order_id"]),
            quality.unique(shop.table("lineitem"), "order_items", ["l_orderkey", "l_linenumber"]),
            quality.unique(shop.attempts, "payments", ["payment_id"]),
            quality.unique(
                shop.attempts.select(id_text("PAY", "payment_id", 7).alias("transaction_id")), "payments", ["transaction_id"]
            ),
            quality.unique(curate.customers(shop.raw("customers")), "customers", ["email"]),
        ]
    )


@query(
    "dq_not_null",
    _CHECK,
    _sql_checks(
        [(f"customers.{c}", "s_customers", f"{c} IS NULL") for c in ("customer_id", "name", "country")]
        + [(f"orders.{c}", "s_orders", f"{c} IS NULL") for c in ("customer_id", "order_date", "total_amount")]
        + [("payments.payment_id", "s_payments", "payment_id IS NULL"), ("payments.card_bin", "s_payments", "method <> 'card'")]
        + [("sessions.start_ts", "s_sessions", "session_start IS NULL"), ("sessions.end_ts", "s_sessions", "n_events = 1")]
    ),
)
def dq_not_null(shop):
    return quality.union_all(
        [
            quality.not_null(shop.customers, "customers", ["customer_id", "name", "country"]),
            quality.not_null(shop.orders, "orders", ["customer_id", "order_date", "total_amount"]),
            quality.not_null(shop.raw("payments"), "payments", ["payment_id", "card_bin"]),
            quality.not_null(shop.raw("sessions"), "sessions", ["start_ts", "end_ts"]),
        ]
    )


_KNOWN_EVENTS = ["view", "click", "purchase"]


@query(
    "dq_accepted_values",
    _CHECK,
    _sql_checks(
        [
            ("orders.status", "s_orders", "status NOT IN ('pending', 'paid', 'cancelled', 'processing', 'shipped')"),
            ("payments.method", "s_payments", "method NOT IN ('card', 'paypal', 'bank_transfer')"),
            ("payments.result", "s_payments", "result NOT IN ('success', 'failed')"),
            ("addresses.address_type", "s_customers", f"'{v.DEFAULT_ADDRESS_TYPE}' NOT IN ('billing', 'shipping', 'both')"),
            (
                "documents.document_type",
                "(SELECT CASE WHEN json_valid(extracted_data) THEN json_extract_string(extracted_data, '$.document.type') END AS kind FROM s_extracted)",
                "kind NOT IN ('national_id', 'passport', 'driver_license')",
            ),
            ("fraud_alerts.severity", "s_alerts", "severity NOT IN ('low', 'medium', 'high', 'critical')"),
            ("fraud_alerts.status", "s_alerts", "status NOT IN ('open', 'investigating', 'resolved', 'false_positive')"),
            ("events.event_type", "s_events", "event_type NOT IN ('view', 'click', 'purchase')"),
        ]
    ),
)
def dq_accepted_values(shop):
    return quality.union_all(
        [
            quality.accepted_values(shop.orders, "orders", {"status": v.ORDER_STATUSES}),
            quality.accepted_values(
                shop.attempts, "payments", {"method": v.PAYMENT_METHODS, "result": v.PAYMENT_RESULTS}
            ),
            quality.accepted_values(
                curate.addresses(curate.customers(shop.raw("customers"))),
                "addresses",
                {"address_type": v.ADDRESS_TYPES},
            ),
            quality.accepted_values(
                # The type is what was read from the document; where nothing could be read there is none to check.
                documents.fields(
                    documents.read_variant(shop.extracted, "extracted_data"), "extracted_data", {"document_type": ("$.document.type", "string")}
                ),
                "documents",
                {"document_type": v.DOCUMENT_TYPES},
            ),
            quality.accepted_values(
                shop.alerts, "fraud_alerts", {"severity": v.ALERT_SEVERITIES, "status": v.ALERT_STATUSES}
            ),
            quality.accepted_values(shop.events, "events", {"event_type": _KNOWN_EVENTS}),
        ]
    )


@query(
    "dq_ranges",
    _CHECK,
    _sql_checks(
        [
            ("customers.balance", "s_customers", "balance < 0"),
            ("products.price", "s_products", "price < 0"),
            ("orders.total_amount", "s_orders", "total_amount < 0"),
            ("order_items.quantity", "s_items", "quantity <= 0"),
            ("order_items.unit_price", "s_items", "unit_price < 0"),
            ("payments.amount", "s_payments", "amount NOT BETWEEN 0 AND 200"),
            ("fraud_alerts.risk_score", "s_alerts", "risk_score NOT BETWEEN 0 AND 1"),
        ]
    ),
)
def dq_ranges(shop):
    items = curate.price_lines(shop.lines, shop.products)
    return quality.union_all(
        [
            quality.in_range(shop.people, "customers", {"balance": F.col("balance") >= 0}),
            quality.in_range(shop.products, "products", {"price": F.col("price") >= 0}),
            quality.in_range(shop.orders, "orders", {"total_amount": F.col("total_amount") >= 0}),
            quality.in_range(
                items,
                "order_items",
                {"quantity": F.col("quantity") > 0, "unit_price": F.col("unit_price") >= 0},
            ),
            quality.in_range(shop.attempts, "payments", {"amount": F.col("amount").between(0, 200)}),
            quality.in_range(shop.alerts, "fraud_alerts", {"risk_score": F.col("risk_score").between(0, 1)}),
        ]
    )


@query(
    "dq_formats",
    _CHECK,
    _sql_checks(
        [
            ("customers.customer_id", "s_people", "NOT regexp_matches(customer_id, '^C[0-9]{5}$')"),
            ("customers.country", "s_people", "length(country) > 2 OR NOT regexp_matches(country, '^[A-Z]{2}$')"),
            ("documents.doc_number", "s_people", "customer_num % 13 = 0"),
            (
                "payments.card_bin",
                "s_payments",
                "method = 'card' AND NOT regexp_matches(CAST(400000 + customer_id * 7919 % 100000 AS VARCHAR), '^[0-9]{6}$')",
            ),
        ]
    ),
)
def dq_formats(shop):
    return quality.union_all(
        [
            quality.well_formed(
                shop.raw("customers"),
                "customers",
                {"customer_id": (50, "^C[0-9]{5}$"), "country": (2, "^[A-Z]{2}$")},
            ),
            quality.well_formed(
                shop.raw("identity_labels"), "documents", {"doc_number": (9, "^ID[0-9]{7}$")}
            ),
            quality.well_formed(shop.raw("payments"), "payments", {"card_bin": (6, "^[0-9]{6}$")}),
        ]
    )


@query(
    "dq_drift_psi",
    "bucket:l base:f now:f psi:r",
    """
    SELECT bucket, base, now, (now / tn - base / tb) * ln((now / tn) / (base / tb)) AS psi FROM (
        SELECT *, sum(base) OVER () AS tb, sum(now) OVER () AS tn FROM (
            SELECT g AS bucket, CAST(count(*) FILTER (b = g AND NOT later) AS DOUBLE) + 0.5 AS base,
                   CAST(count(*) FILTER (b = g AND later) AS DOUBLE) + 0.5 AS now
            FROM (SELECT least(floor(CAST(value AS DOUBLE) / 50), 9) AS b, ts >= TIMESTAMP '2024-01-16' AS later
                  FROM s_events), range(10) t(g) GROUP BY g))""",
)
def dq_drift_psi(shop):
    return quality.drift_psi(
        shop.events.withColumn("value", F.col("value").cast("double")), "value", "ts", "2024-01-16", 50.0, 10
    )


@query(
    "dq_drift_quantiles",
    "utm_source:s week:d n:l psi:r ks:r",
    """
    WITH sides AS (
        SELECT utm_source, ts >= TIMESTAMP '2024-01-08' AS later, CAST(date_trunc('week', ts) AS DATE) AS week, CAST(value AS DOUBLE) AS v
        FROM s_events WHERE value IS NOT NULL
    ), shares AS (SELECT list_transform(range(1, 201), lambda i: (2 * i - 1) / CAST(400 AS DOUBLE)) AS s),
    base AS (SELECT utm_source, count(*) AS base_n, list(v) AS bv FROM sides WHERE NOT later GROUP BY utm_source),
    weeks AS (SELECT utm_source, week, count(*) AS n, list(v) AS v FROM sides WHERE later GROUP BY utm_source, week),
    both_sides AS (
        SELECT utm_source, week, n, base_n, list_transform(s, lambda q: list_sort(bv)[CAST(ceil(q * base_n) AS BIGINT)]) AS b,
            list_transform(s, lambda q: list_sort(v)[CAST(ceil(q * n) AS BIGINT)]) AS g
        FROM weeks JOIN base USING (utm_source), shares
    ), cut AS (
        SELECT *, list_sort(list_distinct(list_transform(range(1, 10), lambda i: b[20 * i]))) AS edges FROM both_sides
    ), ranks AS (
        SELECT *, len(edges) + 1 AS m, list_transform(edges, lambda x: len(list_filter(b, lambda y: y <= x)) / CAST(200 AS DOUBLE)) AS p,
            list_transform(edges, lambda x: len(list_filter(g, lambda y: y <= x)) / CAST(200 AS DOUBLE)) AS q,
            list_max(list_transform(list_concat(b, g), lambda x:
                abs(len(list_filter(b, lambda y: y <= x)) - len(list_filter(g, lambda y: y <= x))) / CAST(200 AS DOUBLE))) AS ks
        FROM cut
    ), parts AS (
        SELECT *, list_transform(range(1, m + 1), lambda i:
                ((coalesce(p[i], 1.0) - CASE WHEN i = 1 THEN 0.0 ELSE p[i - 1] END) * base_n + 0.5) / (base_n + 0.5 * m)) AS ps,
            list_transform(range(1, m + 1), lambda i:
                ((coalesce(q[i], 1.0) - CASE WHEN i = 1 THEN 0.0 ELSE q[i - 1] END) * n + 0.5) / (n + 0.5 * m)) AS qs
        FROM ranks
    )
    SELECT utm_source, week, n, list_sum(list_transform(range(1, m + 1), lambda i: (qs[i] - ps[i]) * ln(qs[i] / ps[i]))) AS psi, ks FROM parts""",
)
def dq_drift_quantiles(shop):
    """Values of each source, week by week, against those before 8 January."""
    weekly = shop.events.withColumn("week", F.to_date(F.date_trunc("week", "ts")))
    later = F.col("ts") >= F.lit("2024-01-08").cast("timestamp_ntz")
    found = sketches.value_sketches(weekly.withColumn("later", later), "value", ["utm_source", "week", "later"])
    return sketches.drift(found, ["utm_source"], ~F.col("later"))


@query(
    "dq_profile",
    "period:d rows:l null_share:f mean:r stddev:r",
    """
    SELECT period, "rows", null_share, mean, sqrt(greatest(squares / n - mean * mean, 0)) AS stddev FROM (
        SELECT CAST(ts AS DATE) AS period, count(*) AS "rows", count(v) AS n,
               CAST(count(*) - count(v) AS DOUBLE) / count(*) AS null_share,
               CAST(sum(v) AS DOUBLE) / count(v) AS mean, CAST(sum(v * v) AS DOUBLE) AS squares
        FROM (SELECT ts, CASE WHEN event_type <> 'signup' THEN value END AS v FROM s_events) GROUP BY 1)""",
)
def dq_profile(shop):
    """Event values per day; sign-ups count as having none."""
    valued = F.when(F.col("event_type") != "signup", F.col("value"))
    return quality.profile(shop.events.withColumn("value", valued), "value", F.to_date("ts"))


@query(
    "dq_reconcile",
    "outcome:s n:l difference:m",
    """
    SELECT CASE WHEN lines_total IS NULL THEN 'no_lines' WHEN total_amount IS NULL THEN 'no_order'
                WHEN lines_total = total_amount THEN 'equal' ELSE 'differs' END AS outcome,
           count(*) AS n, sum(coalesce(total_amount, 0) - coalesce(lines_total, 0)) AS difference
    FROM s_orders o FULL OUTER JOIN (SELECT order_id, sum(subtotal) AS lines_total FROM s_items GROUP BY 1) i
      ON o.order_id = i.order_id GROUP BY 1
    UNION ALL SELECT 'left_only', count(*), NULL FROM (
        SELECT order_id FROM s_orders EXCEPT ALL SELECT DISTINCT order_id FROM s_items)
    UNION ALL SELECT 'right_only', count(*), NULL FROM (
        SELECT DISTINCT order_id FROM s_items EXCEPT ALL SELECT order_id FROM s_orders)""",
)
def dq_reconcile(shop):
    items = curate.price_lines(shop.lines, shop.products)
    sides = quality.only_in_one(
        shop.orders.select("order_id"), shop.lines.select("order_id").distinct()
    ).select(F.col("side").alias("outcome"), "n", F.lit(None).cast("decimal(38,2)").alias("difference"))
    return quality.reconcile(shop.orders, items).unionByName(sides)


@query(
    "id_age_check",
    "file:s age:l labelled_adult:b agrees:b",
    """
    SELECT printf('id_%07d.png', customer_num) AS file, age, age >= 17 AS labelled_adult,
           (age >= 18) = (age >= 17) AS agrees FROM s_people""",
)
def id_age_check(shop):
    return privacy.age_check(shop.raw("identity_labels"), AS_OF)


@query(
    "id_verify",
    "file:s doc_number:s number_ok:b not_expired:b label_ok:b score:f status:s",
    """
    SELECT *, CAST(CAST(number_ok AS INT) + CAST(not_expired AS INT) + CAST(label_ok AS INT) AS DOUBLE) / 3 AS score,
           CASE WHEN number_ok AND not_expired AND label_ok THEN 'verified' ELSE 'rejected' END AS status
    FROM (SELECT printf('id_%07d.png', customer_num) AS file,
                 CASE WHEN customer_num % 13 = 0 THEN concat('ID', customer_num)
                      ELSE printf('ID%07d', customer_num) END AS doc_number,
                 customer_num % 13 <> 0 AS number_ok, customer_num % 11 <> 0 AS not_expired,
                 (age >= 18) = (age >= 17) AS label_ok FROM s_people)""",
)
def id_verify(shop):
    return privacy.verify_documents(shop.raw("identity_labels"), AS_OF)


@query(
    "gdpr_pseudonymize",
    "pseudonym:s birth_year:l country:s segment:s",
    """
    SELECT sha256(concat('salt:', customer_id)) AS pseudonym, year(birthdate) AS birth_year, country, segment
    FROM s_customers""",
)
def gdpr_pseudonymize(shop):
    """With a salt that is known, so that the result can be compared."""
    return privacy.pseudonymize(shop.customers, "salt:")


_INACTIVE = """
    SELECT customer_id FROM s_customers WHERE customer_id NOT IN (
        SELECT customer_id FROM s_orders WHERE order_date >= TIMESTAMP '2001-01-01 00:00:00')"""


def _erased_sql(parts: list[tuple[str, str, str]]) -> str:
    """(table name, table, condition that keeps a row) -> rows before and after."""
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS before, count(*) FILTER ({c}) AS after FROM {t}" for n, t, c in parts
    )


@query(
    "gdpr_erase",
    "table_name:s before:l after:l",
    f"""
    WITH gone AS ({_INACTIVE}), gone_orders AS (
        SELECT order_id FROM s_orders WHERE customer_id IN (SELECT customer_id FROM gone)),
    gone_payments AS (SELECT payment_id FROM s_payments WHERE customer_id IN (SELECT customer_id FROM gone))
    """
    + _erased_sql(
        [
            (name, table, f"{column} NOT IN (SELECT {column if column.endswith('_id') else 'customer_id'} FROM gone)")
            for name, table, column in [
                ("customers", "s_customers", "customer_id"),
                ("addresses", "s_people", "customer_num"),
                ("documents", "s_people", "customer_num"),
                ("sessions", "s_sessions", "customer_id"),
                ("events", "s_events", "customer_id"),
                ("orders", "s_orders", "customer_id"),
                ("payments", "s_payments", "customer_id"),
            ]
        ]
        + [
            ("order_items", "lineitem", "l_orderkey NOT IN (SELECT order_id FROM gone_orders)"),
            ("fraud_alerts", "s_alerts", "payment_id NOT IN (SELECT payment_id FROM gone_payments)"),
        ]
    ),
)
def gdpr_erase(shop):
    """Erase the customers without an order since 2001, with all that hangs on them, into new folders."""
    recent = shop.orders.where(F.col("order_date") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    erased = shop.people.join(recent, "customer_id", "left_anti")
    number = id_number("customer_id", "C")
    together({"sessions": lambda: shop.sessions, "alerts": lambda: shop.alerts})
    return privacy.erase_to(
        {
            "customers": shop.people,
            "addresses": curate.addresses(curate.customers(shop.raw("customers"))).withColumn("customer_id", number),
            # Documents carry their customer's number in the name of the file.
            "documents": shop.raw("identity_labels").withColumn(
                "customer_id", F.regexp_extract("file", "([0-9]+)", 1).cast("bigint")
            ),
            "sessions": shop.sessions,
            "events": shop.events,
            "orders": shop.orders,
            "order_items": shop.lines,
            "payments": shop.attempts,
            "fraud_alerts": shop.alerts.drop("customer_id"),
        },
        erased,
        "customer_id",
        children={"order_items": ("orders", "order_id"), "fraud_alerts": ("payments", "payment_id")},
        out=fresh_dir(shop.spark, "erased"),
    )


@query(
    "gdpr_erase_files",
    "table_name:s before:l after:l pruned:b",
    """
    SELECT 'orders' AS table_name, count(*) AS before, count(*) FILTER (customer_id > 20) AS after, TRUE AS pruned FROM s_orders
    UNION ALL SELECT 'order_items', count(*), count(*) FILTER (
        l_orderkey NOT IN (SELECT order_id FROM s_orders WHERE customer_id <= 20)), NULL FROM lineitem
    UNION ALL SELECT 'products', count(*), count(*), TRUE FROM s_products""",
)
def gdpr_erase_files(shop):
    """Erase the first twenty customers from stored tables; orders lie by customer, so most of their files stay."""
    folder, out = fresh_dir(shop.spark, "kept"), fresh_dir(shop.spark, "erased")
    shop.orders.repartitionByRange(12, "customer_id").write.parquet(f"{folder}/orders")
    shop.lines.repartitionByRange(12, "order_id").write.parquet(f"{folder}/order_items")
    shop.products.write.parquet(f"{folder}/products")
    erased = shop.people.where("customer_id <= 20")
    names = ["orders", "order_items", "products"]
    done = privacy.erase_files(shop.spark, folder, names, erased, "customer_id", {"order_items": ("orders", "order_id")}, out)
    # Lines of twenty customers' orders can be in few files or in all, by the size of the table.
    pruned = F.when(F.col("table_name") != "order_items", F.col("rewritten") < F.col("files"))
    return done.select("table_name", "before", "after", pruned.alias("pruned"))


def _digest(columns: str) -> str:
    return f"coalesce(sum(CAST(concat('0x', substr(md5(concat_ws('|', {columns})), 1, 8)) AS BIGINT)), 0)"


@query(
    "lineage_counts",
    "step:l stage:s rows:l checksum:l",
    f"""
    SELECT 0 AS step, 'raw' AS stage, count(*) AS "rows",
           {_digest('l_orderkey, l_partkey, CAST(l_quantity AS BIGINT)')} AS checksum FROM lineitem
    UNION ALL
    SELECT 1, 'known_order', count(*), {_digest('l_orderkey, l_partkey, CAST(l_quantity AS BIGINT)')}
    FROM lineitem WHERE l_orderkey IN (SELECT order_id FROM s_orders WHERE status = 'paid')
    UNION ALL
    SELECT 2, 'priced', count(*), {_digest('order_id, product_id, quantity')}
    FROM s_items WHERE order_id IN (SELECT order_id FROM s_orders WHERE status = 'paid')""",
)
def lineage_counts(shop):
    """Order lines from raw to priced, for paid orders."""
    paid = shop.orders.where("status = 'paid'")
    known = shop.lines.join(paid.select("order_id"), "order_id", "left_semi")
    return privacy.lineage(
        {"raw": shop.lines, "known_order": known, "priced": curate.price_lines(known, shop.products)},
        ["order_id", "product_id", "quantity"],
    )
