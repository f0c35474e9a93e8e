"""Queries that curate: projections, ids, maps, lookups, loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from etalage.domain import AS_OF
from etalage.functions import values as v
from etalage.functions.columns import hash_bucket, id_text, mapped
from etalage.operators import curate
from etalage.operators.ordered import global_row_number
from etalage.plans.registry import query
from etalage.plans.views import case_map


@query(
    "customers_curated",
    "customer_id:s email:s first_name:s last_name:s phone:s date_of_birth:d country:s"
    " registration_ip:s created_at:t",
    """
    SELECT customer_id, concat('customer', customer_num, '@shop.example') AS email,
           concat('FirstName', customer_num) AS first_name, concat('LastName', customer_num) AS last_name,
           printf('+33612345%03d', customer_num) AS phone, birthdate AS date_of_birth, country,
           concat('192.168.', customer_num % 256, '.', customer_num % 256) AS registration_ip,
           signup_ts AS created_at
    FROM s_people""",
)
def customers_curated(shop):
    return curate.customers(shop.raw("customers"))


@query(
    "customers_with_contact",
    "email:s first_name:s last_name:s date_of_birth:d identity_verified:b",
    """
    SELECT concat(lower(customer_id), '@shop.example') AS email,
           concat('Client', substr(customer_id, 2)) AS first_name,
           concat('Test', substr(customer_id, 2)) AS last_name, birthdate AS date_of_birth,
           age >= 18 AS identity_verified
    FROM s_people""",
)
def customers_with_contact(shop):
    return curate.customers_with_contact(shop.raw("customers"))


@query(
    "products_curated",
    "product_id:l name:s category:s subcategory:s price:m stock_quantity:l brand:s description:s"
    " is_adult_only:b created_at:t",
    """
    SELECT product_id, printf('Product %04d', product_id) AS name, category, category AS subcategory,
           price, 100 AS stock_quantity, concat('Brand ', category) AS brand,
           printf('Description de Product %04d', product_id) AS description,
           is_adult_restricted AS is_adult_only,
           DATE '2023-01-01' + CAST(product_id % 365 AS INT) AS created_at
    FROM s_products""",
)
def products_curated(shop):
    return curate.products(shop.raw("products"))


@query(
    "sessions_curated",
    "session_id:s customer_id:s start_ts:t end_ts:t device:s ip_hash:s utm_source:s utm_campaign:s"
    " created_at:t",
    """
    SELECT concat('S', customer_id, '-', strftime(session_start, '%Y%m%d%H%M%S')) AS session_id,
           printf('C%05d', customer_id) AS customer_id, session_start AS start_ts,
           CASE WHEN n_events > 1 THEN session_end END AS end_ts, device,
           md5(printf('C%05d', customer_id)) AS ip_hash, utm_source,
           CASE WHEN utm_source = 'direct' THEN 'none' ELSE 'spring' END AS utm_campaign,
           session_start AS created_at
    FROM s_sessions WHERE customer_id IN (SELECT customer_id FROM s_customers)""",
)
def sessions_curated(shop):
    return curate.sessions(shop.raw("sessions"), shop.raw("customers"))


@query(
    "payments_curated",
    "payment_id:l order_id:l payment_date:t amount:m payment_method:s card_bin_last4:s payment_status:s"
    " transaction_id:s ip_address:s device_id:s payment_country:s is_fraudulent:b",
    """
    SELECT payment_id, order_id, attempt_ts AS payment_date, amount, method AS payment_method,
           CASE WHEN method = 'card'
                THEN right(CAST(400000 + customer_id * 7919 % 100000 AS VARCHAR), 4) END AS card_bin_last4,
           result AS payment_status, printf('PAY%07d', payment_id) AS transaction_id,
           ip_hash AS ip_address, device_id, payment_country, is_fraudulent
    FROM s_payments JOIN s_links USING (payment_id) WHERE order_id IS NOT NULL""",
)
def payments_curated(shop):
    return curate.payments(shop.raw("payments"), shop.orders, numbers=shop.attempts)


@query(
    "alerts_curated",
    "alert_id:s payment_id:l alert_date:t alert_type:s risk_score:f action_taken:s severity:s"
    " description:s status:s",
    """
    SELECT alert_id, payment_id, alert_date, alert_type, risk_score, action_taken, severity,
           concat('Alerte déclenchée par règle: ', alert_type) AS description, status
    FROM s_alerts WHERE payment_id IN (SELECT payment_id FROM s_links WHERE order_id IS NOT NULL)""",
)
def alerts_curated(shop):
    linked = curate.link_nearest(shop.attempts.select("payment_id"), shop.orders)
    return curate.alerts(shop.raw("fraud_alerts"), linked)


@query(
    "map_defaults",
    "kind:s source:s target:s n:l",
    f"""
    SELECT 'order_status' AS kind, status AS source,
           {case_map('status', v.ORDER_STATUS, v.DEFAULT_ORDER_STATUS)} AS target, count(*) AS n
    FROM s_orders GROUP BY 2, 3
    UNION ALL
    SELECT 'payment_method', method,
           {case_map('method', v.PAYMENT_METHOD, v.DEFAULT_PAYMENT_METHOD)}, count(*)
    FROM s_payments GROUP BY 2, 3
    UNION ALL
    SELECT 'severity', alert_type, {case_map('alert_type', v.SEVERITIES, v.DEFAULT_SEVERITY)}, count(*)
    FROM s_alerts GROUP BY 2, 3""",
)
def map_defaults(shop):
    def counted(df, kind, column, values, default):
        # Count per source value first, so that the map runs once per value.
        return (
            df.groupBy(F.col(column).alias("source"))
            .agg(F.count("*").alias("n"))
            .select(F.lit(kind).alias("kind"), "source", mapped("source", values, default).alias("target"), "n")
        )

    return (
        counted(shop.orders, "order_status", "status", v.ORDER_STATUS, v.DEFAULT_ORDER_STATUS)
        .unionByName(
            counted(
                shop.attempts, "payment_method", "method", v.PAYMENT_METHOD, v.DEFAULT_PAYMENT_METHOD
            )
        )
        .unionByName(
            counted(shop.alerts, "severity", "alert_type", v.SEVERITIES, v.DEFAULT_SEVERITY)
        )
    )


@query(
    "payments_scored",
    "transaction_id:s payment_method:s amount:m status:s is_fraudulent:b fraud_score:f payment_date:t",
    f"""
    SELECT printf('PAY%07d', payment_id) AS transaction_id,
           {case_map('method', v.PAYMENT_METHOD, v.DEFAULT_PAYMENT_METHOD)} AS payment_method, amount,
           CASE WHEN result = 'success' THEN 'completed' ELSE 'failed' END AS status, is_fraudulent,
           CASE WHEN is_fraudulent THEN 90.0 ELSE 10.0 END AS fraud_score, attempt_ts AS payment_date
    FROM s_payments""",
)
def payments_scored(shop):
    return curate.payments_scored(shop.raw("payments"))


@query(
    "addresses_build",
    "address_id:l customer_id:s street:s city:s postal_code:s country:s address_type:s created_at:t",
    """
    SELECT row_number() OVER (ORDER BY segment <> 'BUILDING', printf('C%05d', c.customer_id)) AS address_id,
           printf('C%05d', c.customer_id) AS customer_id, '123 Rue de la Paix' AS street, 'Paris' AS city,
           '75001' AS postal_code, country, 'both' AS address_type, signup_ts AS created_at
    FROM s_customers c""",
)
def addresses_build(shop):
    """Customers of one segment have an address already; the others get one."""
    people = curate.customers(shop.raw("customers"))
    has_one = shop.people.where("segment = 'BUILDING'").select(
        id_text("C", "customer_id", 5).alias("customer_id")
    )
    existing = global_row_number(
        curate.addresses(people.join(has_one, "customer_id", "left_semi")),
        [F.col("customer_id")],
        "address_id",
    )
    return curate.append_addresses(existing, people)


@query(
    "addresses_latest",
    "customer_id:l address_id:l",
    "SELECT customer_id, max(order_id) AS address_id FROM s_orders GROUP BY customer_id",
)
def addresses_latest(shop):
    """The delivery address of each order is numbered like the order; the last one wins."""
    return curate.latest_address(
        shop.orders.select("customer_id", F.col("order_id").alias("address_id"))
    )


@query(
    "adult_flag",
    "customer_id:l date_of_birth:d age:l is_adult:b",
    """
    SELECT customer_num AS customer_id, birthdate AS date_of_birth, age, age >= 18 AS is_adult
    FROM s_people""",
)
def adult_flag(shop):
    return curate.adults(shop.people.withColumnRenamed("birthdate", "date_of_birth"), AS_OF)


@query(
    "customer_age_bands",
    "band:l n:l n_adults:l",
    """
    SELECT age // 10 * 10 AS band, count(*) AS n, count(*) FILTER (age >= 18) AS n_adults
    FROM s_people GROUP BY 1""",
)
def customer_age_bands(shop):
    people = curate.adults(shop.people, AS_OF, born="birthdate")
    return people.groupBy((F.floor(F.col("age") / 10) * 10).alias("band")).agg(
        F.count("*").alias("n"), F.count_if("is_adult").alias("n_adults")
    )


@query(
    "reject_split",
    "reject:s n:l quantity:l",
    """
    SELECT CASE WHEN order_bad THEN 'order_id' WHEN product_bad THEN 'product_id' ELSE 'accepted' END AS reject,
           count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS quantity
    FROM (SELECT *, l_tax = 0.08 AND l_discount = 0.1 AS order_bad, l_tax = 0 AND l_discount = 0 AS product_bad
          FROM lineitem) GROUP BY 1""",
)
def reject_split(shop):
    """Lines with some ids spoilt: a letter in the order number, or no product id."""
    li = shop.table("lineitem")
    order = id_text("O", "l_orderkey", 7)
    feed = li.select(
        F.when((F.col("l_tax") == 0.08) & (F.col("l_discount") == 0.1), F.concat(order, F.lit("X")))
        .otherwise(order)
        .alias("order_id"),
        F.when(
            ~((F.col("l_tax") == 0) & (F.col("l_discount") == 0)), id_text("P", "l_partkey", 4)
        ).alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("qty"),
    )
    split = curate.split_rejects(
        feed, {"order_num": ("order_id", "O"), "product_num": ("product_id", "P")}
    )
    return split.groupBy(F.coalesce("reject", F.lit("accepted")).alias("reject")).agg(
        F.count("*").alias("n"), F.sum("qty").alias("quantity")
    )


_GOOD = "SELECT customer_id FROM s_customers WHERE balance >= 0"


@query(
    "semi_valid_orders",
    "order_id:l customer_id:l total_amount:m",
    f"SELECT order_id, customer_id, total_amount FROM s_orders WHERE customer_id IN ({_GOOD})",
)
def semi_valid_orders(shop):
    """Orders whose customer is in the valid set: accounts in credit."""
    return shop.orders.join(shop.people.where("balance >= 0"), "customer_id", "left_semi")


@query(
    "anti_rejected_orders",
    "order_id:l customer_id:l total_amount:m",
    f"SELECT order_id, customer_id, total_amount FROM s_orders WHERE customer_id NOT IN ({_GOOD})",
)
def anti_rejected_orders(shop):
    return shop.orders.join(shop.people.where("balance >= 0"), "customer_id", "left_anti")


@query(
    "order_items_priced",
    "order_id:l product_id:l quantity:l unit_price:m subtotal:m",
    "SELECT * FROM s_items",
)
def order_items_priced(shop):
    return curate.price_lines(shop.lines, shop.products)


@query(
    "lookup_by_name",
    "order_id:l product_id:l quantity:l unit_price:m",
    "SELECT * FROM s_items",
)
def lookup_by_name(shop):
    return curate.price_lines_by_name(shop.raw("order_items"), curate.products(shop.raw("products")))


@query(
    "payment_order_nearest",
    "payment_id:l order_id:l link:s",
    """
    SELECT p.payment_id,
           coalesce(o.order_id, (SELECT min(n.order_id) FROM s_orders n WHERE n.status = 'paid'
                                 AND n.order_id BETWEEN p.payment_id - 4 AND p.payment_id + 4)) AS order_id,
           CASE WHEN o.order_id IS NOT NULL THEN 'exact' ELSE 'near' END AS link
    FROM s_payments p LEFT JOIN s_orders o ON o.order_id = p.payment_id AND o.status = 'paid'
    WHERE coalesce(o.order_id, (SELECT min(n.order_id) FROM s_orders n WHERE n.status = 'paid'
                                AND n.order_id BETWEEN p.payment_id - 4 AND p.payment_id + 4)) IS NOT NULL""",
)
def payment_order_nearest(shop):
    """Only paid orders can be linked to."""
    return curate.link_nearest(
        shop.attempts.select("payment_id"), shop.orders.where("status = 'paid'")
    )


@query(
    "positional_link",
    "position:l payment_id:l order_id:l amount:m",
    """
    SELECT a.position, a.payment_id, b.order_id, a.amount
    FROM (SELECT payment_id, amount, row_number() OVER (ORDER BY payment_id) AS position FROM s_payments) a
    JOIN (SELECT order_id, row_number() OVER (ORDER BY order_id) AS position FROM s_orders) b
      ON a.position = b.position""",
)
def positional_link(shop):
    return curate.link_by_position(
        shop.attempts.select("payment_id", "amount"), "payment_id", shop.orders.select("order_id"), "order_id"
    )


@query(
    "scalar_lookup",
    "order_id:l email:s customer_id:l",
    """
    SELECT order_id, email, c.customer_id
    FROM (SELECT order_id, concat(lower(printf('C%05d', customer_id)), '@shop.example') AS email FROM s_orders)
    LEFT JOIN (SELECT concat(lower(printf('C%05d', customer_id)), '@shop.example') AS email,
                      min(customer_id) AS customer_id
               FROM s_customers WHERE balance >= 0 GROUP BY 1) c USING (email)""",
)
def scalar_lookup(shop):
    """Customer number by the e-mail an order carries; null where no account in credit has it."""
    email = F.concat(F.lower(id_text("C", "customer_id", 5)), F.lit("@shop.example"))
    by_email = shop.people.where("balance >= 0").select(email.alias("email"), "customer_id")
    return curate.lookup_first(
        shop.orders.select("order_id", email.alias("email")), "email", by_email, "customer_id"
    )


@query(
    "upsert_stamped",
    "customer_id:l balance:m segment:s updated_at:t change:s",
    """
    SELECT coalesce(o.customer_id, i.customer_id) AS customer_id, coalesce(i.balance, o.balance) AS balance,
           coalesce(i.segment, o.segment) AS segment,
           CASE WHEN o.customer_id IS NULL OR (i.customer_id IS NOT NULL
                     AND (o.balance <> i.balance OR o.segment <> i.segment))
                THEN TIMESTAMP '2024-01-31 00:00:00' ELSE o.signup_ts END AS updated_at,
           CASE WHEN o.customer_id IS NULL THEN 'inserted'
                WHEN i.customer_id IS NOT NULL AND (o.balance <> i.balance OR o.segment <> i.segment)
                THEN 'updated' ELSE 'kept' END AS change
    FROM s_customers o FULL OUTER JOIN (
        SELECT customer_id, CASE WHEN balance < 0 THEN 0 ELSE balance END AS balance, segment
        FROM s_customers WHERE segment IN ('BUILDING', 'MACHINERY')
        UNION ALL
        SELECT 1000000000000 + s_suppkey, CAST(s_acctbal AS DECIMAL(18, 2)), 'SUPPLIER' FROM supplier
    ) i ON o.customer_id = i.customer_id""",
)
def upsert_stamped(shop):
    """Incoming rows: two segments with overdrafts cleared, and the suppliers as new customers."""
    current = shop.people.withColumnRenamed("signup_ts", "updated_at")
    cleared = shop.people.where(F.col("segment").isin("BUILDING", "MACHINERY")).select(
        "customer_id",
        F.greatest("balance", F.lit(0).cast("decimal(18,2)")).alias("balance"),
        "segment",
    )
    new = shop.table("supplier").select(
        (F.lit(1_000_000_000_000) + F.col("s_suppkey")).alias("customer_id"),
        F.col("s_acctbal").cast("decimal(18,2)").alias("balance"),
        F.lit("SUPPLIER").alias("segment"),
    )
    return curate.upsert(
        current, cleared.unionByName(new), "customer_id", ["balance", "segment"], f"{AS_OF} 00:00:00"
    )


@query(
    "dedup_latest",
    "order_id:l product_id:l line_number:l ship_date:t quantity:m",
    """
    SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_number, l_shipdate AS ship_date,
           l_quantity AS quantity
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1""",
)
def dedup_latest(shop):
    """Lines share (order, line number); the one shipped last stays."""
    kept = curate.dedup_latest(
        shop.table("lineitem"),
        ["l_orderkey", "l_linenumber"],
        [F.col("l_shipdate").desc(), *map(F.col, ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"])],
    )
    return kept.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_shipdate").alias("ship_date"),
        F.col("l_quantity").alias("quantity"),
    )


@query(
    "split_70_15_15",
    "customer_id:l part:s",
    """
    SELECT customer_id, CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'validation' ELSE 'test' END AS part
    FROM (SELECT customer_id,
                 CAST(concat('0x', substr(md5(CAST(customer_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 AS b
          FROM s_customers)""",
)
def split_70_15_15(shop):
    b = hash_bucket("customer_id")
    return shop.people.select(
        "customer_id",
        F.when(b < 70, "train").when(b < 85, "validation").otherwise("test").alias("part"),
    )
