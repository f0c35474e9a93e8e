"""Queries behind the business marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from etalage.operators import baskets, marts, sketches, reports
from etalage.operators.ordered import sessionize as split_sessions
from etalage.plans.registry import query
from etalage.session import write_through
from etalage.plans.views import age


@query(
    "kpi_summary",
    "revenue:m nb_orders:l paid_orders:l customers:l mean_basket:f",
    """
    SELECT sum(total_amount) FILTER (status = 'paid') AS revenue, count(*) AS nb_orders,
           count(*) FILTER (status = 'paid') AS paid_orders, count(DISTINCT customer_id) AS customers,
           CAST(sum(total_amount) FILTER (status = 'paid') AS DOUBLE) / count(*) FILTER (status = 'paid')
               AS mean_basket
    FROM s_orders""",
)
def kpi_summary(shop):
    return marts.kpi_summary(shop.orders)


@query(
    "revenue_growth",
    "grain:s period:d revenue:m previous:m growth:f",
    """
    SELECT grain, period, revenue, previous, CAST(revenue - previous AS DOUBLE) / CAST(previous AS DOUBLE) AS growth
    FROM (SELECT *, lag(revenue) OVER (PARTITION BY grain ORDER BY period) AS previous FROM (
        SELECT 'week' AS grain, CAST(date_trunc('week', order_date) AS DATE) AS period, sum(total_amount) AS revenue
        FROM s_orders WHERE status = 'paid' GROUP BY 2
        UNION ALL
        SELECT 'month', CAST(date_trunc('month', order_date) AS DATE), sum(total_amount)
        FROM s_orders WHERE status = 'paid' GROUP BY 2))""",
)
def revenue_growth(shop):
    return marts.revenue_growth(shop.orders)


@query(
    "kpi_anomalies",
    "measure:s date:d value:f kind:s",
    """
    WITH daily AS (
        SELECT 'revenue' AS measure, CAST(order_date AS DATE) AS date, CAST(sum(total_amount) AS DECIMAL(28, 2)) AS value
        FROM s_orders WHERE status = 'paid' GROUP BY 2
        UNION ALL
        SELECT 'frauds', CAST(attempt_ts AS DATE), CAST(count(*) FILTER (is_fraudulent) AS DECIMAL(28, 2))
        FROM s_payments GROUP BY 2),
    seven AS (
        SELECT *, sum(value) OVER w AS total7, count(*) OVER w AS days FROM daily
        WINDOW w AS (PARTITION BY measure ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
    judged AS (
        SELECT measure, date, CAST(value AS DOUBLE) AS value,
               CASE WHEN days < 7 THEN NULL WHEN 14 * value < total7 THEN 'drop'
                    WHEN 7 * value > 2 * total7 THEN 'peak' END AS kind FROM seven)
    SELECT * FROM judged WHERE kind IS NOT NULL AND (measure = 'revenue' OR kind = 'peak')""",
)
def kpi_anomalies(shop):
    return marts.kpi_anomalies(shop.orders, shop.attempts)


@query(
    "top_products_per_category",
    "category:s rank:l product_id:l name:s total_revenue:m",
    """
    SELECT * FROM (
        SELECT category, product_id, name, sum(subtotal) AS total_revenue,
               row_number() OVER (PARTITION BY category ORDER BY sum(subtotal) DESC, product_id) AS rank
        FROM s_items JOIN s_products USING (product_id) GROUP BY 1, 2, 3) WHERE rank <= 3""",
)
def top_products_per_category(shop):
    return marts.top_per_category(shop.products, reports.sales_from_lines(shop.lines, shop.products))


@query(
    "low_stock",
    "product_id:l name:s sold:l stock_left:l",
    """
    SELECT p.product_id, p.name, coalesce(sold, 0) AS sold, 800 - coalesce(sold, 0) AS stock_left
    FROM s_products p LEFT JOIN (SELECT l_partkey, sum(CAST(l_quantity AS BIGINT)) AS sold FROM lineitem GROUP BY 1)
      ON l_partkey = p.product_id
    WHERE 800 - coalesce(sold, 0) < 50""",
)
def low_stock(shop):
    return marts.low_stock(shop.products, shop.lines, stock=800, below=50)


@query(
    "rfm_segments",
    "customer_id:l recency:l frequency:l monetary:m r_score:l f_score:l m_score:l segment:s",
    """
    SELECT *, CASE WHEN r_score + f_score + m_score >= 13 THEN 'champions'
                   WHEN r_score + f_score + m_score >= 10 THEN 'loyal'
                   WHEN r_score + f_score + m_score >= 7 THEN 'regular' ELSE 'at_risk' END AS segment
    FROM (SELECT *, ntile(5) OVER (ORDER BY recency DESC, customer_id) AS r_score,
                 ntile(5) OVER (ORDER BY frequency, customer_id) AS f_score,
                 ntile(5) OVER (ORDER BY monetary, customer_id) AS m_score
          FROM (SELECT customer_id,
                       date_diff('day', CAST(max(order_date) AS DATE),
                                 (SELECT CAST(max(order_date) AS DATE) FROM s_orders)) AS recency,
                       count(*) AS frequency, sum(total_amount) AS monetary
                FROM s_orders GROUP BY customer_id))""",
)
def rfm_segments(shop):
    return marts.rfm(shop.orders)


@query(
    "cohort_retention",
    "cohort:d month_offset:l customers:l",
    """
    SELECT cohort, date_diff('month', cohort, month) AS month_offset, count(DISTINCT customer_id) AS customers
    FROM (SELECT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS month,
                 CAST(date_trunc('month', min(order_date) OVER (PARTITION BY customer_id)) AS DATE) AS cohort
          FROM s_orders) GROUP BY 1, 2""",
)
def cohort_retention(shop):
    return marts.cohort_retention(shop.orders)


@query(
    "customer_lifetime_value",
    "customer_id:l nb_orders:l revenue:m active_days:l span_days:l",
    """
    SELECT customer_id, count(*) AS nb_orders, sum(total_amount) AS revenue,
           count(DISTINCT CAST(order_date AS DATE)) AS active_days,
           date_diff('day', CAST(min(order_date) AS DATE), CAST(max(order_date) AS DATE)) AS span_days
    FROM s_orders WHERE status = 'paid' GROUP BY customer_id""",
)
def customer_lifetime_value(shop):
    return marts.lifetime_value(shop.orders)


@query(
    "conversion_funnel",
    "step_no:l step:s customers:l",
    """
    WITH v AS (SELECT customer_id, min(event_id) AS at FROM s_events WHERE event_type = 'view' GROUP BY 1),
    c AS (SELECT e.customer_id, min(event_id) AS at FROM s_events e JOIN v ON e.customer_id = v.customer_id
          WHERE event_type = 'click' AND event_id > v.at GROUP BY 1),
    p AS (SELECT e.customer_id, min(event_id) AS at FROM s_events e JOIN c ON e.customer_id = c.customer_id
          WHERE event_type = 'purchase' AND event_id > c.at GROUP BY 1)
    SELECT 1 AS step_no, 'view' AS step, count(*) AS customers FROM v
    UNION ALL SELECT 2, 'click', count(*) FROM c UNION ALL SELECT 3, 'purchase', count(*) FROM p""",
)
def conversion_funnel(shop):
    return marts.conversion_funnel(shop.events, ["view", "click", "purchase"])


@query(
    "cart_abandonment",
    "sessions:l with_cart:l abandoned:l abandonment_rate:f",
    """
    SELECT count(*) AS sessions, count(*) FILTER (n_clicks > 0) AS with_cart,
           count(*) FILTER (n_clicks > 0 AND n_purchases = 0) AS abandoned,
           CAST(count(*) FILTER (n_clicks > 0 AND n_purchases = 0) AS DOUBLE) / count(*) FILTER (n_clicks > 0)
               AS abandonment_rate
    FROM s_sessions6""",
)
def cart_abandonment(shop):
    return marts.cart_abandonment(shop.events, gap=6 * 3600)


@query(
    "utm_attribution",
    "touch:s source:s purchases:l revenue:m",
    """
    WITH touched AS (
        SELECT *, first_value(utm_source) OVER w AS first_source, lag(utm_source) OVER w AS last_source,
               row_number() OVER w AS n
        FROM s_events WINDOW w AS (PARTITION BY customer_id ORDER BY ts, event_id))
    SELECT 'first' AS touch, CASE WHEN n > 1 THEN first_source ELSE 'none' END AS source, count(*) AS purchases,
           sum(value) AS revenue FROM touched WHERE event_type = 'purchase' GROUP BY 2
    UNION ALL
    SELECT 'last', coalesce(last_source, 'none'), count(*), sum(value) FROM touched
    WHERE event_type = 'purchase' GROUP BY 2""",
)
def utm_attribution(shop):
    return marts.utm_attribution(shop.events)


_SECONDS = "CAST(floor((epoch_us(session_end) - epoch_us(session_start)) / 1000000) AS BIGINT)"


@query(
    "session_metrics",
    "utm_source:s sessions:l events:l seconds:l mean_seconds:f bounce_rate:f",
    f"""
    SELECT utm_source, count(*) AS sessions, sum(n_events) AS events, sum({_SECONDS}) AS seconds,
           CAST(sum({_SECONDS}) AS DOUBLE) / count(*) AS mean_seconds,
           CAST(count(*) FILTER (n_events = 1) AS DOUBLE) / count(*) AS bounce_rate
    FROM s_sessions GROUP BY utm_source""",
)
def session_metrics(shop):
    return marts.session_metrics(shop.sessions)


@query(
    "sessionize",
    "customer_id:l session_start:t session_end:t n_events:l n_purchases:l",
    "SELECT * FROM s_sessions",
)
def sessionize(shop):
    bought = (F.col("event_type") == "purchase").cast("int")
    return split_sessions(shop.events, "customer_id", "ts", 1800, sums={"n_purchases": bought})


@query(
    "customer_360",
    "customer_id:l name:s country:s segment:s nb_orders:l revenue:m last_order:t last_order_id:l"
    " linked:l linked_failed:l attempts:l failed:l frauds:l",
    """
    SELECT c.customer_id, name, country, segment, nb_orders, revenue, last_order, last_order_id, linked,
           linked_failed, attempts, failed, frauds
    FROM s_customers c LEFT JOIN (
        SELECT customer_id, count(*) AS nb_orders, sum(total_amount) FILTER (status = 'paid') AS revenue,
               max(order_date) AS last_order FROM s_orders GROUP BY 1) USING (customer_id)
    LEFT JOIN (
        SELECT customer_id, order_id AS last_order_id FROM s_orders
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) = 1)
      USING (customer_id)
    LEFT JOIN (
        SELECT o.customer_id, count(*) AS linked, count(*) FILTER (result = 'failed') AS linked_failed
        FROM s_orders o JOIN s_payments p ON o.order_id = p.payment_id GROUP BY 1) USING (customer_id)
    LEFT JOIN (
        SELECT customer_id, count(*) AS attempts, count(*) FILTER (result = 'failed') AS failed,
               count(*) FILTER (is_fraudulent) AS frauds FROM s_payments GROUP BY 1) USING (customer_id)""",
)
def customer_360(shop):
    # The raw orders carry the number of their payment, which here is their own.
    orders = shop.orders.withColumn("payment_id", F.col("order_id"))
    profile = marts.customer_360(shop.customers, orders, shop.attempts)
    return profile.select(
        "customer_id",
        "name",
        "country",
        "segment",
        "orders.*",
        "linked_payments.linked",
        F.col("linked_payments.failed").alias("linked_failed"),
        "payments.*",
    )


@query(
    "revenue_by_country",
    "country:s customers:l nb_orders:l revenue:m",
    """
    SELECT country, count(DISTINCT o.customer_id) AS customers, count(*) AS nb_orders, sum(total_amount) AS revenue
    FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id WHERE status = 'paid' GROUP BY country""",
)
def revenue_by_country(shop):
    return marts.revenue_by_country(shop.orders, shop.customers)


@query(
    "seasonality",
    "month:l dow:l hour:l purchases:l revenue:m",
    """
    SELECT month(ts) AS month, dayofweek(ts) + 1 AS dow, hour(ts) AS hour, count(*) AS purchases,
           sum(value) AS revenue
    FROM s_events WHERE event_type = 'purchase' GROUP BY 1, 2, 3""",
)
def seasonality(shop):
    return marts.seasonality(shop.events)


@query(
    "category_pairs",
    "a:s b:s orders:l orders_a:l orders_b:l lift:f",
    """
    WITH basket AS (SELECT DISTINCT l_orderkey AS o, category AS c FROM lineitem JOIN s_products ON l_partkey = product_id),
    support AS (SELECT c, count(*) AS n FROM basket GROUP BY c),
    pairs AS (SELECT x.c AS a, y.c AS b, count(*) AS orders FROM basket x JOIN basket y ON x.o = y.o AND x.c < y.c
              GROUP BY 1, 2)
    SELECT a, b, orders, s.n AS orders_a, t.n AS orders_b,
           orders * CAST((SELECT count(DISTINCT o) FROM basket) AS DOUBLE) / (s.n * t.n) AS lift
    FROM pairs JOIN support s ON a = s.c JOIN support t ON b = t.c""",
)
def category_pairs(shop):
    return marts.category_pairs(shop.lines, shop.products)


@query(
    "restricted_sales_to_minors",
    "order_id:l product_id:l quantity:l customer_id:l order_date:t age:l",
    f"""
    SELECT order_id, product_id, quantity, customer_id, order_date, age FROM (
        SELECT i.order_id, i.product_id, i.quantity, o.customer_id, order_date,
               {age('birthdate', 'CAST(order_date AS DATE)')} AS age
        FROM s_items i JOIN s_products p ON i.product_id = p.product_id AND is_adult_restricted
        JOIN s_orders o ON i.order_id = o.order_id JOIN s_customers c ON o.customer_id = c.customer_id)
    WHERE age < 18""",
)
def restricted_sales_to_minors(shop):
    return marts.restricted_to_minors(shop.lines, shop.products, shop.orders, shop.people)


@query(
    "cross_device",
    "customer_id:l devices:l events:l main_device:s",
    """
    SELECT customer_id, count(*) AS devices, sum(n) AS events, arg_max(device, (n, device)) AS main_device
    FROM (SELECT customer_id, device, count(*) AS n FROM s_events GROUP BY 1, 2) GROUP BY 1""",
)
def cross_device(shop):
    return marts.cross_device(shop.events)


@query(
    "interval_click_purchase",
    "event_id:l customer_id:l ts:t value:m clicks:l",
    """
    SELECT p.event_id, p.customer_id, p.ts, p.value, count(*) AS clicks
    FROM s_events p JOIN s_events c ON p.customer_id = c.customer_id AND c.event_type = 'click'
      AND c.ts <= p.ts AND c.ts >= p.ts - INTERVAL 30 MINUTE
    WHERE p.event_type = 'purchase' GROUP BY ALL""",
)
def interval_click_purchase(shop):
    return marts.clicks_before_purchase(shop.events, 1800)


@query(
    "retention_filter",
    "order_id:l order_date:t",
    """
    SELECT order_id, order_date FROM s_orders
    WHERE order_date >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 24 MONTH""",
)
def retention_filter(shop):
    return marts.within_retention(shop.orders, "order_date", "2001-08-01")


@query(
    "tumbling_5min",
    "window_start:t event_type:s n:l",
    """
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS n
    FROM s_events GROUP BY 1, 2""",
)
def tumbling_5min(shop):
    return marts.tumbling(shop.events, 5)


def _pairs_sql(items: str, least: int) -> str:
    """Plain self-join of (basket, item) rows."""
    return f"""
    WITH items AS (SELECT DISTINCT basket, item FROM ({items}) WHERE basket IS NOT NULL AND item IS NOT NULL),
    single AS (SELECT item, count(*) AS n FROM items GROUP BY item),
    pairs AS (SELECT x.item AS a, y.item AS b, count(*) AS baskets FROM items x JOIN items y ON x.basket = y.basket AND x.item < y.item
              GROUP BY ALL HAVING count(*) >= {least})
    SELECT a, b, baskets, s.n AS baskets_a, t.n AS baskets_b, CAST(baskets AS DOUBLE) / s.n AS confidence_ab,
           CAST(baskets AS DOUBLE) / t.n AS confidence_ba,
           baskets * CAST((SELECT count(DISTINCT basket) FROM items) AS DOUBLE) / (s.n * t.n) AS lift
    FROM pairs JOIN single s ON a = s.item JOIN single t ON b = t.item"""


@query(
    "product_pairs",
    "a:l b:l baskets:l baskets_a:l baskets_b:l confidence_ab:r confidence_ba:r lift:r",
    _pairs_sql("SELECT l_orderkey AS basket, l_partkey AS item FROM lineitem", 3),
)
def product_pairs(shop):
    """Products in three orders or more together."""
    return baskets.frequent_pairs(shop.lines, "order_id", F.col("product_id"), 3)


_TRAITS = """
    SELECT payment_id AS basket, unnest([concat('method=', method), concat('result=', result),
        CASE WHEN country_mismatch THEN 'country_mismatch=true' END, CASE WHEN high_amount THEN 'high_amount=true' END,
        CASE WHEN time_anomaly THEN 'time_anomaly=true' END, CASE WHEN device_change THEN 'device_change=true' END,
        CASE WHEN amount > 200 THEN 'large=true' END]) AS item
    FROM s_flags WHERE is_fraudulent"""


@query(
    "fraud_trait_pairs",
    "a:s b:s baskets:l baskets_a:l baskets_b:l confidence_ab:r confidence_ba:r lift:r",
    _pairs_sql(_TRAITS, 5),
)
def fraud_trait_pairs(shop):
    """Traits that five fraudulent payments or more have together."""
    columns = {"method": F.col("method"), "result": F.col("result"), "large": F.col("amount") > 200}
    columns |= {r: F.col(r) for r in ("country_mismatch", "high_amount", "time_anomaly", "device_change")}
    seen = baskets.traits(shop.flagged.where("is_fraudulent"), columns)
    return baskets.frequent_pairs(seen, "payment_id", F.col("trait"), 5)


@query(
    "audience_spans",
    "grain:s period:d event_type:s customers:l",
    """
    SELECT 'week' AS grain, CAST(date_trunc('week', ts) AS DATE) AS period, event_type, count(DISTINCT customer_id) AS customers
    FROM s_events GROUP BY ALL
    UNION ALL SELECT 'month', CAST(date_trunc('month', ts) AS DATE), event_type, count(DISTINCT customer_id) FROM s_events GROUP BY ALL""",
)
def audience_spans(shop):
    """Distinct customers of weeks and months from the daily sketches of the gold layer; no event is read for them."""
    daily = _daily_audience(shop)
    spans = {g: sketches.sizes(sketches.audience(daily, F.to_date(F.date_trunc(g, "day")), ["event_type"])) for g in ("week", "month")}
    return spans["week"].withColumn("grain", F.lit("week")).unionByName(spans["month"].withColumn("grain", F.lit("month")))


def _daily_audience(shop):
    return write_through(sketches.daily_audience(shop.events, "customer_id", "ts", ["event_type"]), "gold-audience")


@query(
    "audience_returning",
    "period:d event_type:s weeks_later:l customers:l again:l",
    """
    WITH weeks AS (SELECT DISTINCT CAST(date_trunc('week', ts) AS DATE) AS period, event_type, customer_id AS c FROM s_events),
    sizes AS (SELECT period, event_type, count(*) AS customers FROM weeks GROUP BY ALL),
    pairs AS (SELECT a.period, a.event_type, o AS weeks_later, b.period AS later FROM sizes a, (VALUES (1), (2), (3)) v(o)
              JOIN sizes b ON b.event_type = a.event_type AND b.period = a.period + CAST(7 * o AS INTEGER))
    SELECT p.period, p.event_type, p.weeks_later, any_value(s.customers) AS customers, count(y.c) AS again
    FROM pairs p JOIN sizes s ON s.period = p.period AND s.event_type = p.event_type
    JOIN weeks x ON x.period = p.period AND x.event_type = p.event_type
    LEFT JOIN weeks y ON y.period = p.later AND y.event_type = p.event_type AND y.c = x.c GROUP BY ALL""",
)
def audience_returning(shop):
    """Customers of a week who are there again one, two or three weeks later."""
    weekly = sketches.audience(_daily_audience(shop), F.to_date(F.date_trunc("week", "day")), ["event_type"])
    return sketches.returning(weekly, ["event_type"], [1, 2, 3])
