"""The shop's tables as SQL over the test tables, for the SQL twins of the queries."""

from etalage.domain import AS_OF, DEVICES, METHODS, UTM_SOURCES
from etalage.functions import values as v


def _list(items: list[str]) -> str:
    return "[" + ", ".join(f"'{i}'" for i in items) + "]"


def case_map(column: str, values: dict, default) -> str:
    def lit(x):
        return f"'{x}'" if isinstance(x, str) else f"CAST({x} AS DOUBLE)"

    arms = " ".join(f"WHEN '{k}' THEN {lit(x)}" for k, x in values.items())
    return f"CASE {column} {arms} ELSE {lit(default)} END"


def age(born: str, at: str) -> str:
    return (
        f"(year({at}) - year({born}) - CASE WHEN strftime({at}, '%m%d') < strftime({born}, '%m%d')"
        " THEN 1 ELSE 0 END)"
    )


def sessions(gap: str) -> str:
    return f"""
    SELECT customer_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events,
           count(*) FILTER (event_type = 'view') AS n_views,
           count(*) FILTER (event_type = 'click') AS n_clicks,
           count(*) FILTER (event_type = 'purchase') AS n_purchases,
           arg_min(device, event_id) AS device, arg_min(utm_source, event_id) AS utm_source
    FROM (SELECT *, sum(fresh) OVER (PARTITION BY customer_id ORDER BY ts, event_id) AS sid
          FROM (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL '{gap}'
                               THEN 1 ELSE 0 END AS fresh
                FROM s_events WINDOW w AS (PARTITION BY customer_id ORDER BY ts, event_id)))
    GROUP BY customer_id, sid"""


_FLAGS = ", ".join(f"CASE WHEN {r} THEN '{r}' END" for r in v.RULES)
_SORTED = ", ".join(f"CASE WHEN {r} THEN '{r}' END" for r in sorted(v.RULES))
_SCORES = ", ".join(
    f"CASE WHEN {r} THEN CAST({v.RISK_SCORES.get(r, v.DEFAULT_RISK_SCORE)} AS DOUBLE) ELSE 0 END"
    for r in v.RULES
)

VIEWS = {
    "s_customers": """
    SELECT c_custkey AS customer_id, c_name AS name, n_name AS country, c_nationkey AS nk,
           CAST(DATE '1950-01-01' + CAST(c_custkey * 37 % 21900 AS INT) AS DATE) AS birthdate,
           CAST(DATE '1994-01-01' + CAST(c_custkey * 11 % 360 AS INT) AS TIMESTAMP) AS signup_ts,
           CAST(c_acctbal AS DECIMAL(18, 2)) AS balance, c_mktsegment AS segment
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "s_products": """
    SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS brand,
           CAST(p_retailprice AS DECIMAL(18, 2)) AS price, p_type = 'PROMO' AS is_adult_restricted
    FROM part""",
    "s_orders": """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
           CAST(o_totalprice AS DECIMAL(18, 2)) AS total_amount,
           CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status
    FROM orders""",
    "s_items": """
    SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
           price AS unit_price, CAST(CAST(l_quantity AS BIGINT) * price AS DECIMAL(18, 2)) AS subtotal
    FROM lineitem JOIN s_products ON l_partkey = product_id""",
    "s_events": f"""
    SELECT event_id, ts, user_id AS customer_id, event_type, CAST(value AS DECIMAL(18, 2)) AS value, k,
           {_list(UTM_SOURCES)}[k % 4 + 1] AS utm_source,
           {_list(DEVICES)}[(k // 10) % 4 + 1] AS device
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
    "s_payments": f"""
    SELECT event_id AS payment_id, e.customer_id, c.country AS customer_country, ts AS attempt_ts,
           value AS amount, {_list(METHODS)}[k % 3 + 1] AS method, n_name AS payment_country,
           concat('dev', e.customer_id * 7 + CASE WHEN k BETWEEN 85 AND 94 THEN k ELSE 0 END) AS device_id,
           concat('ip', e.customer_id * 7 + CASE WHEN k BETWEEN 85 AND 94 THEN k ELSE 0 END) AS ip_hash,
           CASE WHEN event_type = 'purchase' THEN 'success' ELSE 'failed' END AS result,
           value > 200 OR k >= 98 AS is_fraudulent
    FROM s_events e LEFT JOIN s_customers c ON e.customer_id = c.customer_id
    LEFT JOIN nation ON n_nationkey = CASE WHEN k >= 95 THEN (c.nk + k) % 25 ELSE c.nk END
    WHERE event_type IN ('purchase', 'error')""",
    "s_windows": """
    SELECT *,
           count(*) OVER (PARTITION BY customer_id ORDER BY attempt_ts
                          RANGE BETWEEN INTERVAL 10 MINUTE PRECEDING AND CURRENT ROW) AS attempts_10min,
           sum(CASE WHEN result = 'failed' THEN 1 ELSE 0 END)
               OVER (PARTITION BY customer_id ORDER BY attempt_ts
                     RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS failures_24h,
           lag(attempt_ts) OVER w AS prev_ts, lag(device_id) OVER w AS prev_device,
           lag(ip_hash) OVER w AS prev_ip,
           sum(CASE WHEN result = 'success' THEN 1 ELSE 0 END)
               OVER (PARTITION BY customer_id ORDER BY attempt_ts, payment_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ok_before
    FROM s_payments WINDOW w AS (PARTITION BY customer_id ORDER BY attempt_ts, payment_id)""",
    "s_flags": """
    SELECT *,
           amount > 100 AND coalesce(ok_before, 0) = 0 AS high_amount,
           coalesce(payment_country <> customer_country, FALSE) AS country_mismatch,
           attempts_10min > 5 AS velocity,
           coalesce(device_id <> prev_device AND ip_hash <> prev_ip
                    AND attempt_ts - prev_ts < INTERVAL 1 HOUR, FALSE) AS device_change,
           hour(attempt_ts) >= 3 AND hour(attempt_ts) < 6 AS time_anomaly,
           result = 'failed' AND failures_24h >= 3 AS many_failed_attempts,
           coalesce(attempt_ts - prev_ts < INTERVAL 10 MINUTE, FALSE) AS rapid_attempts
    FROM s_windows""",
    "s_scores": f"SELECT *, greatest({_SCORES}) AS score FROM s_flags",
    "s_alerts": f"""
    SELECT *, upper(concat('AL', substr(md5(concat(payment_id, ':', alert_type)), 1, 10))) AS alert_id,
           {case_map('alert_type', v.RISK_SCORES, v.DEFAULT_RISK_SCORE)} AS risk_score,
           {case_map('alert_type', v.SEVERITIES, v.DEFAULT_SEVERITY)} AS severity,
           CASE WHEN is_fraudulent THEN 'blocked' ELSE 'reviewed' END AS action_taken,
           CASE WHEN is_fraudulent THEN 'resolved' ELSE 'false_positive' END AS status
    FROM (SELECT payment_id, customer_id, customer_country, attempt_ts AS alert_date, amount,
                 is_fraudulent, unnest([{_FLAGS}]) AS alert_type FROM s_flags)
    WHERE alert_type IS NOT NULL""",
    "s_fired": f"""
    SELECT payment_id, customer_id,
           list_filter([{_SORTED}], lambda r: r IS NOT NULL) AS rules FROM s_flags""",
    "s_links": """
    SELECT p.payment_id,
           CASE WHEN o.order_id IS NOT NULL THEN o.order_id
                ELSE (SELECT min(n.order_id) FROM s_orders n
                      WHERE n.order_id BETWEEN p.payment_id - 4 AND p.payment_id + 4) END AS order_id,
           CASE WHEN o.order_id IS NOT NULL THEN 'exact' ELSE 'near' END AS link
    FROM s_payments p LEFT JOIN s_orders o ON o.order_id = p.payment_id""",
    "s_extracted": f"""
    SELECT customer_id, CASE WHEN customer_id % 19 <> 0 THEN concat('{{', CASE WHEN customer_id % 7 = 0 THEN '' ELSE concat(
            '"document": {{"type": "', CASE WHEN customer_id % 23 = 0 THEN 'library_card' WHEN customer_id % 2 = 0 THEN 'passport' ELSE 'national_id' END, '", "number": ',
            CASE WHEN customer_id % 11 = 0 THEN CAST(customer_id AS VARCHAR) ELSE printf('"ID%07d"', customer_id) END, ', "expiry": ',
            CASE WHEN customer_id % 3 = 0 THEN '"soon"' WHEN customer_id % 5 = 0 THEN 'null' ELSE '"2030-06-30"' END, '}}, ') END,
        '"person": {{"name": "', name, '", "birth": {{"date": "', strftime(birthdate, '%Y-%m-%d'), '"}}}}, "scores": [',
        CAST(CAST((customer_id % 100) / 100.0 AS DECIMAL(3, 2)) AS VARCHAR), ', 0.5], "adult": ',
        CASE WHEN customer_id % 13 = 0 THEN '"perhaps"' WHEN {age('birthdate', f"DATE '{AS_OF}'")} >= 18 THEN 'true' ELSE 'false' END,
        CASE WHEN customer_id % 17 = 0 THEN '' ELSE '}}' END) END AS extracted_data FROM s_customers""",
    "s_sessions": sessions("30 minutes"),
    "s_sessions6": sessions("6 hours"),
    "s_people": f"""
    SELECT customer_id AS customer_num, printf('C%05d', customer_id) AS customer_id, signup_ts, country,
           birthdate, {age('birthdate', f"DATE '{AS_OF}'")} AS age
    FROM s_customers""",
}
