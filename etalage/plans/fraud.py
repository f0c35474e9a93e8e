"""Queries over payment attempts: rules, alerts, scores, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from etalage.functions.values import RULES
from etalage.operators import fraud, marts
from etalage.operators.ordered import DAY
from etalage.plans.registry import query

_ROW = "payment_id:l customer_id:l attempt_ts:t amount:m"
_PICK = "SELECT payment_id, customer_id, attempt_ts, amount"


@query("rule_high_amount", _ROW, f"{_PICK} FROM s_flags WHERE high_amount")
def rule_high_amount(shop):
    return fraud.flag_high_amount(shop.attempts).where("high_amount")


@query(
    "rule_country_mismatch",
    f"{_ROW} payment_country:s customer_country:s",
    f"{_PICK}, payment_country, customer_country FROM s_flags WHERE country_mismatch",
)
def rule_country_mismatch(shop):
    return fraud.flag_stateless(shop.payments).where("country_mismatch")


@query("rule_time_anomaly", _ROW, f"{_PICK} FROM s_flags WHERE time_anomaly")
def rule_time_anomaly(shop):
    return shop.attempts.where(fraud.at_night())


@query(
    "rule_velocity",
    f"{_ROW} attempts:l",
    f"""
    SELECT * FROM ({_PICK}, count(*) OVER (PARTITION BY customer_id ORDER BY attempt_ts
        RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS attempts FROM s_payments) WHERE attempts > 5""",
)
def rule_velocity(shop):
    """More than five attempts in 24 hours: a wider form of the rule, as its ten minutes never hold six here."""
    return fraud.attempts_within(shop.attempts, DAY).where("attempts > 5")


@query("rule_velocity_10min", f"{_ROW} attempts_10min:l", f"{_PICK}, attempts_10min FROM s_flags WHERE velocity")
def rule_velocity_10min(shop):
    """The rule as stated: more than five attempts in ten minutes."""
    return fraud.flag_sequences(shop.attempts, only=["velocity"]).where("velocity")


@query(
    "rule_device_change",
    f"{_ROW} device_id:s prev_device:s ip_hash:s prev_ip:s",
    f"{_PICK}, device_id, prev_device, ip_hash, prev_ip FROM s_flags WHERE device_change",
)
def rule_device_change(shop):
    return fraud.flag_sequences(shop.attempts, only=["device_change"]).where("device_change")


@query(
    "rule_many_failed",
    f"{_ROW} failures_24h:l",
    f"{_PICK}, failures_24h FROM s_flags WHERE many_failed_attempts",
)
def rule_many_failed(shop):
    return fraud.flag_sequences(shop.attempts, only=["many_failed_attempts"]).where("many_failed_attempts")


@query("rule_rapid", f"{_ROW} prev_ts:t", f"{_PICK}, prev_ts FROM s_flags WHERE rapid_attempts")
def rule_rapid(shop):
    return fraud.flag_sequences(shop.attempts, only=["rapid_attempts"]).where("rapid_attempts")


@query(
    "cep_fail_then_success",
    "payment_id:l customer_id:l first_failure:t attempt_ts:t amount:m",
    """
    SELECT payment_id, customer_id, first_failure, attempt_ts, amount FROM (
        SELECT *, lag(result, 1) OVER w AS r1, lag(result, 2) OVER w AS r2, lag(result, 3) OVER w AS r3,
               lag(attempt_ts, 3) OVER w AS first_failure
        FROM s_payments WINDOW w AS (PARTITION BY customer_id ORDER BY attempt_ts, payment_id))
    WHERE result = 'success' AND r1 = 'failed' AND r2 = 'failed' AND r3 = 'failed'
      AND attempt_ts - first_failure <= INTERVAL 24 HOUR""",
)
def cep_fail_then_success(shop):
    return fraud.fail_then_success(shop.attempts)


@query(
    "fraud_alerts_build",
    "alert_id:s payment_id:l alert_date:t alert_type:s risk_score:f action_taken:s severity:s status:s",
    "SELECT * FROM s_alerts",
)
def fraud_alerts_build(shop):
    return shop.alerts


@query("fraud_score", "payment_id:l score:f", "SELECT payment_id, score FROM s_scores")
def fraud_score(shop):
    return fraud.score(shop.flagged)


_THRESHOLDS = [0.70, 0.75, 0.80, 0.85, 0.90]
_TESTS = [(r, r) for r in RULES] + [(f"score>={t:.2f}", f"score >= {t}") for t in _THRESHOLDS]


@query(
    "fraud_rule_metrics",
    "rule:s tp:l fp:l fn:l tn:l precision:f recall:f f1:f",
    "SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,"
    " CASE WHEN tp + fn = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,"
    " CASE WHEN tp + fp + fn = 0 THEN 0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1 FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (({c}) AND is_fraudulent) AS tp,"
        f" count(*) FILTER (({c}) AND NOT is_fraudulent) AS fp,"
        f" count(*) FILTER (NOT ({c}) AND is_fraudulent) AS fn,"
        f" count(*) FILTER (NOT ({c}) AND NOT is_fraudulent) AS tn FROM s_scores"
        for name, c in _TESTS
    )
    + ")",
)
def fraud_rule_metrics(shop):
    return fraud.rule_metrics(fraud.score(shop.flagged), _THRESHOLDS)


@query(
    "top_rules",
    "alert_type:s n:l frauds:l",
    """
    SELECT alert_type, count(*) AS n, count(*) FILTER (is_fraudulent) AS frauds FROM s_alerts GROUP BY alert_type""",
)
def top_rules(shop):
    return (
        shop.alerts.groupBy("alert_type")
        .agg(F.count("*").alias("n"), F.count_if("is_fraudulent").alias("frauds"))
        .orderBy(F.col("n").desc(), "alert_type")
    )


@query(
    "fraud_cost_avoided",
    "blocked:l saved:m missed:l lost:m",
    """
    SELECT count(*) FILTER (score > 0) AS blocked, sum(amount) FILTER (score > 0) AS saved,
           count(*) FILTER (score = 0) AS missed, sum(amount) FILTER (score = 0) AS lost
    FROM s_scores WHERE is_fraudulent""",
)
def fraud_cost_avoided(shop):
    """Labelled payments that a rule stops, and those none does."""
    bad = fraud.score(shop.flagged).where("is_fraudulent")
    hit = F.col("score") > 0
    return bad.agg(
        F.count_if(hit).alias("blocked"),
        F.sum(F.when(hit, F.col("amount"))).alias("saved"),
        F.count_if(~hit).alias("missed"),
        F.sum(F.when(~hit, F.col("amount"))).alias("lost"),
    )


@query(
    "fraud_by_country",
    "customer_country:s payments:l frauds:l fraud_amount:m fraud_rate:f",
    """
    SELECT customer_country, count(*) AS payments, count(*) FILTER (is_fraudulent) AS frauds,
           coalesce(sum(amount) FILTER (is_fraudulent), 0) AS fraud_amount,
           CAST(count(*) FILTER (is_fraudulent) AS DOUBLE) / count(*) AS fraud_rate
    FROM s_payments GROUP BY customer_country""",
)
def fraud_by_country(shop):
    """Added up per customer first; the country joins one row each."""
    bad = F.col("is_fraudulent")
    per_customer = shop.attempts.groupBy("customer_id").agg(
        F.count("*").alias("n"), F.count_if(bad).alias("bad"), F.sum(F.when(bad, F.col("amount")).otherwise(0)).alias("lost")
    )
    people = shop.customers.select("customer_id", F.col("country").alias("customer_country"))
    return (
        per_customer.join(people, "customer_id", "left")
        .groupBy("customer_country")
        .agg(
            F.sum("n").alias("payments"),
            F.sum("bad").alias("frauds"),
            F.sum("lost").alias("fraud_amount"),
            (F.sum("bad") / F.sum("n")).alias("fraud_rate"),
        )
    )


@query(
    "fraud_stats_daily",
    "day:d alert_type:s is_fraudulent:b alerts:l amount:m",
    """
    SELECT CAST(alert_date AS DATE) AS day, alert_type, is_fraudulent, count(*) AS alerts, sum(amount) AS amount
    FROM s_alerts GROUP BY 1, 2, 3""",
)
def fraud_stats_daily(shop):
    return fraud.daily_stats(shop.alerts)


@query(
    "fraud_patterns",
    "pattern:s customers:l",
    """
    SELECT pattern, count(*) AS customers FROM (
        SELECT customer_id, array_to_string(list_sort(list_distinct(flatten(list(rules)))), '+') AS pattern
        FROM s_fired GROUP BY customer_id) WHERE pattern <> '' GROUP BY pattern""",
)
def fraud_patterns(shop):
    return marts.fraud_patterns(shop.flagged, RULES)


def features(shop):
    """Model inputs per payment: the attempt itself, the rules, and the customer's history."""
    return shop.flagged.withColumn("hour", F.hour("attempt_ts"))


@query(
    "fraud_features",
    "payment_id:l amount:m hour:l country_mismatch:b device_change:b attempts_10min:l failures_24h:l"
    " past_attempts:l past_failures:l past_amount:m is_fraudulent:b",
    """
    SELECT payment_id, amount, hour(attempt_ts) AS hour, country_mismatch, device_change, attempts_10min,
           failures_24h, count(*) OVER w AS past_attempts,
           coalesce(sum(CASE WHEN result = 'failed' THEN 1 ELSE 0 END) OVER w, 0) AS past_failures,
           coalesce(sum(amount) OVER w, 0) AS past_amount, is_fraudulent
    FROM s_flags WINDOW w AS (PARTITION BY customer_id ORDER BY attempt_ts, payment_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def fraud_features(shop):
    return features(shop)
