from datetime import datetime

import pytest
from pyspark.sql import functions as F

from etalage.operators import fraud, reports
from tests.conftest import at, payment


def fired(df, rule):
    return sorted(r.payment_id for r in df.where(rule).collect())


def test_velocity_edge(payments):
    six_in_ten = [payment(i, 120 * i) for i in range(6)]
    a_second_more = [payment(10 + i, [0, 120, 240, 360, 480, 601][i], customer=2) for i in range(6)]
    flagged = fraud.flag_sequences(payments(six_in_ten + a_second_more))
    assert fired(flagged, "velocity") == [5]


def test_velocity_counts_rows_at_the_same_time(payments):
    flagged = fraud.flag_sequences(payments([payment(i, 0) for i in range(6)]))
    assert fired(flagged, "velocity") == [0, 1, 2, 3, 4, 5]


def test_device_change(payments):
    rows = [
        payment(1, 0, customer=1), payment(2, 59 * 60, customer=1, device="x", ip="y"),
        payment(3, 0, customer=2), payment(4, 60 * 60, customer=2, device="x", ip="y"),
        payment(5, 0, customer=3), payment(6, 60, customer=3, device="x"),
    ]
    assert fired(fraud.flag_sequences(payments(rows)), "device_change") == [2]


def test_night(payments):
    day = datetime(2024, 1, 1)
    times = [3 * 3600 - 1, 3 * 3600, 6 * 3600 - 1, 6 * 3600]
    rows = [payment(i, t, base=day) for i, t in enumerate(times)]
    assert fired(fraud.flag_stateless(payments(rows)), "time_anomaly") == [1, 2]


def test_country_null_is_no_mismatch(payments):
    rows = [payment(1, 0, home=None), payment(2, 0, paid=None), payment(3, 0, paid="DE"), payment(4, 0)]
    assert fired(fraud.flag_stateless(payments(rows)), "country_mismatch") == [3]


def test_high_amount_only_before_a_first_success(payments):
    rows = [
        payment(1, 0, amount=150.0, result="failed"),
        payment(2, 10, amount=150.0, result="success"),
        payment(3, 20, amount=150.0, result="success"),
        payment(4, 0, customer=2, amount=100.0, result="success"),
    ]
    assert fired(fraud.flag_high_amount(payments(rows)), "high_amount") == [1, 2]


def test_many_failed_and_rapid(payments):
    rows = [payment(1, 0), payment(2, 599), payment(3, 1199), payment(4, 86400 + 1200)]
    flagged = fraud.flag_sequences(payments(rows))
    assert fired(flagged, "many_failed_attempts") == [3]
    assert fired(flagged, "rapid_attempts") == [2]


def test_fail_then_success(payments):
    ok = [payment(i, i * 3600) for i in range(3)] + [payment(3, 24 * 3600, result="success")]
    late = [payment(10 + i, i * 3600, customer=2) for i in range(3)]
    late += [payment(13, 24 * 3600 + 1, customer=2, result="success")]
    broken = [payment(20, 0, customer=3), payment(21, 1, customer=3, result="success"),
              payment(22, 2, customer=3), payment(23, 3, customer=3), payment(24, 4, customer=3, result="success")]
    got = fraud.fail_then_success(payments(ok + late + broken)).collect()
    assert [(r.payment_id, r.first_failure) for r in got] == [(3, at(0))]


def test_alert_scores(spark):
    flags = {r: True for r in fraud.RULES}
    df = spark.range(1).select(
        F.lit(1).alias("payment_id"), F.lit(1).alias("customer_id"), F.lit("FR").alias("customer_country"),
        F.lit(at()).cast("timestamp_ntz").alias("attempt_ts"), F.lit(1.0).alias("amount"),
        F.lit(False).alias("is_fraudulent"), *[F.lit(v).alias(k) for k, v in flags.items()],
    )
    got = {r.alert_type: (r.risk_score, r.severity, r.action_taken) for r in fraud.build_alerts(df).collect()}
    assert got["high_amount"] == (0.85, "high", "reviewed")
    assert got["country_mismatch"] == (0.75, "medium", "reviewed")
    assert got["velocity"] == (0.90, "high", "reviewed")
    assert got["device_change"] == (0.70, "low", "reviewed")
    for other in ("many_failed_attempts", "rapid_attempts", "time_anomaly"):
        assert got[other] == (0.80, "medium", "reviewed")
    assert fraud.score(df).first().score == 0.90


def test_rule_metrics(payments):
    rows = [payment(1, 0, paid="DE", fraud=True), payment(2, 0, customer=2, paid="DE"),
            payment(3, 0, customer=3, fraud=True), payment(4, 0, customer=4)]
    m = {r.rule: r for r in fraud.rule_metrics(fraud.score(fraud.flag_all(payments(rows))), [0.7]).collect()}
    r = m["country_mismatch"]
    assert (r.tp, r.fp, r.fn, r.tn) == (1, 1, 1, 1)
    assert (r.precision, r.recall, r.f1) == (0.5, 0.5, 0.5)
    assert m["velocity"].precision == 0.0


def test_empty_input(payments):
    empty = payments([])
    assert reports.fraud_rate(empty).first().fraud_rate == 0.0
    assert fraud.flag_all(empty).count() == 0


@pytest.mark.parametrize("threshold,kept", [(0.7, 2), (70, 1)])
def test_score_scale(spark, threshold, kept):
    p = spark.createDataFrame(
        [(1, 1, 10.0, False), (2, 1, 90.0, False)],
        "payment_id long, order_id long, fraud_score double, is_fraudulent boolean",
    )
    orders = spark.createDataFrame([(1, 7)], "order_id long, customer_id long")
    people = spark.createDataFrame([(7, "e")], "customer_id long, email string")
    assert reports.suspicious_scored(p, orders, people, threshold).count() == kept
