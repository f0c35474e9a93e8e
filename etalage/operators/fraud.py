"""Rule-based fraud detection over payment attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.functions.columns import mapped, micros, share
from etalage.functions.values import (
    DEFAULT_RISK_SCORE,
    DEFAULT_SEVERITY,
    RISK_SCORES,
    RULES,
    SEVERITIES,
)
from etalage.operators.ordered import DAY, trailing, with_rows_before

TEN_MINUTES = 600


def first_success(payments: DataFrame) -> DataFrame:
    """First successful payment of each customer, as (ts, id)."""
    return (
        payments.where("result = 'success'")
        .groupBy("customer_id")
        .agg(F.min(F.struct("attempt_ts", "payment_id")).alias("first_ok"))
    )


def flag_high_amount(payments: DataFrame, limit: float = 100) -> DataFrame:
    """Amount above the limit and no earlier successful payment by the customer."""
    at = F.struct("attempt_ts", "payment_id")
    first = F.coalesce(at <= F.col("first_ok"), F.lit(True))
    return (
        payments.join(first_success(payments), "customer_id", "left")
        .withColumn("high_amount", (F.col("amount") > limit) & first)
        .drop("first_ok")
    )


def flag_stateless(payments: DataFrame) -> DataFrame:
    """Rules that look at one attempt: country mismatch (false on null) and night hours [3, 6)."""
    return payments.withColumns(
        {
            "country_mismatch": F.coalesce(
                F.col("payment_country") != F.col("customer_country"), F.lit(False)
            ),
            "time_anomaly": at_night(),
        }
    )


def at_night(ts: str = "attempt_ts") -> Column:
    return (F.hour(ts) >= 3) & (F.hour(ts) < 6)


#: The rules that look back, in the order of the columns they add.
SEQUENCES = ("velocity", "many_failed_attempts", "rapid_attempts", "device_change")


def flag_sequences(
    payments: DataFrame, velocity_limit: int = 5, failed_limit: int = 3, only: list[str] | None = None
) -> DataFrame:
    """Rules that look back, and the customer's history: all from one pass over (customer, piece).

    Velocity, many failed, rapid attempts and device change; attempts, failures, successes and amount
    before. ``only`` names the rules wanted; the pass then does no more than they need, and the history
    is left out.
    """
    rules = set(only or SEQUENCES)
    counts = {
        "attempts_10min": ("velocity", F.lit(True), TEN_MINUTES),
        "failures_24h": ("many_failed_attempts", F.col("result") == "failed", DAY),
    }
    history = {
        "past_attempts": F.lit(1),
        "past_failures": (F.col("result") == "failed").cast("int"),
        "past_successes": (F.col("result") == "success").cast("int"),
        "past_amount": F.col("amount"),
    }
    row_before = {"prev_ts": "attempt_ts", "prev_device": "device_id", "prev_ip": "ip_hash"}
    swept = trailing(
        payments,
        "customer_id",
        "attempt_ts",
        counts={n: (cond, seconds) for n, (rule, cond, seconds) in counts.items() if rule in rules},
        totals=None if only else history,
        previous=row_before if rules & {"rapid_attempts", "device_change"} else None,
        order="payment_id",
    )
    gap = (micros("attempt_ts") - micros("prev_ts")) / F.lit(1_000_000)
    flags = {
        "velocity": F.col("attempts_10min") > velocity_limit,
        "many_failed_attempts": (F.col("result") == "failed") & (F.col("failures_24h") >= failed_limit),
        "rapid_attempts": F.coalesce(gap < TEN_MINUTES, F.lit(False)),
        "device_change": F.coalesce(
            (F.col("device_id") != F.col("prev_device")) & (F.col("ip_hash") != F.col("prev_ip")) & (gap < 3600),
            F.lit(False),
        ),
    }
    if rules & {"rapid_attempts", "device_change"}:
        swept = swept.withColumn("gap_s", gap)
    return swept.withColumns({r: flags[r] for r in SEQUENCES if r in rules})


def attempts_within(payments: DataFrame, seconds: int) -> DataFrame:
    """Attempts of the customer in the closed range [t - seconds, t]."""
    return trailing(
        payments, "customer_id", "attempt_ts", counts={"attempts": (F.lit(True), seconds)}
    )


def flag_first(swept: DataFrame, limit: float = 100) -> DataFrame:
    """The high-amount rule, from the history of ``flag_sequences``."""
    return swept.withColumn("high_amount", (F.col("amount") > limit) & (F.col("past_successes") == 0))


def flag_all(payments: DataFrame, velocity_limit: int = 5) -> DataFrame:
    return flag_first(flag_stateless(flag_sequences(payments, velocity_limit=velocity_limit)))


def build_alerts(flagged: DataFrame) -> DataFrame:
    """One row per fired rule, with the score and action of the rule."""
    fired = F.filter(
        F.array(*[F.when(F.col(r), F.lit(r)) for r in RULES]), lambda r: r.isNotNull()
    )
    alerts = flagged.select(
        "payment_id",
        "customer_id",
        "customer_country",
        "attempt_ts",
        "amount",
        "is_fraudulent",
        F.explode(fired).alias("alert_type"),
    )
    digest = F.md5(F.concat_ws(":", F.col("payment_id").cast("string"), F.col("alert_type")))
    return alerts.select(
        F.concat(F.lit("AL"), F.upper(F.substring(digest, 1, 10))).alias("alert_id"),
        "payment_id",
        "customer_id",
        "customer_country",
        F.col("attempt_ts").alias("alert_date"),
        "amount",
        "alert_type",
        mapped("alert_type", RISK_SCORES, DEFAULT_RISK_SCORE).alias("risk_score"),
        F.when(F.col("is_fraudulent"), "blocked").otherwise("reviewed").alias("action_taken"),
        mapped("alert_type", SEVERITIES, DEFAULT_SEVERITY).alias("severity"),
        F.when(F.col("is_fraudulent"), "resolved").otherwise("false_positive").alias("status"),
        "is_fraudulent",
    )


def daily_stats(alerts: DataFrame) -> DataFrame:
    """Alerts and amounts per day, rule and label."""
    return alerts.groupBy(F.to_date("alert_date").alias("day"), "alert_type", "is_fraudulent").agg(
        F.count("*").alias("alerts"), F.sum("amount").alias("amount")
    )


def fired_rules() -> Column:
    return F.filter(
        F.array(*[F.when(F.col(r), F.lit(r)) for r in sorted(RULES)]), lambda r: r.isNotNull()
    )


def score(flagged: DataFrame) -> DataFrame:
    """Highest score among the fired rules; 0 when none fired. Straight from the flags, no join."""
    best = F.greatest(
        *[
            F.when(F.col(r), F.lit(RISK_SCORES.get(r, DEFAULT_RISK_SCORE))).otherwise(F.lit(0.0))
            for r in RULES
        ]
    )
    return flagged.withColumn("score", best).withColumn("n_rules", F.size(fired_rules()).cast("bigint"))


def rule_metrics(scored: DataFrame, thresholds: list[float]) -> DataFrame:
    """Confusion counts, precision, recall and F1 per rule and per score threshold.

    All tests are counted in one aggregate row; that row is then turned into one row per test.
    """
    tests = {r: F.col(r) for r in RULES}
    tests |= {f"score>={t:.2f}": F.col("score") >= t for t in thresholds}
    return confusion(scored, "rule", tests, F.col("is_fraudulent"))


def confusion(
    df: DataFrame, name: str, tests: dict, bad: Column, by: list[str] | None = None
) -> DataFrame:
    counts = df.groupBy(*(by or [])).agg(
        F.count("*").alias("_n"),
        F.count_if(bad).alias("_bad"),
        *[F.count_if(hit).alias(f"_hit{i}") for i, hit in enumerate(tests.values())],
        *[F.count_if(hit & bad).alias(f"_tp{i}") for i, hit in enumerate(tests.values())],
    )
    entries = [
        F.struct(
            F.lit(test).alias(name),
            F.col(f"_tp{i}").alias("tp"),
            (F.col(f"_hit{i}") - F.col(f"_tp{i}")).alias("fp"),
            (F.col("_bad") - F.col(f"_tp{i}")).alias("fn"),
            (F.col("_n") - F.col("_bad") - F.col(f"_hit{i}") + F.col(f"_tp{i}")).alias("tn"),
        )
        for i, test in enumerate(tests)
    ]
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(*(by or []), F.inline(F.array(*entries))).withColumns(
        {
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1": share(2 * tp, 2 * tp + fp + fn),
        }
    )


def fail_then_success(payments: DataFrame, failures: int = 3, seconds: int = DAY) -> DataFrame:
    """Successes whose last ``failures`` attempts all failed, the first at most ``seconds`` before."""
    rows = with_rows_before(
        payments.select("payment_id", "customer_id", "attempt_ts", "amount", "result"),
        "customer_id",
        "attempt_ts",
        "payment_id",
        failures,
    )
    w = Window.partitionBy("customer_id", "_piece").orderBy("attempt_ts", "payment_id")
    all_failed = F.lit(True)
    for i in range(1, failures + 1):
        all_failed = all_failed & (F.lag("result", i).over(w) == "failed")
    return (
        rows.withColumn("all_failed", all_failed)
        .withColumn("first_failure", F.lag("attempt_ts", failures).over(w))
        .where("_live and result = 'success' and all_failed")
        .where(micros("attempt_ts") - micros("first_failure") <= seconds * 1_000_000)
        .select("payment_id", "customer_id", "first_failure", "attempt_ts", "amount")
    )
