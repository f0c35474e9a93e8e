"""Model queries; their results depend on the trainer, so they have no SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from etalage.operators import ml
from etalage.plans.fraud import features
from etalage.plans.registry import query


@query(
    "fraud_model",
    "part:s threshold:f tp:l fp:l fn:l tn:l precision:f recall:f f1:f",
)
def fraud_model(shop):
    _, scored = ml.fit_fraud_model(features(shop))
    return ml.threshold_metrics(scored, [0.1 * i for i in range(1, 10)])


@query("als_recommend", "customer_id:l rank:l product_id:l prediction:f")
def als_recommend(shop):
    bought = (
        shop.lines.join(shop.orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id", "product_id")
        .agg(F.count("*").alias("times"))
    )
    return ml.recommend(bought, shop.products)
