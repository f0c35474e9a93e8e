"""Declared schemas of the shop's input files and curated tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(10, 2)
TOTAL = DecimalType(18, 2)
_TYPES = {
    "s": StringType(),
    "i": IntegerType(),
    "l": LongType(),
    "d": DateType(),
    "t": TimestampNTZType(),
    "m": MONEY,
    "f": DoubleType(),
    "b": BooleanType(),
}


def _schema(text: str) -> StructType:
    return StructType(
        [StructField(n, _TYPES[t]) for n, t in (part.split(":") for part in text.split())]
    )


# Input files, one entry per file of the data set.
FILES = {
    "customers": _schema(
        "customer_id:s signup_ts:t country:s preferred_device:s birthdate:d is_minor:i"
    ),
    "products": _schema(
        "product_id:s name:s category:s is_adult_restricted:i unit_price:m created_at:t"
    ),
    "sessions": _schema(
        "session_id:s customer_id:s start_ts:t end_ts:t device:s ip_hash:s utm_source:s utm_campaign:s"
    ),
    "orders": _schema(
        "order_id:s customer_id:s session_id:s payment_id:s order_ts:t total_amount:m"
        " currency:s shipping_method:s status:s"
    ),
    "order_items": _schema("order_id:s product_id:s qty:i"),
    "payments": _schema(
        "payment_id:s customer_id:s session_id:s attempt_ts:t method:s card_bin:s"
        " payment_country:s ip_hash:s device_id:s amount:m result:s is_fraud_label:i"
    ),
    "fraud_alerts": _schema(
        "alert_id:s alert_ts:t payment_id:s customer_id:s session_id:s amount:m"
        " rule_triggered:s is_fraud_label:i"
    ),
    "identity_labels": _schema(
        "last_name:s first_name:s sex:s birthdate:d doc_number:s expiry:d is_adult:i file:s"
    ),
    "events": _schema(
        "event_id:s ts:t event_type:s customer_id:s session_id:s device:s ip_hash:s utm_source:s"
        " utm_campaign:s product_id:s cart_value:f payment_id:s order_id:s"
    ),
}

# File name of each input; events are JSON lines, the rest CSV with a header.
FILE_NAMES = {
    "customers": "customers.csv",
    "products": "products.csv",
    "sessions": "sessions.csv",
    "orders": "orders.csv",
    "order_items": "order_items.csv",
    "payments": "payments.csv",
    "fraud_alerts": "fraud_alerts.csv",
    "identity_labels": "synthetic_id_labels.csv",
    "events": "events.jsonl",
}

# The star-schema tables the shop is derived from.
STAR = {
    "region": _schema("r_regionkey:i r_name:s"),
    "nation": _schema("n_nationkey:i n_name:s n_regionkey:i"),
    "customer": _schema("c_custkey:l c_name:s c_nationkey:i c_acctbal:f c_mktsegment:s"),
    "supplier": _schema("s_suppkey:l s_name:s s_nationkey:i s_acctbal:f"),
    "part": _schema("p_partkey:l p_name:s p_brand:s p_type:s p_size:i p_retailprice:f"),
    "orders": _schema(
        "o_orderkey:l o_custkey:l o_orderstatus:s o_totalprice:f o_orderdate:t o_orderpriority:s"
    ),
    "lineitem": _schema(
        "l_orderkey:l l_partkey:l l_suppkey:l l_linenumber:i l_quantity:f l_extendedprice:f l_discount:f"
        " l_tax:f l_returnflag:s l_linestatus:s l_shipdate:t"
    ),
    "events": _schema("event_id:l ts:t user_id:l event_type:s value:f props:s"),
}
