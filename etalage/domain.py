"""The shop's tables, derived from the star-schema test tables by fixed formulas."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etalage.functions.columns import age_years, id_text, is_adult, money
from etalage.operators.fraud import build_alerts, flag_first, flag_sequences, flag_stateless
from etalage.operators.ordered import sessionize
from etalage.schemas import MONEY, STAR
from etalage.session import prepare, write_through

AS_OF = "2024-01-31"
UTM_SOURCES = ["direct", "ads_google", "ads_meta", "email"]
DEVICES = ["web_desktop", "web_mobile", "ios", "android"]
METHODS = ["card", "paypal", "bank_transfer"]


def _pick(values: list[str], i) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))


class Shop:
    """Views of the tables. Most are lazy; sessions and alerts place and write rows when first asked for."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = prepare(spark)
        self.path = path

    def table(self, name: str) -> DataFrame:
        # The schema is declared, so that no file is opened before the query runs.
        return self.spark.read.schema(STAR[name]).parquet(f"{self.path}/{name}.parquet")

    @cached_property
    def people(self) -> DataFrame:
        """Customers without the name of their country, for queries that do not show it."""
        born = F.date_add(
            F.lit("1950-01-01").cast("date"), (F.col("c_custkey") * 37 % 21900).cast("int")
        )
        signed_up = F.date_add(
            F.lit("1994-01-01").cast("date"), (F.col("c_custkey") * 11 % 360).cast("int")
        )
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("c_nationkey").alias("nk"),
            born.alias("birthdate"),
            signed_up.cast("timestamp_ntz").alias("signup_ts"),
            money("c_acctbal").alias("balance"),
            F.col("c_mktsegment").alias("segment"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        nations = self.table("nation").select(
            F.col("n_nationkey").alias("nk"), F.col("n_name").alias("country")
        )
        return self.people.join(nations, "nk")

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            money("p_retailprice").alias("price"),
            (F.col("p_type") == "PROMO").alias("is_adult_restricted"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        status = F.when(F.col("o_orderstatus") == "F", "paid").when(
            F.col("o_orderstatus") == "O", "pending"
        )
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            money("o_totalprice").alias("total_amount"),
            status.otherwise("cancelled").alias("status"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines as they arrive: no price."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.shape_events(self.table("events"))

    def shape_events(self, events: DataFrame) -> DataFrame:
        """Works on the table and on a stream of it."""
        k = F.get_json_object("props", "$.k").cast("int")
        return events.select(
            "event_id",
            "ts",
            F.col("user_id").alias("customer_id"),
            "event_type",
            money("value").alias("value"),
            k.alias("k"),
            _pick(UTM_SOURCES, k % 4).alias("utm_source"),
            _pick(DEVICES, F.floor(k / 10) % 4).alias("device"),
        )

    @cached_property
    def attempts(self) -> DataFrame:
        return self.shape_attempts(self.events)

    @cached_property
    def payments(self) -> DataFrame:
        """Attempts with the customer's and the payment's country."""
        return self.with_countries(self.attempts)

    def shape_attempts(self, events: DataFrame) -> DataFrame:
        """Payment attempts: purchases succeeded, errors failed."""
        k = F.col("k")
        other = F.when(k.between(85, 94), k).otherwise(0)
        device = (F.col("customer_id") * 7 + other).cast("string")
        return events.where(F.col("event_type").isin("purchase", "error")).select(
            F.col("event_id").alias("payment_id"),
            "customer_id",
            F.col("ts").alias("attempt_ts"),
            F.col("value").alias("amount"),
            _pick(METHODS, k % 3).alias("method"),
            F.concat(F.lit("dev"), device).alias("device_id"),
            F.concat(F.lit("ip"), device).alias("ip_hash"),
            F.when(F.col("event_type") == "purchase", "success").otherwise("failed").alias("result"),
            ((F.col("value") > 200) | (k >= 98)).alias("is_fraudulent"),
            "k",
        )

    def with_countries(self, attempts: DataFrame) -> DataFrame:
        """Every customer pays from home but for attempts with k of 95 and more."""
        people = self.customers.select(
            "customer_id", "nk", F.col("country").alias("customer_country")
        )
        nations = self.table("nation").select(
            F.col("n_nationkey").alias("pay_nk"), F.col("n_name").alias("payment_country")
        )
        k = F.col("k")
        pay_nk = F.when(k >= 95, (F.col("nk") + k) % 25).otherwise(F.col("nk"))
        return (
            attempts.join(people, "customer_id", "left")
            .withColumn("pay_nk", pay_nk)
            .join(nations, "pay_nk", "left")
            .drop("pay_nk", "nk", "k")
        )

    # Tables in the form of the input files (text ids, 0/1 flags).

    @cached_property
    def sessions(self) -> DataFrame:
        """Sessions of 30 minutes, with the device and source of their first event."""
        return sessionize(
            self.events,
            "customer_id",
            "ts",
            1800,
            firsts={"device": F.col("device"), "utm_source": F.col("utm_source")},
            order="event_id",
        )

    def raw(self, name: str) -> DataFrame:
        return getattr(self, f"_raw_{name}")

    @cached_property
    def _raw_customers(self) -> DataFrame:
        return self.customers.select(
            id_text("C", "customer_id", 5).alias("customer_id"),
            "signup_ts",
            "country",
            _pick(DEVICES, F.col("customer_id") % 4).alias("preferred_device"),
            "birthdate",
            (~is_adult("birthdate", AS_OF)).cast("int").alias("is_minor"),
        )

    @cached_property
    def _raw_products(self) -> DataFrame:
        created = F.date_add(
            F.lit("2023-01-01").cast("date"), (F.col("product_id") % 365).cast("int")
        )
        return self.products.select(
            id_text("P", "product_id", 4).alias("product_id"),
            id_text("Product ", "product_id", 4).alias("name"),
            "category",
            F.col("is_adult_restricted").cast("int").alias("is_adult_restricted"),
            F.col("price").cast(MONEY).alias("unit_price"),
            created.cast("timestamp_ntz").alias("created_at"),
        )

    @cached_property
    def _raw_sessions(self) -> DataFrame:
        c = id_text("C", "customer_id", 5)
        start = F.date_format("session_start", "yyyyMMddHHmmss")
        return self.sessions.select(
            F.concat(F.lit("S"), F.col("customer_id").cast("string"), F.lit("-"), start).alias(
                "session_id"
            ),
            c.alias("customer_id"),
            F.col("session_start").alias("start_ts"),
            F.when(F.col("n_events") > 1, F.col("session_end")).alias("end_ts"),
            "device",
            F.md5(c).alias("ip_hash"),
            "utm_source",
            F.when(F.col("utm_source") == "direct", "none").otherwise("spring").alias("utm_campaign"),
        )

    @cached_property
    def _raw_orders(self) -> DataFrame:
        return self.orders.select(
            id_text("O", "order_id", 7).alias("order_id"),
            id_text("C", "customer_id", 5).alias("customer_id"),
            F.lit(None).cast("string").alias("session_id"),
            id_text("PAY", "order_id", 7).alias("payment_id"),
            F.col("order_date").alias("order_ts"),
            F.col("total_amount").cast(MONEY).alias("total_amount"),
            F.lit("EUR").alias("currency"),
            F.lit("standard").alias("shipping_method"),
            "status",
        )

    @cached_property
    def _raw_order_items(self) -> DataFrame:
        return self.lines.select(
            id_text("O", "order_id", 7).alias("order_id"),
            id_text("P", "product_id", 4).alias("product_id"),
            F.col("quantity").cast("int").alias("qty"),
        )

    @cached_property
    def _raw_payments(self) -> DataFrame:
        number = (F.lit(400000) + F.col("customer_id") * 7919 % 100000).cast("string")
        return self.payments.select(
            id_text("PAY", "payment_id", 7).alias("payment_id"),
            id_text("C", "customer_id", 5).alias("customer_id"),
            F.lit(None).cast("string").alias("session_id"),
            "attempt_ts",
            "method",
            F.when(F.col("method") == "card", number).alias("card_bin"),
            "payment_country",
            "ip_hash",
            "device_id",
            F.col("amount").cast(MONEY).alias("amount"),
            "result",
            F.col("is_fraudulent").cast("int").alias("is_fraud_label"),
        )

    @cached_property
    def flagged(self) -> DataFrame:
        """All rules; the countries are joined on after the pass over the history."""
        swept = flag_sequences(self.attempts)
        return flag_first(flag_stateless(self.with_countries(swept)))

    @cached_property
    def alerts(self) -> DataFrame:
        # Written once: queries look at them from several sides.
        return write_through(build_alerts(self.flagged), "alerts")

    @cached_property
    def _raw_fraud_alerts(self) -> DataFrame:
        return self.alerts.select(
            "alert_id",
            F.col("alert_date").alias("alert_ts"),
            id_text("PAY", "payment_id", 7).alias("payment_id"),
            id_text("C", "customer_id", 5).alias("customer_id"),
            F.lit(None).cast("string").alias("session_id"),
            F.col("amount").cast(MONEY).alias("amount"),
            F.col("alert_type").alias("rule_triggered"),
            F.col("is_fraudulent").cast("int").alias("is_fraud_label"),
        )

    @cached_property
    def _raw_identity_labels(self) -> DataFrame:
        """One identity document per customer; some with a short number or past their expiry."""
        c = F.col("customer_id")
        number = F.when(c % 13 == 0, F.concat(F.lit("ID"), c.cast("string"))).otherwise(
            id_text("ID", c, 7)
        )
        expiry = F.when(c % 11 == 0, "2023-06-30").otherwise("2030-06-30").cast("date")
        return self.people.select(
            F.upper("name").alias("last_name"),
            F.upper("segment").alias("first_name"),
            F.when(c % 2 == 0, "F").otherwise("M").alias("sex"),
            "birthdate",
            number.alias("doc_number"),
            expiry.alias("expiry"),
            (age_years("birthdate", AS_OF) >= 17).cast("int").alias("is_adult"),
            F.concat(id_text("id_", c, 7), F.lit(".png")).alias("file"),
        )

    @cached_property
    def extracted(self) -> DataFrame:
        """What was read from the identity documents, as JSON text: some without a part, with values of another type,
        broken off, or not there."""
        c = F.col("customer_id")
        number = F.when(c % 11 == 0, c.cast("string")).otherwise(F.concat(F.lit('"'), id_text("ID", c, 7), F.lit('"')))
        expiry = F.when(c % 3 == 0, '"soon"').when(c % 5 == 0, "null").otherwise('"2030-06-30"')
        kind = F.when(c % 23 == 0, "library_card").when(c % 2 == 0, "passport").otherwise("national_id")
        document = F.concat(F.lit('"document": {"type": "'), kind, F.lit('", "number": '), number, F.lit(', "expiry": '), expiry, F.lit("}, "))
        born = F.date_format("birthdate", "yyyy-MM-dd")
        person = F.concat(F.lit('"person": {"name": "'), F.col("name"), F.lit('", "birth": {"date": "'), born, F.lit('"}}, '))
        score = (c % 100 / 100).cast("decimal(3,2)").cast("string")
        adult = F.when(c % 13 == 0, '"perhaps"').when(is_adult("birthdate", AS_OF), "true").otherwise("false")
        rest = F.concat(F.lit('"scores": ['), score, F.lit(', 0.5], "adult": '), adult)
        text = F.concat(F.lit("{"), F.when(c % 7 == 0, "").otherwise(document), person, rest, F.when(c % 17 == 0, "").otherwise("}"))
        return self.people.select("customer_id", F.when(c % 19 != 0, text).alias("extracted_data"))

    @cached_property
    def _raw_events(self) -> DataFrame:
        return self.events_as_input()

    def events_as_input(self, *keep: str) -> DataFrame:
        kind = F.col("event_type")
        pay = kind.isin("purchase", "error")
        return self.events.select(
            F.col("event_id").cast("string").alias("event_id"),
            "ts",
            "event_type",
            id_text("C", "customer_id", 5).alias("customer_id"),
            F.lit(None).cast("string").alias("session_id"),
            "device",
            F.md5(F.col("customer_id").cast("string")).alias("ip_hash"),
            "utm_source",
            F.lit("none").alias("utm_campaign"),
            F.when(kind == "view", id_text("P", F.col("k"), 4)).alias("product_id"),
            F.when(kind == "click", F.col("value").cast("double")).alias("cart_value"),
            F.when(pay, id_text("PAY", "event_id", 7)).alias("payment_id"),
            F.when(kind == "purchase", id_text("O", "event_id", 7)).alias("order_id"),
            *keep,
        )
