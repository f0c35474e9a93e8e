"""The full load: input files -> curated tables, in order of dependence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etalage.operators import curate, quality, reports
from etalage.operators.ordered import global_row_number
from etalage.session import together, write_through
from etalage.sources.files import good_rows, is_good, read_checked, refresh


def full_load(spark: SparkSession, folder: str, out: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Replace every curated table from the files of ``folder``.

    Returns the tables by name, and for each input file how many rows were read and accepted, were
    unreadable, or were left out because what they refer to is not there.
    """
    done: dict[str, DataFrame] = {}
    tallies = {}

    def load(name: str, build) -> DataFrame:
        # Each file is parsed once, whatever looks at its rows: the builds, some more than once, and the counts.
        checked = write_through(read_checked(spark, folder, name), f"checked-{name}")
        done[name] = refresh(build(good_rows(checked)), out, name)

        def tally() -> tuple:
            row = checked.agg(F.count("*").alias("read"), F.count_if(~is_good()).alias("unreadable")).first()
            accepted = done[name].count()
            return name, row["read"], accepted, row["unreadable"], row["read"] - row["unreadable"] - accepted

        tallies[name] = tally
        return done[name]

    customers = load("customers", curate.customers)
    products = load("products", curate.products)
    load("sessions", lambda rows: curate.sessions(rows, customers))
    numbered = global_row_number(curate.addresses(customers), [F.col("customer_id")], "address_id")
    addresses = done["addresses"] = refresh(numbered, out, "addresses")
    orders = load("orders", lambda rows: curate.orders(rows, customers, curate.latest_address(addresses)))
    load("order_items", lambda rows: curate.order_items(rows, orders, products))
    payments = load("payments", lambda rows: curate.payments(rows, orders))
    load("fraud_alerts", lambda rows: curate.alerts(rows, payments))
    counts = list(together(tallies).values())
    return done, spark.createDataFrame(counts, "table_name string, read long, accepted long, unreadable long, unlinked long")


def register_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Make the tables and the report views known to SQL by name."""
    sales = reports.sales_by_product(tables["order_items"])
    views = {
        "daily_revenue": reports.daily_revenue(tables["orders"]),
        "top_products": reports.top_products(tables["products"], sales),
        "suspicious_payments": reports.suspicious_payments(
            tables["payments"], tables["orders"], tables["customers"], tables["fraud_alerts"]
        ).select(
            "payment_id",
            "payment_date",
            "amount",
            "payment_method",
            "is_fraudulent",
            "customer_id",
            "customer_country",
            "nb_alerts",
        ),
        "v_orders_details": reports.orders_details(
            tables["orders"].select("order_id", "order_date", "status", "total_amount", "customer_id"),
            tables["customers"].select("customer_id", "email", "first_name", "last_name"),
            tables["order_items"],
        ),
        "v_suspicious_payments": reports.suspicious_scored(
            tables["payments"].select(
                "payment_id",
                "order_id",
                "amount",
                F.col("payment_status").alias("status"),
                curate.fraud_score(F.col("is_fraudulent")).alias("fraud_score"),
                "is_fraudulent",
            ),
            tables["orders"],
            tables["customers"],
        ),
    }
    for name, df in {**tables, **views}.items():
        df.createOrReplaceTempView(name)
    return views


def validate(tables: dict[str, DataFrame]) -> DataFrame:
    """The report after a load: row counts, orphans, business totals."""
    links = {
        "orders_customers": (tables["orders"], tables["customers"], "customer_id"),
        "order_items_products": (tables["order_items"], tables["products"], "product_id"),
        "payments_orders": (tables["payments"], tables["orders"], "order_id"),
    }
    return quality.validation_report(
        tables,
        links,
        tables["orders"],
        tables["order_items"],
        reports.sales_by_product(tables["order_items"]),
        tables["payments"],
    )
