import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from etalage.session import prepare  # noqa: E402

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1, 10, 0, 0)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    yield prepare(session)
    session.stop()


def at(seconds=0, base=T0):
    return base + timedelta(seconds=seconds)


PAYMENT = (
    "payment_id long, customer_id long, customer_country string, attempt_ts timestamp_ntz, amount double,"
    " payment_country string, device_id string, ip_hash string, result string, is_fraudulent boolean"
)


def payment(pid, seconds, customer=1, amount=10.0, result="failed", home="FR", paid="FR", device="d", ip="i",
            fraud=False, base=T0):
    return (pid, customer, home, at(seconds, base), amount, paid, device, ip, result, fraud)


@pytest.fixture
def payments(spark):
    return lambda rows: spark.createDataFrame(rows, PAYMENT)
