import hashlib
import datetime

import pytest
from pyspark.sql import functions as F

from etalage.operators import privacy, quality
from tests.conftest import at


def test_checks(spark):
    df = spark.createDataFrame([(1, "FR", 5.0), (1, "FRA", -1.0), (2, None, None)], "k long, c string, v double")
    row = lambda d: {r.check_name: (r.rows, r.failed) for r in d.collect()}
    assert row(quality.not_null(df, "t", ["k", "c"])) == {"t.k": (3, 0), "t.c": (3, 1)}
    assert row(quality.accepted_values(df, "t", {"c": ["FR"]})) == {"t.c": (3, 1)}
    assert row(quality.in_range(df, "t", {"v": F.col("v") >= 0})) == {"t.v": (3, 1)}
    assert row(quality.well_formed(df, "t", {"c": (2, "^[A-Z]+$")})) == {"t.c": (3, 1)}
    u = quality.unique(df, "t", ["k"]).first()
    assert (u.keys, u.repeated_keys, u.extra_rows) == (2, 1, 1)


def test_sources_compared_both_ways(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x long")
    b = spark.createDataFrame([(1,), (3,)], "x long")
    assert {r.side: r.n for r in quality.only_in_one(a, b).collect()} == {"left_only": 2, "right_only": 1}


def test_no_drift_between_equal_halves(spark):
    df = spark.createDataFrame(
        [(float(v), at(d)) for v in range(100) for d in (0, 86400)], "v double, ts timestamp_ntz"
    )
    psi = quality.drift_psi(df, "v", "ts", "2024-01-02", 25.0, 4).collect()
    assert [r.bucket for r in psi] == [0, 1, 2, 3]
    assert sum(r.psi for r in psi) == pytest.approx(0)


def test_documents(spark):
    d = datetime.date
    df = spark.createDataFrame(
        [
            ("ID1234567", d(2030, 1, 1), d(1990, 1, 1), 1, "a"),
            ("ID12345", d(2030, 1, 1), d(1990, 1, 1), 1, "b"),
            ("ID1234567", d(2020, 1, 1), d(1990, 1, 1), 1, "c"),
            ("ID1234567", d(2030, 1, 1), d(2015, 1, 1), 1, "d"),
        ],
        "doc_number string, expiry date, birthdate date, is_adult int, file string",
    )
    got = {r.file: (r.status, round(r.score, 2)) for r in privacy.verify_documents(df, "2024-01-31").collect()}
    assert got == {"a": ("verified", 1.0), "b": ("rejected", 0.67), "c": ("rejected", 0.67), "d": ("rejected", 0.67)}
    ages = {r.file: r.agrees for r in privacy.age_check(df, "2024-01-31").collect()}
    assert ages == {"a": True, "b": True, "c": True, "d": False}


def test_erase_leaves_no_orphan(spark):
    customers = spark.createDataFrame([(1,), (2,)], "customer_id long")
    orders = spark.createDataFrame([(10, 1), (20, 2)], "order_id long, customer_id long")
    items = spark.createDataFrame([(10, 5), (20, 5), (20, 6)], "order_id long, product_id long")
    kept = privacy.erase(
        {"customers": customers, "orders": orders, "items": items},
        customers.where("customer_id = 2"), "customer_id", {"items": ("orders", "order_id")},
    )
    assert [r.customer_id for r in kept["customers"].collect()] == [1]
    assert kept["items"].join(kept["orders"], "order_id", "left_anti").count() == 0
    assert kept["items"].count() == 1


def test_lineage_checksum_ignores_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "a long, b string")
    got = privacy.lineage({"in": a, "out": a.orderBy(F.desc("a")), "less": a.where("a = 1")}, ["a", "b"]).collect()
    sums = {r.stage: r.checksum for r in got}
    assert sums["in"] == sums["out"] != sums["less"]


def test_erasure_leaves_no_key_anywhere(spark, tmp_path):
    from etalage.__main__ import TABLES, erase_command

    def rows(schema, *data):
        return spark.createDataFrame(list(data), schema)

    tables = {
        "customers": rows("customer_id string, email string", ("C1", "a"), ("C2", "b")),
        "products": rows("product_id long", (1,)),
        "sessions": rows("session_id string, customer_id string", ("s", "C1"), ("t", "C2"), ("u", None)),
        "addresses": rows("address_id long, customer_id string", (1, "C1"), (2, "C2")),
        "orders": rows("order_id long, customer_id string", (1, "C1"), (2, "C2"), (3, "C1")),
        "order_items": rows("order_id long, product_id long", (1, 1), (2, 1), (3, 1)),
        "payments": rows("payment_id long, order_id long", (10, 1), (20, 2), (30, 3)),
        "fraud_alerts": rows("alert_id string, payment_id long", ("x", 10), ("y", 20)),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / "old" / name))
    (tmp_path / "ids.txt").write_text("C1\nC404\n")
    counts = erase_command(spark, str(tmp_path / "old"), str(tmp_path / "ids.txt"), str(tmp_path / "new")).collect()
    assert {r.table_name: (r.before, r.after) for r in counts} == {
        "customers": (2, 1), "products": (1, 1), "sessions": (3, 2), "addresses": (2, 1), "orders": (3, 1),
        "order_items": (3, 1), "payments": (3, 1), "fraud_alerts": (2, 1),
    }
    kept = {t: privacy.stored(spark, str(tmp_path / "new"), t) for t in TABLES}
    assert all(df.where("customer_id = 'C1'").isEmpty() for df in kept.values() if "customer_id" in df.columns)
    assert [r.payment_id for r in kept["payments"].collect()] == [20]


def test_only_files_with_an_erased_key_are_rewritten(spark, tmp_path):
    """The others keep their bytes, in the first erasure and in one of its outcome; one job tells, one writes."""
    def digests(folder):
        return {p: hashlib.sha256(p.read_bytes()).hexdigest() for p in (tmp_path / folder).rglob("*.parquet")}

    ids = spark.range(1000).withColumnRenamed("id", "customer_id")
    orders = ids.select((F.col("customer_id") * 10).alias("order_id"), "customer_id").unionByName(ids.selectExpr("customer_id * 10 + 1 as order_id", "null as customer_id"))
    orders.repartitionByRange(8, "order_id").write.parquet(str(tmp_path / "old/orders"))
    items = orders.select("order_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("product_id"))
    items.repartitionByRange(8, "order_id").write.parquet(str(tmp_path / "old/items"))
    before = digests("old")

    def erase(old, new, *customers):
        gone = spark.createDataFrame([(c,) for c in customers], "customer_id long")
        got = privacy.erase_files(spark, str(tmp_path / old), ["orders", "items"], gone, "customer_id", {"items": ("orders", "order_id")}, str(tmp_path / new))
        return {r.table_name: tuple(r)[1:] for r in got.collect()}

    assert erase("old", "new", 3, 4, 3, 5000) == {"orders": (2000, 1998, 8, 1), "items": (4000, 3996, 8, 1)}
    assert digests("old") == before
    listed = spark.read.parquet(str(tmp_path / "new/_files")).where("replaced").collect()
    assert sorted(r.table_name for r in listed) == ["items", "orders"]
    for name, n in (("orders", 1998), ("items", 3996)):
        left = privacy.stored(spark, str(tmp_path / "new"), name)
        assert left.count() == n and left.where("order_id in (30, 40)").isEmpty()
    after = digests("new")
    again = erase("new", "newer", 4, 999)
    assert (again["orders"][:2], again["orders"][3]) == ((1998, 1997), 1) and (again["items"][:2], again["items"][3]) == ((3996, 3994), 1)
    assert digests("old") == before and digests("new") == after
    assert privacy.stored(spark, str(tmp_path / "newer"), "items").where("order_id in (30, 40, 9990)").isEmpty()
    assert privacy.stored(spark, str(tmp_path / "newer"), "items").count() == 3994
    assert erase("old", "none", 5000) == {"orders": (2000, 2000, 8, 0), "items": (4000, 4000, 8, 0)}
