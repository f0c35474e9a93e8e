import pytest
from pyspark.sql import functions as F

from etalage.functions.columns import age_years, id_number, id_text, is_adult
from etalage.operators import curate, reports
from etalage.plans import catalog
from etalage.sources import files
from etalage.sources.load import full_load, register_views, validate
from tests.conftest import SF, at


def test_ids(spark):
    df = spark.createDataFrame([("O0000012",), ("O00X1",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(id_number("x", "O")).collect()] == [12, None, None, None]
    wide = spark.createDataFrame([(7,), (999,), (1234,)], "n long")
    assert [r[0] for r in wide.select(id_text("+", "n", 3)).collect()] == ["+007", "+999", "+1234"]


def test_rejects(spark):
    df = spark.createDataFrame([("O0000000", "P0001"), ("O00X1", "P0001"), ("O1", None)], "o string, p string")
    got = curate.split_rejects(df, {"order_id": ("o", "O"), "product_id": ("p", "P")}).collect()
    assert [r.reject for r in got] == [None, "o", "p"]
    assert got[0].order_id == 0


@pytest.mark.parametrize("as_of,age", [("2022-02-28", 17), ("2022-03-01", 18)])
def test_leap_birthday(spark, as_of, age):
    df = spark.createDataFrame([("2004-02-29",), (None,)], "d string").select(F.col("d").cast("date"))
    rows = df.select(age_years("d", as_of).alias("a"), is_adult("d", as_of).alias("ok")).collect()
    assert rows[0].a == age
    assert rows[1].ok is False


@pytest.mark.parametrize(
    "payment,orders,want",
    [(12, [8, 14], 8), (12, [12, 8], 12), (12, [7, 17], None), (0, [0], 0)],
)
def test_near_order(spark, payment, orders, want):
    p = spark.createDataFrame([(payment,)], "payment_id long")
    o = spark.createDataFrame([(x,) for x in orders], "order_id long")
    got = [r.order_id for r in curate.link_nearest(p, o).collect()]
    assert got == ([] if want is None else [want])


def test_anonymous_sessions(spark):
    raw = spark.createDataFrame(
        [("S1", "C1"), ("S2", None), ("S3", "C9")], "session_id string, customer_id string"
    ).select(
        "*", *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("start_ts", "end_ts")],
        *[F.lit("x").alias(c) for c in ("device", "ip_hash", "utm_source", "utm_campaign")],
    )
    people = spark.createDataFrame([("C1",)], "customer_id string")
    ids = lambda df: sorted(r.session_id for r in df.collect())
    assert ids(curate.sessions(raw, people)) == ["S1"]
    assert ids(curate.sessions(raw, people, keep_anonymous=True)) == ["S1", "S2"]


def test_upsert_stamps_only_changes(spark):
    schema = "k long, v string, updated_at timestamp_ntz"
    old = spark.createDataFrame([(1, "a", at()), (2, "b", at()), (3, "c", at())], schema)
    new = spark.createDataFrame([(2, "b"), (3, "x"), (4, "y")], "k long, v string")
    got = {r.k: (r.v, r.change, r.updated_at == at()) for r in
           curate.upsert(old, new, "k", ["v"], "2025-01-01 00:00:00").collect()}
    assert got == {1: ("a", "kept", True), 2: ("b", "kept", True), 3: ("x", "updated", False),
                   4: ("y", "inserted", False)}


def test_unsold_product_comes_first(spark):
    products = spark.createDataFrame([(1, "a", "c", 2.0), (2, "b", "c", 3.0)],
                                     "product_id long, name string, category string, price double")
    lines = spark.createDataFrame([(0, 2, 5)], "order_id long, product_id long, quantity long")
    got = reports.top_products(products, reports.sales_from_lines(lines, products)).collect()
    assert [(r.product_id, r.nb_sales, r.total_revenue) for r in got] == [(1, 0, None), (2, 1, 15)]


def test_orphans(spark):
    orders = spark.createDataFrame([(1, 1), (2, 9)], "order_id long, customer_id long")
    people = spark.createDataFrame([(1,)], "customer_id long")
    got = reports.orphan_counts({"o": (orders, people, "customer_id")}).collect()
    assert [(r.link, r.orphans) for r in got] == [("o", 1)]


def test_load_from_files(spark, tmp_path):
    """The documented file forms, with a bad id, an unknown customer and a payment without order."""
    text = {
        "customers.csv": "customer_id,signup_ts,country,preferred_device,birthdate,is_minor\n"
        "C00001,2025-11-26 08:10:15,BE,ios,1973-09-15,0\nC01234,2025-11-26 08:10:15,FR,ios,2010-09-15,1\n",
        "products.csv": "product_id,name,category,is_adult_restricted,unit_price,created_at\n"
        "P0001,Product 0001,Sports,0,16.69,2025-11-08 15:46:54\n",
        "sessions.csv": "session_id,customer_id,start_ts,end_ts,device,ip_hash,utm_source,utm_campaign\n"
        "S000001,C00001,2025-11-19 14:23:04,,ios,h,direct,none\n"
        "S000002,,2025-11-19 14:23:04,2025-11-19 14:39:04,ios,h,direct,none\n",
        "orders.csv": "order_id,customer_id,session_id,payment_id,order_ts,total_amount,currency,shipping_method,status\n"
        "O0000000,C00001,S000001,PAY0000001,2025-11-17 06:38:34,47.83,EUR,express,paid\n"
        "O0000009,C99999,S000001,PAY0000002,2025-11-17 06:38:34,47.83,EUR,express,paid\n",
        "order_items.csv": "order_id,product_id,qty\nO0000000,P0001,2\nO0000000,P0404,1\nO0000777,P0001,1\n",
        "payments.csv": "payment_id,customer_id,session_id,attempt_ts,method,card_bin,payment_country,ip_hash,"
        "device_id,amount,result,is_fraud_label\n"
        "PAY0000003,C00001,S000001,2025-11-11 09:51:23,card,492078,IT,h,dev,58.58,success,1\n"
        "PAY0000009,C00001,S000001,2025-11-11 09:51:23,paypal,,IT,h,dev,58.58,failed,0\n",
        "fraud_alerts.csv": "alert_id,alert_ts,payment_id,customer_id,session_id,amount,rule_triggered,is_fraud_label\n"
        "AL1,2025-11-11 09:51:23,PAY0000003,C00001,S000001,58.58,many_failed_attempts,1\n"
        "AL2,2025-11-11 09:51:23,PAY0000009,C00001,S000001,58.58,velocity,0\n",
    }
    for name, body in text.items():
        (tmp_path / name).write_text(body)
    out = str(tmp_path / "tables")
    for _ in range(2):  # a second load replaces, it does not add
        tables, counts = full_load(spark, str(tmp_path), out)
        t = {name: df.collect() for name, df in tables.items()}
    phones = {r.customer_id: r.phone for r in t["customers"]}
    assert phones == {"C00001": "+33612345001", "C01234": "+336123451234"}
    assert [str(r.created_at) for r in t["products"]] == ["2025-11-08 15:46:54"]
    assert [(r.session_id, r.end_ts) for r in t["sessions"]] == [("S000001", None)]
    assert [r.order_id for r in t["orders"]] == [0]
    assert [(r.product_id, r.quantity, float(r.subtotal)) for r in t["order_items"]] == [(1, 2, 33.38)]
    assert [(r.payment_id, r.order_id, r.card_bin_last4, r.is_fraudulent) for r in t["payments"]] == [(3, 0, "2078", True)]
    assert [(r.alert_id, r.risk_score, r.action_taken) for r in t["fraud_alerts"]] == [("AL1", 0.80, "blocked")]
    assert len(t["addresses"]) == 2
    assert {r.table_name: r[1:] for r in counts.collect()} == {
        "customers": (2, 2, 0, 0), "products": (1, 1, 0, 0), "sessions": (2, 1, 0, 1), "orders": (2, 1, 0, 1),
        "order_items": (3, 1, 0, 2), "payments": (2, 1, 0, 1), "fraud_alerts": (2, 1, 0, 1),
    }

    tables = {name: spark.read.parquet(f"{out}/{name}") for name in t}
    report = {r.check_name: (r.value, r.ok) for r in validate(tables).collect()}
    assert report["rows_customers"] == (2.0, True)
    assert report["orphans_orders_customers"] == (0.0, True)
    assert report["paid_revenue"][0] == 47.83
    assert report["fraud_rate"][0] == 100.0
    register_views(tables)
    assert spark.sql("SELECT nb_alerts, customer_country FROM suspicious_payments").first()[:] == (1, "BE")
    assert spark.sql("SELECT items_count, email FROM v_orders_details").first().items_count == 1
    assert spark.sql("SELECT fraud_score FROM v_suspicious_payments").first().fraud_score == 90.0
    assert spark.sql("SELECT total_quantity FROM top_products").first().total_quantity == 2
    assert spark.sql("SELECT nb_orders FROM daily_revenue").first().nb_orders == 1


def test_bad_json_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "events.jsonl").write_text(
        '{"event_id": "a", "ts": "2025-11-11T09:51:23", "event_type": "search", "customer_id": "C1"}\n{"event_id": \n'
    )
    rows = files.read_jsonl(spark, str(tmp_path / "events.jsonl")).collect()
    assert [r.event_id for r in rows if r[files.CORRUPT] is None] == ["a"]
    assert sum(r[files.CORRUPT] is not None for r in rows) == 1


def test_conversion_skips_absent_files(spark, tmp_path):
    (tmp_path / "products.csv").write_text(
        "product_id,name,category,is_adult_restricted,unit_price,created_at\nP0001,A,B,0,1.5,2025-11-08 15:46:54\n"
    )
    out = str(tmp_path / "out")
    assert files.convert_to_parquet(spark, str(tmp_path), out) == {"products": 0}
    assert spark.read.parquet(f"{out}/products").first().unit_price is not None


HEADER = "product_id,name,category,is_adult_restricted,unit_price,created_at"


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "products.csv").write_text(
        "category,extra,name,created_at,product_id,unit_price,is_adult_restricted\nB,x,A,2025-11-08 15:46:54,P0001,1.5,0\n"
    )
    row = files.read_input(spark, str(tmp_path), "products").first()
    assert (row.product_id, row.name, row.category, float(row.unit_price)) == ("P0001", "A", "B", 1.5)


def test_a_missing_column_is_an_error(spark, tmp_path):
    (tmp_path / "products.csv").write_text("product_id,name\nP0001,A\n")
    with pytest.raises(ValueError, match="category, is_adult_restricted, unit_price, created_at"):
        files.read_input(spark, str(tmp_path), "products")


def test_bad_cells_and_broken_lines_are_counted_and_kept_apart(spark, tmp_path):
    good = "P0001,A,B,0,1.5,2025-11-08 15:46:54"
    (tmp_path / "products.csv").write_text(f"{HEADER}\n{good}\nP0002,A,B,0,abc,2025-11-08 15:46:54\nP0003,A,B\n{good},1,2\nP0004,,B,0,,\n")
    (tmp_path / "events.jsonl").write_text('{"event_id": "a", "event_type": "view"}\n{"event_id": \n')
    checked = files.read_checked(spark, str(tmp_path), "products").collect()
    assert [r[files.BAD] for r in checked if r[files.CORRUPT] is None] == [[], ["unit_price"], []]
    out = str(tmp_path / "out")
    assert files.convert_to_parquet(spark, str(tmp_path), out) == {"products": 3, "events": 1}
    assert sorted(r.product_id for r in spark.read.parquet(f"{out}/products").collect()) == ["P0001", "P0004"]
    assert [r.event_id for r in spark.read.parquet(f"{out}/events").collect()] == ["a"]
    assert spark.read.parquet(f"{out}/events_rejects").first()[files.CORRUPT].startswith('{"event_id"')


def test_orphans_of_both_address_links(spark, tmp_path):
    """An order of nobody has neither an address it is sent to nor one it is billed to."""
    for table in ("nation", "customer", "part", "lineitem", "events"):
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    stray = orders.limit(1).withColumns({"o_custkey": F.lit(10**9), "o_orderkey": F.lit(10**9)}).select(orders.columns)
    orders.unionByName(stray).write.parquet(str(tmp_path / "orders.parquet"))
    got = {r.link: r.orphans for r in catalog.run("orphan_counts", spark, str(tmp_path)).collect()}
    assert len(got) == 11
    assert got["orders_customers"] == got["orders_shipping_address"] == got["orders_billing_address"] == 1
