import os
from datetime import date

from pyspark.sql import functions as F

from etalage.domain import Shop
from etalage.operators import documents
from etalage.operators import reports as operators
from etalage.plans import catalog
from etalage.sources import gold
from tests.conftest import SF

ROW = "event_id long, kind string, day date"


def test_late_rows_change_their_own_day_only(spark, tmp_path):
    """Three runs: all days, one late row, nothing new. The folders of other days keep their files."""
    bronze, out, seen = (str(tmp_path / n) for n in ("bronze", "gold", "seen"))
    schema = spark.createDataFrame([], ROW).schema

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).write.mode("append").partitionBy("day").parquet(bronze)

    def refresh():
        return gold.refresh_days(spark, bronze, schema, out, lambda df: df.groupBy("day", "kind").agg(F.count("*").alias("n")), seen)

    def files():
        return {p.parent.name: (p.name, p.read_bytes()) for p in (tmp_path / "gold").rglob("*.parquet")}

    days = [date(2024, 1, d) for d in (1, 2, 3)]
    arrive(*[(i, "ab"[i % 2], days[i % 3]) for i in range(30)], (99, "a", None))
    assert refresh() == [["2024-01-01", "2024-01-02", "2024-01-03", "None"]]
    before = files()
    assert len(before) == 4
    arrive((100, "a", days[1]))
    assert refresh() == [["2024-01-02"]]
    after = files()
    assert {d for d in before if before[d] != after[d]} == {"day=2024-01-02"}
    assert refresh() == []
    assert files() == after
    full = spark.read.schema(schema).parquet(bronze).groupBy("day", "kind").agg(F.count("*").alias("n"))
    got = spark.read.parquet(out).select("day", "kind", "n")
    assert sorted(map(str, got.collect())) == sorted(map(str, full.collect()))


def test_bucketed_tables_join_where_they_lie(spark):
    """No row is shuffled by order, also where no side is small enough to be sent to all."""
    shop = Shop(spark, SF)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [
            catalog.run(name, spark, SF)._jdf.queryExecution().executedPlan().toString()
            for name in ("orders_details_bucketed", "suspicious_payments_bucketed")
        ]
        plain = operators.orders_details(shop.orders, shop.customers, shop.lines)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for plan in plans:
        assert "SortMergeJoin [order_id" in plan and "hashpartitioning(order_id" not in plan
    assert "hashpartitioning(order_id" in plain


def test_a_bucket_is_one_file(spark):
    table = gold.bucketed(spark.range(1000).withColumnRenamed("id", "order_id"), "numbers", "order_id", 4)
    names = [os.path.basename(f) for f in table.inputFiles()]
    assert len(names) == 4 and table.count() == 1000


def test_fields_that_are_missing_null_or_of_another_type(spark):
    rows = [
        (1, '{"a": {"b": 5}, "d": "2024-01-02", "ok": true, "l": [1.5, 2]}'),
        (2, '{"a": {"b": "five"}, "d": "soon", "ok": "perhaps", "l": []}'),
        (3, '{"a": 7, "d": null, "l": "none"}'),
        (4, '{"a": {"b": null}}'),
        (5, "[1, 2]"),
        (6, '{"a": {"b": 5}'),
        (7, "  "),
        (8, None),
        (9, '"text"'),
        (10, '{"a": {"b": 99999999999}}'),
    ]
    df = spark.createDataFrame(rows, "id long, j string")
    wanted = {"b": ("$.a.b", "int"), "d": ("$.d", "date"), "ok": ("$.ok", "boolean"), "first": ("$.l[0]", "double")}
    read = documents.read_variant(df, "j")
    got = {r.id: (r.status, r.b, r.d, r.ok, r.first) for r in documents.fields(read, "j", wanted).select("id", "status", *wanted).collect()}
    nothing = (None, None, None, None)
    assert got == {
        1: ("ok", 5, date(2024, 1, 2), True, 1.5),
        2: ("ok", *nothing),
        3: ("ok", *nothing),
        4: ("ok", *nothing),
        5: ("ok", *nothing),
        6: ("unreadable", *nothing),
        7: ("missing", *nothing),
        8: ("missing", *nothing),
        9: ("ok", *nothing),
        10: ("ok", *nothing),
    }
    kinds = {(r.key, r.kind): r.n for r in documents.shape(read, "j").collect()}
    assert kinds["a", "object"] == 4 and kinds["a", "number"] == 1 and kinds["l", "array"] == 2 and kinds["l", "string"] == 1
    whole = documents.schema_of(read.where("id in (1, 4)"), "j").first().schema
    assert whole.startswith("OBJECT<a: OBJECT<b: BIGINT>") and "ok: BOOLEAN" in whole
    assert documents.shape(read.where("false"), "j").count() == 0
