"""The ordered operators against brute force, with one customer holding much of the rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from etalage.operators import marts, ordered
from tests.conftest import at

SCHEMA = "customer_id long, ts timestamp_ntz, id long, kind string, value long"


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    out = []
    for i in range(900):
        customer = 1 if i % 3 else rnd.randrange(2, 40)
        # Whole minutes, so that many rows share a time.
        ts = datetime(2024, 1, 1) + timedelta(minutes=rnd.randrange(0, 60 * 24 * 4))
        out.append((customer, ts, i, rnd.choice("ab"), rnd.randrange(100)))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def history(rows):
    by_customer = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        by_customer.setdefault(r[0], []).append(r)
    return by_customer


@pytest.mark.parametrize("pieces", [2, 16, 200])
def test_trailing_counts_and_previous(frame, rows, pieces):
    got = {
        r.id: (r.n, r.n_a, r.total, r.prev)
        for r in ordered.trailing(
            frame,
            "customer_id",
            "ts",
            counts={"n": (F.lit(True), 7200), "n_a": (F.col("kind") == "a", 86400)},
            totals={"total": F.col("value")},
            previous={"prev": "id"},
            order="id",
            pieces=pieces,
        ).collect()
    }
    assert len(got) == len(rows)
    for line in history(rows).values():
        for i, r in enumerate(line):
            near = [x for x in line if r[1] - timedelta(hours=2) <= x[1] <= r[1]]
            day = [x for x in line if r[1] - timedelta(days=1) <= x[1] <= r[1] and x[3] == "a"]
            total = sum(x[4] for x in line[:i])
            assert got[r[2]] == (len(near), len(day), total, line[i - 1][2] if i else None)


def test_trailing_keeps_rows_without_a_time(spark):
    df = spark.createDataFrame([(1, None, 1, "a", 5), (1, at(0), 2, "a", 5), (1, at(60), 3, "a", 5)], SCHEMA)
    out = ordered.trailing(
        df, "customer_id", "ts", counts={"n": (F.lit(True), 600)}, totals={"total": F.col("value")},
        previous={"prev": "id"}, order="id",
    )
    got = {r.id: (r.n, r.total, r.prev) for r in out.collect()}
    assert got == {1: (None, None, None), 2: (1, 0, None), 3: (2, 5, 2)}


def test_history(frame, rows):
    out = ordered.with_history(
        frame,
        "customer_id",
        "ts",
        "id",
        totals={"n": F.lit(1), "total": F.col("value")},
        latest={"last_a": (F.col("id"), F.col("kind") == "a")},
        pieces=50,
    )
    got = {r.id: (r.n, r.total, r.last_a) for r in out.collect()}
    for line in history(rows).values():
        for i, r in enumerate(line):
            last_a = [x[2] for x in line[:i] if x[3] == "a"]
            assert got[r[2]] == (i, sum(x[4] for x in line[:i]), last_a[-1] if last_a else None)


def test_rows_before(spark, frame, rows):
    out = ordered.with_rows_before(frame, "customer_id", "ts", "id", 3, pieces=200)
    from pyspark.sql import Window

    w = Window.partitionBy("customer_id", "_piece").orderBy("ts", "id")
    got = {r.id: r.back for r in out.withColumn("back", F.lag("id", 3).over(w)).where("_live").collect()}
    for line in history(rows).values():
        for i, r in enumerate(line):
            assert got[r[2]] == (line[i - 3][2] if i >= 3 else None)


@pytest.mark.parametrize("gap,pieces", [(1800, 100), (1800, 4), (6 * 3600, 100)])
def test_sessions(frame, rows, gap, pieces):
    out = ordered.sessionize(
        frame, "customer_id", "ts", gap, sums={"total": F.col("value")}, firsts={"first": F.col("id")},
        order="id", pieces=pieces,
    )
    got = sorted((r.customer_id, r.session_start, r.session_end, r.n_events, r.total, r.first) for r in out.collect())
    want = []
    for customer, line in history(rows).items():
        current = [line[0]]
        for r in line[1:]:
            if (r[1] - current[-1][1]).total_seconds() > gap:
                want.append(current)
                current = []
            current.append(r)
        want.append(current)
    want = sorted((s[0][0], s[0][1], s[-1][1], len(s), sum(x[4] for x in s), s[0][2]) for s in want)
    assert got == want


def test_session_edge(spark):
    """A gap of exactly 30 minutes goes on; one second more starts anew."""
    df = spark.createDataFrame([(1, at(0)), (1, at(1800)), (1, at(3601))], "customer_id long, ts timestamp_ntz")
    got = sorted(r.n_events for r in ordered.sessionize(df, "customer_id", "ts", 1800).collect())
    assert got == [1, 2]


def test_row_number_and_ntile(frame, rows):
    out = ordered.global_row_number(frame, [F.col("value").desc(), F.col("id")], "rn", partitions=7)
    got = [r.id for r in out.orderBy("rn").collect()]
    assert got == [r[2] for r in sorted(rows, key=lambda r: (-r[4], r[2]))]


@pytest.mark.parametrize("n", [1, 3, 5, 12, 13, 14])
def test_ntile_matches_builtin(spark, n):
    from pyspark.sql import Window

    df = spark.range(1, n + 1).withColumn("built", F.ntile(5).over(Window.orderBy("id")))
    got = df.select("built", ordered.ntile_of("id", F.lit(n), 5).alias("own")).collect()
    assert all(r.built == r.own for r in got)


def test_category_pairs(spark):
    """One order of every product and many small ones: the plain count's answer."""
    rnd = random.Random(5)
    kind = {p: f"c{p % 7}" for p in range(35)}
    lines = [(0, p) for p in range(35)] + [(1, p) for p in range(10, 35)]
    lines += [(o, rnd.randrange(35)) for o in range(2, 60) for _ in range(rnd.randrange(1, 5))]
    df = spark.createDataFrame(lines, "order_id long, product_id long")
    products = spark.createDataFrame(list(kind.items()), "product_id long, category string")
    baskets = {}
    for o, p in lines:
        baskets.setdefault(o, set()).add(kind[p])
    want = {}
    for b in baskets.values():
        for x in b:
            for y in b:
                if x < y:
                    want[x, y] = want.get((x, y), 0) + 1
    for least in (1, 15):
        got = {(r.a, r.b): r for r in marts.category_pairs(df, products, least).collect()}
        assert {k: r.orders for k, r in got.items()} == {k: n for k, n in want.items() if n >= least}
        for (a, b), r in got.items():
            na, nb = (sum(c in s for s in baskets.values()) for c in (a, b))
            assert r.lift == pytest.approx(want[a, b] * len(baskets) / (na * nb))


@pytest.mark.parametrize("hot", [True, False])
def test_little_is_carried_on(spark, hot):
    """A summary row for each piece at most, with one customer holding a third and with many small ones."""
    if hot:
        customer = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500)
    else:
        customer = F.col("id") % 100_000
    df = spark.range(200_000).select(customer.alias("customer_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), "id")
    rows = ordered.placed(df, "customer_id", F.col("ts"), pieces=40)
    cross = ordered.crossings(rows, "customer_id")
    assert cross.count() <= 40
    assert rows.groupBy("_piece").count().agg(F.max("count")).first()[0] < 20_000
    out = ordered.with_history(df, "customer_id", "ts", "id", totals={"n": F.lit(1)}, pieces=40)
    total = out.groupBy("customer_id").agg(F.max("n").alias("n"), F.count("*").alias("rows"))
    assert total.where("n <> rows - 1").count() == 0


def test_null_keys_are_a_key(spark):
    df = spark.createDataFrame([(None, at(60 * i), i, "a", 1) for i in range(50)], SCHEMA)
    out = ordered.with_history(df, "customer_id", "ts", "id", totals={"n": F.lit(1)}, pieces=5).collect()
    assert sorted((r.id, r.n) for r in out) == [(i, i) for i in range(50)]
