import math
import random

import pytest
from pyspark.sql import functions as F

from etalage.operators import baskets, sketches
from tests.conftest import at


def drifted(spark, rows):
    """rows: (group, period, value); period 0 is the base."""
    df = spark.createDataFrame(rows, "g string, p int, v double")
    found = sketches.drift(sketches.value_sketches(df, "v", ["g", "p"]), ["g"], F.col("p") == 0)
    assert found.columns == ["g", "p", "n", "base_n", "ks", "psi"]
    return {(r.g, r.p): r for r in found.collect()}


def test_equal_halves_do_not_drift_and_a_shifted_half_does(spark):
    rows = [("a", p, float(v)) for v in range(1000) for p in (0, 1)] + [("a", 2, float(v + 300)) for v in range(1000)]
    got = drifted(spark, rows)
    assert got["a", 1].psi == pytest.approx(0, abs=1e-12) and got["a", 1].ks == 0
    assert got["a", 2].ks == pytest.approx(0.3, abs=0.01) and got["a", 2].psi > 0.5


def test_distance_and_index_by_hand_on_large_sketches(spark):
    """More values than a sketch holds: the distance is right to a hundredth."""
    draw = random.Random(1)
    base, now = [draw.gauss(0, 1) for _ in range(40_000)], [draw.gauss(0.5, 1.2) for _ in range(30_000)]
    got = drifted(spark, [("a", 0, v) for v in base] + [("a", 1, v) for v in now])["a", 1]
    both = sorted([(v, 1 / len(base)) for v in base] + [(v, -1 / len(now)) for v in now])
    gap, far = 0.0, 0.0
    for _, step in both:
        gap += step
        far = max(far, abs(gap))
    assert got.ks == pytest.approx(far, abs=0.015)
    ordered = sorted(base)
    edges = [-math.inf, *[ordered[4000 * i - 1] for i in range(1, 10)], math.inf]
    psi = 0.0
    for low, high in zip(edges, edges[1:], strict=False):
        p, q = (sum(low < v <= high for v in x) / len(x) for x in (base, now))
        psi += (q - p) * math.log(q / p)
    assert got.psi == pytest.approx(psi, abs=0.05)


def test_drift_of_nulls_ties_and_single_values(spark):
    rows = [("a", 0, None), ("a", 1, 1.0), ("b", 0, 5.0), ("b", 1, 5.0), ("b", 2, None), ("b", 3, 9.0), ("c", 1, 1.0), *[("d", p, 7.0) for p in (0, 1) for _ in range(50)]]
    got = drifted(spark, rows)
    assert set(got) == {("b", 1), ("b", 3), ("d", 1)}
    assert got["b", 1].ks == got["d", 1].ks == 0 and got["b", 3].ks == 1
    assert drifted(spark, []) == {}


AUDIENCE = "who long, ts timestamp_ntz, kind string"


def test_audiences_add_up_and_read_no_event(spark, tmp_path):
    draw = random.Random(2)
    rows = [(draw.randrange(300), at(draw.randrange(20 * 86400)), draw.choice("ab")) for _ in range(3000)]
    rows += [(None, at(0), "a"), (1, None, "a")]
    daily = sketches.daily_audience(spark.createDataFrame(rows, AUDIENCE), "who", "ts", ["kind"])
    daily.write.parquet(str(tmp_path / "gold"))
    gold = spark.read.parquet(str(tmp_path / "gold"))
    month = sketches.sizes(sketches.audience(gold, F.date_trunc("month", "day"), ["kind"]))
    want = {k: len({r[0] for r in rows if r[2] == k and r[0] is not None and r[1]}) for k in "ab"}
    assert {r.kind: r.customers for r in month.collect()} == want
    plan = month._jdf.queryExecution().toString()
    assert "gold" in plan and "ts#" not in plan


def test_returning_by_intersection(spark):
    weeks = [(1, 0), (2, 0), (3, 0), (1, 7), (2, 14), (1, 14), (4, 14)]
    rows = [(who, at(86400 * day), "a") for who, day in weeks]
    daily = sketches.daily_audience(spark.createDataFrame(rows, AUDIENCE), "who", "ts", ["kind"])
    weekly = sketches.audience(daily, F.to_date(F.date_trunc("week", "day")), ["kind"])
    got = sorted((r.period.day, r.weeks_later, r.customers, r.again) for r in sketches.returning(weekly, ["kind"], [1, 2]).collect())
    assert got == [(1, 1, 3, 1), (1, 2, 3, 2), (8, 1, 1, 1)]


def test_error_of_a_large_audience_is_within_its_bound(spark):
    """Five times as many customers as a sketch holds: three standard errors of 1 / sqrt(2 ** 14)."""
    n = 80_000
    events = spark.range(3 * n).select((F.col("id") % n).alias("who"), F.lit(at(0)).cast("timestamp_ntz").alias("ts"), F.lit("a").alias("kind"))
    daily = sketches.daily_audience(events, "who", "ts", ["kind"])
    got = sketches.sizes(daily).first().customers
    assert abs(got - n) < 3 * n / math.sqrt(2**14)


def pairs_by_hand(rows, least):
    sets = {}
    for basket, item in rows:
        if basket is not None and item is not None:
            sets.setdefault(basket, set()).add(item)
    single, both = {}, {}
    for items in sets.values():
        for a in items:
            single[a] = single.get(a, 0) + 1
            for b in items:
                if a < b:
                    both[a, b] = both.get((a, b), 0) + 1
    return sorted(
        (a, b, n, single[a], single[b], n / single[a], n / single[b], n * len(sets) / (single[a] * single[b]))
        for (a, b), n in both.items()
        if n >= least
    )


@pytest.mark.parametrize("least", [1, 2, 4, 9])
def test_pairs_by_hand(spark, least):
    draw = random.Random(least)
    rows = [(draw.randrange(40), draw.randrange(15)) for _ in range(300)]
    rows += [(99, i) for i in range(15)] + [(None, 1), (1, None), (500, 77)]
    found = baskets.frequent_pairs(spark.createDataFrame(rows, "o long, p long"), "o", F.col("p"), least)
    got, want = sorted(tuple(r) for r in found.collect()), pairs_by_hand(rows, least)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [x for r in got for x in r[5:]] == pytest.approx([x for r in want for x in r[5:]])


def test_no_frequent_pair(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2)], "o long, p long")
    assert baskets.frequent_pairs(rows, "o", F.col("p"), 1).count() == 0
    assert baskets.frequent_pairs(rows.where("false"), "o", F.col("p"), 1).count() == 0


def test_a_basket_longer_than_a_span_and_one_kind_of_basket_over_and_over(spark):
    """Pairs within and across spans; and baskets of 30 common items, which have a thousand million frequent sets but 435
    pairs."""
    draw = random.Random(8)
    rows = [(b, draw.randrange(40)) for b in range(4) for _ in range(60)] + [(9, i) for i in range(7)]
    df = spark.createDataFrame(rows, "o long, p long")
    for span in (1, 3, 7):
        found = baskets.frequent_pairs(df, "o", F.col("p"), 3, span=span)
        assert sorted(tuple(r)[:5] for r in found.collect()) == [r[:5] for r in pairs_by_hand(rows, 3)]
    same = spark.createDataFrame([(b, f"i{i:02}") for b in range(3) for i in range(30)], "o long, p string")
    assert {(r.baskets, r.lift) for r in baskets.frequent_pairs(same, "o", F.col("p"), 3).collect()} == {(3, 1.0)}
    assert baskets.frequent_pairs(same, "o", F.col("p"), 3).count() == 30 * 29 // 2
