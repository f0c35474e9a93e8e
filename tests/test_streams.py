import random
import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from etalage.functions.values import RULES
from etalage.operators import fraud
from etalage.plans import catalog
from etalage.plans.streams import ROCKSDB
from etalage.session import fresh_dir, settings
from etalage.sources import streams
from etalage.streaming import in_order, jobs, stateful
from tests.conftest import SF, at

EVENT = "event_id long, ts timestamp_ntz, customer_id long, event_type string"


def arrivals(spark, batches):
    return [spark.createDataFrame([(i, at(60 * m), 1, "view") for i, m in batch], EVENT) for batch in batches]


def test_late_rows_are_dropped(spark):
    """A row behind the watermark is lost; one still ahead of it counts, though out of order."""
    minutes = [[0, 2], [40], [41], [1, 42, 30]]
    batches = [[(10 * i + j, m) for j, m in enumerate(b)] for i, b in enumerate(minutes)]
    out, progress = streams.replay(
        spark, arrivals(spark, batches), lambda s: jobs.tumbling_counts(s), "late-test"
    )
    got = {r.window_start: r.n for r in out.collect()}
    assert got[at(0)] == 2
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress if p["stateOperators"])
    assert dropped == 1


def test_duplicates_count_once(spark):
    out, _ = streams.replay(
        spark, arrivals(spark, [[(1, 0), (2, 1)], [(2, 1), (3, 2)]]), jobs.unique_events, "dedup-test"
    )
    assert sorted(r.event_id for r in out.collect()) == [1, 2, 3]


ATTEMPT = (
    "payment_id long, customer_id long, ts timestamp_ntz, amount double, result string, device_id string, ip_hash string,"
    " payment_country string, customer_country string"
)
LATER = at(30 * 86400)


def attempt(pid, seconds, customer=1, amount=10.0, result="failed", device="d", ip="i", paid="FR", home="FR"):
    return (pid, customer, at(seconds), amount, result, device, ip, paid, home)


def alerts_of(spark, arrivals, name, **options):
    """Alerts after the arrivals and one last attempt, long after, that moves the watermark past all others."""
    arrivals = [*arrivals, [(999_999, 777, LATER, 1.0, "failed", "d", "i", "FR", "FR")]]
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB, spark__sql__shuffle__partitions="4"):
        out, _ = streams.replay(
            spark, [spark.createDataFrame(a, ATTEMPT) for a in arrivals], lambda s: stateful.attempt_alerts(s, **options), name
        )
    return sorted((r.payment_id, r.rule) for r in out.collect())


def test_late_attempts_raise_no_false_alerts(spark):
    """Half an hour apart, the earlier one arriving second: nothing. Five minutes apart: the later one is rapid."""
    assert alerts_of(spark, [[attempt(2, 1800)], [attempt(1, 0)]], "late-none", delay="2 hours") == []
    assert alerts_of(spark, [[attempt(2, 300)], [attempt(1, 0)]], "late-pair", delay="2 hours") == [(2, "rapid_attempts")]


def test_attempts_of_the_open_day_are_judged_up_to_the_watermark(spark):
    """Pairs five minutes apart, over one day: only the last, within the delay of ten minutes, is open at the end."""
    rows = [attempt(2 * i + j, 3600 * i + 300 * j) for i in range(12) for j in (0, 1)]
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB, spark__sql__shuffle__partitions="4"):
        for cut in (24, 13):
            arrivals = [spark.createDataFrame(a, ATTEMPT) for a in (rows[:cut], rows[cut:]) if a]
            out, _ = streams.replay(spark, arrivals, stateful.attempt_alerts, f"open-day-{cut}")
            got = sorted(r.payment_id for r in out.where("rule = 'rapid_attempts'").collect())
            assert got == [2 * i + 1 for i in range(11)]


def some_attempts():
    rnd = random.Random(11)
    out = []
    for i in range(220):
        # Half of them one customer's; times over two days, some equal, and the edges of slices among them.
        seconds = rnd.choice([rnd.randrange(2 * 86400), rnd.randrange(86400) // 900 * 900, 8 * 3600 + rnd.randrange(-900, 900)])
        out.append(attempt(i, seconds, customer=1 if rnd.random() < 0.5 else rnd.randrange(2, 8), amount=rnd.choice([50.0, 150.0]),
                           result=rnd.choice(["failed", "failed", "success"]), device=rnd.choice("ab"), ip=rnd.choice("xy"),
                           paid=rnd.choice(["FR", "BE", None])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_gives_the_batch_rules_for_any_order_of_arrival(spark, seed):
    rows = some_attempts()
    batch = spark.createDataFrame(rows, ATTEMPT).withColumnsRenamed({"ts": "attempt_ts"})
    batch = batch.withColumn("is_fraudulent", F.lit(False))
    flagged = fraud.flag_all(batch)
    rules = F.filter(F.array(*[F.when(F.col(r), F.lit(r)) for r in RULES]), lambda r: r.isNotNull())
    want = [(r.payment_id, r.rule) for r in flagged.select("payment_id", F.explode(rules).alias("rule")).collect()]
    want += [(r.payment_id, "fail_then_success") for r in fraud.fail_then_success(batch).collect()]
    known = list(rows)
    random.Random(seed).shuffle(known)
    cut = random.Random(seed).randrange(40, 180)
    assert alerts_of(spark, [known[:cut], known[cut:]], f"any-order-{seed}", delay="3 days") == sorted(want)


def rules_by_batch(spark, rows):
    """(payment, rule) of the batch rules over all rows."""
    batch = spark.createDataFrame(rows, ATTEMPT).withColumnsRenamed({"ts": "attempt_ts"})
    batch = batch.withColumn("is_fraudulent", F.lit(False))
    rules = F.filter(F.array(*[F.when(F.col(r), F.lit(r)) for r in RULES]), lambda r: r.isNotNull())
    flagged = fraud.flag_all(batch).select("payment_id", F.explode(rules).alias("rule")).collect()
    return sorted([(r.payment_id, r.rule) for r in flagged] + [(r.payment_id, "fail_then_success") for r in fraud.fail_then_success(batch).collect()])


def test_a_new_customer_s_second_large_payment_raises_nothing(spark):
    """The first success comes on the stream; after it no amount is high, in the same batch or a later one."""
    large = [attempt(i, 7200 * i, amount=500.0, result="success") for i in range(4)]
    tried = [attempt(10, 0, customer=2, amount=500.0), attempt(11, 40_000, customer=2, amount=500.0, result="success"), attempt(12, 90_000, customer=2, amount=500.0)]
    got = alerts_of(spark, [[large[0], large[1], *tried[:2]], [large[2]], [large[3], tried[2]]], "new-customer")
    assert [p for p, rule in got if rule == "high_amount"] == [0, 10, 11]


@pytest.mark.parametrize("seed", [3, 4])
def test_seeded_state_stands_for_the_past(spark, seed):
    """A table of the past, taken in once, and the stream after it give what the batch rules give for both."""
    rows = sorted(some_attempts(), key=lambda r: (r[2], r[0]))
    cut = random.Random(seed).randrange(60, 160)
    while rows[cut][2] == rows[cut - 1][2]:
        cut += 1
    past, live = rows[:cut], rows[cut:]
    random.Random(seed).shuffle(live)
    seeded = stateful.past_of(spark.createDataFrame(past, ATTEMPT))
    assert max(r.n for r in seeded.select(F.size("last").alias("n")).collect()) <= stateful.ROWS_BACK + stateful.FAILURES_BACK
    ids = {r[0] for r in live}
    want = [x for x in rules_by_batch(spark, rows) if x[0] in ids]
    assert alerts_of(spark, [live[:30], live[30:]], f"seeded-{seed}", delay="3 days", past=seeded) == want
    assert want != [x for x in rules_by_batch(spark, live)]


def test_the_query_judges_the_attempts_of_the_past_too(spark, tmp_path):
    """Rapid pairs long before the seeded day, over its last ten minutes, and on the stream; the last pair is open."""
    for table in ("customer", "nation"):
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    starts = [datetime(2024, 1, 3, 12), datetime(2024, 1, 9, 23, 53), datetime(2024, 1, 9, 23, 58), datetime(2024, 1, 20, 12), datetime(2024, 1, 30, 12)]
    rows = [(2 * i + j, at(240 * j, t), 5 + i, "error", 1.0, '{"k": 1}') for i, t in enumerate(starts) for j in (0, 1)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    with settings(spark, spark__sql__shuffle__partitions="2"):
        got = catalog.run("stream_rules_stateful", spark, str(tmp_path)).collect()
    assert sorted(r.payment_id for r in got if r.rule == "rapid_attempts") == [1, 3, 5, 7]


def test_a_busy_customer_is_judged_part_by_part(spark, monkeypatch):
    """Parts of a few rows that overlap in time, judged in several steps, give the batch rules."""
    monkeypatch.setattr(in_order, "PART_ROWS", 3)
    monkeypatch.setattr(in_order, "ORDERED_ROWS", 10)
    rows = some_attempts()
    known = list(rows)
    random.Random(7).shuffle(known)
    assert alerts_of(spark, [known[:120], known[120:]], "parts", delay="3 days") == rules_by_batch(spark, rows)


def test_context_is_dropped_a_day_after_the_last_attempt(spark):
    """A success after three failures, then a day and more of others' attempts: only the first success is left."""
    rows = [attempt(i, 60 * i, amount=150.0, result="success" if i == 3 else "failed") for i in range(4)]
    others = [[attempt(100 + i, 40_000 * (i + 1), customer=2, ip=str(i))] for i in range(6)]
    again = [attempt(50, 400_000, amount=500.0), attempt(51, 400_060, amount=500.0)]
    folder = {}

    def build(s):
        folder["state"] = stateful.attempt_alerts(s)
        return folder["state"]

    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB, spark__sql__shuffle__partitions="2"):
        out, progress = streams.replay(
            spark, [spark.createDataFrame(a, ATTEMPT) for a in [rows, *others, again, [attempt(999, 900_000, customer=3)]]], build, "dropped"
        )
    got = sorted((r.payment_id, r.rule) for r in out.collect())
    assert (3, "fail_then_success") in got and (51, "rapid_attempts") in got
    assert not [x for x in got if x[0] in (50, 51) and x[1] in ("high_amount", "many_failed_attempts")]


def test_workers_need_not_have_the_package(tmp_path):
    """From another folder, with the package on the driver's path only."""
    root = str(Path(__file__).resolve().parents[1])
    job = f"""
import sys
sys.path.append({root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.sql.streaming.stateStore.providerClass", "{ROCKSDB}").getOrCreate())
from etalage.session import prepare
from etalage.sources import streams
from etalage.streaming import stateful
from datetime import datetime
rows = [(i, 1, datetime(2024, 1, 1 + 9 * (i == 3), 10, 5 * i), 1.0, "failed", "d", "i", "FR", "FR") for i in (1, 2, 3)]
df = prepare(spark).createDataFrame(rows, "{ATTEMPT}")
print("ALERTS", streams.replay(spark, [df], stateful.attempt_alerts, "t")[0].count())
"""
    said = subprocess.run([sys.executable, "-c", job], cwd=tmp_path, capture_output=True, text=True, timeout=150)
    assert "ALERTS 1" in said.stdout, said.stderr[-2000:]


def test_a_batch_written_again_leaves_no_row_twice(spark):
    table, topic = fresh_dir(spark, "t"), fresh_dir(spark, "m")
    write = jobs.write_twice(table, topic)
    batch = spark.range(5).select(F.col("id").alias("payment_id"), F.lit("r").alias("rule"))
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    assert spark.read.parquet(table).count() == 10
    assert spark.read.parquet(topic).count() == 10


def test_ingest_takes_each_new_file_once(spark, tmp_path):
    from etalage.__main__ import ingest_events

    inbox = tmp_path / "inbox"
    inbox.mkdir()
    line = '{"event_id": "%s", "ts": "2025-11-%02dT09:51:23", "event_type": "view", "customer_id": "C1"}\n'
    (inbox / "a.jsonl").write_text(line % ("a", 11))
    query = ingest_events(spark, str(inbox), str(tmp_path / "bronze"), str(tmp_path / "check"), "1 second")
    try:
        query.processAllAvailable()
        (inbox / "b.jsonl").write_text(line % ("b", 11) + line % ("c", 12))
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.parquet(str(tmp_path / "bronze")).collect()
    assert sorted((r.event_id, str(r.day)) for r in rows) == [("a", "2025-11-11"), ("b", "2025-11-11"), ("c", "2025-11-12")]


def test_progress_log_counts_what_came_too_late(spark, tmp_path):
    """The listener writes a row a batch; the late row of the second delivery is one of them."""
    path = str(tmp_path / "progress")
    listener = streams.ProgressLog(spark, path)
    spark.streams.addListener(listener)
    try:
        streams.replay(spark, arrivals(spark, [[(1, 5000)], [(2, 1), (3, 5001)]]), jobs.unique_events, "logged")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    rows = spark.read.parquet(path).orderBy("batch_id").collect()
    assert sum(r.input_rows for r in rows) == 3 and sum(r.late_rows for r in rows) == 1
    assert rows[-1].state_rows == 2 and len({r.query for r in rows}) == 1
