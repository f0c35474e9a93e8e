import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from etalage.functions.columns import micros
from etalage.operators.patterns import Pattern, Step, matches
from etalage.plans.streams import ROCKSDB
from etalage.session import settings
from etalage.sources import streams
from etalage.streaming.patterns import live_matches
from tests.conftest import T0, at

EVENT = "number long, who long, ts timestamp_ntz, kind string, device string"
A, B, C = (Step(f"kind = '{k}'") for k in "abc")
HOP = Step("kind <> 'c'", ("device",))

PATTERNS = {
    "strict": Pattern("strict", (A, A, A, B), 4000, strict=True),
    "strict-pair": Pattern("strict-pair", (A, B), 900, strict=True),
    "between": Pattern("between", (A, B, C), 3000),
    "between-four": Pattern("between-four", (A, B, A, C), 6000),
    "unless": Pattern("unless", (A, A, B), 5000, unless="kind = 'c'"),
    "absent": Pattern("absent", (A, B), 1200, absent=True),
    "hop": Pattern("hop", (HOP, HOP), 3000, strict=True),
    "hop-later": Pattern("hop-later", (A, HOP, Step("kind = 'b'", ("device",))), 9000),
}


def by_hand(rows, pattern, upto=None):
    """All choices of events as steps, for each event that can be the last; the latest beginning counts."""
    conditions = {A: "a", B: "b", C: "c"}
    out = []
    for who in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == who and r[2] is not None), key=lambda r: (r[2], r[0]))
        seconds = [(r[2] - T0).total_seconds() for r in own]

        def does(i, step):
            if pattern.unless and own[i][3] == "c":
                return False
            kind = own[i][3]
            fits = kind == conditions[step] if step in conditions else (kind not in (None, "c") if step == HOP else kind == "b")
            return fits and all(i > 0 and own[i][4] and own[i - 1][4] and own[i][4] != own[i - 1][4] for _ in step.changed)

        if pattern.absent:
            for i in range(len(own)):
                if does(i, A) and not any(does(j, B) and seconds[j] - seconds[i] <= pattern.within for j in range(i + 1, len(own))):
                    if upto is None or seconds[i] + pattern.within <= upto:
                        out.append((who, own[i][0], seconds[i]))
            continue

        def begun(i, step):
            """The latest beginning of a run whose ``step``-th step is event i."""
            if not does(i, pattern.steps[step]):
                return None
            if step == 0:
                return i
            found = None
            for j in range(i - 1, -1, -1):
                if pattern.unless and own[j][3] == "c":
                    break
                b = begun(j, step - 1)
                if b is not None:
                    found = b if found is None else max(found, b)
                if pattern.strict:
                    break
            return found

        for i in range(len(own)):
            b = begun(i, len(pattern.steps) - 1)
            if b is not None and seconds[i] - seconds[b] <= pattern.within:
                out.append((who, own[i][0], seconds[b]))
    return sorted(out)


def some_events(seed, n=160):
    draw = random.Random(seed)
    return [
        # A hot key, and times that meet others.
        (i, 1 if draw.random() < 0.5 else draw.randrange(2, 6), at(draw.choice([draw.randrange(20_000), draw.randrange(200) * 100])),
         draw.choice(["a", "a", "b", "b", "c", None]), draw.choice(["x", "y", "z", None]))
        for i in range(n)
    ]


def told(df):
    return sorted((r.who, r.number, (r.started - T0).total_seconds()) for r in df.withColumn("started", F.col("started").cast("timestamp_ntz")).collect())


@pytest.mark.parametrize("pieces", [1, 13])
@pytest.mark.parametrize("name", list(PATTERNS))
def test_batch_by_brute_force(spark, name, pieces):
    pattern = PATTERNS[name]
    rows = [*some_events(len(name)), (900, 1, None, "a", "x"), (901, 1, None, "b", "y")]
    df = spark.createDataFrame(rows, EVENT)
    want = by_hand(rows, pattern)
    assert want
    found = matches(df, "who", "ts", "number", pattern, pieces=pieces)
    assert found.columns == ["who", "number", "started", "ended"]
    assert told(found) == want


def test_a_hot_key_is_many_pieces(spark):
    """One key only, in 13 pieces; a run goes on over pieces that hold nothing of it."""
    rows = [(0, 1, at(0), "a", "x"), *[(i, 1, at(10 * i), None, "x") for i in range(1, 200)], (200, 1, at(2500), "b", "x"), (201, 1, at(2600), "c", "x")]
    found = matches(spark.createDataFrame(rows, EVENT), "who", "ts", "number", PATTERNS["between"], pieces=13)
    assert told(found) == [(1, 201, 0.0)]


def test_no_rows_and_meaningless_patterns(spark):
    empty = spark.createDataFrame([], EVENT)
    assert matches(empty, "who", "ts", "number", PATTERNS["hop"]).count() == 0
    assert matches(empty, "who", "ts", "number", PATTERNS["absent"]).count() == 0
    for wrong in (dict(steps=(A,)), dict(steps=(A, B, C), absent=True), dict(steps=(A, B), strict=True, unless="true")):
        with pytest.raises(ValueError, match="meaning"):
            Pattern("wrong", within=1, **wrong)


@pytest.mark.parametrize("name", list(PATTERNS))
def test_stream_gives_the_same_for_any_order_of_arrival(spark, name):
    pattern = PATTERNS[name]
    rows = some_events(len(name) + 50)
    last = (999, 77, at(200_000), None, None)
    want = by_hand(rows, pattern)
    random.Random(1).shuffle(rows)
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB, spark__sql__shuffle__partitions="2"):
        arrivals = [spark.createDataFrame(part, EVENT) for part in (rows[:70], rows[70:], [last])]
        out, _ = streams.replay(spark, arrivals, lambda s: live_matches(s, "who", "ts", "number", pattern, "1 day"), f"live-{name}")
    assert want and told(out) == want


def test_absent_steps_are_told_up_to_the_watermark(spark):
    """Three clicks; the second is followed in time, the third's time has not run out at the watermark."""
    rows = [(1, 1, at(0), "a", "x"), (2, 1, at(5000), "a", "x"), (3, 1, at(6000), "b", "x"), (4, 1, at(20_000), "a", "x"), (5, 2, at(21_700), None, "x")]
    pattern = PATTERNS["absent"]
    df = spark.createDataFrame(rows, EVENT)
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB, spark__sql__shuffle__partitions="2"):
        out, _ = streams.replay(spark, [df], lambda s: live_matches(s, "who", "ts", "number", pattern), "open-clicks")
    assert told(out) == [(1, 1, 0.0)]
    upto = df.agg((F.max(micros("ts")) - 600_000_000).alias("m")).first().m
    assert told(matches(df, "who", "ts", "number", pattern, F.lit(upto))) == [(1, 1, 0.0)]
    assert told(matches(df, "who", "ts", "number", pattern)) == [(1, 1, 0.0), (1, 4, 20_000.0)]


def test_workers_need_not_have_the_package(tmp_path):
    """From another folder, with the package on the driver's path only: the pattern travels whole."""
    root = str(Path(__file__).resolve().parents[1])
    job = f"""
import sys
sys.path.append({root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.sql.streaming.stateStore.providerClass", "{ROCKSDB}").getOrCreate())
from datetime import datetime
from etalage.operators.patterns import Pattern, Step
from etalage.session import prepare
from etalage.sources import streams
from etalage.streaming.patterns import live_matches
rows = [(1, 1, datetime(2024, 1, 1, 10), "a"), (2, 1, datetime(2024, 1, 1, 10, 5), "b"), (3, 2, datetime(2024, 1, 2), "a")]
df = prepare(spark).createDataFrame(rows, "number long, who long, ts timestamp_ntz, kind string")
pattern = Pattern("pair", (Step("kind = 'a'"), Step("kind = 'b'")), 900)
print("FOUND", streams.replay(spark, [df], lambda s: live_matches(s, "who", "ts", "number", pattern), "t")[0].count())
"""
    said = subprocess.run([sys.executable, "-c", job], cwd=tmp_path, capture_output=True, text=True, timeout=150)
    assert "FOUND 1" in said.stdout, said.stderr[-2000:]
