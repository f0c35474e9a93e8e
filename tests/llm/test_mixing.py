import re
import random
import duckdb
import pytest
from pyspark.sql import functions as F

from etalage.llm.common import word_count
from etalage.llm import mixing, queries
from tests.conftest import SF

SHAPES = queries.MIX_SHAPES


def area(shape, time):
    """The shape's integral up to a time, by small steps."""
    def density(t):
        for (t0, d0), (t1, d1) in zip(shape, shape[1:], strict=False):
            if t <= t1:
                return d0 + (d1 - d0) * (t - t0) / (t1 - t0)
        return 0.0

    steps = 4000
    return sum(density(time * (i + 0.5) / steps) for i in range(steps)) * time / steps


@pytest.mark.parametrize("shape", [*SHAPES, [(0.0, 0.0), (0.25, 4.0), (0.25001, 0.0), (1.0, 0.0)]])
def test_inverse_undoes_the_integral(spark, shape):
    shares = [0.0, 0.1, 0.25, 0.5, 0.77, 0.999]
    rows = spark.createDataFrame([(s,) for s in shares], "s double").select("s", mixing.inverse(F.col("s"), shape).alias("t"))
    for r in rows.collect():
        assert area(shape, r.t) / area(shape, 1.0) == pytest.approx(r.s, abs=2e-3)


def water_level(sizes, weights, most):
    """Targets by hand: cap, share the rest out again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        open_weight = sum(w for s, w in weight.items() if s not in capped)
        over = [s for s in names if s not in capped and rest * weight[s] / open_weight > most * sizes[s]]
        if not over:
            return {s: most * sizes[s] if s in capped else rest * weight[s] / open_weight for s in names}
        capped.update(over)


def documents():
    out, number = [], 0
    for source, count, words in [("a", 3, 4), ("B", 400, 10), (None, 50, 7), ("é", 30, 20), ("", 5, 1), ("zero", 4, 0)]:
        for _ in range(count):
            out.append((number, "w " * words, source, "s", 1.0))
            number += 1
    return [*out, (None, "w w", "B", "s", 1.0), (None, "w w", "B", "s", 1.0), (number, None, "a", "s", 1.0), (number, "", None, "s", 1.0)]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(documents(), "doc_id long, text string, source string, slice string, target double")


def test_targets_and_what_is_taken(docs):
    found = queries.mixed(docs, F.col("doc_id")).collect()
    assert len(found) == len(documents())
    sizes = {}
    for _, text, source, *_ in documents():
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = sorted((sizes[s], round(t, 6)) for s, t in water_level(sizes, [5, 2, 1], 3).items())
    assert sorted({(r.source_size, round(r.target, 6)) for r in found}) == sorted(set(want))
    for size, target in {(r.source_size, r.target) for r in found}:
        own = [r for r in found if (r.source_size, r.target) == (size, target)]
        assert abs(sum(r.size * r.copies for r in own) - target) <= max((r.size for r in own), default=0)
    assert all(0 <= r.copies <= 3 and (r.size > 0 or r.copies == 0) for r in found)
    assert sum(r.target for r in {(r.source_size, r.target): r for r in found}.values()) == pytest.approx(sum(sizes.values()))


def test_slices_do_not_change_the_result(docs):
    def run(rows):
        found = mixing.mix(docs, F.col("doc_id"), F.col("source"), F.length("text"), [5, 2, 1], SHAPES, rows_per_slice=rows)
        return sorted(map(tuple, found.collect()), key=str)

    assert run(3) == run(1_000_000)


def test_copies_come_in_the_order_of_their_positions(docs):
    mixed = queries.mixed(docs, F.col("doc_id"))
    rows = mixing.in_order(mixed, SHAPES).collect()
    assert len(rows) == mixed.agg(F.sum("copies")).first()[0]
    positions = [r.position for r in rows]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1


def test_early_sources_come_early(docs):
    """The source that grows rarer has over half of its words in the first half, the one that grows less than half."""
    rows = mixing.in_order(queries.mixed(docs, F.col("doc_id")), SHAPES).collect()
    for shape, early in ((0, True), (2, False)):
        own = [r for r in rows if r.shape == shape]
        first = sum(r.size for r in own if r.position < 0.5) / sum(r.size for r in own)
        assert (first > 0.5) == early


def test_empty_table_and_no_words(spark, docs):
    assert queries.mixed(docs.where("false"), F.col("doc_id")).count() == 0
    silent = queries.mixed(docs.where("source = 'zero'"), F.col("doc_id")).collect()
    assert [(r.target, r.copies, r.position) for r in silent] == [(0.0, 0, None)] * 4


def test_query_is_its_twin(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    for folder, files in ((SF, f"{SF}/documents.parquet"), (str(tmp_path), f"{tmp_path}/documents.parquet/*.parquet")):
        con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{files}'")
        for name in ("op3_source_mix", "op3_source_mix_order"):
            df = queries.QUERIES[name](spark, folder)
            cur = con.execute(queries.SQL[name])
            assert [d[0] for d in cur.description] == df.columns
            assert sorted(map(tuple, df.collect()), key=str) == sorted(cur.fetchall(), key=str)


def test_queries_carry_the_positions(spark, docs, tmp_path):
    """Each copy at the time at which its place on the tape has been asked for; documents in the order of their first copies."""
    docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).write.parquet(str(tmp_path / "documents.parquet"))
    mixed = queries.mixed(spark.read.parquet(str(tmp_path / "documents.parquet")), F.col("doc_id"))
    rows = {r.key: r for r in mixed.collect()}
    copies = queries.QUERIES["op3_source_mix_order"](spark, str(tmp_path)).collect()
    assert sorted((c.doc_id, c.turn) for c in copies) == sorted((k, t) for k, r in rows.items() for t in range(r.copies))
    assert [c.position for c in copies] == sorted(c.position for c in copies)
    for c in copies[::7]:
        r, shape = rows[c.doc_id], SHAPES[rows[c.doc_id].shape]
        share = (r.start + c.turn * r.source_size) / r.target
        assert area(shape, c.position) / area(shape, 1.0) == pytest.approx(share, abs=2e-3)
    order = [rows[r.doc_id].position for r in queries.QUERIES["op3_source_mix"](spark, str(tmp_path)).collect()]
    taken = [p for p in order if p is not None]
    assert taken == sorted(taken) and order == taken + [None] * (len(order) - len(taken)) and len(set(taken)) > 100


def test_rows_without_an_id_lie_in_even_slices(spark):
    """A third of 3,000 rows has no id, another third shares one: slices of 300 rows are about that large."""
    rows = [(i if i % 3 == 0 else None if i % 3 == 1 else 7, "one", "w " * (1 + i % 5)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = mixing.mix(docs, F.col("doc_id"), F.col("source"), word_count(F.col("text")), [5, 2, 1], rows_per_slice=300)
    plan = found._jdf.queryExecution().analyzed().toString()
    tape = spark.read.parquet(re.search(r"(file:\S+/tape)", "\n".join(found.inputFiles()))[1])
    sizes = [r["count"] for r in tape.groupBy("slice").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 600 and plan
    total = sum(len(t.split()) for *_, t in rows)
    taken = found.agg(F.sum(F.col("size") * F.col("copies"))).first()[0]
    assert abs(taken - total) <= 5


def test_targets_by_rounds(spark):
    """The level found in one pass is the one that taking capped sources out round by round ends at."""
    draw = random.Random(5)
    for _ in range(4):
        sizes = {f"s{i:02d}": draw.choice([1, 5, 40, 1000, 20_000]) for i in range(draw.randint(1, 14))}
        weights = [5, 2, 1]
        weight = {s: weights[i % 3] for i, s in enumerate(sorted(sizes))}
        want, full = {}, set()
        while True:
            rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
            level = rest / sum(weight[s] for s in sizes if s not in full) if len(full) < len(sizes) else 0
            over = {s for s in sizes if s not in full and level * weight[s] > 3 * sizes[s]}
            if not over:
                break
            full |= over
        want = {s: 3 * sizes[s] if s in full else level * weight[s] for s in sizes}
        table = spark.createDataFrame([(s, f"s{s}", n) for s, n in sizes.items()], "source string, source_key string, source_size long")
        got = {r.source_key[1:]: r.target for r in mixing.targets(table, weights, 3, 3).collect()}
        assert got == pytest.approx(want)
