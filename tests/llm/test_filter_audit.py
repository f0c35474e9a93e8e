import random
import re
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from etalage.llm import filter_audit, queries
from tests.conftest import SF

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def by_hand(masks):
    """(part, set of failed letters, good, toxic) of each document, filtered one by one in every order."""
    out = set()
    for part in {m[0] for m in masks}:
        share, rows = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            alive = [m for m in masks if m[0] == part]
            failing = {f: sum(f in m[1] for m in alive) for f in order}
            alone = {f: sum({f} == m[1] for m in alive) for f in order}
            for i, f in enumerate(order, 1):
                gone = [m for m in alive if f in m[1]]
                alive = [m for m in alive if f not in m[1]]
                share[f] += len(gone)
                rows.append((f, (part, "".join(order), i, len(alive), len(gone), failing[f] - len(gone), alone[f],
                                 sum(m[2] for m in gone), sum(m[3] for m in gone))))
        out |= {(*row, share[f]) for f, row in rows}
    return out


def masks_by_hand(docs, labels):
    """docs: (id, text, lang); labels: (id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = []
    for i, text, lang in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(w) < 100:
            fails.add("A")
        if 100 * len(set(w)) < 80 * len(w):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs):
            fails.add("E")
        out.append((lang or "", fails, int(i in good), int(i in toxic)))
    return out


def audited(spark, docs, labels):
    text, key = F.col("text"), F.col("doc_id")
    counted = filter_audit.failures(
        spark.createDataFrame(docs, "doc_id long, text string, lang string, n int, part string, digest string")
        if docs and len(docs[0]) == 6
        else spark.createDataFrame(docs, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        key, F.col("lang"), text, filter_audit.text_conditions(text), [F.col("quality") == 1, F.col("toxic") == 1], key,
    )
    return filter_audit.interactions(counted, "ABCDE", ["good_lost", "toxic_lost"])


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_swaps_meet_every_order_once(n):
    order = list(range(n))
    seen = [tuple(order)]
    for level in filter_audit.swaps(n):
        order[level], order[level + 1] = order[level + 1], order[level]
        seen.append(tuple(order))
    assert sorted(seen) == sorted(permutations(range(n)))


@pytest.mark.parametrize("seed", range(6))
def test_diagram_by_brute_force(seed):
    draw = random.Random(seed)
    masks = [("p", {f for f in "ABCDE" if draw.random() < 0.2 * seed}, draw.randint(0, 1), draw.randint(0, 1)) for _ in range(60)]
    counts = {}
    for _, fails, good, toxic in masks:
        mask = sum(1 << "ABCDE".index(f) for f in fails)
        counts[mask] = tuple(map(sum, zip(counts.get(mask, (0, 0, 0)), (1, good, toxic), strict=True)))
    assert {("p", *row) for row in filter_audit.audit(counts, "ABCDE")} == by_hand(masks)


def test_diagram_shares_equal_remainders():
    diagram = filter_audit.Diagram({m: (1,) for m in range(32)}, "ABCDE")
    assert [len(k) for k in diagram.kids] == [1] * 5 and diagram.weight(0, diagram.root) == (32,)


def test_nulls_empties_ties_repeats_and_clashing_names(spark):
    many = " ".join(f"w{i}" for i in range(120))
    docs = [
        (5, many, "en"), (3, many, "fr"), (3, many, "en"), (9, many, None), (9, many, ""), (None, many, "en"), (None, many, None),
        (1, None, "en"), (2, "", "en"), (4, "", None), (6, "A B C " * 50, "en"), (7, "a$ " + many, "fr"), (8, "x " * 50_000, "de"),
        (10, "É " * 100, "de"), (11, many + "!", "en"), (11, many + "!", "en"), (12, many + "!", "en"),
    ]
    labels = [(5, 1, 0), (5, 0, 1), (3, 1, None), (None, 1, 1), (6, 0, 1), (99, 1, 1), (9, 1, 1)]
    rows = [(*d, i, "x", "y") for i, d in enumerate(docs)]
    found = audited(spark, rows, labels)
    assert found.columns == COLUMNS
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == by_hand(masks_by_hand(docs, labels))
    assert {r[0] for r in got} == {"en", "fr", "de", ""}


def test_empty_table(spark):
    assert audited(spark, [], []).count() == 0
    assert audited(spark, [(1, "a", "en")], []).where("step = 5 and kept = 0").count() == 120


@pytest.mark.parametrize("table", ["documents"])
def test_query_by_brute_force_and_twin(spark, table):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/{table}.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    df = queries.QUERIES["op13_filter_audit"](spark, SF)
    got = {tuple(r) for r in df.collect()}
    assert got == by_hand(masks_by_hand(docs, labels))
    duck = duckdb.connect()
    for t in ("documents", "labels"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = duck.execute(queries.SQL["op13_filter_audit"])
    assert [d[0] for d in cur.description] == df.columns and set(cur.fetchall()) == got
