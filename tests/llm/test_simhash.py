import random
import re
import tracemalloc

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from etalage.llm import queries, simhash
from etalage.llm.graph import components
from tests.conftest import SF


def fingerprint_by_hand(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(fingerprints, radius):
    """Smallest index that can be reached, over all pairs."""
    n = len(fingerprints)
    label = list(range(n))
    values = np.array(fingerprints, np.uint64)
    changed = True
    while changed:
        changed = False
        for i in range(n):
            near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= radius)
            low = min(label[j] for j in near)
            for j in near:
                if label[j] != low:
                    label[j], changed = low, True
    return label


def test_hash_is_the_engine_s(spark):
    text = "the quick brown fox"
    assert xxhash.xxh64_intdigest(text.encode(), 42) == spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % (1 << 64)


@pytest.mark.parametrize("text", ["", " \t\n", "One", "a b c", "A b C d", "é É x\x1cy z z z z z", "w " * 9000, "x" * 100_000, "ÀB cd ef gh ij"])
def test_fingerprint_by_brute_force(text):
    assert simhash.fingerprint(text.encode(), 4) == fingerprint_by_hand(text)


def crowd(seed, n=400):
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        if out and draw.random() < 0.7:
            x = draw.choice(out)
            for b in draw.sample(range(64), draw.randint(0, 6)):
                x ^= 1 << b
        else:
            x = draw.getrandbits(64)
        out.append(x)
    return out


@pytest.mark.parametrize(("radius", "most"), [(4, 8_000_000), (3, 8_000_000), (2, 8_000_000), (1, 8_000_000), (0, 8_000_000), (4, 2000), (3, 2000), (2, 300)])
def test_links_join_up_all_pairs_within_the_radius(spark, radius, most):
    values = sorted(set(crowd(radius)))
    signed = [int(x) for x in np.array(values, np.uint64).view(np.int64)]
    nodes = spark.createDataFrame([(x,) for x in signed], "node long")
    roots = {r.node: r.root for r in components(simhash.links(nodes, radius, most)).collect()}
    label = groups_by_hand(values, radius)
    mine = [roots.get(x, x) for x in signed]
    assert len(set(zip(mine, label, strict=True))) == len(set(mine)) == len(set(label))


def test_a_dense_crowd_is_not_paired(spark):
    """All values within two bits of one: links stay about as many as values."""
    base = 0x0123456789ABCDEF
    values = {base} | {base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    nodes = spark.createDataFrame([(int(np.array([x], np.uint64).view(np.int64)[0]),) for x in values], "node long")
    found = simhash.links(nodes, 4)
    assert found.distinct().count() < 80 * len(values)
    assert components(found).select("root").distinct().count() == 1


def test_a_crowded_place_is_taken_apart_in_bounded_memory():
    """400,000 fingerprints with the same 28 high bits: a few hundred MB at most, and the links of the pairs among them."""
    draw = np.random.default_rng(3)
    nodes = np.unique(draw.integers(0, 1 << 36, 400_000, dtype=np.uint64) | (np.uint64(0xABCDEF1) << np.uint64(36)))
    pair = nodes[0] ^ np.uint64(0b1111)
    nodes = np.unique(np.r_[nodes, pair])
    tracemalloc.start()
    u, v = simhash.collide(np.full(len(nodes), 0xABCDEF1, np.uint64), nodes, 28, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000_000_000
    assert (np.bitwise_count(u ^ v) <= 64).all() and (v < u).all()
    reached = dict(zip(u.tolist(), v.tolist(), strict=True))
    assert reached.get(int(nodes[0]), int(nodes[0])) == reached.get(int(pair), int(pair))


def test_components_of_a_long_path(spark):
    ids = [xxhash.xxh64_intdigest(str(i)) - (1 << 63) for i in range(300)]
    links = spark.createDataFrame(list(zip(ids, ids[1:], strict=False)) + [(ids[0], ids[0]), (5, 5)], "u long, v long")
    found = components(links).collect()
    assert len(found) == 300 and len({r.root for r in found}) == 1
    assert components(links.where("u = v")).count() == 0


def test_query_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    values = [fingerprint_by_hand(d.text) for d in docs]
    label = groups_by_hand(values, 4)
    got = {r.doc_id: r for r in queries.QUERIES["op9_simhash"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d, value, low in zip(docs, values, label, strict=True):
        assert got[d.doc_id].fingerprint == f"{value:016x}"
        assert got[d.doc_id].component_id == docs[low].doc_id


def test_nulls_empties_repeats_and_clashing_names(spark):
    rows = [(7, None), (3, ""), (None, "lonely text of five words"), (5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (9, "A B C D E")]
    docs = spark.createDataFrame([(i, t, 1, "n") for i, t in rows], "doc_id long, text string, fingerprint int, node string")
    found = simhash.near_duplicates(docs, F.col("doc_id"))
    assert found.columns == ["key", "fingerprint", "component"]
    got = sorted(((r.key, r.component) for r in found.collect()), key=str)
    assert got == sorted([(7, 3), (3, 3), (None, None), (5, 5), (5, 5), (None, 5), (9, 5)], key=str)
    assert simhash.near_duplicates(docs.where("false"), F.col("doc_id")).count() == 0
