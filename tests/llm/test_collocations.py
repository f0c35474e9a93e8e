import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from etalage.llm import collocations, queries
from tests.conftest import SF

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def pieces_by_hand(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def by_hand(docs, longest=3, least=10, share=50, most=2000):
    """docs: (lang, text)."""
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for w in pieces_by_hand(text):
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    key = tuple(w[i : i + k])
                    counts.setdefault(lang, Counter())[key] += 1
    out = []
    for lang, found in counts.items():
        kept = []
        candidates = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            inside = [
                b for q, b in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * b >= share * a for b in inside):
                continue
            score, _, left, right = min(
                (1000000 * a * a // (found[p[:c]] * found[p[c:]]), c, found[p[:c]], found[p[c:]]) for c in range(1, len(p))
            )
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def mined(spark, docs, **how):
    table = spark.createDataFrame([(t, x, i, "p", 1) for i, (x, t) in enumerate(docs)], "text string, lang string, k int, phrase string, mark int")
    found = collocations.collocations(table, F.col("lang"), F.col("text"), **how)
    assert found.columns == COLUMNS
    return sorted(tuple(r) for r in found.collect())


def babble(seed, n, words=12, signs=True):
    draw = random.Random(seed)
    vocabulary = [draw.choice(["la", "Le", "été", "x", "WORD", "naïve", "ß"]) + str(draw.randrange(words)) for _ in range(words)]
    gaps = [" "] * 12 + (["  ", "\t", ". ", ", ", "\n", "!?", " ;", "\r\n"] if signs else [])
    return "".join(draw.choice(vocabulary) + draw.choice(gaps) for _ in range(n))


def test_by_brute_force(spark):
    docs = [(draw, babble(seed, 300)) for seed in range(6) for draw in ("en", "fr", None)]
    assert mined(spark, docs) == by_hand(docs)
    assert mined(spark, docs, longest=4, least=3, share=70, most=20) == by_hand(docs, 4, 3, 70, 20)
    assert mined(spark, docs, chunk_words=100) == by_hand(docs)


def test_nulls_empties_repeats_and_ties(spark):
    docs = [(None, None), ("en", ""), ("en", " \t."), (None, "a b"), ("und", "a b"), ("", "c d"), *[("en", "Same words here")] * 12,
            *[("de", "p q; r s")] * 10, *[("und", "A B")] * 8, *[("", "c d")] * 9, ("en", "same, words here"), ("fr", "z " * 40)]
    assert mined(spark, docs) == by_hand(docs)
    assert mined(spark, [], chunk_words=5) == []
    assert mined(spark, [("en", "one two three")]) == []


def test_very_long_texts_and_words(spark, monkeypatch):
    """Slabs of 64 bytes and words: runs go on over their edges, words are longer than two of them."""
    monkeypatch.setattr(collocations, "SLAB", 64)
    docs = [("en", babble(1, 5000, signs=False)), ("en", babble(1, 5000)), ("fr", ("y" * 1000 + " b ") * 30), ("fr", "x" * 5000 + " " + "x" * 5000)]
    assert mined(spark, docs) == by_hand(docs)
    monkeypatch.undo()
    docs = [("en", babble(2, 300_000, words=40)), ("en", "w" * 3_000_000 + " tail " + "w" * 3_000_000)]
    assert mined(spark, docs, most=50) == by_hand(docs, most=50)


def test_collisions_are_found_and_hashed_anew(spark):
    """Fingerprints of six bits collide; the next seed is whole. Without one it is an error, not a wrong result."""
    docs = [("en", babble(3, 2000)), ("fr", babble(4, 500))]
    assert mined(spark, docs, seeds=((7, 6), (8, 64))) == by_hand(docs)
    with pytest.raises(ValueError, match="collide"):
        mined(spark, docs, seeds=((7, 6), (9, 5)))


def test_equal_second_hashes_are_told_by_the_text(spark, monkeypatch):
    """With second hashes that are all one, only the words themselves can tell a collision."""
    monkeypatch.setattr(collocations, "CHECK_BITS", 0)
    docs = [("en", " ".join(f"w{i}" for i in range(3000) for _ in range(12)))]
    with pytest.raises(ValueError, match="collide"):
        mined(spark, docs, seeds=((7, 10),))
    assert mined(spark, docs) == by_hand(docs)


def test_fingerprints_depend_on_the_words_only():
    poly = collocations.hashes(1)
    a = collocations.Words(pa.array([b"x one  two", b"", b"one\ttwo one", b"one. two"], pa.binary()), poly)
    found = {}
    for k, at, mark, check in a.grams(2, np.zeros(4, np.uint64), 64):
        for i, m, c in zip(at.tolist(), mark.tolist(), check.tolist(), strict=True):
            found.setdefault(a.text(i, k), set()).add((k, m, c))
    assert all(len(v) == 1 for v in found.values()) and len(set.union(*found.values())) == len(found)
    assert set(found) == {b"x", b"one", b"two", b"x one", b"one two", b"two one"}


def test_packing_is_a_round_trip():
    for kind in (np.uint64, np.uint32, np.uint16):
        values = np.array([0, 1, 255, 256, np.iinfo(kind).max], kind)
        assert (collocations.unpacked(collocations.packed(values), kind) == values).all()


def test_query_by_brute_force_and_twin(spark):
    docs = [(r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = queries.QUERIES["op11_collocations"](spark, SF)
    got = sorted(tuple(r) for r in df.collect())
    assert df.columns == COLUMNS and got == by_hand(docs)
    cur = duckdb.connect()
    cur.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(cur.execute(queries.SQL["op11_collocations"]).fetchall()) == got
