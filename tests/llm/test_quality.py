import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from etalage.llm import quality, queries
from tests.conftest import SF

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    words = WORDS.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            again += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, again, len(repeated)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def texts():
    draw = random.Random(3)
    out = [None, "", " \n\t ", "a", "one two\none two\n\n\n one two", "é ü x y", "#*$%&|<>" * 3, "a\x1cb\x85c", "x\r\nx\r\n"]
    out += [" ".join(draw.choice("ab") for _ in range(draw.randint(5, 40))) for _ in range(40)]
    out += ["\n".join(draw.choice(["p q", "r", " ", ""]) for _ in range(20)) for _ in range(5)]
    out += ["a b c d e f g h " * 3, "a b c d e f g h a b c d e f g h", "k " * 5000, "y" * 100_000 + " z"]
    return out


def test_counts_by_brute_force(spark):
    rows = [(i, t, 1, "c") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, _text string")
    for r in quality.count_columns(docs, {"doc_id": F.col("doc_id")}).collect():
        assert tuple(r[c] for c in COUNTS) == by_hand(rows[r.doc_id][1]), rows[r.doc_id][1]


def test_query_counts_and_base_rules(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.QUERIES["op4_quality_rules"](spark, SF).collect()
    assert len(found) == len(docs)
    for r in found:
        want = by_hand(docs[r.doc_id])
        assert tuple(r[c] for c in COUNTS) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def corpus(draw, lang, source, n, clean=True):
    short = ["the", "of", "and", "river", "stone", "walks", "under", "light", "paper", "seven", "green", "a", "to", "in"]
    words = short if lang == "en" else [w * 2 for w in short]
    out = []
    for _ in range(n):
        body = [draw.choice(words) + str(draw.randint(0, 99)) for _ in range(60)]
        out.append((" ".join(body if clean else [f"{w}***" for w in body]), lang, source))
    return out


def judged(spark, rows, **options):
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    found = quality.quality(docs, {"doc_id": F.col("doc_id")}, **options).collect()
    assert len(found) == len(rows)
    return {r.doc_id: r for r in found}


def test_thresholds_follow_the_group(spark):
    """Long words are usual in one language and stand out in the other; symbols stand out in both."""
    draw = random.Random(1)
    rows = corpus(draw, "en", "s", 300) + corpus(draw, "de", "s", 300) + corpus(draw, "en", "s", 10, clean=False)
    strange = [(" ".join(w * 6 for w in t.split()), lang, s) for t, lang, s in corpus(draw, "en", "s", 10)]
    found = judged(spark, rows + strange)
    assert all(found[i].kept for i in range(600))
    assert not any(found[i].kept for i in range(600, 620))


def test_exact_quartiles_stand_behind_the_limits(spark):
    draw = random.Random(2)
    rows = corpus(draw, "en", "s", 250)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    counts = quality.count_columns(docs, {c: F.col(c) for c in ("lang", "source")})
    limits = quality.thresholds(quality.sketches(counts.repartition(5))).first()
    ratios = sorted(r.word_chars / r.n_words for r in counts.collect())
    q1, q3 = ratios[62], ratios[187]
    # Ranks of a sketch this small are exact up to the neighbour that a quantile between two falls on.
    assert limits.chars_per_word_high == pytest.approx(q3 + 5 * max(q3 - q1, 1.0), abs=0.05)
    assert limits.chars_per_word_low == pytest.approx(q1 - 5 * max(q3 - q1, 1.0), abs=0.05)


def test_small_groups_use_their_language(spark):
    draw = random.Random(4)
    rows = corpus(draw, "en", "big", 300) + corpus(draw, "en", "small", 3) + corpus(draw, "en", "small", 3, clean=False)
    found = judged(spark, rows)
    assert all(found[i].kept for i in range(303)) and not any(found[i].kept for i in range(303, 306))


def test_nulls_empties_and_groups_without_limits(spark):
    draw = random.Random(6)
    good = corpus(draw, "en", "s", 5)[0][0]
    rows = [(None, None, None), ("", "xx", "only bad"), (good, None, None), (good, None, None), (good, "", "")]
    found = judged(spark, rows)
    assert [found[i].kept for i in range(5)] == [False, False, True, True, True]
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality.quality(none, {"doc_id": F.col("doc_id")}).count() == 0


def test_query_is_its_twin(spark):
    """Groups of this table fit into a sketch, which is then exact."""
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries.QUERIES["op4_quality_rules"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(queries.SQL["op4_quality_rules"]).fetchall())
