import random
import time

import numpy as np
import pytest

from etalage.llm import license_scan, queries
from etalage.llm.license_scan import TOKEN, Index
from etalage.llm.license_templates import TEMPLATES
from tests.conftest import SF

MIT, NOTICE = TEMPLATES["MIT"], TEMPLATES["MIT notice"]
PROSE = "river stone walks under light paper seven green house morning table window quiet letter".split()


def found(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "L", 7) for i, t in enumerate(texts)], "doc_id long, text string, license string, start int")
    rows = license_scan.scan(docs, ["doc_id"], **options).collect()
    return [(r.doc_id, r.license, round(r.coverage, 3), texts[r.doc_id][r.start : r.end]) for r in rows]


def test_exact_copies_with_spans(spark):
    texts = [f"Éa İ {NOTICE} tail", f"{MIT}", f"x {TEMPLATES['CC-BY-NC-4.0 notice']} y {TEMPLATES['GPL-3.0 notice']}", "nothing here"]
    got = found(spark, texts)
    assert got[0] == (0, "MIT notice", 1.0, NOTICE.rstrip("."))
    assert got[1][:3] == (1, "MIT", 1.0)
    assert [g[1] for g in got[2:]] == ["CC-BY-NC-4.0 notice", "GPL-3.0 notice"]


def test_changed_words_lower_the_coverage(spark):
    draw = random.Random(4)
    words = MIT.split()
    few = [draw.choice(PROSE) if i % 17 == 5 else w for i, w in enumerate(words)]
    many = [draw.choice(PROSE) if i % 3 == 0 else w for i, w in enumerate(words)]
    dropped = [w for i, w in enumerate(words) if i % 20 != 7]
    got = found(spark, [" ".join(t) for t in (few, many, dropped)])
    assert [(g[0], g[1]) for g in got] == [(0, "MIT"), (2, "MIT")]
    assert got[0][2] == pytest.approx(1 - 10 / len(TOKEN.findall(MIT)), abs=0.02)


def test_the_longer_of_overlapping_findings_stays(spark):
    """The Apache text has the Apache notice in it."""
    assert [g[1] for g in found(spark, [TEMPLATES["Apache-2.0"], TEMPLATES["Apache-2.0 notice"]])] == ["Apache-2.0", "Apache-2.0 notice"]


def test_many_notices_in_a_long_text(spark):
    filler = " ".join(PROSE * 300)
    got = found(spark, [f" {filler} ".join([NOTICE] * 20)])
    assert [g[1:] for g in got] == [("MIT notice", 1.0, NOTICE.rstrip("."))] * 20


def test_notices_that_stand_next_to_each_other(spark):
    """Of every notice 2, 3 and 9 in a row, with nothing or a word between them, and in turn with another."""
    names = [n for n in TEMPLATES if n.endswith(("notice", "licensed"))]
    texts, want = [], []
    for i, name in enumerate(names):
        other = names[(i + 1) % len(names)]
        for row in ([name] * 2, [name] * 3, [name] * 9, [name, other] * 3):
            for between in (" ", " and "):
                texts.append(between.join(TEMPLATES[n] for n in row))
                want += [(len(texts) - 1, n, 1.0, TEMPLATES[n].rstrip(".")) for n in row]
    assert found(spark, texts) == want


def test_winnowing_keeps_a_code_of_every_shared_run():
    index = Index({"t": " ".join(f"w{i}" for i in range(60))}, k=3, window=4)
    words = index.words[0]
    for at in range(len(words) - 5):
        assert index.candidates(words[at : at + 6], 8), at
    assert len(index.keys) < len(words) - 2


def test_alignment_by_brute_force():
    """With the band as wide as the texts, matched words are those of an optimal local alignment."""
    draw = random.Random(9)
    for _ in range(60):
        own = [draw.choice("abcd") for _ in range(draw.randint(3, 9))]
        index = Index({"t": " ".join(own)})
        text = np.array([index.number.get(draw.choice("abcde"), 0) for _ in range(draw.randint(1, 12))], np.int64)
        a, b = index.words[0].tolist(), text.tolist()
        score = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                same = a[i - 1] == b[j - 1]
                score[i][j] = max(0, score[i - 1][j - 1] + (2 if same else -1), score[i - 1][j] - 1, score[i][j - 1] - 1)
        best = max(map(max, score))
        matched, first, last = index.align(text, 0, 0, 20)
        if not best:
            assert matched == 0
            continue
        part = b[first : last + 1]
        common = [[0] * (len(part) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(part) + 1):
                common[i][j] = max(common[i - 1][j], common[i][j - 1], common[i - 1][j - 1] + (a[i - 1] == part[j - 1]))
        assert 0 < matched <= common[-1][-1] and 2 * matched >= best


def test_nulls_empties_and_empty_table(spark):
    docs = spark.createDataFrame([(1, None), (None, ""), (None, NOTICE), (None, NOTICE)], "doc_id long, text string")
    rows = license_scan.scan(docs, ["doc_id"]).collect()
    assert [(r.doc_id, r.license) for r in rows] == [(None, "MIT notice")] * 2
    assert license_scan.scan(docs.where("false"), ["doc_id"]).count() == 0
    assert license_scan.scan(docs, ["doc_id"], templates={}).count() == 0


def test_query_finds_the_notices_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    notices = {n: t for n, t in TEMPLATES.items() if n.endswith("notice")}
    want = {(d.doc_id, n) for d in docs for n, t in notices.items() if t in d.text}
    got = {(r.doc_id, r.license) for r in queries.QUERIES["op2_license_scan"](spark, SF).where("coverage = 1").collect()}
    assert got == want and want


def test_many_notices_in_a_very_long_text_take_time_in_proportion():
    """208,000 words with 3,200 notices: each alignment looks at its own part of the text only."""
    index = Index({"N": NOTICE})
    own = [index.number[w.lower()] for w in TOKEN.findall(NOTICE)]
    words = np.zeros(208_000, np.int64)
    starts = np.arange(3200) * 65
    for i, w in enumerate(own):
        words[starts + i] = w
    begin = time.process_time()
    got = index.scan(words, 8, 0.8)
    assert time.process_time() - begin < 2.0
    assert [x[3] for x in got] == starts.tolist() and all(x[1] == 1 for x in got)
