import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from etalage.llm import exact_dedup, queries
from tests.conftest import SF

ROWS = [
    (5, "same"), (9, "same"), (9, "same"), (None, "same"), (1, ""), (None, None), (3, "Same"), (4, "x" * 200_000), (8, "x" * 200_000),
    (None, "nameless"), (None, "nameless"), (7, "same "),
]



def by_hand(rows):
    out = []
    for key, text in rows:
        keys = [k for k, t in rows if (t or "") == (text or "")]
        known = [k for k in keys if k is not None]
        out.append((key, max(known) if known else None, len(keys)))
    return out


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(k, t, "d", 0) for k, t in ROWS], "doc_id long, text string, digest string, n int")


@pytest.mark.parametrize("files_per_batch", [10_000, 1])
def test_groups_and_one_row_of_each_stays(docs, files_per_batch):
    found = exact_dedup.exact_duplicates(docs.repartition(4), F.col("doc_id"), files_per_batch=files_per_batch).collect()
    got = [(r.key, r.keeper.key, r.n) for r in found]
    assert sorted(got, key=str) == sorted(by_hand(ROWS), key=str)
    assert sum(r.kept for r in found) == len({t or "" for _, t in ROWS})
    assert all(r.key == r.keeper.key for r in found if r.kept)


def test_equal_digests_of_different_texts_are_told_apart(docs):
    """With the first letter as digest nearly everything collides; the full bytes decide."""
    weak = lambda text: F.coalesce(F.substring(text, 1, 1), F.lit(""))
    found = exact_dedup.exact_duplicates(docs, F.col("doc_id"), digest=weak).collect()
    assert sorted([(r.key, r.keeper.key, r.n) for r in found], key=str) == sorted(by_hand(ROWS), key=str)
    assert sum(r.kept for r in found) == len({t or "" for _, t in ROWS})


@pytest.mark.parametrize("weak", [False, True])
def test_a_second_feed_meets_the_state_of_the_first(spark, tmp_path, weak):
    """Three feeds into one folder: what has stayed stays, later copies go, whatever their keys; also where digests collide."""
    digest = (lambda text: F.coalesce(F.substring(text, 1, 1), F.lit(""))) if weak else exact_dedup.text_digest
    feeds = [[(5, "same"), (2, "same"), (1, "one"), (None, None)], [(9, "same"), (8, "some"), (3, "some"), (7, "")], [(4, "some"), (6, "one"), (10, "new"), (11, "oh")], []]
    stays, counts = {}, {}
    for i, feed in enumerate(feeds):
        spark.createDataFrame(feed, "doc_id long, text string").write.parquet(str(tmp_path / f"feed{i}"))
        docs = spark.read.parquet(str(tmp_path / f"feed{i}"))
        found = exact_dedup.exact_duplicates(docs, F.col("doc_id"), digest=digest, folder=str(tmp_path / "lasting")).collect()
        new = {}
        for key, text in feed:
            t = text or ""
            counts[t] = counts.get(t, 0) + 1
            if t not in stays:
                new[t] = max([k for k, x in feed if (x or "") == t], key=lambda k: (k is not None, k or 0))
        stays |= new
        want = [(key, stays[text or ""], counts[text or ""], new.get(text or "", "none") == key) for key, text in feed]
        assert sorted([(r.key, r.keeper.key, r.n, r.kept) for r in found], key=str) == sorted(want, key=str)


def test_hits_are_the_same_with_and_without_a_shuffle(spark):
    texts = spark.range(100).select(F.col("id").cast("string").alias("digest"))
    hits = texts.where("id % 7 = 0")
    a, b = (exact_dedup.only_hits(texts, hits, most).collect() for most in (1_000, 1))
    assert sorted(a) == sorted(b) and len(a) == 15


def test_empty_table(docs):
    assert exact_dedup.exact_duplicates(docs.where("false"), F.col("doc_id")).count() == 0


def test_query_is_its_twin(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries.QUERIES["op1_exact_dedup"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(queries.SQL["op1_exact_dedup"]).fetchall())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r.text_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in got)
