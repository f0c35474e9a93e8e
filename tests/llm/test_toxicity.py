import math
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from etalage.llm import queries, toxicity
from tests.conftest import SF

BAD = ["vile", "rotten", "cursed", "wretched"]
PLAIN = "river stone walks under light paper seven green house morning table window quiet letter".split()


def document(draw, bad):
    sentences = [" ".join(draw.choice(PLAIN) for _ in range(8)).capitalize() for _ in range(draw.randint(3, 15))]
    if bad:
        at = draw.randrange(len(sentences))
        sentences[at] += " " + draw.choice(BAD) + draw.choice(["", "ness", "ly"])
    return ". ".join(sentences) + "."


@pytest.fixture(scope="module")
def labelled(spark):
    draw = random.Random(8)
    rows = [(i, document(draw, i % 6 == 0), int(i % 6 == 0)) for i in range(1200)]
    docs = spark.createDataFrame([(i, t, "clash", 0.5) for i, t, _ in rows], "doc_id long, text string, offending string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    return docs, labels


@pytest.fixture(scope="module")
def model(labelled):
    docs, labels = labelled
    return toxicity.train(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))


def test_held_out_documents(labelled, model):
    docs, labels = labelled
    out = docs.where(toxicity.held_out(F.col("doc_id")))
    rows = toxicity.score(out, model, keep=["doc_id", "text"]).join(labels.dropna(), "doc_id").collect()
    assert len(rows) > 200
    assert sum((r.score >= 0.3) == (r.toxic == 1) for r in rows) / len(rows) > 0.97
    for r in rows:
        if r.toxic and r.score >= 0.3:  # the sentence with the word is the one that is found
            assert any(any(w in r.text[x.start : x.end] for w in BAD) for x in r.offending)


def test_score_is_the_noisy_or_of_the_sentences(spark, model):
    text = "River stone. Vile house!\nRotten paper? \n . 12 34"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = toxicity.score(docs, model, offends=0.0).first()
    clean = 1.0
    for sentence in ["River stone", " Vile house", "Rotten paper"]:
        z = model.bias + sum(model.weights[i] for w in set(sentence.lower().split()) for i in toxicity.features(w))
        clean *= 1 - 1 / (1 + math.exp(-z))
    assert row.score == pytest.approx(1 - clean, rel=1e-5)
    assert [text[x.start : x.end].strip() for x in row.offending] == ["River stone", "Vile house", "Rotten paper"]


def test_training_is_repeatable(labelled, model):
    docs, labels = labelled
    again = toxicity.train(docs.repartition(7), labels.where(~toxicity.held_out(F.col("doc_id"))))
    assert again.bias == model.bias and (again.weights == model.weights).all()


def test_weights_follow_the_labels():
    """Buckets of the bad document gain weight, those of clean ones lose it, unseen ones keep none."""
    ids = pa.array([[1, 2], [3], [1, 3], [3]], pa.list_(pa.int32()))
    sizes = pa.array([[1, 1], [1], [1, 1], [1]], pa.list_(pa.int32()))
    table = pa.table({"label": [1, 0, 0, 0], "ids": ids, "sizes": sizes})
    fitted = toxicity.fit(table, {0: 0.75, 1: 0.25}, epochs=60, least_docs=1)
    assert fitted.weights[2] > fitted.weights[1] > fitted.weights[4] == 0 > fitted.weights[3]


def test_without_one_of_the_classes_every_score_is_zero(spark, labelled):
    docs, labels = labelled
    for kept in ("toxic = 0", "false"):
        silent = toxicity.train(docs, labels.where(kept))
        assert toxicity.score(docs.limit(5), silent).agg(F.max("score")).first()[0] == 0.0


def test_nulls_empties_repeats_long_texts_and_clashing_names(spark, model):
    rows = [(1, None), (2, ""), (None, "vile house"), (None, "vile house"), (4, "river. " * 50_000), (5, "x" * 200_000), (6, "İ ſ vile")]
    docs = spark.createDataFrame([(i, t, 0, "s") for i, t in rows], "doc_id long, text string, _text int, score string")
    found = toxicity.score(docs.drop("_text"), model)
    assert found.columns == ["doc_id", "score", "offending"]
    got = sorted(((r.doc_id or 0), 0 <= r.score <= 1) for r in found.collect())
    assert got == [(0, True), (0, True), (1, True), (2, True), (4, True), (5, True), (6, True)]
    assert found.where("doc_id <= 2").agg(F.max("score")).first()[0] == 0.0
    assert toxicity.score(docs.drop("_text").where("false"), model).count() == 0


def test_query(spark):
    found = queries.QUERIES["op10_toxicity"](spark, SF)
    rows = found.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_held_out_accuracy_on_a_larger_table(spark):
    folder = SF.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = queries.QUERIES["op10_toxicity"](spark, folder).where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert right / len(rows) > max(sum(r.toxic == 0 for r in rows) / len(rows), 0.85)
