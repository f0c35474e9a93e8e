"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of its distinct words,
each seen as the whole word and as its first letters, so that inflected and compound forms share
what is learned; the document's is their noisy-or, 1 - prod(1 - p): one bad sentence is enough. Only documents are
labelled, so the sentence weights are learned through the noisy-or, and then tell which sentences
offend.

Null and empty texts have no sentence and score 0. Labels that are null, and labels of a null id,
are not learned from; of several labels of one id the largest counts. Without any label of either
class every score is 0. Rows are scored one by one, so copies and null ids get a score as well; an
empty table stays empty.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.llm.common import extended
from etalage.session import write_through

#: Fixed patterns: a sentence ends at a full stop, a mark or a line end; a word is a run of letters.
SENTENCE = r"[^.!?\n]+"
LETTERS = r"[^\W\d_]+"
BUCKETS = 1 << 18
#: Lengths of the word beginnings that are features.
PREFIXES = (4, 5, 6, 7, 8)


@dataclass
class Model:
    """A weight for each hash bucket of words and beginnings, and the offset of a sentence's score."""

    weights: np.ndarray
    bias: float


def features(word: str) -> list[int]:
    """Hash buckets of a word in lower case: itself, and its beginnings if it is longer."""
    parts = [f"{word} ", *[word[:n] for n in PREFIXES if len(word) >= n]]
    return [zlib.crc32(x.encode()) & (BUCKETS - 1) for x in parts]


def bags(docs: DataFrame, label: str, text: str) -> DataFrame:
    """label, place (a hash of the text, to put rows in an order), the buckets of the distinct words of each
    sentence one after the other, and their numbers."""
    rows = docs.select(
        F.col(label).cast("int").alias("label"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.xxhash64(text).alias("place"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentences, words = re.compile(SENTENCE).findall, re.compile(LETTERS).findall
        for batch in batches:
            ids, sizes = [], []
            for doc in batch.column(1).to_pylist():
                own = [[i for w in sorted(set(words(s.lower()))) for i in features(w)] for s in sentences(doc)]
                own = [x for x in own if x]
                ids.append([i for x in own for i in x])
                sizes.append([len(x) for x in own])
            kind = pa.list_(pa.int32())
            columns = [batch.column(0), batch.column(2), pa.array(ids, kind), pa.array(sizes, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "place", "ids", "sizes"])

    return rows.mapInArrow(run, "label int, place long, ids array<int>, sizes array<int>")


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as slices of its own buffers."""
    out: list[np.ndarray] = []
    for chunk in column.chunks:
        values, offsets = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        out += [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return out


def fit(
    bagged: pa.Table,
    share: dict[int, float],
    epochs: int = 15,
    rate: float = 0.3,
    shrink: float = 1e-4,
    per_step: int = 128,
    least_docs: int = 3,
) -> Model:
    """Noisy-or logistic regression by stochastic gradient steps scaled by past gradients.

    ``share`` is each class's share of all labels; rows are weighted so that the classes count in
    these shares however many of each were drawn. A bucket counts by how unevenly it is spread over
    the classes (the log of the ratio of its document rates), and one of fewer than ``least_docs``
    documents not at all: few labels then go a long way. The same rows in the same order give the
    same model.
    """
    ids, sizes = _lists(bagged.column("ids")), _lists(bagged.column("sizes"))
    label = bagged.column("label").to_numpy().astype(np.int64)
    used = np.array([i for i, x in enumerate(sizes) if len(x)], np.int64)
    weights, bias = np.zeros(BUCKETS), -6.0
    drawn = {c: float((label[used] == c).sum()) for c in (0, 1)}
    if not drawn[0] or not drawn[1]:
        return Model(weights, -1e9)
    factor = np.array([share[c] * len(used) / drawn[c] for c in (0, 1)])
    seen = np.zeros((2, BUCKETS))
    for i in used:
        seen[label[i], np.unique(ids[i])] += 1
    rates = [np.log((seen[c] + 1) / (drawn[c] + 2)) for c in (0, 1)]
    scale = np.where(seen.sum(axis=0) >= least_docs, np.abs(rates[1] - rates[0]), 0.0)
    past, past_bias = np.full(BUCKETS, 1e-8), 1e-8
    shuffled = np.random.default_rng(7)
    for _ in range(epochs):
        order = shuffled.permutation(used)
        for at in range(0, len(order), per_step):
            own = order[at : at + per_step]
            words = np.concatenate([ids[i] for i in own])
            size = np.concatenate([sizes[i] for i in own])
            count = np.array([len(sizes[i]) for i in own])
            z = np.add.reduceat(weights[words] * scale[words], np.cumsum(size) - size) + bias
            total = np.add.reduceat(np.logaddexp(0, z), np.cumsum(count) - count)  # -log of no sentence being bad
            y = label[own]
            slope = np.where(y == 1, -1 / np.maximum(np.expm1(np.minimum(total, 50)), 1e-6), 1.0) * factor[y]
            by_sentence = np.repeat(slope, count) / (1 + np.exp(-z))
            touched, where = np.unique(words, return_inverse=True)
            grad = np.bincount(where, weights=np.repeat(by_sentence, size)) * scale[touched] / len(own)
            grad += shrink * weights[touched]
            past[touched] += grad**2
            weights[touched] -= rate * grad / np.sqrt(past[touched])
            grad = by_sentence.sum() / len(own)
            past_bias += grad**2
            bias -= rate * grad / math.sqrt(past_bias)
    return Model(weights * scale, bias)


def train(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 6000,
    key: str = "doc_id",
    label: str = "toxic",
    text: str = "text",
    class_chars: int = 40_000_000,
) -> Model:
    """Fit on at most ``per_class`` labelled documents of each class, drawn by a hash of the id, and of these on the
    first that have ``class_chars`` characters together.

    The bounds are on what goes to the driver: word buckets of the drawn rows. Of the rows that share an id one is drawn.
    Class shares are counted over all labels.
    """
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(label).cast("int").alias("_label"))
    )
    counts = {int(r["_label"]): r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    all_labels = max(sum(counts.values()), 1)
    share = {c: counts.get(c, 0) / all_labels for c in (0, 1)}
    order = [F.xxhash64("_key"), F.col("_key")]
    drawn = known.where("_label = 0").orderBy(*order).limit(per_class).unionAll(
        known.where("_label = 1").orderBy(*order).limit(per_class)
    )
    # At most 2 x per_class rows of two numbers.
    picked = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(drawn), "_key")
    # One row an id; the choice must be the same on every run.
    single = F.min_by("_text", F.struct(F.xxhash64("_text"), F.length("_text")))
    picked = write_through(picked.groupBy("_key", "_label").agg(single.alias("_text")), "drawn")
    upto = Window.partitionBy("_label").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sizes = picked.select("_key", "_label", F.coalesce(F.length("_text"), F.lit(0)).alias("_size"))
    fitting = sizes.withColumn("_upto", F.sum("_size").over(upto)).where(F.col("_upto") <= class_chars).select("_key")
    bagged = bags(picked.join(F.broadcast(fitting), "_key"), "_label", "_text").toArrow()
    return fit(bagged.sort_by([("label", "ascending"), ("place", "ascending")]), share)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, offends: float = 0.3) -> DataFrame:
    """The columns ``keep`` (all but the text if not given), ``score``, and ``offending``: the sentences that
    score ``offends`` or more, as start and end (code points, end excluded) with their score.

    The model, whose size is fixed, goes to the tasks with the function.
    """
    made = ["score", "offending"]
    keep = [c for c in docs.columns if c not in (text, *made)] if keep is None else keep
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    # Weights travel at half the width; unseen buckets weigh nothing.
    weights, bias = model.weights.astype(np.float32), model.bias
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentences, words = re.compile(SENTENCE).finditer, re.compile(LETTERS).findall
        weight: dict[str, float] = {}
        for batch in batches:
            scores, found = [], []
            for doc in batch.column(len(keep)).to_pylist():
                clean, bad = 0.0, []  # log of the chance that no sentence is bad
                for m in sentences(doc):
                    own = set(words(m[0].lower()))
                    if not own:
                        continue
                    z = bias
                    for w in own:
                        x = weight.get(w)
                        if x is None:
                            if len(weight) > 500_000:
                                weight.clear()
                            x = weight[w] = float(sum(weights[i] for i in features(w)))
                        z += x
                    if z > -40:
                        clean -= math.log1p(math.exp(z)) if z < 30 else z
                        p = 1 / (1 + math.exp(-z))
                        if p >= offends:
                            bad.append({"start": m.start(), "end": m.end(), "score": p})
                scores.append(-math.expm1(clean))
                found.append(bad)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array(found, span)], names=[*keep, *made])

    schema = extended(rows.drop("_text").schema, "score double, offending array<struct<start:int,end:int,score:double>>")
    return rows.mapInArrow(run, schema)


def held_out(key: Column) -> Column:
    """Whether a document's label is kept from training: CRC-32 of its id as text, modulo 4, is 2. No id: no."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))
