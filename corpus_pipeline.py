"""The corpus pipeline: documents to token ids, in stages that each read what the one before wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etalage.llm import exact_dedup, mixing, quality, simhash
from etalage.llm.common import in_files, located, ready, without, word_count
from etalage.llm.queries import MIX_MOST, MIX_SHAPES, MIX_WEIGHTS, bpe_digests
from etalage.session import write_through


def by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    ready(spark)
    docs = in_files(docs)
    rows = located(docs, [F.col("text"), F.col("lang"), F.col("source")])
    judged = quality.quality(rows, {"_loc": F.col("_loc")})
    return without(docs, judged.where("not kept").select("_loc"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays: the largest id, then the last place."""
    ready(spark)
    docs = in_files(docs)
    found = exact_dedup.exact_duplicates(docs, F.col("doc_id"))
    return without(docs, found.where("not kept").select("_loc"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays: the smallest id, then the first place."""
    ready(spark)
    docs = in_files(docs)
    rows = located(docs, [F.col("doc_id"), F.col("text")])
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("_loc"))
    found = simhash.near_duplicates(rows, first)
    return without(docs, found.where("key <> component").select("key._loc"))


def in_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, as often as it takes them, in the order of training."""
    ready(spark)
    docs = in_files(docs)
    rows = located(docs, [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")])
    mixed = mixing.mix(
        located(docs, [F.col("doc_id"), F.col("source"), F.col("text")]),
        F.col("_loc"),
        F.col("source"),
        word_count(F.col("text")),
        MIX_WEIGHTS,
        MIX_SHAPES,
        MIX_MOST,
        order_by=F.col("doc_id"),
    )
    taken = mixed.where("copies > 0").join(rows.withColumnRenamed("_loc", "key"), "key")
    return mixing.in_order(taken, MIX_SHAPES).select("_doc.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document that is in the mix."""
    ready(spark)
    return bpe_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("by_rules", by_rules),
    ("exact", exact),
    ("near_dedup", near_dedup),
    ("in_mix", in_mix),
    ("tokens", tokens),
]

#: SQL can express neither the fingerprints' links nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written and read again."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
