"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from etalage.session import prepare, write_through

#: Fixed pattern: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """The package's settings, and batches to Python workers bounded in rows and bytes: texts can be long."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    return spark


def word_list(text: Column) -> Column:
    """The words of a text; no words for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(word_list(text)).cast("bigint")


def extended(schema: StructType, more: str) -> StructType:
    """A schema with the columns of ``more`` (DDL) after its own."""
    return StructType([*schema.fields, *StructType.fromDDL(more).fields])


def in_files(docs: DataFrame) -> DataFrame:
    """``docs`` itself where it comes straight from files, so that its rows have places; else a copy that
    is written to the shared folder. Places agree only between uses of one such table."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return write_through(docs, "documents")
    return docs


def located(docs: DataFrame, columns: list[Column]) -> DataFrame:
    """``columns`` of every row of a table from files and ``_loc``, the row's place: its file and its number
    in the file. A place names one row for good, also where ids repeat or are null."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return docs.select(*columns, place.alias("_loc"))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` less the rows whose places are in ``dropped``, with the columns of ``docs``."""
    rows = located(docs, [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")])
    return rows.join(dropped, "_loc", "left_anti").select("_doc.*")
