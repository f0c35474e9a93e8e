"""Semi-structured columns: read once into a variant, taken apart by path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def read_variant(df: DataFrame, column: str, status: str = "status") -> DataFrame:
    """The JSON text of a column as a variant, and whether it is ``ok``, ``missing`` (null or blank) or ``unreadable``.

    What cannot be read is null.
    """
    text = F.col(column)
    blank = text.isNull() | (F.trim(text) == "")
    read = F.when(~blank, F.try_parse_json(text))
    state = F.when(blank, "missing").when(read.isNull(), "unreadable").otherwise("ok")
    return df.withColumns({status: state, column: read})


def fields(df: DataFrame, column: str, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """Columns of a variant by path: name -> (path, type). A path that is not there, a JSON null, and a value that is
    not of the type and cannot be cast to it, all give null."""
    return df.withColumns({n: F.try_variant_get(column, path, kind) for n, (path, kind) in wanted.items()})


def _kind(schema: Column) -> Column:
    name = F.regexp_extract(schema, "^[A-Z]+", 0)
    number = name.isin("BIGINT", "DECIMAL", "DOUBLE", "INT", "FLOAT")
    return F.when(number, "number").otherwise(F.lower(name))


def shape(df: DataFrame, column: str) -> DataFrame:
    """What the objects of a variant column hold: key, kind of value, how often. One pass, added up in the tasks."""
    view = df.select(F.col(column).alias("v")).where("v is not null and schema_of_variant(v) like 'OBJECT%'")
    each = view.lateralJoin(view.sparkSession.tvf.variant_explode(F.col("v").outer())).select("key", "value")
    return each.groupBy("key", _kind(F.schema_of_variant("value")).alias("kind")).agg(F.count("*").alias("n"))


def schema_of(df: DataFrame, column: str) -> DataFrame:
    """The one schema that all values of a variant column fit."""
    return df.agg(F.schema_of_variant_agg(column).alias("schema"))
