"""File sources and sinks: declared-schema scans, conversion, layered tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from etalage.operators import fraud, marts, reports
from etalage.schemas import FILE_NAMES, FILES

CORRUPT = "_corrupt"
BAD = "_bad"


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV with a header, columns taken by name and typed as declared; nothing is inferred.

    ``_corrupt`` has a line that does not have the header's columns, ``_bad`` the names of the cells that
    are not of their type. A missing column is an error, and so are files whose headers differ.
    """
    names = spark.read.option("header", True).csv(path).columns
    missing = [c for c in FILES[table].names if c not in names]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    as_text = StructType([StructField(c, StringType()) for c in [*names, CORRUPT]])
    lines = (
        spark.read.schema(as_text)
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in FILES[table].fields}
    bad = [F.when(F.col(f"`{c}`").isNotNull() & t.isNull(), F.lit(c)) for c, t in typed.items()]
    return lines.select(
        *[t.alias(c) for c, t in typed.items()],
        CORRUPT,
        F.filter(F.array(*bad), lambda c: c.isNotNull()).alias(BAD),
    )


def read_jsonl(spark: SparkSession, path: str, table: str = "events") -> DataFrame:
    """JSON lines; a line that does not parse is kept in the ``_corrupt`` column."""
    schema = StructType(FILES[table].fields + [StructField(CORRUPT, StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_checked(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """All lines of an input file, the broken ones too, with ``_corrupt`` and ``_bad``."""
    name = FILE_NAMES[table]
    if name.endswith(".jsonl"):
        return read_jsonl(spark, f"{folder}/{name}", table).withColumn(BAD, F.array().cast("array<string>"))
    return read_csv(spark, f"{folder}/{name}", table)


def is_good() -> Column:
    return F.col(CORRUPT).isNull() & (F.size(BAD) == 0)


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.where(is_good()).drop(CORRUPT, BAD)


def read_input(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The good rows of an input file; :func:`read_checked` has the others."""
    return good_rows(read_checked(spark, folder, table))


def write_input(df: DataFrame, folder: str, table: str) -> None:
    """Write a table in the form its input file has."""
    name = FILE_NAMES[table]
    writer = df.select(FILES[table].names).write.mode("overwrite")
    if name.endswith(".jsonl"):
        writer.json(f"{folder}/{name}")
    else:
        writer.option("header", True).csv(f"{folder}/{name}")


def convert_to_parquet(
    spark: SparkSession, folder: str, out: str, tables: list[str] | None = None
) -> dict[str, int]:
    """Convert every input file that exists to Parquet; absent files are passed over.

    Broken lines and lines with bad cells go to ``<table>_rejects``. Returns the rejects of each table.
    """
    done = {}
    for table in tables or list(FILES):
        try:
            checked = read_checked(spark, folder, table)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        good_rows(checked).write.mode("overwrite").parquet(f"{out}/{table}")
        rejects = refresh(checked.where(~is_good()), out, f"{table}_rejects")
        done[table] = rejects.count()
    return done


def refresh(df: DataFrame, folder: str, table: str) -> DataFrame:
    """Truncate-and-load: replace the table and read it back."""
    path = f"{folder}/{table}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_layer(
    df: DataFrame, root: str, layer: str, table: str, by: str | None = None, spread: list | None = None
) -> DataFrame:
    """Replace one table of the bronze, silver or gold layer.

    With ``by`` the table is partitioned; ``spread`` names further columns rows are placed by, so
    that a partition holding much of the data is written by several tasks.
    """
    path = f"{root}/{layer}/{table}"
    if by:
        df = df.repartitionByRange(by, *(spread or []))
        df.write.mode("overwrite").partitionBy(by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_partitions(spark: SparkSession, path: str, by: str, before: str) -> list[str]:
    """Delete the partitions of a table whose value is below ``before``, without reading a row of them.

    ``by`` is a calendar column (day, month), so the list of its values is short. Returns those dropped.
    """
    values = spark.read.parquet(path).select(F.col(by).cast("string").alias("value")).distinct()
    gone = sorted(r["value"] for r in values.where(F.col("value") < before).collect())
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for value in gone:
        folder = hadoop.Path(f"{path}/{by}={value}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return gone


def write_gold(
    lake: str,
    orders: DataFrame,
    products: DataFrame,
    sales: DataFrame,
    alerts: DataFrame,
) -> dict[str, DataFrame]:
    """The aggregate tables of the gold layer, from silver tables."""
    gold = {
        "daily_revenue": reports.daily_revenue(orders),
        "top_products": reports.top_products(products, sales),
        "fraud_stats": fraud.daily_stats(alerts),
        "customer_lifetime_value": marts.lifetime_value(orders),
    }
    return {name: write_layer(df, lake, "gold", name) for name, df in gold.items()}


def topic_of(event_type: str | Column, topics: dict[str, str]) -> Column:
    c = F.col(event_type) if isinstance(event_type, str) else event_type
    pairs = [F.lit(x) for kv in topics.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), c), F.lit("unrouted"))


def read_external(spark: SparkSession, format: str, **options: str) -> DataFrame:
    """Any other batch source (``jdbc``, ``mongodb``, ``kafka``); its jar must be on the class path."""
    return spark.read.format(format).options(**options).load()


def write_external(df: DataFrame, format: str, mode: str = "append", **options: str) -> None:
    df.write.format(format).mode(mode).options(**options).save()
