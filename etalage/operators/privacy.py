"""Identity checks, pseudonyms, erasure and lineage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from etalage.functions.columns import age_years, flag, is_adult, salted_hash
from etalage.session import together, write_through


def age_check(labels: DataFrame, as_of: str) -> DataFrame:
    """Age from the birth date against the document's adult label."""
    adult = is_adult("birthdate", as_of)
    return labels.select(
        "file",
        age_years("birthdate", as_of).alias("age"),
        flag("is_adult").alias("labelled_adult"),
        (adult == flag("is_adult")).alias("agrees"),
    )


def verify_documents(labels: DataFrame, as_of: str) -> DataFrame:
    """Number format, expiry and age label of each document; score is the share of checks passed."""
    today = F.lit(as_of).cast("date")
    checks = {
        "number_ok": F.coalesce(F.col("doc_number").rlike("^ID[0-9]{7}$"), F.lit(False)),
        "not_expired": F.coalesce(F.col("expiry") >= today, F.lit(False)),
        "label_ok": F.coalesce(is_adult("birthdate", as_of) == flag("is_adult"), F.lit(False)),
    }
    passed = sum((F.col(c).cast("int") for c in list(checks)[1:]), F.col("number_ok").cast("int"))
    return (
        labels.withColumns(checks)
        .withColumn("score", passed / F.lit(len(checks)))
        .withColumn("status", F.when(F.col("score") == 1, "verified").otherwise("rejected"))
    )


def pseudonymize(customers: DataFrame, salt: str) -> DataFrame:
    """Salted hash for the id, year for the birth date, no name or contact.

    The salt must be secret and long: ids are small numbers, and without it they are found by counting up.
    """
    return customers.select(
        salted_hash("customer_id", salt).alias("pseudonym"),
        F.year("birthdate").alias("birth_year"),
        "country",
        "segment",
    )


def _marked(
    tables: dict[str, DataFrame], gone: DataFrame, key: str, children: dict[str, tuple[str, str]], name: str, keep: list[str] | None = None
) -> DataFrame | None:
    """Rows of a table with ``_gone`` (true or null), by its own key or by its parent's rows; None: nothing to go by."""
    df = tables[name].select(*keep) if keep else tables[name]
    if name in children:
        parent, column = children[name]
        above = _marked(tables, gone, key, children, parent)
        # A parent's column can repeat there; the child's rows must not.
        dead = above.where("_gone").select(column, "_gone").distinct()
    elif key in tables[name].columns:
        column, dead = key, gone.select(key, F.lit(True).alias("_gone"))
    else:
        return None
    return df.join(dead, column, "left").select(*[F.col(f"`{c}`") for c in df.columns], "_gone")


def erase(
    tables: dict[str, DataFrame],
    erased: DataFrame,
    key: str,
    children: dict[str, tuple[str, str]],
) -> dict[str, DataFrame]:
    """Tables without the erased keys.

    Tables carrying ``key`` lose its rows directly; ``children`` maps a table to (parent, column)
    for those that go with their parent's rows. Tables with neither stay as they are.
    """
    # Written once, so that every table is rid of the same keys.
    gone = write_through(erased.select(key).distinct(), "erased")
    kept = {}
    for name, df in tables.items():
        marked = _marked(tables, gone, key, children, name)
        kept[name] = df if marked is None else marked.where("_gone is null").drop("_gone")
    return kept


def _write_rest(marked: DataFrame, path: str) -> tuple[int, int]:
    """Write the rows that stay; rows before and after, counted as they pass on their way to the files."""
    seen = Observation()
    counted = marked.observe(seen, F.count(F.lit(1)).alias("before"), F.count_if(F.col("_gone").isNull()).alias("after"))
    counted.where("_gone is null").drop("_gone").write.mode("overwrite").parquet(path)
    return seen.get["before"], seen.get["after"]


def erase_to(
    tables: dict[str, DataFrame],
    erased: DataFrame,
    key: str,
    children: dict[str, tuple[str, str]],
    out: str,
) -> DataFrame:
    """Write the tables without the erased keys to ``out``, a folder each; rows before and after by table.

    One job a table, several tables at a time. The old folders are the caller's to delete, once the new ones are in use.
    """
    spark = erased.sparkSession
    gone = write_through(erased.select(key).distinct(), "erased")

    def job(name: str) -> Callable[[], tuple]:
        marked = _marked(tables, gone, key, children, name)
        if marked is None:
            marked = tables[name].withColumn("_gone", F.lit(None).cast("boolean"))
        return lambda: _write_rest(marked, f"{out}/{name}")

    counts = together({name: job(name) for name in tables})
    return spark.createDataFrame([(n, *c) for n, c in counts.items()], "table_name string, before long, after long")


FILE_LIST = "_files"


def erase_files(
    spark: SparkSession, folder: str, names: list[str], erased: DataFrame, key: str, children: dict[str, tuple[str, str]], out: str
) -> DataFrame:
    """Rid stored tables (folders of Parquet files) of keys, rewriting only the files that hold one.

    A first pass over the keys tells how many rows of which file go. Only those files are read whole and written
    anew, to ``out``; the others are kept as they lie. ``out`` lists the files that make up each table from now on
    (``stored`` reads it) and those they replace, for the caller to delete. Result: rows and files by table.
    """
    tables = {n: stored(spark, folder, n) for n in names}
    gone = write_through(erased.select(key).distinct(), "erased")

    def job(name: str) -> Callable[[], tuple]:
        columns = tables[name].columns
        column = children[name][1] if name in children else key
        if column not in columns:
            files = tables[name].groupBy(F.col("_metadata.file_path").alias("path"))
            return lambda: ([(r.path, r.n, 0) for r in files.agg(F.count("*").alias("n")).collect()], 0)
        placed = {**tables, name: tables[name].select("*", F.col("_metadata.file_path").alias("_path"))}
        marked = _marked(placed, gone, key, children, name, [column, "_path"])
        per_file = marked.groupBy("_path").agg(F.count("*").alias("n"), F.count("_gone").alias("n_gone"))

        def run() -> tuple:
            # A row for each file of the table.
            found = [tuple(r) for r in per_file.collect()]
            touched = [p for p, _, n_gone in found if n_gone]
            after = 0
            if touched:
                part = {**tables, name: spark.read.schema(tables[name].schema).parquet(*touched)}
                _, after = _write_rest(_marked(part, gone, key, children, name), f"{out}/{name}")
            return found, after

        return run

    done = together({name: job(name) for name in names})
    # Files of the new version, and those they replace.
    listed = [(n, p, bool(g)) for n, (found, _) in done.items() for p, _, g in found]
    written = spark.createDataFrame(listed, "table_name string, path string, replaced boolean")
    written.coalesce(1).write.mode("overwrite").parquet(f"{out}/{FILE_LIST}")
    rows = []
    for n, (found, after) in done.items():
        untouched = sum(m for _, m, g in found if not g)
        rows.append((n, sum(m for _, m, _ in found), untouched + after, len(found), sum(1 for *_, g in found if g)))
    return spark.createDataFrame(rows, "table_name string, before long, after long, files long, rewritten long")


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table: the files of its folder, and where ``erase_files`` has left a list the files it keeps."""
    try:
        listed = spark.read.parquet(f"{folder}/{FILE_LIST}")
    except AnalysisException:
        return spark.read.parquet(f"{folder}/{name}")
    mine = [(r.path, r.replaced) for r in listed.where(F.col("table_name") == name).collect()]
    kept = [p for p, replaced in mine if not replaced]
    return spark.read.parquet(*kept, *([f"{folder}/{name}"] if len(kept) < len(mine) or not mine else []))


def row_checksum(columns: list[str]) -> Column:
    """Order-free checksum: the sum over rows of 32 bits of the row's digest."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    return F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"))


def lineage(stages: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Rows and checksum of each stage, over the columns all stages share."""
    out = None
    for i, (name, df) in enumerate(stages.items()):
        part = df.agg(
            F.count("*").alias("rows"), F.coalesce(row_checksum(columns), F.lit(0)).alias("checksum")
        ).select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "rows", "checksum")
        out = part if out is None else out.unionByName(part)
    return out
