"""Registry of the queries, each with the SQL twin its result is compared with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etalage.domain import Shop
from etalage.plans.views import VIEWS

QUERIES: dict[str, Callable[[Shop], DataFrame]] = {}
COLUMNS: dict[str, str] = {}
SQL: dict[str, str] = {}

# Kinds in a column list: l whole number, s text, b boolean, m money, f double,
# r double rounded to six places, d date, t timestamp. Dates and timestamps are compared as text.
_SPARK = {
    "l": lambda c: F.col(c).cast("bigint"),
    "s": F.col,
    "b": F.col,
    "m": lambda c: F.col(c).cast("double"),
    "f": lambda c: F.col(c).cast("double"),
    "r": lambda c: F.round(F.col(c).cast("double"), 6),
    "d": lambda c: F.date_format(c, "yyyy-MM-dd"),
    "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
}
_SQL = {
    "l": "CAST({0} AS BIGINT)",
    "s": "{0}",
    "b": "{0}",
    "m": "CAST({0} AS DOUBLE)",
    "f": "CAST({0} AS DOUBLE)",
    "r": "round(CAST({0} AS DOUBLE), 6)",
    "d": "strftime(CAST({0} AS DATE), '%Y-%m-%d')",
    "t": "strftime(CAST({0} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')",
}


def _parse(columns: str) -> list[tuple[str, str]]:
    return [tuple(part.split(":")) for part in columns.split()]


def plain(df: DataFrame, columns: str) -> DataFrame:
    """Project to the declared columns in types both engines write alike."""
    return df.select(*[_SPARK[kind](name).alias(name) for name, kind in _parse(columns)])


def views_for(body: str) -> list[str]:
    """Names of the shop views a statement needs, each after those it builds on."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in found:
                visit(VIEWS[name])
                if name not in found:
                    found.append(name)

    visit(body)
    return found


def query(name: str, columns: str, sql: str | None = None):
    """Register a query by name, with its result columns and, where SQL can say it, the SQL."""

    def register(fn: Callable[[Shop], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        COLUMNS[name] = columns
        if sql is not None:
            needed = [f"{v} AS ({VIEWS[v]})" for v in views_for(sql)]
            picked = ", ".join(f"{_SQL[k].format(n)} AS {n}" for n, k in _parse(columns))
            ctes = ",\n".join([*needed, f"result_rows AS ({sql})"])
            SQL[name] = f"WITH {ctes}\nSELECT {picked} FROM result_rows"
        return fn

    return register


def run(name: str, spark: SparkSession, path: str) -> DataFrame:
    return plain(QUERIES[name](Shop(spark, path)), COLUMNS[name])
