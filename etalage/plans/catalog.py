"""All registered queries."""

from etalage.plans import (  # noqa: F401
    curation,
    files,
    fraud,
    marts,
    models,
    patterns,
    quality,
    reports,
    streams,
)
from etalage.plans.registry import COLUMNS, QUERIES, SQL, run

__all__ = ["COLUMNS", "QUERIES", "SQL", "run"]
