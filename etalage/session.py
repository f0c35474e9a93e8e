"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIR: str | None = None


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on, and the adaptive ones skewed joins rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Split a hot join key even where that costs a shuffle before the step that follows.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one in local mode only."""
    global _LOCAL_DIR
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _LOCAL_DIR is None:
        _LOCAL_DIR = tempfile.mkdtemp(prefix="etalage-")
        atexit.register(shutil.rmtree, _LOCAL_DIR, ignore_errors=True)
    return _LOCAL_DIR


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    return f"{scratch_root(spark)}/etalage/{uuid.uuid4().hex[:12]}/{name}"


def write_through(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts lineage in a way that outlives lost executors, and freezes values that a
    recomputation could change (partition ids).
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(jobs: dict[str, Callable[[], object]], at_once: int = 4) -> dict[str, object]:
    """Run jobs that do not wait for each other a few at a time; the first error is raised."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        started = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in started.items()}


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Set runtime settings for the duration of a block (dots written as ``__``)."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
