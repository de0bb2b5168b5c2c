"""Session settings for jobs and tests, and the shared folder for stored steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def build_session(app: str = "tally", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling on; extra settings by keyword."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under ``spark.checkpoint.dir``.

    Only a local-master session (tests) that names no such folder gets a temporary
    one; on a cluster the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tally-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/tally/{purpose}-{uuid.uuid4().hex}"


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: later stages re-read files when an executor is lost, and all
    of them see the very same rows and partition numbers.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(jobs: Sequence[Callable[[], T]], at_once: int = 4) -> list[T]:
    """Run independent jobs at the same time, so that small ones do not wait for each other."""
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]
