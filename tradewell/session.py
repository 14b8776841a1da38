"""Where intermediate tables live, and how a frame is cut from its lineage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

PARALLEL_TABLES = 8


def for_each_table(work: Mapping[str, Callable[[], T]]) -> dict[str, T | Exception]:
    """Run the jobs of independent tables at the same time; a failing one yields its exception.

    The job of a small table has too few tasks to fill a cluster, so several are submitted at once.
    """
    def attempt(job: Callable[[], T]) -> T | Exception:
        try:
            return job()
        except Exception as error:  # noqa: BLE001 - the caller records or raises it
            return error

    with ThreadPoolExecutor(max_workers=PARALLEL_TABLES) as pool:
        return dict(zip(work, pool.map(attempt, work.values())))


def all_or_raise(results: Mapping[str, T | Exception]) -> dict[str, T]:
    """The results when no table failed, else the first failure."""
    for result in results.values():
        if isinstance(result, Exception):
            raise result
    return dict(results)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else a folder of the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate").rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared root that nothing has used before."""
    return f"{shared_root(spark)}/tradewell/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and go on from the files, so a lost executor recomputes nothing before it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
