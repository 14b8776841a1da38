"""Writing tables: versions behind a view, logs by run, and a name-safe sync of staging to target."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Versions of a table that stay on disk: the published one and those that running readers may still hold.
KEPT_VERSIONS = 3
# How stored tables are compressed: row hashes, most of a narrow table, take about half the space of snappy's.
STORED_AS = "zstd"


def publish(df: DataFrame, name: str, root: str, *, keep: int = KEPT_VERSIONS, hidden: Sequence[str] = (),
            bucket_by: Sequence[str] = ()) -> DataFrame:
    """Replace a catalog table as a whole, schema included, without a moment in which it is missing.

    The frame is written to a folder of its own and one statement points the view ``name`` at it. So a
    table may be rebuilt from itself, a reader sees the old rows or the new ones and keeps reading the
    version it began with, and a failed write leaves the table as it was. The last ``keep`` versions
    stay. ``hidden`` columns are stored but not shown; with ``bucket_by`` the version is bucketed and
    sorted by these columns, so a join on them moves the other side only.
    """
    spark = df.sparkSession
    version = f"v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    folder = f"{root.rstrip('/')}/{name}"
    source = f"parquet.`{folder}/{version}`"
    if bucket_by:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        source = f"{name}_{version}"
        (df.repartition(buckets, *bucket_by).write.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
         .option("path", f"{folder}/{version}").option("compression", STORED_AS).format("parquet").saveAsTable(source))
    else:
        df.write.option("compression", STORED_AS).parquet(f"{folder}/{version}")
    shown = ", ".join(f"`{c}`" for c in df.columns if c not in hidden)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {shown} FROM {source}")
    _retire(spark, name, folder, keep)
    return spark.table(name)


def versions(spark: SparkSession, name: str, root: str) -> list[str]:
    """The complete versions of a published table on disk, oldest first."""
    return [p for p, complete in _listed(spark, f"{root.rstrip('/')}/{name}") if complete]


def stored(spark: SparkSession, name: str, root: str) -> DataFrame:
    """The published version with its hidden columns."""
    return spark.read.parquet(versions(spark, name, root)[-1])


def _listed(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = lambda p: files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
    return sorted((s.getPath().toString(), done(s.getPath())) for s in files.listStatus(path) if s.isDirectory())


def _retire(spark: SparkSession, name: str, folder: str, keep: int) -> None:
    """Remove what is older than the last ``keep`` complete versions, broken writes among it."""
    listed = _listed(spark, folder)
    complete = [p for p, done in listed if done]
    for path, _ in listed:
        if len(complete) > keep and path < complete[-keep]:
            spark.sql(f"DROP TABLE IF EXISTS {name}_{path.rpartition('/')[2]}")
            old = spark._jvm.org.apache.hadoop.fs.Path(path)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


# ---- logs ---------------------------------------------------------------------------------------

def append(df: DataFrame, path: str) -> None:
    """Add rows to a log; a column the log did not have yet widens it on the next read."""
    df.write.mode("append").parquet(path)


def append_run(df: DataFrame, path: str, run: str = "run_id") -> None:
    """Add the rows of one or more runs to a log; a run that is repeated replaces its own rows.

    Each run is a partition, named by the column ``run``. Only the partitions in the frame are
    written, nothing else is read or copied. A repeated run without rows leaves its earlier ones.
    """
    (df.withColumn("_run", F.col(run).cast("string")).hint("rebalance", F.col("_run")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("_run").parquet(path))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A log with the columns of all its writes, null where a write had none."""
    return spark.read.option("mergeSchema", True).parquet(path).drop("_run")


# ---- differences and sync -----------------------------------------------------------------------

def column_difference(a: DataFrame, b: DataFrame) -> set[str]:
    """Names that only one of two frames has."""
    return set(a.columns) ^ set(b.columns)


def row_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two frames has, the side, and how many copies more it has.

    Both sides go into one grouped union, where the right one counts as negative; copies of a row meet
    in the tasks that read them, so a hot row is one per task in the single shuffle. Nulls are alike.
    Columns are matched by name.
    """
    signed = a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1)))
    net = signed.groupBy(*[f"`{c}`" for c in a.columns]).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return net.select(*[f"`{c}`" for c in a.columns], F.when(F.col("_n") > 0, "left").otherwise("right").alias("side"),
                      F.abs("_n").alias("copies"))


def sync(staging: DataFrame, name: str, root: str) -> str:
    """Rebuild the target if it is missing or has other columns, else refill it by name.

    The target keeps its column order when the names agree. Types are not compared.
    """
    spark = staging.sparkSession
    if spark.catalog.tableExists(name):
        target = spark.table(name)
        if not column_difference(staging, target):
            publish(staging.select(*target.columns), name, root)
            return "REFILLED"
    publish(staging, name, root)
    return "REBUILT"
