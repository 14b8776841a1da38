"""Profiles and checks of one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewell.config import TECHNICAL_COLUMNS

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC)]


def _total(column: str, dtype: T.DataType) -> str:
    """A sum that cannot depend on the order of rows: floats are added as decimals."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return f"CAST(sum(try_cast(`{column}` AS DECIMAL(28,6))) AS DOUBLE)"
    return f"CAST(sum(`{column}`) AS DOUBLE)"


def duplicate_keys(df: DataFrame, keys: list[str], among: Column | None = None) -> Column:
    """Rows minus distinct keys as a struct ``all`` and, of the rows where ``among`` holds, ``among``.

    Rows are counted per key first and the counts are added, so both come from one narrow shuffle of
    the keys, whose copies meet in the tasks that read them. Null keys count as a key like any other.
    """
    zero = F.lit(0).cast("bigint")
    if not keys:
        return F.struct(zero.alias("all"), zero.alias("among"))
    counted = F.count_if(among) if among is not None else F.count(F.lit(1))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), counted.alias("_among"))
    extra = [F.coalesce(F.sum(F.greatest(F.col(c) - 1, zero)), zero).alias(n) for c, n in (("_rows", "all"), ("_among", "among"))]
    return per_key.agg(F.struct(*extra)).scalar()


def null_count(column: str) -> Column:
    return F.expr(f"count_if(`{column}` IS NULL)")


def null_counts(df: DataFrame, skip_technical: bool = True) -> DataFrame:
    """Per column with nulls, how many and what percentage of all rows."""
    columns = [c for c in df.columns if not (skip_technical and c in TECHNICAL_COLUMNS)]
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[null_count(c).alias(c) for c in columns])
    tall = one.select("_rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])).alias("n"))
    pct = F.round(F.col("n.null_count") / F.col("_rows") * 100, 2)
    return tall.where("n.null_count > 0").select("n.column_name", "n.null_count", pct.alias("null_pct"))


def numeric_profile(df: DataFrame) -> DataFrame:
    """Sum, smallest and largest of every numeric column, as one row per column."""
    columns = numeric_columns(df)
    parts = []
    for c in columns:
        parts += [F.expr(_total(c, df.schema[c].dataType)).alias(f"{c}_sum"),
                  F.min(c).cast("double").alias(f"{c}_min"), F.max(c).cast("double").alias(f"{c}_max")]
    if not parts:
        return df.sparkSession.createDataFrame([], "column_name string, total double, smallest double, largest double")
    tall = df.agg(*parts).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_sum").alias("total"),
                 F.col(f"{c}_min").alias("smallest"), F.col(f"{c}_max").alias("largest")) for c in columns])).alias("p"))
    return tall.select("p.*")


def source_profile(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, duplicate keys, null keys, null counts of all columns, numeric aggregates.

    One aggregate over all columns, which needs no shuffle of rows, and one over the keys alone.
    """
    keys = [k for k in keys if k in df.columns]
    numbers = numeric_columns(df)
    types = {f.name: f.dataType for f in df.schema}
    nulls = ", ".join(f"count_if(`{c}` IS NULL) AS `{c}`" for c in df.columns)
    required = " + ".join(f"count_if(`{k}` IS NULL)" for k in keys) or "CAST(0 AS BIGINT)"
    sums = [f"{_total(c, types[c])} AS `{c}_sum`" for c in numbers]
    edges = [f"CAST({f}(`{c}`) AS DOUBLE) AS `{c}_{f}`" for c in numbers for f in ("min", "max")]
    aggregates = f"to_json(struct({', '.join([*sums, *edges])}))" if numbers else "'{}'"
    row = df.agg(
        F.count(F.lit(1)).alias("row_count"), F.expr(required).alias("null_keys"),
        F.expr(f"to_json(struct({nulls}))").alias("nulls_json"), F.expr(aggregates).alias("aggregates_json"))
    return row.select("row_count", duplicate_keys(df, keys)["all"].alias("duplicates"), "null_keys", "nulls_json", "aggregates_json")


def counts_by_source(df: DataFrame) -> DataFrame:
    """All and current rows of each source, largest first."""
    current = F.count_if("is_current") if "is_current" in df.columns else F.count(F.lit(1))
    return df.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("all_rows"), current.alias("current_rows")).orderBy(F.desc("all_rows"), "source_system")
