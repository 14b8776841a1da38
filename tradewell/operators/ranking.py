"""Numbering, winners and top-n without windows that gather a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


ROWS_A_RANGE = 1_000_000
SAMPLED_A_RANGE = 100


def number_rows(df: DataFrame, key: str, by: str, rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """1..n in the order of ``by``, as a new first column ``key``; nothing is written on the way.

    The rows' order is (``by``, a hash of the row). Bounds from a sample cut it into ranges of about
    ``rows_a_range``, and one count says how many rows lie before each. A row's number is that plus its
    place in its range, which one task sorts. The sample only says where ranges begin, so numbers do
    not depend on it; its size and the driver's part follow the number of ranges.
    """
    df = df.withColumn("_at", F.struct(F.col(by).isNotNull().alias("known"), F.col(by).alias("by"), F.xxhash64(*df.columns).alias("row")))
    n = df.count()
    ranges = 1 + n // rows_a_range
    bounds = _bounds(df, ranges, n) if ranges > 1 else []
    if not bounds:
        return df.select(F.row_number().over(W.orderBy("_at")).cast("bigint").alias(key), *[c for c in df.columns if c != "_at"])
    ranged = df.withColumn("_cuts", _constant(df, bounds, df.schema["_at"].dataType)).withColumn(
        "_range", F.size(F.filter("_cuts", lambda cut: cut <= F.col("_at")))).drop("_cuts")
    sizes = dict(ranged.groupBy("_range").count().collect())
    before = [sum(sizes.get(k, 0) for k in range(r)) for r in range(len(bounds) + 1)]
    place = F.row_number().over(W.partitionBy("_range").orderBy("_at"))
    numbered = ranged.withColumn(key, place + F.get(_constant(df, before, T.LongType()), F.col("_range")))
    return numbered.select(F.col(key).cast("bigint"), *[c for c in df.columns if c != "_at"])


def _constant(df: DataFrame, values: list, kind: T.DataType) -> Column:
    """A list as one value of a plan, however long."""
    return df.sparkSession.createDataFrame([(values,)], T.StructType([T.StructField("v", T.ArrayType(kind))])).scalar()


def _bounds(df: DataFrame, ranges: int, n: int) -> list:
    """Where ranges of about equal size begin."""
    share = min(1.0, ranges * SAMPLED_A_RANGE / n)
    sampled = [r["_at"] for r in df.select("_at").sample(share, seed=1).orderBy("_at").collect()]
    return list(dict.fromkeys(sampled[len(sampled) * i // ranges] for i in range(1, ranges))) if sampled else []


def top_with_ties(df: DataFrame, measure: str, n: int, largest: bool = True) -> DataFrame:
    """The n first rows by a measure and every row that ties with the last of them.

    The n-th value is found by a distributed top-n and used as a threshold, so no rank over the
    whole frame is needed and ties are never cut.
    """
    value = F.coalesce(F.col(measure), F.lit(0))
    ordered = df.select(value.alias("_v")).orderBy(F.desc("_v") if largest else F.asc("_v")).limit(n)
    edge = ordered.agg((F.min if largest else F.max)("_v").alias("_edge")).scalar()
    return df.where(value >= edge if largest else value <= edge)


def _blank_as_zero(measure: Column | str) -> Column:
    return F.coalesce(F.col(measure) if isinstance(measure, str) else measure, F.lit(0))


def _candidate(value: Column, label: str | Column, where: Column | None) -> Column:
    entry = F.struct(value.alias("value"), (F.col(label) if isinstance(label, str) else label).alias("label"))
    return entry if where is None else F.when(where, entry)


def winner_largest_label(measure: str, label: str | Column, where: Column | None = None) -> Column:
    """T02 n=1 read through a maximum: best measure, and among ties the largest label."""
    return F.max(_candidate(_blank_as_zero(measure), label, where))


def winner_smallest_label(measure: str, label: str | Column, where: Column | None = None) -> Column:
    """Best measure, ties broken by the smallest label. ``value`` holds the negated measure."""
    return F.min(_candidate(-_blank_as_zero(measure), label, where))


def winner_or_blank(measure: Column | str, label: str | Column, largest: bool = True, where: Column | None = None) -> Column:
    """T02 n=1 read as the selected value: the label of the best measure, null when several tie."""
    sign = _blank_as_zero(measure) if largest else -_blank_as_zero(measure)
    high = F.max(_candidate(sign, label, where))["label"]
    low = F.min(_candidate(-sign, label, where))["label"]
    return F.when(high.eqNullSafe(low), high)


def single_value(column: Column | str, default: Column | None = None) -> Column:
    """The value if the group holds exactly one, else a default."""
    c = F.col(column) if isinstance(column, str) else column
    one = F.min(c).eqNullSafe(F.max(c)) & (F.count(c) == F.count(F.lit(1)))
    return F.when(one, F.max(c)).otherwise(F.lit(None) if default is None else default)
