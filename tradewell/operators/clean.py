"""Cleaning and shaping of one table. Every function is one projection or one aggregation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewell.config import (HASH_NULL, HASH_SEPARATOR, TECHNICAL_COLUMNS, UNKNOWN_TEXT, Entity)
from tradewell.functions.dates import DATE_TEXT, date_texts, parse_timestamp
from tradewell.functions.text import clean_names


def _map_columns(df: DataFrame, change: dict[str, Column]) -> DataFrame:
    """Replace some columns in a single projection."""
    return df.select(*[change[c].alias(c) if c in change else f"`{c}`" for c in df.columns])


def _of_type(df: DataFrame, *types: type) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, types)]


def sanitise_names(df: DataFrame) -> DataFrame:
    """P01."""
    return df.toDF(*clean_names(df.columns))


def nan_to_null(df: DataFrame) -> DataFrame:
    """P02."""
    floats = _of_type(df, T.DoubleType, T.FloatType)
    return _map_columns(df, {c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def with_default(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Add a column unless the table brings its own."""
    return df if column in df.columns else df.withColumn(column, value)


def drop_feed_metadata(df: DataFrame, prefix: str = "@odata") -> DataFrame:
    """P04."""
    return df.select(*[f"`{c}`" for c in df.columns if not c.startswith(prefix)])


def project(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Exactly these columns; one the table lacks becomes null text."""
    have = set(df.columns)
    return df.select(*[c if c in have else F.lit(None).cast("string").alias(c) for c in columns])


def align_types(df: DataFrame, like: DataFrame) -> DataFrame:
    """Take over the types of another frame; a value that does not fit becomes null."""
    target = {f.name: f.dataType for f in like.schema}
    return _map_columns(df, {
        f.name: F.col(f.name).try_cast(target[f.name])
        for f in df.schema if f.name in target and f.dataType != target[f.name]
    })


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast rules of one table, unfit values become null."""
    return _map_columns(df, {c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def trim_text(df: DataFrame) -> DataFrame:
    """Trimmed, and blank text is null."""
    return _map_columns(df, {c: F.expr(f"nullif(trim(`{c}`), '')") for c in _of_type(df, T.StringType)})


def parse_dates(df: DataFrame) -> DataFrame:
    """P10 + P11: text in date-like columns becomes timestamps."""
    return _map_columns(df, {c: parse_timestamp(F.col(c)) for c in date_texts(df.schema)})


def dates_as_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Configured date columns in one text form, so both feeds hash alike."""
    change = {}
    for name in columns:
        if "date" in name.lower() and name in df.columns:
            text = isinstance(df.schema[name].dataType, T.StringType)
            stamp = F.try_to_timestamp(name) if text else F.col(name).cast("timestamp")
            change[name] = F.date_format(stamp, DATE_TEXT)
    return _map_columns(df, change)


def fill_text(df: DataFrame) -> DataFrame:
    """Null text reads ``Unknown``, technical and provenance columns excepted."""
    names = [c for c in _of_type(df, T.StringType)
             if c not in TECHNICAL_COLUMNS and not c.startswith("source_")]
    return _map_columns(df, {c: F.coalesce(c, F.lit(UNKNOWN_TEXT)) for c in names})


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """F01."""
    present = [k for k in keys if k in df.columns]
    return df.dropna(how="any", subset=present) if present else df


def dedup(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key, the first by ``order_by`` and then by all other columns.

    The order is total, so the survivor does not depend on how rows are spread. Keeping only rank 1
    lets Spark drop all but the first copy of a key inside each map task, before the shuffle: a hot
    key sends one row per task. History tables keep every version.
    """
    if not keys or "is_current" in df.columns:
        return df
    first = [c for c in (order_by or []) if c not in keys]
    rest = first + [c for c in df.columns if c not in keys and c not in first]
    if not rest:
        return df.distinct()
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*rest))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def hash_text(column: str, dtype: T.DataType) -> Column:
    """The text of one value inside a row hash; floats go through a decimal so 0.0, -0.0 and 1e7 print alike.

    ``column`` is an SQL reference, quoted where its name needs it.
    """
    text = f"CAST({column} AS STRING)"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = f"CAST(try_cast({column} AS DECIMAL(38,10)) AS STRING), {text}"
    return F.expr(f"coalesce({text}, '{HASH_NULL}')")


def row_hash(df: DataFrame, columns: list[str], at: Mapping[str, str] | None = None) -> Column:
    """SHA-256 over the joined text of the columns, in the given order.

    ``at`` says where a column of ``df`` is found in another frame that holds its values.
    """
    places = at or {c: f"`{c}`" for c in df.columns}
    parts = [hash_text(places[c], df.schema[c].dataType) for c in columns if c in df.columns]
    joined = F.concat_ws(HASH_SEPARATOR, *parts) if parts else F.lit("EMPTY_RECORD")
    return F.sha2(joined, 256)


def clean_table(df: DataFrame, keys: list[str], run_ts: datetime | str | None = None) -> DataFrame:
    """The whole cleaning chain of a freshly landed table."""
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    df = dedup(drop_null_keys(trim_text(df), keys), keys)
    return fill_text(with_default(parse_dates(df), "ingested_at", stamp))


def prepare_feed(df: DataFrame, entity: Entity) -> DataFrame:
    """What both feeds go through before they are merged: P04, P05, P12, D01."""
    shaped = project(drop_feed_metadata(df), entity.business_columns)
    return dedup(dates_as_text(shaped, entity.columns), entity.keys)
