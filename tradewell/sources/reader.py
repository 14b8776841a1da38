"""Reading landed tables: columnar folders, JSON trees, catalog tables, and choosing among them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewell.config import API_PREFIX, COLUMN_TYPES, EXCEL_PREFIX, TABLE_ALIASES
from tradewell.operators.clean import cast_columns, drop_feed_metadata
from tradewell.sources.pages import read_pages


def read_columnar(spark: SparkSession, path: str) -> DataFrame:
    """Columnar files only, so a folder of another format reads as absent rather than as broken."""
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(path)


def unwrap_value(df: DataFrame) -> DataFrame:
    """One row per record of the ``value`` array, if the frame is an envelope."""
    if "value" in df.columns and isinstance(df.schema["value"].dataType, T.ArrayType):
        df = df.select(F.explode("value").alias("r")).select("r.*")
    return drop_feed_metadata(df)


def read_json_tree(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Line-delimited JSON anywhere under a folder, envelopes unwrapped."""
    reader = spark.read.option("recursiveFileLookup", True)
    return unwrap_value((reader.schema(schema) if schema else reader).json(path))


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One multi-line JSON document per file. A folder of concatenated pages needs ``read_pages``."""
    reader = spark.read.option("multiLine", True)
    return unwrap_value((reader.schema(schema) if schema else reader).json(path))


def read_json_feed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """S04 or S02: a folder of pages is read page by page, one of plain records line by line.

    Pages give the configured types, and text for fields without one.
    """
    plain = spark.read.option("recursiveFileLookup", True).json(path)
    enveloped = "value" in plain.columns and isinstance(plain.schema["value"].dataType, T.ArrayType)
    if enveloped or plain.columns == ["_corrupt_record"]:
        records = drop_feed_metadata(read_pages(spark, path, require_rows=False))
        return cast_columns(records, COLUMN_TYPES.get(table, {}))
    return drop_feed_metadata(plain)


def first_readable(attempts: Iterable[Callable[[], DataFrame]]) -> DataFrame | None:
    """The first source that exists. Only "not there" and "not this format" are passed over."""
    for attempt in attempts:
        try:
            df = attempt()
        except AnalysisException:
            continue
        if df.columns:
            return df
    return None


def spellings(table: str) -> list[str]:
    """The names under which a table may have been landed, in order of preference."""
    other = [raw for raw, name in TABLE_ALIASES.items() if name == table]
    names = [table, *other]
    return list(dict.fromkeys([*names, *[n.lower() for n in names]]))


def resolve(spark: SparkSession, root: str, table: str, feed: str = "API") -> DataFrame | None:
    """Catalog table, then columnar folder, then JSON folder, for every spelling."""
    prefix = EXCEL_PREFIX if feed == "Excel" else API_PREFIX
    attempts: list[Callable[[], DataFrame]] = []
    for name in spellings(table):
        landed, path = f"{prefix}{name}", f"{root.rstrip('/')}/{prefix}{name}"
        attempts.append(lambda landed=landed: drop_feed_metadata(spark.table(landed)))
        attempts.append(lambda path=path: drop_feed_metadata(read_columnar(spark, path)))
        attempts.append(lambda path=path: read_json_feed(spark, path, table))
    return first_readable(attempts)
