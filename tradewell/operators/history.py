"""Two-source history: stamps, the merge in one join, and its counts."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewell.config import API, BASELINE_START, EXCEL, TECHNICAL_COLUMNS, Entity
from tradewell.operators.clean import align_types, row_hash

# Order of the columns that a version carries after its business columns.
VERSION_COLUMNS = ["source_system", "effective_start", "effective_end", "is_current", "created_at",
                   "modified_at", "operation", "row_hash"]


def timestamp(value: datetime | str) -> Column:
    return F.lit(value).cast("timestamp")


def _version(source: str, start: Column, operation: str, end: Column | None = None,
             modified: Column | None = None) -> list[Column]:
    """Technical columns of one version; a version with an end is closed."""
    return [
        F.lit(source).alias("source_system"), start.alias("effective_start"),
        (F.lit(None).cast("timestamp") if end is None else end).alias("effective_end"),
        F.lit(end is None).alias("is_current"), start.alias("created_at"),
        (start if modified is None else modified).alias("modified_at"), F.lit(operation).alias("operation")]


def stamp(df: DataFrame, source: str, start: datetime | str, operation: str, hashed: list[str] | None = None,
          run_id: str | None = None) -> DataFrame:
    """P15 + P16: every row as a first, current version. Hashed: the given columns, else all business ones."""
    columns = hashed or [c for c in df.columns if c not in TECHNICAL_COLUMNS]
    own = [c for c in df.columns if c not in VERSION_COLUMNS]
    extra = [] if run_id is None else [F.lit(run_id).alias("_run_id")]
    return df.select(*own, *_version(source, timestamp(start), operation), row_hash(df, columns).alias("row_hash"), *extra)


def classify(baseline: DataFrame, incoming: DataFrame, entity: Entity) -> DataFrame:
    """Both sides of every key, and what became of it.

    One full outer join replaces inner, semi and anti joins; both sides hold one row per key, so no
    key can be hot in it. A null key matches nothing: the baseline row stays, the incoming row is new.
    Values decide whether a row changed, nulls being alike; the hash rounds floats and is only carried.
    It is taken after the join, so that the join moves each key once and no hash.
    """
    incoming = align_types(incoming, baseline)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"{name}_{k}") for k in entity.keys],
                         F.struct(F.lit(True).alias("_there"), *entity.columns).alias(name))

    def row(df: DataFrame, name: str) -> Column:
        at = {k: f"`{name}_{k}`" for k in entity.keys} | {c: f"{name}.`{c}`" for c in entity.columns}
        values = [F.col(at[c]).alias(c) for c in entity.business_columns]
        hashed = row_hash(df, entity.business_columns, at).alias("row_hash")
        return F.when(F.col(name).isNotNull(), F.struct(*values, hashed)).alias(name)

    same_key = [F.col(f"old_{k}") == F.col(f"new_{k}") for k in entity.keys]
    both = side(baseline, "old").join(side(incoming, "new"), same_key, "full_outer").select(row(baseline, "old"), row(incoming, "new"))
    alike = reduce(Column.__and__, [F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")) for c in entity.business_columns])
    status = (F.when(F.col("new").isNull(), "BASELINE_ONLY").when(F.col("old").isNull(), "NEW")
              .when(alike, "UNCHANGED").otherwise("CHANGED"))
    return both.withColumn("status", status)


# The column of a version that tells what became of its key, if it is asked for.
OUTCOME = "_outcome"


def merge(baseline: DataFrame, incoming: DataFrame, entity: Entity, run_ts: datetime | str, outcome: bool = False) -> DataFrame:
    """The history table of two prepared feeds (one row per key each).

    Same key and content: the baseline stays current. Other content: the baseline is closed at run
    time and the incoming row becomes current as an update. New key: the incoming row, as an insert.
    With ``outcome`` each version also carries the status of its key. A baseline that is bucketed by
    the keys is joined where it lies, so that only the feed is moved.
    """
    run = timestamp(run_ts)
    start = timestamp(BASELINE_START)
    old, new = F.col("old"), F.col("new")

    def version(side: str, technical: list[Column]) -> Column:
        business = [F.col(f"{side}.{c}").alias(c) for c in entity.business_columns]
        return F.struct(*business, *technical, F.col(f"{side}.row_hash").alias("row_hash"))

    changed, added = F.col("status") == "CHANGED", F.col("status") == "NEW"
    kept = F.when(old.isNotNull() & ~changed, version("old", _version(API, start, "I")))
    closed = F.when(changed, version("old", _version(API, start, "I", end=run, modified=run)))
    updated = F.when(changed, version("new", _version(EXCEL, run, "U")))
    inserted = F.when(added, version("new", _version(EXCEL, run, "I")))
    versions = F.array_compact(F.array(F.coalesce(kept, closed), F.coalesce(updated, inserted)))
    told = [F.col("status").alias(OUTCOME)] if outcome else []
    return classify(baseline, incoming, entity).select(F.explode(versions).alias("v"), *told).select("v.*", *[OUTCOME] * outcome)


def merge_counts(classified: DataFrame) -> DataFrame:
    """One row with what the merge did, from the classified keys alone."""
    def of(*statuses: str) -> Column:
        return F.count_if(F.col("status").isin(*statuses))

    return classified.agg(
        of("BASELINE_ONLY", "UNCHANGED", "CHANGED").alias("api_rows"),
        of("NEW", "UNCHANGED", "CHANGED").alias("excel_rows"), of("UNCHANGED").alias("unchanged_rows"),
        of("CHANGED").alias("changed_rows"), of("NEW").alias("new_rows"),
        (F.count(F.lit(1)) + of("CHANGED")).alias("total_rows"), F.count(F.lit(1)).alias("current_rows"),
        of("CHANGED").alias("historical_rows"))
