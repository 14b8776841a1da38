"""Silver jobs: merge run, table build, quality, references, readiness, summary."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewell.config import (API, EXCEL, EXPECTED_API_ROWS, HISTORY_COLUMNS, TECHNICAL_COLUMNS, Entity,
                              silver_name)
from tradewell.operators import history, keys
from tradewell.operators.clean import clean_table, fill_text, parse_dates, prepare_feed, trim_text, with_default
from tradewell.operators.profile import duplicate_keys, null_count
from tradewell.plans.bronze import error_text
from tradewell.session import all_or_raise, for_each_table
from tradewell.sources.sinks import STORED_AS, append_run, publish, read_log, stored

Source = Callable[[], DataFrame]

# Fields of the merge log.
MERGE_LOG_SCHEMA = ("target_table string, sheet string, excel_rows bigint, net_row_change bigint, status string, "
                    "error string, run_timestamp string, api_rows bigint, unchanged_rows bigint, changed_rows bigint, "
                    "new_rows bigint, current_rows bigint, historical_rows bigint")


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ---- merge run ----------------------------------------------------------------------------------

def merge_record(stored: DataFrame, entity: Entity, run_ts: str) -> DataFrame:
    """The log row of one merge, counted on the table it wrote: what became of each key is stored with it."""
    def keys(*outcomes: str) -> Column:
        return F.count_if(F.col(history.OUTCOME).isin(*outcomes) & F.col("is_current"))

    counts = stored.agg(
        keys("NEW", "CHANGED", "UNCHANGED").alias("excel_rows"), F.count_if(F.col("source_system") == API).alias("api_rows"),
        keys("UNCHANGED").alias("unchanged_rows"), keys("CHANGED").alias("changed_rows"), keys("NEW").alias("new_rows"),
        F.count_if("is_current").alias("current_rows"), F.count_if(~F.col("is_current")).alias("historical_rows"))
    return counts.select(
        F.lit(silver_name(entity.name)).alias("target_table"), F.lit(entity.name).alias("sheet"), "excel_rows",
        (F.col("changed_rows") + F.col("new_rows")).alias("net_row_change"), F.lit("SUCCESS").alias("status"),
        F.lit(None).cast("string").alias("error"), F.lit(run_ts).alias("run_timestamp"), "api_rows", "unchanged_rows",
        "changed_rows", "new_rows", "current_rows", "historical_rows")


def store_baseline(df: DataFrame, entity: Entity, name: str, root: str) -> DataFrame:
    """A baseline feed published bucketed and sorted by its keys: merges with it move the other feed only."""
    return publish(df, name, root, bucket_by=entity.keys)


def merge_run(spark: SparkSession, entities: Iterable[Entity], baseline: Mapping[str, Source],
              incoming: Mapping[str, Source], root: str, run_ts: str, schema: str = "") -> DataFrame:
    """Merge every entity into its table and log it; a failing entity is logged and the rest go on.

    Each feed is read once. The log rows are counted on two small columns of the published tables, in one
    job for all of them; a run that is repeated replaces its rows in the log.
    """
    def run(entity: Entity) -> DataFrame:
        old, new = baseline[entity.name](), incoming[entity.name]()
        merged = history.merge(prepare_feed(old, entity), prepare_feed(new, entity), entity, run_ts, outcome=True)
        name = f"{schema}{silver_name(entity.name)}"
        publish(merged, name, root, hidden=[history.OUTCOME])
        return merge_record(stored(spark, name, root), entity, run_ts)

    records = []
    for name, result in for_each_table({e.name: partial(run, e) for e in entities}).items():
        if isinstance(result, Exception):
            row = (silver_name(name), name, 0, 0, "FAILED", error_text(result), run_ts, *[None] * 6)
            result = spark.createDataFrame([row], MERGE_LOG_SCHEMA)
        records.append(result)
    log = f"{root.rstrip('/')}/merge_log"
    append_run(_union(records), log, "run_timestamp")
    return read_log(spark, log)


def merge_summary(log: DataFrame) -> DataFrame:
    """Overall outcome of a merge run."""
    failed = F.count_if(~F.col("status").isin("SUCCESS", "SKIPPED"))
    return log.groupBy("run_timestamp").agg(
        F.when(failed == 0, "SUCCESS").otherwise("FAILED").alias("overall_status"),
        F.count_if(F.col("status") == "SUCCESS").alias("success_count"), failed.alias("failed_count"),
        F.count_if(F.col("status") == "SKIPPED").alias("skipped_count"), F.count("*").alias("total_tables_processed"))


# Fields of the merge diagnostic.
DIAGNOSTIC_SCHEMA = ("table_name string, table_exists boolean, rows bigint, current_rows bigint, "
                     "historical_rows bigint, status string, expected bigint, baseline_rows bigint")


def merge_diagnostic(spark: SparkSession, tables: Mapping[str, str],
                     expected: Mapping[str, int] = EXPECTED_API_ROWS) -> DataFrame:
    """State of each merged table: MISSING, INVALID_SCHEMA, OK or ERROR, beside the expected feed rows."""
    rows = []
    for logical, name in tables.items():
        wanted = F.lit(expected.get(logical)).cast("bigint").alias("expected")
        try:
            if not spark.catalog.tableExists(name):
                rows.append(_fixed_diagnostic(spark, name, False, "MISSING", expected.get(logical)))
                continue
            df = spark.table(name)
            valid = all(c in df.columns for c in HISTORY_COLUMNS)
            zero = F.lit(0).cast("bigint")
            rows.append(df.agg(
                F.lit(name).alias("table_name"), F.lit(True).alias("table_exists"), F.count(F.lit(1)).alias("rows"),
                (F.count_if("is_current") if valid else zero).alias("current_rows"),
                (F.count_if(~F.col("is_current")) if valid else zero).alias("historical_rows"),
                F.lit("OK" if valid else "INVALID_SCHEMA").alias("status"), wanted,
                (F.count_if(F.col("source_system") == API) if valid else zero).alias("baseline_rows")))
        except PySparkException:
            rows.append(_fixed_diagnostic(spark, name, True, "ERROR", expected.get(logical)))
    return _union(rows)


def _fixed_diagnostic(spark: SparkSession, name: str, exists: bool, status: str, expected: int | None) -> DataFrame:
    return spark.createDataFrame([(name, exists, 0, 0, 0, status, expected, 0)], DIAGNOSTIC_SCHEMA)


# ---- table build --------------------------------------------------------------------------------

def refine_merged(df: DataFrame) -> DataFrame:
    """C10, a table that the merge built: trimmed, dates parsed, null text filled; all versions kept."""
    return fill_text(parse_dates(trim_text(df)))


def build_api_only(df: DataFrame, key_columns: list[str], run_ts: str, run_id: str) -> DataFrame:
    """C10, a table of the API feed alone: cleaned, then stamped as current first versions with a hash."""
    clean = with_default(clean_table(df, key_columns, run_ts), "source_system", F.lit(API))
    hashed = [c for c in clean.columns if c not in TECHNICAL_COLUMNS]
    return history.stamp(clean, API, run_ts, "I", hashed, run_id)


def build(api_only: Mapping[str, DataFrame], merged: Mapping[str, DataFrame], table_keys: Mapping[str, list[str]],
          run_ts: str, run_id: str) -> dict[str, DataFrame]:
    """All Silver tables. How a table is built follows from the feed it is configured for."""
    tables = {name: refine_merged(df) for name, df in merged.items()}
    tables.update({name: build_api_only(df, table_keys[name], run_ts, run_id) for name, df in api_only.items()})
    return tables


def write(tables: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """One folder per Silver table, independent tables at the same time; returns the written tables."""
    made = run({name: (lambda df=df: df) for name, df in tables.items()}, root)
    all_or_raise(made.errors)
    return made.tables


# Fixed value: why a table that could not be built is not ready for Gold.
TRANSFORM_FAILED = "Silver transformation failed"


@dataclass(frozen=True)
class Run:
    """The Silver tables that a run wrote, and the errors of those that it could not build."""

    tables: dict[str, DataFrame]
    errors: dict[str, Exception]

    def failures(self, spark: SparkSession) -> DataFrame:
        """table_name, error: as many rows as tables failed."""
        return spark.createDataFrame([(n, error_text(e)) for n, e in self.errors.items()], "table_name string, error string")


def run(makers: Mapping[str, Source], root: str) -> Run:
    """Build and write every Silver table; one that fails is noted and the rest go on."""
    def make(name: str, source: Source) -> DataFrame:
        df = source()
        path = f"{root.rstrip('/')}/{silver_name(name)}"
        df.write.option("compression", STORED_AS).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    results = for_each_table({name: partial(make, name, source) for name, source in makers.items()})
    errors = {n: r for n, r in results.items() if isinstance(r, Exception)}
    return Run({n: r for n, r in results.items() if n not in errors}, errors)


# ---- quality ------------------------------------------------------------------------------------

def quality_record(df: DataFrame, table: str, key_columns: list[str]) -> DataFrame:
    """C11: counts, duplicate keys, nulls and status of one Silver table.

    Duplicates among current rows fail a table. Those over all versions are reported only: a closed
    version shares its key with the current one by design.
    """
    current = F.col("is_current") if "is_current" in df.columns else F.lit(True)
    business = [c for c in df.columns if c not in TECHNICAL_COLUMNS]
    row = df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(current).alias("current_rows"),
        F.count_if(~current).alias("historical_rows"), *[null_count(c).alias(f"_null_{c}") for c in business])
    found = ", ".join(
        f"CASE WHEN `_null_{c}` > 0 THEN struct('{c}' AS column_name, struct(`_null_{c}` AS null_count, "
        f"round(`_null_{c}` / row_count * 100, 2) AS null_pct) AS n) END" for c in business)
    duplicates = F.col("_duplicates.among")
    reason = F.when(duplicates > 0, F.concat(duplicates.cast("string"), F.lit(" duplicate current PK rows")))
    return row.withColumn("_duplicates", duplicate_keys(df, key_columns, current)).select(
        F.lit(table).alias("table_name"), F.lit(",".join(key_columns)).alias("primary_key"), "row_count", "current_rows",
        "historical_rows", F.col("_duplicates.all").alias("duplicate_pk_count"), duplicates.alias("current_duplicate_pk_count"),
        F.expr(f"to_json(map_from_entries(array_compact(array({found}))))").alias("nulls"),
        F.when(reason.isNull(), "PASSED").otherwise("FAILED").alias("status"), reason.alias("reason"))


def _failed_records(failures: DataFrame) -> DataFrame:
    zeros = [F.lit(0).cast("bigint").alias(n) for n in ("row_count", "current_rows", "historical_rows", "duplicate_pk_count",
                                                        "current_duplicate_pk_count")]
    return failures.select("table_name", F.lit("").alias("primary_key"), *zeros, F.lit("{}").alias("nulls"),
                           F.lit("FAILED").alias("status"), F.col("error").alias("reason"))


def quality(tables: Mapping[str, DataFrame], table_keys: Mapping[str, list[str]], failures: DataFrame | None = None) -> DataFrame:
    """C11 for all tables; one that could not be built has a failed record with its error."""
    records = [quality_record(df, name, table_keys.get(name, [])) for name, df in tables.items()]
    return _union([*records, *([] if failures is None else [_failed_records(failures)])])


def referential_integrity(tables: Mapping[str, DataFrame], references: Iterable[tuple[str, str, str, str]]) -> DataFrame:
    """Orphan count of each (table, column, referenced table, referenced column)."""
    return _union(
        keys.orphans(tables[t], c, tables[rt], rc).select(
            F.lit(t).alias("table_name"), F.lit(f"{c} -> {rt}.{rc}").alias("reference"), "orphan_count")
        for t, c, rt, rc in references)


def references(tables: Mapping[str, DataFrame], table_keys: Mapping[str, list[str]],
               declared: Iterable[tuple[str, str, str, str]] = ()) -> list[tuple[str, str, str, str]]:
    """Inferred references, then declared ones that inference cannot see."""
    inferred = [(t, c, rt, rc) for t, df in tables.items()
                for c, rt, rc in keys.infer_foreign_keys(t, df.columns, table_keys) if rt in tables]
    present = [d for d in declared if d[0] in tables and d[2] in tables and d[1] in tables[d[0]].columns]
    return list(dict.fromkeys([*inferred, *present]))


def readiness(quality_records: DataFrame, integrity: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """Whether each table may go to Gold, and why not; one that could not be built has that reason alone.

    The list of broken references holds at most one entry per configured reference.
    """
    broken = integrity.where("orphan_count > 0").groupBy("table_name").agg(
        F.expr("listagg(reference, ', ') WITHIN GROUP (ORDER BY reference)").alias("_broken"))
    joined = quality_records.join(broken, "table_name", "left")
    if failures is not None:
        joined = joined.join(failures.select("table_name", F.lit(TRANSFORM_FAILED).alias("_failed")), "table_name", "left")
    else:
        joined = joined.withColumn("_failed", F.lit(None).cast("string"))
    reasons = F.coalesce("_failed", F.concat_ws(
        "; ",
        F.when(F.col("current_duplicate_pk_count") > 0, "Duplicate current keys found"),
        F.when(F.col("_broken").isNotNull(), F.concat(F.lit("Referential integrity failures: "), F.col("_broken")))))
    return joined.select("table_name", (reasons == "").alias("gold_ready"), reasons.alias("reasons"))


def quality_log(quality_records: DataFrame, ready: DataFrame, run_id: str, run_ts: str) -> DataFrame:
    """The quality log, details as JSON text."""
    details = F.to_json(F.struct(*[F.col(c) for c in quality_records.columns]))
    return quality_records.withColumn("details_json", details).join(ready, "table_name").select(
        F.lit(run_id).alias("run_id"), F.lit(run_ts).alias("run_timestamp"), "table_name", "primary_key",
        "gold_ready", "reasons", "details_json")


def append_quality_log(records: DataFrame, log: str) -> DataFrame:
    """C14: the quality log at a path with the records of a run; a run that is repeated replaces its own."""
    append_run(records, log)
    return read_log(records.sparkSession, log)


# ---- summary ------------------------------------------------------------------------------------

def provenance(tables: Mapping[str, DataFrame], failures: DataFrame | None = None) -> DataFrame:
    """Rows per table from each feed, over all versions and over current ones; none of a table that failed."""
    counted = ("all_api_rows", "all_excel_rows", "current_api_rows", "current_excel_rows")

    def record(name: str, df: DataFrame) -> DataFrame:
        current = F.col("is_current") if "is_current" in df.columns else F.lit(True)
        source = F.col("source_system") if "source_system" in df.columns else F.lit(None).cast("string")
        counts = (F.count_if(source == API), F.count_if(source == EXCEL), F.count_if((source == API) & current),
                  F.count_if((source == EXCEL) & current))
        return df.agg(F.lit(name).alias("table_name"), *[c.alias(n) for n, c in zip(counted, counts)])

    none = [] if failures is None else [failures.select("table_name", *[F.lit(0).cast("bigint").alias(n) for n in counted])]
    return _union([*[record(name, df) for name, df in tables.items()], *none])


def summary(quality_records: DataFrame, ready: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per Silver table for the end of a run."""
    joined = quality_records.join(sources, "table_name", "left").join(ready, "table_name", "left")
    return joined.select(
        F.concat(F.lit("silver_"), F.lower("table_name")).alias("table"), "status",
        F.col("row_count").alias("final_rows"), "current_rows", "historical_rows", "all_api_rows", "all_excel_rows",
        "current_api_rows", "current_excel_rows", "gold_ready", F.col("reason").alias("error"))


def run_outcome(final: DataFrame) -> DataFrame:
    """Overall outcome of a Silver run."""
    failed = F.col("status") != "PASSED"
    return final.agg(
        F.when(F.count_if(failed) > 0, "FAILED").otherwise("SUCCESS").alias("overall_status"),
        F.count("*").alias("tables_discovered"), F.count_if(~failed).alias("total_succeeded"),
        F.count_if(failed).alias("total_failed"), F.count_if(~F.col("gold_ready")).alias("tables_not_gold_ready"))
