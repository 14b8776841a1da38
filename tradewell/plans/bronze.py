"""Bronze jobs: landing, copy log, validation."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewell.config import EXCEL, EXCEL_PREFIX, KEYS, table_name
from tradewell.operators.clean import nan_to_null, sanitise_names
from tradewell.operators.profile import numeric_columns, source_profile
from tradewell.session import for_each_table, materialise
from tradewell.sources.sinks import append_run, read_log

Source = Callable[[], DataFrame]

# Fields of the landing log; those of the validation log and its reasons follow in validate_bronze.
AUDIT_SCHEMA = ("run_id string, table_name string, row_count bigint, column_count int, "
                "numeric_column_count int, loaded_at string, error string")
PROFILE_SCHEMA = ("row_count bigint, duplicates bigint, null_keys bigint, nulls_json string, "
                  "aggregates_json string, dtypes_json string, feed string")


def error_text(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


# ---- landing ------------------------------------------------------------------------------------

def land_sheet(df: DataFrame, table: str, root: str) -> DataFrame:
    """S05 for one sheet: clean names, NaN as null, provenance, written as one table."""
    path = f"{root.rstrip('/')}/{EXCEL_PREFIX}{table}"
    landed = nan_to_null(sanitise_names(df)).withColumn("source_system", F.lit(EXCEL))
    landed.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(landed.schema).parquet(path)


def land(spark: SparkSession, sheets: Mapping[str, Source], root: str, run_id: str, run_ts: str) -> DataFrame:
    """Land every sheet and log one audit row each; a failing or empty sheet does not stop the rest.

    Rows are counted on the written files, whose footers hold the number. A run that is repeated
    replaces its rows in the log.
    """
    def run(table: str, source: Source) -> tuple:
        df = source()
        if df.isEmpty():
            return run_id, table, 0, 0, 0, run_ts, "Empty sheet"
        landed = land_sheet(df, table, root)
        return run_id, table, landed.count(), len(landed.columns), len(numeric_columns(landed)), run_ts, None

    results = for_each_table({table_name(raw): partial(run, table_name(raw), source) for raw, source in sheets.items()})
    audit = [(run_id, table, None, 0, 0, run_ts, error_text(r)) if isinstance(r, Exception) else r
             for table, r in results.items()]
    log = f"{root.rstrip('/')}/{EXCEL_PREFIX}load_log"
    append_run(spark.createDataFrame(audit, AUDIT_SCHEMA), log)
    return read_log(spark, log)


def copy_log(runs: DataFrame, run_ts: str) -> DataFrame:
    """One row per table that a copy run reports.

    ``runs`` holds pipeline_run_id and two JSON lists of table names, success_list and failed_list.
    """
    outcomes = F.array(F.struct(F.lit("SUCCESS").alias("status"), F.col("success_list").alias("names")),
                       F.struct(F.lit("FAILED").alias("status"), F.col("failed_list").alias("names")))
    lists = runs.select("pipeline_run_id", F.explode(outcomes).alias("o")).select("pipeline_run_id", "o.*")
    return lists.select("pipeline_run_id", F.explode(F.from_json("names", "array<string>")).alias("table_name"),
                        "status", F.lit(run_ts).alias("run_timestamp"))


def append_copy_log(runs: DataFrame, run_ts: str, log: str) -> DataFrame:
    """The rows of ``copy_log`` in the log at a path; a run that reports again replaces its rows."""
    append_run(copy_log(runs, run_ts), log, "pipeline_run_id")
    return read_log(runs.sparkSession, log)


# ---- validation ---------------------------------------------------------------------------------

def expected_counts(spark: SparkSession, text: str | None) -> dict[str, str | None]:
    """A parameter that is an object of counts, or a list of {table | table_name | name, count | row_count}.

    Spark reads it by schema in both shapes; what fits neither gives no counts. As many rows as tables
    are configured, the last one of a table holds.
    """
    item = "struct<table_name:string,table:string,name:string,count:string,row_count:string>"
    given = spark.createDataFrame([(text,)], "given string")
    shape = F.when(F.ltrim("given").startswith("["), F.transform(
        F.from_json("given", f"array<{item}>"), lambda i: F.struct(
            F.coalesce(*[F.nullif(i[n], F.lit("")) for n in ("table_name", "table", "name")]).alias("key"),
            F.coalesce(i["count"], i["row_count"]).alias("value")))).otherwise(
        F.map_entries(F.from_json("given", "map<string,string>")))
    rows = given.select(F.explode(shape).alias("e")).where("e.key IS NOT NULL").select("e.key", "e.value").collect()
    return {r.key: r.value for r in rows}


def _feed_profile(df: DataFrame, keys: list[str], feed: str) -> DataFrame:
    dtypes = json.dumps({f.name: f.dataType.simpleString() for f in df.schema})
    return source_profile(df, keys).select("*", F.lit(dtypes).alias("dtypes_json"), F.lit(feed).alias("feed"))


def _json_pair(api: Column, excel: Column) -> Column:
    empty = F.lit("{}")
    return F.concat(F.lit('{"API": '), F.coalesce(api, empty), F.lit(', "Excel": '), F.coalesce(excel, empty), F.lit("}"))


def validate_bronze(spark: SparkSession, table: str, api: DataFrame | None, excel: DataFrame | None, *,
                    run_id: str, run_ts: str, expected: object = None, is_api: bool = True,
                    is_excel: bool = False) -> DataFrame:
    """The validation record of one table, from an aggregate over each feed and one over its keys."""
    first = api if api is not None else excel
    keys = [k for k in KEYS.get(table, []) if first is not None and k in first.columns]
    profiles = spark.createDataFrame([], PROFILE_SCHEMA)
    for feed, df in (("API", api), ("Excel", excel)):
        if df is not None:
            profiles = profiles.unionByName(_feed_profile(df, keys, feed))

    def of(feed: str, column: str) -> Column:
        return F.max(F.when(F.col("feed") == feed, F.col(column)))

    picked = {f"{feed}_{c}": of(feed, c) for feed in ("API", "Excel") for c in
              ("row_count", "duplicates", "null_keys", "nulls_json", "aggregates_json", "dtypes_json")}
    row = profiles.agg(*[c.alias(n) for n, c in picked.items()])
    zero = F.lit(0).cast("bigint")
    api_dup, excel_dup = (F.coalesce(f"{f}_duplicates", zero) for f in ("API", "Excel"))
    null_keys = F.coalesce("API_null_keys", zero) + F.coalesce("Excel_null_keys", zero)
    wanted = F.lit(None if expected is None or not is_api else str(expected)).try_cast("bigint")
    match = F.col("API_row_count") == wanted
    no_api, no_excel = F.lit(is_api and api is None), F.lit(is_excel and excel is None)
    no_key = F.lit(table in KEYS and first is not None and not keys)
    reasons = F.concat_ws(
        "; ",
        F.when(no_api, "no API Bronze data found"), F.when(no_excel, "no Excel Bronze data found"),
        F.when(~match, F.concat(F.lit("API count mismatch: expected="), wanted.cast("string"), F.lit(", actual="),
                                F.col("API_row_count").cast("string"))),
        F.when(api_dup > 0, F.concat(api_dup.cast("string"), F.lit(" duplicate API PK rows"))),
        F.when(excel_dup > 0, F.concat(excel_dup.cast("string"), F.lit(" duplicate Excel PK rows"))),
        F.when(null_keys > 0, F.concat(null_keys.cast("string"), F.lit(" required PK NULL rows"))),
        F.when(no_key, "required primary key not found"))
    key_text = F.lit(",".join(keys) if keys else None).cast("string")
    return row.select(
        F.lit(run_id).alias("run_id"), F.lit(run_ts).alias("run_timestamp"), F.lit(table).alias("table_name"),
        F.lit(api is not None).alias("has_api"), F.lit(excel is not None).alias("has_excel"),
        F.when(reasons == "", "PASSED").otherwise("FAILED").alias("status"),
        F.when(reasons == "", "validation passed").otherwise(reasons).alias("failure_reason"),
        F.col("API_row_count").alias("api_count"), wanted.alias("api_source_count"), match.alias("api_count_match"),
        F.col("Excel_row_count").alias("excel_count"), F.col("Excel_row_count").alias("excel_source_count"),
        F.lit(True if excel is not None else None).cast("boolean").alias("excel_count_match"),
        api_dup.alias("api_pk_duplicates"), excel_dup.alias("excel_pk_duplicates"),
        (api_dup + excel_dup).alias("full_duplicate_count"), key_text.alias("inferred_pk"),
        key_text.alias("required_columns"), null_keys.alias("required_null_count"),
        _json_pair(F.col("API_nulls_json"), F.col("Excel_nulls_json")).alias("null_counts_by_column"),
        _json_pair(F.col("API_aggregates_json"), F.col("Excel_aggregates_json")).alias("combined_bronze_aggs"),
        F.coalesce("Excel_aggregates_json", F.lit("{}")).alias("excel_bronze_aggs"),
        F.lit("{}").alias("excel_source_aggs"), F.lit("not_compared").alias("aggs_match"), F.lit("{}").alias("agg_diffs"),
        _json_pair(F.col("API_dtypes_json"), F.col("Excel_dtypes_json")).alias("dtypes"))


def _load(source: Source | None) -> DataFrame | None:
    return source() if source is not None else None


def validate_all(spark: SparkSession, tables: Iterable[str], api: Mapping[str, Source], excel: Mapping[str, Source],
                 log: str, *, run_id: str, run_ts: str, expected: Mapping[str, object] | None = None,
                 excel_tables: Iterable[str] = ()) -> DataFrame:
    """Validate every table into a log; one that cannot be read is recorded as failed.

    Each record is computed by its own job, so a broken table costs only its own record; the log
    gets all records, one row per table, in one write; a run that is repeated replaces its records.
    """
    excel_tables = set(excel_tables)

    def facts(table: str) -> dict[str, object]:
        return {"run_id": run_id, "run_ts": run_ts, "expected": (expected or {}).get(table),
                "is_excel": table in excel_tables}

    def run(table: str) -> DataFrame:
        record = validate_bronze(spark, table, _load(api.get(table)), _load(excel.get(table)), **facts(table))
        return materialise(record, f"validation-{table}")

    records = []
    for table, result in for_each_table({t: partial(run, t) for t in tables}).items():
        if isinstance(result, Exception):
            record = validate_bronze(spark, table, None, None, **facts(table))
            result = record.withColumn("failure_reason", F.lit(error_text(result)))
        records.append(result)
    append_run(reduce(DataFrame.unionByName, records), log)
    return read_log(spark, log)


def validation_summary(log: DataFrame) -> DataFrame:
    """Tables and outcomes of a run; the lists hold table names, as many as are configured."""
    passed = F.col("status") == "PASSED"

    def named(condition: Column) -> Column:
        return F.concat_ws(",", F.sort_array(F.collect_list(F.when(condition, F.col("table_name")))))

    return log.groupBy("run_id").agg(
        F.count("*").alias("total_tables"), F.count_if(passed).alias("passed_count"),
        F.count_if(~passed).alias("failed_count"), named(passed).alias("passed_tables"), named(~passed).alias("failed_tables"))
