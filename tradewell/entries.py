"""Registered queries: every one takes (spark, sf_dir) and returns a frame.

Jobs up to Gold work on the test tables read as business tables. Measures and reports read the star
that the Gold job has built from the same folder, once per application.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import replace
from functools import partial
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewell.config import (DECLARED_FOREIGN_KEYS, EXPECTED_API_ROWS, KEYS, MERGED, TECHNICAL_COLUMNS,
                              silver_name)
from tradewell.functions.dates import us_week
from tradewell.functions.text import dollars, fixed, percent, whole
from tradewell.operators import clean, history, profile, ranking
from tradewell.operators import keys as key_ops
from tradewell.plans import bronze, gold, insights, reports, silver
from tradewell.plans import measures as m
from tradewell.plans.star import Star
from tradewell.session import all_or_raise, for_each_table, materialise, new_path
from tradewell.sources import pages, reader, sinks
from tradewell.sources.adapter import TestTables

Query = Callable[[SparkSession, str], DataFrame]

RUN_ID, RUN_TS = "run-1", "2026-02-01 00:00:00"
COMPANY = "the company"
DRILL_CUSTOMER = "Customer#000000007"
# One value for each of the four filters that all report pages share.
SHARED = {"DimDate.Year": [1996, 1997], "Sales.ShipCountry": [f"NATION_{i}" for i in range(12)],
          "DimCategories.CategoryName": ["Category 1", "Category 4", "Others"],
          "DimEmployees.FirstName": [f"NATION_{i}" for i in range(5, 20)]}

_queries: dict[str, Query] = {}
_stars: dict[tuple[str, str], Star] = {}


def query(make: Query) -> Query:
    """Register a function under its own name."""
    _queries[make.__name__] = make
    return make


def on_star(name: str, make: Callable[[Star], DataFrame]) -> None:
    """Register a question to the star."""
    _queries[name] = lambda spark, sf_dir: make(star(spark, sf_dir))


def queries() -> dict[str, Query]:
    return dict(_queries)


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The Gold star of one folder, built on first use."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _stars:
        root = new_path(spark, "gold")
        gold.build(TestTables(spark, sf_dir).all(), root)
        _stars[at] = gold.open_star(spark, root)
    return _stars[at]


def _tables_root(spark: SparkSession) -> str:
    return new_path(spark, "tables")


def _name(base: str) -> str:
    return f"{base}_{uuid4().hex[:12]}"


# ---- sources and sinks --------------------------------------------------------------------------

ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
               "o_totalprice": "double", "o_orderpriority": "string"}
PER_PAGE, PAGES_PER_FILE, PER_DOCUMENT = 20, 50, 2000


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TestTables(spark, sf_dir).raw("orders").select(*ORDER_TYPES)


def _write_pages(orders: DataFrame, path: str, per_page: int = PER_PAGE, per_file: int = PAGES_PER_FILE) -> None:
    """API pages of a fixed number of orders, several back to back in each file."""
    page = F.floor(F.col("o_orderkey") / per_page)
    record = F.to_json(F.struct(*ORDER_TYPES))
    text = orders.groupBy(page.alias("page")).agg(F.concat_ws(",", F.collect_list(record)).alias("records"))
    envelope = F.concat(F.lit('{"@odata.context":"orders","value":['), F.col("records"),
                        F.lit('],"@odata.nextLink":"page='), (F.col("page") + 1).cast("string"), F.lit('"}'))
    filed = text.select(envelope.alias("value"), F.floor(F.col("page") / per_file).alias("file"))
    filed.repartition("file").write.partitionBy("file").option("lineSep", " ").text(path)


@query
def s01_columnar_scan(spark, sf_dir):
    lines = reader.read_columnar(spark, f"{sf_dir}/lineitem.parquet")
    return lines.where(F.col("l_shipdate") < F.lit("1996-01-01")).select("l_orderkey", "l_linenumber", "l_quantity")


@query
def s01_full_scan(spark, sf_dir):
    return reader.read_columnar(spark, f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")


@query
def s02_json_tree(spark, sf_dir):
    path = new_path(spark, "json")
    orders = _orders(spark, sf_dir)
    orders.where("o_orderstatus = 'F'").write.json(f"{path}/finished")
    orders.where("o_orderstatus <> 'F'").write.json(f"{path}/other")
    return reader.read_json_tree(spark, path).select(*ORDER_TYPES)


@query
def s03_json_document(spark, sf_dir):
    path = new_path(spark, "documents")
    _write_pages(_orders(spark, sf_dir), path, PER_DOCUMENT, per_file=1)
    return reader.read_json_document(spark, path).select(*ORDER_TYPES)


@query
def s04_read_pages(spark, sf_dir):
    path = new_path(spark, "pages")
    _write_pages(_orders(spark, sf_dir), path)
    return pages.read_pages(spark, path, ORDER_TYPES)


@query
def s06_resolve_source(spark, sf_dir):
    """Orders landed as JSON in lower case, details columnar under their other spelling."""
    root = new_path(spark, "bronze")
    tables = TestTables(spark, sf_dir)
    _orders(spark, sf_dir).write.json(f"{root}/bronze_orders")
    tables.raw("lineitem").select("l_orderkey", "l_linenumber").write.parquet(f"{root}/bronze_OrderDetails")
    found = [reader.resolve(spark, root, t) for t in ("Orders", "Order_Details")]
    counts = [df.agg(F.lit(t).alias("table_name"), F.count("*").alias("row_count"))
              for t, df in zip(("Orders", "Order_Details"), found)]
    return counts[0].unionAll(counts[1])


@query
def s09_publish_from_itself(spark, sf_dir):
    name, root = _name("orders_published"), _tables_root(spark)
    published = sinks.publish(_orders(spark, sf_dir), name, root)
    sinks.publish(published.where("o_orderstatus = 'F'"), name, root)
    wider = spark.table(name).withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    return sinks.publish(wider, name, root)


@query
def s09_publish_whole(spark, sf_dir):
    """All orders, published over themselves with one more column and then with one less."""
    name, root = _name("orders_whole"), _tables_root(spark)
    published = sinks.publish(_orders(spark, sf_dir), name, root)
    wider = sinks.publish(published.withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint")), name, root)
    return sinks.publish(wider.drop("o_orderpriority"), name, root)


@query
def s10_append_widening(spark, sf_dir):
    log = new_path(spark, "log")
    orders = _orders(spark, sf_dir)
    sinks.append(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus"), log)
    sinks.append(orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus", "o_custkey"), log)
    return sinks.read_log(spark, log)


@query
def s11_append_by_rewrite(spark, sf_dir):
    return _run_log(spark, sf_dir, {"F": "o_custkey", "P": "o_orderpriority"})


@query
def s11_append_every_status(spark, sf_dir):
    return _run_log(spark, sf_dir, {"F": "o_custkey", "P": "o_orderpriority", "O": "o_custkey"})


def _run_log(spark: SparkSession, sf_dir: str, columns: dict[str, str]) -> DataFrame:
    """A log with one run for each order status, columns of its own in each; the first run is repeated at the end."""
    log, orders = new_path(spark, "log"), _orders(spark, sf_dir)
    for status, column in [*columns.items(), next(iter(columns.items()))]:
        rows = orders.where(F.col("o_orderstatus") == status).select("o_orderkey", column, F.lit(f"run {status}").alias("run_id"))
        sinks.append_run(rows, log)
    return sinks.read_log(spark, log).drop("run_id")


# ---- projections, cleaning ----------------------------------------------------------------------

@query
def p01_clean_names(spark, sf_dir):
    raw = TestTables(spark, sf_dir).raw("customer")
    return clean.sanitise_names(raw.toDF("Cust ID", "a,b;c", "__nation__", "%%%", "cust  id"))


@query
def p02_nan_to_null(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", F.when(
        F.col("o_orderkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("price"))
    return clean.nan_to_null(orders)


@query
def p05_project_missing(spark, sf_dir):
    df = _orders(spark, sf_dir).withColumnRenamed("o_orderkey", "@odata.id").withColumn("o_orderkey", F.col("o_custkey"))
    return clean.project(clean.drop_feed_metadata(df), ["o_orderkey", "o_orderstatus", "o_region"])


def _as_text(df: DataFrame, junk: dict[str, Column]) -> DataFrame:
    return df.select(*[F.when(junk[c], "n/a").otherwise(F.col(c).cast("string")).alias(c) if c in junk
                       else F.col(c).cast("string").alias(c) for c in df.columns])


@query
def p06_align_types(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return clean.align_types(_as_text(orders, {"o_custkey": F.col("o_orderkey") % 7 == 0}), orders)


@query
def p08_cast_rules(spark, sf_dir):
    details = TestTables(spark, sf_dir).order_details()
    text = _as_text(details, {"Quantity": F.col("OrderID") % 9 == 0})
    return clean.cast_columns(text, MERGED["Order_Details"].types)


@query
def p09_trim_text(spark, sf_dir):
    padded = _orders(spark, sf_dir).select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, "   ").otherwise(
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))).alias("priority"))
    return clean.trim_text(padded)


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in six ways, one of them unreadable."""
    day = F.col("o_orderdate")
    patterns = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy"]
    text = F.lit("junk")
    for i, pattern in enumerate(patterns):
        text = F.when(F.col("o_orderkey") % 6 == i, F.date_format(day, pattern)).otherwise(text)
    return TestTables(spark, sf_dir).raw("orders").select("o_orderkey", text.alias("order_date"), F.col("o_orderstatus").alias("status"))


@query
def p11_parse_dates(spark, sf_dir):
    return clean.parse_dates(_dated_orders(spark, sf_dir))


@query
def p12_dates_as_text(spark, sf_dir):
    return clean.dates_as_text(TestTables(spark, sf_dir).raw("orders").select("o_orderkey", "o_orderdate"), ["o_orderdate"])


@query
def p13_fill_text(spark, sf_dir):
    df = _orders(spark, sf_dir).select("o_orderkey", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderpriority")).alias("priority"),
                                       F.lit(None).cast("string").alias("source_note"))
    return clean.fill_text(df)


@query
def p16_row_hash(spark, sf_dir):
    orders = TestTables(spark, sf_dir).order_details()
    return orders.select("OrderID", "ProductID", clean.row_hash(orders, MERGED["Order_Details"].business_columns).alias("row_hash"))


@query
def p17_clean_chain(spark, sf_dir):
    """Repeated order rows with padded text, a null key now and then, and dates as text."""
    raw = _dated_orders(spark, sf_dir).select(
        F.when(F.col("o_orderkey") % 11 > 0, F.floor(F.col("o_orderkey") / 2)).alias("order_id"), "order_date",
        F.when(F.col("o_orderkey") % 5 > 0, F.concat(F.lit(" "), "status")).alias("status"))
    return clean.clean_table(raw, ["order_id"], RUN_TS)


@query
def d01_dedup(spark, sf_dir):
    return TestTables(spark, sf_dir).order_details()


@query
def f01_drop_null_keys(spark, sf_dir):
    df = _orders(spark, sf_dir).select(F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey")).alias("id"), "o_custkey")
    return clean.drop_null_keys(df, ["id"])


# ---- profiling ----------------------------------------------------------------------------------

@query
def a02_numeric_profile(spark, sf_dir):
    return profile.numeric_profile(TestTables(spark, sf_dir).raw("lineitem"))


@query
def a03_null_counts(spark, sf_dir):
    return profile.null_counts(TestTables(spark, sf_dir).orders())


@query
def a04_duplicate_keys(spark, sf_dir):
    details = TestTables(spark, sf_dir).raw_order_details()
    return details.agg(F.count("*").alias("row_count")).withColumn(
        "duplicates", profile.duplicate_keys(details, ["OrderID", "ProductID"])["all"])


@query
def a09_counts_by_source(spark, sf_dir):
    return profile.counts_by_source(_merged(spark, sf_dir, "Orders"))


@query
def a10_calendar_bounds(spark, sf_dir):
    return gold.calendar_bounds(TestTables(spark, sf_dir).orders())


# ---- Bronze jobs --------------------------------------------------------------------------------

@query
def c01_land_sheets(spark, sf_dir):
    """Five sheets, one of them empty, and one whose source is missing."""
    tables = TestTables(spark, sf_dir)
    sheets = {"Customers": tables.incoming_customers, "Products": tables.incoming_products,
              "Orders": tables.incoming_orders, "OrderDetails": tables.incoming_order_details,
              "Returns": lambda: tables.orders().where("false"),
              "Budget": lambda: spark.read.parquet(f"{sf_dir}/no_such_sheet.parquet")}
    log = bronze.land(spark, sheets, new_path(spark, "bronze"), RUN_ID, RUN_TS)
    failed = F.when(F.col("row_count").isNull(), "failed").otherwise(F.col("error"))
    return log.select("run_id", "table_name", "row_count", "column_count", "numeric_column_count", failed.alias("error"))


@query
def c02_copy_log(spark, sf_dir):
    """One copy run per order day: priorities of finished orders succeeded, those of open orders failed."""
    return bronze.copy_log(_copy_runs(spark, sf_dir, ["O"]), RUN_TS)


@query
def c02_copy_log_appended(spark, sf_dir):
    """One run per order month, every other status as failed, in a log to which each January reports twice."""
    log, runs = new_path(spark, "copy-log"), _copy_runs(spark, sf_dir, ["O", "P"], "yyyy-MM")
    bronze.append_copy_log(runs, RUN_TS, log)
    return bronze.append_copy_log(runs.where("pipeline_run_id LIKE '%-01'"), RUN_TS, log)


def _copy_runs(spark: SparkSession, sf_dir: str, failed: list[str], period: str = "yyyy-MM-dd") -> DataFrame:
    day = F.date_format("o_orderdate", period)

    def names(*statuses: str) -> Column:
        # At most five priorities exist, so the lists are short.
        return F.to_json(F.collect_set(F.when(F.col("o_orderstatus").isin(*statuses), F.col("o_orderpriority"))))

    return TestTables(spark, sf_dir).raw("orders").groupBy(day.alias("pipeline_run_id")).agg(
        names("F").alias("success_list"), names(*failed).alias("failed_list"))


@query
def c03_validate_bronze(spark, sf_dir):
    tables = TestTables(spark, sf_dir)
    return bronze.validate_bronze(
        spark, "Order_Details", tables.raw_order_details(), tables.incoming_order_details(), run_id=RUN_ID, run_ts=RUN_TS,
        expected=EXPECTED_API_ROWS["Order_Details"], is_excel=True).drop("combined_bronze_aggs", "excel_bronze_aggs", "dtypes")


@query
def x17_json_details(spark, sf_dir):
    """What the JSON fields of the validation record hold, one row for each feed, field and column."""
    tables = TestTables(spark, sf_dir)
    record = bronze.validate_bronze(spark, "Order_Details", tables.raw_order_details(), tables.incoming_order_details(),
                                    run_id=RUN_ID, run_ts=RUN_TS, is_excel=True)
    fields = ("null_counts_by_column", "combined_bronze_aggs", "dtypes")
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.from_json(f, "map<string,map<string,string>>").alias("held")) for f in fields]))
    feeds = record.select(each.alias("f")).select("f.field", F.explode("f.held").alias("feed", "entries"))
    shown = feeds.select("field", "feed", F.explode("entries").alias("name", "value"))
    number = F.when(F.col("field") != "dtypes", F.col("value").cast("double"))
    return shown.select("field", "feed", "name", number.alias("number"), F.when(F.col("field") == "dtypes", F.col("value")).alias("dtype"))


def _validation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = TestTables(spark, sf_dir)
    api = {"Categories": tables.categories, "Customers": tables.customers, "Employees": tables.employees,
           "Order_Details": tables.raw_order_details, "Orders": tables.orders, "Products": tables.products,
           "Regions": tables.regions, "Suppliers": tables.suppliers, "Territories": tables.territories,
           "Shippers": lambda: spark.read.parquet(f"{sf_dir}/no_such_table.parquet")}
    excel = {"Customers": tables.incoming_customers, "Orders": tables.incoming_orders,
             "Products": tables.incoming_products, "Order_Details": tables.incoming_order_details}
    expected = bronze.expected_counts(spark, '[{"table": "Regions", "count": 5}, {"name": "Employees", "row_count": 26}]')
    return bronze.validate_all(spark, KEYS, api, excel, new_path(spark, "validation-log"), run_id=RUN_ID, run_ts=RUN_TS,
                               expected=expected, excel_tables=excel)


@query
def c04_validation_log(spark, sf_dir):
    unread = F.col("failure_reason").startswith("AnalysisException")
    return _validation_log(spark, sf_dir).select(
        "table_name", "has_api", "has_excel", "status", F.when(unread, "unreadable").otherwise(F.col("failure_reason")).alias("failure_reason"),
        "api_count", "api_source_count", "api_count_match", "excel_count", "api_pk_duplicates", "excel_pk_duplicates",
        "inferred_pk", "required_null_count")


@query
def c04_validation_fields(spark, sf_dir):
    """The fields of every record that c04_validation_log leaves out, but for the JSON of columns."""
    return _validation_log(spark, sf_dir).select(
        "run_id", "run_timestamp", "table_name", "excel_source_count", "excel_count_match", "full_duplicate_count",
        "required_columns", "excel_source_aggs", "aggs_match", "agg_diffs")


@query
def c04_validation_summary(spark, sf_dir):
    return bronze.validation_summary(_validation_log(spark, sf_dir))


@query
def c05_page_diagnostic(spark, sf_dir):
    path = new_path(spark, "pages")
    _write_pages(_orders(spark, sf_dir), path)
    return pages.page_diagnostic(pages.scan_pages(spark, path), "Orders")


# ---- history ------------------------------------------------------------------------------------

def _feeds(spark: SparkSession, sf_dir: str, table: str) -> tuple[DataFrame, DataFrame]:
    tables = TestTables(spark, sf_dir)
    makers = {"Customers": (tables.customers, tables.incoming_customers), "Products": (tables.products, tables.incoming_products),
              "Orders": (tables.orders, tables.incoming_orders),
              "Order_Details": (tables.order_details, tables.incoming_order_details)}
    old, new = makers[table]
    return clean.prepare_feed(old(), MERGED[table]), clean.prepare_feed(new(), MERGED[table])


def _merged(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return history.merge(*_feeds(spark, sf_dir, table), MERGED[table], RUN_TS)


@query
def c06_merge_customers(spark, sf_dir):
    return _merged(spark, sf_dir, "Customers")


@query
def c06_merge_order_details(spark, sf_dir):
    return _merged(spark, sf_dir, "Order_Details")


@query
def c06_merge_products(spark, sf_dir):
    return _merged(spark, sf_dir, "Products")


@query
def c06_merge_orders(spark, sf_dir):
    """The baseline is stored bucketed by its key, so the join moves the feed alone."""
    tables, orders = TestTables(spark, sf_dir), MERGED["Orders"]
    stored = silver.store_baseline(tables.orders(), orders, _name("baseline_orders"), _tables_root(spark))
    return history.merge(clean.prepare_feed(stored, orders), clean.prepare_feed(tables.incoming_orders(), orders), orders, RUN_TS)


@query
def d02_history_is_not_deduplicated(spark, sf_dir):
    return clean.dedup(_merged(spark, sf_dir, "Orders"), ["OrderID"]).select("OrderID", "is_current", "operation")


@query
def u05_whole_row_distinct(spark, sf_dir):
    lines = TestTables(spark, sf_dir).raw("lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    return clean.dedup(lines, lines.columns)


@query
def a08_merge_counts(spark, sf_dir):
    return history.merge_counts(history.classify(*_feeds(spark, sf_dir, "Orders"), MERGED["Orders"]))


@query
def f02_historical_rows(spark, sf_dir):
    return gold.historical(_merged(spark, sf_dir, "Products")).select("ProductID", "UnitsInStock", "effective_end", "operation")


@query
def f04_rows_of_one_source(spark, sf_dir):
    merged = _merged(spark, sf_dir, "Orders")
    return gold.current(merged).where("source_system = 'Excel'").select("OrderID", "Freight", "operation")


def _run_merge(spark: SparkSession, sf_dir: str, schema: str) -> DataFrame:
    """Merge all four tables; the feed of Products is missing, so that one fails."""
    tables = TestTables(spark, sf_dir)
    old = {"Customers": tables.customers, "Products": tables.products, "Orders": tables.orders,
           "Order_Details": tables.order_details}
    new = {"Customers": tables.incoming_customers, "Orders": tables.incoming_orders,
           "Order_Details": tables.incoming_order_details}
    return silver.merge_run(spark, MERGED.values(), old, new, _tables_root(spark), RUN_TS, schema)


@query
def c07_merge_run(spark, sf_dir):
    log = _run_merge(spark, sf_dir, f"{_name('run')}_")
    return log.drop("run_timestamp").withColumn("error", F.when(F.col("status") == "FAILED", "failed"))


@query
def c07_merge_summary(spark, sf_dir):
    return silver.merge_summary(_run_merge(spark, sf_dir, f"{_name('run')}_"))


@query
def c08_merge_diagnostic(spark, sf_dir):
    schema = f"{_name('run')}_"
    _run_merge(spark, sf_dir, schema)
    bare = _name("bare")
    sinks.publish(TestTables(spark, sf_dir).regions(), bare, _tables_root(spark))
    found = silver.merge_diagnostic(spark, {**{t: f"{schema}{silver_name(t)}" for t in MERGED}, "Regions": bare})
    logical = F.when(F.col("table_name") == bare, "bare").otherwise(F.regexp_extract("table_name", "silver_.*", 0))
    return found.withColumn("table_name", logical)


# ---- Silver jobs --------------------------------------------------------------------------------

def _silver(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Silver tables, written once so that the checks read files."""
    tables = TestTables(spark, sf_dir)
    api_only = {n: getattr(tables, n.lower())() for n in names if n not in MERGED}
    merged = {n: _merged(spark, sf_dir, n) for n in names if n in MERGED}
    return silver.write(silver.build(api_only, merged, KEYS, RUN_TS, RUN_ID), new_path(spark, "silver"))


_silver_tables: dict[tuple[str, str], dict[str, DataFrame]] = {}


def silver_tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = tuple(KEYS)) -> dict[str, DataFrame]:
    """The named Silver tables; each is built when it is first asked for, and no other is built for it."""
    built = _silver_tables.setdefault((spark.sparkContext.applicationId, sf_dir), {})
    built.update(_silver(spark, sf_dir, [n for n in names if n not in built]))
    return {n: built[n] for n in names}


def _primary_keys(tables: dict[str, DataFrame]) -> dict[str, list[str]]:
    """Keys of the Silver tables, found among the current versions of their business columns."""
    return all_or_raise(for_each_table({
        n: partial(key_ops.infer_primary_key, gold.current(df).drop(*TECHNICAL_COLUMNS)) for n, df in tables.items()}))


@query
def c09_primary_keys(spark, sf_dir):
    found = _primary_keys(silver_tables(spark, sf_dir))
    return spark.createDataFrame([(n, ",".join(k)) for n, k in found.items()], "table_name string, primary_key string")


@query
def c09_wide_keys(spark, sf_dir):
    """A key of four columns, which only the proof of the fallback finds, and a table without any."""
    order, tables = F.col("o_orderkey"), TestTables(spark, sf_dir)
    wide = tables.raw("orders").select(*[(F.floor(order / 4 ** i) % 4).alias(f"part{i}_id") for i in range(3)],
                                       F.floor(order / 64).alias("rest_id"), "o_orderstatus")
    none = tables.raw("lineitem").select((F.col("l_orderkey") % 3).alias("a_id"), (F.col("l_partkey") % 2).alias("b_id"),
                                         (F.col("l_suppkey") % 2).alias("c_id"), (F.col("l_linenumber") % 2).alias("d_id"))
    found = {"orders_in_parts": key_ops.infer_key(wide), "lines_without_key": key_ops.infer_key(none)}
    return spark.createDataFrame([(n, ",".join(k.columns), k.proven) for n, k in found.items()],
                                 "table_name string, primary_key string, proven boolean")


@query
def c10_silver_merged(spark, sf_dir):
    return silver.refine_merged(_merged(spark, sf_dir, "Orders")).drop("row_hash")


for _table in KEYS:
    _queries[f"c10_silver_{_table.lower()}"] = lambda spark, sf_dir, table=_table: silver_tables(spark, sf_dir, [table])[table]


@query
def c10_silver_api_only(spark, sf_dir):
    return silver.build_api_only(TestTables(spark, sf_dir).suppliers(), ["SupplierID"], RUN_TS, RUN_ID)


@query
def c11_quality(spark, sf_dir):
    return silver.quality(silver_tables(spark, sf_dir), KEYS)


def _references(tables: dict[str, DataFrame]) -> list[tuple[str, str, str, str]]:
    return silver.references(tables, _primary_keys(tables), DECLARED_FOREIGN_KEYS)


@query
def c12_foreign_keys(spark, sf_dir):
    rows = _references(silver_tables(spark, sf_dir))
    return spark.createDataFrame(rows, "table_name string, column_name string, ref_table string, ref_column string")


@query
def c13_referential_integrity(spark, sf_dir):
    tables = silver_tables(spark, sf_dir)
    return silver.referential_integrity(tables, silver.references(tables, KEYS, DECLARED_FOREIGN_KEYS))


@query
def c15_provenance(spark, sf_dir):
    return silver.provenance(silver_tables(spark, sf_dir))


_checks: dict[tuple[str, str], dict[str, DataFrame]] = {}


def checks(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The checks of one folder's Silver tables as written records, which the later steps of a run read."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _checks:
        made = {f.__name__: f(spark, sf_dir) for f in (c11_quality, c13_referential_integrity, c15_provenance)}
        _checks[at] = all_or_raise(for_each_table({n: partial(materialise, df, n) for n, df in made.items()}))
    return _checks[at]


def _ready(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    found = checks(spark, sf_dir)
    return found["c11_quality"], silver.readiness(found["c11_quality"], found["c13_referential_integrity"])


@query
def c14_gold_readiness(spark, sf_dir):
    return _ready(spark, sf_dir)[1]


@query
def c14_quality_log(spark, sf_dir):
    return silver.quality_log(*_ready(spark, sf_dir), RUN_ID, RUN_TS).drop("details_json")


@query
def c14_quality_log_details(spark, sf_dir):
    """The whole quality log, JSON details among it, after the same run was logged twice."""
    log, records = new_path(spark, "quality-log"), silver.quality_log(*_ready(spark, sf_dir), RUN_ID, RUN_TS)
    silver.append_quality_log(records, log)
    return silver.append_quality_log(records, log)


_broken_runs: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _broken_run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A Silver run with a table whose source is missing, one with every key twice, and references to both."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _broken_runs:
        tables = TestTables(spark, sf_dir)

        def api_only(name: str, df: DataFrame) -> DataFrame:
            return silver.build_api_only(df, KEYS[name], RUN_TS, RUN_ID)

        def twice() -> DataFrame:
            suppliers = api_only("Suppliers", tables.suppliers())
            return suppliers.unionByName(suppliers)

        made = silver.run({
            "Shippers": lambda: api_only("Shippers", spark.read.parquet(f"{sf_dir}/no_such_table.parquet")),
            "Suppliers": twice, "Regions": lambda: api_only("Regions", tables.regions()),
            "Products": lambda: silver.refine_merged(_merged(spark, sf_dir, "Products")),
            "Orders": lambda: silver.refine_merged(_merged(spark, sf_dir, "Orders")),
        }, new_path(spark, "silver"))
        failures = made.failures(spark).withColumn("error", F.lit("failed"))  # the message names a path
        found = silver.references(made.tables, KEYS, DECLARED_FOREIGN_KEYS)
        _broken_runs[at] = {
            "quality": materialise(silver.quality(made.tables, KEYS, failures), "broken-quality"),
            "integrity": materialise(silver.referential_integrity(made.tables, found), "broken-integrity"),
            "sources": materialise(silver.provenance(made.tables, failures), "broken-sources"), "failures": failures}
    return _broken_runs[at]


def _broken_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = _broken_run(spark, sf_dir)
    return silver.readiness(checked["quality"], checked["integrity"], checked["failures"])


@query
def c14_readiness_of_a_broken_run(spark, sf_dir):
    return _broken_ready(spark, sf_dir)


@query
def c14_log_of_a_broken_run(spark, sf_dir):
    return silver.quality_log(_broken_run(spark, sf_dir)["quality"], _broken_ready(spark, sf_dir), RUN_ID, RUN_TS).drop("details_json")


@query
def c15_summary_of_a_broken_run(spark, sf_dir):
    checked = _broken_run(spark, sf_dir)
    return silver.summary(checked["quality"], _broken_ready(spark, sf_dir), checked["sources"])


@query
def c15_outcome_of_a_broken_run(spark, sf_dir):
    return silver.run_outcome(c15_summary_of_a_broken_run(spark, sf_dir))


@query
def c15_silver_summary(spark, sf_dir):
    return silver.summary(*_ready(spark, sf_dir), checks(spark, sf_dir)["c15_provenance"])


@query
def c15_run_outcome(spark, sf_dir):
    return silver.run_outcome(c15_silver_summary(spark, sf_dir))


# ---- Gold jobs ----------------------------------------------------------------------------------

def _dimension(name: str) -> Query:
    source = gold.COPIED_DIMENSIONS[name][0]
    return lambda spark, sf_dir: gold.copied_dimension(
        {source: getattr(TestTables(spark, sf_dir), source.lower())()}, name)


for _dim in gold.COPIED_DIMENSIONS:
    _queries[f"c16_{_dim.lower()}"] = _dimension(_dim)


@query
def c17_dimcategories(spark, sf_dir):
    return gold.dim_categories({"Categories": TestTables(spark, sf_dir).categories()})


@query
def c18_dimproducts(spark, sf_dir):
    tables = TestTables(spark, sf_dir)
    source = {"Categories": tables.categories(), "Suppliers": tables.suppliers(), "Products": tables.products()}
    return gold.dim_products(source, gold.dim_categories(source), gold.copied_dimension(source, "DimSuppliers"))


@query
def c19_dimdate(spark, sf_dir):
    return gold.dim_date(TestTables(spark, sf_dir).orders())


@query
def c20_sales_fact(spark, sf_dir):
    """The whole star from the source tables; the fact is returned."""
    root = new_path(spark, "gold")
    gold.build(TestTables(spark, sf_dir).all(), root)
    return gold.read(spark, root, ["Sales"])["Sales"].drop("OrderYear")


@query
def c20_sales_of_current_versions(spark, sf_dir):
    """The fact from merged history: only current versions of orders and lines count."""
    tables = dict(TestTables(spark, sf_dir).all())
    tables |= {n: _merged(spark, sf_dir, n) for n in ("Orders", "Order_Details")}
    root = new_path(spark, "gold")
    gold.build(tables, root)
    return gold.read(spark, root, ["Sales"])["Sales"].groupBy("ShipCountry").agg(
        F.count("*").alias("lines"), F.sum("Quantity").alias("quantity"), F.sum("LineTotal").cast("double").alias("line_total"))


_medallions: dict[tuple[str, str], Star] = {}


def medallion(spark: SparkSession, sf_dir: str) -> Star:
    """Both feeds landed, resolved, merged and refined; the star is built from the written Silver tables."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _medallions:
        tables, bronze_root, schema = TestTables(spark, sf_dir), new_path(spark, "bronze"), f"{_name('run')}_"
        all_or_raise(for_each_table({n: partial(df.write.parquet, f"{bronze_root}/bronze_{n}") for n, df in tables.all().items()}))
        sheets = {"Customers": tables.incoming_customers, "Products": tables.incoming_products,
                  "Orders": tables.incoming_orders, "OrderDetails": tables.incoming_order_details}
        bronze.land(spark, sheets, bronze_root, RUN_ID, RUN_TS)

        def landed(feed: str) -> dict[str, Callable[[], DataFrame]]:
            return {t: partial(reader.resolve, spark, bronze_root, t, feed) for t in MERGED}

        silver.merge_run(spark, MERGED.values(), landed("API"), landed("Excel"), _tables_root(spark), RUN_TS, schema)
        makers = {t: partial(lambda name: silver.refine_merged(spark.table(name)), f"{schema}{silver_name(t)}") for t in MERGED}
        makers |= {t: partial(lambda table: silver.build_api_only(reader.resolve(spark, bronze_root, table), KEYS[table], RUN_TS, RUN_ID), t)
                   for t in KEYS if t not in MERGED}
        made = silver.run(makers, new_path(spark, "silver"))
        all_or_raise(made.errors)
        root = new_path(spark, "gold")
        gold.build(made.tables, root)
        _medallions[at] = gold.open_star(spark, root)
    return _medallions[at]


@query
def c22_report_from_bronze(spark, sf_dir):
    """Bronze to Silver to Gold to a report: sales by year and category from what the jobs wrote."""
    return m.values(medallion(spark, sf_dir), ["DimDate.Year", "DimCategories.CategoryName"], "total_sales", "line_total", "total_orders",
                    "active_customers", "total_quantity")


@query
def c20_fact_from_bronze(spark, sf_dir):
    """The fact at the end of the same chain, by country: lines, amounts and how many keys were found."""
    return medallion(spark, sf_dir).tables["Sales"].groupBy("ShipCountry").agg(
        F.count("*").alias("lines"), F.sum("Quantity").alias("quantity"), F.sum("LineTotal").cast("double").alias("line_total"),
        F.count("CustomerKey").alias("customers"), F.count("ProductKey").alias("products"), F.count("EmployeeKey").alias("employees"),
        F.count("ShipperKey").alias("shippers"), F.count("OrderDateKey").alias("dated"))


@query
def c21_sync_table(spark, sf_dir):
    """First sync creates, second has the columns in another order, third has one more."""
    name, root = _name("dim_orders"), _tables_root(spark)
    orders = _orders(spark, sf_dir)
    actions = [sinks.sync(orders.where("o_orderstatus = 'P'"), name, root),
               sinks.sync(orders.select(*reversed(orders.columns)), name, root)]
    kept_order = spark.table(name).columns == orders.columns
    actions.append(sinks.sync(orders.withColumn("extra", F.lit(1)), name, root))
    return spark.table(name).withColumn("actions", F.lit(",".join(actions))).withColumn("kept_order", F.lit(kept_order))


@query
def u04_column_and_row_difference(spark, sf_dir):
    """Rows that two versions of a table do not share, by side."""
    base, other = TestTables(spark, sf_dir).shippers(), TestTables(spark, sf_dir).regions().toDF("ShipperID", "CompanyName")
    other = other.where("ShipperID > 0").unionByName(
        TestTables(spark, sf_dir).employees().select(F.col("EmployeeID").alias("ShipperID"), F.col("FirstName").alias("CompanyName")))
    return _expanded(sinks.row_difference(base, other))


def _expanded(difference: DataFrame) -> DataFrame:
    """One row for each copy."""
    return difference.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).drop("copies")


@query
def u04_difference_of_two_versions(spark, sf_dir):
    """All orders against a later version: some changed, some gone, some twice."""
    before = _orders(spark, sf_dir)
    key = F.col("o_orderkey")
    after = before.where(key % 7 > 0).withColumn("o_totalprice", F.when(key % 10 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return sinks.row_difference(before, after.unionByName(after.where(key % 9 == 0)))


# ---- scalar functions, ranking ------------------------------------------------------------------

@query
def x05_number_formats(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    price = F.col("o_totalprice")
    share = F.col("o_custkey") / 1000
    return orders.select("o_orderkey", whole(price).alias("whole"), dollars(price).alias("dollars"),
                         fixed(F.col("o_custkey") / 8, 1).alias("one_digit"), percent(share).alias("pct"),
                         percent(share, 1).alias("pct1"))


@query
def x11_week_of_year(spark, sf_dir):
    return TestTables(spark, sf_dir).raw("orders").select("o_orderkey", us_week(F.col("o_orderdate").cast("date")).alias("week"))


@query
def t02_top_with_ties(spark, sf_dir):
    """Parts by number of lines: the tenth value is tied."""
    parts = TestTables(spark, sf_dir).raw("lineitem").groupBy("l_partkey").agg(F.count("*").alias("line_count"))
    return ranking.top_with_ties(parts, "line_count", 10)


@query
def t02_bottom_with_ties(spark, sf_dir):
    parts = TestTables(spark, sf_dir).raw("lineitem").groupBy("l_partkey").agg(F.count("*").alias("line_count"))
    return ranking.top_with_ties(parts, "line_count", 10, largest=False)


@query
def w01_number_orders(spark, sf_dir):
    return ranking.number_rows(_orders(spark, sf_dir).select("o_totalprice", "o_orderkey"), "row_key", "o_orderkey")


on_star("f03_category_range", lambda s: s.tables["DimProducts"].where(F.col("CategoryID").between(1, 8)).groupBy("CategoryID").agg(F.count("*").alias("products")))
on_star("f05_year_list", lambda s: m.values(s.filtered({"DimDate.Year": reports.REPORT_YEARS}), ["DimDate.Year"], "line_total"))
on_star("f06_shared_filters", lambda s: m.values(s.filtered(SHARED), ["DimDate.Year", "DimCategories.CategoryName"], "total_sales", "total_orders", "active_customers"))
on_star("f10_share_under_filters", lambda s: m.category_share(s.filtered(SHARED)))
on_star("j10_sales_by_ship_year", lambda s: m.values(replace(s, date_role="shipped"), ["DimDate.Year"], "total_sales"))
on_star("j10_sales_by_required_year", lambda s: m.values(replace(s, date_role="required"), ["DimDate.Year"], "total_sales"))

# ---- measures -----------------------------------------------------------------------------------

YEAR, YEAR_MONTH = ["DimDate.Year"], ["DimDate.Year", "DimDate.Month"]
PRODUCT = ["DimProducts.ProductName"]
YEAR_CATEGORY = ["DimDate.Year", "DimCategories.CategoryName"]

on_star("m01_total_sales", lambda s: m.values(s, ["DimDate.Year", "DimCategories.CategoryName"], "total_sales"))
on_star("m02_total_orders", lambda s: m.values(s, ["Sales.ShipCountry"], "total_orders"))
on_star("m03_total_quantity", lambda s: m.values(s, YEAR, "total_quantity"))
on_star("m04_avg_order_value", lambda s: m.average_order_value(s, ["DimCustomers.ContactTitle"]))
on_star("m05_total_customers", lambda s: m.total_customers(s.filtered({"DimCustomers.Region": ["ASIA", "EUROPE"], "DimDate.Year": [1997]})))
on_star("m05_all_customers", m.total_customers)
on_star("m06_products_sold", lambda s: m.values(s, YEAR, "products_sold"))
on_star("m07_total_freight", lambda s: m.values(s, ["DimShippers.CompanyName"], "total_freight"))
on_star("m08_sales_last_year", lambda s: m.sales_last_year(s, YEAR_MONTH))
on_star("m08_by_category", lambda s: m.sales_last_year(s, YEAR_CATEGORY))
on_star("m09_by_category", lambda s: m.year_over_year(s, YEAR_CATEGORY))
on_star("m09_total", lambda s: m.year_over_year(s, []))
on_star("m10_by_country", lambda s: m.sales_year_to_date(s, ["DimDate.Year", "DimDate.Month", "Sales.ShipCountry"]))
on_star("m10_by_category", lambda s: m.sales_year_to_date(s, ["DimCategories.CategoryName"]))
on_star("m09_sales_yoy", lambda s: m.year_over_year(s, YEAR))
on_star("m10_sales_ytd", lambda s: m.sales_year_to_date(s, YEAR_MONTH))
on_star("m11_best_year_sales", lambda s: m.best_year(s.filtered({"DimDate.Year": [1999]})).select("best_year_sales"))
on_star("m12_best_year", lambda s: m.best_year(s).select(F.col("best_year").cast("string").alias("best_year")))
on_star("m13_top_category", lambda s: m.top_category(s).select("top_category"))
on_star("m14_all_years", lambda s: m.top_category(s).select("top_category_sales"))
on_star("m14_top_category_sales", lambda s: m.top_category(s.filtered({"DimDate.Year": [1997]})).select("top_category_sales"))
on_star("m15_peak_month", lambda s: m.peak_month(s).select("peak_month"))
on_star("m16_peak_month_sales", lambda s: m.peak_month(s).select("peak_month_sales"))
on_star("m17_top10_customers_sales", lambda s: m.top_customers_sales(s).select("top10_customers_sales"))
on_star("m18_top10_share", lambda s: m.top_customers_sales(s.filtered({"DimCustomers.Region": ["ASIA"]})).select("top10_share"))
on_star("m18_all_customers", lambda s: m.top_customers_sales(s).select("top10_share"))
on_star("m11_all_years", lambda s: m.best_year(s).select("best_year_sales"))
on_star("m28_all_years", insights.glance_recommendation)
on_star("m49_all_categories", m.reorder_table)
on_star("m50_all_years", lambda s: insights.glance_insight(s, COMPANY))
on_star("m19_active_customers", lambda s: m.values(s, YEAR, "active_customers"))
on_star("m20_on_time_rate", lambda s: m.on_time_rate(s, ["DimShippers.CompanyName"]))
on_star("m21_unshipped_orders", lambda s: m.values(s, ["Sales.ShipCountry"], "unshipped_orders"))
on_star("m22_avg_delivery_days", lambda s: m.average_delivery_days(s, ["DimEmployees.FirstName"]))
on_star("m23_needs_reorder", lambda s: m.needs_reorder(s, PRODUCT))
on_star("m23_needs_reorder_by_supplier", lambda s: m.needs_reorder(s, ["DimSuppliers.CompanyName"]))
on_star("m33_selected_product_by_category", lambda s: m.product_card(s, ["DimCategories.CategoryName"]).select("CategoryName", "selected_product"))
on_star("m24_growth_recommendation", insights.growth_recommendation)
on_star("m25_operations_recommendation", insights.operations_recommendation)
on_star("m26_buying_recommendation", insights.buying_recommendation)
on_star("m27_selling_recommendation", insights.selling_recommendation)
on_star("m28_glance_recommendation", lambda s: insights.glance_recommendation(s.filtered({"DimDate.Year": [1996, 1997]})))
on_star("m29_seasonality_insight", insights.seasonality_insight)
on_star("m30_seasonality_recommendation", insights.seasonality_recommendation)
on_star("m31_inventory_insight", insights.inventory_insight)
on_star("m32_inventory_recommendation", insights.inventory_recommendation)
on_star("m33_selected_product", lambda s: m.product_card(s, ["DimProducts.CategoryKey", "DimProducts.SupplierKey"]).select("CategoryKey", "SupplierKey", "selected_product"))
on_star("m34_selected_category", lambda s: m.product_card(s, ["DimProducts.CategoryID"]).select("CategoryID", "selected_category"))
on_star("m35_selected_supplier", lambda s: m.product_card(s, PRODUCT).select("ProductName", "selected_supplier"))
on_star("m36_selected_unit_price", lambda s: m.product_card(s, PRODUCT).select("ProductName", "selected_unit_price"))
on_star("m37_selected_units_in_stock", lambda s: m.product_card(s, PRODUCT).select("ProductName", "selected_units_in_stock"))
on_star("m38_selected_reorder_level", lambda s: m.product_card(s, PRODUCT).select("ProductName", "selected_reorder_level"))
on_star("m39_product_quantity", lambda s: m.values(s, PRODUCT, "total_quantity"))
on_star("m40_reorder_flag", lambda s: m.product_card(s, PRODUCT).select("ProductName", "reorder_flag"))
on_star("m41_category_share", m.category_share)
on_star("m42_category_rank", m.category_rank)
on_star("m43_category_top_product", m.category_top_product)
on_star("m44_total_sales_card", insights.total_sales_card)
on_star("m45_total_orders_card", insights.total_orders_card)
on_star("m46_active_customers_card", insights.active_customers_card)
on_star("m47_avg_order_value_card", insights.average_order_card)
on_star("m48_reorder_rows", m.reorder_table)
on_star("m49_inventory_replenishment", lambda s: m.reorder_table(s.filtered({"DimCategories.CategoryName": ["Category 1", "Others"]})))
on_star("m50_glance_insight", lambda s: insights.glance_insight(s.filtered({"DimDate.Year": [1997]}), COMPANY))
on_star("m51_growth_insight", insights.growth_insight)
on_star("m52_selling_insight", insights.selling_insight)
on_star("m53_buying_insight", insights.buying_insight)
on_star("m54_operations_insight", insights.operations_insight)

# ---- reports ------------------------------------------------------------------------------------

on_star("r01_totals", reports.totals)
on_star("r02_totals_by_title", reports.totals_by_title)
on_star("r03_top_products", reports.top_products)
on_star("r04_sales_by_category", reports.sales_by_category)
on_star("r05_best_of", reports.best_of)
on_star("r06_top_customers", reports.top_customers)
on_star("r07_sales_by_city", reports.sales_by_city)
on_star("r08_customers_by_year", reports.customers_by_year)
on_star("r09_top_customer_share", reports.top_customer_share)
on_star("r10_average_freight", reports.average_freight)
on_star("r11_top_employees", reports.top_employees)
on_star("r12_operations", reports.operations)
on_star("r13_reorder_table", reports.reorder_table)
on_star("r14_customer_profile", lambda s: reports.customer_profile(s, DRILL_CUSTOMER))
on_star("r14_customer_years", lambda s: reports.customer_years(s, DRILL_CUSTOMER))
on_star("r14_customer_lines", lambda s: reports.customer_lines(s, DRILL_CUSTOMER))
on_star("r14_customer_products", lambda s: reports.customer_products(s, DRILL_CUSTOMER))
on_star("r15_category_tooltip", reports.category_tooltip)
on_star("r16_product_tooltip", reports.product_tooltip)
on_star("r17_insights_page", reports.insights.insights_page)
on_star("r18_growth_page", reports.growth_page)
on_star("r19_filter_values", reports.filter_values)
