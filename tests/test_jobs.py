import json

from pyspark.sql import functions as F

from tradewell.config import MERGED
from tradewell.operators import history, profile
from tradewell.operators.clean import prepare_feed
from tradewell.plans import bronze, silver

RUN = {"run_id": "r", "run_ts": "t"}


def test_validation_names_every_fault(spark):
    api = spark.createDataFrame([(1, 1), (1, 1), (None, 2), (3, 3)], "OrderID int, ProductID int")
    row = bronze.validate_bronze(spark, "Order_Details", api, None, expected="5", is_excel=True, **RUN).first()
    assert row.status == "FAILED" and len(row) == 26
    assert row.failure_reason == ("no Excel Bronze data found; API count mismatch: expected=5, actual=4; "
                                  "1 duplicate API PK rows; 1 required PK NULL rows")
    assert json.loads(row.null_counts_by_column) == {"API": {"OrderID": 1, "ProductID": 0}, "Excel": {}}
    assert json.loads(row.combined_bronze_aggs)["API"]["ProductID_sum"] == 7.0


def test_validation_passes_and_tolerates_bad_expectations(spark):
    api = spark.createDataFrame([(1,), (2,)], "RegionID int")
    row = bronze.validate_bronze(spark, "Regions", api, None, expected="many", **RUN).first()
    assert (row.status, row.failure_reason, row.api_count_match) == ("PASSED", "validation passed", None)
    no_key = bronze.validate_bronze(spark, "Regions", api.toDF("x"), None, **RUN).first()
    assert no_key.failure_reason == "required primary key not found"


def test_expected_counts_in_both_shapes(spark):
    assert bronze.expected_counts(spark, '{"A": 1}') == {"A": "1"}
    assert bronze.expected_counts(spark, '[{"table": "A", "count": 0}, {"name": "B", "row_count": 2}, {"count": 1}]') == {"A": "0", "B": "2"}
    assert bronze.expected_counts(spark, "not json") == {} and bronze.expected_counts(spark, None) == {}


def test_a_failing_table_costs_only_its_own_record(spark, root):
    def broken():
        return spark.range(1).select(F.raise_error(F.lit("boom")).cast("bigint").alias("RegionID"))

    api = {"Regions": broken, "Shippers": lambda: spark.range(3).toDF("ShipperID")}
    log = bronze.validate_all(spark, ["Regions", "Shippers"], api, {}, f"{root}/log", **RUN)
    found = {r.table_name: (r.status, "boom" in r.failure_reason) for r in log.collect()}
    assert found == {"Regions": ("FAILED", True), "Shippers": ("PASSED", False)}
    summary = bronze.validation_summary(log).first()
    assert (summary.passed_tables, summary.failed_tables) == ("Shippers", "Regions")


def test_landing_records_empty_and_broken_sheets(spark, root):
    sheets = {"OrderDetails": lambda: spark.createDataFrame([(1, float("nan"))], "`Order ID` int, price double"),
              "Empty": lambda: spark.range(0), "Broken": lambda: spark.read.parquet(f"{root}/none")}
    log = {r.table_name: r for r in bronze.land(spark, sheets, root, "r", "t").collect()}
    assert (log["Order_Details"].row_count, log["Order_Details"].column_count, log["Order_Details"].numeric_column_count) == (1, 3, 2)
    assert log["Empty"].error == "Empty sheet" and log["Broken"].row_count is None and log["Broken"].error
    landed = spark.read.parquet(f"{root}/bronze_excel_Order_Details").first()
    assert landed.asDict() == {"Order_ID": 1, "price": None, "source_system": "Excel"}


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, source_system string")
    assert [tuple(r) for r in profile.null_counts(df).collect()] == [("a", 1, 33.33)]


def test_duplicates_count_null_keys(spark):
    df = spark.createDataFrame([(None, True), (None, False), (1, True), (1, True)], "k int, is_current boolean")
    row = spark.range(1).select(profile.duplicate_keys(df, ["k"], F.col("is_current")).alias("d")).first().d
    assert (row["all"], row["among"]) == (2, 1)
    none = spark.range(1).select(profile.duplicate_keys(df.where("false"), ["k"]).alias("d"), profile.duplicate_keys(df, []).alias("e")).first()
    assert tuple(none.d) == tuple(none.e) == (0, 0)


def test_profiles_need_no_expand(spark):
    df = spark.createDataFrame([(1, 2, True, "x")], "k int, j int, is_current boolean, v string")
    for question in (silver.quality_record(df, "T", ["k", "j"]), profile.source_profile(df, ["k", "j"])):
        assert "Expand" not in question._jdf.queryExecution().executedPlan().toString()


def test_a_copy_run_that_reports_again_replaces_its_rows(spark, root):
    def runs(*rows):
        return spark.createDataFrame(rows, "pipeline_run_id string, success_list string, failed_list string")

    bronze.append_copy_log(runs(("1", '["A"]', '["B"]'), ("2", '["A"]', "[]")), "t1", f"{root}/copy")
    log = bronze.append_copy_log(runs(("1", '["A", "B"]', None)), "t2", f"{root}/copy")
    assert sorted(tuple(r) for r in log.select("pipeline_run_id", "table_name", "status", "run_timestamp").collect()) == [
        ("1", "A", "SUCCESS", "t2"), ("1", "B", "SUCCESS", "t2"), ("2", "A", "SUCCESS", "t1")]


def test_a_repeated_run_is_logged_once(spark, root):
    api = {"Shippers": lambda: spark.range(3).toDF("ShipperID")}
    for _ in range(2):
        log = bronze.validate_all(spark, ["Shippers"], api, {}, f"{root}/log", **RUN)
        landed = bronze.land(spark, {"A": lambda: spark.range(2)}, root, "r", "t")
    assert log.count() == 1 and landed.count() == 1
    assert bronze.land(spark, {"A": lambda: spark.range(2)}, root, "r2", "t").count() == 2


def test_a_silver_run_survives_a_failing_table(spark, root):
    def broken():
        return spark.range(1).select(F.raise_error(F.lit("boom")).cast("bigint").alias("a_id"))

    def stamped(rows, schema):
        return lambda: spark.createDataFrame(rows, schema).withColumn("is_current", F.lit(True)).withColumn("source_system", F.lit("API"))

    made = silver.run({"A": broken, "B": stamped([(1, 7), (1, 7), (2, 9)], "b_id int, c_id int"), "C": stamped([(7,)], "c_id int")}, root)
    assert list(made.errors) == ["A"] and set(made.tables) == {"B", "C"}
    keys = {"A": ["a_id"], "B": ["b_id"], "C": ["c_id"]}
    failures = made.failures(spark)
    records = silver.quality(made.tables, keys, failures)
    integrity = silver.referential_integrity(made.tables, silver.references(made.tables, keys, [("B", "b_id", "A", "a_id")]))
    ready = silver.readiness(records, integrity, failures)
    assert {r.table_name: (r.gold_ready, r.reasons) for r in ready.collect()} == {
        "A": (False, "Silver transformation failed"), "C": (True, ""),
        "B": (False, "Duplicate current keys found; Referential integrity failures: c_id -> C.c_id")}
    final = silver.summary(records, ready, silver.provenance(made.tables, failures))
    rows = {r["table"]: r for r in final.collect()}
    assert rows["silver_a"].status == "FAILED" and "boom" in rows["silver_a"].error and rows["silver_a"].all_api_rows == 0
    outcome = silver.run_outcome(final).first()
    assert tuple(outcome) == ("FAILED", 3, 1, 2, 2)
    first = silver.append_quality_log(silver.quality_log(records, ready, "r", "t"), f"{root}/dq").count()
    assert first == silver.append_quality_log(silver.quality_log(records, ready, "r", "t"), f"{root}/dq").count() == 3


def test_merge_moves_the_feed_alone(spark, root):
    details = MERGED["Order_Details"]
    rows = [(i, i % 7, i, 1.0, 0.0) for i in range(50)]
    old, new = (spark.createDataFrame(r, "OrderID bigint, ProductID bigint, Quantity bigint, UnitPrice double, Discount double") for r in (rows, rows[:9]))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = silver.store_baseline(old, details, "t_bucketed", root)
        merged = history.merge(prepare_feed(stored, details), prepare_feed(new.withColumn("Quantity", F.col("Quantity") + 1), details), details,
                               "2026-03-01 00:00:00")
        plan = merged._jdf.queryExecution().executedPlan().toString()
        baseline = plan[:plan.index("Scan ExistingRDD")] if plan.index("FileScan") < plan.index("Scan ExistingRDD") else plan[plan.index("FileScan"):]
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and baseline
        assert merged.count() == 59
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_quality_gates_on_current_duplicates(spark):
    history_ok = spark.createDataFrame([(1, True, None), (1, False, "x")], "k int, is_current boolean, v string")
    broken = spark.createDataFrame([(1, True, None), (1, True, "x")], "k int, is_current boolean, v string")
    records = {n: silver.quality_record(df, n, ["k"]).first() for n, df in (("ok", history_ok), ("bad", broken))}
    assert (records["ok"].status, records["ok"].duplicate_pk_count, records["ok"].historical_rows) == ("PASSED", 1, 1)
    assert (records["bad"].status, records["bad"].reason) == ("FAILED", "1 duplicate current PK rows")
    assert json.loads(records["ok"].nulls) == {"v": {"null_count": 1, "null_pct": 50.0}}


def test_readiness_lists_broken_references(spark):
    tables = {"A": spark.createDataFrame([(1, 9, 8)], "a_id int, b_id int, c_id int"),
              "B": spark.createDataFrame([(1,)], "b_id int"), "C": spark.createDataFrame([(1,)], "c_id int")}
    keys = {"A": ["a_id"], "B": ["b_id"], "C": ["c_id"]}
    found = silver.references(tables, keys, [("A", "missing", "B", "b_id")])
    assert found == [("A", "b_id", "B", "b_id"), ("A", "c_id", "C", "c_id")]
    ready = {r.table_name: r for r in silver.readiness(
        silver.quality(tables, keys), silver.referential_integrity(tables, found)).collect()}
    assert ready["A"].reasons == "Referential integrity failures: b_id -> B.b_id, c_id -> C.c_id"
    assert not ready["A"].gold_ready and ready["B"].gold_ready


def test_merge_run_isolates_a_failure(spark, root):
    details = MERGED["Order_Details"]
    old = spark.createDataFrame([(1, 1, 2, 3.0, 0.0)], "OrderID int, ProductID int, Quantity int, UnitPrice double, Discount double")
    log = silver.merge_run(spark, [details, MERGED["Orders"]], {"Order_Details": lambda: old}, {"Order_Details": lambda: old},
                           root, "2026-01-02 00:00:00", "t_run_")
    found = {r.sheet: r for r in log.collect()}
    assert (found["Order_Details"].unchanged_rows, found["Order_Details"].net_row_change) == (1, 0)
    assert found["Orders"].status == "FAILED"
    assert silver.merge_summary(log).first().overall_status == "FAILED"
    assert spark.table("t_run_silver_order_details").count() == 1


def test_api_only_table_is_stamped(spark):
    df = spark.createDataFrame([(1, " a "), (1, " a "), (None, "x")], "RegionID int, RegionDescription string")
    row = silver.build_api_only(df, ["RegionID"], "2026-01-02 00:00:00", "r1").collect()
    assert len(row) == 1 and row[0].RegionDescription == "a" and row[0]._run_id == "r1" and row[0].is_current
    assert list(history.VERSION_COLUMNS) == [c for c in row[0].asDict() if c in history.VERSION_COLUMNS]
