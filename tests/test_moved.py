"""What joins and builds move: no hashes, no columns that decide nothing, no tables that nobody asked for."""

import datetime
import re

from pyspark.sql import functions as F

from tradewell import entries
from tradewell.config import Entity
from tradewell.operators import history
from tradewell.plans import gold
from tradewell.sources.adapter import TestTables

ORDERS = Entity("T", ["k"], ["v"])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below_exchanges(text):
    """Lines of a plan that lie under a shuffle."""
    depth = lambda line: len(re.match(r"[\s:|+\-]*", line).group())
    found, under = [], None
    for line in text.splitlines():
        if under is not None and depth(line) <= under:
            under = None
        if under is not None:
            found.append(line)
        elif "Exchange hashpartitioning" in line:
            under = depth(line)
    return found


def test_merge_takes_hashes_after_its_join(spark):
    old = spark.range(50).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    new = spark.range(25, 75).select(F.col("id").alias("k"), F.lit("b").alias("v"))
    joined = history.merge(old.hint("merge"), new, ORDERS, "2026-03-01 00:00:00")
    text = plan(joined)
    assert "sha2" in text and below_exchanges(text)
    assert not [line for line in below_exchanges(text) if "sha2" in line]
    assert joined.count() == 100 and joined.where("row_hash IS NULL").count() == 0


def _tables(spark, root):
    day = datetime.datetime(1997, 1, 1)
    for name, rows, schema in (
            ("region", [(0, "R")], "r_regionkey int, r_name string"),
            ("nation", [(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
            ("part", [(1, "p", "b", "t", 3, 2.5)], "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
            ("lineitem", [(1, 1, 1, 1, 5.0, 9.0, 0.1, 0.3, "A", "F", day), (1, 1, 1, 1, 5.0, 9.0, 0.2, 0.0, "A", "F", day),
                          (1, 1, 2, 1, 4.0, 1.0, 0.0, 0.0, "A", "F", day)],
             "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
             "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def test_lines_are_chosen_by_the_columns_that_show(spark, root):
    details = TestTables(spark, _tables(spark, root)).order_details()
    assert [tuple(r) for r in details.collect()] == [(1, 1, 5, 2.5, 0.1)]
    assert "l_returnflag" not in plan(details) and "l_tax" not in plan(details)


def test_a_silver_table_is_built_alone(spark, root):
    """The folder has no orders, customers or suppliers, so no other table could be built."""
    _tables(spark, root)
    assert [r.TerritoryID for r in entries.queries()["c10_silver_territories"](spark, root).collect()] == ["0"]
    assert [r.CategoryID for r in entries.queries()["c10_silver_categories"](spark, root).collect()] == [4]


def test_fact_is_dealt_before_it_is_computed(spark, root):
    """What follows from a line's own columns is not moved; the product is looked up while lines are narrow."""
    day = datetime.datetime(1997, 1, 2)
    orders = spark.createDataFrame([(1, "c", 1, 1, day, day, None, 2.5, "N", "R")], "OrderID bigint, CustomerID string, EmployeeID bigint, "
                                   "ShipVia bigint, OrderDate timestamp, RequiredDate timestamp, ShippedDate timestamp, Freight double, "
                                   "ShipCountry string, ShipRegion string")
    lines = spark.createDataFrame([(1, 7, 2, 3.0, 0.5)], "OrderID bigint, ProductID bigint, Quantity bigint, UnitPrice double, Discount double")
    dims = {n: spark.createDataFrame([(1, k)], f"{key} bigint, {business} {kind}") for n, key, business, k, kind in (
        ("DimCustomers", "CustomerKey", "CustomerID", "c", "string"), ("DimEmployees", "EmployeeKey", "EmployeeID", 1, "bigint"),
        ("DimShippers", "ShipperKey", "ShipperID", 1, "bigint"), ("DimProducts", "ProductKey", "ProductID", 7, "bigint"))}
    silver = {"Orders": orders, "Order_Details": lines}
    moved = gold.sales_lines(silver, dims | {"DimDate": gold.dim_date(orders)})
    assert not {"LineTotal", "DeliveryDays", "OnTimeFlag"} & set(moved.columns)
    gold.write_fact(moved, f"{root}/Sales", finish=gold.computed)
    found = spark.read.parquet(f"{root}/Sales")
    assert found.columns == [*gold.sales(silver, dims | {"DimDate": gold.dim_date(orders)}).columns, "OrderYear"]
    assert [(float(r.LineTotal), r.DeliveryDays, r.OnTimeFlag, r.ProductKey, r.OrderYear) for r in found.collect()] == [(3.0, None, None, 1, 1997)]


def test_lines_are_dealt_before_they_are_sorted(spark, root):
    """No task sorts all lines that it reads of a large file."""
    details = TestTables(spark, _tables(spark, root)).order_details()
    assert not [line for line in below_exchanges(plan(details)) if re.search(r"\bSort\b", line) and "l_linenumber" in line and "Window" not in line
                and _under_scan_side(plan(details), line)]


def _under_scan_side(text, line):
    """Whether the sort has no shuffle by pair below it."""
    lines = text.splitlines()
    rest = lines[lines.index(line) + 1:]
    return not any("hashpartitioning(l_orderkey" in x for x in rest)
