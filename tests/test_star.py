import datetime
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tradewell.functions import money
from tradewell.operators.ranking import number_rows, top_with_ties
from tradewell.plans import gold, insights, reports
from tradewell.plans import measures as m
from tradewell.plans.star import Ask, Star


def day(text):
    return None if text is None else datetime.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """A hand-made shop: late, early and unshipped orders, ties, a stray line and an unknown product."""
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    orders = [(1, "A", 1, "1996-01-05", "1996-02-01", "1996-01-10", 1, 10.0, "X"),
              (2, "B", 2, "1997-01-05", "1997-01-20", "1997-02-01", 2, 20.0, "Y"),
              (3, "A", 1, "1997-12-31", "1998-01-30", None, 1, 30.0, "X"),
              (4, "B", 2, "1996-02-29", None, "1996-03-01", 9, 40.0, None)]
    current = [(*o[:3], *map(day, o[3:6]), *o[6:], None, True) for o in orders]
    closed = (1, "B", 2, *map(day, ("2005-01-01", "2005-01-01", "2005-01-01")), 1, 99.0, "Z", None, False)
    silver = {
        "Customers": frame([("A", "Anna", True), ("B", "Bob", True), ("B", "Bobby", False)], "CustomerID string, CompanyName string, is_current boolean"),
        "Employees": frame([(2, "Lee", "Kim"), (1, "Ray", "Joe")], "EmployeeID bigint, LastName string, FirstName string"),
        "Suppliers": frame([(1, "S1")], "SupplierID bigint, CompanyName string"),
        "Shippers": frame([(1, "Fast"), (2, "Slow")], "ShipperID bigint, CompanyName string"),
        "Regions": frame([(1, "R")], "RegionID bigint, RegionDescription string"),
        "Territories": frame([("10", "T", 1), ("9", "U", 1)], "TerritoryID string, TerritoryDescription string, RegionID bigint"),
        "Categories": frame([(1, "One"), (2, "Two"), (9, "Nine")], "CategoryID bigint, CategoryName string"),
        "Products": frame([(1, "P1", 1, 1, 5, 9), (2, "P2", 1, 2, None, 3), (3, "P3", 7, 9, 4, None), (4, "P4", 1, None, 1, 1), (5, "P5", 1, 0, 1, 0), (6, "P6", 1, 8, 2, 1)],
                          "ProductID bigint, ProductName string, SupplierID bigint, CategoryID bigint, UnitsInStock bigint, ReorderLevel bigint"),
        "Orders": frame([*current, closed], "OrderID bigint, CustomerID string, EmployeeID bigint, OrderDate timestamp, RequiredDate timestamp, "
                        "ShippedDate timestamp, ShipVia bigint, Freight double, ShipCountry string, ShipRegion string, is_current boolean"),
        "Order_Details": frame([(1, 1, 2, 10.0, 0.0, True), (1, 2, 2, 10.0, 0.0, True), (2, 3, 1, 33.33, 0.15, True), (3, 1, 4, 10.0, 0.5, True),
                                (4, 4, 1, 1.0, 0.0, True), (99, 1, 1, 1.0, 0.0, True), (1, 77, 1, 0.5, 0.0, True), (2, 1, 50, 50.0, 0.0, False)],
                               "OrderID bigint, ProductID bigint, Quantity bigint, UnitPrice double, Discount double, is_current boolean"),
    }
    root = str(tmp_path_factory.mktemp("gold"))
    gold.build(silver, root)
    return gold.open_star(spark, root)


@pytest.fixture(params=["broadcast", "sorted"])
def star(request, spark, built):
    """Lookups that Spark broadcasts and lookups that it sorts must agree, so every question is asked of both."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "sorted":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield built
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_categories_and_bucket(built):
    assert rows(built.tables["DimCategories"].select("CategoryKey", "CategoryID", "CategoryName")) == [
        (1, 1, "One"), (2, 2, "Two"), (3, -1, "Others")]
    keys = dict(built.tables["DimProducts"].select("ProductID", "CategoryKey").collect())
    assert keys == {1: 1, 2: 2, 3: 3, 4: 3, 5: 3, 6: None}  # 8 is in range but has no category row


def test_keys_follow_text_order(built):
    assert rows(built.tables["DimTerritories"].select("TerritoryKey", "TerritoryID")) == [(1, "10"), (2, "9")]
    assert rows(built.tables["DimCustomers"].select("CustomerKey", "CompanyName")) == [(1, "Anna"), (2, "Bob")]


def test_calendar(built):
    dates = built.tables["DimDate"]
    assert dates.agg(F.min("FullDate"), F.max("FullDate"), F.count("*")).first() == (
        datetime.date(1995, 12, 29), datetime.date(1998, 2, 6), 771)
    leap = dates.where("DateKey = 19960229").first()
    assert (leap.Year, leap.Quarter, leap.Month, leap.MonthName, leap.Day, leap.DayName) == (1996, 1, 2, "February", 29, "Thursday")


def test_fact_rows(built):
    facts = {(r.OrderID, r.ProductID): r for r in built.tables["Sales"].collect()}
    assert len(facts) == 7
    late, unshipped, stray, unknown = facts[2, 3], facts[3, 1], facts[99, 1], facts[1, 77]
    assert (str(late.LineTotal), late.DeliveryDays, late.OnTimeFlag) == ("28.33", 27, 0)
    assert (unshipped.DeliveryDays, unshipped.OnTimeFlag, unshipped.ShippedDateKey) == (None, None, None)
    assert stray.CustomerKey is None and stray.OrderDate is None and stray.ProductKey == 1
    assert unknown.ProductKey is None and unknown.CustomerKey == 1 and unknown.Freight == 10.0
    assert facts[4, 4].ShipperKey is None and facts[4, 4].OnTimeFlag is None and facts[4, 4].DeliveryDays == 1


@pytest.mark.parametrize("rows_a_range", [10 ** 6, 700, 40])
def test_numbering_across_ranges(spark, rows_a_range):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k"), F.lit("x").alias("v")).repartition(7)
    got = number_rows(df, "n", "k", rows_a_range)
    assert got.columns == ["n", "k", "v"] and sorted((r.k, r.n) for r in got.collect()) == [(i, i + 1) for i in range(5000)]
    tied = number_rows(spark.range(3000).select(F.when(F.col("id") % 3 > 0, 1).alias("k"), "id"), "n", "k", rows_a_range).collect()
    assert sorted(r.n for r in tied) == list(range(1, 3001))
    assert {r.k for r in tied if r.n <= 1000} == {None}  # nulls first
    assert number_rows(df.where("false"), "n", "k", rows_a_range).count() == 0


def test_numbering_writes_nothing_on_the_way(spark, built, tmp_path):
    before = set(tmp_path.parent.parent.rglob("numbered-*"))
    plan = number_rows(built.tables["DimCustomers"].drop("CustomerKey"), "n", "CustomerID")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "DimCustomers" in plan and set(tmp_path.parent.parent.rglob("numbered-*")) == before


def test_top_with_ties(spark):
    df = spark.createDataFrame([("a", 3), ("b", 2), ("c", 2), ("d", 1), ("e", None)], "k string, v int")
    assert sorted(r.k for r in top_with_ties(df, "v", 2).collect()) == ["a", "b", "c"]
    assert sorted(r.k for r in top_with_ties(df, "v", 2, largest=False).collect()) == ["d", "e"]
    assert top_with_ties(df, "v", 9).count() == 5 and top_with_ties(df.where("false"), "v", 2).count() == 0


def test_measures_keep_the_blank_member(star):
    assert rows(m.values(star, ["DimCustomers.CompanyName"], "total_sales")) == [
        ("Anna", 60.5), ("Bob", 29.3305), (None, 1.0)]
    assert rows(m.values(star, ["DimCategories.CategoryName"], "total_quantity")) == [("One", 7), ("Others", 2), ("Two", 2), (None, 1)]


def test_filters_and_removed_filters(star):
    context = star.filtered({"DimDate.Year": [1996], "DimCategories.CategoryName": ["One"]})
    assert m.values(context, (), "total_sales").first()[0] == 20.0
    assert rows(m.category_share(context)) == [("One", pytest.approx(20 / 41.5))]
    assert m.best_year(context).first().best_year == 1997  # ties with 1996 at 20.00: the largest label
    assert m.total_customers(context).first()[0] == 2
    assert m.values(star.filtered({"Sales.ShipCountry": ["Y"]}), (), "total_orders").first()[0] == 1
    assert m.values(star.filtered({"DimCustomers.CompanyName": lambda c: c.startswith("A")}), (), "total_orders").first()[0] == 2


def test_rates_default_to_zero_or_blank(star):
    none = star.filtered({"Sales.OrderID": [3, 99]})
    assert m.on_time_rate(none).first()[0] == 0.0
    assert m.average_delivery_days(none).first()[0] is None
    assert m.average_order_value(star.filtered({"Sales.OrderID": [-1]})).first()[0] is None
    assert m.on_time_rate(star).first()[0] == 0.5


def test_last_year_shifts_the_set_of_days(star):
    got = {(r.Year, r.Month): r.sales_last_year for r in m.sales_last_year(star, ["DimDate.Year", "DimDate.Month"]).collect()}
    assert got[1997, 1] == 40.5 and got[1998, 1] == 28.3305 and got[1997, 2] is None  # 29 February 1996 has no day in 1997
    growth = {r.Year: r.sales_yoy for r in m.year_over_year(star, ["DimDate.Year"]).collect()}
    assert growth[1997] == pytest.approx((48.3305 - 40.5) / 40.5)


def test_time_measures_in_any_context(star):
    total = m.year_over_year(star).first()
    assert total.total_sales == pytest.approx(m.values(star, [], "total_sales").first()[0])
    assert m.sales_year_to_date(star).count() == 1
    by = ["DimDate.Year", "Sales.OrderID"]
    split = m.sales_last_year(star, by).groupBy("Year").agg(F.sum("sales_last_year").alias("v"))
    whole = {r.Year: r.sales_last_year for r in m.sales_last_year(star, ["DimDate.Year"]).where("sales_last_year IS NOT NULL").collect()}
    assert {r.Year: r.v for r in split.collect()} == pytest.approx(whole)
    split = m.sales_year_to_date(star, by).groupBy("Year").agg(F.sum("sales_ytd").alias("v"))
    whole = {r.Year: r.sales_ytd for r in m.sales_year_to_date(star, ["DimDate.Year"]).where("sales_ytd IS NOT NULL").collect()}
    assert {r.Year: r.v for r in split.collect()} == pytest.approx(whole)


def test_money_is_rounded_once(spark):
    rows = [(1_000_000, 0.00005, 0.0), (20_000_000_000, 1.0, 0.05), (3, 1.005, 0.0), (None, 1.0, 0.0), (1, float("nan"), 0.0),
            (1, 250_000_000.5, 0.1), (10 ** 15, 0.5, 0.0), (1, 2.0, 12.0), (10 ** 18, 10.0 ** 9, 0.0)]
    df = spark.createDataFrame(rows, "q bigint, p double, d double")
    got = [None if r[0] is None else str(r[0]) for r in df.select(money.line_total(F.col("q"), F.col("p"), F.col("d"))).collect()]
    assert got == ["50.00", "19000000000.00", "3.02", None, None, "225000000.45", "500000000000000.00", "-22.00", None]
    many = spark.range(1000).select(money.net_amount(F.lit(1), F.lit(0.00004), F.lit(0.0)).alias("n"))
    assert float(many.agg(F.sum("n")).first()[0]) == 0.04


def test_year_to_date_restarts(star):
    got = {(r.Year, r.Month): r.sales_ytd for r in m.sales_year_to_date(star, ["DimDate.Year", "DimDate.Month"]).collect()}
    assert (got[1996, 1], got[1996, 2], got[1996, 12], got[1997, 1], got[1997, 12], got[1998, 1]) == (
        40.5, 41.5, 41.5, 28.3305, 48.3305, None)


def test_ties(star):
    tied = star.filtered({"Sales.OrderID": [1], "Sales.ProductID": [1, 2]})  # categories One and Two both sell 20.00
    assert m.top_category(tied).first().top_category == "Two"
    assert insights.selling_insight(tied).first().top_category == "One"
    assert insights.selling_recommendation(tied).first().top_category is None
    assert insights.total_sales_card(tied).first().leading_category is None


def test_rank_counts_blank_as_zero(star):
    assert dict(m.category_rank(star.filtered({"Sales.ProductID": [1]})).collect()) == {"One": 1, "Others": 2, "Two": 2}


def test_stock_blanks_count_as_zero(star):
    assert dict(m.needs_reorder(star, ["DimProducts.ProductName"]).collect()) == {"P1": 1, "P2": 1, "P3": 0, "P4": 0, "P5": 0, "P6": 0}
    assert rows(reports.reorder_table(star)) == [("P1", "S1", 5, 9, 1), ("P2", "S1", None, 3, 1)]
    assert insights.inventory_insight(star).first().answer.startswith("2 product(s)")
    one = star.filtered({"DimCategories.CategoryName": ["One"]})  # reaches products, which are its many side
    assert rows(reports.reorder_table(one)) == [("P1", "S1", 5, 9, 1)] and m.low_stock(one).first()[0] == 1
    assert m.low_stock(star.filtered({"Sales.OrderID": [1]})).first()[0] == 2


def test_selected_values(star):
    card = {r.CategoryID: r for r in m.product_card(star, ["DimProducts.CategoryID"]).collect()}
    assert card[9].selected_product == "P3" and card[9].selected_category == "Others" and card[9].selected_supplier is None
    whole = m.product_card(star, ()).first()
    assert (whole.selected_product, whole.selected_unit_price) == ("Multiple Products", None)


def test_growth_and_glance(star):
    growth = insights.growth_recommendation(star).first()
    assert growth.peak_year == 1997 and growth.answer.startswith("Sales grew 16% into 1997, then fell 100% the year after.")
    assert insights.growth_recommendation(star.filtered({"DimDate.Year": [1996]})).first().peak_year == 1996
    one = insights.glance_insight(star.filtered({"DimDate.Year": [1997]}), "Shop").first()
    assert one.answer == "In 1997, Shop generated $48 in revenue across 2 orders."
    assert insights.glance_insight(star, "Shop").first().year == "All Years"
    assert insights.growth_insight(star.filtered({"DimDate.Year": [1997]})).first().answer == "Selected year (1997) generated $48 in sales."


def test_slowest_shipper_and_best_employee(star):
    assert insights.operations_recommendation(star).first().slowest_shipper == "Slow"
    assert insights.operations_insight(star).first().top_employee == "Joe Ray"


def test_top_customers(star):
    row = m.top_customers_sales(star, 1).first()
    assert (row.top10_customers_sales, row.top10_share) == (60.5, pytest.approx(60.5 / 90.8305))


def test_top_employees_rank_first_names(star):
    assert rows(reports.top_employees(star, 1)) == [("Joe", "Ray", 60.5)]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_filter_chooses_partitions(built):
    context = built.filtered({"DimDate.Year": [1997]})
    for question in (m.values(context, ["DimCategories.CategoryName"], "total_sales"), m.on_time_rate(context), reports.totals(context)):
        plan = executed(question)
        assert "PartitionFilters: [isnotnull(OrderYear" in plan or "PartitionFilters: [OrderYear" in plan
        assert "DimDate" not in plan  # the fact says the year itself
    days = executed(m.values(built.filtered({"DimDate.FullDate": [datetime.date(1997, 1, 5)]}), (), "total_sales"))
    assert "(OrderYear" in days.split("PartitionFilters: ")[1].split("]")[0] and "PushedFilters: [IsNotNull(OrderDate)" in days


def test_other_roles_do_not_choose_partitions(built):
    shipped = replace(built, date_role="shipped").filtered({"DimDate.Year": [1997]})
    assert "PartitionFilters: []" in executed(m.values(shipped, (), "total_sales"))
    assert m.values(shipped, (), "total_orders").first()[0] == 1


def test_partitions_by_month(spark, built, tmp_path):
    fact = built.tables["Sales"].drop("OrderYear")
    gold.write_fact(fact, str(tmp_path / "Sales"), ["OrderYear", "OrderMonth"])
    monthly = replace(built, tables={**built.tables, "Sales": spark.read.parquet(str(tmp_path / "Sales"))})
    for context in ({}, {"DimDate.Year": [1997], "DimDate.Month": [1]}, {"DimDate.Month": lambda c: c > 1}):
        by = ["DimDate.Year", "DimDate.Month"]
        assert rows(m.values(monthly.filtered(context), by, "total_sales", "total_orders")) == rows(
            m.values(built.filtered(context), by, "total_sales", "total_orders"))
    plan = executed(m.values(monthly.filtered({"DimDate.Month": [1]}), (), "total_sales"))
    assert "OrderMonth" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_filters_reduce_the_fact_before_it_is_grouped(spark, star):
    context = star.filtered({"DimCustomers.CompanyName": ["Anna"], "DimCategories.CategoryName": ["One"]})
    plan = m.values(context, ["DimDate.Year", "DimCustomers.City"], "line_total")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 2 and plan.index("Aggregate") < plan.index("LeftSemi")
    assert plan.count("Aggregate") == 1
    assert m.values(context, (), "line_total").first()[0] == 40.0


@pytest.mark.parametrize("question", [
    reports.best_of, reports.top_customer_share, reports.operations, reports.category_tooltip, reports.growth_page,
    insights.insights_page, insights.growth_recommendation, insights.operations_insight, insights.glance_recommendation, m.category_share])
def test_one_read_of_the_fact(built, question):
    for context in (built, built.filtered({"DimDate.Year": [1996], "DimCategories.CategoryName": ["One"], "DimCustomers.CompanyName": ["Anna"]})):
        plan = question(context)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("OrderYear") and plan.count("LineTotal#") and plan.count("Relation [OrderID") == 1, plan


@pytest.mark.parametrize("question", [reports.operations, m.on_time_rate, insights.operations_insight])
def test_distinct_orders_need_no_expand(built, question):
    assert "Expand" not in executed(question(built))


def test_groups_remove_filters_one_by_one(star):
    context = star.filtered({"DimDate.Year": [1996], "DimCategories.CategoryName": ["One"]})
    asks = {"both": Ask(), "year": Ask(without=("DimCategories",)), "category": Ask(("DimCategories.CategoryName",), without=("DimDate.Year",), members="all"),
            "orders": Ask(key="OrderID", without=("DimDate", "DimCategories"))}
    found = {(r.of, r.name): r for r in context.groups(asks, {"q": F.col("Quantity")}, {"days": F.col("DeliveryDays")}).collect()}
    assert {k: r.q for k, r in found.items()} == {("both", None): 2, ("year", None): 6, ("category", "One"): 7, ("orders", None): 12}
    orders = found["orders", None]
    assert (orders["keys"], orders.days, orders.days_keys) == (5, 33, 3)
    with pytest.raises(ValueError):
        star.groups({"two": Ask(("DimDate.Year", "DimCategories.CategoryName"))}, {"q": F.col("Quantity")})
    shipped = replace(star, date_role="shipped").groups({"year": Ask(("DimDate.Year",), key="CustomerKey")}, {"q": F.col("Quantity")}).collect()
    assert {r.number: (r.q, r["keys"]) for r in shipped} == {1996: (6, 2), 1997: (1, 1), None: (5, 1)}
    listed = star.groups({"category": Ask(("DimCategories.CategoryName",), members="context")}, {"q": F.col("Quantity")}).collect()
    assert {r.name: (r.q, r.member) for r in listed} == {"One": (7, 1), "Two": (2, 1), "Others": (2, 1), None: (1, None)}


def test_star_type(built):
    assert isinstance(built, Star) and not hasattr(built, "row_counts")
