"""Gold star schema: nine dimensions and the sales fact, from Silver tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewell.config import CATEGORY_IDS, OTHERS_ID, OTHERS_NAME
from tradewell.functions.dates import as_date, date_key, us_week
from tradewell.functions.money import line_total
from tradewell.operators.clean import project
from tradewell.operators.ranking import number_rows
from tradewell.plans.star import Star
from tradewell.session import all_or_raise, for_each_table
from tradewell.sources.sinks import STORED_AS

# Columns of the dimensions that only copy their source (P18), and their keys.
COPIED_DIMENSIONS = {
    "DimCustomers": ("Customers", "CustomerKey", "CustomerID", [
        "CustomerID", "CompanyName", "ContactName", "ContactTitle", "Address", "City", "Region",
        "PostalCode", "Country", "Phone", "Fax"]),
    "DimEmployees": ("Employees", "EmployeeKey", "EmployeeID", [
        "EmployeeID", "LastName", "FirstName", "Title", "TitleOfCourtesy", "BirthDate", "HireDate",
        "Address", "City", "Region", "PostalCode", "Country", "HomePhone", "Extension", "Photo", "Notes",
        "ReportsTo", "PhotoPath"]),
    "DimSuppliers": ("Suppliers", "SupplierKey", "SupplierID", [
        "SupplierID", "CompanyName", "ContactName", "ContactTitle", "Address", "City", "Region",
        "PostalCode", "Country", "Phone", "Fax", "HomePage"]),
    "DimShippers": ("Shippers", "ShipperKey", "ShipperID", ["ShipperID", "CompanyName", "Phone"]),
    "DimRegions": ("Regions", "RegionKey", "RegionID", ["RegionID", "RegionDescription"]),
    "DimTerritories": ("Territories", "TerritoryKey", "TerritoryID", [
        "TerritoryID", "TerritoryDescription", "RegionID"]),
}
CATEGORY_COLUMNS = ["CategoryID", "CategoryName", "Description", "Picture"]
PRODUCT_COLUMNS = ["ProductID", "ProductName", "SupplierID", "CategoryID", "QuantityPerUnit", "UnitPrice",
                   "UnitsInStock", "UnitsOnOrder", "ReorderLevel", "Discontinued"]
# Fixed value: days added on both ends of the calendar.
CALENDAR_MARGIN = 7
ORDER_DATES = ["OrderDate", "ShippedDate", "RequiredDate"]
PERIODS = ("OrderYear", "OrderMonth")


def current(df: DataFrame) -> DataFrame:
    """the valid version of each row; a table without history is all current."""
    return df.where("is_current") if "is_current" in df.columns else df


def historical(df: DataFrame) -> DataFrame:
    """closed versions."""
    return df.where("NOT is_current")


def copied_dimension(silver: dict[str, DataFrame], name: str) -> DataFrame:
    """Current rows, chosen columns, numbered in key order."""
    source, key, business_key, columns = COPIED_DIMENSIONS[name]
    dim = project(current(silver[source]), columns)
    if name == "DimEmployees":
        dim = dim.withColumn("FullName", F.concat_ws(" ", "FirstName", "LastName"))
    return number_rows(dim, key, business_key)


def _known_category(category_id: Column) -> Column:
    """Ids that are no number are not known."""
    return category_id.try_cast("bigint").between(*CATEGORY_IDS)


def dim_categories(silver: dict[str, DataFrame]) -> DataFrame:
    """C17: categories in range (F03) and one ``Others`` member (U06) numbered after them."""
    known = project(current(silver["Categories"]), CATEGORY_COLUMNS).where(_known_category(F.col("CategoryID")))
    known = number_rows(known.withColumn("CategoryID", F.col("CategoryID").try_cast("bigint")), "CategoryKey", "CategoryID")
    others = known.agg((F.coalesce(F.max("CategoryKey"), F.lit(0)) + 1).cast("bigint").alias("CategoryKey")).select(
        "CategoryKey", F.lit(OTHERS_ID).cast("bigint").alias("CategoryID"), F.lit(OTHERS_NAME).alias("CategoryName"))
    return known.unionByName(others, allowMissingColumns=True)


def dim_products(silver: dict[str, DataFrame], categories: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Current products with supplier key and category key; null or out-of-range ids go to ``Others``."""
    products = number_rows(project(current(silver["Products"]), PRODUCT_COLUMNS), "ProductKey", "ProductID")
    others = categories.where(F.col("CategoryID") == OTHERS_ID).agg(F.max("CategoryKey")).scalar()
    category = categories.where(_known_category(F.col("CategoryID"))).select(
        F.col("CategoryID").alias("_category_id"), F.col("CategoryKey").alias("_category_key"))
    supplier = suppliers.select(F.col("SupplierID").alias("_supplier_id"), "SupplierKey")
    joined = (products
              .join(category, F.col("CategoryID").try_cast("bigint") == F.col("_category_id"), "left")
              .join(supplier, F.col("SupplierID").try_cast("bigint") == F.col("_supplier_id"), "left"))
    bucket = F.when(_known_category(F.col("CategoryID")), F.col("_category_key")).otherwise(others)
    return joined.select(*products.columns, bucket.alias("CategoryKey"), "SupplierKey")


def calendar_bounds(orders: DataFrame) -> DataFrame:
    """First and last day of any of the three order dates, with the margin."""
    days = [as_date(F.col(c)) for c in ORDER_DATES]
    span = current(orders).agg(F.min(F.least(*days)).alias("lo"), F.max(F.greatest(*days)).alias("hi"))
    first = F.date_sub("lo", CALENDAR_MARGIN)
    return span.select(first.alias("first_day"), F.date_add("hi", CALENDAR_MARGIN).alias("last_day"))


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per day. Its size is bounded by the calendar, not by the orders."""
    day = F.col("FullDate")
    days = calendar_bounds(orders).select(F.explode(F.sequence("first_day", "last_day")).alias("FullDate"))
    return days.select(
        day, date_key(day).alias("DateKey"), F.year(day).alias("Year"), F.quarter(day).alias("Quarter"),
        F.month(day).alias("Month"), F.date_format(day, "MMMM").alias("MonthName"),
        F.dayofmonth(day).alias("Day"), F.date_format(day, "EEEE").alias("DayName"),
        us_week(day).alias("WeekOfYear"))


def _lookup(dim: DataFrame, key: str, business_key: str) -> DataFrame:
    """The two columns of a dimension that a fact needs."""
    return dim.select(F.col(business_key).alias(f"_{key}"), key)


def sales(silver: dict[str, DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    """C20: one row per current order line, with all keys and amounts."""
    return computed(sales_lines(silver, dims))


def sales_lines(silver: dict[str, DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    """C20: the current order lines and their keys.

    Keys that belong to the order (customer, employee, shipper, three dates) are looked up once per
    order, so only two joins run at line grain, the product's first, while a line is narrow. Whether a
    lookup is broadcast is left to its size.
    """
    orders = current(silver["Orders"])
    orders = orders.select(
        F.col("OrderID").alias("_order_id"), "CustomerID", "EmployeeID", "ShipVia",
        *[as_date(F.col(c)).alias(c) for c in ORDER_DATES], "Freight", "ShipCountry", "ShipRegion")
    orders = (orders
              .join(_lookup(dims["DimCustomers"], "CustomerKey", "CustomerID"),
                    F.col("CustomerID") == F.col("_CustomerKey"), "left")
              .join(_lookup(dims["DimEmployees"], "EmployeeKey", "EmployeeID"),
                    F.col("EmployeeID") == F.col("_EmployeeKey"), "left")
              .join(_lookup(dims["DimShippers"], "ShipperKey", "ShipperID"),
                    F.col("ShipVia") == F.col("_ShipperKey"), "left"))
    for name in ORDER_DATES:  # J07: the calendar in three roles
        role = dims["DimDate"].select(F.col("FullDate").alias(f"_{name}"), F.col("DateKey").alias(f"{name}Key"))
        orders = orders.join(role, F.col(name) == F.col(f"_{name}"), "left")
    lines = current(silver["Order_Details"]).select("OrderID", "ProductID", "Quantity", "UnitPrice", "Discount")
    lines = (lines.join(_lookup(dims["DimProducts"], "ProductKey", "ProductID"),
                        F.col("ProductID") == F.col("_ProductKey"), "left")
             .join(orders, F.col("OrderID") == F.col("_order_id"), "left"))
    return lines.select(
        "OrderID", "ProductID", "CustomerKey", "EmployeeKey", "ProductKey", "ShipperKey",
        "OrderDateKey", "ShippedDateKey", "RequiredDateKey", *ORDER_DATES,
        "Quantity", "UnitPrice", "Discount", "Freight", "ShipCountry", "ShipRegion")


def computed(lines: DataFrame) -> DataFrame:
    """C20: order lines with what follows from their own columns; periods stay last."""
    ordered, shipped, required = (F.col(c) for c in ORDER_DATES)
    on_time = (F.when(shipped.isNull() | required.isNull(), F.lit(None).cast("int"))
               .when(shipped <= required, 1).otherwise(0))
    return lines.select(
        "OrderID", "ProductID", "CustomerKey", "EmployeeKey", "ProductKey", "ShipperKey",
        "OrderDateKey", "ShippedDateKey", "RequiredDateKey", *ORDER_DATES,
        "Quantity", "UnitPrice", "Discount",
        line_total(F.col("Quantity"), F.col("UnitPrice"), F.col("Discount")).alias("LineTotal"),
        "Freight", "ShipCountry", "ShipRegion",
        F.datediff(shipped, ordered).alias("DeliveryDays"), on_time.alias("OnTimeFlag"),
        *[c for c in PERIODS if c in lines.columns])


def with_periods(fact: DataFrame) -> DataFrame:
    """The fact with the year and month of its order date, which it is partitioned by."""
    return fact.withColumns(dict(zip(PERIODS, (F.year("OrderDate"), F.month("OrderDate")))))


def write_fact(fact: DataFrame, path: str, by: Sequence[str] = ("OrderYear",),
               finish: Callable[[DataFrame], DataFrame] = lambda lines: lines) -> None:
    """One folder per order year (``by`` may add the month), rows in order of day.

    ``finish`` adds columns that follow from a row's others once rows are dealt, so that they are not moved;
    it keeps the rows and the columns of ``by``.

    Rows are dealt by period; adaptive execution splits a large one over several tasks and puts small
    ones together. A filter on the period then reads its folders, one on days their row groups.
    """
    kept = with_periods(fact).select(*fact.columns, *by)
    dealt = kept.hint("rebalance", *[F.col(c) for c in by])
    ready = finish(dealt.sortWithinPartitions(*by, "OrderDateKey"))
    ready.write.option("compression", STORED_AS).partitionBy(*by).parquet(path)


def build(silver: dict[str, DataFrame], root: str, partition_by: Sequence[str] = ("OrderYear",)) -> None:
    """Write the star as one folder per table.

    Small dimensions do not fill a cluster, so those that do not depend on each other are written at
    the same time. The fact reads the written dimensions back.
    """
    spark = next(iter(silver.values())).sparkSession

    def write(name: str, make: Callable[[], DataFrame]) -> None:
        make().write.parquet(f"{root}/{name}")

    makers: dict[str, Callable[[], DataFrame]] = {
        name: partial(copied_dimension, silver, name) for name in COPIED_DIMENSIONS}
    makers["DimCategories"] = partial(dim_categories, silver)
    makers["DimDate"] = partial(dim_date, silver["Orders"])
    all_or_raise(for_each_table({name: partial(write, name, make) for name, make in makers.items()}))
    dims = read(spark, root, list(makers))
    write("DimProducts", lambda: dim_products(silver, dims["DimCategories"], dims["DimSuppliers"]))
    write_fact(sales_lines(silver, {**dims, **read(spark, root, ["DimProducts"])}), f"{root}/Sales", partition_by, computed)


TABLES = [*COPIED_DIMENSIONS, "DimCategories", "DimProducts", "DimDate", "Sales"]


def read(spark: SparkSession, root: str, tables: list[str] = TABLES) -> dict[str, DataFrame]:
    """The tables of a built star; the fact has its partition columns last."""
    return {name: spark.read.parquet(f"{root}/{name}") for name in tables}


def open_star(spark: SparkSession, root: str) -> Star:
    """A built star."""
    return Star(read(spark, root))
