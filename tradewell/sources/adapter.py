"""The star-schema test tables read as the ten business tables of the feeds.

Keys, dates and stock that the test tables lack are derived from their keys, so that any SQL engine
can derive the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewell.config import MERGED
from tradewell.operators.clean import dedup, project

LINE_ORDER = ["l_linenumber", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax", "l_returnflag", "l_linestatus"]

_schemas: dict[str, T.StructType] = {}


def _key(text_or_number: str) -> Column:
    return F.col(text_or_number).cast("bigint")


class TestTables:
    """Business tables over one folder of test tables; each method is a lazy frame."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _schemas:  # reading a footer is a job; one per table is enough
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def _with_place(self, df: DataFrame, nation_key: str) -> DataFrame:
        """Nation and region looked up one after the other, so the size of each decides how it is joined."""
        nation = self.raw("nation").select("n_nationkey", "n_name", "n_regionkey")
        region = self.raw("region").select("r_regionkey", "r_name")
        return (df.join(nation, F.col(nation_key) == F.col("n_nationkey"), "left")
                .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left"))

    def customers(self) -> DataFrame:
        rows = self._with_place(self.raw("customer"), "c_nationkey")
        named = rows.select(
            F.col("c_custkey").cast("string").alias("CustomerID"), F.col("c_name").alias("CompanyName"),
            F.col("c_mktsegment").alias("ContactTitle"), F.col("n_name").alias("City"),
            F.col("r_name").alias("Region"), F.col("n_name").alias("Country"))
        return project(named, MERGED["Customers"].business_columns)

    def employees(self) -> DataFrame:
        return self.raw("nation").select(
            _key("n_nationkey").alias("EmployeeID"),
            F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("LastName"),
            F.col("n_name").alias("FirstName"))

    def shippers(self) -> DataFrame:
        return self.raw("region").select(_key("r_regionkey").alias("ShipperID"), F.col("r_name").alias("CompanyName"))

    def regions(self) -> DataFrame:
        return self.raw("region").select(
            _key("r_regionkey").alias("RegionID"), F.col("r_name").alias("RegionDescription"))

    def territories(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").cast("string").alias("TerritoryID"),
            F.col("n_name").alias("TerritoryDescription"), _key("n_regionkey").alias("RegionID"))

    def suppliers(self) -> DataFrame:
        return self.raw("supplier").select(_key("s_suppkey").alias("SupplierID"), F.col("s_name").alias("CompanyName"))

    def categories(self) -> DataFrame:
        ids = self.raw("part").select(self._category().alias("CategoryID")).distinct()
        return ids.select("CategoryID", F.concat(F.lit("Category "), F.col("CategoryID").cast("string")).alias("CategoryName"))

    @staticmethod
    def _category() -> Column:
        return (F.col("p_size") % 10 + 1).cast("bigint")

    def products(self) -> DataFrame:
        suppliers = self.raw("supplier").agg(F.count("*")).scalar()
        named = self.raw("part").select(
            F.col("p_partkey").alias("ProductID"),
            F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("ProductName"),
            (F.col("p_partkey") % suppliers).alias("SupplierID"), self._category().alias("CategoryID"),
            F.col("p_retailprice").alias("UnitPrice"), _key("p_size").alias("UnitsInStock"),
            F.lit(0).cast("bigint").alias("UnitsOnOrder"), F.lit(25).cast("bigint").alias("ReorderLevel"),
            F.lit(False).alias("Discontinued"))
        return project(named, MERGED["Products"].business_columns)

    def orders(self) -> DataFrame:
        customer = self.raw("customer").select("c_custkey", "c_nationkey")
        rows = self.raw("orders").join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        rows = self._with_place(rows, "c_nationkey")
        day = F.col("o_orderdate").cast("date")
        shipped = F.date_add(day, (F.col("o_orderkey") % 45).cast("int"))
        named = rows.select(
            F.col("o_orderkey").alias("OrderID"), F.col("o_custkey").cast("string").alias("CustomerID"),
            (F.col("o_orderkey") % 25).alias("EmployeeID"), day.cast("timestamp").alias("OrderDate"),
            F.date_add(day, 30).cast("timestamp").alias("RequiredDate"),
            F.when(F.col("o_orderkey") % 20 != 0, shipped).cast("timestamp").alias("ShippedDate"),
            (F.col("o_orderkey") % 5).alias("ShipVia"), F.col("o_totalprice").alias("Freight"),
            F.col("r_name").alias("ShipRegion"), F.col("n_name").alias("ShipCountry"))
        return project(named, MERGED["Orders"].business_columns)

    def raw_order_details(self) -> DataFrame:
        """Lines as they come: some pairs of order and product repeat."""
        price = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
        return self._as_details(self.raw("lineitem").join(price, "l_partkey", "left"))

    def order_details(self) -> DataFrame:
        """One line for each pair of order and product.

        Lines that agree up to the discount show the same values, so only the columns up to it are moved to choose
        one. Few pairs repeat: lines are dealt by pair first, so no task sorts what it reads of a large file.
        """
        order = LINE_ORDER[:LINE_ORDER.index("l_discount") + 1]
        dealt = self.raw("lineitem").select("l_orderkey", "l_partkey", *order).repartition("l_orderkey", "l_partkey")
        lines = dedup(dealt, ["l_orderkey", "l_partkey"], order)
        price = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
        return self._as_details(lines.join(price, "l_partkey", "left"))

    @staticmethod
    def _as_details(lines: DataFrame) -> DataFrame:
        return lines.select(
            F.col("l_orderkey").alias("OrderID"), F.col("l_partkey").alias("ProductID"),
            F.col("l_quantity").cast("bigint").alias("Quantity"), F.col("p_retailprice").alias("UnitPrice"),
            (F.col("l_discount") + 0.0).alias("Discount"))

    def all(self) -> dict[str, DataFrame]:
        """Every business table by name."""
        makers: dict[str, Callable[[], DataFrame]] = {
            "Categories": self.categories, "Customers": self.customers, "Employees": self.employees,
            "Order_Details": self.order_details, "Orders": self.orders, "Products": self.products,
            "Regions": self.regions, "Shippers": self.shippers, "Suppliers": self.suppliers,
            "Territories": self.territories,
        }
        return {name: make() for name, make in makers.items()}

    # The second feed: of every ten keys one is changed and one is sent unchanged, and some keys are new.

    def incoming_customers(self) -> DataFrame:
        return self._incoming(self.customers(), self._largest("customer", "c_custkey"), "CustomerID", "ContactTitle", F.concat("ContactTitle", F.lit(" (NEW)")))

    def incoming_orders(self) -> DataFrame:
        return self._incoming(self.orders(), self._largest("orders", "o_orderkey"), "OrderID", "Freight", F.col("Freight") + 1)

    def incoming_products(self) -> DataFrame:
        return self._incoming(self.products(), self._largest("part", "p_partkey"), "ProductID", "UnitsInStock", F.col("UnitsInStock") + 100)

    def incoming_order_details(self) -> DataFrame:
        return self._incoming(self.order_details(), self._largest("orders", "o_orderkey"), "OrderID", "Quantity", F.col("Quantity") + 1)

    def incoming(self) -> dict[str, DataFrame]:
        return {"Customers": self.incoming_customers(), "Products": self.incoming_products(),
                "Orders": self.incoming_orders(), "Order_Details": self.incoming_order_details()}

    def _largest(self, table: str, key: str) -> Column:
        """Keys that are moved up by this meet none that exist."""
        return self.raw(table).agg(F.max(key)).scalar()

    @staticmethod
    def _incoming(base: DataFrame, largest: Column, key: str, column: str, changed: Column) -> DataFrame:
        number = F.col(key).cast("bigint")
        sent = base.where((number % 10).isin(0, 1)).withColumn(
            column, F.when(number % 10 == 0, changed).otherwise(F.col(column)))
        shifted = (number + largest).cast(base.schema[key].dataType)
        return sent.unionByName(base.where(number % 50 == 7).withColumn(key, shifted))
