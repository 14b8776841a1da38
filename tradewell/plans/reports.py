"""Report queries: what each page of the sales report asks of the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewell.operators.ranking import top_with_ties
from tradewell.plans import insights
from tradewell.plans import measures as m
from tradewell.plans.star import Star, net

# Years that the report's year slicer and customer trend let through.
REPORT_YEARS = [1996, 1997, 1998, 2026]
# The four filters that every page shares.
SHARED_FILTERS = ["DimDate.Year", "Sales.ShipCountry", "DimCategories.CategoryName", "DimEmployees.FirstName"]

TOTALS = ["total_sales", "total_quantity", "total_freight", "total_orders"]


def _with_order_value(df: DataFrame, *by: str) -> DataFrame:
    return df.select(*by, "total_sales", "total_quantity", "total_freight",
                     m.ratio("total_sales", "total_orders").alias("avg_order_value"))


def totals(star: Star) -> DataFrame:
    """The four headline totals."""
    return _with_order_value(m.values(star, (), *TOTALS))


def totals_by_title(star: Star) -> DataFrame:
    """The same by contact title, best first."""
    df = _with_order_value(m.values(star, ["DimCustomers.ContactTitle"], *TOTALS), "ContactTitle")
    return df.orderBy(F.desc("total_sales"), "ContactTitle")


def _top_by(star: Star, ref: str, n: int) -> DataFrame:
    """Members with the n highest sales, ties kept, best first."""
    label = ref.split(".")[1]
    per_member = star.summarise([ref], {"sales": net()})
    top = top_with_ties(per_member, "sales", n)
    return top.select(label, F.col("sales").cast("double").alias("total_sales")).orderBy(F.desc("total_sales"), label)


def top_products(star: Star, n: int = 10) -> DataFrame:
    """R03."""
    return _top_by(star, "DimProducts.ProductName", n)


def sales_by_category(star: Star) -> DataFrame:
    """R04."""
    return m.values(star, ["DimCategories.CategoryName"], "total_sales").orderBy(F.desc("total_sales"), "CategoryName")


def best_of(star: Star) -> DataFrame:
    """Best year and its sales, top category, peak month."""
    return m.best_of(star).select("best_year", "best_year_sales", "top_category", "peak_month")


def top_customers(star: Star, n: int = 10) -> DataFrame:
    """R06."""
    return _top_by(star, "DimCustomers.CompanyName", n)


def sales_by_city(star: Star) -> DataFrame:
    """R07."""
    return m.values(star, ["DimCustomers.City"], "total_sales")


def customers_by_year(star: Star) -> DataFrame:
    """R08."""
    return m.values(star.filtered({"DimDate.Year": REPORT_YEARS}), ["DimDate.Year"], "active_customers").orderBy("Year")


def top_customer_share(star: Star) -> DataFrame:
    """R09."""
    return m.top_customers_sales(star).select("top10_share")


def average_freight(star: Star) -> DataFrame:
    """Mean freight per line."""
    return m.base(star, (), "total_freight", "freight_lines").select(
        m.ratio("total_freight", "freight_lines").alias("avg_freight"))


def top_employees(star: Star, n: int = 5) -> DataFrame:
    """The n first names with the highest line totals, then one row per full name that has one of them."""
    by = {"FirstName": "DimEmployees.FirstName", "LastName": "DimEmployees.LastName"}
    per_name = star.summarise(by, {"lt": F.col("LineTotal")})
    first_names = top_with_ties(per_name.groupBy("FirstName").agg(F.sum("lt").alias("lt")), "lt", n)
    kept = per_name.join(first_names.select("FirstName"), "FirstName", "left_semi")
    return kept.select("FirstName", "LastName", F.col("lt").cast("double").alias("line_total")).orderBy(
        F.desc("line_total"), "FirstName", "LastName")


def operations(star: Star) -> DataFrame:
    """On-time rate, unshipped orders, average delivery days, number of employees."""
    return m.operations(star).withColumn("employees", star.dimension("DimEmployees").agg(F.count("EmployeeID")).scalar())


def reorder_table(star: Star) -> DataFrame:
    """Per product and supplier, only those to reorder, supplier descending."""
    pairs = m.reorder_groups(star, "ProductName", "CompanyName")
    return pairs.orderBy(F.desc("CompanyName"), "ProductName")


# ---- drill-through to one customer (R14, F08) ---------------------------------------------------

def _customer(star: Star, name: str) -> Star:
    return star.filtered({"DimCustomers.CompanyName": [name]})


def customer_profile(star: Star, name: str) -> DataFrame:
    return _customer(star, name).dimension("DimCustomers").select(
        "CompanyName", "ContactName", "ContactTitle", "City", "Country", "Phone").distinct()


def customer_years(star: Star, name: str) -> DataFrame:
    """Line totals by year, with the report's year filter."""
    context = _customer(star, name).filtered({"DimDate.Year": REPORT_YEARS})
    return m.values(context, ["DimDate.Year"], "line_total").orderBy("Year")


def customer_lines(star: Star, name: str) -> DataFrame:
    """Lines of the customer by order date and ship date."""
    context = _customer(star, name)
    one = F.lit(1)
    df = context.summarise(["Sales.OrderDate", "Sales.ShippedDate"], {
        "order_lines": F.when(F.col("OrderID").isNotNull(), one), "product_lines": F.when(F.col("ProductID").isNotNull(), one),
        "quantity": F.col("Quantity"), "unit_price": F.col("UnitPrice").cast("decimal(18,4)"),
        "line_total": F.col("LineTotal"), "on_time": F.col("OnTimeFlag")})
    return df.select("OrderDate", "ShippedDate", "order_lines", "product_lines", "quantity",
                     F.col("unit_price").cast("double").alias("unit_price"),
                     F.col("line_total").cast("double").alias("line_total"), "on_time")


def customer_products(star: Star, name: str, n: int = 5) -> DataFrame:
    """The customer's n best products."""
    return _top_by(_customer(star, name), "DimProducts.ProductName", n)


# ---- tooltips, pages, filters -------------------------------------------------------------------

def category_tooltip(star: Star) -> DataFrame:
    """Rank and best product of every category."""
    return m.category_tooltip(star)


def product_tooltip(star: Star) -> DataFrame:
    """What the report shows about one product."""
    return m.product_card(star, ["DimProducts.ProductName"]).select(
        "ProductName", "selected_product", "selected_category", "selected_supplier", "selected_unit_price",
        "selected_reorder_level")


def growth_page(star: Star) -> DataFrame:
    """The four cards of the growth page as rows of name, number, label."""
    return insights.growth_page(star)


def filter_values(star: Star) -> DataFrame:
    """The choices of the four shared filters."""
    star = star.filtered({"DimDate.Year": REPORT_YEARS})
    choices = None
    for ref in SHARED_FILTERS:
        column = ref.split(".")[1]
        values = star.members(ref).select(F.lit(column).alias("filter"), F.col(column).cast("string").alias("choice"))
        choices = values if choices is None else choices.unionAll(values)
    return choices

