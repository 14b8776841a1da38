"""Business measures over the star. Each is a function (star, by) -> frame of groups and values.

``by`` maps output names to ``Table.Column``; empty means one total row. Sums of money are exact
decimals inside and leave as doubles.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewell.operators.ranking import single_value, winner_largest_label
from tradewell.plans.star import THROUGH_PRODUCT, Ask, Star, net, split_ref

By = Mapping[str, str] | Iterable[str]

# Base sums and distinct counts (A13). Each measure below names the ones it needs.
SUMS = {
    "total_sales": net,
    "line_total": lambda: F.col("LineTotal"),
    "total_quantity": lambda: F.col("Quantity"),
    "total_freight": lambda: F.col("Freight").cast("decimal(18,4)"),
    "freight_lines": lambda: F.when(F.col("Freight").isNotNull(), F.lit(1)),
    "delivery_days": lambda: F.col("DeliveryDays"),
    "delivery_lines": lambda: F.when(F.col("DeliveryDays").isNotNull(), F.lit(1)),
    "on_time_lines": lambda: F.col("OnTimeFlag"),
    "flagged_lines": lambda: F.when(F.col("OnTimeFlag").isNotNull(), F.lit(1)),
}
DISTINCT = {
    "total_orders": lambda: ("OrderID", None),
    "products_sold": lambda: ("ProductID", None),
    "active_customers": lambda: ("CustomerKey", None),
    "dated_orders": lambda: ("OrderID", dated()),
    "on_time_orders": lambda: ("OrderID", F.col("OnTimeFlag") == 1),
    "unshipped_orders": lambda: ("OrderID", F.col("ShippedDate").isNull()),
}
MONEY = {"total_sales", "line_total", "total_freight"}


def dated() -> Column:
    return F.col("ShippedDate").isNotNull() & F.col("RequiredDate").isNotNull()


def names(by: By) -> dict[str, str]:
    return dict(by) if isinstance(by, Mapping) else {split_ref(r)[1]: r for r in by}


def base(star: Star, by: By, *wanted: str) -> DataFrame:
    """Base values per group, still exact."""
    return star.summarise(names(by), {w: SUMS[w]() for w in wanted if w in SUMS},
                          {w: DISTINCT[w]() for w in wanted if w in DISTINCT})


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Blank on a zero or missing denominator."""
    top, bottom = (_double(x) if isinstance(x, str) else x for x in (top, bottom))
    return F.try_divide(top, bottom)


def values(star: Star, by: By, *wanted: str) -> DataFrame:
    """Base values as they are."""
    by = names(by)
    shown = [_double(w).alias(w) if w in MONEY else F.col(w) for w in wanted]
    return base(star, by, *wanted).select(*by, *shown)


def average_order_value(star: Star, by: By = ()) -> DataFrame:
    """M04."""
    by = names(by)
    return base(star, by, "total_sales", "total_orders").select(
        *by, ratio("total_sales", "total_orders").alias("avg_order_value"))


def total_customers(star: Star) -> DataFrame:
    """Counted in the dimension; filters on the fact or other dimensions do not reach it."""
    return star.dimension("DimCustomers").agg(F.count_distinct("CustomerKey").alias("total_customers"))


def on_time_rate(star: Star, by: By = ()) -> DataFrame:
    """Orders on time over orders with both dates, 0 when there are none."""
    by = names(by)
    rate = F.coalesce(ratio("on_time_orders", "dated_orders"), F.lit(0.0))
    return base(star, by, "on_time_orders", "dated_orders").select(*by, rate.alias("on_time_rate"))


def average_delivery_days(star: Star, by: By = ()) -> DataFrame:
    """Mean over orders of the longest delivery of the order."""
    by = names(by)
    per_order = star.summarise({**by, "_order": "Sales.OrderID"}, maxes={"days": F.col("DeliveryDays")})
    return per_order.groupBy(*by).agg(ratio(F.sum("days").cast("double"), F.count("days")).alias("avg_delivery_days"))


def operations(star: Star) -> DataFrame:
    """On-time rate, unshipped orders and mean delivery, all from one row per order."""
    flags = {"on_time": F.when(F.col("OnTimeFlag") == 1, 1), "dated": F.when(dated(), 1),
             "unshipped": F.when(F.col("ShippedDate").isNull(), 1), "days": F.col("DeliveryDays")}
    found = star.groups({"orders": Ask(key="OrderID")}, {"lines": F.lit(1)}, flags).agg(
        *[F.sum(f).alias(f) for f in flags], F.sum("days_keys").alias("days_keys"))
    return found.select(F.coalesce(ratio("on_time", "dated"), F.lit(0.0)).alias("on_time_rate"),
                        F.coalesce("unshipped", F.lit(0).cast("bigint")).alias("unshipped_orders"),
                        ratio("days", "days_keys").alias("avg_delivery_days"))


# ---- time ---------------------------------------------------------------------------------------

def _split(by: By) -> tuple[dict[str, str], dict[str, str], list[Column]]:
    """All group names, those that are not of the calendar, and the calendar's columns under their names."""
    by = names(by)
    other = {n: r for n, r in by.items() if split_ref(r)[0] != "DimDate"}
    return by, other, [F.col(split_ref(r)[1]).alias(n) for n, r in by.items() if n not in other]


def _daily(star: Star, other: Mapping[str, str]) -> DataFrame:
    """Exact sales per calendar day and other groups, all date filters removed."""
    return star.without("DimDate").summarise({"_day": "DimDate.FullDate", **other}, {"sales": net()})


def sales_last_year(star: Star, by: By = ()) -> DataFrame:
    """Sales of the same days one year earlier.

    The set of days of a group is shifted, so 28 and 29 February do not both count the 28th. Groups
    that are not of the calendar keep their members; those without any sale on these days are absent.
    """
    by, other, dates = _split(by)
    shifted = star.dimension("DimDate").select(*dates, F.add_months("FullDate", -12).alias("_day")).distinct()
    known = star.tables["DimDate"].select(F.col("FullDate").alias("_day"))
    days = shifted.join(known, "_day", "left_semi").join(_daily(star, other), "_day", "inner" if other else "left")
    return days.groupBy(*by).agg(F.sum("sales").cast("double").alias("sales_last_year"))


def year_over_year(star: Star, by: By = ()) -> DataFrame:
    """This period, the same last year, and the growth between them. Null groups stay groups."""
    by = names(by)
    none = F.lit(None).cast("double")
    now = values(star, by, "total_sales").withColumn("sales_last_year", none)
    before = sales_last_year(star, by).where("sales_last_year IS NOT NULL").withColumn("total_sales", none)
    both = now.unionByName(before).groupBy(*by).agg(
        F.max("total_sales").alias("total_sales"), F.max("sales_last_year").alias("sales_last_year"))
    change = F.coalesce("total_sales", F.lit(0.0)) - F.coalesce("sales_last_year", F.lit(0.0))
    return both.select(*by, "total_sales", "sales_last_year", ratio(change, "sales_last_year").alias("sales_yoy"))


def sales_year_to_date(star: Star, by: By = ()) -> DataFrame:
    """Sales from 1 January to the last day of the group, inside that day's year.

    The last days are put among the days with sales, and one running sum per year and other group
    reads them off; a window holds the days of one year and its last days only.
    """
    by, other, dates = _split(by)
    calendar = star.tables["DimDate"].select(F.col("FullDate").alias("_day"), F.col("Year").alias("_year"))
    sold = _daily(star, other).join(calendar, "_day")
    last = star.dimension("DimDate").groupBy(*dates).agg(F.max("FullDate").alias("_day")).join(calendar, "_day")
    if other:
        last = last.join(sold.select(*other, "_year").distinct(), "_year")
    told = last.withColumn("_asked", F.lit(True)).unionByName(sold.withColumn("_asked", F.lit(False)), allowMissingColumns=True)
    running = F.sum("sales").over(W.partitionBy("_year", *other).orderBy("_day").rangeBetween(W.unboundedPreceding, W.currentRow))
    to_date = told.withColumn("sales_ytd", running.cast("double")).where("_asked").select(*by, "sales_ytd")
    return to_date.where("sales_ytd IS NOT NULL") if other else to_date


# ---- winners ------------------------------------------------------------------------------------

# What wins: the grouping, and the names of its label and value. The filter on the grouping's own column is removed.
WINNERS = {"year": ("DimDate.Year", "best_year"), "category": ("DimCategories.CategoryName", "top_category"),
           "month": ("DimDate.MonthName", "peak_month")}


def best_of(star: Star, *kinds: str) -> DataFrame:
    """Best member of each kind and its sales, from one read; a tie yields the largest label."""
    kinds = kinds or tuple(WINNERS)
    asks = {k: Ask((WINNERS[k][0],), without=(WINNERS[k][0],), members="all") for k in kinds}
    best = {}
    for k in kinds:
        label = "number" if k == "year" else "name"
        best[k] = winner_largest_label("sales", label, (F.col("of") == k) & (F.col("member") == 1)).alias(k)
    row = star.groups(asks, {"sales": net()}).agg(*best.values())
    year = {"year": "int"}
    return row.select(*[c for k in kinds for c in (
        F.col(f"{k}.label").cast(year.get(k, "string")).alias(WINNERS[k][1]),
        F.col(f"{k}.value").cast("double").alias(f"{WINNERS[k][1]}_sales"))])


def best_year(star: Star) -> DataFrame:
    """M11, M12."""
    return best_of(star, "year")


def top_category(star: Star) -> DataFrame:
    """M13, M14."""
    return best_of(star, "category")


def peak_month(star: Star) -> DataFrame:
    """By month name, all years pooled."""
    return best_of(star, "month")


def top_customers_sales(star: Star, n: int = 10) -> DataFrame:
    """Sales of the n best customers, ties included, and their share of the total.

    Filters on customers are removed for the ranking; the total keeps them. Customers of equal sales
    are one row, so the n largest amounts hold the n best customers with all their ties.
    """
    asks = {"customer": Ask(("Sales.CustomerKey",), without=("DimCustomers",)), "total": Ask()}
    amount = F.coalesce("sales", F.lit(0))
    amounts = star.groups(asks, {"sales": net()}).groupBy("of", amount.alias("sales")).agg(
        F.count("*").alias("n"), F.sum("sales").alias("held"))
    first = amounts.orderBy(F.desc("of"), F.desc("sales")).limit(n + 1)  # the total, then the largest amounts
    before = F.sum(F.when(F.col("of") == "customer", F.col("n"))).over(W.orderBy(F.desc("of"), F.desc("sales"))) - F.col("n")
    best = F.sum(F.when((F.col("of") == "customer") & (F.col("before") < n), F.col("held")))
    total = F.max(F.when(F.col("of") == "total", F.col("held")))
    return first.withColumn("before", before).agg(best.alias("top"), total.alias("total")).select(
        _double("top").alias("top10_customers_sales"), ratio("top", "total").alias("top10_share"))


# ---- categories ---------------------------------------------------------------------------------

CATEGORY_NAME = "DimCategories.CategoryName"
CATEGORY = {"CategoryName": CATEGORY_NAME}


def category_share(star: Star) -> DataFrame:
    """Each category's part of the sales of all categories.

    The window sees one row per category, at most nine by construction of the dimension, and the total.
    """
    asks = {"category": Ask((CATEGORY_NAME,)), "total": Ask(without=("DimCategories",))}
    total = F.max(F.when(F.col("of") == "total", _double("sales"))).over(W.partitionBy())
    shares = star.groups(asks, {"sales": net()}).withColumn("total", total).where("of = 'category'")
    return shares.select(F.col("name").alias("CategoryName"), ratio("sales", "total").alias("category_share"))


def _ranks(of: Column, value: Column) -> Column:
    """Rank with gaps among the rows of a kind, one row per category."""
    return F.rank().over(W.partitionBy(of).orderBy(F.coalesce(value, F.lit(0)).desc()))


def category_rank(star: Star) -> DataFrame:
    """Rank with gaps among all categories; one without sales counts as 0."""
    asks = {"category": Ask((CATEGORY_NAME,), without=(CATEGORY_NAME,), members="all")}
    ranked = star.groups(asks, {"sales": net()}).where("member = 1").select(
        F.col("name").alias("CategoryName"), _ranks(F.col("of"), F.col("sales")).alias("category_rank"))
    return ranked.join(star.members(CATEGORY_NAME), "CategoryName", "left_semi")


def category_tooltip(star: Star) -> DataFrame:
    """Rank and best product of every category, from one read of the fact."""
    asks = {"category": Ask((CATEGORY_NAME,), without=(CATEGORY_NAME,), members="all"),
            "product": Ask((CATEGORY_NAME, "DimProducts.ProductName"))}
    best = winner_largest_label("sales", "within", F.col("of") == "product")
    per_category = star.groups(asks, {"sales": net()}).groupBy(F.col("name").alias("CategoryName")).agg(
        F.max("member").alias("member"), F.max(F.when(F.col("of") == "category", F.col("sales"))).alias("sales"), best["label"].alias("top_product"))
    ranked = per_category.where("member = 1").withColumn("category_rank", _ranks(F.lit(1), F.col("sales")))
    return ranked.select("CategoryName", "category_rank", "top_product").join(
        star.members(CATEGORY_NAME), "CategoryName", "left_semi")


def category_top_product(star: Star) -> DataFrame:
    """Best product of each category; a tie yields the largest name."""
    by = {**CATEGORY, "ProductName": "DimProducts.ProductName"}
    per_product = star.summarise(by, {"sales": net()})
    best = per_product.groupBy("CategoryName").agg(winner_largest_label("sales", "ProductName").alias("w"))
    return best.select("CategoryName", F.col("w.label").alias("top_product"))


# ---- products -----------------------------------------------------------------------------------

# Labels of the reorder flag and of a selection that is not a single product.
REORDER, STOCK_OK, MANY_PRODUCTS = "⚠ Reorder Needed", "✅ Stock OK", "Multiple Products"


def _below(stock: Column, level: Column) -> Column:
    """Comparison where blank counts as 0."""
    return F.coalesce(stock, F.lit(0)) < F.coalesce(level, F.lit(0))


def _products_by(star: Star, by: Mapping[str, str]) -> tuple[DataFrame, list[Column]]:
    """Products in the context and the columns to group them by, their own or those of category and supplier."""
    products, group = star.dimension("DimProducts"), []
    for table, key in THROUGH_PRODUCT.items():
        wanted = {n: split_ref(r)[1] for n, r in by.items() if split_ref(r)[0] == table}
        if wanted:
            far = star.tables[table].select(F.col(key).alias("_far"), *[F.col(c).alias(f"_by_{n}") for n, c in wanted.items()])
            products = products.join(far, F.col(key) == F.col("_far"), "left").drop("_far")
    for name, ref in by.items():
        table, column = split_ref(ref)
        group.append(F.col(f"_by_{name}" if table in THROUGH_PRODUCT else column).alias(name))
    return products, group


def needs_reorder(star: Star, by: By) -> DataFrame:
    """1 when the stock of the group's products is below their summed reorder level."""
    products, group = _products_by(star, names(by))
    flag = F.when(_below(F.sum("UnitsInStock"), F.sum("ReorderLevel")), 1).otherwise(0)
    return products.groupBy(*group).agg(flag.alias("needs_reorder"))


def low_stock(star: Star) -> DataFrame:
    """Number of products below their reorder level."""
    low = _below(F.col("UnitsInStock"), F.col("ReorderLevel"))
    return star.dimension("DimProducts").agg(F.count_if(low).alias("low_stock"))


def product_card(star: Star, by: By) -> DataFrame:
    """Attributes of the selected product, blank where the group holds several."""
    by = names(by)
    products, group = _products_by(star, by)
    picked = products.groupBy(*group).agg(
        single_value("ProductName", F.lit(MANY_PRODUCTS)).alias("selected_product"),
        single_value("CategoryKey").alias("_category"), single_value("SupplierKey").alias("_supplier"),
        single_value("UnitPrice").alias("selected_unit_price"),
        single_value("UnitsInStock").alias("selected_units_in_stock"),
        single_value("ReorderLevel").alias("selected_reorder_level"))
    category = star.tables["DimCategories"].select(
        F.col("CategoryKey").alias("_category"), F.col("CategoryName").alias("selected_category"))
    supplier = star.tables["DimSuppliers"].select(
        F.col("SupplierKey").alias("_supplier"), F.col("CompanyName").alias("selected_supplier"))
    flag = F.when(_below(F.col("selected_units_in_stock"), F.col("selected_reorder_level")), REORDER).otherwise(STOCK_OK)
    return (picked.join(category, "_category", "left").join(supplier, "_supplier", "left")
            .select(*by, "selected_product", "selected_category", "selected_supplier", "selected_unit_price",
                    "selected_units_in_stock", "selected_reorder_level", flag.alias("reorder_flag")))


def reorder_groups(star: Star, *by: str) -> DataFrame:
    """Groups of products and suppliers whose summed stock is below their summed reorder level."""
    supplier = star.dimension("DimSuppliers").select(F.col("SupplierKey").alias("_supplier"), "CompanyName")
    joined = star.dimension("DimProducts").join(supplier, F.col("SupplierKey") == F.col("_supplier"))
    groups = joined.groupBy(*by).agg(F.sum("UnitsInStock").alias("units_in_stock"),
                                     F.sum("ReorderLevel").alias("reorder_level"))
    flag = F.when(_below(F.col("units_in_stock"), F.col("reorder_level")), 1).otherwise(0)
    return groups.withColumn("needs_reorder", flag).where("needs_reorder = 1")


def reorder_table(star: Star) -> DataFrame:
    """Products to reorder with stock, level and supplier, one row each rather than one long text."""
    return reorder_groups(star, "ProductName", "UnitsInStock", "ReorderLevel", "CompanyName").drop(
        "units_in_stock", "reorder_level")
