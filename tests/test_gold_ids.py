"""Gold from Silver text: ids that are no numbers go to the Others member."""

from pyspark.sql import functions as F

from tradewell.config import OTHERS_NAME
from tradewell.plans import gold


def test_text_category_ids(spark):
    categories = spark.createDataFrame([("1", "Tea"), ("Unknown", "Lost")], "CategoryID string, CategoryName string")
    suppliers = spark.createDataFrame([(5, "Firm")], "SupplierID bigint, CompanyName string")
    products = spark.createDataFrame(
        [(1, "a", "5", "1"), (2, "b", "Unknown", "Unknown"), (3, "c", None, None)],
        "ProductID bigint, ProductName string, SupplierID string, CategoryID string")
    source = {"Categories": categories, "Suppliers": suppliers, "Products": products}
    known = gold.dim_categories(source)
    dim = gold.dim_products(source, known, gold.copied_dimension(source, "DimSuppliers"))
    named = dim.join(known.select("CategoryKey", F.col("CategoryName").alias("name")), "CategoryKey")
    rows = {r.ProductName: (r.name, r.SupplierKey is not None) for r in named.collect()}
    assert rows == {"a": ("Tea", True), "b": (OTHERS_NAME, False), "c": (OTHERS_NAME, False)}
