"""Fixed facts about the feeds: tables, keys, columns, types, technical columns."""

from __future__ import annotations

from dataclasses import dataclass, field

# Business keys and columns of the four tables that arrive from both feeds,
# in the order in which the row hash reads them.
MERGED_COLUMNS = {
    "Customers": (
        ["CustomerID"],
        ["CompanyName", "ContactName", "ContactTitle", "Address", "City", "Region", "PostalCode",
         "Country", "Phone", "Fax"],
    ),
    "Products": (
        ["ProductID"],
        ["ProductName", "SupplierID", "CategoryID", "QuantityPerUnit", "UnitPrice", "UnitsInStock",
         "UnitsOnOrder", "ReorderLevel", "Discontinued"],
    ),
    "Orders": (
        ["OrderID"],
        ["CustomerID", "EmployeeID", "OrderDate", "RequiredDate", "ShippedDate", "ShipVia", "Freight",
         "ShipName", "ShipAddress", "ShipCity", "ShipRegion", "ShipPostalCode", "ShipCountry"],
    ),
    "Order_Details": (
        ["OrderID", "ProductID"],
        ["Quantity", "UnitPrice", "Discount"],
    ),
}

# Business keys of the tables that arrive from the API only.
API_ONLY_KEYS = {
    "Categories": ["CategoryID"],
    "Employees": ["EmployeeID"],
    "Regions": ["RegionID"],
    "Shippers": ["ShipperID"],
    "Suppliers": ["SupplierID"],
    "Territories": ["TerritoryID"],
}

# Types that the cast rules give to non-text columns of each table.
COLUMN_TYPES = {
    "Customers": {"CustomerID": "string"},
    "Products": {
        "ProductID": "bigint", "SupplierID": "bigint", "CategoryID": "bigint", "UnitPrice": "double",
        "UnitsInStock": "bigint", "UnitsOnOrder": "bigint", "ReorderLevel": "bigint",
        "Discontinued": "boolean",
    },
    "Orders": {
        "OrderID": "bigint", "CustomerID": "string", "EmployeeID": "bigint", "ShipVia": "bigint",
        "Freight": "double",
    },
    "Order_Details": {
        "OrderID": "bigint", "ProductID": "bigint", "Quantity": "bigint", "UnitPrice": "double",
        "Discount": "double",
    },
    "Categories": {"CategoryID": "bigint"},
    "Employees": {"EmployeeID": "bigint", "ReportsTo": "bigint"},
    "Regions": {"RegionID": "bigint"},
    "Shippers": {"ShipperID": "bigint"},
    "Suppliers": {"SupplierID": "bigint"},
    "Territories": {"TerritoryID": "string", "RegionID": "bigint"},
}

# Columns that the history layer adds to a table.
TECHNICAL_COLUMNS = frozenset({
    "source_system", "row_hash", "effective_start", "effective_end", "is_current", "_run_id",
    "created_at", "modified_at", "operation", "ingested_at",
})

# The columns without which a table is not a history table.
HISTORY_COLUMNS = ["row_hash", "effective_start", "effective_end", "is_current", "source_system"]

# API feed row counts that the page diagnostic expects.
EXPECTED_API_ROWS = {"Customers": 91, "Products": 77, "Orders": 830, "Order_Details": 2155}

# Start of the baseline version, labels of the two feeds, texts for nulls.
BASELINE_START = "2026-01-01 00:00:00"
API, EXCEL = "API", "Excel"
UNKNOWN_TEXT = "Unknown"
HASH_NULL, HASH_SEPARATOR = "<NULL>", "||"

# Range of category ids that keep their own member, and the bucket for all others.
CATEGORY_IDS = (1, 8)
OTHERS_ID, OTHERS_NAME = -1, "Others"

# Spellings of one table, and prefixes of landed folders.
TABLE_ALIASES = {"OrderDetails": "Order_Details"}
API_PREFIX, EXCEL_PREFIX = "bronze_", "bronze_excel_"

# Foreign keys that share no column name with the table they point to, or sit in a composite key.
DECLARED_FOREIGN_KEYS = [
    ("Orders", "ShipVia", "Shippers", "ShipperID"),
    ("Order_Details", "OrderID", "Orders", "OrderID"),
    ("Order_Details", "ProductID", "Products", "ProductID"),
    ("Employees", "ReportsTo", "Employees", "EmployeeID"),
]


@dataclass(frozen=True)
class Entity:
    """One business table: its key columns, its other columns and its non-text types."""

    name: str
    keys: list[str]
    columns: list[str] = field(default_factory=list)

    @property
    def business_columns(self) -> list[str]:
        return self.keys + self.columns

    @property
    def types(self) -> dict[str, str]:
        return COLUMN_TYPES.get(self.name, {})


MERGED = {name: Entity(name, keys, columns) for name, (keys, columns) in MERGED_COLUMNS.items()}
KEYS = {**{n: e.keys for n, e in MERGED.items()}, **API_ONLY_KEYS}


def table_name(raw: str) -> str:
    """One spelling per table, whatever the feed called it."""
    return TABLE_ALIASES.get(raw, raw)


def silver_name(table: str) -> str:
    return f"silver_{table.lower()}"
