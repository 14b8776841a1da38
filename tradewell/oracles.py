"""SQL counterparts of the registered queries, written against the raw test tables.

They say what a query must return, independently of how it is computed.
"""

from __future__ import annotations

# ---- business tables ----------------------------------------------------------------------------

_SOURCES = """
places AS (
  SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
src_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS CustomerID, c_name AS CompanyName, CAST(NULL AS VARCHAR) AS ContactName,
         c_mktsegment AS ContactTitle, CAST(NULL AS VARCHAR) AS Address, n_name AS City, r_name AS Region,
         CAST(NULL AS VARCHAR) AS PostalCode, n_name AS Country, CAST(NULL AS VARCHAR) AS Phone, CAST(NULL AS VARCHAR) AS Fax
  FROM customer JOIN places ON c_nationkey = n_nationkey),
src_products AS (
  SELECT p_partkey AS ProductID, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS ProductName,
         p_partkey % (SELECT count(*) FROM supplier) AS SupplierID, CAST(p_size % 10 + 1 AS BIGINT) AS CategoryID,
         CAST(NULL AS VARCHAR) AS QuantityPerUnit, p_retailprice AS UnitPrice, CAST(p_size AS BIGINT) AS UnitsInStock,
         CAST(0 AS BIGINT) AS UnitsOnOrder, CAST(25 AS BIGINT) AS ReorderLevel, false AS Discontinued
  FROM part),
src_orders AS (
  SELECT o_orderkey AS OrderID, CAST(o_custkey AS VARCHAR) AS CustomerID, o_orderkey % 25 AS EmployeeID,
         CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS OrderDate,
         CAST(CAST(o_orderdate AS DATE) + 30 AS TIMESTAMP) AS RequiredDate,
         CASE WHEN o_orderkey % 20 <> 0 THEN CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INTEGER) AS TIMESTAMP) END AS ShippedDate,
         o_orderkey % 5 AS ShipVia, o_totalprice AS Freight, CAST(NULL AS VARCHAR) AS ShipName,
         CAST(NULL AS VARCHAR) AS ShipAddress, CAST(NULL AS VARCHAR) AS ShipCity, r_name AS ShipRegion,
         CAST(NULL AS VARCHAR) AS ShipPostalCode, n_name AS ShipCountry
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN places ON c_nationkey = n_nationkey),
raw_details AS (
  SELECT l_orderkey AS OrderID, l_partkey AS ProductID, CAST(l_quantity AS BIGINT) AS Quantity,
         p_retailprice AS UnitPrice, l_discount + 0.0 AS Discount,
         row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, l_suppkey, l_shipdate,
           l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS place
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
src_details AS (SELECT OrderID, ProductID, Quantity, UnitPrice, Discount FROM raw_details WHERE place = 1)
"""

# ---- second feed and history --------------------------------------------------------------------

_FEEDS = """
new_customers AS (
  SELECT * REPLACE (CASE WHEN CAST(CustomerID AS BIGINT) % 10 = 0 THEN ContactTitle || ' (NEW)' ELSE ContactTitle END AS ContactTitle)
  FROM src_customers WHERE CAST(CustomerID AS BIGINT) % 10 IN (0, 1)
  UNION ALL
  SELECT * REPLACE (CAST(CAST(CustomerID AS BIGINT) + (SELECT max(c_custkey) FROM customer) AS VARCHAR) AS CustomerID)
  FROM src_customers WHERE CAST(CustomerID AS BIGINT) % 50 = 7),
new_products AS (
  SELECT * REPLACE (CASE WHEN ProductID % 10 = 0 THEN UnitsInStock + 100 ELSE UnitsInStock END AS UnitsInStock)
  FROM src_products WHERE ProductID % 10 IN (0, 1)
  UNION ALL SELECT * REPLACE (ProductID + (SELECT max(p_partkey) FROM part) AS ProductID) FROM src_products WHERE ProductID % 50 = 7),
new_orders AS (
  SELECT * REPLACE (CASE WHEN OrderID % 10 = 0 THEN Freight + 1 ELSE Freight END AS Freight)
  FROM src_orders WHERE OrderID % 10 IN (0, 1)
  UNION ALL SELECT * REPLACE (OrderID + (SELECT max(o_orderkey) FROM orders) AS OrderID) FROM src_orders WHERE OrderID % 50 = 7),
new_details AS (
  SELECT * REPLACE (CASE WHEN OrderID % 10 = 0 THEN Quantity + 1 ELSE Quantity END AS Quantity)
  FROM src_details WHERE OrderID % 10 IN (0, 1)
  UNION ALL SELECT * REPLACE (OrderID + (SELECT max(o_orderkey) FROM orders) AS OrderID) FROM src_details WHERE OrderID % 50 = 7)
"""

_RUN = "TIMESTAMP '2026-02-01 00:00:00'"
_BASE = "TIMESTAMP '2026-01-01 00:00:00'"


def _text(column: str, kind: str) -> str:
    inner = {"double": f"CAST(CAST(CAST({column} AS VARCHAR) AS DECIMAL(38,10)) AS VARCHAR)",
             "date": f"strftime({column}, '%Y-%m-%d %H:%M:%S')"}.get(kind, f"CAST({column} AS VARCHAR)")
    return f"coalesce({inner}, '<NULL>')"


def _hash(columns: dict[str, str]) -> str:
    return "sha256(" + " || '||' || ".join(_text(c, k) for c, k in columns.items()) + ")"


_HASHED = {
    "customers": dict.fromkeys(["CustomerID", "CompanyName", "ContactName", "ContactTitle", "Address", "City", "Region",
                                "PostalCode", "Country", "Phone", "Fax"], ""),
    "products": {"ProductID": "", "ProductName": "", "SupplierID": "", "CategoryID": "", "QuantityPerUnit": "",
                 "UnitPrice": "double", "UnitsInStock": "", "UnitsOnOrder": "", "ReorderLevel": "", "Discontinued": ""},
    "orders": {"OrderID": "", "CustomerID": "", "EmployeeID": "", "OrderDate": "date", "RequiredDate": "date",
               "ShippedDate": "date", "ShipVia": "", "Freight": "double", "ShipName": "", "ShipAddress": "",
               "ShipCity": "", "ShipRegion": "", "ShipPostalCode": "", "ShipCountry": ""},
    "details": {"OrderID": "", "ProductID": "", "Quantity": "", "UnitPrice": "double", "Discount": "double"},
}
_KEYS = {"customers": ["CustomerID"], "products": ["ProductID"], "orders": ["OrderID"], "details": ["OrderID", "ProductID"]}


def _history(name: str) -> str:
    """History of one table as the reference semantics state it: four branches."""
    columns = ", ".join(_HASHED[name])
    shown = ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" if k == "date" else c for c, k in _HASHED[name].items())
    using = ", ".join(_KEYS[name])
    hashed = _hash(_HASHED[name])
    return f"""
h_old_{name} AS (SELECT {columns}, {hashed} AS row_hash FROM src_{name}),
h_new_{name} AS (SELECT {columns}, {hashed} AS row_hash FROM new_{name}),
h_changed_{name} AS (
  SELECT {using} FROM h_old_{name} o JOIN h_new_{name} n USING ({using}) WHERE o.row_hash <> n.row_hash),
h_{name} AS (
  SELECT {shown}, 'API' AS source_system, {_BASE} AS effective_start, CAST(NULL AS TIMESTAMP) AS effective_end,
         true AS is_current, {_BASE} AS created_at, {_BASE} AS modified_at, 'I' AS operation, row_hash
  FROM h_old_{name} ANTI JOIN h_changed_{name} USING ({using})
  UNION ALL
  SELECT {shown}, 'API', {_BASE}, {_RUN}, false, {_BASE}, {_RUN}, 'I', row_hash
  FROM h_old_{name} SEMI JOIN h_changed_{name} USING ({using})
  UNION ALL
  SELECT {shown}, 'Excel', {_RUN}, NULL, true, {_RUN}, {_RUN}, 'U', row_hash
  FROM h_new_{name} SEMI JOIN h_changed_{name} USING ({using})
  UNION ALL
  SELECT {shown}, 'Excel', {_RUN}, NULL, true, {_RUN}, {_RUN}, 'I', row_hash
  FROM h_new_{name} ANTI JOIN h_old_{name} USING ({using}))
"""


def _merged(names: list[str], select: str) -> str:
    return f"WITH {_SOURCES}, {_FEEDS}, " + ", ".join(_history(n) for n in names) + f" {select}"


# ---- star ---------------------------------------------------------------------------------------

_LINE = ("CAST(CAST(d.Quantity AS DECIMAL(10,0)) * CAST(d.UnitPrice AS DECIMAL(12,2)) * "
         "(1 - CAST(d.Discount AS DECIMAL(4,2))) AS DECIMAL(18,2))")

_DIMENSIONS = """
dim_customers AS (SELECT row_number() OVER (ORDER BY CustomerID) AS CustomerKey, * FROM src_customers),
dim_employees AS (
  SELECT CAST(n_nationkey + 1 AS BIGINT) AS EmployeeKey, CAST(n_nationkey AS BIGINT) AS EmployeeID,
         'R' || CAST(n_regionkey AS VARCHAR) AS LastName, n_name AS FirstName FROM nation),
dim_suppliers AS (
  SELECT row_number() OVER (ORDER BY s_suppkey) AS SupplierKey, s_suppkey AS SupplierID, s_name AS CompanyName FROM supplier),
dim_shippers AS (
  SELECT row_number() OVER (ORDER BY r_regionkey) AS ShipperKey, CAST(r_regionkey AS BIGINT) AS ShipperID, r_name AS CompanyName FROM region),
known_categories AS (
  SELECT row_number() OVER (ORDER BY CategoryID) AS CategoryKey, CategoryID, 'Category ' || CAST(CategoryID AS VARCHAR) AS CategoryName
  FROM (SELECT DISTINCT CategoryID FROM src_products WHERE CategoryID BETWEEN 1 AND 8)),
dim_categories AS (
  SELECT * FROM known_categories
  UNION ALL SELECT (SELECT coalesce(max(CategoryKey), 0) + 1 FROM known_categories), CAST(-1 AS BIGINT), 'Others'),
dim_products AS (
  SELECT row_number() OVER (ORDER BY p.ProductID) AS ProductKey, p.*,
         coalesce(c.CategoryKey, (SELECT max(CategoryKey) FROM dim_categories)) AS CategoryKey, s.SupplierKey
  FROM src_products p LEFT JOIN known_categories c ON p.CategoryID = c.CategoryID
  LEFT JOIN dim_suppliers s ON p.SupplierID = s.SupplierID),
span AS (
  SELECT least(min(OrderDate), min(ShippedDate), min(RequiredDate)) AS lo,
         greatest(max(OrderDate), max(ShippedDate), max(RequiredDate)) AS hi FROM src_orders),
days AS (SELECT CAST(unnest(generate_series(lo - INTERVAL 7 DAY, hi + INTERVAL 7 DAY, INTERVAL 1 DAY)) AS DATE) AS FullDate FROM span),
dim_date AS (
  SELECT FullDate, CAST(strftime(FullDate, '%Y%m%d') AS INTEGER) AS DateKey, CAST(year(FullDate) AS INTEGER) AS "Year",
         CAST(quarter(FullDate) AS INTEGER) AS Quarter, CAST(month(FullDate) AS INTEGER) AS "Month",
         monthname(FullDate) AS MonthName, CAST(day(FullDate) AS INTEGER) AS "Day", dayname(FullDate) AS DayName,
         CAST(ceil((dayofyear(FullDate) + dayofweek(date_trunc('year', FullDate))) / 7.0) AS INTEGER) AS WeekOfYear
  FROM days)
"""

_SALES = f"""
sales AS (
  SELECT d.OrderID, d.ProductID, cu.CustomerKey, em.EmployeeKey, pr.ProductKey, sh.ShipperKey,
         CAST(strftime(o.OrderDate, '%Y%m%d') AS INTEGER) AS OrderDateKey,
         CAST(strftime(o.ShippedDate, '%Y%m%d') AS INTEGER) AS ShippedDateKey,
         CAST(strftime(o.RequiredDate, '%Y%m%d') AS INTEGER) AS RequiredDateKey,
         CAST(o.OrderDate AS DATE) AS OrderDate, CAST(o.ShippedDate AS DATE) AS ShippedDate,
         CAST(o.RequiredDate AS DATE) AS RequiredDate, d.Quantity, d.UnitPrice, d.Discount, {_LINE} AS LineTotal,
         o.Freight, o.ShipCountry, o.ShipRegion,
         CAST(date_diff('day', o.OrderDate, o.ShippedDate) AS INTEGER) AS DeliveryDays,
         CAST(CASE WHEN o.ShippedDate IS NULL OR o.RequiredDate IS NULL THEN NULL
                   WHEN o.ShippedDate <= o.RequiredDate THEN 1 ELSE 0 END AS INTEGER) AS OnTimeFlag
  FROM src_details d LEFT JOIN src_orders o USING (OrderID)
  LEFT JOIN dim_customers cu ON o.CustomerID = cu.CustomerID LEFT JOIN dim_employees em ON o.EmployeeID = em.EmployeeID
  LEFT JOIN dim_shippers sh ON o.ShipVia = sh.ShipperID LEFT JOIN dim_products pr ON d.ProductID = pr.ProductID),
s AS (
  SELECT f.*, CAST(f.Quantity * f.UnitPrice * (1 - f.Discount) AS DECIMAL(18,4)) AS net, cu.CompanyName AS Customer,
         cu.ContactTitle, cu.City, cu.Region AS CustomerRegion, em.FirstName, em.LastName, sh.CompanyName AS Shipper,
         pr.ProductName, ca.CategoryName, dt."Year", dt."Month", dt.MonthName
  FROM sales f LEFT JOIN dim_customers cu USING (CustomerKey) LEFT JOIN dim_employees em USING (EmployeeKey)
  LEFT JOIN dim_shippers sh USING (ShipperKey) LEFT JOIN dim_products pr USING (ProductKey)
  LEFT JOIN dim_categories ca USING (CategoryKey) LEFT JOIN dim_date dt ON f.OrderDateKey = dt.DateKey)
"""

_SHARED = """"Year" IN (1996, 1997) AND FirstName IN (SELECT 'NATION_' || CAST(i AS VARCHAR) FROM range(5, 20) t(i))
  AND ShipCountry IN (SELECT 'NATION_' || CAST(i AS VARCHAR) FROM range(12) t(i))"""


def _source(select: str) -> str:
    return f"WITH {_SOURCES} {select}"


def _feed(select: str) -> str:
    return f"WITH {_SOURCES}, {_FEEDS} {select}"


def _star(select: str, more: str = "") -> str:
    extra = f", {more}" if more else ""
    return f"WITH {_SOURCES}, {_DIMENSIONS}, {_SALES}{extra} {select}"


def _dim(select: str) -> str:
    return f"WITH {_SOURCES}, {_DIMENSIONS} {select}"


_NET = "CAST(sum(net) AS DOUBLE)"
_LT = "CAST(sum(LineTotal) AS DOUBLE)"
_FREIGHT = "CAST(sum(CAST(Freight AS DECIMAL(18,4))) AS DOUBLE)"
_AOV = f"{_NET} / nullif(CAST(count(DISTINCT OrderID) AS DOUBLE), 0)"


def _pct(x: str, digits: int = 0) -> str:
    return f"printf('%.{digits}f', round(CAST({x} AS DOUBLE) * 100, {digits})) || '%'"


def _whole(x: str) -> str:
    return f"format('{{:,}}', CAST(round(CAST({x} AS DOUBLE)) AS BIGINT))"


def _best(ref: str, value: str = "sum(net)", members: str = "", largest: bool = True) -> str:
    """Label of the best group, null when several tie."""
    order = "DESC" if largest else "ASC"
    source = members or f"SELECT {ref} AS label, {value} AS v FROM s GROUP BY {ref}"
    return (f"(SELECT CASE WHEN count(*) = 1 THEN max(label) END FROM (SELECT label, rank() OVER (ORDER BY coalesce(v, 0) {order}) AS r "
            f"FROM ({source})) WHERE r = 1)")


def _first(ref: str, value: str = "sum(net)") -> str:
    """Label of the best group, ties broken by the smallest label."""
    return f"(SELECT label FROM (SELECT {ref} AS label, {value} AS v FROM s GROUP BY {ref}) ORDER BY v DESC, label LIMIT 1)"


def _largest(ref: str, column: str, where: str = "true") -> str:
    """Label or value of the best group, ties to the largest label."""
    return (f"(SELECT {column} FROM (SELECT {ref} AS label, CAST(sum(net) AS DOUBLE) AS v FROM s WHERE {where} GROUP BY {ref}) "
            f"ORDER BY v DESC, label DESC LIMIT 1)")


_CATEGORY_LT = "SELECT CategoryName AS label, sum(LineTotal) AS v FROM dim_categories LEFT JOIN s USING (CategoryName) GROUP BY CategoryName"
_YEAR_LT = 'SELECT "Year" AS label, sum(LineTotal) AS v FROM dim_date d LEFT JOIN (SELECT "Year" AS y, LineTotal FROM s) ON y = d."Year" GROUP BY ALL'
_MONTH_LT = "SELECT MonthName AS label, sum(LineTotal) AS v FROM s GROUP BY MonthName"


def _top(ref: str, n: int, where: str = "true", column: str = "net") -> str:
    """Groups whose value is among the n best, ties kept."""
    return (f"SELECT label, CAST(v AS DOUBLE) AS v FROM (SELECT {ref} AS label, sum({column}) AS v, "
            f"rank() OVER (ORDER BY sum({column}) DESC) AS r FROM s WHERE {where} GROUP BY {ref}) WHERE r <= {n}")


_DAILY = """
daily AS (SELECT OrderDate AS day, sum(net) AS v FROM s GROUP BY OrderDate)"""

_ANSWERS = {
    "growth": f"""
      peak AS (SELECT {_best('', members='SELECT label, v FROM (' + _YEAR_LT + ')')} AS y),
      per_year AS (SELECT "Year" AS y, CAST(sum(LineTotal) AS DOUBLE) AS v FROM s GROUP BY "Year"),
      growth AS (SELECT peak.y AS peak_year, a.v AS peak_sales, (a.v - b.v) / b.v AS growth_before,
                        (coalesce(c.v, 0) - a.v) / a.v AS change_after
                 FROM peak LEFT JOIN per_year a ON a.y = peak.y LEFT JOIN per_year b ON b.y = peak.y - 1
                 LEFT JOIN per_year c ON c.y = peak.y + 1)""",
}
_GROWTH_TEXT = (
    "'Sales grew ' || coalesce(" + _pct("growth_before") + ", '') || ' into ' || peak_year || ', then ' || "
    "CASE WHEN change_after < 0 THEN 'fell ' || " + _pct("abs(change_after)") + " ELSE 'kept rising ' || coalesce(" + _pct("change_after") + ", '') END || "
    "' the year after. Prioritize retention for customers acquired in ' || peak_year || ' to protect against the post-peak drop.'")

_OPERATIONS = f"""
      ops AS (SELECT CAST(sum(DeliveryDays) AS DOUBLE) / CAST(count(DeliveryDays) AS DOUBLE) AS avg_delivery_days,
                     CAST(sum(OnTimeFlag) AS DOUBLE) / CAST(count(OnTimeFlag) AS DOUBLE) AS on_time_share,
                     {_best('Shipper', 'CAST(sum(DeliveryDays) AS DOUBLE) / count(DeliveryDays)')} AS slowest_shipper FROM s)"""
_OPERATIONS_TEXT = (
    "'Average delivery is ' || printf('%.1f', round(avg_delivery_days, 1)) || ' days at a ' || " + _pct("on_time_share") +
    " || ' on-time rate. ' || coalesce(slowest_shipper, '') || ' runs slowest — renegotiate their SLA or shift volume to a faster carrier.'")

_BUYING = f"""
      buy AS (SELECT {_best('Customer', 'sum(LineTotal)')} AS top_customer),
      buying AS (SELECT top_customer, (SELECT {_LT} FROM s WHERE Customer = top_customer) / (SELECT {_LT} FROM s) AS concentration FROM buy)"""
_BUYING_TEXT = (
    "coalesce(top_customer, '') || ' drives ' || coalesce(" + _pct("concentration", 1) + ", '') || ' of total revenue. ' || CASE WHEN concentration > 0.1 "
    "THEN 'That''s a retention risk — build a dedicated account plan and diversify acquisition.' "
    "ELSE 'Revenue is healthily diversified — keep prioritizing broad acquisition.' END")

_SELLING = f"""
      selling AS (SELECT {_best('', members=_CATEGORY_LT)} AS top_category,
                         {_best('', members=_CATEGORY_LT, largest=False)} AS bottom_category)"""
_SELLING_TEXT = (
    "coalesce(top_category, '') || ' leads sales; ' || coalesce(bottom_category, '') || ' lags furthest behind. Bundle ' || coalesce(bottom_category, '') || ' with ' || "
    "coalesce(top_category, '') || ' in promotions, or reassess whether it''s worth the catalog space.'")

_SEASON = f"season AS (SELECT {_best('', members=_MONTH_LT)} AS peak_month)"
_SEASON_TEXT = "coalesce(peak_month, '') || ' is consistently your strongest sales month.'"
_SEASON_ADVICE = ("'Build up inventory and staffing ahead of ' || coalesce(peak_month, '') || ', and test a promotion in your weakest "
                  "month to smooth the seasonal gap.'")

_PEAK = f"""
      best AS (SELECT {_first('"Year"')} AS best_year),
      peak_year AS (SELECT CAST(NULL AS INTEGER) AS selected_year, best_year,
                           (SELECT {_NET} FROM s WHERE "Year" = best_year) AS best_sales FROM best)"""
_PEAK_TEXT = "'Peak year: ' || best_year || ' with $' || " + _whole("best_sales") + " || ' in sales.'"
_LEADERS = f"leaders AS (SELECT {_first('CategoryName')} AS top_category, {_first('ProductName')} AS top_product)"
_LEADERS_TEXT = "'Leading category: ' || top_category || '. Top product: ' || top_product || '.'"
_CUSTOMER = f"customer_first AS (SELECT {_first('Customer')} AS top_customer)"
_CUSTOMER_TEXT = "'Top customer: ' || top_customer || ' within the current filter selection.'"
_ON_TIME = ("coalesce(CAST(count(DISTINCT CASE WHEN OnTimeFlag = 1 THEN OrderID END) AS DOUBLE) / "
            "nullif(CAST(count(DISTINCT CASE WHEN ShippedDate IS NOT NULL AND RequiredDate IS NOT NULL THEN OrderID END) AS DOUBLE), 0), 0)")
_DELIVERY = f"""
      delivery AS (SELECT {_ON_TIME} AS on_time_rate,
                          (SELECT FirstName || ' ' || LastName FROM dim_employees WHERE EmployeeKey = {_first('EmployeeKey')}) AS top_employee FROM s)"""
_DELIVERY_TEXT = "'On-time delivery: ' || " + _pct("on_time_rate", 1) + " || '. Top performer: ' || top_employee || '.'"

_LOW = "SELECT count(*) AS low_stock FROM dim_products WHERE UnitsInStock < ReorderLevel"
_REORDER = """SELECT ProductName, UnitsInStock, ReorderLevel, s2.CompanyName, 1 AS needs_reorder
  FROM dim_products p JOIN dim_suppliers s2 USING (SupplierKey) WHERE UnitsInStock < ReorderLevel"""
_AVG_DELIVERY = "SELECT {by} CAST(sum(d) AS DOUBLE) / count(d) AS avg_delivery_days FROM (SELECT {by} OrderID, max(DeliveryDays) AS d FROM s GROUP BY ALL) {group}"

_CARDS = {
    "total_sales": f"SELECT {_LT} AS line_total, {_best('', members=_CATEGORY_LT)} AS leading_category, '$' || {_whole('sum(LineTotal)')} AS value_text FROM s",
    "total_orders": f"SELECT count(DISTINCT OrderID) AS total_orders, {_best('ProductName', 'sum(Quantity)')} AS most_ordered_product, {_whole('count(DISTINCT OrderID)')} AS value_text FROM s",
    "active_customers": "SELECT count(DISTINCT CustomerKey) AS active_customers, " + _best('"Year"', "count(DISTINCT CustomerKey)") + f" AS peak_year, {_whole('count(DISTINCT CustomerKey)')} AS value_text FROM s",
    "avg_order_value": f"SELECT {_LT} / count(DISTINCT OrderID) AS avg_order_value, " + _best("ShipCountry", "CAST(sum(LineTotal) AS DOUBLE) / count(DISTINCT OrderID)") + f" AS top_country, '$' || {_whole(_LT + ' / count(DISTINCT OrderID)')} AS value_text FROM s",
}

_MERGE_COUNTS = """SELECT CAST('silver_{table}' AS VARCHAR) AS target_table, '{sheet}' AS sheet, (SELECT count(*) FROM new_{name}) AS excel_rows,
  count(*) FILTER (source_system = 'Excel') AS net_row_change, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error,
  count(*) FILTER (source_system = 'API') AS api_rows,
  (SELECT count(*) FROM new_{name}) - count(*) FILTER (source_system = 'Excel') AS unchanged_rows,
  count(*) FILTER (operation = 'U') AS changed_rows, count(*) FILTER (source_system = 'Excel' AND operation = 'I') AS new_rows,
  count(*) FILTER (is_current) AS current_rows, count(*) FILTER (NOT is_current) AS historical_rows FROM h_{name}"""
_MERGED_NAMES = [("customers", "customers", "Customers"), ("products", "products", "Products"),
                 ("orders", "orders", "Orders"), ("details", "order_details", "Order_Details")]

# Silver tables as rows of (table, key, total, current, historical, duplicates over all versions).
_API_ONLY_COUNTS = """
  SELECT 'Categories' AS table_name, 'CategoryID' AS primary_key, (SELECT count(DISTINCT p_size % 10) FROM part) AS n
  UNION ALL SELECT 'Employees', 'EmployeeID', (SELECT count(*) FROM nation)
  UNION ALL SELECT 'Regions', 'RegionID', (SELECT count(*) FROM region)
  UNION ALL SELECT 'Shippers', 'ShipperID', (SELECT count(*) FROM region)
  UNION ALL SELECT 'Suppliers', 'SupplierID', (SELECT count(*) FROM supplier)
  UNION ALL SELECT 'Territories', 'TerritoryID', (SELECT count(*) FROM nation)"""


def _silver_counts() -> str:
    merged = " UNION ALL ".join(
        f"""SELECT '{sheet}' AS table_name, '{','.join(_KEYS[name])}' AS primary_key, count(*) AS row_count,
        count(*) FILTER (is_current) AS current_rows, count(*) FILTER (NOT is_current) AS historical_rows,
        count(*) FILTER (source_system = 'API') AS all_api_rows, count(*) FILTER (source_system = 'Excel') AS all_excel_rows,
        count(*) FILTER (source_system = 'API' AND is_current) AS current_api_rows,
        count(*) FILTER (source_system = 'Excel' AND is_current) AS current_excel_rows FROM h_{name}"""
        for name, _, sheet in _MERGED_NAMES)
    return f"""silver_counts AS ({merged}
      UNION ALL SELECT table_name, primary_key, n, n, 0, n, 0, n, 0 FROM ({_API_ONLY_COUNTS}))"""


def _silver(select: str) -> str:
    return (f"WITH {_SOURCES}, {_FEEDS}, " + ", ".join(_history(n) for n in _HASHED) + f", {_silver_counts()}, {_orphans()} {select}")


def _orphans() -> str:
    """Orders sent with a new key have no lines of their own customer, and lines may name orders that were not sent."""
    checks = [
        ("Products", "SupplierID -> Suppliers.SupplierID", "SELECT count(*) FROM h_products WHERE SupplierID NOT IN (SELECT s_suppkey FROM supplier)"),
        ("Products", "CategoryID -> Categories.CategoryID", "SELECT count(*) FROM h_products WHERE CategoryID NOT IN (SELECT CategoryID FROM src_products)"),
        ("Orders", "CustomerID -> Customers.CustomerID", "SELECT count(*) FROM h_orders WHERE CustomerID NOT IN (SELECT CustomerID FROM h_customers)"),
        ("Orders", "EmployeeID -> Employees.EmployeeID", "SELECT count(*) FROM h_orders WHERE EmployeeID NOT IN (SELECT n_nationkey FROM nation)"),
        ("Orders", "ShipVia -> Shippers.ShipperID", "SELECT count(*) FROM h_orders WHERE ShipVia NOT IN (SELECT r_regionkey FROM region)"),
        ("Order_Details", "OrderID -> Orders.OrderID", "SELECT count(*) FROM h_details WHERE OrderID NOT IN (SELECT OrderID FROM h_orders)"),
        ("Order_Details", "ProductID -> Products.ProductID", "SELECT count(*) FROM h_details WHERE ProductID NOT IN (SELECT ProductID FROM h_products)"),
        ("Territories", "RegionID -> Regions.RegionID", "SELECT count(*) FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)"),
    ]
    rows = " UNION ALL ".join(f"SELECT '{c[0]}' AS table_name, '{c[1]}' AS reference, ({c[2]}) AS orphan_count" for c in checks)
    return f"orphan_counts AS ({rows})"


_READY = """ready AS (
  SELECT c.*, coalesce((SELECT 'Referential integrity failures: ' || string_agg(reference, ', ' ORDER BY reference)
    FROM orphan_counts o WHERE o.table_name = c.table_name AND orphan_count > 0), '') AS reasons FROM silver_counts c)"""


def _ready(select: str) -> str:
    return _silver("") .rstrip() + f", {_READY} {select}"


_VALIDATION = """
validated(table_name, has_api, has_excel, api_count, api_source_count, excel_count, api_pk_duplicates, inferred_pk) AS (
  SELECT 'Categories', true, false, (SELECT count(DISTINCT p_size % 10) FROM part), NULL, NULL, 0, 'CategoryID'
  UNION ALL SELECT 'Customers', true, true, (SELECT count(*) FROM customer), NULL, (SELECT count(*) FROM new_customers), 0, 'CustomerID'
  UNION ALL SELECT 'Employees', true, false, (SELECT count(*) FROM nation), 26, NULL, 0, 'EmployeeID'
  UNION ALL SELECT 'Order_Details', true, true, (SELECT count(*) FROM lineitem), NULL, (SELECT count(*) FROM new_details),
    (SELECT count(*) FROM raw_details WHERE place > 1), 'OrderID,ProductID'
  UNION ALL SELECT 'Orders', true, true, (SELECT count(*) FROM orders), NULL, (SELECT count(*) FROM new_orders), 0, 'OrderID'
  UNION ALL SELECT 'Products', true, true, (SELECT count(*) FROM part), NULL, (SELECT count(*) FROM new_products), 0, 'ProductID'
  UNION ALL SELECT 'Regions', true, false, (SELECT count(*) FROM region), 5, NULL, 0, 'RegionID'
  UNION ALL SELECT 'Suppliers', true, false, (SELECT count(*) FROM supplier), NULL, NULL, 0, 'SupplierID'
  UNION ALL SELECT 'Territories', true, false, (SELECT count(*) FROM nation), NULL, NULL, 0, 'TerritoryID'
  UNION ALL SELECT 'Shippers', false, false, NULL, NULL, NULL, 0, NULL),
judged AS (
  SELECT *, CASE WHEN NOT has_api THEN 'unreadable' ELSE nullif(concat_ws('; ',
    CASE WHEN api_count <> api_source_count THEN 'API count mismatch: expected=' || api_source_count || ', actual=' || api_count END,
    CASE WHEN api_pk_duplicates > 0 THEN api_pk_duplicates || ' duplicate API PK rows' END), '') END AS found FROM validated)"""

def _refined(name: str) -> str:
    """A merged table as Silver keeps it: dates parsed, null text filled, all versions."""
    numbers = {"SupplierID", "CategoryID", "UnitsInStock", "UnitsOnOrder", "ReorderLevel", "Discontinued", "EmployeeID", "ShipVia", "Quantity"}
    shown = [f"CAST({c} AS TIMESTAMP) AS {c}" if k == "date" else c if k == "double" or c in numbers or (c in _KEYS[name] and name != "customers")
             else f"coalesce({c}, 'Unknown') AS {c}" for c, k in _HASHED[name].items()]
    return _merged([name], f"SELECT {', '.join(shown)}, source_system, effective_start, effective_end, is_current, created_at, modified_at, operation, row_hash FROM h_{name}")


def _api_only(columns: dict[str, str], source: str) -> str:
    """A table of the API feed alone as Silver keeps it."""
    hashed = " || '||' || ".join(f"CAST({c} AS VARCHAR)" for c in columns.values())
    shown = ", ".join(f"{c} AS {n}" for n, c in columns.items())
    return (f"SELECT {shown}, {_RUN} AS ingested_at, 'API' AS source_system, {_RUN} AS effective_start, CAST(NULL AS TIMESTAMP) AS effective_end, "
            f"true AS is_current, {_RUN} AS created_at, {_RUN} AS modified_at, 'I' AS operation, sha256({hashed}) AS row_hash, 'run-1' AS _run_id FROM {source}")


_BROKEN = _silver(""" , broken AS (
  SELECT table_name, primary_key, row_count, current_rows, historical_rows, 0 AS dup, all_api_rows, all_excel_rows, current_api_rows, current_excel_rows
  FROM silver_counts WHERE table_name IN ('Regions', 'Products', 'Orders')
  UNION ALL SELECT table_name, primary_key, 2 * row_count, 2 * current_rows, 0, row_count, 2 * row_count, 0, 2 * row_count, 0 FROM silver_counts WHERE table_name = 'Suppliers'
  UNION ALL SELECT 'Shippers', '', 0, 0, 0, 0, 0, 0, 0, 0),
refs AS (SELECT table_name, string_agg(reference, ', ' ORDER BY reference) AS lost FROM orphan_counts
         WHERE orphan_count > 0 AND reference IN ('SupplierID -> Suppliers.SupplierID') GROUP BY table_name),
broken_ready AS (
  SELECT b.*, CASE WHEN table_name = 'Shippers' THEN 'Silver transformation failed' ELSE concat_ws('; ',
    CASE WHEN dup > 0 THEN 'Duplicate current keys found' END,
    CASE WHEN lost IS NOT NULL THEN 'Referential integrity failures: ' || lost END) END AS reasons,
    CASE WHEN table_name = 'Shippers' THEN 'failed' WHEN dup > 0 THEN dup || ' duplicate current PK rows' END AS error
  FROM broken b LEFT JOIN refs USING (table_name))""")

_CURRENT_DIMS = """
  cur_orders AS (SELECT * FROM h_orders WHERE is_current), cur_details AS (SELECT * FROM h_details WHERE is_current),
  cur_products AS (SELECT * FROM h_products WHERE is_current), cur_customers AS (SELECT * FROM h_customers WHERE is_current)"""
_FROM_BRONZE = "cur_details d LEFT JOIN cur_orders o USING (OrderID) LEFT JOIN cur_products p USING (ProductID) LEFT JOIN cur_customers c USING (CustomerID)"


_CURRENT_FACT = f"""
  SELECT o.ShipCountry, count(*) AS lines, CAST(sum(d.Quantity) AS BIGINT) AS quantity, CAST(sum({_LINE}) AS DOUBLE) AS line_total
  FROM (SELECT * FROM h_details WHERE is_current) d LEFT JOIN (SELECT * FROM h_orders WHERE is_current) o USING (OrderID) GROUP BY o.ShipCountry"""

_O = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


def _profile(columns: list[str]) -> str:
    exact = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(sum({'CAST(' + c + ' AS DECIMAL(28,6))' if c in exact else c}) AS DOUBLE) AS total, "
        f"CAST(min({c}) AS DOUBLE) AS smallest, CAST(max({c}) AS DOUBLE) AS largest FROM lineitem" for c in columns)


_DATED = """CASE o_orderkey % 6 WHEN 5 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END"""

_LINES_OF = "SELECT l_partkey, count(*) AS line_count FROM lineitem GROUP BY l_partkey"
_CARD_BY_PRODUCT = "SELECT ProductName, {value} FROM dim_products p"


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    answer_parts = ", ".join([_ANSWERS["growth"], _OPERATIONS, _BUYING, _SELLING, _SEASON, _PEAK, _LEADERS, _CUSTOMER, _DELIVERY])
    sql = {
        "s01_columnar_scan": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01'",
        "s01_full_scan": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
        "s02_json_tree": f"SELECT {_O} FROM orders",
        "s03_json_document": f"SELECT {_O} FROM orders",
        "s04_read_pages": f"SELECT {_O} FROM orders",
        "s06_resolve_source": "SELECT 'Orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'Order_Details', count(*) FROM lineitem",
        "s09_publish_from_itself": f"SELECT {_O}, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders WHERE o_orderstatus = 'F'",
        "s10_append_widening": "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS o_custkey FROM orders",
        "s11_append_by_rewrite": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey,
            CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'P')""",
        "p01_clean_names": 'SELECT c_custkey AS "Cust_ID", c_name AS a_b_c, c_nationkey AS nation, c_acctbal AS unnamed_column, c_mktsegment AS cust_id_2 FROM customer',
        "p02_nan_to_null": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price FROM orders",
        "p05_project_missing": "SELECT o_custkey AS o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_region FROM orders",
        "p06_align_types": "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
        "p08_cast_rules": _source("SELECT OrderID, ProductID, CASE WHEN OrderID % 9 <> 0 THEN Quantity END AS Quantity, UnitPrice, Discount FROM src_details"),
        "p09_trim_text": "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS priority FROM orders",
        "p11_parse_dates": f"SELECT o_orderkey, {_DATED} AS order_date, o_orderstatus AS status FROM orders",
        "p12_dates_as_text": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders",
        "p13_fill_text": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority ELSE 'Unknown' END AS priority, CAST(NULL AS VARCHAR) AS source_note FROM orders",
        "p16_row_hash": _source(f"SELECT OrderID, ProductID, {_hash(_HASHED['details'])} AS row_hash FROM src_details"),
        "p17_clean_chain": f"""
            WITH raw AS (SELECT o_orderkey, CAST(floor(o_orderkey / 2) AS BIGINT) AS order_id,
              CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
                WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 3 THEN strftime(o_orderdate, '%m/%d/%Y %H:%M:%S')
                WHEN 4 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE 'junk' END AS order_text, {_DATED} AS order_date,
              CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus END AS status FROM orders WHERE o_orderkey % 11 > 0),
            placed AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_text, status NULLS FIRST) AS place FROM raw)
            SELECT order_id, order_date, coalesce(status, 'Unknown') AS status, {_RUN} AS ingested_at FROM placed WHERE place = 1""",
        "d01_dedup": _source("SELECT * FROM src_details"),
        "f01_drop_null_keys": "SELECT o_orderkey AS id, o_custkey FROM orders WHERE o_orderkey % 3 > 0",
        "a02_numeric_profile": _profile(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
        "a03_null_counts": _source("SELECT column_name, null_count, round(CAST(null_count AS DOUBLE) / n * 100, 2) AS null_pct FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS n FROM src_orders" for c in _HASHED["orders"]) + ") WHERE null_count > 0"),
        "a04_duplicate_keys": "SELECT count(*) AS row_count, count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)) AS duplicates FROM lineitem",
        "a08_merge_counts": _merged(["orders"], """SELECT api_rows, excel_rows, unchanged_rows, changed_rows, new_rows, current_rows + historical_rows AS total_rows,
            current_rows, historical_rows FROM (""" + _MERGE_COUNTS.format(table="orders", sheet="Orders", name="orders") + ")"),
        "a09_counts_by_source": _merged(["orders"], "SELECT source_system, count(*) AS all_rows, count(*) FILTER (is_current) AS current_rows FROM h_orders GROUP BY source_system"),
        "a10_calendar_bounds": _dim("SELECT CAST(lo AS DATE) - 7 AS first_day, CAST(hi AS DATE) + 7 AS last_day FROM span"),
        "c01_land_sheets": _feed("""SELECT 'run-1' AS run_id, * FROM (
            SELECT 'Customers' AS table_name, (SELECT count(*) FROM new_customers) AS row_count, 12 AS column_count, 0 AS numeric_column_count, CAST(NULL AS VARCHAR) AS error
            UNION ALL SELECT 'Products', (SELECT count(*) FROM new_products), 11, 7, NULL UNION ALL SELECT 'Orders', (SELECT count(*) FROM new_orders), 15, 4, NULL
            UNION ALL SELECT 'Order_Details', (SELECT count(*) FROM new_details), 6, 5, NULL
            UNION ALL SELECT 'Returns', 0, 0, 0, 'Empty sheet' UNION ALL SELECT 'Budget', NULL, 0, 0, 'failed')"""),
        "c02_copy_log": """SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS pipeline_run_id, o_orderpriority AS table_name,
            CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status, '2026-02-01 00:00:00' AS run_timestamp FROM orders WHERE o_orderstatus IN ('F', 'O')""",
        "c03_validate_bronze": _feed("""SELECT 'run-1' AS run_id, '2026-02-01 00:00:00' AS run_timestamp, 'Order_Details' AS table_name, true AS has_api, true AS has_excel,
            'FAILED' AS status, 'API count mismatch: expected=2155, actual=' || n || CASE WHEN dup > 0 THEN '; ' || dup || ' duplicate API PK rows' ELSE '' END AS failure_reason,
            n AS api_count, CAST(2155 AS BIGINT) AS api_source_count, false AS api_count_match, e AS excel_count, e AS excel_source_count, true AS excel_count_match,
            dup AS api_pk_duplicates, CAST(0 AS BIGINT) AS excel_pk_duplicates, dup AS full_duplicate_count, 'OrderID,ProductID' AS inferred_pk,
            'OrderID,ProductID' AS required_columns, CAST(0 AS BIGINT) AS required_null_count,
            '{"API": {"OrderID":0,"ProductID":0,"Quantity":0,"UnitPrice":0,"Discount":0}, "Excel": {"OrderID":0,"ProductID":0,"Quantity":0,"UnitPrice":0,"Discount":0}}' AS null_counts_by_column,
            '{}' AS excel_source_aggs, 'not_compared' AS aggs_match, '{}' AS agg_diffs
            FROM (SELECT count(*) AS n, count(*) FILTER (place > 1) AS dup, (SELECT count(*) FROM new_details) AS e FROM raw_details)"""),
        "c04_validation_log": f"""WITH {_SOURCES}, {_FEEDS}, {_VALIDATION} SELECT table_name, has_api, has_excel, CASE WHEN found IS NULL THEN 'PASSED' ELSE 'FAILED' END AS status,
            coalesce(found, 'validation passed') AS failure_reason, api_count, CAST(api_source_count AS BIGINT) AS api_source_count, api_count = api_source_count AS api_count_match, excel_count,
            CAST(api_pk_duplicates AS BIGINT) AS api_pk_duplicates, CAST(0 AS BIGINT) AS excel_pk_duplicates, inferred_pk, CAST(0 AS BIGINT) AS required_null_count FROM judged""",
        "c04_validation_summary": f"""WITH {_SOURCES}, {_FEEDS}, {_VALIDATION} SELECT 'run-1' AS run_id, count(*) AS total_tables, count(*) FILTER (found IS NULL) AS passed_count,
            count(*) FILTER (found IS NOT NULL) AS failed_count, string_agg(table_name, ',' ORDER BY table_name) FILTER (found IS NULL) AS passed_tables,
            string_agg(table_name, ',' ORDER BY table_name) FILTER (found IS NOT NULL) AS failed_tables FROM judged""",
        "c05_page_diagnostic": """SELECT 'Orders' AS table_name, count(DISTINCT floor(page / 50)) AS files, count(*) AS objects, count(*) AS pages, min(n) AS min_page, max(n) AS max_page,
            CAST(sum(n) AS BIGINT) AS records, count(*) AS next_links, CAST(830 AS BIGINT) AS expected, CAST(830 - sum(n) AS BIGINT) AS missing,
            CASE WHEN sum(n) = 830 THEN 'COMPLETE' WHEN sum(n) < 830 THEN 'INCOMPLETE' ELSE 'MORE_THAN_EXPECTED' END AS verdict
            FROM (SELECT floor(o_orderkey / 20) AS page, count(*) AS n FROM orders GROUP BY 1)""",
        "c06_merge_customers": _merged(["customers"], "SELECT * FROM h_customers"),
        "c06_merge_order_details": _merged(["details"], "SELECT * FROM h_details"),
        "f02_historical_rows": _merged(["products"], "SELECT ProductID, UnitsInStock, effective_end, operation FROM h_products WHERE NOT is_current"),
        "f04_rows_of_one_source": _merged(["orders"], "SELECT OrderID, Freight, operation FROM h_orders WHERE is_current AND source_system = 'Excel'"),
        "c07_merge_run": _merged(["customers", "orders", "details"], " UNION ALL ".join(
            _MERGE_COUNTS.format(table=t, sheet=s, name=n) for n, t, s in _MERGED_NAMES if n != "products") +
            " UNION ALL SELECT 'silver_products', 'Products', 0, 0, 'FAILED', 'failed', NULL, NULL, NULL, NULL, NULL, NULL"),
        "c07_merge_summary": """SELECT '2026-02-01 00:00:00' AS run_timestamp, 'FAILED' AS overall_status, count(*) - 1 AS success_count, CAST(1 AS BIGINT) AS failed_count,
            CAST(0 AS BIGINT) AS skipped_count, count(*) AS total_tables_processed FROM (VALUES (1), (2), (3), (4))""",
        "c08_merge_diagnostic": _merged(["customers", "orders", "details"], " UNION ALL ".join(
            f"SELECT 'silver_{t}' AS table_name, true AS table_exists, count(*) AS rows, count(*) FILTER (is_current) AS current_rows, count(*) FILTER (NOT is_current) AS historical_rows, "
            f"'OK' AS status, CAST({e} AS BIGINT) AS expected, count(*) FILTER (source_system = 'API') AS baseline_rows FROM h_{n}"
            for (n, t, _), e in zip(_MERGED_NAMES, (91, 77, 830, 2155)) if n != "products") +
            " UNION ALL SELECT 'silver_products', false, 0, 0, 0, 'MISSING', 77, 0 UNION ALL SELECT 'bare', true, count(*), 0, 0, 'INVALID_SCHEMA', NULL, 0 FROM region"),
        "c09_primary_keys": """SELECT * FROM (VALUES ('Categories', 'CategoryID'), ('Customers', 'CustomerID'), ('Employees', 'EmployeeID'), ('Order_Details', 'OrderID,ProductID'),
            ('Orders', 'OrderID'), ('Products', 'ProductID'), ('Regions', 'RegionID'), ('Shippers', 'ShipperID'), ('Suppliers', 'SupplierID'), ('Territories', 'TerritoryID')) t(table_name, primary_key)""",
        "c10_silver_merged": _merged(["orders"], """SELECT OrderID, CustomerID, EmployeeID, CAST(OrderDate AS TIMESTAMP) AS OrderDate, CAST(RequiredDate AS TIMESTAMP) AS RequiredDate,
            CAST(ShippedDate AS TIMESTAMP) AS ShippedDate, ShipVia, Freight, coalesce(ShipName, 'Unknown') AS ShipName, coalesce(ShipAddress, 'Unknown') AS ShipAddress,
            coalesce(ShipCity, 'Unknown') AS ShipCity, ShipRegion, coalesce(ShipPostalCode, 'Unknown') AS ShipPostalCode, ShipCountry, source_system, effective_start, effective_end,
            is_current, created_at, modified_at, operation FROM h_orders"""),
        "c10_silver_api_only": f"""SELECT s_suppkey AS SupplierID, s_name AS CompanyName, {_RUN} AS ingested_at, 'API' AS source_system, {_RUN} AS effective_start,
            CAST(NULL AS TIMESTAMP) AS effective_end, true AS is_current, {_RUN} AS created_at, {_RUN} AS modified_at, 'I' AS operation,
            sha256(CAST(s_suppkey AS VARCHAR) || '||' || s_name) AS row_hash, 'run-1' AS _run_id FROM supplier""",
        "c11_quality": _silver("""SELECT table_name, primary_key, row_count, current_rows, historical_rows, historical_rows AS duplicate_pk_count, CAST(0 AS BIGINT) AS current_duplicate_pk_count,
            CASE WHEN table_name = 'Orders' THEN (SELECT '{"ShippedDate":{"null_count":' || count(*) FILTER (ShippedDate IS NULL) || ',"null_pct":' ||
              round(CAST(count(*) FILTER (ShippedDate IS NULL) AS DOUBLE) / count(*) * 100, 2) || '}}' FROM h_orders) ELSE '{}' END AS nulls,
            'PASSED' AS status, CAST(NULL AS VARCHAR) AS reason FROM silver_counts"""),
        "c12_foreign_keys": """SELECT * FROM (VALUES ('Orders', 'CustomerID', 'Customers', 'CustomerID'), ('Orders', 'EmployeeID', 'Employees', 'EmployeeID'),
            ('Products', 'SupplierID', 'Suppliers', 'SupplierID'), ('Products', 'CategoryID', 'Categories', 'CategoryID'), ('Territories', 'RegionID', 'Regions', 'RegionID'),
            ('Orders', 'ShipVia', 'Shippers', 'ShipperID'), ('Order_Details', 'OrderID', 'Orders', 'OrderID'), ('Order_Details', 'ProductID', 'Products', 'ProductID'))
            t(table_name, column_name, ref_table, ref_column)""",
        "c13_referential_integrity": _silver("SELECT * FROM orphan_counts"),
        "c14_gold_readiness": _ready("SELECT table_name, reasons = '' AS gold_ready, reasons FROM ready"),
        "c14_quality_log": _ready("SELECT 'run-1' AS run_id, '2026-02-01 00:00:00' AS run_timestamp, table_name, primary_key, reasons = '' AS gold_ready, reasons FROM ready"),
        "c15_provenance": _silver("SELECT table_name, all_api_rows, all_excel_rows, current_api_rows, current_excel_rows FROM silver_counts"),
        "c15_silver_summary": _ready("""SELECT 'silver_' || lower(table_name) AS "table", 'PASSED' AS status, row_count AS final_rows, current_rows, historical_rows, all_api_rows, all_excel_rows,
            current_api_rows, current_excel_rows, reasons = '' AS gold_ready, CAST(NULL AS VARCHAR) AS error FROM ready"""),
        "c15_run_outcome": _ready("""SELECT 'SUCCESS' AS overall_status, count(*) AS tables_discovered, count(*) AS total_succeeded, CAST(0 AS BIGINT) AS total_failed,
            count(*) FILTER (reasons <> '') AS tables_not_gold_ready FROM ready"""),
        "c16_dimcustomers": _dim("SELECT * FROM dim_customers"),
        "c16_dimemployees": _dim("SELECT EmployeeKey, EmployeeID, LastName, FirstName, " + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in (
            "Title", "TitleOfCourtesy", "BirthDate", "HireDate", "Address", "City", "Region", "PostalCode", "Country", "HomePhone", "Extension", "Photo", "Notes",
            "ReportsTo", "PhotoPath")) + ", FirstName || ' ' || LastName AS FullName FROM dim_employees"),
        "c16_dimsuppliers": _dim("SELECT SupplierKey, SupplierID, CompanyName, " + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in (
            "ContactName", "ContactTitle", "Address", "City", "Region", "PostalCode", "Country", "Phone", "Fax", "HomePage")) + " FROM dim_suppliers"),
        "c16_dimshippers": _dim("SELECT ShipperKey, ShipperID, CompanyName, CAST(NULL AS VARCHAR) AS Phone FROM dim_shippers"),
        "c16_dimregions": "SELECT row_number() OVER (ORDER BY r_regionkey) AS RegionKey, CAST(r_regionkey AS BIGINT) AS RegionID, r_name AS RegionDescription FROM region",
        "c16_dimterritories": """SELECT row_number() OVER (ORDER BY CAST(n_nationkey AS VARCHAR)) AS TerritoryKey, CAST(n_nationkey AS VARCHAR) AS TerritoryID,
            n_name AS TerritoryDescription, CAST(n_regionkey AS BIGINT) AS RegionID FROM nation""",
        "c17_dimcategories": _dim("SELECT CategoryKey, CategoryID, CategoryName, CAST(NULL AS VARCHAR) AS Description, CAST(NULL AS VARCHAR) AS Picture FROM dim_categories"),
        "c18_dimproducts": _dim("SELECT * FROM dim_products"),
        "c19_dimdate": _dim("SELECT * FROM dim_date"),
        "c20_sales_fact": _star("SELECT * FROM sales"),
        "c20_sales_of_current_versions": _merged(["orders", "details"], _CURRENT_FACT),
        "c21_sync_table": f"SELECT {_O}, 1 AS extra, 'REBUILT,REFILLED,REBUILT' AS actions, true AS kept_order FROM orders",
        "u04_column_and_row_difference": """
            WITH a AS (SELECT CAST(r_regionkey AS BIGINT) AS ShipperID, r_name AS CompanyName FROM region),
            b AS (SELECT * FROM a WHERE ShipperID > 0 UNION ALL SELECT CAST(n_nationkey AS BIGINT), n_name FROM nation)
            SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
        "x05_number_formats": f"""SELECT o_orderkey, {_whole('o_totalprice')} AS whole, '$' || {_whole('o_totalprice')} AS dollars, printf('%.1f', round(o_custkey / 8, 1)) AS one_digit,
            {_pct('o_custkey / 1000')} AS pct, {_pct('o_custkey / 1000', 1)} AS pct1 FROM orders""",
        "x11_week_of_year": "SELECT o_orderkey, CAST(ceil((dayofyear(o_orderdate) + dayofweek(date_trunc('year', o_orderdate))) / 7.0) AS INTEGER) AS week FROM orders",
        "t02_top_with_ties": f"SELECT l_partkey, line_count FROM (SELECT *, rank() OVER (ORDER BY line_count DESC) AS r FROM ({_LINES_OF})) WHERE r <= 10",
        "t02_bottom_with_ties": f"SELECT l_partkey, line_count FROM (SELECT *, rank() OVER (ORDER BY line_count) AS r FROM ({_LINES_OF})) WHERE r <= 10",
        "w01_number_orders": "SELECT row_number() OVER (ORDER BY o_orderkey) AS row_key, o_totalprice, o_orderkey FROM orders",
        "f03_category_range": _dim("SELECT CategoryID, count(*) AS products FROM dim_products WHERE CategoryID BETWEEN 1 AND 8 GROUP BY CategoryID"),
        "f05_year_list": _star(f'SELECT "Year", {_LT} AS line_total FROM s WHERE "Year" IN (1996, 1997, 1998, 2026) GROUP BY "Year"'),
        "f06_shared_filters": _star(f"""SELECT "Year", CategoryName, {_NET} AS total_sales, count(DISTINCT OrderID) AS total_orders, count(DISTINCT CustomerKey) AS active_customers
            FROM s WHERE {_SHARED} AND CategoryName IN ('Category 1', 'Category 4', 'Others') GROUP BY ALL"""),
        "f10_share_under_filters": _star(f"""SELECT CategoryName, {_NET} / (SELECT {_NET} FROM s WHERE {_SHARED}) AS category_share
            FROM s WHERE {_SHARED} AND CategoryName IN ('Category 1', 'Category 4', 'Others') GROUP BY CategoryName"""),
        "j10_sales_by_ship_year": _star(f'SELECT CAST(year(ShippedDate) AS INTEGER) AS "Year", {_NET} AS total_sales FROM s GROUP BY 1'),
        "j10_sales_by_required_year": _star(f'SELECT CAST(year(RequiredDate) AS INTEGER) AS "Year", {_NET} AS total_sales FROM s GROUP BY 1'),
        "m01_total_sales": _star(f'SELECT "Year", CategoryName, {_NET} AS total_sales FROM s GROUP BY ALL'),
        "m02_total_orders": _star("SELECT ShipCountry, count(DISTINCT OrderID) AS total_orders FROM s GROUP BY ShipCountry"),
        "m03_total_quantity": _star('SELECT "Year", CAST(sum(Quantity) AS BIGINT) AS total_quantity FROM s GROUP BY "Year"'),
        "m04_avg_order_value": _star(f"SELECT ContactTitle, {_AOV} AS avg_order_value FROM s GROUP BY ContactTitle"),
        "m05_total_customers": _dim("SELECT count(*) AS total_customers FROM dim_customers WHERE Region IN ('ASIA', 'EUROPE')"),
        "m05_all_customers": _dim("SELECT count(*) AS total_customers FROM dim_customers"),
        "m06_products_sold": _star('SELECT "Year", count(DISTINCT ProductID) AS products_sold FROM s GROUP BY "Year"'),
        "m07_total_freight": _star(f"SELECT Shipper AS CompanyName, {_FREIGHT} AS total_freight FROM s GROUP BY Shipper"),
        "m08_sales_last_year": _star("""SELECT "Year", "Month", CAST(sum(v) AS DOUBLE) AS sales_last_year
            FROM (SELECT DISTINCT "Year", "Month", CAST(FullDate - INTERVAL 1 YEAR AS DATE) AS day FROM dim_date) x LEFT JOIN daily USING (day)
            WHERE x.day IN (SELECT FullDate FROM dim_date) GROUP BY ALL""", _DAILY),
        "m08_by_category": _star("""SELECT "Year", CategoryName, CAST(sum(v) AS DOUBLE) AS sales_last_year
            FROM (SELECT DISTINCT "Year", CAST(FullDate - INTERVAL 1 YEAR AS DATE) AS day FROM dim_date)
            JOIN (SELECT OrderDate AS day, CategoryName, net AS v FROM s) USING (day) GROUP BY ALL"""),
        "m09_by_category": _star(f"""SELECT "Year", CategoryName, total_sales, sales_last_year, (coalesce(total_sales, 0) - sales_last_year) / sales_last_year AS sales_yoy
            FROM (SELECT "Year", CategoryName, {_NET} AS total_sales FROM s GROUP BY ALL) FULL JOIN
            (SELECT "Year", CategoryName, CAST(sum(v) AS DOUBLE) AS sales_last_year
             FROM (SELECT DISTINCT "Year", CAST(FullDate - INTERVAL 1 YEAR AS DATE) AS day FROM dim_date)
             JOIN (SELECT OrderDate AS day, CategoryName, net AS v FROM s) USING (day) GROUP BY ALL) USING ("Year", CategoryName)"""),
        "m09_total": _star(f"""SELECT total_sales, sales_last_year, (total_sales - sales_last_year) / sales_last_year AS sales_yoy
            FROM (SELECT {_NET} AS total_sales FROM s), (SELECT CAST(sum(net) AS DOUBLE) AS sales_last_year FROM s
             WHERE OrderDate IN (SELECT CAST(FullDate - INTERVAL 1 YEAR AS DATE) FROM dim_date))"""),
        "m10_by_country": _star("""SELECT "Year", "Month", ShipCountry, CAST(sum(v) AS DOUBLE) AS sales_ytd
            FROM (SELECT "Year", "Month", max(FullDate) AS last FROM dim_date GROUP BY ALL)
            JOIN (SELECT OrderDate AS day, ShipCountry, sum(net) AS v FROM s GROUP BY ALL) ON day <= last AND year(day) = year(last) GROUP BY ALL"""),
        "m10_by_category": _star("""SELECT CategoryName, CAST(sum(net) AS DOUBLE) AS sales_ytd
            FROM (SELECT max(FullDate) AS last FROM dim_date) JOIN s ON OrderDate <= last AND year(OrderDate) = year(last) GROUP BY ALL"""),
        "m09_sales_yoy": _star(f"""SELECT "Year", total_sales, sales_last_year, (coalesce(total_sales, 0) - sales_last_year) / sales_last_year AS sales_yoy
            FROM (SELECT "Year", {_NET} AS total_sales FROM s GROUP BY "Year") FULL JOIN
            (SELECT "Year", CAST(sum(v) AS DOUBLE) AS sales_last_year FROM (SELECT DISTINCT "Year", CAST(FullDate - INTERVAL 1 YEAR AS DATE) AS day FROM dim_date) JOIN daily USING (day) GROUP BY "Year")
            USING ("Year")""", _DAILY),
        "m10_sales_ytd": _star("""SELECT "Year", "Month", CAST(sum(v) AS DOUBLE) AS sales_ytd
            FROM (SELECT "Year", "Month", max(FullDate) AS last FROM dim_date GROUP BY ALL) LEFT JOIN daily ON day <= last AND year(day) = year(last) GROUP BY ALL""", _DAILY),
        "m11_best_year_sales": _star('SELECT ' + _largest('"Year"', "v") + " AS best_year_sales"),
        "m12_best_year": _star('SELECT CAST(' + _largest('"Year"', "label") + " AS VARCHAR) AS best_year"),
        "m13_top_category": _star("SELECT " + _largest("CategoryName", "label") + " AS top_category"),
        "m14_all_years": _star("SELECT " + _largest("CategoryName", "v") + " AS top_category_sales"),
        "m14_top_category_sales": _star("SELECT " + _largest("CategoryName", "v", '"Year" = 1997') + " AS top_category_sales"),
        "m15_peak_month": _star("SELECT " + _largest("MonthName", "label") + " AS peak_month"),
        "m16_peak_month_sales": _star("SELECT " + _largest("MonthName", "v") + " AS peak_month_sales"),
        "m17_top10_customers_sales": _star(f"SELECT sum(v) AS top10_customers_sales FROM ({_top('CustomerKey', 10)})".replace("CAST(v AS DOUBLE) AS v", "v").replace("sum(v) AS top10", "CAST(sum(v) AS DOUBLE) AS top10")),
        "m18_top10_share": _star(f"SELECT CAST(sum(v) AS DOUBLE) / (SELECT {_NET} FROM s WHERE CustomerRegion = 'ASIA') AS top10_share FROM ({_top('CustomerKey', 10)})".replace("CAST(v AS DOUBLE) AS v", "v")),
        "m19_active_customers": _star('SELECT "Year", count(DISTINCT CustomerKey) AS active_customers FROM s GROUP BY "Year"'),
        "m20_on_time_rate": _star(f"SELECT Shipper AS CompanyName, {_ON_TIME} AS on_time_rate FROM s GROUP BY Shipper"),
        "m21_unshipped_orders": _star("SELECT ShipCountry, count(DISTINCT CASE WHEN ShippedDate IS NULL THEN OrderID END) AS unshipped_orders FROM s GROUP BY ShipCountry"),
        "m22_avg_delivery_days": _star(_AVG_DELIVERY.format(by="FirstName,", group="GROUP BY FirstName")),
        "m23_needs_reorder": _dim("SELECT ProductName, CAST(sum(UnitsInStock) < sum(ReorderLevel) AS INTEGER) AS needs_reorder FROM dim_products GROUP BY ProductName"),
        "m23_needs_reorder_by_supplier": _dim("SELECT su.CompanyName, CAST(coalesce(sum(UnitsInStock), 0) < coalesce(sum(ReorderLevel), 0) AS INTEGER) AS needs_reorder FROM dim_products p LEFT JOIN dim_suppliers su ON p.SupplierKey = su.SupplierKey GROUP BY su.CompanyName"),
        "m33_selected_product_by_category": _dim("SELECT ca.CategoryName, CASE WHEN count(DISTINCT ProductName) = 1 THEN max(ProductName) ELSE 'Multiple Products' END AS selected_product FROM dim_products p LEFT JOIN dim_categories ca ON p.CategoryKey = ca.CategoryKey GROUP BY ca.CategoryName"),
        "m24_growth_recommendation": _star(f"SELECT *, {_GROWTH_TEXT} AS answer FROM growth", _ANSWERS["growth"]),
        "m25_operations_recommendation": _star(f"SELECT *, {_OPERATIONS_TEXT} AS answer FROM ops", _OPERATIONS),
        "m26_buying_recommendation": _star(f"SELECT *, {_BUYING_TEXT} AS answer FROM buying", _BUYING),
        "m27_selling_recommendation": _star(f"SELECT *, {_SELLING_TEXT} AS answer FROM selling", _SELLING),
        "m28_glance_recommendation": _star(f"""SELECT last_year, yoy, 'Overall performance is ' || CASE WHEN yoy >= 0 THEN 'up ' || {_pct('yoy')} ELSE 'down ' || {_pct('abs(yoy)')} END || ' year-over-year. ' ||
            CASE WHEN yoy >= 0 THEN 'Double down on this year''s top category and channel.' ELSE 'Investigate what drove the decline before setting next quarter''s budget.' END AS answer
            FROM (SELECT 1997 AS last_year, (a - b) / b AS yoy FROM (SELECT CAST(sum(LineTotal) FILTER ("Year" = 1997) AS DOUBLE) AS a, CAST(sum(LineTotal) FILTER ("Year" = 1996) AS DOUBLE) AS b FROM s))"""),
        "m29_seasonality_insight": _star(f"SELECT *, {_SEASON_TEXT} AS answer FROM season", _SEASON),
        "m30_seasonality_recommendation": _star(f"SELECT *, {_SEASON_ADVICE} AS answer FROM season", _SEASON),
        "m31_inventory_insight": _dim(f"SELECT low_stock, coalesce(CAST(nullif(low_stock, 0) AS VARCHAR), '') || ' product(s) are currently below their reorder level.' AS answer FROM ({_LOW})"),
        "m32_inventory_recommendation": _dim(f"""SELECT low_stock, CASE WHEN low_stock > 0 THEN 'Reorder now to avoid stockouts — check DimProducts for the exact list.'
            ELSE 'All products are stocked above threshold — no action needed.' END AS answer FROM ({_LOW})"""),
        "m33_selected_product": _dim("SELECT CategoryKey, SupplierKey, CASE WHEN count(DISTINCT ProductName) = 1 THEN max(ProductName) ELSE 'Multiple Products' END AS selected_product FROM dim_products GROUP BY ALL"),
        "m34_selected_category": _dim("SELECT p.CategoryID, CategoryName AS selected_category FROM (SELECT DISTINCT CategoryID, CategoryKey FROM dim_products) p JOIN dim_categories USING (CategoryKey)"),
        "m35_selected_supplier": _dim(_CARD_BY_PRODUCT.format(value="CompanyName AS selected_supplier") + " JOIN dim_suppliers USING (SupplierKey)"),
        "m36_selected_unit_price": _dim(_CARD_BY_PRODUCT.format(value="UnitPrice AS selected_unit_price")),
        "m37_selected_units_in_stock": _dim(_CARD_BY_PRODUCT.format(value="UnitsInStock AS selected_units_in_stock")),
        "m38_selected_reorder_level": _dim(_CARD_BY_PRODUCT.format(value="ReorderLevel AS selected_reorder_level")),
        "m39_product_quantity": _star("SELECT ProductName, CAST(sum(Quantity) AS BIGINT) AS total_quantity FROM s GROUP BY ProductName"),
        "m40_reorder_flag": _dim(_CARD_BY_PRODUCT.format(value="CASE WHEN UnitsInStock < ReorderLevel THEN '⚠ Reorder Needed' ELSE '✅ Stock OK' END AS reorder_flag")),
        "m41_category_share": _star(f"SELECT CategoryName, {_NET} / (SELECT {_NET} FROM s) AS category_share FROM s GROUP BY CategoryName"),
        "m42_category_rank": _star("SELECT CategoryName, CAST(rank() OVER (ORDER BY coalesce(sum(net), 0) DESC) AS INTEGER) AS category_rank FROM dim_categories LEFT JOIN s USING (CategoryName) GROUP BY CategoryName"),
        "m43_category_top_product": _star("""SELECT CategoryName, ProductName AS top_product FROM (SELECT CategoryName, ProductName,
            row_number() OVER (PARTITION BY CategoryName ORDER BY v DESC, ProductName DESC) AS r
            FROM (SELECT CategoryName, ProductName, sum(net) AS v FROM s GROUP BY ALL)) WHERE r = 1"""),
        "m44_total_sales_card": _star(_CARDS["total_sales"]),
        "m45_total_orders_card": _star(_CARDS["total_orders"]),
        "m46_active_customers_card": _star(_CARDS["active_customers"]),
        "m47_avg_order_value_card": _star(_CARDS["avg_order_value"]),
        "m48_reorder_rows": _dim(_REORDER),
        "m49_inventory_replenishment": _dim(_REORDER + " AND CategoryKey IN (SELECT CategoryKey FROM dim_categories WHERE CategoryName IN ('Category 1', 'Others'))"),
        "m50_glance_insight": _star(f"""SELECT total_sales, total_orders, '1997' AS "year", 'In 1997, the company generated $' || {_whole('total_sales')} || ' in revenue across ' || {_whole('total_orders')} || ' orders.' AS answer
            FROM (SELECT {_NET} AS total_sales, count(DISTINCT OrderID) AS total_orders FROM s WHERE "Year" = 1997)"""),
        "m51_growth_insight": _star(f"SELECT *, {_PEAK_TEXT} AS answer FROM peak_year", _PEAK),
        "m52_selling_insight": _star(f"SELECT *, {_LEADERS_TEXT} AS answer FROM leaders", _LEADERS),
        "m53_buying_insight": _star(f"SELECT *, {_CUSTOMER_TEXT} AS answer FROM customer_first", _CUSTOMER),
        "m54_operations_insight": _star(f"SELECT *, {_DELIVERY_TEXT} AS answer FROM delivery", _DELIVERY),
        "r01_totals": _star(f"SELECT {_NET} AS total_sales, CAST(sum(Quantity) AS BIGINT) AS total_quantity, {_FREIGHT} AS total_freight, {_AOV} AS avg_order_value FROM s"),
        "r02_totals_by_title": _star(f"SELECT ContactTitle, {_NET} AS total_sales, CAST(sum(Quantity) AS BIGINT) AS total_quantity, {_FREIGHT} AS total_freight, {_AOV} AS avg_order_value FROM s GROUP BY ContactTitle"),
        "r03_top_products": _star(f"SELECT label AS ProductName, v AS total_sales FROM ({_top('ProductName', 10)})"),
        "r04_sales_by_category": _star(f"SELECT CategoryName, {_NET} AS total_sales FROM s GROUP BY CategoryName"),
        "r05_best_of": _star("SELECT " + _largest('"Year"', "label") + " AS best_year, " + _largest('"Year"', "v") + " AS best_year_sales, " +
                             _largest("CategoryName", "label") + " AS top_category, " + _largest("MonthName", "label") + " AS peak_month"),
        "r06_top_customers": _star(f"SELECT label AS CompanyName, v AS total_sales FROM ({_top('Customer', 10)})"),
        "r07_sales_by_city": _star(f"SELECT City, {_NET} AS total_sales FROM s GROUP BY City"),
        "r08_customers_by_year": _star('SELECT "Year", count(DISTINCT CustomerKey) AS active_customers FROM s WHERE "Year" IN (1996, 1997, 1998, 2026) GROUP BY "Year"'),
        "r09_top_customer_share": _star(f"SELECT CAST(sum(v) AS DOUBLE) / (SELECT {_NET} FROM s) AS top10_share FROM ({_top('CustomerKey', 10)})".replace("CAST(v AS DOUBLE) AS v", "v")),
        "r10_average_freight": _star(f"SELECT {_FREIGHT} / count(Freight) AS avg_freight FROM s"),
        "r11_top_employees": _star(f"SELECT FirstName, LastName, {_LT} AS line_total FROM s WHERE FirstName IN (SELECT label FROM ({_top('FirstName', 5, column='LineTotal')})) GROUP BY ALL"),
        "r12_operations": _star(f"""SELECT {_ON_TIME} AS on_time_rate, count(DISTINCT CASE WHEN ShippedDate IS NULL THEN OrderID END) AS unshipped_orders,
            ({_AVG_DELIVERY.format(by='', group='')}) AS avg_delivery_days, (SELECT count(*) FROM nation) AS employees FROM s"""),
        "r13_reorder_table": _dim("SELECT ProductName, CompanyName, CAST(UnitsInStock AS BIGINT) AS units_in_stock, CAST(ReorderLevel AS BIGINT) AS reorder_level, needs_reorder FROM (" + _REORDER + ")"),
        "r14_customer_profile": _dim("SELECT CompanyName, ContactName, ContactTitle, City, Country, Phone FROM dim_customers WHERE CompanyName = 'Customer#000000007'"),
        "r14_customer_years": _star(f"""SELECT "Year", {_LT} AS line_total FROM s WHERE Customer = 'Customer#000000007' AND "Year" IN (1996, 1997, 1998, 2026) GROUP BY "Year" """),
        "r14_customer_lines": _star(f"""SELECT OrderDate, ShippedDate, count(OrderID) AS order_lines, count(ProductID) AS product_lines, CAST(sum(Quantity) AS BIGINT) AS quantity,
            CAST(sum(CAST(UnitPrice AS DECIMAL(18,4))) AS DOUBLE) AS unit_price, {_LT} AS line_total, CAST(sum(OnTimeFlag) AS BIGINT) AS on_time FROM s WHERE Customer = 'Customer#000000007' GROUP BY ALL"""),
        "r14_customer_products": _star("SELECT label AS ProductName, v AS total_sales FROM (" + _top("ProductName", 5, "Customer = 'Customer#000000007'") + ")"),
        "r15_category_tooltip": _star("""SELECT CategoryName, CAST(rank() OVER (ORDER BY sum(v) DESC) AS INTEGER) AS category_rank, arg_max(ProductName, (v, ProductName)) AS top_product
            FROM (SELECT CategoryName, ProductName, sum(net) AS v FROM s GROUP BY ALL) GROUP BY CategoryName"""),
        "r16_product_tooltip": _dim("""SELECT ProductName, ProductName AS selected_product, CategoryName AS selected_category, CompanyName AS selected_supplier,
            UnitPrice AS selected_unit_price, ReorderLevel AS selected_reorder_level FROM dim_products JOIN dim_categories USING (CategoryKey) JOIN dim_suppliers USING (SupplierKey)"""),
        "r17_insights_page": _star(" UNION ALL ".join(f"SELECT '{q}' AS question, {text} AS answer FROM {source}" for q, text, source in [
            ("growth_recommendation", _GROWTH_TEXT, "growth"), ("operations_recommendation", _OPERATIONS_TEXT, "ops"), ("buying_recommendation", _BUYING_TEXT, "buying"),
            ("selling_recommendation", _SELLING_TEXT, "selling"), ("seasonality_insight", _SEASON_TEXT, "season"), ("seasonality_recommendation", _SEASON_ADVICE, "season"),
            ("growth_insight", _PEAK_TEXT, "peak_year"), ("selling_insight", _LEADERS_TEXT, "leaders"), ("buying_insight", _CUSTOMER_TEXT, "customer_first"),
            ("operations_insight", _DELIVERY_TEXT, "delivery")]), answer_parts),
        "r18_growth_page": _star(" UNION ALL ".join(
            f"SELECT '{name}' AS card, CAST({value} AS DOUBLE) AS value, value_text, CAST({label} AS VARCHAR) AS label FROM ({_CARDS[name]})" for name, value, label in [
                ("total_sales", "line_total", "leading_category"), ("total_orders", "total_orders", "most_ordered_product"),
                ("active_customers", "active_customers", "peak_year"), ("avg_order_value", "avg_order_value", "top_country")])),
        "r19_filter_values": _star("""SELECT DISTINCT 'Year' AS "filter", CAST("Year" AS VARCHAR) AS choice FROM dim_date WHERE "Year" IN (1996, 1997, 1998, 2026)
            UNION ALL SELECT DISTINCT 'ShipCountry', ShipCountry FROM sales UNION ALL SELECT DISTINCT 'CategoryName', CategoryName FROM dim_categories
            UNION ALL SELECT DISTINCT 'FirstName', FirstName FROM dim_employees"""),
    }
    sql |= _whole_tables()
    return sql


def _whole_tables() -> dict[str, str]:
    """Whole-table forms, the other merges and Silver tables, and runs with failures."""
    details = {"OrderID": "bigint", "ProductID": "bigint", "Quantity": "bigint", "UnitPrice": "double", "Discount": "double"}
    feeds = {"API": "(SELECT * FROM raw_details)", "Excel": "new_details"}
    facts = []
    for feed, table in feeds.items():
        for c, kind in details.items():
            total = f"CAST(sum({'CAST(' + c + ' AS DECIMAL(28,6))' if kind == 'double' else c}) AS DOUBLE)"
            facts += [f"SELECT 'null_counts_by_column' AS field, '{feed}' AS feed, '{c}' AS name, CAST(count(*) - count({c}) AS DOUBLE) AS number, CAST(NULL AS VARCHAR) AS dtype FROM {table}",
                      f"SELECT 'dtypes', '{feed}', '{c}', NULL, '{kind}'"]
            facts += [f"SELECT 'combined_bronze_aggs', '{feed}', '{c}_{n}', {v}, NULL FROM {table}" for n, v in (
                ("sum", total), ("min", f"CAST(min({c}) AS DOUBLE)"), ("max", f"CAST(max({c}) AS DOUBLE)"))]
    found = {
        "s09_publish_whole": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders",
        "s11_append_every_status": """SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_custkey END AS o_custkey,
            CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS o_orderpriority FROM orders""",
        "c02_copy_log_appended": """SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS pipeline_run_id, o_orderpriority AS table_name,
            CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status, '2026-02-01 00:00:00' AS run_timestamp FROM orders""",
        "x17_json_details": _feed(" UNION ALL ".join(facts)),
        "c04_validation_fields": f"""WITH {_SOURCES}, {_FEEDS}, {_VALIDATION} SELECT 'run-1' AS run_id, '2026-02-01 00:00:00' AS run_timestamp, table_name,
            excel_count AS excel_source_count, CASE WHEN excel_count IS NOT NULL THEN true END AS excel_count_match,
            CAST(api_pk_duplicates AS BIGINT) AS full_duplicate_count, inferred_pk AS required_columns, '{{}}' AS excel_source_aggs,
            'not_compared' AS aggs_match, '{{}}' AS agg_diffs FROM judged""",
        "c06_merge_products": _merged(["products"], "SELECT * FROM h_products"),
        "c06_merge_orders": _merged(["orders"], "SELECT * FROM h_orders"),
        "d02_history_is_not_deduplicated": _merged(["orders"], "SELECT OrderID, is_current, operation FROM h_orders"),
        "u05_whole_row_distinct": "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem",
        "c09_wide_keys": """SELECT 'orders_in_parts' AS table_name, 'part0_id,part1_id,part2_id,rest_id' AS primary_key,
            (SELECT count(*) = count(DISTINCT o_orderkey) FROM orders) AS proven
            UNION ALL SELECT 'lines_without_key', 'a_id,b_id,c_id,d_id', (SELECT count(*) <= 24 FROM lineitem)""",
        "c14_quality_log_details": _ready("""SELECT 'run-1' AS run_id, '2026-02-01 00:00:00' AS run_timestamp, table_name, primary_key, reasons = '' AS gold_ready, reasons,
            '{"table_name":"' || table_name || '","primary_key":"' || primary_key || '","row_count":' || row_count || ',"current_rows":' || current_rows ||
            ',"historical_rows":' || historical_rows || ',"duplicate_pk_count":' || historical_rows || ',"current_duplicate_pk_count":0,"nulls":"' ||
            CASE WHEN table_name = 'Orders' THEN (SELECT '{\\"ShippedDate\\":{\\"null_count\\":' || count(*) FILTER (ShippedDate IS NULL) || ',\\"null_pct\\":' ||
              round(CAST(count(*) FILTER (ShippedDate IS NULL) AS DOUBLE) / count(*) * 100, 2) || '}}' FROM h_orders) ELSE '{}' END ||
            '","status":"PASSED"}' AS details_json FROM ready"""),
        "c14_readiness_of_a_broken_run": _BROKEN + " SELECT table_name, reasons = '' AS gold_ready, reasons FROM broken_ready",
        "c14_log_of_a_broken_run": _BROKEN + """ SELECT 'run-1' AS run_id, '2026-02-01 00:00:00' AS run_timestamp, table_name, primary_key,
            reasons = '' AS gold_ready, reasons FROM broken_ready""",
        "c15_summary_of_a_broken_run": _BROKEN + """ SELECT 'silver_' || lower(table_name) AS "table", CASE WHEN error IS NULL THEN 'PASSED' ELSE 'FAILED' END AS status,
            row_count AS final_rows, current_rows, historical_rows, all_api_rows, all_excel_rows, current_api_rows, current_excel_rows,
            reasons = '' AS gold_ready, error FROM broken_ready""",
        "c15_outcome_of_a_broken_run": _BROKEN + """ SELECT CASE WHEN count(error) > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS overall_status, count(*) AS tables_discovered,
            count(*) - count(error) AS total_succeeded, count(error) AS total_failed, count(*) FILTER (reasons <> '') AS tables_not_gold_ready FROM broken_ready""",
        "c22_report_from_bronze": _merged(list(_HASHED), f""", {_CURRENT_DIMS} SELECT CAST(year(CAST(o.OrderDate AS TIMESTAMP)) AS INTEGER) AS "Year",
            CASE WHEN p.ProductID IS NULL THEN NULL WHEN p.CategoryID BETWEEN 1 AND 8 THEN 'Category ' || p.CategoryID ELSE 'Others' END AS CategoryName,
            CAST(sum(CAST(d.Quantity * d.UnitPrice * (1 - d.Discount) AS DECIMAL(18,4))) AS DOUBLE) AS total_sales, CAST(sum({_LINE}) AS DOUBLE) AS line_total,
            count(DISTINCT o.OrderID) AS total_orders, count(DISTINCT c.CustomerID) AS active_customers, CAST(sum(d.Quantity) AS BIGINT) AS total_quantity
            FROM {_FROM_BRONZE} GROUP BY ALL"""),
        "c20_fact_from_bronze": _merged(list(_HASHED), f""", {_CURRENT_DIMS} SELECT o.ShipCountry, count(*) AS lines, CAST(sum(d.Quantity) AS BIGINT) AS quantity,
            CAST(sum({_LINE}) AS DOUBLE) AS line_total, count(c.CustomerID) AS customers, count(p.ProductID) AS products, count(o.EmployeeID) AS employees,
            count(o.ShipVia) AS shippers, count(o.OrderDate) AS dated FROM {_FROM_BRONZE} GROUP BY o.ShipCountry"""),
        "u04_difference_of_two_versions": f"""WITH a AS (SELECT {_O} FROM orders),
            b AS (SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM a WHERE o_orderkey % 7 > 0),
            c AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE o_orderkey % 9 = 0)
            SELECT *, 'left' AS side, count(*) AS copies FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM c) GROUP BY ALL
            UNION ALL SELECT *, 'right', count(*) FROM (SELECT * FROM c EXCEPT ALL SELECT * FROM a) GROUP BY ALL""",
        "m18_all_customers": _star(f"SELECT sum(v) / (SELECT {_NET} FROM s) AS top10_share FROM ({_top('CustomerKey', 10)})"),
        "m11_all_years": _star('SELECT ' + _largest('"Year"', "v") + " AS best_year_sales"),
        "m49_all_categories": _dim(_REORDER),
        "m50_all_years": _star(f"""SELECT total_sales, total_orders, 'All Years' AS "year", 'In All Years, the company generated $' || {_whole('total_sales')} || ' in revenue across ' || {_whole('total_orders')} || ' orders.' AS answer
            FROM (SELECT {_NET} AS total_sales, count(DISTINCT OrderID) AS total_orders FROM s)"""),
        "m28_all_years": _star(f"""SELECT last_year, yoy, 'Overall performance is ' || CASE WHEN coalesce(yoy, 0) >= 0 THEN 'up ' || coalesce({_pct('yoy')}, '') ELSE 'down ' || {_pct('abs(yoy)')} END || ' year-over-year. ' ||
            CASE WHEN coalesce(yoy, 0) >= 0 THEN 'Double down on this year''s top category and channel.' ELSE 'Investigate what drove the decline before setting next quarter''s budget.' END AS answer
            FROM (SELECT last_year, (coalesce((SELECT CAST(sum(LineTotal) AS DOUBLE) FROM s WHERE "Year" = last_year), 0) - b) / nullif(b, 0) AS yoy
                  FROM (SELECT last_year, (SELECT CAST(sum(LineTotal) AS DOUBLE) FROM s WHERE "Year" = last_year - 1) AS b
                        FROM (SELECT max("Year") AS last_year FROM dim_date)))"""),
        "c10_silver_categories": _api_only({"CategoryID": "id", "CategoryName": "'Category ' || CAST(id AS VARCHAR)"}, "(SELECT DISTINCT CAST(p_size % 10 + 1 AS BIGINT) AS id FROM part)"),
        "c10_silver_employees": _api_only({"EmployeeID": "CAST(n_nationkey AS BIGINT)", "LastName": "'R' || CAST(n_regionkey AS VARCHAR)", "FirstName": "n_name"}, "nation"),
        "c10_silver_regions": _api_only({"RegionID": "CAST(r_regionkey AS BIGINT)", "RegionDescription": "r_name"}, "region"),
        "c10_silver_shippers": _api_only({"ShipperID": "CAST(r_regionkey AS BIGINT)", "CompanyName": "r_name"}, "region"),
        "c10_silver_suppliers": _api_only({"SupplierID": "s_suppkey", "CompanyName": "s_name"}, "supplier"),
        "c10_silver_territories": _api_only({"TerritoryID": "CAST(n_nationkey AS VARCHAR)", "TerritoryDescription": "n_name", "RegionID": "CAST(n_regionkey AS BIGINT)"}, "nation"),
    }
    return found | {f"c10_silver_{t}": _refined(n) for n, t, _ in _MERGED_NAMES}
