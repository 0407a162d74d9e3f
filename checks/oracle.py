"""DuckDB counterpart of every registered query.

A query is written against named parts; ``_sql`` puts the parts it uses, and the parts those
use, in front as common table expressions. The parts work on plain line-level rows with no
pre-aggregation, so they check the Spark plans independently.
"""

from __future__ import annotations

import re

from checks.inputs import RAW, SALES, duckdb_text
from checks.queries import (
    BEST_SELLER,
    DIRTY_CONTACT,
    DIRTY_CUSTOMERS,
    DIRTY_LINES,
    DIRTY_ORDERS,
    DIRTY_PART,
)

FIRST, REPRICED, LATER = "DATE '1900-01-01'", "DATE '1998-07-01'", "DATE '1998-08-01'"
MIDDLE = "DATE '1997-03-01'"
CUT = "DATE '2000-01-01'"
AS_OF = "DATE '2001-08-02'"
MONEY_SUM = "DECIMAL(28,4)"


def initcap(text: str) -> str:
    word = "upper(w[1]) || lower(w[2:])"
    return f"array_to_string(list_transform(string_split({text}, ' '), lambda w: {word}), ' ')"


def key(*parts: str) -> str:
    return "sha256(" + " || '||' || ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"


def unscaled(amount: str, scale: int = 4) -> str:
    """The amount in units of its last decimal, as an integer."""
    # operands narrow enough for an exact decimal product; wider ones would turn into DOUBLE
    return f"CAST(CAST({amount} AS DECIMAL(28,{scale})) * CAST({10 ** scale} AS DECIMAL({scale + 1},0)) AS HUGEINT)"


def mean(total: str, n: str, scale: int = 4, factor: int = 1) -> str:
    """Exact factor * total / n for an integer n, rounded half up to four decimals; not for negative totals."""
    unit = 10 ** (scale - 4)
    return (
        f"CASE WHEN {n} > 0 THEN CAST(({unscaled(total, scale)} * {2 * factor} + {n} * {unit}) // (2 * {n} * {unit}) AS DECIMAL(22,0))"
        " * CAST(0.0001 AS DECIMAL(4,4)) END"
    )


def money(column: str) -> str:
    return f"CAST(sum({column}) AS {MONEY_SUM})"


REVENUE = (
    "(CAST(unit_price AS DECIMAL(20,4)) * CAST(order_qty AS DECIMAL(10,0)) * "
    "(1 - coalesce(CAST(unit_price_discount AS DECIMAL(4,2)), 0)))"
)
DATE_KEY = "CAST(strftime(order_date, '%Y%m%d') AS INTEGER)"
VERSION = "effective_date, expiry_date, is_current, version"


def first_version(source: str, surrogate: str, id_column: str, day: str) -> str:
    return f"""SELECT {key(id_column, day)} AS {surrogate}, *, {day} AS effective_date,
       CAST(NULL AS DATE) AS expiry_date, true AS is_current, CAST(1 AS SMALLINT) AS version FROM {source}"""


def merged(history: str, snapshot: str, surrogate: str, id_column: str, tracked: list[str], rest: list[str], day: str) -> str:
    """The next history, as separate statements for each kind of row."""
    changed = " OR ".join(
        f"coalesce(CAST(o.{c} AS VARCHAR), '') <> coalesce(CAST(n.{c} AS VARCHAR), '')" for c in tracked
    )
    plain = ", ".join(f"o.{c}" for c in [id_column, *tracked, *rest])
    fresh = ", ".join(f"n.{c}" for c in [id_column, *tracked, *rest])
    columns = ", ".join([id_column, *tracked, *rest])
    return f"""SELECT {surrogate}, {columns}, {VERSION} FROM {history} WHERE NOT is_current
 UNION ALL
 SELECT o.{surrogate}, {plain}, o.effective_date,
        CASE WHEN n.{id_column} IS NOT NULL AND ({changed}) THEN {day} END, n.{id_column} IS NULL OR NOT ({changed}), o.version
 FROM {history} o LEFT JOIN {snapshot} n ON o.{id_column} = n.{id_column}
 WHERE o.is_current AND NOT (n.{id_column} IS NOT NULL AND ({changed}) AND o.effective_date = {day})
 UNION ALL
 SELECT CASE WHEN o.effective_date = {day} THEN o.{surrogate} ELSE {key(f'n.{id_column}', day)} END, {fresh},
        {day}, CAST(NULL AS DATE), true, CAST(CASE WHEN o.effective_date = {day} THEN o.version ELSE o.version + 1 END AS SMALLINT)
 FROM {history} o JOIN {snapshot} n ON o.{id_column} = n.{id_column} WHERE o.is_current AND ({changed})
 UNION ALL
 SELECT {key(f'n.{id_column}', day)}, {fresh}, {day}, CAST(NULL AS DATE), true, CAST(1 AS SMALLINT)
 FROM {snapshot} n WHERE n.{id_column} NOT IN (SELECT {id_column} FROM {history} WHERE is_current)"""


def product_snapshot(source: str) -> str:
    return f"""SELECT product_id, coalesce(product_name, 'Unknown') AS product_name, coalesce(product_number, 'N/A') AS product_number,
       coalesce(color, 'Unknown') AS color, coalesce(size, 'Unknown') AS size, coalesce(standard_cost, 0) AS standard_cost,
       coalesce(list_price, 0) AS list_price, coalesce(category_name, 'Unknown') AS category_name,
       coalesce(subcategory_name, 'Unknown') AS subcategory_name FROM {source}"""


def customer_snapshot(source: str) -> str:
    return f"""SELECT customer_id, {initcap("coalesce(customer_name, 'Unknown')")} AS customer_name,
       coalesce(customer_type, 'Unknown') AS customer_type, coalesce(account_number, 'N/A') AS account_number FROM {source}"""


UNKNOWN_PRODUCT = """SELECT 'UNKNOWN' AS product_key, CAST(-1 AS BIGINT) AS product_id, 'Unknown / N/A' AS product_name, 'N/A' AS product_number,
       'Unknown' AS color, 'Unknown' AS size, CAST(0 AS DECIMAL(18,4)) AS standard_cost, CAST(0 AS DECIMAL(18,4)) AS list_price,
       'Unknown' AS category_name, 'Unknown' AS subcategory_name, DATE '2000-01-01' AS effective_date, CAST(NULL AS DATE) AS expiry_date,
       true AS is_current, CAST(1 AS SMALLINT) AS version"""
UNKNOWN_CUSTOMER = """SELECT 'UNKNOWN' AS customer_key, CAST(-1 AS BIGINT) AS customer_id, 'Unknown / N/A' AS customer_name, 'Unknown' AS customer_type,
       'N/A' AS account_number, DATE '2000-01-01' AS effective_date, CAST(NULL AS DATE) AS expiry_date, true AS is_current, CAST(1 AS SMALLINT) AS version"""

PRODUCT_REST = ["product_name", "product_number", "color", "size", "category_name", "subcategory_name"]
PRICES = ["standard_cost", "list_price"]
PRODUCT_MERGE = dict(surrogate="product_key", id_column="product_id", tracked=PRICES, rest=PRODUCT_REST)
CUSTOMER_MERGE = dict(
    surrogate="customer_key", id_column="customer_id", tracked=["customer_name", "customer_type"], rest=["account_number"]
)


def trimmed(column: str) -> str:
    return f"CASE WHEN length(trim({column})) > 0 THEN trim({column}) END"


def daily_facts(prefix: str, header: str, detail: str = "order_detail") -> dict[str, str]:
    """The three day-grain facts over a header part, straight from the lines."""
    lines = f"(SELECT h.order_date, h.customer_id, h.sales_person_id, d.* FROM {header} h JOIN {detail} d ON h.order_id = d.order_id)"
    return {
        f"{prefix}order_daily": f"""SELECT {key(DATE_KEY)} AS fact_order_daily_key, {DATE_KEY} AS date_key,
       count(DISTINCT order_id) AS daily_order_count, count(DISTINCT customer_id) AS daily_customer_count,
       CAST(sum(order_qty) AS BIGINT) AS daily_quantity, {money(REVENUE)} AS daily_revenue,
       {mean(f'sum({REVENUE})', f'count({REVENUE})', 6)} AS average_order_value,
       {mean(f'sum({REVENUE})', 'count(DISTINCT order_id)', 6)} AS avg_order_total
 FROM {lines} l GROUP BY order_date""",
        f"{prefix}product_daily": f"""SELECT {key('date_key', 'product_key')} AS fact_product_daily_key, * FROM (
 SELECT {DATE_KEY} AS date_key, coalesce(p.product_key, 'UNKNOWN') AS product_key, CAST(sum(order_qty) AS BIGINT) AS quantity_sold,
       {money('line_total')} AS revenue,
       CAST(sum((unit_price - coalesce(p.standard_cost, 0)) * CAST(order_qty AS DECIMAL(10,0))) AS {MONEY_SUM}) AS gross_profit,
       count(DISTINCT order_id) AS order_count,
       {mean('sum(p.standard_cost)', 'count(p.standard_cost)')} AS avg_standard_cost,
       {mean('sum(p.list_price)', 'count(p.list_price)')} AS avg_list_price
 FROM {lines} l LEFT JOIN dim_product p ON l.product_id = p.product_id AND order_date >= p.effective_date
      AND (p.expiry_date IS NULL OR order_date < p.expiry_date)
 GROUP BY order_date, coalesce(p.product_key, 'UNKNOWN')) f""",
        f"{prefix}seller_daily": f"""SELECT {key('date_key', 'seller_key')} AS fact_seller_daily_key, * FROM (
 SELECT {DATE_KEY} AS date_key, coalesce(s.seller_key, 'UNKNOWN') AS seller_key, count(DISTINCT order_id) AS order_count,
       count(DISTINCT customer_id) AS customer_count, CAST(sum(order_qty) AS BIGINT) AS quantity_sold, {money(REVENUE)} AS revenue,
       {money(f"CAST({REVENUE} AS DECIMAL(24,6)) * coalesce(CAST(s.commission_pct AS DECIMAL(5,2)), 0) * CAST(0.01 AS DECIMAL(2,2))")} AS commission_earned
 FROM {lines} l LEFT JOIN (SELECT * FROM dim_seller WHERE is_current) s ON l.sales_person_id = s.seller_id
 GROUP BY order_date, coalesce(s.seller_key, 'UNKNOWN')) f""",
    }


# ---------------------------------------------------------------- parts

PARTS: dict[str, str] = {name: duckdb_text(text).strip() for name, text in (SALES | RAW).items()}
PARTS |= {
    "snap_product_1": product_snapshot("product_v1"),
    "snap_product_2": product_snapshot("product_v2"),
    "snap_customer_1": customer_snapshot("customer_v1"),
    "snap_customer_2": customer_snapshot("customer_v2"),
    "product_first": f"{first_version('snap_product_1', 'product_key', 'product_id', FIRST)} UNION ALL BY NAME {UNKNOWN_PRODUCT}",
    "customer_first": f"{first_version('snap_customer_1', 'customer_key', 'customer_id', FIRST)} UNION ALL BY NAME {UNKNOWN_CUSTOMER}",
    "dim_product": merged("product_first", "snap_product_2", day=REPRICED, **PRODUCT_MERGE),
    "dim_customer": merged("customer_first", "snap_customer_2", day=REPRICED, **CUSTOMER_MERGE),
    "dim_seller": f"""SELECT {key('seller_id', FIRST)} AS seller_key, seller_id, {initcap('full_name')} AS seller_name,
       CAST(commission_pct * 100 AS DECIMAL(5,2)) AS commission_pct, coalesce(sales_quota, 0) AS sales_quota, bonus,
       CAST(0 AS DECIMAL(18,4)) AS sales_ytd, CAST(0 AS DECIMAL(18,4)) AS sales_last_year,
       {FIRST} AS effective_date, CAST(NULL AS DATE) AS expiry_date, true AS is_current, CAST(1 AS SMALLINT) AS version FROM seller
 UNION ALL SELECT 'UNKNOWN', -1, 'Unknown / N/A', 0, 0, 0, 0, 0, DATE '2000-01-01', NULL, true, 1""",
    "dim_geography": f"""SELECT {key('address_id')} AS geography_key, address_id, address_line1, coalesce(address_line2, '') AS address_line2,
       city, state_name, country_name, territory_name, territory_group, coalesce(postal_code, 'Unknown') AS postal_code FROM geography
 UNION ALL SELECT 'UNKNOWN', -1, 'Unknown', '', 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown'""",
    "vendors": f"""SELECT {key('vendor_id')} AS vendor_key, vendor_id, account_number, name AS vendor_name, credit_rating,
       CASE WHEN preferred_vendor_status THEN 'Yes' ELSE 'No' END AS preferred_vendor,
       CASE WHEN coalesce(active_flag, false) THEN 'Active' ELSE 'Inactive' END AS vendor_status FROM vendor""",
    "dim_vendor": "SELECT * FROM vendors UNION ALL SELECT 'UNKNOWN', -1, 'N/A', 'Unknown / N/A', 0, 'No', 'Inactive'",
    "calendar": f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, day(d) AS day, dayname(d) AS day_name,
       dayofweek(d) + 1 AS day_of_week, week(d) AS week, month(d) AS month, monthname(d) AS month_name, quarter(d) AS quarter,
       year(d) AS year, dayofweek(d) IN (0, 6) AS is_weekend
 FROM (SELECT unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS d FROM order_header) days""",
    "order_lines": f"""SELECT {key('d.order_detail_id')} AS fact_order_key, h.order_id, {DATE_KEY} AS date_key,
       coalesce(c.customer_key, 'UNKNOWN') AS customer_key, coalesce(p.product_key, 'UNKNOWN') AS product_key,
       coalesce(s.seller_key, 'UNKNOWN') AS seller_key, coalesce(g.geography_key, 'UNKNOWN') AS geography_key,
       h.sales_channel, d.order_qty, d.unit_price, d.unit_price_discount, d.line_total,
       h.sub_total, h.tax_amt, h.freight_amt, h.total_due
 FROM order_header h JOIN order_detail d ON h.order_id = d.order_id
 LEFT JOIN (SELECT * FROM dim_customer WHERE is_current) c ON h.customer_id = c.customer_id
 LEFT JOIN (SELECT * FROM dim_seller WHERE is_current) s ON h.sales_person_id = s.seller_id
 JOIN order_address a ON h.order_id = a.order_id LEFT JOIN dim_geography g ON a.address_id = g.address_id
 LEFT JOIN dim_product p ON d.product_id = p.product_id AND h.order_date >= p.effective_date
      AND (p.expiry_date IS NULL OR h.order_date < p.expiry_date)""",
    "inventory_now": """SELECT sha256(CAST(i.product_id AS VARCHAR) || '||' || CAST(location_id AS VARCHAR)) AS fact_inventory_key,
       coalesce(product_key, 'UNKNOWN') AS product_key, location_id, quantity, shelf, bin
 FROM inventory i LEFT JOIN (SELECT * FROM dim_product WHERE is_current) p ON i.product_id = p.product_id""",
    "behavior": f"""SELECT sha256(who) AS fact_customer_behavior_key, customer_key, total_orders, total_quantity, total_amount, avg_order_value,
       avg_order_total, first_purchase, last_purchase, CAST(date_diff('day', last_purchase, {AS_OF}) AS INTEGER) AS recency_days,
       CASE WHEN total_amount >= 10000 AND total_orders >= 10 THEN 'VIP' WHEN total_orders >= 5 THEN 'Loyal'
            WHEN date_diff('day', last_purchase, {AS_OF}) > 365 THEN 'Lost' ELSE 'Regular' END AS customer_segment
 FROM (SELECT coalesce(CASE WHEN c.customer_key IS NOT NULL THEN CAST(c.customer_id AS VARCHAR) END, 'UNKNOWN') AS who,
              coalesce(c.customer_key, 'UNKNOWN') AS customer_key, count(DISTINCT h.order_id) AS total_orders,
              CAST(sum(order_qty) AS BIGINT) AS total_quantity, {money('line_total')} AS total_amount,
              {mean('sum(line_total)', 'count(line_total)')} AS avg_order_value,
              {mean('sum(line_total)', 'count(DISTINCT h.order_id)')} AS avg_order_total,
              min(order_date) AS first_purchase, max(order_date) AS last_purchase
       FROM order_header h JOIN order_detail d ON h.order_id = d.order_id
       LEFT JOIN (SELECT * FROM dim_customer WHERE is_current) c ON h.customer_id = c.customer_id GROUP BY ALL) b""",
    "due": "SELECT DISTINCT order_id, customer_key, seller_key, geography_key, total_due FROM order_lines",
    "stock_sales": """SELECT p.product_id, p.product_name, CAST(coalesce(i.stock, 0) AS BIGINT) AS stock, CAST(coalesce(s.sold, 0) AS BIGINT) AS sold
 FROM dim_product p
 LEFT JOIN (SELECT product_id, sum(quantity) AS stock FROM inventory_now f JOIN dim_product v ON f.product_key = v.product_key GROUP BY 1) i
   ON p.product_id = i.product_id
 LEFT JOIN (SELECT product_id, sum(quantity_sold) AS sold FROM product_daily f JOIN dim_product v ON f.product_key = v.product_key GROUP BY 1) s
   ON p.product_id = s.product_id
 WHERE p.is_current AND p.product_id <> -1""",
}
PARTS |= daily_facts("", "order_header")
PARTS |= {
    "dirty_part": duckdb_text(DIRTY_PART).strip(),
    "dirty_contact": duckdb_text(DIRTY_CONTACT).strip(),
    "dirty_lines": duckdb_text(DIRTY_LINES).strip(),
    "dirty_orders": duckdb_text(DIRTY_ORDERS).strip(),
    "dirty_customers": duckdb_text(DIRTY_CUSTOMERS).strip(),
    "people": f"""SELECT BusinessEntityID, concat_ws(' ', {trimmed('FirstName')}, {trimmed('MiddleName')}, {trimmed('LastName')}) AS full_name
 FROM person_person""",
}


def _sql(body: str) -> str:
    """``body`` with every part it needs in front, in order of use."""
    needed: list[str] = []

    def need(text: str) -> None:
        for word in re.findall(r"[a-z_0-9]+", text):
            if word in PARTS and word not in needed and not _is_column(word, text):
                need(PARTS[word])
                if word not in needed:
                    needed.append(word)

    need(body)
    parts = ",\n".join(f"{name} AS (\n{PARTS[name]}\n)" for name in needed)
    return f"WITH {parts}\n{body}" if needed else body


def _is_column(word: str, text: str) -> bool:
    """A part counts only where it is read from."""
    return not re.search(rf"(FROM|JOIN)\s+{word}\b", text)


# ---------------------------------------------------------------- queries

BODIES: dict[str, str] = {
    "scan_parquet_lineitem": "SELECT * FROM order_detail",
    "ingest_batch_report": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'success' AS status, count(*) AS row_count FROM {t}"
        for t in ["region", "nation", "supplier", "customer", "part", "orders", "lineitem"]
    )
    + " UNION ALL SELECT 'no_such_table', 'failed', 0",
    "parquet_version_roundtrip": "SELECT * FROM dim_product",
    "parquet_append": "SELECT n_name AS name FROM nation UNION ALL SELECT s_name FROM supplier",
    "schema_evolution_add_columns": f"""SELECT {key('s_suppkey')} AS seller_key, s_suppkey AS seller_id, s_name AS seller_name,
       CAST(NULL AS DECIMAL(5,2)) AS commission_pct, CAST(NULL AS DECIMAL(18,4)) AS sales_quota, CAST(NULL AS DECIMAL(18,4)) AS bonus,
       CAST(NULL AS DECIMAL(18,4)) AS sales_ytd, CAST(NULL AS DECIMAL(18,4)) AS sales_last_year, {FIRST} AS effective_date,
       CAST(NULL AS DATE) AS expiry_date, true AS is_current, CAST(1 AS SMALLINT) AS version FROM supplier""",
    "run_sql_by_name": f"""SELECT sales_channel, count(*) AS n_lines, {money('line_total')} AS revenue FROM order_lines
 WHERE date_key >= 19980101 GROUP BY sales_channel""",
    "clean_strings": f"SELECT id, {trimmed('name')} AS name, {trimmed('brand')} AS brand, size FROM dirty_part",
    "clean_blank_to_null": """SELECT id, name, CASE WHEN length(trim(brand)) > 0 THEN brand END AS brand, size FROM dirty_part""",
    "clean_lower_case": f"SELECT id, lower({trimmed('name')}) AS name, lower({trimmed('brand')}) AS brand, size FROM dirty_part",
    "clean_email_phone": """SELECT id, lower(work_email) AS work_email, name, regexp_replace("Phone", '[^0-9]', '', 'g') AS "Phone", phone_type_id
 FROM dirty_contact""",
    "clean_title_case": f"SELECT p_partkey, {initcap('upper(p_name)')} AS p_name FROM part",
    "clean_keys_dedupe": """SELECT order_id, line, part, supplier, flag, price FROM (
 SELECT *, row_number() OVER (PARTITION BY order_id, line ORDER BY part, supplier, flag, price) AS n FROM dirty_lines
 WHERE order_id IS NOT NULL AND line IS NOT NULL) l WHERE n = 1""",
    "clean_casts": """SELECT id, TRY_CAST(amount AS DECIMAL(7,2)) AS amount, TRY_CAST(qty AS INTEGER) AS qty, TRY_CAST(day AS DATE) AS day,
       TRY_CAST(moment AS TIMESTAMP) AS moment FROM dirty_orders""",
    "clean_positive": """SELECT * FROM (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,4)) AS balance,
       CASE WHEN c_nationkey <> 3 THEN c_nationkey - 1 END AS level FROM customer) c
 WHERE (balance IS NULL OR balance >= 0) AND (level IS NULL OR level >= 0)""",
    "clean_fill": """SELECT c_custkey, CASE WHEN c_nationkey > 3 THEN c_name ELSE 'Unknown' END AS name,
       CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(18,4)) ELSE 0 END AS balance,
       CASE WHEN c_nationkey > 9 THEN c_acctbal > 0 ELSE false END AS active FROM customer""",
    "generic_clean_audit": f"""SELECT id, {trimmed('name')} AS name, lower({trimmed('email_address')}) AS email_address,
       regexp_replace({trimmed('phone')}, '[^0-9]', '', 'g') AS phone, balance, 'silver' AS _layer FROM dirty_customers WHERE id IS NOT NULL""",
    "silver_customer": f"""SELECT CustomerID AS customer_id, coalesce(full_name, {trimmed('s.Name')}) AS customer_name,
       CASE WHEN StoreID IS NOT NULL THEN 'Store' ELSE 'Individual' END AS customer_type, {trimmed('AccountNumber')} AS account_number
 FROM sales_customer c LEFT JOIN people p ON c.PersonID = p.BusinessEntityID LEFT JOIN sales_store s ON c.StoreID = s.BusinessEntityID""",
    "silver_product": f"""SELECT ProductID AS product_id, {initcap(f"{trimmed('p.Name')}")} AS product_name, ProductNumber AS product_number,
       {initcap(f"coalesce({trimmed('Color')}, 'Unknown')")} AS color, coalesce(Size, 'Unknown') AS size,
       CAST(StandardCost AS DECIMAL(18,4)) AS standard_cost, CAST(ListPrice AS DECIMAL(18,4)) AS list_price,
       trim(c.Name) AS category_name, s.Name AS subcategory_name
 FROM production_product p LEFT JOIN (SELECT DISTINCT * FROM production_productsubcategory) s ON p.ProductSubcategoryID = s.ProductSubcategoryID
 LEFT JOIN production_productcategory c ON s.ProductCategoryID = c.ProductCategoryID
 WHERE CAST(StandardCost AS DECIMAL(18,4)) >= 0 AND ListPrice >= 0""",
    "silver_geography": f"""SELECT AddressID AS address_id, trim(AddressLine1) AS address_line1, {trimmed('AddressLine2')} AS address_line2,
       {initcap('trim(City)')} AS city, s.Name AS state_name, trim(c.Name) AS country_name, t.Name AS territory_name,
       t."Group" AS territory_group, PostalCode AS postal_code
 FROM person_address a LEFT JOIN person_stateprovince s ON a.StateProvinceID = s.StateProvinceID
 LEFT JOIN person_countryregion c ON s.CountryRegionCode = c.CountryRegionCode
 LEFT JOIN sales_salesterritory t ON s.TerritoryID = t.TerritoryID""",
    "silver_sales_header": """SELECT SalesOrderID AS order_id, CustomerID AS customer_id, SalesPersonID AS sales_person_id, TerritoryID AS territory_id,
       ShipToAddressID AS address_id, CAST(OrderDate AS DATE) AS order_date, CAST(DueDate AS DATE) AS due_date, CAST(ShipDate AS DATE) AS ship_date,
       Status AS status, CASE WHEN OnlineOrderFlag THEN 'Online' ELSE 'Offline' END AS sales_channel,
       CAST(SubTotal AS DECIMAL(18,4)) AS sub_total, CAST(TaxAmt AS DECIMAL(18,4)) AS tax_amt, CAST(Freight AS DECIMAL(18,4)) AS freight_amt,
       CAST(TotalDue AS DECIMAL(18,4)) AS total_due FROM sales_salesorderheader
 WHERE SubTotal >= 0 AND TaxAmt >= 0 AND (Freight IS NULL OR Freight >= 0) AND TotalDue >= 0""",
    "silver_sales_detail": """SELECT SalesOrderID AS order_id, SalesOrderDetailID AS order_detail_id, ProductID AS product_id, OrderQty AS order_qty,
       CAST(UnitPrice AS DECIMAL(18,4)) AS unit_price, CAST(UnitPriceDiscount AS DECIMAL(18,4)) AS unit_price_discount,
       CAST(LineTotal AS DECIMAL(18,4)) AS line_total
 FROM (SELECT *, row_number() OVER (PARTITION BY SalesOrderDetailID ORDER BY SalesOrderID, ProductID, OrderQty, UnitPrice, UnitPriceDiscount, LineTotal) AS n
       FROM sales_salesorderdetail) d
 WHERE n = 1 AND OrderQty >= 0 AND UnitPrice >= 0 AND LineTotal >= 0""",
    "silver_vendor": f"""SELECT BusinessEntityID AS vendor_id, trim(AccountNumber) AS account_number, {initcap('Name')} AS name, CreditRating AS credit_rating,
       PreferredVendorStatus AS preferred_vendor_status, ActiveFlag AS active_flag FROM purchasing_vendor""",
    "silver_seller": """SELECT s.BusinessEntityID AS seller_id, full_name, SalesQuota AS sales_quota, Bonus AS bonus, CommissionPct AS commission_pct,
       SalesYTD AS sales_ytd, SalesLastYear AS sales_last_year
 FROM sales_salesperson s LEFT JOIN people p ON s.BusinessEntityID = p.BusinessEntityID""",
    "silver_inventory": """SELECT ProductID AS product_id, LocationID AS location_id, trim(Shelf) AS shelf, Bin AS bin, Quantity AS quantity
 FROM production_productinventory WHERE ProductID IS NOT NULL AND Quantity >= 0""",
    "dim_date": "SELECT * FROM calendar",
    "dim_product": "SELECT * FROM product_first",
    "dim_customer": "SELECT * FROM customer_first",
    "dim_seller": "SELECT * FROM dim_seller",
    "dim_geography": "SELECT * FROM dim_geography",
    "dim_vendor": "SELECT * FROM dim_vendor",
    "dim_vendor_positions": """SELECT CAST(row_number() OVER (ORDER BY vendor_id) AS INTEGER) AS vendor_key, vendor_id, account_number, vendor_name,
       credit_rating, preferred_vendor, vendor_status FROM vendors""",
    "upsert_scd1": """SELECT s_suppkey, s_name, CAST(CAST(s_acctbal AS DECIMAL(18,4)) + CASE WHEN s_acctbal < 5000 THEN 1 ELSE 0 END AS DECIMAL(18,4)) AS s_acctbal
 FROM supplier UNION ALL SELECT -s_suppkey - 1, NULL, NULL FROM supplier WHERE s_nationkey = 3""",
    "unknown_member_insert": "SELECT * FROM dim_vendor",
    "scd2_first_load": first_version("snap_product_1", "product_key", "product_id", REPRICED) + f" UNION ALL BY NAME {UNKNOWN_PRODUCT}",
    "scd2_second_load": "SELECT * FROM dim_product",
    "scd2_out_of_order": f"""SELECT * FROM (WITH seen AS (
   SELECT {FIRST} AS day, * FROM product_v1
   UNION ALL SELECT {MIDDLE}, * REPLACE (CAST(CASE WHEN category_name = 'PROMO' THEN list_price + 1 ELSE list_price END AS DECIMAL(18,4)) AS list_price)
   FROM product_v1 WHERE size <> '49'
   UNION ALL SELECT {REPRICED}, * FROM product_v2),
 grid AS (SELECT i.product_id AS id, d.day AS on_day, s.* FROM (SELECT DISTINCT product_id FROM seen) i CROSS JOIN (SELECT DISTINCT day FROM seen) d
   LEFT JOIN seen s ON s.product_id = i.product_id AND s.day = d.day),
 told AS (SELECT *, CASE WHEN product_id IS NOT NULL THEN concat_ws('|', {', '.join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in [*PRICES, *PRODUCT_REST])}) END AS state FROM grid),
 marked AS (SELECT *, lag(state) OVER w AS before, row_number() OVER w AS rn FROM told WINDOW w AS (PARTITION BY id ORDER BY on_day)),
 ended AS (SELECT *, lead(on_day) OVER (PARTITION BY id ORDER BY on_day) AS until FROM marked WHERE rn = 1 OR state IS DISTINCT FROM before)
 SELECT {key('product_id', 'on_day')} AS product_key, product_id, {', '.join([*PRICES, *PRODUCT_REST])}, on_day AS effective_date, until AS expiry_date,
        until IS NULL AS is_current, CAST(row_number() OVER (PARTITION BY product_id ORDER BY on_day) AS SMALLINT) AS version
 FROM ended WHERE product_id IS NOT NULL) h""",
    "scd2_noop": merged("dim_product", "snap_product_2", day=LATER, **PRODUCT_MERGE),
    "scd2_same_day": merged("dim_product", "snap_product_1", day=REPRICED, **PRODUCT_MERGE),
    "scd2_change_hash": """SELECT customer_id, sha256(coalesce(customer_name, '') || '||' || coalesce(customer_type, '')) AS change_hash
 FROM customer_v2""",
    "duplicate_line_keys": "SELECT order_id, line, count(*) AS n FROM dirty_lines GROUP BY ALL HAVING count(*) > 1",
    "overlapping_price_versions": f"SELECT product_id, {FIRST} AS effective_date, {REPRICED} AS next_effective_date FROM product_v2",
    "scd2_customer_history": "SELECT * FROM dim_customer",
    "scd2_overwrite_untracked": f"""SELECT d.customer_key, d.customer_id, d.customer_name, d.customer_type,
       coalesce(CASE WHEN d.is_current THEN n.account_number END, d.account_number) AS account_number, {VERSION}
 FROM dim_customer d LEFT JOIN snap_customer_2 n ON d.customer_id = n.customer_id""",
    "scd2_address_change": f"""SELECT {key('c_custkey', FIRST)} AS customer_key, c_custkey AS customer_id, c_name AS customer_name,
       'nation ' || CAST(c_nationkey AS VARCHAR) AS address, {FIRST} AS effective_date,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN {REPRICED} END AS expiry_date, c_mktsegment <> 'HOUSEHOLD' AS is_current, CAST(1 AS SMALLINT) AS version
 FROM customer UNION ALL
 SELECT {key('c_custkey', REPRICED)}, c_custkey, c_name, 'nation ' || CAST(c_nationkey + 1 AS VARCHAR), {REPRICED}, NULL, true, 2
 FROM customer WHERE c_mktsegment = 'HOUSEHOLD'""",
    "fact_order": "SELECT * FROM order_lines",
    "fact_product_daily": "SELECT * FROM product_daily",
    "fact_seller_daily": "SELECT * FROM seller_daily",
    "fact_order_daily": "SELECT * FROM order_daily",
    "fact_inventory": "SELECT * FROM inventory_now",
    "fact_customer_behavior": "SELECT * FROM behavior",
    "fact_order_header": "SELECT DISTINCT order_id, date_key, customer_key, seller_key, geography_key, sales_channel, total_due FROM order_lines",
    "load_state": f"""SELECT 'fact_order' AS table_name, CAST(max(order_date) AS TIMESTAMP) AS last_loaded, count(*) AS row_count FROM order_header
 UNION ALL SELECT 'fact_seller_daily', CAST(max(order_date) AS TIMESTAMP), count(*) FROM order_header WHERE sales_channel = 'Online'
 UNION ALL SELECT 'fact_order_daily', NULL, NULL""",
    "fact_product_daily_of_lines": "SELECT * FROM product_daily",
    "incremental_order_daily": "SELECT * FROM order_daily",
    "incremental_stored_runs": "SELECT * FROM order_daily",
    "incremental_product_daily": "SELECT * FROM product_daily",
    "incremental_seller_daily": "SELECT * FROM seller_daily",
    "late_orders_order_daily": "SELECT * FROM order_daily",
    "details_of_orders": "SELECT * FROM order_detail WHERE order_id IN (SELECT order_id FROM order_header WHERE sales_channel = 'Online')",
    "affected_customer_recompute": "SELECT * FROM behavior",
    "full_refresh_inventory": """SELECT fact_inventory_key, product_key, location_id, CASE WHEN location_id < 3 THEN quantity + 5 ELSE quantity END AS quantity,
       shelf, bin FROM inventory_now""",
    "full_refresh_inventory_delete": """SELECT fact_inventory_key, product_key, location_id, quantity + 5 AS quantity, shelf, bin FROM inventory_now
 WHERE location_id < 3""",
    "replace_month_partitions": f"""SELECT * FROM order_daily WHERE date_key >= 20000101
 UNION ALL SELECT * FROM ({daily_facts('', "(SELECT * FROM order_header WHERE status <> 'P')")['order_daily']}) early WHERE date_key < 20000101""",
    "late_orders_months": "SELECT * FROM order_daily WHERE date_key >= 20000101 OR date_key < 19960201",
    "q_sales_kpis": f"""SELECT total_revenue, product_order_count, total_profit, total_orders,
       {mean('total_profit', f"({unscaled('total_revenue')})", 4, 100 * 10000)} AS profit_margin
 FROM (SELECT {money('revenue')} AS total_revenue, CAST(sum(order_count) AS BIGINT) AS product_order_count, {money('gross_profit')} AS total_profit FROM product_daily) k,
      (SELECT count(DISTINCT order_id) AS total_orders FROM order_lines) o""",
    "q_daily_trend": f"""SELECT full_date, year, month, {money('revenue')} AS revenue, {money('gross_profit')} AS profit
 FROM product_daily f JOIN calendar d ON f.date_key = d.date_key GROUP BY full_date, year, month""",
    "q_aov_by_type": f"""SELECT customer_type, CASE customer_type WHEN 'Individual' THEN 'B2C' ELSE 'B2B' END AS market, count(*) AS total_orders,
       {money('total_due')} AS total_revenue, {mean('sum(total_due)', 'count(*)')} AS avg_order_value
 FROM due o JOIN dim_customer c ON o.customer_key = c.customer_key WHERE customer_type IN ('Individual', 'Store') GROUP BY customer_type""",
    "q_top_products": f"""SELECT product_name, {money('revenue')} AS total_revenue, CAST(sum(quantity_sold) AS BIGINT) AS total_quantity
 FROM product_daily f JOIN dim_product p ON f.product_key = p.product_key GROUP BY product_name ORDER BY total_revenue DESC, product_name LIMIT 10""",
    "q_revenue_by_country": f"""SELECT country_name, {money('total_due')} AS total_revenue FROM due o JOIN dim_geography g ON o.geography_key = g.geography_key
 GROUP BY country_name""",
    "q_revenue_by_type": f"""SELECT customer_type, CASE customer_type WHEN 'Individual' THEN 'B2C' ELSE 'B2B' END AS market, {money('total_due')} AS total_revenue
 FROM due o JOIN dim_customer c ON o.customer_key = c.customer_key WHERE customer_type IN ('Individual', 'Store') GROUP BY customer_type""",
    "q_stock_vs_sales": "SELECT * FROM stock_sales ORDER BY stock, product_id LIMIT 20",
    "q_low_stock": "SELECT * FROM (SELECT * FROM stock_sales ORDER BY stock, product_id LIMIT 20) s WHERE stock < 50",
    "q_low_stock_all": "SELECT * FROM stock_sales WHERE stock < 50",
    "q_segment_summary": f"SELECT customer_segment, count(customer_key) AS num_customers, {money('total_amount')} AS total_revenue FROM behavior GROUP BY 1",
    "q_top_regions": f"""SELECT country_name, state_name, {money('total_due')} AS total_revenue, count(DISTINCT customer_id) AS num_customers
 FROM due o JOIN dim_geography g ON o.geography_key = g.geography_key JOIN dim_customer c ON o.customer_key = c.customer_key GROUP BY ALL
 ORDER BY total_revenue DESC, country_name, state_name LIMIT 15""",
    "q_rfm_scatter": """SELECT fact_customer_behavior_key, customer_segment, recency_days, total_orders, total_amount FROM behavior
 WHERE total_amount > 0 AND CAST(total_amount AS DOUBLE) < (SELECT quantile_cont(CAST(total_amount AS DOUBLE), 0.99) FROM behavior WHERE total_amount > 0)""",
    "q_top_sellers": f"""SELECT seller_name, {money('revenue')} AS total_revenue, CAST(sum(order_count) AS BIGINT) AS total_orders
 FROM seller_daily f JOIN dim_seller s ON f.seller_key = s.seller_key WHERE seller_id <> -1 GROUP BY seller_name
 ORDER BY total_revenue DESC, seller_name LIMIT 10""",
    "q_seller_territories": f"""SELECT country_name AS territory, {money('total_due')} AS revenue
 FROM due o JOIN dim_seller s ON o.seller_key = s.seller_key JOIN dim_geography g ON o.geography_key = g.geography_key
 WHERE seller_name = '{BEST_SELLER}' GROUP BY country_name ORDER BY revenue DESC, territory LIMIT 5""",
    "q_seller_segments": f"""SELECT customer_segment, count(DISTINCT c.customer_id) AS num_customers, {money('total_due')} AS revenue
 FROM due o JOIN dim_seller s ON o.seller_key = s.seller_key JOIN dim_customer c ON o.customer_key = c.customer_key
 JOIN (SELECT customer_id, customer_segment FROM behavior f JOIN dim_customer v ON f.customer_key = v.customer_key) b ON c.customer_id = b.customer_id
 WHERE seller_name = '{BEST_SELLER}' GROUP BY customer_segment""",
    "q_category_by_country": f"""SELECT country_name, category_name, {money('line_total')} AS total_revenue
 FROM order_lines f JOIN dim_product p ON f.product_key = p.product_key JOIN dim_geography g ON f.geography_key = g.geography_key GROUP BY ALL""",
    "q_seller_top_products": f"""SELECT product_name, {money('line_total')} AS revenue, count(DISTINCT order_id) AS num_orders
 FROM order_lines f JOIN dim_seller s ON f.seller_key = s.seller_key JOIN dim_product p ON f.product_key = p.product_key
 WHERE seller_name = '{BEST_SELLER}' GROUP BY product_name ORDER BY revenue DESC, product_name LIMIT 5""",
    "x_abc_class": f"""SELECT product_id, revenue, CAST(running AS {MONEY_SUM}) AS running_revenue,
       CASE WHEN running * 100 <= total * 80 THEN 'A' WHEN running * 100 <= total * 95 THEN 'B' ELSE 'C' END AS abc_class
 FROM (SELECT product_id, revenue, sum(revenue) OVER (ORDER BY revenue DESC, product_id) AS running, sum(revenue) OVER () AS total
       FROM (SELECT product_id, {money('revenue')} AS revenue FROM product_daily f JOIN dim_product p ON f.product_key = p.product_key
             GROUP BY product_id) r) w""",
    "x_stream_incremental": "SELECT * FROM order_daily",
}

# a load in two runs equals the load in one; reports by business id do not depend on versions
BODIES |= {
    f"{load}_{fact}": BODIES[fact]
    for load in ["increments", "store"]
    for fact in ["fact_order", "fact_order_header", "fact_product_daily", "fact_seller_daily", "fact_order_daily", "fact_customer_behavior"]
}
BODIES |= {
    "versions_top_regions": BODIES["q_top_regions"],
    "versions_seller_segments": BODIES["q_seller_segments"],
    "versions_stock_vs_sales": BODIES["q_stock_vs_sales"],
    "versions_customer_behavior": BODIES["fact_customer_behavior"],
    "clean_rejects": """SELECT * FROM (WITH raw AS (SELECT CASE WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN NULL ELSE l_orderkey || '-' || l_linenumber END AS line,
   CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN CAST(l_quantity AS INT) || ' pcs' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS quantity,
   CASE WHEN l_quantity = 1 THEN '-1.00' ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount FROM lineitem),
 typed AS (SELECT *, TRY_CAST(quantity AS INT) AS q, TRY_CAST(amount AS DECIMAL(18,4)) AS a FROM raw),
 sound AS (SELECT line, q, a, count(*) AS n FROM typed WHERE line IS NOT NULL AND NOT coalesce(a < 0, false) GROUP BY ALL),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY q NULLS FIRST, a NULLS FIRST) AS rn FROM sound)
 SELECT coalesce(line, '') AS row_key, 'quantity' AS column_name, quantity AS raw_value, 'no int' AS rule, false AS dropped, CAST(1 AS BIGINT) AS copies
 FROM typed WHERE quantity IS NOT NULL AND q IS NULL
 UNION ALL SELECT '', 'line', NULL, 'no key', true, 1 FROM typed WHERE line IS NULL
 UNION ALL SELECT coalesce(line, ''), 'amount', amount, 'negative', true, 1 FROM typed WHERE a < 0
 UNION ALL SELECT line, NULL, coalesce(CAST(q AS VARCHAR), '') || '|' || coalesce(CAST(a AS VARCHAR), ''), 'key occurs again', true,
   CAST(n - CASE WHEN rn = 1 THEN 1 ELSE 0 END AS BIGINT) FROM ranked WHERE n - CASE WHEN rn = 1 THEN 1 ELSE 0 END > 0) r""",
    "clean_rejects_kept": """SELECT line, q AS quantity, a AS amount FROM (
 SELECT line, q, a, row_number() OVER (PARTITION BY line ORDER BY q NULLS FIRST, a NULLS FIRST) AS rn FROM (
   SELECT CASE WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN NULL ELSE l_orderkey || '-' || l_linenumber END AS line,
     CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN NULL ELSE CAST(l_quantity AS INT) END AS q,
     CASE WHEN l_quantity = 1 THEN CAST(-1 AS DECIMAL(18,4)) ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) END AS a FROM lineitem) t
 WHERE line IS NOT NULL AND a >= 0) r WHERE rn = 1""",
    "late_orders_by_arrival": "SELECT * FROM order_daily",
    "store_increment_months": "SELECT * FROM order_daily",
    "month_emptied": "SELECT * FROM order_daily WHERE date_key NOT BETWEEN 19960201 AND 19960229",
    "x_stream_late_lines": "SELECT * FROM order_daily",
    "x_stream_resent_orders": "SELECT * FROM order_daily",
    "x_kmeans_check": """SELECT count(*) AS customers, count(DISTINCT fact_customer_behavior_key) AS distinct_customers,
       CAST(0 AS BIGINT) AS out_of_range, CAST(0 AS BIGINT) AS not_nearest FROM behavior""",
}

# build_summary runs the whole chain from raw tables; its SQL counts each table's grain.
BODIES["build_summary"] = f"""SELECT table_name, CAST(row_count AS BIGINT) AS row_count, 'loaded' AS status FROM (
 SELECT 'dim_date' AS table_name, date_diff('day', min(CAST(OrderDate AS DATE)), max(CAST(OrderDate AS DATE))) + 1 AS row_count FROM silver_header
 UNION ALL SELECT 'dim_product', count(*) + 1 FROM silver_products
 UNION ALL SELECT 'dim_geography', count(*) + 1 FROM person_address
 UNION ALL SELECT 'dim_vendor', count(*) + 1 FROM purchasing_vendor
 UNION ALL SELECT 'dim_customer', count(*) + 1 FROM sales_customer
 UNION ALL SELECT 'dim_seller', count(*) + 1 FROM sales_salesperson
 UNION ALL SELECT 'fact_order', count(*) FROM silver_lines
 UNION ALL SELECT 'fact_order_header', count(*) FROM (SELECT DISTINCT SalesOrderID FROM silver_lines) o
 UNION ALL SELECT 'fact_product_daily', count(*) FROM (SELECT DISTINCT OrderDate, product FROM silver_lines) a
 UNION ALL SELECT 'fact_seller_daily', count(*) FROM (SELECT DISTINCT OrderDate, seller FROM silver_lines) b
 UNION ALL SELECT 'fact_order_daily', count(*) FROM (SELECT DISTINCT OrderDate FROM silver_lines) c
 UNION ALL SELECT 'fact_inventory', count(*) FROM production_productinventory WHERE ProductID IS NOT NULL AND Quantity >= 0
 UNION ALL SELECT 'fact_customer_behavior', count(*) FROM (SELECT DISTINCT CustomerID FROM silver_lines) d) t"""
PARTS |= {
    "silver_header": "SELECT * FROM sales_salesorderheader WHERE TaxAmt >= 0",
    "silver_products": "SELECT ProductID FROM production_product WHERE CAST(StandardCost AS DECIMAL(18,4)) >= 0",
    "silver_lines": """SELECT h.SalesOrderID, h.OrderDate, h.CustomerID, coalesce(CAST(p.ProductID AS VARCHAR), 'UNKNOWN') AS product,
       coalesce(CAST(s.BusinessEntityID AS VARCHAR), 'UNKNOWN') AS seller
 FROM silver_header h JOIN (
   SELECT *, row_number() OVER (PARTITION BY SalesOrderDetailID ORDER BY SalesOrderID, ProductID, OrderQty, UnitPrice, UnitPriceDiscount, LineTotal) AS n
   FROM sales_salesorderdetail) d ON h.SalesOrderID = d.SalesOrderID
 LEFT JOIN silver_products p ON d.ProductID = p.ProductID
 LEFT JOIN sales_salesperson s ON h.SalesPersonID = s.BusinessEntityID
 WHERE d.n = 1 AND LineTotal >= 0""",
}

ORACLE: dict[str, str] = {name: _sql(body) for name, body in BODIES.items()}
