"""The driver's tables as sales inputs.

Each text runs unchanged in Spark and DuckDB but for the dialect words in ``SPARK`` and
``DUCKDB``. ``{orders}`` and the like name the driver's tables. What those tables lack is
planted by business attributes: NULLs, unknown keys, a second price list, withdrawn products.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

FIRST_DAY = date(1900, 1, 1)
REPRICED_ON = date(1998, 7, 1)
AS_OF = date(2001, 8, 2)

# Exact half-up unit price, and the three stock locations, in each dialect.
SPARK = {
    "unit_price": "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) / CAST(l_quantity AS DECIMAL(4,0)) AS DECIMAL(18,4))",
    "locations": "explode(array(1, 2, 3))",
    "part_word": "split_part(p_name, ' ', 1)",
}
DUCKDB = {
    "unit_price": "CAST((CAST(CAST(l_extendedprice AS DECIMAL(18,2))*10000 AS BIGINT)*2 + CAST(l_quantity AS BIGINT))"
    " // (2*CAST(l_quantity AS BIGINT)) AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(4,4))",
    "locations": "unnest([1, 2, 3])",
    "part_word": "split_part(p_name, ' ', 1)",
}

# Conformed inputs of the dimension and fact builders.
SALES = {
    "order_header": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN NULL ELSE CAST(o_orderkey % 100 AS BIGINT) END AS sales_person_id,
       CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status,
       CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'Online' ELSE 'Offline' END AS sales_channel,
       CAST(o_totalprice AS DECIMAL(18,4)) AS sub_total,
       CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST(0.08 AS DECIMAL(2,2)) AS DECIMAL(18,4)) AS tax_amt,
       CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST(0.02 AS DECIMAL(2,2)) AS DECIMAL(18,4)) AS freight_amt,
       CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST(1.10 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS total_due
FROM {orders}""",
    # where each order goes: the customer's nation, which the order table itself does not hold
    "order_address": """
SELECT o_orderkey AS order_id, CAST(c_nationkey AS BIGINT) AS address_id
FROM {orders} LEFT JOIN {customer} ON o_custkey = c_custkey""",
    # a line is identified by its order, line number, product, supplier and amount
    "order_detail": """
SELECT l_orderkey AS order_id,
       concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),
                 CAST(l_suppkey AS STRING), CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING)) AS order_detail_id,
       CASE WHEN l_returnflag = 'R' AND l_quantity = 7 THEN CAST(-l_partkey - 2 AS BIGINT) ELSE l_partkey END AS product_id,
       CAST(l_quantity AS INT) AS order_qty,
       [unit_price] AS unit_price,
       CAST(l_discount AS DECIMAL(10,4)) AS unit_price_discount,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS line_total
FROM {lineitem}""",
    "product_v1": """
SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS product_number, CAST(NULL AS STRING) AS color,
       CAST(p_size AS STRING) AS size,
       CAST(CAST(p_retailprice AS DECIMAL(12,4)) * CAST(0.60 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS standard_cost,
       CAST(p_retailprice AS DECIMAL(18,4)) AS list_price, p_type AS category_name, p_brand AS subcategory_name
FROM {part}""",
    # PROMO products cost more; size 50 is withdrawn
    "product_v2": """
SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS product_number, CAST(NULL AS STRING) AS color,
       CAST(p_size AS STRING) AS size,
       CAST(CAST(p_retailprice AS DECIMAL(12,4)) * CASE WHEN p_type = 'PROMO' THEN CAST(0.66 AS DECIMAL(3,2)) ELSE CAST(0.60 AS DECIMAL(3,2)) END AS DECIMAL(18,4)) AS standard_cost,
       CAST(CAST(p_retailprice AS DECIMAL(12,4)) * CASE WHEN p_type = 'PROMO' THEN CAST(1.10 AS DECIMAL(3,2)) ELSE CAST(1.00 AS DECIMAL(3,2)) END AS DECIMAL(18,4)) AS list_price,
       p_type AS category_name, p_brand AS subcategory_name
FROM {part} WHERE p_size <> 50""",
    "customer_v1": """
SELECT c_custkey AS customer_id, CASE WHEN c_nationkey = 11 AND c_acctbal < 0 THEN NULL ELSE c_name END AS customer_name,
       CASE WHEN c_mktsegment IN ('MACHINERY','AUTOMOBILE') THEN 'Store' ELSE 'Individual' END AS customer_type,
       concat_ws('', 'AW', CAST(c_custkey AS STRING)) AS account_number
FROM {customer}""",
    # FURNITURE buyers become stores, one nation left the customer file, every account is renumbered
    "customer_v2": """
SELECT c_custkey AS customer_id, CASE WHEN c_nationkey = 11 AND c_acctbal < 0 THEN '' ELSE c_name END AS customer_name,
       CASE WHEN c_mktsegment IN ('MACHINERY','AUTOMOBILE','FURNITURE') THEN 'Store' ELSE 'Individual' END AS customer_type,
       concat_ws('', 'AX', CAST(c_custkey AS STRING)) AS account_number
FROM {customer} WHERE c_nationkey <> 5""",
    "seller": """
SELECT s_suppkey AS seller_id, s_name AS full_name,
       CASE WHEN s_nationkey = 7 THEN NULL ELSE CAST(250000 AS DECIMAL(18,4)) END AS sales_quota,
       CAST(s_acctbal AS DECIMAL(18,4)) AS bonus,
       CAST(CAST(s_suppkey % 5 AS DECIMAL(4,0)) * CAST(0.005 AS DECIMAL(4,3)) + CAST(0.010 AS DECIMAL(4,3)) AS DECIMAL(10,4)) AS commission_pct
FROM {supplier}""",
    "vendor": """
SELECT s_suppkey AS vendor_id, concat_ws('', 'V', CAST(s_suppkey AS STRING)) AS account_number, s_name AS name,
       CAST(s_suppkey % 5 + 1 AS INT) AS credit_rating, s_suppkey % 3 = 0 AS preferred_vendor_status,
       CASE WHEN s_nationkey = 11 THEN NULL ELSE s_acctbal >= 0 END AS active_flag
FROM {supplier}""",
    "geography": """
SELECT CAST(n_nationkey AS BIGINT) AS address_id, concat_ws(' ', CAST(n_nationkey AS STRING), 'main street') AS address_line1,
       CAST(NULL AS STRING) AS address_line2, concat_ws(' ', 'city', lower(n_name)) AS city, n_name AS state_name,
       n_name AS country_name, r_name AS territory_name, r_name AS territory_group, CAST(NULL AS STRING) AS postal_code
FROM {nation} LEFT JOIN {region} ON n_regionkey = r_regionkey WHERE n_nationkey IS NOT NULL""",
    "inventory": """
SELECT product_id, location_id, concat_ws('', 'S', CAST(location_id AS STRING)) AS shelf,
       CAST(product_id % 13 AS INT) AS bin, CAST((product_id * 37 + location_id * 11) % 100 AS INT) AS quantity
FROM (SELECT p_partkey AS product_id, [locations] AS location_id FROM {part}) AS stock""",
}

# Raw source tables with the source system's column names, and dirt to clean.
RAW = {
    "sales_customer": """
SELECT c_custkey AS CustomerID, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_custkey END AS PersonID,
       CASE WHEN c_mktsegment IN ('MACHINERY','AUTOMOBILE') THEN c_nationkey END AS StoreID,
       concat(' AW', CAST(c_custkey AS STRING), '  ') AS AccountNumber
FROM {customer}""",
    "person_person": """
SELECT c_custkey AS BusinessEntityID, concat('  ', lower(c_mktsegment)) AS FirstName,
       CASE WHEN c_acctbal < 0 THEN '   ' WHEN c_nationkey = 3 THEN NULL ELSE 'van' END AS MiddleName,
       concat(c_name, ' ') AS LastName
FROM {customer}""",
    "sales_store": """
SELECT n_nationkey AS BusinessEntityID, concat(' ', n_name, ' stores') AS Name
FROM {nation} WHERE n_regionkey <> 4""",
    "production_product": """
SELECT p_partkey AS ProductID, concat(' ', p_name) AS Name, p_brand AS ProductNumber,
       CASE WHEN p_size < 10 THEN '  ' ELSE [part_word] END AS Color,
       CASE WHEN p_size > 45 THEN NULL ELSE CAST(p_size AS STRING) END AS Size,
       p_retailprice - 910 AS StandardCost, p_retailprice AS ListPrice,
       p_size AS ProductSubcategoryID
FROM {part}""",
    # one row per size, many times over: the duplicates must go; size 50 has no category
    "production_productsubcategory": """
SELECT p_size AS ProductSubcategoryID, CAST(floor(p_size / 10) AS INT) AS ProductCategoryID,
       concat('Size ', CAST(p_size AS STRING)) AS Name
FROM {part}""",
    "production_productcategory": """
SELECT r_regionkey AS ProductCategoryID, concat(' ', r_name) AS Name FROM {region}""",
    "person_address": """
SELECT c_custkey AS AddressID, concat(' ', CAST(c_custkey AS STRING), ' main street') AS AddressLine1,
       CAST('   ' AS STRING) AS AddressLine2, concat('NEW ', lower(c_mktsegment), ' city ') AS City,
       c_nationkey AS StateProvinceID, CAST(c_nationkey AS STRING) AS PostalCode
FROM {customer}""",
    "person_stateprovince": """
SELECT n_nationkey AS StateProvinceID, n_name AS CountryRegionCode, n_regionkey AS TerritoryID,
       concat(n_name, ' state') AS Name
FROM {nation} WHERE n_nationkey <> 9""",
    "person_countryregion": """
SELECT n_name AS CountryRegionCode, concat(n_name, ' country ') AS Name FROM {nation} WHERE n_regionkey <> 2""",
    "sales_salesterritory": """
SELECT r_regionkey AS TerritoryID, r_name AS Name, lower(r_name) AS [group] FROM {region} WHERE r_regionkey <> 1""",
    "sales_salesorderheader": """
SELECT o_orderkey AS SalesOrderID, o_custkey AS CustomerID, o_orderkey % 100 AS SalesPersonID,
       o_custkey AS ShipToAddressID, CAST(1 AS INT) AS TerritoryID, o_orderdate AS OrderDate, o_orderdate AS DueDate,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END AS ShipDate, o_orderstatus AS Status,
       CASE WHEN o_orderpriority = '1-URGENT' THEN true WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE false END AS OnlineOrderFlag,
       o_totalprice AS SubTotal, CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice < 5000 THEN -1.0 ELSE 1.5 END AS TaxAmt,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 2.25 END AS Freight, o_totalprice AS TotalDue
FROM {orders}""",
    # the source's line id repeats: order and line number are not unique in these tables
    "sales_salesorderdetail": """
SELECT l_orderkey AS SalesOrderID, l_orderkey * 8 + l_linenumber AS SalesOrderDetailID, l_partkey AS ProductID,
       CAST(l_quantity AS INT) AS OrderQty, CAST(l_extendedprice AS DECIMAL(12,2)) AS UnitPrice,
       CAST(l_discount AS DECIMAL(4,2)) AS UnitPriceDiscount,
       CASE WHEN l_returnflag = 'R' AND l_quantity = 50 THEN CAST(-1 AS DECIMAL(12,2)) ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS LineTotal
FROM {lineitem}""",
    "purchasing_vendor": """
SELECT s_suppkey AS BusinessEntityID, concat('V', CAST(s_suppkey AS STRING), ' ') AS AccountNumber, upper(s_name) AS Name,
       CAST(s_suppkey % 5 + 1 AS INT) AS CreditRating, s_suppkey % 3 = 0 AS PreferredVendorStatus, s_acctbal >= 0 AS ActiveFlag
FROM {supplier}""",
    "sales_salesperson": """
SELECT s_suppkey AS BusinessEntityID, CASE WHEN s_nationkey = 7 THEN NULL ELSE 250000 END AS SalesQuota,
       CAST(s_acctbal AS DECIMAL(18,4)) AS Bonus, CAST(0.0150 AS DECIMAL(10,4)) AS CommissionPct,
       CAST(s_acctbal AS DECIMAL(18,4)) AS SalesYTD, CAST(0 AS DECIMAL(18,4)) AS SalesLastYear
FROM {supplier}""",
    "production_productinventory": """
SELECT ProductID, LocationID, concat(' S', CAST(LocationID AS STRING)) AS Shelf, CAST(ProductID % 13 AS INT) AS Bin,
       CASE WHEN LocationID = 3 AND ProductID % 13 = 4 THEN -1 ELSE CAST((ProductID * 37 + LocationID * 11) % 100 AS INT) END AS Quantity
FROM (SELECT CASE WHEN p_size = 1 THEN NULL ELSE p_partkey END AS ProductID, [locations] AS LocationID FROM {part}) AS stock""",
}


def spark_text(text: str) -> str:
    for word, value in SPARK.items():
        text = text.replace(f"[{word}]", value)
    return text.replace("[group]", "`Group`")


def duckdb_text(text: str) -> str:
    for word, value in DUCKDB.items():
        text = text.replace(f"[{word}]", value)
    text = text.replace("[group]", '"Group"').replace("AS STRING", "AS VARCHAR")
    for table in DRIVER_TABLES:
        text = text.replace(f"{{{table}}}", table)
    return text


# (application, folder, table) -> scan; listing and footers are read once per application
SCANS: dict[tuple[str, str, str], DataFrame] = {}


class Inputs:
    """Lazy frames over one driver folder: ``inputs.order_header``, ``inputs.lineitem`` …"""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        place = (self.spark.sparkContext.applicationId, self.folder, name)
        if place not in SCANS:
            SCANS[place] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return SCANS[place]

    def sql(self, text: str) -> DataFrame:
        used = {t: self.table(t) for t in DRIVER_TABLES if f"{{{t}}}" in text}
        return self.spark.sql(spark_text(text), **used)

    def raw(self, name: str) -> DataFrame:
        return self.sql(RAW[name])

    def input(self, name: str) -> DataFrame:
        return self.sql(SALES[name])

    def __getattr__(self, name: str) -> DataFrame:
        if name in SALES:
            return self.input(name)
        if name in DRIVER_TABLES:
            return self.table(name)
        raise AttributeError(name)
