"""Conformed tables from raw source tables.

Inputs are raw tables with the source system's column names; each is cleaned with
``standard_clean`` on its key, then lookups are joined and the columns renamed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions.labels import full_name
from martwright.operators.cleaning import (
    capitalize,
    fill_missing,
    keep_non_negative,
    standard_clean,
    to_day,
    to_decimal,
)
from martwright.operators.lookup import lookup


def _clean(df: DataFrame, *keys: str) -> DataFrame:
    return standard_clean(df, list(keys), audit=False)


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def _people(person: DataFrame) -> DataFrame:
    return _clean(person, "BusinessEntityID").select(
        "BusinessEntityID", full_name("FirstName", "MiddleName", "LastName").alias("full_name")
    )


def conform_customer(customer: DataFrame, person: DataFrame, store: DataFrame) -> DataFrame:
    """Person name, else store name; a store link makes the customer a store."""
    stores = _clean(store, "BusinessEntityID").select("BusinessEntityID", F.col("Name").alias("store_name"))
    df = _clean(customer, "CustomerID")
    df = lookup(df, _people(person), {"PersonID": "BusinessEntityID"}, ["full_name"])
    df = lookup(df, stores, {"StoreID": "BusinessEntityID"}, ["store_name"])
    return df.select(
        F.col("CustomerID").alias("customer_id"),
        F.coalesce("full_name", "store_name").alias("customer_name"),
        F.when(F.col("StoreID").isNull(), "Individual").otherwise("Store").alias("customer_type"),
        F.col("AccountNumber").alias("account_number"),
    )


def conform_product(product: DataFrame, subcategory: DataFrame, category: DataFrame) -> DataFrame:
    """Products with sound prices, their category chain flattened in."""
    money = ["StandardCost", "ListPrice"]
    df = (
        _clean(product, "ProductID")
        .transform(fill_missing, {"Color": "Unknown", "Size": "Unknown"})
        .transform(to_decimal, money)
        .transform(keep_non_negative, money)
        .transform(capitalize, ["Name", "Color"])
    )
    groups = lookup(
        _clean(subcategory, "ProductSubcategoryID").withColumnRenamed("Name", "subcategory_name"),
        _clean(category, "ProductCategoryID").withColumnRenamed("Name", "category_name"),
        {"ProductCategoryID": "ProductCategoryID"},
        ["category_name"],
    )
    df = lookup(
        df,
        groups,
        {"ProductSubcategoryID": "ProductSubcategoryID"},
        ["category_name", "subcategory_name"],
    )
    return _renamed(
        df,
        {
            "ProductID": "product_id",
            "Name": "product_name",
            "ProductNumber": "product_number",
            "Color": "color",
            "Size": "size",
            "StandardCost": "standard_cost",
            "ListPrice": "list_price",
            "category_name": "category_name",
            "subcategory_name": "subcategory_name",
        },
    )


def conform_geography(
    address: DataFrame, state: DataFrame, country: DataFrame, territory: DataFrame
) -> DataFrame:
    """Addresses with state, country and sales territory.

    The three small tables are joined to each other first, so the address table is joined once.
    """
    territories = _clean(territory, "TerritoryID").select(
        "TerritoryID",
        F.col("Name").alias("territory_name"),
        F.col("Group").alias("territory_group"),
    )
    countries = _clean(country, "CountryRegionCode").withColumnRenamed("Name", "country_name")
    states = _clean(state, "StateProvinceID").withColumnRenamed("Name", "state_name")
    states = lookup(states, countries, {"CountryRegionCode": "CountryRegionCode"}, ["country_name"])
    states = lookup(
        states, territories, {"TerritoryID": "TerritoryID"}, ["territory_name", "territory_group"]
    )
    places = ["state_name", "country_name", "territory_name", "territory_group"]
    df = _clean(address, "AddressID").transform(capitalize, ["City"])
    df = lookup(df, states, {"StateProvinceID": "StateProvinceID"}, places)
    return _renamed(
        df,
        {
            "AddressID": "address_id",
            "AddressLine1": "address_line1",
            "AddressLine2": "address_line2",
            "City": "city",
            **{c: c for c in places},
            "PostalCode": "postal_code",
        },
    )


def conform_order_header(header: DataFrame) -> DataFrame:
    """Order headers with sound amounts. The ship-to address is kept where the source has one,
    so that facts can be placed geographically."""
    money = ["SubTotal", "TaxAmt", "Freight", "TotalDue"]
    df = (
        _clean(header, "SalesOrderID")
        .transform(to_decimal, money)
        .transform(keep_non_negative, money)
        .transform(to_day, ["OrderDate", "DueDate", "ShipDate"])
        .withColumn("sales_channel", F.when(F.col("OnlineOrderFlag"), "Online").otherwise("Offline"))
    )
    names = {
        "SalesOrderID": "order_id",
        "CustomerID": "customer_id",
        "SalesPersonID": "sales_person_id",
        "TerritoryID": "territory_id",
        "ShipToAddressID": "address_id",
        "OrderDate": "order_date",
        "DueDate": "due_date",
        "ShipDate": "ship_date",
        "Status": "status",
        "sales_channel": "sales_channel",
        "SubTotal": "sub_total",
        "TaxAmt": "tax_amt",
        "Freight": "freight_amt",
        "TotalDue": "total_due",
    }
    if "ShipToAddressID" not in df.columns:
        del names["ShipToAddressID"]
    if "_ingested_at" in df.columns:  # the batch's arrival, by which increments find it
        names["_ingested_at"] = "ingested_at"
    return _renamed(df, names)


def conform_order_detail(detail: DataFrame) -> DataFrame:
    """Order lines with sound quantities and amounts; the discount is not checked."""
    df = (
        _clean(detail, "SalesOrderDetailID")
        .transform(to_decimal, ["UnitPrice", "UnitPriceDiscount", "LineTotal"])
        .transform(keep_non_negative, ["OrderQty", "UnitPrice", "LineTotal"])
    )
    names = {
        "SalesOrderID": "order_id",
        "SalesOrderDetailID": "order_detail_id",
        "ProductID": "product_id",
        "OrderQty": "order_qty",
        "UnitPrice": "unit_price",
        "UnitPriceDiscount": "unit_price_discount",
        "LineTotal": "line_total",
    }
    if "_ingested_at" in df.columns:  # lines may come after their order
        names["_ingested_at"] = "ingested_at"
    return _renamed(df, names)


def conform_vendor(vendor: DataFrame) -> DataFrame:
    return _renamed(
        _clean(vendor, "BusinessEntityID").transform(capitalize, ["Name"]),
        {
            "BusinessEntityID": "vendor_id",
            "AccountNumber": "account_number",
            "Name": "name",
            "CreditRating": "credit_rating",
            "PreferredVendorStatus": "preferred_vendor_status",
            "ActiveFlag": "active_flag",
        },
    )


def conform_seller(salesperson: DataFrame, person: DataFrame) -> DataFrame:
    df = lookup(
        _clean(salesperson, "BusinessEntityID"),
        _people(person),
        {"BusinessEntityID": "BusinessEntityID"},
        ["full_name"],
    )
    return _renamed(
        df,
        {
            "BusinessEntityID": "seller_id",
            "full_name": "full_name",
            "SalesQuota": "sales_quota",
            "Bonus": "bonus",
            "CommissionPct": "commission_pct",
            "SalesYTD": "sales_ytd",
            "SalesLastYear": "sales_last_year",
        },
    )


def conform_inventory(inventory: DataFrame) -> DataFrame:
    df = _clean(inventory, "ProductID", "LocationID").transform(keep_non_negative, ["Quantity"])
    return _renamed(
        df,
        {
            "ProductID": "product_id",
            "LocationID": "location_id",
            "Shelf": "shelf",
            "Bin": "bin",
            "Quantity": "quantity",
        },
    )


# conformed table: builder and the raw tables it reads, in argument order
SILVER_TABLES = {
    "customer": (conform_customer, ["sales_customer", "person_person", "sales_store"]),
    "product": (
        conform_product,
        ["production_product", "production_productsubcategory", "production_productcategory"],
    ),
    "geography": (
        conform_geography,
        [
            "person_address",
            "person_stateprovince",
            "person_countryregion",
            "sales_salesterritory",
        ],
    ),
    "sales_order_header": (conform_order_header, ["sales_salesorderheader"]),
    "sales_order_detail": (conform_order_detail, ["sales_salesorderdetail"]),
    "vendor": (conform_vendor, ["purchasing_vendor"]),
    "seller": (conform_seller, ["sales_salesperson", "person_person"]),
    "product_inventory": (conform_inventory, ["production_productinventory"]),
}


def build_silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All conformed tables from the raw tables, as lazy plans."""
    return {
        table: build(*[bronze[source] for source in sources])
        for table, (build, sources) in SILVER_TABLES.items()
    }
