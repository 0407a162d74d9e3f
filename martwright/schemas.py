"""Gold table contracts: columns, keys, tracked columns, defaults, unknown members."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.keys import UNKNOWN_ID, UNKNOWN_KEY

# Versions loaded first are valid from here on, so that orders older than the load find them.
HISTORY_START = date(1900, 1, 1)

_VERSIONING = {
    "effective_date": "date",
    "expiry_date": "date",
    "is_current": "boolean",
    "version": "smallint",
}

# The table contracts. Ids and counts are bigint and money sums decimal(28,4): a key with a third of all rows must fit.
TABLES: dict[str, dict[str, str]] = {
    "dim_date": {
        "date_key": "int",
        "full_date": "date",
        "day": "int",
        "day_name": "string",
        "day_of_week": "int",
        "week": "int",
        "month": "int",
        "month_name": "string",
        "quarter": "int",
        "year": "int",
        "is_weekend": "boolean",
    },
    "dim_product": {
        "product_key": "string",
        "product_id": "bigint",
        "product_name": "string",
        "product_number": "string",
        "color": "string",
        "size": "string",
        "standard_cost": "decimal(18,4)",
        "list_price": "decimal(18,4)",
        "category_name": "string",
        "subcategory_name": "string",
        **_VERSIONING,
    },
    "dim_geography": {
        "geography_key": "string",
        "address_id": "bigint",
        "address_line1": "string",
        "address_line2": "string",
        "city": "string",
        "state_name": "string",
        "country_name": "string",
        "territory_name": "string",
        "territory_group": "string",
        "postal_code": "string",
        "created_at": "timestamp",
    },
    "dim_vendor": {
        "vendor_key": "string",
        "vendor_id": "bigint",
        "account_number": "string",
        "vendor_name": "string",
        "credit_rating": "int",
        "preferred_vendor": "string",
        "vendor_status": "string",
        "created_at": "timestamp",
    },
    "dim_customer": {
        "customer_key": "string",
        "customer_id": "bigint",
        "customer_name": "string",
        "customer_type": "string",
        "account_number": "string",
        **_VERSIONING,
    },
    "dim_seller": {
        "seller_key": "string",
        "seller_id": "bigint",
        "seller_name": "string",
        "commission_pct": "decimal(5,2)",
        "sales_quota": "decimal(18,4)",
        "bonus": "decimal(18,4)",
        "sales_ytd": "decimal(18,4)",
        "sales_last_year": "decimal(18,4)",
        **_VERSIONING,
    },
    "fact_order": {
        "fact_order_key": "string",
        "order_id": "bigint",
        "date_key": "int",
        "customer_key": "string",
        "product_key": "string",
        "seller_key": "string",
        "geography_key": "string",
        "sales_channel": "string",
        "order_qty": "int",
        "unit_price": "decimal(18,4)",
        "unit_price_discount": "decimal(10,4)",
        "line_total": "decimal(18,4)",
        "sub_total": "decimal(18,4)",
        "tax_amt": "decimal(18,4)",
        "freight_amt": "decimal(18,4)",
        "total_due": "decimal(18,4)",
    },
    "fact_order_header": {
        "order_id": "bigint",
        "date_key": "int",
        "customer_key": "string",
        "seller_key": "string",
        "geography_key": "string",
        "sales_channel": "string",
        "total_due": "decimal(18,4)",
    },
    "fact_product_daily": {
        "fact_product_daily_key": "string",
        "date_key": "int",
        "product_key": "string",
        "quantity_sold": "bigint",
        "revenue": "decimal(28,4)",
        "gross_profit": "decimal(28,4)",
        "order_count": "bigint",
        "avg_standard_cost": "decimal(18,4)",
        "avg_list_price": "decimal(18,4)",
    },
    "fact_seller_daily": {
        "fact_seller_daily_key": "string",
        "date_key": "int",
        "seller_key": "string",
        "order_count": "bigint",
        "customer_count": "bigint",
        "quantity_sold": "bigint",
        "revenue": "decimal(28,4)",
        "commission_earned": "decimal(28,4)",
    },
    "fact_order_daily": {
        "fact_order_daily_key": "string",
        "date_key": "int",
        "daily_order_count": "bigint",
        "daily_customer_count": "bigint",
        "daily_quantity": "bigint",
        "daily_revenue": "decimal(28,4)",
        "average_order_value": "decimal(18,4)",
        "avg_order_total": "decimal(18,4)",
    },
    "fact_inventory": {
        "fact_inventory_key": "string",
        "product_key": "string",
        "location_id": "int",
        "quantity": "int",
        "shelf": "string",
        "bin": "int",
    },
    "fact_customer_behavior": {
        "fact_customer_behavior_key": "string",
        "customer_key": "string",
        "total_orders": "bigint",
        "total_quantity": "bigint",
        "total_amount": "decimal(28,4)",
        "avg_order_value": "decimal(18,4)",
        "avg_order_total": "decimal(18,4)",
        "first_purchase": "date",
        "last_purchase": "date",
        "recency_days": "int",
        "customer_segment": "string",
    },
    "load_state": {
        "table_name": "string",
        "last_loaded": "timestamp",
        "row_count": "bigint",
        "updated_at": "timestamp",
    },
}

# Business key, surrogate key.
KEYS: dict[str, tuple[str, str]] = {
    "dim_product": ("product_id", "product_key"),
    "dim_customer": ("customer_id", "customer_key"),
    "dim_seller": ("seller_id", "seller_key"),
    "dim_geography": ("address_id", "geography_key"),
    "dim_vendor": ("vendor_id", "vendor_key"),
}

# Attributes whose change opens a new version.
TRACKED: dict[str, list[str]] = {
    "dim_product": ["standard_cost", "list_price"],
    "dim_customer": ["customer_name", "customer_type"],
    "dim_seller": ["seller_name", "commission_pct", "sales_quota", "bonus"],
}

# What a missing attribute reads as.
DEFAULTS: dict[str, dict[str, object]] = {
    "dim_product": {
        "product_name": "Unknown",
        "product_number": "N/A",
        "color": "Unknown",
        "size": "Unknown",
        "category_name": "Unknown",
        "subcategory_name": "Unknown",
        "standard_cost": 0,
        "list_price": 0,
    },
    "dim_customer": {
        "customer_name": "Unknown",
        "customer_type": "Unknown",
        "account_number": "N/A",
    },
    "dim_seller": {
        "full_name": "Unknown",
        "sales_quota": 0,
        "bonus": 0,
        "commission_pct": 0,
        "sales_ytd": 0,
        "sales_last_year": 0,
    },
    "dim_geography": {
        "address_line1": "Unknown",
        "address_line2": "",
        "city": "Unknown",
        "state_name": "Unknown",
        "country_name": "Unknown",
        "territory_name": "Unknown",
        "territory_group": "Unknown",
        "postal_code": "Unknown",
    },
    "dim_vendor": {
        "account_number": "N/A",
        "name": "Unknown",
        "credit_rating": 0,
        "preferred_vendor_status": False,
        "active_flag": False,
    },
}

# The member that facts without a dimension row point at.
UNKNOWN_FROM = date(2000, 1, 1)
_UNKNOWN_VERSION = {
    "effective_date": UNKNOWN_FROM,
    "expiry_date": None,
    "is_current": True,
    "version": 1,
}
UNKNOWN_MEMBERS: dict[str, dict[str, object]] = {
    "dim_customer": {
        "customer_key": UNKNOWN_KEY,
        "customer_id": UNKNOWN_ID,
        "customer_name": "Unknown / N/A",
        "customer_type": "Unknown",
        "account_number": "N/A",
        **_UNKNOWN_VERSION,
    },
    "dim_seller": {
        "seller_key": UNKNOWN_KEY,
        "seller_id": UNKNOWN_ID,
        "seller_name": "Unknown / N/A",
        "commission_pct": Decimal(0),
        "sales_quota": Decimal(0),
        "bonus": Decimal(0),
        "sales_ytd": Decimal(0),
        "sales_last_year": Decimal(0),
        **_UNKNOWN_VERSION,
    },
    "dim_product": {
        "product_key": UNKNOWN_KEY,
        "product_id": UNKNOWN_ID,
        "product_name": "Unknown / N/A",
        "product_number": "N/A",
        "color": "Unknown",
        "size": "Unknown",
        "standard_cost": Decimal(0),
        "list_price": Decimal(0),
        "category_name": "Unknown",
        "subcategory_name": "Unknown",
        **_UNKNOWN_VERSION,
    },
    "dim_geography": {
        "geography_key": UNKNOWN_KEY,
        "address_id": UNKNOWN_ID,
        "address_line1": "Unknown",
        "address_line2": "",
        "city": "Unknown",
        "state_name": "Unknown",
        "country_name": "Unknown",
        "territory_name": "Unknown",
        "territory_group": "Unknown",
        "postal_code": "Unknown",
        "created_at": None,
    },
    "dim_vendor": {
        "vendor_key": UNKNOWN_KEY,
        "vendor_id": UNKNOWN_ID,
        "account_number": "N/A",
        "vendor_name": "Unknown / N/A",
        "credit_rating": 0,
        "preferred_vendor": "No",
        "vendor_status": "Inactive",
        "created_at": None,
    },
}


def ddl(table: str) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in TABLES[table].items())


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """A gold table before its first load."""
    return spark.createDataFrame([], ddl(table))


def conform(
    df: DataFrame, table: str, defaults: dict[str, str] | None = None, keep: list[str] | None = None
) -> DataFrame:
    """The table's columns in order and type, then those to ``keep`` beside them. A column that ``df`` lacks is added,
    filled with its default (SQL) or NULL, so files written before the column existed stay readable."""
    present, defaults = set(df.columns), defaults or {}

    def column(name: str, kind: str) -> str:
        value = f"`{name}`" if name in present else defaults.get(name, "NULL")
        return f"CAST({value} AS {kind}) AS `{name}`"

    return df.selectExpr(*[column(name, kind) for name, kind in TABLES[table].items()], *[f"`{c}`" for c in keep or []])


def add_versioning(df: DataFrame, table: str, first_day: date) -> DataFrame:
    """Upgrade a dimension stored without history columns: each row becomes version 1."""
    start = f"DATE '{first_day.isoformat()}'"
    return conform(df, table, {"effective_date": start, "is_current": "true", "version": "1"})


def unknown_member(spark: SparkSession, table: str) -> DataFrame:
    """The row that an empty dimension starts with."""
    member = UNKNOWN_MEMBERS[table]
    # a plan rather than local data: Spark knows it is one row and broadcasts it
    return spark.range(1).select(
        *[F.lit(member[name]).cast(kind).alias(name) for name, kind in TABLES[table].items()]
    )
