"""Dimension builders: conformed tables to gold dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.calendar import calendar_columns
from martwright.functions.keys import surrogate_key
from martwright.functions.labels import active_status, yes_no
from martwright.functions.money import MONEY, PERCENT
from martwright.operators.cleaning import fill_missing
from martwright.operators.merge import insert_absent, scd2_merge, start_history, upsert
from martwright.operators.ordering import position_key
from martwright.schemas import (
    DEFAULTS,
    KEYS,
    TABLES,
    TRACKED,
    conform,
    unknown_member,
)


def days_between(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of a one-row frame."""
    step = F.expr("interval 1 day")
    return bounds.select(F.explode(F.sequence("first_day", "last_day", step)).alias("full_date"))


def dim_date(bounds: DataFrame) -> DataFrame:
    """Calendar between the bounds, which may come from a table and stay lazy."""
    return conform(days_between(bounds).select(*calendar_columns("full_date")), "dim_date")


def dim_date_between(spark: SparkSession, first_day: date, last_day: date) -> DataFrame:
    bounds = spark.range(1).select(F.lit(first_day).alias("first_day"), F.lit(last_day).alias("last_day"))
    return dim_date(bounds)


def product_snapshot(product: DataFrame) -> DataFrame:
    df = fill_missing(product, DEFAULTS["dim_product"])
    return df.withColumns({c: F.col(c).cast(MONEY) for c in ["standard_cost", "list_price"]})


def customer_snapshot(customer: DataFrame) -> DataFrame:
    df = fill_missing(customer, DEFAULTS["dim_customer"])
    return df.withColumn("customer_name", F.initcap("customer_name"))


def seller_snapshot(seller: DataFrame) -> DataFrame:
    """Rates become percent; amounts the source lacks are zero."""
    amounts = ["sales_quota", "bonus", "sales_ytd", "sales_last_year"]
    present = seller.withColumns({c: F.lit(0).cast(MONEY) for c in amounts if c not in seller.columns})
    df = fill_missing(present, DEFAULTS["dim_seller"])
    return df.select(
        "seller_id",
        F.initcap("full_name").alias("seller_name"),
        (F.col("commission_pct") * 100).cast(PERCENT).alias("commission_pct"),
        *[F.col(c).cast(MONEY).alias(c) for c in amounts],
    )


SNAPSHOTS = {
    "dim_product": product_snapshot,
    "dim_customer": customer_snapshot,
    "dim_seller": seller_snapshot,
}


def seeded(dim: DataFrame, table: str) -> DataFrame:
    """The first state of a dimension: its rows and the unknown member. Later merges keep both."""
    return dim.unionByName(unknown_member(dim.sparkSession, table))


def seed_stored(dim: DataFrame, table: str) -> DataFrame:
    """Add the unknown member to a stored dimension unless it is there already."""
    return insert_absent(dim, unknown_member(dim.sparkSession, table), [KEYS[table][1]])


def load_versions(
    history: DataFrame | None,
    silver: DataFrame,
    table: str,
    run_date: date,
    *,
    tracked: list[str] | None = None,
    overwrite_untracked: bool = False,
) -> DataFrame:
    """Merge a snapshot into a versioned dimension.

    Without a ``history`` this is the first load: ``run_date`` is the day from which its
    versions are valid, so pass ``HISTORY_START`` to let orders from before the load find them.
    """
    key, surrogate = KEYS[table]
    snapshot = SNAPSHOTS[table](silver)
    if history is None:
        return seeded(conform(start_history(snapshot, key, surrogate, run_date), table), table)
    return scd2_merge(
        history,
        snapshot,
        key,
        surrogate,
        tracked or TRACKED[table],
        run_date,
        overwrite_untracked=overwrite_untracked,
    )


def _stamp(loaded_at: Column | None) -> Column:
    return (F.current_timestamp() if loaded_at is None else loaded_at).alias("created_at")


def dim_geography(geography: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """One row per address, keyed by a hash of its id so that later rows never shift keys."""
    df = fill_missing(geography, DEFAULTS["dim_geography"])
    keyed = df.select(surrogate_key("address_id").alias("geography_key"), "*", _stamp(loaded_at))
    return conform(keyed, "dim_geography")


def dim_vendor(vendor: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """One row per vendor, keyed by a hash of its id."""
    df = fill_missing(vendor, DEFAULTS["dim_vendor"])
    keyed = df.select(
        surrogate_key("vendor_id").alias("vendor_key"),
        "vendor_id",
        "account_number",
        F.col("name").alias("vendor_name"),
        "credit_rating",
        yes_no(F.col("preferred_vendor_status")).alias("preferred_vendor"),
        active_status(F.col("active_flag")).alias("vendor_status"),
        _stamp(loaded_at),
    )
    return conform(keyed, "dim_vendor")


def with_position_key(dim: DataFrame, table: str) -> DataFrame:
    """The dimension keyed 1, 2, 3 … in the order of its business id instead of by hash."""
    business, surrogate = KEYS[table]
    numbered = position_key(dim.drop(surrogate), [F.col(business)], surrogate)
    return numbered.select(*TABLES[table])


def load_geography(
    target: DataFrame | None, geography: DataFrame, loaded_at: Column | None = None
) -> DataFrame:
    """Upsert addresses; without a target, the first load."""
    fresh = dim_geography(geography, loaded_at)
    return seeded(fresh, "dim_geography") if target is None else upsert(target, fresh, ["geography_key"])


def load_vendor(target: DataFrame | None, vendor: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Upsert vendors; without a target, the first load."""
    fresh = dim_vendor(vendor, loaded_at)
    return seeded(fresh, "dim_vendor") if target is None else upsert(target, fresh, ["vendor_key"])
