"""Incremental loads: what a batch touches is recomputed in full, so reruns change nothing.

A batch is found by arrival (``ingested_at``) where the source gives it, else by order date. The months its
orders fall in are rebuilt from the conformed orders and lines of these months, which are stored by
``month_key``: month numbers reach the scans as literals, and only lines of chosen orders are added up.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.calendar import date_key
from martwright.functions.labels import rfm_segment
from martwright.operators.lookup import current_rows
from martwright.operators.merge import upsert
from martwright.plans.facts import fact_customer_behavior, with_customer_key
from martwright.schemas import conform

Build = Callable[[DataFrame, DataFrame], DataFrame]


def load_mark(state: DataFrame, table: str) -> DataFrame:
    """One row: when ``table`` was last loaded, as ``last_loaded`` and ``last_day``; NULL if never."""
    mark = state.filter(F.col("table_name") == table).agg(F.max("last_loaded").alias("last_loaded"))
    return mark.select("last_loaded", F.col("last_loaded").cast("date").alias("last_day"))


def read_mark(state: DataFrame, table: str) -> date | None:
    """The stored day on the driver, so that it can prune partitions as a literal; None if never loaded."""
    return load_mark(state, table).first()["last_day"]


def read_arrival_mark(state: DataFrame, table: str) -> datetime | None:
    return load_mark(state, table).first()["last_loaded"]


def advance_mark(state: DataFrame, marks: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Upsert ``table_name, last_loaded, row_count`` rows into the load state."""
    stamp = F.current_timestamp() if updated_at is None else updated_at
    return upsert(state, conform(marks.withColumn("updated_at", stamp), "load_state"), ["table_name"])


def orders_mark(header: DataFrame, table: str, column: str = "order_date") -> DataFrame:
    """Mark row from the data itself: the latest order date (or arrival) loaded, and how many orders."""
    return header.agg(
        F.max(column).cast("timestamp").alias("last_loaded"), F.count("*").alias("row_count")
    ).select(F.lit(table).alias("table_name"), "last_loaded", "row_count")


def orders_since(header: DataFrame, day: date | None, lateness_days: int = 0) -> DataFrame:
    """Orders from ``day`` on, inclusive, and those without a date; all orders if there is no day yet.

    The literal date reaches the Parquet scan.
    """
    if day is None:
        return header
    since = F.lit(day - timedelta(days=lateness_days))
    return header.filter((F.col("order_date") >= since) | F.col("order_date").isNull())


def arrived_since(header: DataFrame, moment: datetime | None) -> DataFrame:
    """Orders that arrived after ``moment``, or at an unknown time; all orders if there is no mark yet."""
    if moment is None:
        return header
    return header.filter((F.col("ingested_at") > F.lit(moment)) | F.col("ingested_at").isNull())


def details_of(header: DataFrame, detail: DataFrame) -> DataFrame:
    """Lines of the given orders; never repeats a line."""
    return detail.join(header.select("order_id"), "order_id", "left_semi")


def month_key(day: Column | str) -> Column:
    """Integer yyyymm, NULL for no date."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def with_month(header: DataFrame) -> DataFrame:
    return header.withColumn("month_key", month_key("order_date"))


def lines_with_month(header: DataFrame, detail: DataFrame) -> DataFrame:
    """Lines with their order's month, to be stored by it; lines without an order are left to the next batch."""
    months = header.select("order_id", month_key("order_date").alias("month_key"))
    return detail.drop("month_key").join(months, "order_id")


def months_of(orders: DataFrame) -> list[int | None]:
    """The months a batch falls in: at most one value per calendar month, None for orders without a date."""
    return [r["m"] for r in orders.select(month_key("order_date").alias("m")).distinct().collect()]


def of_months(df: DataFrame, months: list[int | None], day: str | None = None) -> DataFrame:
    """Rows of the given months, by the stored ``month_key`` if there is one, else by the date column ``day``."""
    if "month_key" in df.columns:
        key = F.col("month_key")
    elif day is not None:
        key = month_key(day)
    else:
        return df
    known = [m for m in months if m is not None]
    chosen = key.isin(known) if known else F.lit(False)
    return df.filter(chosen | key.isNull()) if None in months else df.filter(chosen)


def refresh_since(fact: DataFrame, header: DataFrame, detail: DataFrame, build: Build, day: date | None) -> DataFrame:
    """New state of a day-grain fact after recomputing every day from ``day`` on; of all days if there is none."""
    orders = orders_since(header, day)
    fresh = build(orders, details_of(orders, detail))
    if day is None:
        return fresh
    return fact.filter(F.col("date_key") < date_key(F.lit(day))).unionByName(fresh)


def touched_days(orders: DataFrame) -> DataFrame:
    """Distinct order dates of a batch: at most one row per calendar day."""
    return orders.select("order_date").distinct()


def rebuild_days(header: DataFrame, detail: DataFrame, days: DataFrame, build: Build) -> DataFrame:
    """The fact rows of the given days only. The day list is bounded by the calendar, which is why it may be
    broadcast; orders of other days, and their lines, drop out before anything is added up."""
    orders = header.join(F.broadcast(days), "order_date", "left_semi")
    return build(orders, details_of(orders, detail))


def rebuild_months(header: DataFrame, detail: DataFrame, months: list[int | None], build: Build) -> DataFrame:
    """The fact rows of the given months only, for facts stored in month partitions."""
    orders = of_months(header, months, "order_date")
    return build(orders, details_of(orders, of_months(detail, months)))


def refresh_days(fact: DataFrame, header: DataFrame, detail: DataFrame, days: DataFrame, build: Build) -> DataFrame:
    """New state of a day-grain fact after a batch, late and back-dated orders included.

    Whole days are replaced, so rows of a day whose product version changed do not linger.
    """
    stale = days.select(date_key("order_date").alias("date_key"))
    kept = fact.join(F.broadcast(stale), "date_key", "left_anti")
    return kept.unionByName(rebuild_days(header, detail, days, build))


def current_behavior(behavior: DataFrame, dim_customer: DataFrame, as_of: date) -> DataFrame:
    """Stored lifetime rows as of another day: the current version's key, recency and segment.

    The sums stay as they are; only customers with new orders need theirs recomputed.
    """
    ids = dim_customer.select(F.col("customer_key").alias("_key"), F.col("customer_id").alias("_id"))
    now = current_rows(dim_customer).select(F.col("customer_id").alias("_now_id"), F.col("customer_key").alias("_now"))
    known = behavior.join(ids, F.col("customer_key") == F.col("_key"), "left").join(now, F.col("_id") == F.col("_now_id"), "left")
    recency = F.datediff(F.lit(as_of), "last_purchase")
    rows = known.withColumns(
        {
            "customer_key": F.coalesce("_now", "customer_key"),
            "recency_days": recency,
            "customer_segment": rfm_segment(F.col("total_amount"), F.col("total_orders"), recency),
        }
    )
    return conform(rows, "fact_customer_behavior")


def refresh_customers(
    behavior: DataFrame,
    new_orders: DataFrame,
    header: DataFrame,
    detail: DataFrame,
    dim_customer: DataFrame,
    as_of: date,
) -> DataFrame:
    """Recompute the lifetime row of every customer with new orders, from all their orders; bring the other
    rows to the current customer version and day.

    Customers are matched on the looked-up key: if one unknown customer ordered, the unknown
    row is rebuilt from the orders of all unknown customers.
    """
    affected = with_customer_key(new_orders, dim_customer).select("customer_key").distinct()
    theirs = with_customer_key(header, dim_customer).join(affected, "customer_key", "left_semi")
    fresh = fact_customer_behavior(
        theirs.drop("customer_key"), details_of(theirs, detail), dim_customer, as_of
    )
    stored = current_behavior(behavior, dim_customer, as_of)
    return upsert(stored, fresh, ["fact_customer_behavior_key"], check=False)
