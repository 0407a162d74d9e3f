"""Global order without a global task: running totals, positions, exact quantiles, top-k."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.session import materialize


def running_total(df: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """Add ``name``, the sum of ``value`` up to and including each row in a global order,
    and ``name``_total, the sum over all rows. ``order`` must be unique per row.

    Rows are range-partitioned on the whole order (so a value shared by many rows still
    spreads), numbered by range and written once, which fixes the ranges. Each range then
    gets its own window; what one range owes the next is one number, so the table of
    offsets has as many rows as there are ranges and is safe to broadcast.
    """
    ranged = materialize(
        df.withColumn("_value", value)
        .repartitionByRange(*order)
        .withColumn("_range", F.spark_partition_id()),
        "ranged",
    )
    sums = ranged.groupBy("_range").agg(F.sum("_value").alias("_sum"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = sums.select(
        "_range",
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(everything).alias(f"{name}_total"),
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("_inside", F.sum("_value").over(inside))
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_offset") + F.col("_inside"))
        .drop("_range", "_value", "_inside", "_offset")
    )


def position_key(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: 1, 2, 3 … over the whole frame in the given unique order."""
    numbered = running_total(df, order, F.lit(1).cast("bigint"), name)
    return numbered.drop(f"{name}_total").withColumn(name, F.col(name).cast("int"))


def exact_quantile(df: DataFrame, column: str, q: float) -> float | None:
    """Linearly interpolated quantile over all non-NULL values, or None if there are none.

    Equal values are counted before anything is sorted; only the two neighbouring values
    that the interpolation needs come back to the driver.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    ranked = running_total(counts, [F.col(column)], F.col("_n"), "_upto")
    place = (F.col("_upto_total") - 1) * F.lit(q)
    # zero-based positions of this value: [_upto - _n, _upto)
    near = ranked.filter(
        (F.col("_upto") > F.floor(place)) & (F.col("_upto") - F.col("_n") <= F.ceil(place))
    )
    rows = near.select(F.col(column).cast("double").alias("v"), "_upto", "_upto_total").orderBy("v").take(2)
    if not rows:
        return None
    exact = (rows[0]["_upto_total"] - 1) * q
    low = rows[0]["v"]
    high = low if math.ceil(exact) < rows[0]["_upto"] else rows[-1]["v"]
    return low + (high - low) * (exact - math.floor(exact))


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows in a unique order; Spark keeps k rows per task, never a full sort."""
    return df.orderBy(*order).limit(k)
