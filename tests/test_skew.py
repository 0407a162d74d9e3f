"""A key with a third of all rows: joins that carry raw lines must be split at run time, joins
on collapsed rows need not be. Sizes are scaled down; broadcast joins are off."""

import pytest
from pyspark.sql import functions as F

from martwright.plans import facts as f

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16",
}
LINES, KEYS = 300_000, 20_000


@pytest.fixture(scope="module")
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)

    def hot(salt):
        spread = F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(KEYS))
        return F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(spread).cast("long")

    def money(salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(10**6)).cast("decimal(18,4)")

    detail = spark.range(0, LINES, 1, 8).select(
        hot(1).alias("order_id"),
        F.col("id").cast("string").alias("order_detail_id"),
        hot(2).alias("product_id"),
        F.lit(2).alias("order_qty"),
        money(4).alias("unit_price"),
        F.lit(0).cast("decimal(10,4)").alias("unit_price_discount"),
        money(5).alias("line_total"),
    )
    header = spark.range(0, KEYS, 1, 4).select(
        F.col("id").alias("order_id"),
        hot(3).alias("customer_id"),
        F.when(F.col("id") % 3 != 0, F.col("id") % 50).alias("sales_person_id"),
        F.expr("DATE '2024-01-01'").alias("order_date"),
        F.lit("x").alias("sales_channel"),
        *[F.lit(1).cast("decimal(18,4)").alias(c) for c in ["sub_total", "tax_amt", "freight_amt", "total_due"]],
    )
    current = [F.expr("DATE '2000-01-01'").alias("effective_date"), F.expr("CAST(NULL AS DATE)").alias("expiry_date"), F.lit(True).alias("is_current")]
    product = spark.range(KEYS).select(
        F.concat(F.lit("p"), "id").alias("product_key"),
        F.col("id").alias("product_id"),
        F.lit(1).cast("decimal(18,4)").alias("standard_cost"),
        F.lit(1).cast("decimal(18,4)").alias("list_price"),
        *current,
    )
    customer = spark.range(KEYS).select(F.concat(F.lit("c"), "id").alias("customer_key"), F.col("id").alias("customer_id"), *current)
    seller = spark.range(50).select(
        F.concat(F.lit("s"), "id").alias("seller_key"),
        F.col("id").alias("seller_id"),
        F.lit(1).cast("decimal(5,2)").alias("commission_pct"),
        *current,
    )
    yield {"header": header, "detail": detail, "product": product, "customer": customer, "seller": seller}
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_order_and_hot_product_are_split(spark, skewed):
    places = spark.createDataFrame([], "geography_key string, address_id long")
    lines = f.fact_order(
        skewed["header"], skewed["detail"], skewed["customer"], skewed["product"], places, skewed["seller"]
    )
    assert final_plan(lines).count("SortMergeJoin(skew=true)") == 2
    assert lines.count() == LINES
    daily = f.fact_product_daily(skewed["header"], skewed["detail"], skewed["product"])
    assert final_plan(daily).count("SortMergeJoin(skew=true)") == 2
    assert daily.agg(F.sum("quantity_sold")).first()[0] == 2 * LINES


def test_hot_order_collapses_before_the_join(skewed):
    plan = final_plan(f.fact_order_daily(skewed["header"], skewed["detail"]))
    assert "skew=true" not in plan  # one row per order reaches the join
    row = f.fact_order_daily(skewed["header"], skewed["detail"]).first()
    assert row["daily_quantity"] == 2 * LINES


def test_known_products_are_summed_where_their_join_left_them(skewed):
    """After the product join no shuffle by order, version and day follows; unknown products, few here, have their own."""
    daily = f.fact_product_daily(skewed["header"], skewed["detail"], skewed["product"])
    plan = daily._jdf.queryExecution().executedPlan().toString()
    known = [x for x in plan.splitlines() if ":" in x[:24]]
    assert any("SortMergeJoin" in x and "Inner" in x for x in known)
    assert not [x for x in known if "hashpartitioning" in x and "product_key" in x]
    assert daily.agg(F.sum("quantity_sold")).first()[0] == 2 * LINES


def test_unknown_products_of_an_order_count_it_once(spark, skewed):
    """Two unknown products, one without an id, and one known: one row each for the day's unknown and known products."""
    line = skewed["detail"].limit(1)
    lines = [line.withColumns({"order_id": F.lit(7).cast("long"), "product_id": F.lit(p).cast("long")}) for p in (-5, -6, None, 9)]
    both = lines[0].unionByName(lines[1]).unionByName(lines[2]).unionByName(lines[3])
    rows = {r["product_key"]: r for r in f.fact_product_daily(skewed["header"], both, skewed["product"]).collect()}
    assert {k: (r["order_count"], r["quantity_sold"]) for k, r in rows.items()} == {"UNKNOWN": (1, 6), "p9": (1, 2)}
