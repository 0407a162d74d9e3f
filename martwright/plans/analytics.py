"""Reports over the gold tables.

Header amounts repeat on every line of ``fact_order``; reports that add them up read the order-grain
``fact_order_header``, so an order counts once. A customer or product has one key per version: reports that
count or match them go by ``customer_id`` and ``product_id``. Top-k reports break ties by name or id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.keys import UNKNOWN_ID
from martwright.functions.labels import LOW_STOCK, MARKETS, abc_class, market
from martwright.functions.money import MONEY, MONEY_SUM, share
from martwright.operators.ordering import exact_quantile, running_total, top


def run_query(
    spark: SparkSession, text: str, tables: dict[str, DataFrame], args: dict[str, object] | None = None
) -> DataFrame:
    """Run SQL over gold tables: ``{table}`` in the text names a table, ``:name`` a parameter."""
    return spark.sql(text, args=args, **tables)


def _money(column: str) -> Column:
    return F.sum(column).cast(MONEY_SUM)


def sales_kpis(fact_product_daily: DataFrame, fact_order_daily: DataFrame) -> DataFrame:
    """Revenue, profit, margin in percent, and orders.

    ``product_order_count`` adds up orders per product, so an order with k products counts
    k times; ``total_orders`` counts each order once, on its one day.
    """
    daily = fact_product_daily.agg(
        F.coalesce(_money("revenue"), F.lit(0).cast(MONEY_SUM)).alias("total_revenue"),
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("product_order_count"),
        F.coalesce(_money("gross_profit"), F.lit(0).cast(MONEY_SUM)).alias("total_profit"),
    )
    orders = fact_order_daily.agg(F.coalesce(F.sum("daily_order_count"), F.lit(0)).alias("total_orders"))
    # two one-row frames made one
    both = daily.unionByName(orders, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in [*daily.columns, *orders.columns]]
    )
    margin = F.coalesce(share(F.col("total_profit") * 100, F.col("total_revenue")), F.lit(0).cast(MONEY))
    return both.withColumn(
        "profit_margin", F.when(F.col("total_revenue") > 0, margin).otherwise(F.lit(0).cast(MONEY))
    )


def daily_trend(fact_product_daily: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue and profit per day, in date order. A day that the calendar lacks fails the report, and sales
    without a day come first: neither leaves the trend in silence."""
    per_day = fact_product_daily.groupBy("date_key").agg(
        _money("revenue").alias("revenue"), _money("gross_profit").alias("profit")
    )
    known = per_day.join(dim_date, "date_key", "left")
    outside = F.raise_error(F.concat(F.lit("sales on a day outside the calendar: "), F.col("date_key").cast("string")))
    day = F.when(F.col("full_date").isNull() & F.col("date_key").isNotNull(), outside.cast("date")).otherwise(F.col("full_date"))
    return known.select(day.alias("full_date"), "year", "month", "revenue", "profit").orderBy("full_date")


def _typed_orders(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    customers = dim_customer.filter(F.col("customer_type").isin(*MARKETS))
    return orders.join(customers.select("customer_key", "customer_type"), "customer_key")


def order_value_by_type(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders, revenue and average order value of individuals and stores."""
    df = _typed_orders(orders, dim_customer).groupBy("customer_type").agg(
        F.count("*").alias("total_orders"), _money("total_due").alias("total_revenue")
    )
    return df.select(
        "customer_type",
        market(F.col("customer_type")).alias("market"),
        "total_orders",
        "total_revenue",
        share(F.col("total_revenue"), F.col("total_orders")).alias("avg_order_value"),
    )


def revenue_by_type(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    df = _typed_orders(orders, dim_customer).groupBy("customer_type").agg(
        _money("total_due").alias("total_revenue")
    )
    return df.select("customer_type", market(F.col("customer_type")).alias("market"), "total_revenue")


def top_products(fact_product_daily: DataFrame, dim_product: DataFrame, k: int = 10) -> DataFrame:
    """Best products by revenue. Sums per version first, so the name join sees few rows."""
    per_version = fact_product_daily.groupBy("product_key").agg(
        F.sum("revenue").alias("revenue"), F.sum("quantity_sold").alias("quantity")
    )
    named = per_version.join(dim_product.select("product_key", "product_name"), "product_key")
    totals = named.groupBy("product_name").agg(
        _money("revenue").alias("total_revenue"), F.sum("quantity").alias("total_quantity")
    )
    return top(totals, k, F.desc("total_revenue"), F.asc("product_name"))


def revenue_by_country(orders: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Amount due per country, highest first."""
    per_place = orders.groupBy("geography_key").agg(F.sum("total_due").alias("due"))
    return (
        per_place.join(dim_geography.select("geography_key", "country_name"), "geography_key")
        .groupBy("country_name")
        .agg(_money("due").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "country_name")
    )


def _ids(dim: DataFrame, key: str, id: str) -> DataFrame:
    """The business id behind every version's key."""
    return dim.select(key, id)


def stock_and_sales(
    dim_product: DataFrame, fact_inventory: DataFrame, fact_product_daily: DataFrame
) -> DataFrame:
    """Stock and units sold of every current product, over all its versions, zero where there are none."""
    ids = _ids(dim_product, "product_key", "product_id")

    def per_product(fact: DataFrame, column: str, name: str) -> DataFrame:
        per_version = fact.groupBy("product_key").agg(F.sum(column).alias("n"))
        return per_version.join(ids, "product_key").groupBy("product_id").agg(F.sum("n").alias(name))

    return (
        dim_product.filter(F.col("is_current") & (F.col("product_id") != UNKNOWN_ID))
        .select("product_id", "product_name")
        .join(per_product(fact_inventory, "quantity", "current_stock"), "product_id", "left")
        .join(per_product(fact_product_daily, "quantity_sold", "total_sold"), "product_id", "left")
        .select(
            "product_id",
            "product_name",
            F.coalesce("current_stock", F.lit(0)).alias("stock"),
            F.coalesce("total_sold", F.lit(0)).alias("sold"),
        )
    )


def lowest_stocks(stock: DataFrame, k: int = 20) -> DataFrame:
    return top(stock, k, F.asc("stock"), F.asc("product_id"))


def low_stock_alert(stock: DataFrame, limit: int = LOW_STOCK) -> DataFrame:
    """Products under the limit. Over ``lowest_stocks`` it looks at those rows only; over
    ``stock_and_sales`` it finds every such product."""
    return stock.filter(F.col("stock") < limit)


def segment_summary(fact_customer_behavior: DataFrame) -> DataFrame:
    return fact_customer_behavior.groupBy("customer_segment").agg(
        F.count("customer_key").alias("num_customers"), _money("total_amount").alias("total_revenue")
    )


def top_regions(orders: DataFrame, dim_geography: DataFrame, dim_customer: DataFrame, k: int = 15) -> DataFrame:
    """Best states by amount due, with their distinct customers."""
    places = dim_geography.select("geography_key", "country_name", "state_name")
    per_place = orders.groupBy("geography_key", "customer_key").agg(F.sum("total_due").alias("due"))
    regions = (
        per_place.join(places, "geography_key")
        .join(_ids(dim_customer, "customer_key", "customer_id"), "customer_key")
        .groupBy("country_name", "state_name", "customer_id")
        .agg(F.sum("due").alias("due"))
        .groupBy("country_name", "state_name")
        .agg(_money("due").alias("total_revenue"), F.count("customer_id").alias("num_customers"))
    )
    return top(regions, k, F.desc("total_revenue"), F.asc("country_name"), F.asc("state_name"))


def rfm_scatter(fact_customer_behavior: DataFrame, q: float = 0.99) -> DataFrame:
    """Buying customers below the given quantile of amount."""
    buyers = fact_customer_behavior.filter("total_amount > 0")
    bound = exact_quantile(buyers, "total_amount", q)
    return buyers.filter(F.col("total_amount").cast("double") < F.lit(bound)).select(
        "fact_customer_behavior_key", "customer_segment", "recency_days", "total_orders", "total_amount"
    )


def top_sellers(fact_seller_daily: DataFrame, dim_seller: DataFrame, k: int = 10) -> DataFrame:
    """Best sellers by revenue, without the unknown seller."""
    per_version = fact_seller_daily.groupBy("seller_key").agg(
        F.sum("revenue").alias("revenue"), F.sum("order_count").alias("orders")
    )
    named = per_version.join(
        dim_seller.filter(F.col("seller_id") != UNKNOWN_ID).select("seller_key", "seller_name"),
        "seller_key",
    )
    totals = named.groupBy("seller_name").agg(
        _money("revenue").alias("total_revenue"), F.sum("orders").alias("total_orders")
    )
    return top(totals, k, F.desc("total_revenue"), F.asc("seller_name"))


def _of_seller(fact: DataFrame, dim_seller: DataFrame, seller_name: str) -> DataFrame:
    """Fact rows of one seller, all versions; the name filter prunes the fact early."""
    chosen = dim_seller.filter(F.col("seller_name") == seller_name).select("seller_key")
    return fact.join(chosen, "seller_key", "left_semi")


def seller_territories(
    orders: DataFrame, dim_seller: DataFrame, dim_geography: DataFrame, seller_name: str, k: int = 5
) -> DataFrame:
    """One seller's best countries."""
    per_place = _of_seller(orders, dim_seller, seller_name).groupBy("geography_key").agg(F.sum("total_due").alias("due"))
    totals = (
        per_place.join(dim_geography.select("geography_key", "country_name"), "geography_key")
        .groupBy(F.col("country_name").alias("territory"))
        .agg(_money("due").alias("revenue"))
    )
    return top(totals, k, F.desc("revenue"), F.asc("territory"))


def seller_segments(
    orders: DataFrame,
    dim_seller: DataFrame,
    dim_customer: DataFrame,
    fact_customer_behavior: DataFrame,
    seller_name: str,
) -> DataFrame:
    """One seller's customers and revenue by customer segment; any version of a customer finds the segment."""
    ids = _ids(dim_customer, "customer_key", "customer_id")
    per_version = _of_seller(orders, dim_seller, seller_name).groupBy("customer_key").agg(F.sum("total_due").alias("due"))
    per_customer = per_version.join(ids, "customer_key").groupBy("customer_id").agg(F.sum("due").alias("due"))
    segments = fact_customer_behavior.join(ids, "customer_key").select("customer_id", "customer_segment")
    return (
        per_customer.join(segments, "customer_id")
        .groupBy("customer_segment")
        .agg(F.count("*").alias("num_customers"), _money("due").alias("revenue"))
    )


def category_by_country(
    fact_order: DataFrame, dim_product: DataFrame, dim_geography: DataFrame
) -> DataFrame:
    """Line revenue per product category and country.

    Both names are looked up on the lines, so that what is shuffled are sums per pair of names and task;
    pairs of product and address would be nearly as many as the lines.
    """
    return (
        fact_order.select("product_key", "geography_key", "line_total")
        .join(dim_product.select("product_key", "category_name"), "product_key")
        .join(dim_geography.select("geography_key", "country_name"), "geography_key")
        .groupBy("country_name", "category_name")
        .agg(_money("line_total").alias("total_revenue"))
    )


def seller_top_products(
    fact_order: DataFrame, dim_seller: DataFrame, dim_product: DataFrame, seller_name: str, k: int = 5
) -> DataFrame:
    """One seller's best products by line revenue, with the orders that hold them."""
    lines = _of_seller(fact_order, dim_seller, seller_name)
    per_order = lines.groupBy("product_key", "order_id").agg(F.sum("line_total").alias("amount"))
    named = per_order.join(dim_product.select("product_key", "product_name"), "product_key")
    totals = (
        named.groupBy("product_name", "order_id")
        .agg(F.sum("amount").alias("amount"))
        .groupBy("product_name")
        .agg(_money("amount").alias("revenue"), F.count("*").alias("num_orders"))
    )
    return top(totals, k, F.desc("revenue"), F.asc("product_name"))


def abc_classes(fact_product_daily: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Products by falling revenue with their running share: A, B and C."""
    per_version = fact_product_daily.groupBy("product_key").agg(F.sum("revenue").alias("revenue"))
    ids = dim_product.select("product_key", "product_id")
    products = (
        per_version.join(ids, "product_key").groupBy("product_id").agg(_money("revenue").alias("revenue"))
    )
    order = [F.desc("revenue"), F.asc("product_id")]
    ranked = running_total(products, order, F.col("revenue"), "running")
    return ranked.select(
        "product_id",
        "revenue",
        F.col("running").cast(MONEY_SUM).alias("running_revenue"),
        abc_class(F.col("running"), F.col("running_total")).alias("abc_class"),
    )
