"""Fact builders: conformed orders, lines and stock to gold facts.

Headers are unique per ``order_id`` and lines per ``order_detail_id`` (the conformed tables
guarantee it). Where a fact needs only sums per order, lines collapse per order before any
join; distinct counts come from grouping at the finer grain first, so every shuffle carries
partial sums and no hot order, day, customer, seller or product reaches one task raw.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.calendar import date_key
from martwright.functions.keys import UNKNOWN_KEY, or_unknown, pack_keys, surrogate_key, unpack_keys
from martwright.functions.labels import rfm_segment
from martwright.functions.money import MONEY_SUM, line_revenue, mean, zero
from martwright.operators.lookup import current_rows, lookup, temporal_lookup
from martwright.schemas import conform

# Revenue summed per order: price and discount have four decimals each. Rounded only in the day's total.
_ORDER_REVENUE = "decimal(26,8)"
# Where a stored order or line lies: its month, and a bucket of its order id.
PLACE = ["month_key", "bucket"]


def _total(column: str, kind: str) -> Column:
    return F.sum(column).cast(kind)


def order_totals(detail: DataFrame) -> DataFrame:
    """Per order: quantity, line amounts and net revenue, with their line counts.

    The seller, order and customer facts all start from these; a load that builds several of
    them stores the totals once and passes them on, so the lines are read and shuffled once.
    """
    return detail.groupBy("order_id").agg(
        F.sum("order_qty").alias("quantity"),
        F.sum("line_total").alias("amount"),
        F.count("line_total").alias("amount_lines"),
        F.sum(line_revenue()).cast(_ORDER_REVENUE).alias("revenue"),
        F.count(line_revenue()).alias("revenue_lines"),
    )


def _orders_with_totals(
    header: DataFrame | None, detail: DataFrame | None, columns: list[str], totals: DataFrame | None
) -> DataFrame:
    """Orders with lines and their totals; without a header the stored totals carry its columns themselves."""
    if header is None:
        return totals
    return header.select("order_id", *columns).join(
        order_totals(detail) if totals is None else totals, "order_id"
    )


def fact_order(
    header: DataFrame,
    detail: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_geography: DataFrame,
    dim_seller: DataFrame,
) -> DataFrame:
    """One row per order line; header amounts repeat on each line of the order.

    Customer, seller and address are looked up on the headers, before these meet the much
    larger line table; only the product needs the line. The product version is the one that
    was valid on the order date, the others are the current rows.
    """
    return order_lines(keyed_orders(header, dim_customer, dim_geography, dim_seller), detail, dim_product)


def keyed_orders(header: DataFrame, dim_customer: DataFrame, dim_geography: DataFrame, dim_seller: DataFrame) -> DataFrame:
    """Headers with day and the keys of the current customer, seller and address, or the unknown members."""
    orders = header if "address_id" in header.columns else header.withColumn(
        "address_id", F.lit(None).cast("bigint")
    )
    orders = lookup(orders, current_rows(dim_customer), {"customer_id": "customer_id"}, ["customer_key"])
    orders = lookup(orders, current_rows(dim_seller), {"sales_person_id": "seller_id"}, ["seller_key"])
    orders = lookup(orders, dim_geography, {"address_id": "address_id"}, ["geography_key"])
    keys = {k: or_unknown(k) for k in ("customer_key", "seller_key", "geography_key")}
    return orders.withColumns({**keys, "date_key": date_key("order_date")})


def order_lines(keyed: DataFrame, detail: DataFrame, dim_product: DataFrame, place: list[str] | None = None) -> DataFrame:
    """``fact_order`` from keyed headers and their lines, with the ``place`` columns of the header.

    The header's keys go along with every line to its product, so they travel packed; the day's key follows from the date.
    Lines that bring their ``order_date`` meet the product first, and only its key goes along with them to the wider header.
    """
    elsewhere, of_order = [c for c in PLACE if c not in (place or [])], ["customer_key", "seller_key", "geography_key"]
    orders = pack_keys(keyed.drop("product_id", "ingested_at", "date_key", *elsewhere), of_order)
    version = (("product_id", "product_id"), "order_date", ["product_key"])
    if "order_date" in detail.columns:
        priced = temporal_lookup(detail.drop(*PLACE), pack_keys(dim_product, ["product_key"]), *version)
        lines = unpack_keys(orders.join(priced.drop("order_date"), "order_id"), ["product_key"])
    else:
        lines = temporal_lookup(orders.join(detail.drop(*PLACE), "order_id"), dim_product, *version)
    keys = {"product_key": or_unknown("product_key"), "fact_order_key": surrogate_key("order_detail_id")}
    rows = unpack_keys(lines, of_order).withColumns({**keys, "date_key": date_key("order_date")})
    return conform(rows, "fact_order", keep=place)


def orders_of(keyed: DataFrame, totals: DataFrame, place: list[str] | None = None) -> DataFrame:
    """``fact_order_header`` from keyed headers: those whose order ``totals`` (or stored lines) know, with their ``place`` columns."""
    return conform(keyed.join(totals.select("order_id"), "order_id", "left_semi"), "fact_order_header", keep=place)


def fact_order_header(fact_order: DataFrame) -> DataFrame:
    """One row per order, from its stored lines, which repeat the header. Lines of an order collapse map-side."""
    return conform(fact_order, "fact_order_header").distinct()


def _product_days(priced: DataFrame) -> DataFrame:
    """Aggregate lines that already carry ``date_key``, ``product_key`` and the version's prices.

    Lines collapse per order first, which counts each order once. Within one version cost and
    list price are constant, so their average over lines is their value; lines of unknown
    products have none.
    """
    return product_days_of(product_parts(priced, []))


def product_parts(priced: DataFrame, place: list[str]) -> DataFrame:
    """Sums per product version, day and ``place`` of its orders. An order lies in one place, so orders add up, too."""
    cost = F.coalesce("standard_cost", zero())
    per_order = priced.groupBy("order_id", "date_key", "product_key", *place).agg(
        F.sum("order_qty").alias("quantity"),
        F.sum("line_total").alias("amount"),
        F.sum((F.col("unit_price") - cost) * F.col("order_qty")).cast(MONEY_SUM).alias("profit"),
        F.max("standard_cost").alias("standard_cost"),
        F.max("list_price").alias("list_price"),
    )
    return per_order.groupBy("date_key", "product_key", *place).agg(
        _total("quantity", "bigint").alias("quantity"),
        _total("amount", MONEY_SUM).alias("amount"),
        _total("profit", MONEY_SUM).alias("profit"),
        F.count("*").alias("orders"),
        F.max("standard_cost").alias("standard_cost"),
        F.max("list_price").alias("list_price"),
    )


def product_days_of(parts: DataFrame) -> DataFrame:
    """``fact_product_daily`` from the sums of places; each day must be there with all its places."""
    return _daily_rows(
        parts.groupBy("date_key", "product_key").agg(
            _total("quantity", "bigint").alias("quantity"),
            _total("amount", MONEY_SUM).alias("amount"),
            _total("profit", MONEY_SUM).alias("profit"),
            _total("orders", "bigint").alias("orders"),
            F.max("standard_cost").alias("standard_cost"),
            F.max("list_price").alias("list_price"),
        )
    )


def _daily_rows(days: DataFrame) -> DataFrame:
    """``fact_product_daily`` from one row of sums per day and product version."""
    names = {
        "quantity": "quantity_sold",
        "amount": "revenue",
        "profit": "gross_profit",
        "orders": "order_count",
        "standard_cost": "avg_standard_cost",
        "list_price": "avg_list_price",
    }
    return conform(
        days.withColumnsRenamed(names).withColumn("fact_product_daily_key", surrogate_key("date_key", "product_key")),
        "fact_product_daily",
    )


def fact_product_daily(header: DataFrame, detail: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Product version and day: quantity, revenue, profit before discount, orders, price snapshot.

    All versions of a product take part; the one valid on the order date gives key and cost. A known product's lines
    are added up by its id, where the product join has left them, so they are not shuffled for order, version and day
    again. Lines of unknown products become one row per day, whatever their ids, and are added up apart.
    """
    sales = header.select("order_id", "order_date").join(detail, "order_id")
    take, on = ["product_key", "standard_cost", "list_price"], ("product_id", "product_id")
    sold, member = dim_product.filter(F.col("product_key") != UNKNOWN_KEY), dim_product.filter(F.col("product_key") == UNKNOWN_KEY)
    known = temporal_lookup(sales, sold, on, "order_date", take, "inner")
    # the versions of a partition are hashed, so that the lines of this second look need no second sort
    unknown = temporal_lookup(sales, sold.hint("shuffle_hash"), on, "order_date", [], "left_anti")
    unknown = temporal_lookup(unknown, member, on, "order_date", take).withColumn("product_key", or_unknown("product_key"))
    day = date_key("order_date").alias("date_key")
    known_days = product_parts(known.withColumn("date_key", day), ["product_id"]).drop("product_id")
    return _daily_rows(known_days).unionByName(_product_days(unknown.withColumn("date_key", day)))


def product_daily_of(fact_order: DataFrame, dim_product: DataFrame) -> DataFrame:
    """``fact_product_daily`` from stored order lines, which know their day and version already:
    neither the order join nor the date-range join is repeated."""
    return _daily_rows(product_parts_of(fact_order, dim_product, []))


def product_parts_of(fact_order: DataFrame, dim_product: DataFrame, place: list[str]) -> DataFrame:
    """``product_parts`` of stored order lines. Lines of known products are added up where the join with their version left
    them. Those of unknown ones share one key: they need no join, and are dealt by order, so that no task holds them all."""
    known, take = F.col("product_key") != UNKNOWN_KEY, ["standard_cost", "list_price"]
    versions = pack_keys(dim_product.filter(known).select("product_key", *take), ["product_key"])
    lines = fact_order.select("order_id", "date_key", "product_key", *place, "order_qty", "line_total", "unit_price")
    priced = lookup(pack_keys(lines.filter(known), ["product_key"]), versions, {"product_key": "product_key"}, take)
    others = lines.filter(F.coalesce(~known, F.lit(True))).withColumns({c: F.lit(None).cast(dim_product.schema[c].dataType) for c in take})
    return unpack_keys(product_parts(priced, place), ["product_key"]).unionByName(product_parts(others, place))


def fact_seller_daily(
    header: DataFrame | None, detail: DataFrame | None, dim_seller: DataFrame, totals: DataFrame | None = None
) -> DataFrame:
    """Seller and day: orders, customers, quantity, net revenue and commission earned."""
    orders = _orders_with_totals(header, detail, ["order_date", "customer_id", "sales_person_id"], totals)
    orders = lookup(
        orders,
        current_rows(dim_seller),
        {"sales_person_id": "seller_id"},
        ["seller_key", "commission_pct"],
    )
    percent = F.coalesce("commission_pct", F.lit(0).cast("decimal(5,2)"))
    commission = F.col("revenue") * percent * F.lit(Decimal("0.01"))
    per_customer = orders.groupBy(
        date_key("order_date").alias("date_key"), or_unknown("seller_key").alias("seller_key"), "customer_id"
    ).agg(
        F.count("*").alias("orders"),
        F.sum("quantity").alias("quantity"),
        F.sum("revenue").alias("revenue"),
        F.sum(commission).alias("commission"),
    )
    daily = per_customer.groupBy("date_key", "seller_key").agg(
        _total("orders", "bigint").alias("order_count"),
        F.count("customer_id").alias("customer_count"),
        _total("quantity", "bigint").alias("quantity_sold"),
        _total("revenue", MONEY_SUM).alias("revenue"),
        _total("commission", MONEY_SUM).alias("commission_earned"),
    )
    return conform(
        daily.withColumn("fact_seller_daily_key", surrogate_key("date_key", "seller_key")),
        "fact_seller_daily",
    )


def fact_order_daily(header: DataFrame | None, detail: DataFrame | None, totals: DataFrame | None = None) -> DataFrame:
    """Day: orders, customers, quantity, net revenue; average per line and per order."""
    orders = _orders_with_totals(header, detail, ["order_date", "customer_id"], totals)
    per_customer = orders.groupBy(date_key("order_date").alias("date_key"), "customer_id").agg(
        F.count("*").alias("orders"),
        F.sum("quantity").alias("quantity"),
        F.sum("revenue").alias("revenue"),
        F.sum("revenue_lines").alias("lines"),
    )
    daily = per_customer.groupBy("date_key").agg(
        _total("orders", "bigint").alias("daily_order_count"),
        F.count("customer_id").alias("daily_customer_count"),
        _total("quantity", "bigint").alias("daily_quantity"),
        _total("revenue", MONEY_SUM).alias("daily_revenue"),
        mean(F.sum("revenue"), F.sum("lines")).alias("average_order_value"),
        mean(F.sum("revenue"), F.sum("orders")).alias("avg_order_total"),
    )
    return conform(
        daily.withColumn("fact_order_daily_key", surrogate_key("date_key")), "fact_order_daily"
    )


def fact_inventory(inventory: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Stock per product and location, with the current product version."""
    stock = lookup(inventory, current_rows(dim_product), {"product_id": "product_id"}, ["product_key"])
    keyed = stock.withColumns(
        {
            "fact_inventory_key": surrogate_key("product_id", "location_id"),
            "product_key": or_unknown("product_key"),
        }
    )
    return conform(keyed, "fact_inventory")


def with_customer_key(header: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Headers with the key of the current customer row, or the unknown member."""
    df = lookup(header, current_rows(dim_customer), {"customer_id": "customer_id"}, ["customer_key"])
    return df.withColumn("customer_key", or_unknown("customer_key"))


def fact_customer_behavior(
    header: DataFrame,
    detail: DataFrame,
    dim_customer: DataFrame,
    as_of: date,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Lifetime totals and segment per customer as of a day; all unknown customers are one row.

    The row key hashes the customer id, so a new version of the customer updates the row
    instead of adding a second one.
    """
    orders = _orders_with_totals(header, detail, ["order_date", "customer_id"], totals)
    return lifetimes(customer_parts(orders, []), dim_customer, as_of)


def customer_parts(orders: DataFrame, by: list[str]) -> DataFrame:
    """Sums per customer (and month, say) of orders with totals: a state that adds up, with the first and last purchase in it."""
    return orders.groupBy("customer_id", *by).agg(
        F.count("*").alias("orders"),
        F.sum("quantity").cast("bigint").alias("quantity"),
        F.sum("amount").cast(MONEY_SUM).alias("amount"),
        F.sum("amount_lines").alias("lines"),
        F.min("order_date").alias("first_purchase"),
        F.max("order_date").alias("last_purchase"),
    )


def lifetimes(parts: DataFrame, dim_customer: DataFrame, as_of: date) -> DataFrame:
    """``fact_customer_behavior`` from the states of whole customers, however many parts each has."""
    sums = {"orders": "bigint", "quantity": "bigint", "amount": MONEY_SUM, "lines": "bigint"}
    per_customer = parts.groupBy("customer_id").agg(
        *[_total(c, kind).alias(c) for c, kind in sums.items()],
        F.min("first_purchase").alias("first_purchase"),
        F.max("last_purchase").alias("last_purchase"),
    )
    known = with_customer_key(per_customer, dim_customer)
    # one group per known customer; only the unknown ids still have to be merged
    identity = F.when(F.col("customer_key") != UNKNOWN_KEY, F.col("customer_id").cast("string")).otherwise(
        F.lit(UNKNOWN_KEY)
    )
    lifetime = known.groupBy(identity.alias("identity"), "customer_key").agg(
        *[_total(c, kind).alias(c) for c, kind in sums.items()],
        F.min("first_purchase").alias("first_purchase"),
        F.max("last_purchase").alias("last_purchase"),
    )
    recency = F.datediff(F.lit(as_of), "last_purchase")
    return conform(
        lifetime.select(
            surrogate_key("identity").alias("fact_customer_behavior_key"),
            "customer_key",
            F.col("orders").alias("total_orders"),
            F.col("quantity").alias("total_quantity"),
            F.col("amount").alias("total_amount"),
            mean(F.col("amount"), F.col("lines")).alias("avg_order_value"),
            mean(F.col("amount"), F.col("orders")).alias("avg_order_total"),
            "first_purchase",
            "last_purchase",
            recency.alias("recency_days"),
            rfm_segment(F.col("amount"), F.col("orders"), recency).alias("customer_segment"),
        ),
        "fact_customer_behavior",
    )
