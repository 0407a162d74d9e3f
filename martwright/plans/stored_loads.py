"""Loads from an order store: facts follow the places that differ from what they were last built from.

Each target keeps the store's digest tree as of its last load. A load compares the two, reads orders and lines of the
differing places only, and replaces what depends on them:

* order lines, orders and totals per order, stored by place, are replaced place by place;
* product sums are kept per place, and a product's day adds up its places;
* sellers, days and customers are added up from stored order totals of the months in question;
* a customer's lifetime adds up a state per customer and month. Of a changed month the old states give way to the new
  ones, and customers whose states differ get their lifetime from their states of all months.

Nothing reads lines or headers outside the differing places. A load that finds no difference reads no table of the store
but the tree. The tree is stored last, so a load that died is run again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.plans.facts import (
    PLACE,
    customer_parts,
    fact_order_daily,
    fact_seller_daily,
    keyed_orders,
    lifetimes,
    order_lines,
    order_totals,
    orders_of,
    product_days_of,
    product_parts_of,
    with_customer_key,
)
from martwright.plans.incremental import Build, current_behavior, of_months
from martwright.plans.order_store import OrderStore, Place, at_places, differing_places
from martwright.plans.refresh import month_slices
from martwright.schemas import conform, ddl
from martwright.session import estimated_bytes, fitted_shuffles, materialize, scratch_tables
from martwright.sources.parquet import read_places, read_table, read_version, replace_months, replace_places, write_version

# Facts stored by place; the day-grain ones are stored by month.
BY_PLACE = ["fact_order", "fact_order_header"]


def _months(places: list[Place]) -> list[int | None]:
    return sorted({m for m, _ in places}, key=str)


def load_stored_increment(store: OrderStore, root: str, table: str, build: Build) -> bool:
    """Bring one day-grain fact, stored by month, up to date with the store; False if nothing differs.

    Months that hold a differing place are rebuilt from their own orders and lines.
    """
    now = store.tree()
    if now is None:
        return False
    places = differing_places(now, read_version(store.spark, root, f"{table}_tree"))
    if not places:
        return False
    months = _months(places)
    orders, lines = store.of_months("orders", months), store.of_months("lines", months)
    with fitted_shuffles(orders, lines):
        replace_months(build(orders.drop(*PLACE), lines.drop(*PLACE)), root, table, months)
    write_version(now, root, f"{table}_tree")
    return True


def load_stored_facts(store: OrderStore, dims: dict[str, DataFrame], root: str, as_of: date) -> list[Place]:
    """Bring the five fact tables of orders and the customers' lifetime rows up to date; returns the places that differed."""
    with scratch_tables(store.spark):
        return _load_stored_facts(store, dims, root, as_of)


def _load_stored_facts(store: OrderStore, dims: dict[str, DataFrame], root: str, as_of: date) -> list[Place]:
    spark, now = store.spark, store.tree()
    if now is None:
        return []
    now = materialize(now, "tree")
    places = differing_places(now, read_version(spark, root, "loaded_tree"))
    behavior = read_version(spark, root, "fact_customer_behavior")
    if not places:
        if behavior is not None:
            write_version(materialize(current_behavior(behavior, dims["dim_customer"], as_of), "behavior"), root, "fact_customer_behavior")
        return []
    months = _months(places)
    # everything but the customers is of one month, so a long history is loaded slice by slice: only one slice's shuffles lie on disk
    for some in month_slices(months, estimated_bytes(store.lines(places)), most=len(months)):
        here = [(m, b) for m, b in places if m in some]
        orders, lines = store.orders(here), store.lines(here)
        with fitted_shuffles(orders, lines):
            _replace_places(orders, lines, dims, root, here)
            totals = of_months(read_places(spark, root, "order_totals"), some)
            parts = of_months(read_places(spark, root, "product_parts"), some)
            replace_months(product_days_of(parts), root, "fact_product_daily", some)
            replace_months(fact_seller_daily(None, None, dims["dim_seller"], totals), root, "fact_seller_daily", some)
            replace_months(fact_order_daily(None, None, totals), root, "fact_order_daily", some)
    totals = of_months(read_places(spark, root, "order_totals"), months)
    with fitted_shuffles(totals):
        fresh = _customers(spark, behavior, totals, dims["dim_customer"], root, months, as_of)
        write_version(fresh, root, "fact_customer_behavior")
        write_version(now, root, "loaded_tree")
    return places


def _replace_places(orders: DataFrame, lines: DataFrame, dims: dict[str, DataFrame], root: str, places: list[Place]) -> None:
    """Everything that is stored by place, from the orders and lines of these places."""
    dim_product, spark = dims["dim_product"], orders.sparkSession
    sums = order_totals(lines).join(orders.select("order_id", "order_date", "customer_id", "sales_person_id", *PLACE), "order_id")
    replace_places(sums, root, "order_totals", places, PLACE)
    keyed = materialize(keyed_orders(orders, dims["dim_customer"], dims["dim_geography"], dims["dim_seller"]), "keyed_orders")
    replace_places(order_lines(keyed, lines, dim_product, PLACE), root, "fact_order", places, PLACE)

    def stored(table: str) -> DataFrame:
        return at_places(read_places(spark, root, table), places)

    replace_places(orders_of(keyed, stored("order_totals"), PLACE), root, "fact_order_header", places, PLACE)
    replace_places(product_parts_of(stored("fact_order"), dim_product, PLACE), root, "product_parts", places, PLACE)


def _customers(
    spark: SparkSession,
    behavior: DataFrame | None,
    totals: DataFrame,
    dim_customer: DataFrame,
    root: str,
    months: list[int | None],
    as_of: date,
) -> DataFrame:
    """Lifetime rows after the customers' states of these months changed."""
    fresh = materialize(customer_parts(totals, ["month_key"]), "customer_months")
    if behavior is None:
        changed = None
    else:
        # a state that is in one of the two only has changed; both sides are of these months
        old = of_months(read_places(spark, root, "customer_months"), months).select(*fresh.columns)
        sides = fresh.withColumn("_n", F.lit(1)).unionByName(old.withColumn("_n", F.lit(-1)))
        changed = sides.groupBy(*fresh.columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0").select("customer_id").distinct()
        changed = materialize(changed, "changed_customers")
    replace_places(fresh, root, "customer_months", [(m,) for m in months], ["month_key"])
    states = read_places(spark, root, "customer_months")
    if changed is None:
        return materialize(lifetimes(states, dim_customer, as_of), "behavior")
    # unknown customers are one row: if one of them changed, the states of all of them count
    keys = with_customer_key(changed, dim_customer).select("customer_key").distinct()
    theirs = with_customer_key(states, dim_customer).join(keys, "customer_key", "left_semi").drop("customer_key")
    kept = current_behavior(behavior, dim_customer, as_of).join(keys, "customer_key", "left_anti")
    return materialize(kept.unionByName(lifetimes(theirs, dim_customer, as_of)), "behavior")


def stored_fact(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A fact that ``load_stored_facts`` keeps."""
    if table == "fact_customer_behavior":
        return conform(read_version(spark, root, table), table)
    df = read_places(spark, root, table) if table in BY_PLACE else read_table(spark, root, table, f"{ddl(table)}, month_key int")
    return conform(df, table)


