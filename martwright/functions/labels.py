"""Business labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits and names the reports depend on.
VIP_AMOUNT = 10000
VIP_ORDERS = 10
LOYAL_ORDERS = 5
LOST_AFTER_DAYS = 365
LOW_STOCK = 50
ABC_LIMITS = {"A": 80, "B": 95}
MARKETS = {"Individual": "B2C", "Store": "B2B"}


def rfm_segment(amount: Column, orders: Column, recency: Column) -> Column:
    """First rule that holds wins, so a loyal customer is never lost."""
    return (
        F.when((amount >= VIP_AMOUNT) & (orders >= VIP_ORDERS), "VIP")
        .when(orders >= LOYAL_ORDERS, "Loyal")
        .when(recency > LOST_AFTER_DAYS, "Lost")
        .otherwise("Regular")
    )


def market(customer_type: Column) -> Column:
    """B2C / B2B label; NULL for the unknown type."""
    rules = [F.when(customer_type == kind, label) for kind, label in MARKETS.items()]
    return F.coalesce(*rules)


def abc_class(running: Column, total: Column) -> Column:
    """Pareto class from the running total of revenue, most valuable first."""
    return (
        F.when(running * 100 <= total * ABC_LIMITS["A"], "A")
        .when(running * 100 <= total * ABC_LIMITS["B"], "B")
        .otherwise("C")
    )


def yes_no(flag: Column) -> Column:
    return F.when(flag, "Yes").otherwise("No")


def active_status(flag: Column) -> Column:
    return F.when(flag, "Active").otherwise("Inactive")


def full_name(*parts: str) -> Column:
    """Name parts joined by one blank; missing parts are skipped."""
    return F.concat_ws(" ", *parts)
