"""Exact decimal money; nothing here goes through double."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
RATE = "decimal(10,4)"
PERCENT = "decimal(5,2)"
# A sum of MONEY: ten more digits, so a key that holds a third of all rows cannot overflow.
MONEY_SUM = "decimal(28,4)"


def zero() -> Column:
    return F.lit(Decimal("0.0000")).cast(MONEY)


def line_revenue() -> Column:
    """Net value of an order line: unit price x quantity x (1 - discount), exact to its eight decimals.

    The operands are narrowed to what they need, else Spark would cut the product to six.
    """
    discount = F.coalesce(F.col("unit_price_discount"), F.lit(0).cast(RATE))
    kept = (F.lit(1) - discount).cast("decimal(6,4)")
    return F.col("unit_price").cast(MONEY) * F.col("order_qty").cast("decimal(10,0)") * kept


def mean(total: Column, n: Column) -> Column:
    """total / n as money, rounded half up; NULL for an empty group.

    The cast leaves 18 decimals to the quotient; from a full-width total Spark would keep 6,
    and rounding those again to 4 is not the same as rounding once.
    """
    return (total.cast("decimal(28,8)") / F.when(n != 0, n)).cast(MONEY)


def share(part: Column, whole: Column) -> Column:
    """part / whole as money; NULL where the whole is zero."""
    return (part.cast(MONEY_SUM) / F.nullif(whole.cast(MONEY_SUM), F.lit(0))).cast(MONEY)
