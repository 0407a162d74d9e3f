"""Dimension lookups: by key, and by key and date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: open-ended versions last until here.
FOREVER = "9999-12-31"


def lookup(df: DataFrame, dim: DataFrame, on: dict[str, str], take: list[str]) -> DataFrame:
    """Left join that adds the ``take`` columns of ``dim``; ``on`` maps df column to dim column.

    No broadcast hint: Spark broadcasts a dimension whose size is under its threshold and
    sort-merges a larger one, splitting hot keys at run time.
    """
    side = dim.selectExpr(
        *[f"`{right}` AS `_on_{left}`" for left, right in on.items()],
        *[f"`{c}` AS `_take_{c}`" for c in take],
    )
    condition = F.expr(" AND ".join(f"`{left}` = `_on_{left}`" for left in on))
    return df.join(side, condition, "left").selectExpr(
        *[f"`{c}`" for c in df.columns], *[f"`_take_{c}` AS `{c}`" for c in take]
    )


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def valid_on(day: str, start: str, end: str) -> str:
    """SQL test of half-open validity: from ``start`` up to but not on ``end``; NULL is open."""
    return f"{day} >= {start} AND {day} < coalesce({end}, DATE '{FOREVER}')"


def temporal_lookup(
    df: DataFrame, versions: DataFrame, on: tuple[str, str], day: str, take: list[str], how: str = "left"
) -> DataFrame:
    """Left join (or an ``inner`` or ``left_anti`` one) to the version of a dimension row that was valid on ``day``.

    The id is a plain equi key, so the join hashes or merges on it and the date range is a
    residual test; a day in a gap, or before the first version, gets NULLs. A row keeps its
    one match as long as versions of one id do not overlap (see ``overlapping_versions``).
    """
    left, right = on
    side = versions.selectExpr(
        f"`{right}` AS _id",
        "effective_date AS _from",
        "expiry_date AS _until",
        *[f"`{c}` AS `_take_{c}`" for c in take],
    )
    hit = F.expr(f"`{left}` = _id AND {valid_on(f'`{day}`', '_from', '_until')}")
    return df.join(side, hit, how).selectExpr(
        *[f"`{c}`" for c in df.columns], *[f"`_take_{c}` AS `{c}`" for c in take]
    )


def overlapping_versions(dim: DataFrame, key: str) -> DataFrame:
    """Versions that run past the start of the next one; empty for a sound history."""
    following = F.lead("effective_date").over(Window.partitionBy(key).orderBy("effective_date", "version"))
    return (
        dim.withColumn("next_effective_date", following)
        .filter(
            F.col("next_effective_date").isNotNull()
            & (F.coalesce("expiry_date", F.lit(FOREVER).cast("date")) > F.col("next_effective_date"))
        )
    )
