"""JDBC scans and sinks. Credentials come from the caller, never from this package."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Split:
    """How a scan is cut into parallel range queries on a numeric, date or timestamp column.

    Rows outside the bounds, and NULLs, still arrive: the first and last range are open.
    """

    column: str
    lower: object
    upper: object
    partitions: int


def is_query(table_or_query: str) -> bool:
    return table_or_query.lstrip().lower().startswith(("(", "select ", "with "))


def as_relation(table_or_query: str) -> str:
    """A table name as it is, a query as a derived table."""
    text = table_or_query.strip()
    if not is_query(text) or text.startswith("("):
        return text
    return f"({text}) src"


def scan_options(
    url: str,
    table_or_query: str,
    properties: dict[str, str] | None = None,
    split: Split | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    options = {"url": url, "dbtable": as_relation(table_or_query), "fetchsize": str(fetch_size)}
    if split:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options | (properties or {})


def read_jdbc(
    spark: SparkSession,
    url: str,
    table_or_query: str,
    properties: dict[str, str] | None = None,
    split: Split | None = None,
) -> DataFrame:
    """Scan a table, or the result of a query, that the database filters and projects itself.

    Filters and column choices made on the frame are pushed down as well.
    """
    return spark.read.format("jdbc").options(**scan_options(url, table_or_query, properties, split)).load()


def split_by(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> Split | None:
    """Ask the database for the bounds of ``column``; None for an empty table."""
    bounds = read_jdbc(spark, url, table, properties).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    row = bounds.first()
    return None if row["lo"] is None else Split(column, row["lo"], row["hi"], partitions)


def sink_options(
    url: str, table: str, properties: dict[str, str] | None, truncate: bool, connections: int | None
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": "10000", "truncate": str(truncate).lower()}
    if connections:
        options["numPartitions"] = str(connections)
    return options | (properties or {})


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    connections: int | None = None,
) -> None:
    """Append rows; ``connections`` caps the parallel writers the database sees."""
    options = sink_options(url, table, properties, False, connections)
    df.write.format("jdbc").options(**options).mode("append").save()


def overwrite_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    connections: int | None = None,
) -> None:
    """Replace the rows but keep the table, its types, indexes and grants."""
    options = sink_options(url, table, properties, True, connections)
    df.write.format("jdbc").options(**options).mode("overwrite").save()
