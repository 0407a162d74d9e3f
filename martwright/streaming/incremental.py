"""Order files as a stream: each micro-batch refreshes the months it touches, and none of its orders is lost."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from martwright.plans.incremental import Build, details_of, months_of, of_months, rebuild_months, with_month
from martwright.session import materialize
from martwright.sources.parquet import read_version, replace_months, write_version

PENDING = "order_id bigint, month_key int"


def order_files(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files arriving in a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def newest(header: DataFrame) -> DataFrame:
    """One row per order: that of the latest batch, and of copies inside a batch the greatest row."""
    columns = [c for c in header.columns if c not in ("batch", "order_id")]
    last = F.max(F.struct("batch", *columns)).alias("row")
    return header.groupBy("order_id").agg(last).select("order_id", *[F.col("row")[c].alias(c) for c in columns])


def pending(spark: SparkSession, root: str) -> DataFrame:
    """Orders that had no lines yet when their month was last built."""
    stored = read_version(spark, root, "pending")
    return spark.createDataFrame([], PENDING) if stored is None else stored


def refresh_months(
    spark: SparkSession,
    root: str,
    schema: StructType,
    months: list[int | None],
    lines: Callable[[], DataFrame],
    fact: str,
    build: Build,
) -> None:
    """Rebuild months from the stored orders and the lines as they are now; remember orders without lines."""
    shape = StructType([*schema.fields, StructField("batch", IntegerType()), StructField("month_key", IntegerType())])
    header = materialize(newest(of_months(spark.read.schema(shape).parquet(f"{root}/orders"), months)), "headers")
    detail = of_months(lines(), months)
    replace_months(rebuild_months(header, detail, months, build), root, fact, months)
    waiting = header.join(detail.select("order_id"), "order_id", "left_anti").select("order_id", "month_key")
    known = pending(spark, root)
    elsewhere = known.join(header.select("order_id"), "order_id", "left_anti")
    write_version(materialize(elsewhere.unionByName(waiting), "pending"), root, "pending")


def load_batch(
    batch: DataFrame, batch_id: int, root: str, lines: Callable[[], DataFrame], fact: str, build: Build
) -> None:
    """Store the headers of one batch by month and rebuild the months of it and of all waiting orders.

    ``lines`` gives the order lines as of now, so lines that came after their order are found. Both
    writes replace: the headers their own batch folder, the fact its months. A batch that Spark replays after a
    failure therefore leaves the same state as one that ran once. Of an order sent again the newest row counts; it
    keeps its order date (a corrected date goes through the batch load).
    """
    spark = batch.sparkSession
    path = f"{root}/orders/batch={batch_id}"
    with_month(batch).write.mode("overwrite").partitionBy("month_key").parquet(path)
    late = [r["month_key"] for r in pending(spark, root).select("month_key").distinct().collect()]
    months = sorted({*months_of(batch), *late}, key=str)
    refresh_months(spark, root, batch.schema, months, lines, fact, build)


def load_late_lines(
    spark: SparkSession, root: str, schema: StructType, arrived: DataFrame, lines: Callable[[], DataFrame], fact: str, build: Build
) -> None:
    """Rebuild the months of orders whose lines have ``arrived`` since, and of orders still waiting.

    Only ids and months of the stored orders are read to find them.
    """
    shape = StructType([*schema.fields, StructField("batch", IntegerType()), StructField("month_key", IntegerType())])
    touched = details_of(arrived, spark.read.schema(shape).parquet(f"{root}/orders").select("order_id", "month_key"))
    waiting = pending(spark, root)
    rows = touched.select("month_key").unionByName(waiting.select("month_key")).distinct().collect()
    if rows:
        refresh_months(spark, root, schema, [r["month_key"] for r in rows], lines, fact, build)


def start_load(
    orders: DataFrame, root: str, lines: Callable[[], DataFrame], fact: str, build: Build
) -> StreamingQuery:
    """Process everything that has arrived, then stop; run again to pick up new files.

    The checkpoint remembers which files were loaded, in place of a stored high-water mark.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, batch_id, root, lines, fact, build)

    return (
        orders.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", f"{root}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
