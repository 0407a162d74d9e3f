"""Conformed orders and lines in places (month, bucket of the order id), with a digest tree beside them.

A batch of arrivals is merged into the places it touches; the others are neither read nor written. Each order has a
digest of its header and all its lines, each place one of its orders. Whoever keeps the digests of the places as they were
when it last looked compares them level by level: months, then places, then orders of differing places. What was added
late, moved to another month, corrected or removed makes a difference, and only differing places have to be read.

The tree has one row per place, so it is bounded by months times ``buckets`` and may be compared on the driver. Where an
order lay before is found among the digests of the batch's buckets: ids and months, never lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.plans.facts import PLACE
from martwright.plans.incremental import month_key
from martwright.session import fitted_shuffles, materialize, scratch_tables
from martwright.sources.parquet import read_places, read_version, replace_places, write_version

Place = tuple[int | None, int]
ARRIVAL = "ingested_at"
# Where lines lie whose order has not come: no month, and a bucket that no order has.
WAITING: Place = (None, -1)


def at_places(df: DataFrame, places: list[Place]) -> DataFrame:
    """Rows of the given places, by literals on the partition columns."""
    buckets: dict[int | None, list[int]] = {}
    for month, bucket in places:
        buckets.setdefault(month, []).append(bucket)
    months: dict[tuple[int, ...], list[int | None]] = {}
    for month, found in buckets.items():
        months.setdefault(tuple(sorted(found)), []).append(month)

    def chosen(found: tuple[int, ...], of: list[int | None]) -> Column:
        known = [m for m in of if m is not None]
        month = F.col("month_key").isin(known) if known else F.lit(False)
        return (month | F.col("month_key").isNull() if None in of else month) & F.col("bucket").isin(*found)

    return df.filter(reduce(lambda a, b: a | b, [chosen(b, m) for b, m in months.items()], F.lit(False)))


def places_of(df: DataFrame) -> list[Place]:
    """At most months times buckets pairs."""
    return [(r["month_key"], r["bucket"]) for r in df.select(*PLACE).distinct().collect()]


def differing_places(now: DataFrame, before: DataFrame | None) -> list[Place]:
    """Places whose orders or digest differ between two trees; all of ``now`` if there is none before."""
    if before is None:
        return places_of(now)
    same = F.col("n.month_key").eqNullSafe(F.col("b.month_key"))

    def months(tree: DataFrame) -> DataFrame:
        return tree.groupBy("month_key").agg(F.sum("orders").alias("orders"), F.bit_xor(F.xxhash64("bucket", "orders", "digest")).alias("digest"))

    def differing(a: DataFrame, b: DataFrame, condition: Column) -> DataFrame:
        pair = a.alias("n").join(b.alias("b"), condition, "full_outer")
        return pair.filter(~(F.col("n.orders").eqNullSafe(F.col("b.orders")) & F.col("n.digest").eqNullSafe(F.col("b.digest"))))

    rows = differing(months(now), months(before), same).select(F.coalesce("n.month_key", "b.month_key").alias("m")).collect()
    if not rows:
        return []
    known = [r["m"] for r in rows if r["m"] is not None]
    inside = F.col("month_key").isin(known) if known else F.lit(False)
    inside = inside | F.col("month_key").isNull() if any(r["m"] is None for r in rows) else inside
    pair = differing(now.filter(inside), before.filter(inside), same & (F.col("n.bucket") == F.col("b.bucket")))
    found = pair.select(F.coalesce("n.month_key", "b.month_key").alias("m"), F.coalesce("n.bucket", "b.bucket").alias("k"))
    return [(r["m"], r["k"]) for r in found.collect()]


def _newest(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the last to arrive, and of several the greatest."""
    columns = [c for c in df.columns if c not in (key, ARRIVAL)]
    first = [ARRIVAL] if ARRIVAL in df.columns else []
    row = F.max(F.struct(*first, *columns)).alias("row")
    return df.groupBy(key).agg(row).select(*[c if c == key else F.col("row")[c].alias(c) for c in df.columns])


def order_digests(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """``order_id``, place, number of lines, and a digest of the header and all lines, whatever their order."""

    def whole(df: DataFrame) -> Column:
        return F.xxhash64(*[c for c in sorted(df.columns) if c not in (*PLACE, ARRIVAL)])

    sums = lines.select("order_id", whole(lines).alias("h")).groupBy("order_id").agg(F.count("*").alias("lines"), F.bit_xor("h").alias("h"))
    heads = orders.select("order_id", *PLACE, whole(orders).alias("head"))
    both = heads.join(sums, "order_id", "left").withColumn("lines", F.coalesce("lines", F.lit(0).cast("bigint")))
    return both.select("order_id", *PLACE, "lines", F.xxhash64("head", "lines", "h").alias("digest"))


class OrderStore:
    """Stored orders and lines below ``root``; the number of buckets is fixed with the first batch."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root, buckets

    def _table(self, name: str, places: list[Place] | None) -> DataFrame:
        df = read_places(self.spark, self.root, name)
        return df.filter(F.col("bucket") >= 0) if places is None else at_places(df, places)

    def orders(self, places: list[Place] | None = None) -> DataFrame:
        return self._table("orders", places)

    def lines(self, places: list[Place] | None = None) -> DataFrame:
        return self._table("lines", places)

    def digests(self, places: list[Place] | None = None) -> DataFrame:
        """Per order: place, number of lines, digest."""
        return self._table("digests", places)

    def tree(self) -> DataFrame | None:
        """Per place: orders and digest; None before the first batch."""
        return read_version(self.spark, self.root, "tree")

    def waiting(self) -> DataFrame | None:
        """Lines whose order has not come yet; None before the first batch."""
        lines = read_places(self.spark, self.root, "lines")
        return None if lines is None else at_places(lines, [WAITING]).drop(*PLACE)

    def of_months(self, name: str, months: list[int | None]) -> DataFrame:
        return self._table(name, [(m, b) for m in months for b in range(self.buckets)])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("order_id"), F.lit(self.buckets)).cast("int")

    def merge(
        self, orders: DataFrame, lines: DataFrame, gone_orders: DataFrame | None = None, gone_lines: DataFrame | None = None
    ) -> list[Place]:
        """Merge a batch: new and corrected orders (whole rows) and lines, and ids of removed ones; returns the places touched.

        An order that comes with another date moves, with all its lines. A removed order takes its lines along. Lines
        without an order wait for it. A line stays with its order. A batch that is merged again changes nothing, so a run
        that died is run again; the tree is written last.
        """
        with scratch_tables(self.spark), fitted_shuffles(orders, lines):
            return self._merge(orders, lines, gone_orders, gone_lines)

    def _merge(self, orders: DataFrame, lines: DataFrame, gone_orders: DataFrame | None, gone_lines: DataFrame | None) -> list[Place]:
        bucket = self.bucket().alias("bucket")
        orders = materialize(_newest(orders.drop(*PLACE), "order_id"), "batch_orders")
        lines = _newest(lines.drop(*PLACE), "order_detail_id").select(*lines.drop(*PLACE).columns)
        late = self.waiting()
        if late is not None:
            late = late.join(lines.select("order_detail_id"), "order_detail_id", "left_anti")
            for df, key in ((gone_lines, "order_detail_id"), (gone_orders, "order_id")):
                late = late if df is None else late.join(df.select(key), key, "left_anti")
            lines = lines.unionByName(late.select(*lines.columns))
        new = orders.select(month_key("order_date").alias("month_key"), bucket)
        tree = self.tree()
        if tree is None:
            places, now = places_of(new), orders
        else:
            lines = materialize(lines, "batch_lines")
            gone = [df.select("order_id") for df in (gone_orders, gone_lines) if df is not None]
            ids = reduce(DataFrame.unionByName, [orders.select("order_id"), lines.select("order_id"), *gone]).distinct()
            ids = materialize(ids.select("order_id", bucket), "touched")
            touched = [r["bucket"] for r in ids.select("bucket").distinct().collect()]
            # ids and months only, of the batch's buckets
            were = self.digests().filter(F.col("bucket").isin(touched)).select("order_id", *PLACE).join(ids.select("order_id"), "order_id", "left_semi")
            places = places_of(were.select(*PLACE).unionByName(new))
            replaced = reduce(DataFrame.unionByName, [orders.select("order_id"), *([] if gone_orders is None else [gone_orders.select("order_id")])])
            now = self.orders(places).drop(*PLACE).join(replaced, "order_id", "left_anti").unionByName(orders)
        held = lines.withColumn("_new", F.lit(True))
        if late is not None and places:
            # also before the first tree: a first run that died may have stored lines that waited
            keys = [lines.select("order_detail_id"), *([] if gone_lines is None else [gone_lines.select("order_detail_id")])]
            old = self.lines(places).drop(*PLACE).join(reduce(DataFrame.unionByName, keys), "order_detail_id", "left_anti")
            held = old.withColumn("_new", F.lit(False)).unionByName(held)
        # What a table holds in these places is read and replaced by one job: Spark swaps partitions when all tasks are through.
        now = now.withColumns({"month_key": month_key("order_date"), "bucket": self.bucket()})
        if places:
            replace_places(now, self.root, "orders", places, PLACE)
            now = self.orders(places)
        # lines that wait are written with the others, so that one pass over the lines does for both
        held = held.join(now.select("order_id", *PLACE), "order_id", "left").filter(F.col("bucket").isNotNull() | F.col("_new")).drop("_new")
        held = held.withColumn("bucket", F.coalesce("bucket", F.lit(WAITING[1])))
        replace_places(held, self.root, "lines", [*places, WAITING], PLACE)
        if not places:
            return []
        replace_places(order_digests(self.orders(places), self.lines(places)), self.root, "digests", places, PLACE)
        leaves = self.digests(places)
        branch = leaves.groupBy(*PLACE).agg(F.count("*").alias("orders"), F.bit_xor(F.xxhash64("order_id", "digest")).alias("digest"))
        if tree is not None:
            rest = tree.join(_frame(self.spark, places), (F.col("month_key").eqNullSafe(F.col("m"))) & (F.col("bucket") == F.col("k")), "left_anti")
            branch = rest.unionByName(branch)
        write_version(materialize(branch, "tree"), self.root, "tree")
        return places


def _frame(spark: SparkSession, places: list[Place]) -> DataFrame:
    return spark.createDataFrame(places, "m int, k int")
