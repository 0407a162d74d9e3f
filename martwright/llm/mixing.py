"""Low-discrepancy source schedule: mix sources to target weights, in blocks of equal token counts.

Every source gets a target: its share, by weight, of ``budget`` times all words, but no more than
``passes`` times its own words; what a source cannot take goes to the others by weight. Each source's
documents are shuffled and cut into blocks of ``block`` words. The schedule has one slot per block
to be read. Slot values 0 … n-1, divided among the sources by cumulative slot counts, are put in
the order of their van der Corput points (the bits of the value, reversed), so every stretch of the
schedule holds the sources in nearly the target proportions. The r-th slot of a source reads block
r modulo its number of blocks; its last slot is cut to the words that are left.

Built-in functions only. No window runs over a source: positions come from range-partitioned
running totals, so a source with a third of all rows spreads over many tasks.

Defined results: NULL or empty texts have size 0 and are never taken. A NULL source is a source of
its own, last in order. Repeated rows are separate documents. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.text import n_words
from martwright.operators.ordering import running_total
from martwright.session import materialize

# Bits of a slot value; enough for 2^62 slots.
BITS = 62


def targets(sizes: DataFrame, weights: list[float], budget: float, passes: float) -> DataFrame:
    """One row per source: ``source``, ``place``, ``source_size``, ``target``, ``before`` (words of earlier sources).

    Sources are ordered by code point, NULL last, and weigh ``weights``, repeated. With every cap
    ``passes * size`` and weight w, the shares that fit are ``min(cap, level * w)`` for one level,
    which is found by adding up caps and weights in the order of cap / w. One row per source only.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    placed = (
        per_source.withColumn("place", F.row_number().over(in_order) - 1)
        .withColumn("weight", F.get(cycle, F.col("place") % len(weights)))
        .withColumn("before", F.sum("source_size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("source_size"))
        .withColumn("cap", passes * F.col("source_size"))
    )
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    level = (
        (budget * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_ratio), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0.0)))
    )
    # before the first source that stays under its cap, all are full; from there on the level is that source's
    levels = placed.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") < F.col("cap"))
    first_free = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(everything)
    return (
        levels.withColumn("first", first_free)
        .withColumn("target", F.coalesce(F.least("cap", F.col("first.level") * F.col("weight")), F.col("cap")))
        .select("source", "place", "source_size", "target", "before")
    )


def van_der_corput(value: Column) -> Column:
    """The bits of a slot value in reverse order; sorting by it spreads neighbouring values evenly."""
    return F.conv(F.reverse(F.lpad(F.bin(value), BITS, "0")), 2, 10).cast("long")


class Mix:
    """The stored parts of one mix; ``documents`` has what is taken of each document."""

    def __init__(
        self,
        docs: DataFrame,
        weights: list[float] = (3, 1, 2),
        budget: float = 1.5,
        passes: float = 2.0,
        block: int = 1024,
        seed: int = 17,
        keep: list[str] = (),
    ):
        """``keep``: names of columns of ``docs`` to carry along beside doc_id, source and text size."""
        self.block = block
        kept = F.struct(*[docs[c] for c in keep]) if keep else F.lit(True)
        sizes = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), kept.alias("kept"))
        # measured once; everything below reads words per document, not texts
        sizes = materialize(sizes, "sizes")
        self.sources = materialize(targets(sizes, list(weights), budget, passes), "targets")
        marked = sizes.join(
            self.sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
        ).drop("of")
        key = F.xxhash64(F.lit(seed), F.col("doc_id"))
        order = [F.col("place"), key, F.col("doc_id"), F.col("size")]
        placed = running_total(marked, [*order, F.xxhash64("kept")] if keep else order, F.col("size"), "upto")
        self.placed = materialize(
            placed.withColumn("start", F.col("upto") - F.col("size") - F.col("before")).drop("upto", "upto_total", "before"),
            "placed",
        )

    def quotas(self) -> DataFrame:
        """Slots of each source: blocks of its full passes and of the part of a pass that is left.

        ``part``: words read in that last pass; its last slot is cut there.
        """
        blocks = F.ceil(F.col("source_size") / F.lit(self.block)).cast("long")
        words = F.round("target").cast("long")
        full = F.floor(words / F.col("source_size")).cast("long")
        rest = words - full * F.col("source_size")
        quotas = self.sources.filter("source_size > 0").select(
            "place",
            blocks.alias("blocks"),
            full.alias("full"),
            rest.alias("part"),
            (full * blocks + F.ceil(rest / F.lit(self.block)).cast("long")).alias("slots"),
        )
        upto = F.sum("slots").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
        return quotas.withColumn("first_value", upto - F.col("slots"))

    def schedule(self) -> DataFrame:
        """One row per slot: ``slot`` (sort by it for the reading order), ``place`` (of the source),
        ``rank`` among the source's slots, ``block_no`` and ``words`` to read from that block's start."""
        step = 1 << 14
        last = F.col("first_value") + F.col("slots") - 1
        chunks = self.quotas().filter("slots > 0").select(
            "*", last.alias("last"), F.explode(F.sequence("first_value", last, F.lit(step).cast("long"))).alias("chunk")
        )
        values = chunks.repartition("chunk").select(
            "place", "blocks", "full", "part",
            F.explode(F.sequence("chunk", F.least(F.col("chunk") + step - 1, F.col("last")))).alias("value"),
            "first_value",
        )
        slots = values.withColumn("slot", van_der_corput(F.col("value"))).drop("value")
        ranked = running_total(slots, [F.col("place"), F.col("slot")], F.lit(1).cast("long"), "upto")
        rank = F.col("upto") - F.col("first_value") - 1
        block_no = rank % F.col("blocks")
        words = F.when(rank < F.col("full") * F.col("blocks"), F.lit(self.block).cast("long")).otherwise(
            F.least(F.lit(self.block).cast("long"), F.col("part") - block_no * self.block)
        )
        return ranked.select("slot", "place", rank.alias("rank"), block_no.alias("block_no"), words.alias("words"))

    def blocks(self) -> DataFrame:
        """Which words of which document lie in which block: ``place``, ``start`` (of the document in its
        source's stream), ``block_no``, and ``begin`` and ``end`` inside the block."""
        begin, end = F.col("start"), F.col("start") + F.col("size")
        numbers = F.sequence(F.floor(begin / F.lit(self.block)), F.floor((end - 1) / F.lit(self.block)))
        cut = self.placed.filter("size > 0").select("place", "start", "size", F.explode(numbers).alias("block_no"))
        base = F.col("block_no") * self.block
        return cut.select(
            "place", "start", "block_no",
            F.greatest(F.col("start") - base, F.lit(0).cast("long")).alias("begin"),
            F.least(F.col("start") + F.col("size") - base, F.lit(self.block).cast("long")).alias("end"),
        )

    def reading(self) -> DataFrame:
        """The schedule joined with its blocks: every stretch of words the mix reads, by ``slot`` and ``begin``."""
        pieces = self.schedule().join(self.blocks(), ["place", "block_no"])
        return pieces.filter("begin < words").withColumn("taken", F.least("end", "words") - F.col("begin"))

    def documents(self) -> DataFrame:
        """One row per document: ``doc_id``, ``kept``, ``source``, ``size``, ``source_size``, ``target``, ``taken``."""
        taken = self.reading().groupBy("place", "start").agg(F.sum("taken").alias("taken"))
        taken = taken.select(F.col("place").alias("p"), F.col("start").alias("s"), "taken")
        mine = (F.col("place") == F.col("p")) & (F.col("start") == F.col("s")) & (F.col("size") > 0)
        return self.placed.join(taken, mine, "left").select(
            "doc_id", "kept", "source", "size", "source_size", "target",
            F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
        )
