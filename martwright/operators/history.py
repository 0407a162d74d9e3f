"""Type-2 histories from snapshots in any order: a back-dated snapshot is spliced in, vanished keys are closed.

A history says what each snapshot saw, as long as the days of the snapshots are known: the version that is valid on a
snapshot's day. A further snapshot of day D therefore adds at most two facts to a key: what it shows on D, and, where the
history ran on unchanged, that the next snapshot saw the old state again. With these put among the starts and ends of
the known versions, neighbours that show the same state join (gaps and islands), and each island is a version.
"""

from __future__ import annotations

from bisect import bisect_right
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.functions.keys import change_hash, surrogate_key_sql
from martwright.operators.lookup import FOREVER
from martwright.operators.merge import SCD2_COLUMNS, require_unique


def splice_snapshot(
    history: DataFrame, snapshot: DataFrame, key: str, surrogate: str, tracked: list[str], day: date, known_days: list[date]
) -> DataFrame:
    """The history after one more snapshot, which may be older than others; ``known_days`` are the days of those merged so far.

    * On ``day`` a key shows the snapshot's row, or nothing if the snapshot lacks it: its version ends there.
    * On the next known day it shows again what the history had for that day.
    * Versions are numbered and keyed anew by their first day, so the same snapshots in any order give the same
      history of keys and tracked columns. Other columns are those of the row that began the version.
    * A snapshot of a known day replaces what that day showed, up to the next known day.

    One shuffle by key; the days are literals, one per load.
    """
    types = dict(history.dtypes)
    attributes = [c for c in history.columns if c not in {key, surrogate, *SCD2_COLUMNS}]
    unknown = [c for c in tracked if c not in attributes]
    if unknown:
        raise ValueError(f"tracked columns that the history lacks: {unknown}")
    days = sorted(set(known_days))
    at = bisect_right(days, day)
    following = days[at] if at < len(days) else None
    shown = F.struct(*[F.col(c).cast(types[c]).alias(c) for c in attributes])
    state = change_hash(tracked)

    def seen(df: DataFrame, on: Column, present: Column, source: int) -> DataFrame:
        row = df.select(key, on.cast("date").alias("_on"), F.when(present, shown).alias("_row"), F.when(present, state).alias("_state"))
        # of several facts of one day the last counts: versions' ends, versions' starts, what is asserted again, the snapshot
        return row.withColumn("_source", F.lit(source))

    yes, no = F.lit(True), F.lit(False)
    starts = seen(history, F.col("effective_date"), yes, 1)
    ends = seen(history.filter("expiry_date IS NOT NULL"), F.col("expiry_date"), no, 0)
    new = seen(require_unique(snapshot.select(key, *attributes), [key]), F.lit(day), yes, 3)
    facts = starts.unionByName(ends).unionByName(new)
    if following is not None:
        until = F.coalesce("expiry_date", F.lit(FOREVER).cast("date"))
        covers = (F.col("effective_date") <= F.lit(following)) & (until > F.lit(following))
        facts = facts.unionByName(seen(history.filter(covers), F.lit(following), yes, 2))
        # keys that had nothing on the next day have nothing again
        facts = facts.unionByName(seen(snapshot.select(key).join(history.filter(covers).select(key), key, "left_anti").selectExpr(f"`{key}`", *[f"CAST(NULL AS {types[c]}) AS `{c}`" for c in attributes]), F.lit(following), no, 2))
    # keys that the snapshot lacks: nothing on the day, unless it has them (then that fact counts)
    lacking = history.select(key).distinct().selectExpr(f"`{key}`", *[f"CAST(NULL AS {types[c]}) AS `{c}`" for c in attributes])
    facts = facts.unionByName(seen(lacking, F.lit(day), no, 2))

    of_day = facts.groupBy(key, "_on").agg(F.max_by(F.struct("_row", "_state"), "_source").alias("f"))
    in_order = Window.partitionBy(key).orderBy("_on")
    told = of_day.select(key, "_on", F.col("f._row").alias("_row"), F.col("f._state").alias("_state"))
    before = F.lag("_state").over(in_order)
    first = F.row_number().over(in_order) == 1
    islands = told.withColumn("_begins", first | ~before.eqNullSafe(F.col("_state"))).filter("_begins")
    islands = islands.withColumn("_until", F.lead("_on").over(in_order)).filter("_row IS NOT NULL")
    numbered = islands.withColumn("_n", F.row_number().over(in_order))
    values = {
        key: f"`{key}`",
        surrogate: surrogate_key_sql(f"`{key}`", "_on"),
        **{c: f"_row.`{c}`" for c in attributes},
        "effective_date": "_on",
        "expiry_date": "_until",
        "is_current": "_until IS NULL",
        "version": "_n",
    }
    return numbered.selectExpr(*[f"CAST({values[c]} AS {types[c]}) AS `{c}`" for c in history.columns])
