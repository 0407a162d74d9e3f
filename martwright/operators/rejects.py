"""Cleaning that leaves a trace: what is made NULL or dropped goes to a reject table, with the raw value and the rule.

Casts, key checks and range checks are decided in one projection, which is written once; the clean rows, the rejects and
the counts come from it. Every input row is either kept or named by a rejecting rule, copies of a key included, so kept
rows and dropped ones add up to the input.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martwright.session import materialize

REJECTS = ["row_key", "column_name", "raw_value", "rule", "dropped", "copies"]
DUPLICATE = "key occurs again"


@dataclass
class Screened:
    """Result of ``screen``: clean rows, rejects (columns ``REJECTS``), and the number of rows per outcome."""

    kept: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def _text(columns: list[str]) -> Column:
    """Columns as one text; NULL and blank look alike."""
    return F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns])


def _problem(hit: Column, column: str, raw: Column, rule: str, drops: bool) -> Column:
    told = F.struct(F.lit(column).alias("column_name"), raw.cast("string").alias("raw_value"), F.lit(rule).alias("rule"), F.lit(drops).alias("dropped"))
    return F.when(hit, told)


def screen(
    df: DataFrame, keys: list[str], casts: dict[str, str] | None = None, non_negative: list[str] | None = None
) -> Screened:
    """Cast, check and deduplicate, and keep what that costs.

    * ``casts``: text that is no value of the type becomes NULL, its raw text is recorded;
    * ``keys``: a row without one is dropped, also if the cast took it;
    * ``non_negative``: a row with a negative value is dropped;
    * of the rows of one key the smallest stays (as in ``one_row_per_key``); each other one is recorded, equal ones with
      their number as ``copies``.

    Counts come from an observation of the written rows, not from a further pass.
    """
    casts, non_negative = casts or {}, non_negative or []
    unknown = {*keys, *casts, *non_negative} - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    value = {c: F.col(f"`{c}`").try_cast(casts[c]) if c in casts else F.col(f"`{c}`") for c in df.columns}
    problems = [
        *[_problem(F.col(f"`{c}`").isNotNull() & value[c].isNull(), c, F.col(f"`{c}`"), f"no {kind}", False) for c, kind in casts.items()],
        *[_problem(value[k].isNull(), k, F.col(f"`{k}`"), "no key", True) for k in keys],
        *[_problem(value[c] < 0, c, F.col(f"`{c}`"), "negative", True) for c in non_negative],
    ]
    found = F.array_compact(F.array(*problems)) if problems else F.array()
    drops = F.exists("_problems", lambda x: x["dropped"])
    judged = df.select(*[v.alias(c) for c, v in value.items()], found.alias("_problems")).withColumn("_drop", drops)
    seen = Observation()
    total = {"input": F.count(F.lit(1)), "dropped": F.count_if("_drop"), "values made NULL": F.coalesce(F.sum(F.size(F.filter("_problems", lambda x: ~x["dropped"]))), F.lit(0))}
    judged = materialize(judged.observe(seen, *[v.alias(n) for n, v in total.items()]), "judged")

    sound = judged.filter("NOT _drop").drop("_problems", "_drop")
    rest = [c for c in df.columns if c not in keys]
    rows = sound.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count("*").alias("_n"))
    first = F.min(F.struct(*[f"`{c}`" for c in rest])) if rest else F.lit(None)
    by_key = materialize(rows.groupBy(*keys).agg(first.alias("_row"), F.sum("_n").alias("_rows")), "by_key")
    kept = by_key.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])

    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"_row.`{c}`")) for c in rest], F.lit(True))
    again = rows.join(by_key.filter("_rows > 1"), keys).withColumn("copies", F.col("_n") - F.when(same, 1).otherwise(0)).filter("copies > 0")
    again = again.select(
        _text(keys).alias("row_key"),
        F.lit(None).cast("string").alias("column_name"),
        _text(rest).alias("raw_value"),
        F.lit(DUPLICATE).alias("rule"),
        F.lit(True).alias("dropped"),
        "copies",
    )
    one = F.lit(1).cast("bigint").alias("copies")
    told = judged.select(_text(keys).alias("row_key"), F.inline("_problems"), one).unionByName(again)
    counts = {name: int(n) for name, n in seen.get.items()}
    return Screened(kept, told.select(*REJECTS), counts)
