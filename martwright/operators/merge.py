"""Keyed merges as pure plans: the new table state is a function of old state and input."""

from __future__ import annotations

from datetime import date
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions.keys import any_changed, surrogate_key_sql

SCD2_COLUMNS = ["effective_date", "expiry_date", "is_current", "version"]


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows, but the job fails if a key repeats.

    The aggregate shuffles on the key that the following merge joins on, so the check
    costs no shuffle of its own, and copies of a key collapse before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(F.struct(*rest)).alias("_row"))
    key_text = f"to_json(struct({', '.join(f'`{k}`' for k in keys)}))"
    only = f"CASE WHEN _n = 1 THEN _row ELSE raise_error('key occurs twice in one batch: ' || {key_text}) END"
    return grouped.selectExpr(*[f"`{k}`" for k in keys], f"{only} AS _row").selectExpr(
        *[f"`{c}`" if c in keys else f"_row.`{c}` AS `{c}`" for c in df.columns]
    )


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Insert new keys, overwrite the given columns of known keys, leave other rows alone.

    ``updates`` may lack columns of ``target``: those keep their value, or are NULL for a
    new key. One full outer join reads both sides once.
    """
    if check:
        updates = require_unique(updates, keys)
    given = set(updates.columns)
    old = target.alias("o")
    new = updates.selectExpr("*", "true AS _new").alias("n")
    hit = F.expr(" AND ".join(f"o.`{k}` = n.`{k}`" for k in keys))

    def merged(c: str, kind: str) -> str:
        if c in keys:
            return f"coalesce(n.`{c}`, o.`{c}`) AS `{c}`"
        if c not in given:
            return f"o.`{c}` AS `{c}`"
        return f"CASE WHEN n._new THEN CAST(n.`{c}` AS {kind}) ELSE o.`{c}` END AS `{c}`"

    columns = [merged(c, kind) for c, kind in target.dtypes]
    return old.join(new, hit, "full_outer").selectExpr(*columns)


def absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The ``rows`` whose key the target lacks.

    The target is first cut down to the keys in question, so few ``rows`` against a large
    target cost one scan of its key columns and no shuffle of it.
    """
    known = target.select(*keys).join(rows.select(*keys), keys, "left_semi")
    return rows.join(known, keys, "left_anti")


def insert_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add the rows whose key the target lacks; keep everything already there."""
    return target.unionByName(absent(target, rows, keys))


def full_refresh(
    target: DataFrame, snapshot: DataFrame, keys: list[str], delete_missing: bool = False
) -> DataFrame:
    """Upsert a whole snapshot; rows it no longer holds stay unless ``delete_missing``."""
    if delete_missing:
        return require_unique(snapshot, keys).select(*target.columns)
    return upsert(target, snapshot, keys)


def start_history(snapshot: DataFrame, key: str, surrogate: str, first_day: date) -> DataFrame:
    """Version 1 of every row of a snapshot, valid from ``first_day``."""
    attributes = [c for c in snapshot.columns if c not in {key, surrogate, *SCD2_COLUMNS}]
    return require_unique(snapshot.select(key, *attributes), [key]).selectExpr(
        f"{surrogate_key_sql(f'`{key}`', _day(first_day))} AS `{surrogate}`",
        f"`{key}`",
        *[f"`{c}`" for c in attributes],
        f"{_day(first_day)} AS effective_date",
        "CAST(NULL AS DATE) AS expiry_date",
        "true AS is_current",
        "CAST(1 AS SMALLINT) AS version",
    )


def _day(day: date) -> str:
    return f"DATE '{day.isoformat()}'"


def scd2_merge(
    history: DataFrame,
    snapshot: DataFrame,
    key: str,
    surrogate: str,
    tracked: list[str],
    run_date: date,
    *,
    first_day: date | None = None,
    overwrite_untracked: bool = False,
    nulls_equal_blank: bool = True,
) -> DataFrame:
    """Type-2 merge of a snapshot into a dimension history; returns the new history.

    * unknown key: version 1, valid from ``first_day`` (default ``run_date``);
    * a tracked column differs: the current version expires on ``run_date`` and the next
      one starts there; a second change on the same day replaces that day's version;
    * otherwise, or if the snapshot lacks the key: untouched
      (``overwrite_untracked`` refreshes the other attributes in place).

    One full outer join of the current versions and the snapshot decides all of this; each
    pair yields one or two rows. Closed versions take no part in the join, and with a
    table partitioned by ``is_current`` the two reads of the history do not overlap.
    """
    types = dict(history.dtypes)
    columns = list(types)
    attributes = [c for c in columns if c not in {key, surrogate, *SCD2_COLUMNS}]
    today, start = _day(run_date), _day(first_day or run_date)

    cast = ", ".join(f"CAST(`{c}` AS {types[c]}) AS `{c}`" for c in [key, *attributes])
    incoming = require_unique(snapshot.select(key, *attributes), [key]).selectExpr(
        f"`{key}` AS _new_key", f"struct({cast}) AS new"
    )
    current = history.filter("is_current").selectExpr(f"`{key}` AS _old_key", "struct(*) AS old")
    pair = current.join(incoming, F.expr("_old_key = _new_key"), "full_outer")

    kept = {c: f"old.`{c}`" for c in columns}
    fresh = {c: f"new.`{c}`" for c in attributes}

    def row(parts: dict[str, str]) -> str:
        return "struct(" + ", ".join(f"CAST({parts[c]} AS {types[c]}) AS `{c}`" for c in columns) + ")"

    def version(effective: str, number: str, surrogate_value: str) -> str:
        return row(
            {
                key: "_new_key",
                surrogate: surrogate_value,
                **fresh,
                "effective_date": effective,
                "expiry_date": "NULL",
                "is_current": "true",
                "version": number,
            }
        )

    first = version(start, "1", surrogate_key_sql("_new_key", start))
    following = version(today, "old.version + 1", surrogate_key_sql("_new_key", today))
    same_day = version("old.effective_date", "old.version", kept[surrogate])
    expired = row({**kept, "expiry_date": today, "is_current": "false"})
    refreshed = row({**kept, **{c: fresh[c] for c in attributes if c not in tracked}})
    matched = refreshed if overwrite_untracked else row(kept)
    changed = any_changed("old", "new", tracked, nulls_equal_blank)
    rows = f"""CASE
        WHEN _old_key IS NULL THEN array({first})
        WHEN _new_key IS NULL THEN array({row(kept)})
        WHEN NOT ({changed}) THEN array({matched})
        WHEN old.effective_date = {today} THEN array({same_day})
        WHEN old.effective_date < {today} THEN array({expired}, {following})
        ELSE raise_error('current version starts after the run date, key ' || CAST(_new_key AS STRING))
    END"""
    return history.filter("NOT is_current").unionByName(pair.selectExpr(f"inline({rows})"))
