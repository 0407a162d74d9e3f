"""Snapshots in any order give one history."""

import itertools
import random
from datetime import date

import pytest

from martwright.functions.keys import surrogate_key
from martwright.operators.history import splice_snapshot
from martwright.operators.merge import scd2_merge

SHAPE = "k_key string, k long, name string, price int, effective_date date, expiry_date date, is_current boolean, version smallint"
DAYS = [date(2024, m, 1) for m in (1, 2, 3, 5)]


def brute(snapshots):
    """Versions by walking through all snapshots in order."""
    out = []
    for k in sorted({k for rows in snapshots.values() for k in rows}):
        runs = []
        for day in sorted(snapshots):
            row = snapshots[day].get(k)
            if not runs or ((row or None) and tuple(x or "" for x in row)) != (runs[-1][1] and tuple(x or "" for x in runs[-1][1])):
                runs.append((day, row))
        n = 0
        for i, (day, row) in enumerate(runs):
            if row is not None:
                n += 1
                until = runs[i + 1][0] if i + 1 < len(runs) else None
                out.append((k, *(x or "" for x in row), day, until, until is None, n))
    return sorted(out, key=str)


def spliced(spark, snapshots, order):
    history, known = spark.createDataFrame([], SHAPE), []
    for day in order:
        rows = [(k, *row, "ignored") for k, row in snapshots[day].items()]
        snap = spark.createDataFrame(rows, "k long, name string, price int, extra string")
        history = splice_snapshot(history, snap, "k", "k_key", ["name", "price"], day, known)
        history = spark.createDataFrame(history.collect(), SHAPE)
        known.append(day)
    return history


def rows_of(history):
    return sorted(((r["k"], r["name"] or "", r["price"] or "", r["effective_date"], r["expiry_date"], r["is_current"], r["version"]) for r in history.collect()), key=str)


@pytest.fixture(scope="module")
def snapshots():
    rng = random.Random(2)
    return {day: {k: (rng.choice(["a", "b", None, ""]), rng.choice([1, 2])) for k in range(40) if rng.random() < 0.75} for day in DAYS}


@pytest.mark.parametrize("order", random.Random(1).sample(list(itertools.permutations(range(4))), 2) + [(3, 2, 1, 0)])
def test_any_order(spark, snapshots, order):
    history = spliced(spark, snapshots, [DAYS[i] for i in order])
    assert rows_of(history) == brute(snapshots)
    want = {(r["k"], r["effective_date"]): r["k_key"] for r in history.collect()}
    keyed = history.select("k", "effective_date", surrogate_key("k", "effective_date").alias("s")).collect()
    assert want == {(r["k"], r["effective_date"]): r["s"] for r in keyed}


def test_in_order_equals_the_merge(spark, snapshots):
    """Without vanished keys, the usual merge gives the same versions."""
    whole = {day: {k: rows.get(k, ("c", 3)) for k in range(40)} for day, rows in snapshots.items()}
    history = spark.createDataFrame([], SHAPE)
    for day in DAYS:
        snap = spark.createDataFrame([(k, *row) for k, row in whole[day].items()], "k long, name string, price int")
        history = spark.createDataFrame(scd2_merge(history, snap, "k", "k_key", ["name", "price"], day).collect(), SHAPE)
    assert rows_of(history) == brute(whole) == rows_of(spliced(spark, whole, DAYS[::-1]))


def test_a_known_day_again_and_empty_snapshots(spark, snapshots):
    other = {k: ("z", 9) for k in range(5, 20)}
    history = spliced(spark, snapshots, DAYS)
    snap = spark.createDataFrame([(k, *row) for k, row in other.items()], "k long, name string, price int")
    again = splice_snapshot(history, snap, "k", "k_key", ["name", "price"], DAYS[1], DAYS)
    assert rows_of(again) == brute(snapshots | {DAYS[1]: other})
    none = splice_snapshot(history, snap.filter("false"), "k", "k_key", ["name", "price"], DAYS[2], DAYS)
    assert rows_of(none) == brute(snapshots | {DAYS[2]: {}})
    twice = snap.unionByName(snap.limit(1))
    with pytest.raises(Exception, match="key occurs twice"):
        splice_snapshot(history, twice, "k", "k_key", ["name", "price"], DAYS[1], DAYS).collect()
    with pytest.raises(ValueError, match="lacks"):
        splice_snapshot(history, snap, "k", "k_key", ["nothing"], DAYS[1], DAYS)


def test_one_shuffle_of_the_history(spark, snapshots):
    history = spliced(spark, snapshots, DAYS[:2])
    snap = spark.createDataFrame([(1, "a", 1)], "k long, name string, price int")
    plan = splice_snapshot(history, snap, "k", "k_key", ["name", "price"], DAYS[3], DAYS[:2])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
