import random
from datetime import date
from decimal import Decimal as D

import pytest

from martwright.operators.lookup import overlapping_versions, temporal_lookup
from martwright.operators.merge import (
    duplicate_keys,
    full_refresh,
    insert_absent,
    require_unique,
    scd2_merge,
    start_history,
    upsert,
)

SNAPSHOT = "id int, attr string, note string, price decimal(18,4)"
DAY0, DAY1, DAY2 = date(1900, 1, 1), date(2024, 1, 1), date(2024, 6, 1)


def snap(spark, *rows):
    return spark.createDataFrame([(i, a, n, None if p is None else D(p)) for i, a, n, p in rows], SNAPSHOT)


def merge(history, new, day, **options):
    return scd2_merge(history, new, "id", "sk", ["attr", "price"], day, **options)


def states(df):
    """id -> versions as (version, attr, effective, expiry, current), oldest first."""
    out = {}
    for r in df.collect():
        out.setdefault(r["id"], []).append(
            (r["version"], r["attr"], r["effective_date"], r["expiry_date"], r["is_current"])
        )
    return {k: sorted(v) for k, v in out.items()}


@pytest.fixture(scope="module")
def first(spark):
    rows = [(1, "a", "n", "1"), (2, "b", "n", "2"), (3, "c", "n", "3"), (4, None, "n", None)]
    return start_history(snap(spark, *rows), "id", "sk", DAY0)


def test_new_changed_same_missing(spark, first):
    new = snap(spark, (1, "a", "other note", "1"), (2, "B", "n", "2"), (4, "", "n", None), (5, "e", "n", "5"))
    got = states(merge(first, new, DAY1))
    assert got[1] == [(1, "a", DAY0, None, True)]
    assert got[2] == [(1, "b", DAY0, DAY1, False), (2, "B", DAY1, None, True)]
    assert got[3] == [(1, "c", DAY0, None, True)]
    assert got[4] == [(1, None, DAY0, None, True)]  # NULL and '' count as equal
    assert got[5] == [(1, "e", DAY1, None, True)]


def test_strict_nulls(spark, first):
    got = states(merge(first, snap(spark, (4, "", "n", None)), DAY1, nulls_equal_blank=False))
    assert len(got[4]) == 2


def test_untracked_change_is_ignored_or_overwritten(spark, first):
    new = snap(spark, (1, "a", "fresh", "1"))
    kept = {r["id"]: r["note"] for r in merge(first, new, DAY1).collect()}
    assert kept[1] == "n"
    changed = {r["id"]: r["note"] for r in merge(first, new, DAY1, overwrite_untracked=True).collect()}
    assert changed[1] == "fresh" and changed[2] == "n"


def test_same_day_change_replaces_the_version(spark, first):
    once = merge(first, snap(spark, (1, "x", "n", "1")), DAY1)
    twice = merge(once, snap(spark, (1, "y", "n", "1")), DAY1)
    assert states(twice)[1] == [(1, "a", DAY0, DAY1, False), (2, "y", DAY1, None, True)]
    keys = [r["sk"] for r in twice.collect()]
    assert len(keys) == len(set(keys))


def test_change_back_opens_a_third_version(spark, first):
    once = merge(first, snap(spark, (1, "x", "n", "1")), DAY1)
    back = merge(once, snap(spark, (1, "a", "n", "1")), DAY2)
    assert [v[:2] for v in states(back)[1]] == [(1, "a"), (2, "x"), (3, "a")]


def test_run_date_before_the_current_version_fails(spark, first):
    later = merge(first, snap(spark, (1, "x", "n", "1")), DAY2)
    with pytest.raises(Exception, match="starts after the run date"):
        merge(later, snap(spark, (1, "y", "n", "1")), DAY1).collect()


def test_duplicate_snapshot_key_fails(spark, first):
    with pytest.raises(Exception, match="key occurs twice"):
        merge(first, snap(spark, (1, "x", "n", "1"), (1, "y", "n", "1")), DAY1).collect()


def test_random_merges_keep_the_laws(spark):
    """Many keys through several random snapshots, against a plain model of one key."""
    dice = random.Random(7)
    ids, days = range(200), [date(2024, m, 1) for m in range(1, 5)]
    attrs = ["a", "b", None, ""]
    model, history = {}, None
    for day in days:
        rows = [(i, dice.choice(attrs), "n", "1") for i in ids if dice.random() < 0.7]
        df = snap(spark, *rows)
        history = start_history(df, "id", "sk", day) if history is None else merge(history, df, day)
        for i, attr, _, _ in rows:
            versions = model.setdefault(i, [])
            if not versions:
                versions.append([1, attr, day, None, True])
            elif (versions[-1][1] or "") != (attr or ""):
                versions[-1][3:] = [day, False]
                versions.append([versions[-1][0] + 1, attr, day, None, True])
        history = spark.createDataFrame(history.collect(), history.schema)
    assert states(history) == {i: [tuple(v) for v in vs] for i, vs in model.items()}
    assert overlapping_versions(history, "id").count() == 0
    assert history.filter("is_current").groupBy("id").count().filter("count > 1").count() == 0
    assert sorted(merge(history, snap(spark, *rows), date(2025, 1, 1)).collect()) == sorted(history.collect())


def test_temporal_lookup_boundaries(spark):
    versions = spark.createDataFrame(
        [
            ("v1", 1, date(2020, 1, 1), date(2021, 1, 1)),
            ("v2", 1, date(2021, 6, 1), None),
            ("w1", 2, date(2020, 1, 1), None),
        ],
        "key string, id int, effective_date date, expiry_date date",
    )
    days = spark.createDataFrame(
        [
            (1, 1, date(2020, 1, 1)),  # first day counts
            (2, 1, date(2021, 1, 1)),  # expiry day does not
            (3, 1, date(2019, 12, 31)),  # before the first version
            (4, 1, date(2021, 3, 1)),  # gap
            (5, 1, date(2021, 6, 1)),
            (6, 3, date(2021, 6, 1)),  # unknown id
            (7, 2, date(2030, 1, 1)),
            (8, None, date(2030, 1, 1)),
        ],
        "n int, item int, day date",
    )
    got = temporal_lookup(days, versions, ("item", "id"), "day", ["key"]).collect()
    assert len(got) == 8
    assert {r["n"]: r["key"] for r in got} == {1: "v1", 2: None, 3: None, 4: None, 5: "v2", 6: None, 7: "w1", 8: None}


def test_overlapping_versions_are_found(spark):
    bad = spark.createDataFrame(
        [(1, date(2020, 1, 1), None, 1), (1, date(2021, 1, 1), None, 2), (2, date(2020, 1, 1), date(2021, 1, 1), 1)],
        "id int, effective_date date, expiry_date date, version int",
    )
    assert [(r["id"], r["version"]) for r in overlapping_versions(bad, "id").collect()] == [(1, 1)]


@pytest.fixture(params=["10MB", "-1"], ids=["broadcast allowed", "no broadcast"])
def target(spark, request):
    """Every upsert test runs with and without broadcast joins."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30)], "k int, a string, b int")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_reads_each_side_once(spark, tmp_path):
    spark.range(1000).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.range(1, 2).selectExpr("id AS k", "7L AS v")
    merged = upsert(stored, batch, ["k"], check=False)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("FullOuter") == 1
    assert merged.filter("k = 1").first()["v"] == 7 and merged.count() == 1000


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_upsert_column_subset(spark, target):
    batch = spark.createDataFrame([(2, "B"), (3, "C"), (9, "N")], "k int, a string")
    got = as_set(upsert(target, batch, ["k"]))
    assert got == {(1, "a", 10), (2, "B", 20), (3, "C", 30), (9, "N", None)}


def test_upsert_writes_nulls_and_is_idempotent(spark, target):
    batch = spark.createDataFrame([(1, None, 11), (4, "d", None)], "k int, a string, b int")
    once = upsert(target, batch, ["k"])
    assert as_set(once) == {(1, None, 11), (2, "b", 20), (3, None, 30), (4, "d", None)}
    assert as_set(upsert(once, batch, ["k"])) == as_set(once)


def test_upsert_composite_string_keys(spark):
    target = spark.createDataFrame([("x", 1, "old")], "s string, n int, v string")
    batch = spark.createDataFrame([("x", 1, "new"), ("x", 2, "two")], "s string, n int, v string")
    assert as_set(upsert(target, batch, ["s", "n"])) == {("x", 1, "new"), ("x", 2, "two")}


def test_upsert_rejects_repeated_keys(spark, target):
    batch = spark.createDataFrame([(1, "x"), (1, "y")], "k int, a string")
    with pytest.raises(Exception, match="key occurs twice"):
        upsert(target, batch, ["k"]).collect()
    assert as_set(duplicate_keys(batch, ["k"])) == {(1, 2)}
    assert require_unique(target, ["k"]).count() == 3


def test_insert_absent_and_full_refresh(spark, target):
    rows = spark.createDataFrame([(1, "zzz", 0), (7, "new", 7)], "k int, a string, b int")
    assert (1, "a", 10) in as_set(insert_absent(target, rows, ["k"]))
    assert (7, "new", 7) in as_set(insert_absent(target, rows, ["k"]))
    assert len(as_set(full_refresh(target, rows, ["k"]))) == 4
    assert as_set(full_refresh(target, rows, ["k"], delete_missing=True)) == as_set(rows)
