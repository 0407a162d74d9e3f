"""Nothing goes without a trace: rejects and kept rows make up the input."""

import pytest

from martwright.operators.cleaning import one_row_per_key
from martwright.operators.rejects import DUPLICATE, REJECTS, screen

ROWS = [
    ("1", "5", "2.50", "a"), ("2", "x", "1", "b"), ("3", "-4", "1", "c"), (None, "1", "1", "d"), ("bad", "1", "1", "e"),
    ("4", "7", None, "f"), ("4", "7", None, "f"), ("4", "6", "1", "g"), ("5", None, "1e99999", ""), ("6", "-1", "-1", "h"),
]
SHAPE = "id string, qty string, price string, `odd name` string"


@pytest.fixture(scope="module")
def found(spark):
    df = spark.createDataFrame(ROWS, SHAPE)
    return screen(df, ["id"], {"id": "int", "qty": "int", "price": "decimal(18,4)"}, ["qty", "price"])


def test_kept_and_dropped_make_up_the_input(found):
    rejects = found.rejects.collect()
    assert found.rejects.columns == REJECTS
    kept = found.kept.collect()
    assert sorted((r["id"], r["qty"], r["odd name"]) for r in kept if r["qty"] is not None) == [(1, 5, "a"), (4, 6, "g")]
    doubles = sum(r["copies"] for r in rejects if r["rule"] == DUPLICATE)
    assert found.counts["input"] == len(ROWS) == len(kept) + found.counts["dropped"] + doubles
    assert found.counts["values made NULL"] == sum(not r["dropped"] for r in rejects)


def test_each_reject_has_its_rule_and_raw_value(found):
    got = sorted((str(r["column_name"]), str(r["raw_value"]), r["rule"], r["copies"]) for r in found.rejects.collect())
    assert got == sorted([
        ("qty", "x", "no int", 1), ("qty", "-4", "negative", 1), ("id", "None", "no key", 1), ("id", "bad", "no int", 1), ("id", "bad", "no key", 1),
        ("price", "1e99999", "no decimal(18,4)", 1), ("qty", "-1", "negative", 1), ("price", "-1", "negative", 1), ("None", "7||f", DUPLICATE, 2),
    ])


def test_same_survivor_as_the_plain_rule(spark):
    rows = [(k % 7, k % 3, str(k % 5)) for k in range(200)]
    df = spark.createDataFrame(rows, "id int, v int, w string")
    done = screen(df, ["id"])
    assert sorted(done.kept.collect()) == sorted(one_row_per_key(df, ["id"]).collect())
    assert sum(r["copies"] for r in done.rejects.collect()) == 200 - 7


def test_empty_table_keys_only_and_unknown_columns(spark):
    none = screen(spark.createDataFrame([], SHAPE), ["id"], {"qty": "int"})
    assert none.kept.count() == none.rejects.count() == 0 and none.counts["input"] == 0
    only = screen(spark.createDataFrame([(1,), (1,), (2,)], "id int"), ["id"])
    assert sorted(r["id"] for r in only.kept.collect()) == [1, 2] and only.rejects.first()["copies"] == 1
    with pytest.raises(ValueError, match="no such columns"):
        screen(spark.createDataFrame([(1,)], "id int"), ["id"], {"other": "int"})
