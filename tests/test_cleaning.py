from datetime import date, datetime
from decimal import Decimal as D

import pytest

from martwright.operators import cleaning as c


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [
            (1, "  Ann ", "A.B@X.COM", "(555) 010-1234 ext 9", 7),
            (2, "", " c@d.e ", "none", 8),
            (3, "   ", None, None, None),
            (4, None, "", "12", 9),
        ],
        "id int, name string, email string, phone string, phone_type_id int",
    )


def rows(df, key="id"):
    return [tuple(r) for r in df.orderBy(key).collect()]


def test_trim_keeps_blank_and_null(people):
    assert [r[1] for r in rows(c.trim_strings(people))] == ["Ann", "", "", None]


def test_blank_to_null_does_not_trim(people):
    assert [r[1] for r in rows(c.blank_to_null(people))] == ["  Ann ", None, None, None]


def test_email_and_phone_only_touch_named_string_columns(people):
    df = people.transform(c.lower_emails).transform(c.digits_only_phones)
    assert dict(df.dtypes)["phone_type_id"] == "int"
    assert rows(df)[0] == (1, "  Ann ", "a.b@x.com", "55501012349", 7)
    assert rows(df)[1][3] == ""


def test_drop_null_keys_and_dedupe(spark):
    df = spark.createDataFrame(
        [(1, 1, "b"), (1, 1, "a"), (1, 1, "a"), (None, 1, "x"), (2, None, "y"), (2, 2, None), (2, 2, "z")],
        "k1 int, k2 int, v string",
    )
    df = df.transform(c.drop_null_keys, ["k1", "k2"]).transform(c.one_row_per_key, ["k1", "k2"])
    assert sorted(map(tuple, df.collect()), key=str) == [(1, 1, "a"), (2, 2, None)]
    assert df.columns == ["k1", "k2", "v"]


def test_dedupe_keeps_whole_rows(spark):
    """The survivor is one of the rows, never a mix of two."""
    df = spark.createDataFrame([(1, "a", 9), (1, "b", 1)], "k int, v string, n int")
    assert [tuple(r) for r in c.one_row_per_key(df, ["k"]).collect()] == [(1, "a", 9)]


def test_dedupe_on_all_columns(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert sorted(map(tuple, c.one_row_per_key(df, ["a", "b"]).collect())) == [(1, 1), (1, 2)]


def test_casts_turn_bad_text_into_null(spark):
    df = spark.createDataFrame(
        [(1, "12.34567", "7", "2024-02-29", "2024-01-01 10:00:00"), (2, "abc", "x", "2024-02-30", ""), (3, "12345.6", "", "", "soon")],
        "id int, amount string, qty string, d string, ts string",
    )
    got = rows(
        df.transform(c.to_decimal, ["amount", "no_such_column"], 5, 2)
        .transform(c.to_integer, ["qty"])
        .transform(c.to_day, ["d"])
        .transform(c.to_instant, ["ts"])
    )
    assert got[0] == (1, D("12.35"), 7, date(2024, 2, 29), datetime(2024, 1, 1, 10))
    assert got[1] == (2, None, None, None, None)
    assert got[2] == (3, None, None, None, None)


def test_non_negative_keeps_null_and_zero(spark):
    df = spark.createDataFrame(
        [(1, D("-1"), 1), (2, D("0"), None), (3, None, -1), (4, D("2"), 0)], "id int, a decimal(18,4), b int"
    )
    assert [r[0] for r in rows(c.keep_non_negative(df, ["a", "b", "no_such_column"]))] == [2, 4]


def test_fill_keeps_types(spark):
    df = spark.createDataFrame([(1, None, None, None)], "id int, s string, m decimal(18,4), f boolean")
    out = c.fill_missing(df, {"s": "?", "m": 0, "f": False, "no_such_column": 1})
    assert out.dtypes == df.dtypes
    assert rows(out) == [(1, "?", D("0.0000"), False)]


def test_capitalize(spark):
    df = spark.createDataFrame([(1, "HL road FRAME"), (2, "o'neil"), (3, "a-b c"), (4, None)], "id int, s string")
    assert [r[1] for r in rows(c.capitalize(df, ["s"]))] == ["Hl Road Frame", "O'neil", "A-b C", None]


def test_standard_clean_order_and_audit(people):
    out = c.standard_clean(people, ["id"])
    assert out.columns == [*people.columns, "_processed_at", "_layer"]
    got = {r["id"]: r for r in out.collect()}
    assert got[1]["name"] == "Ann" and got[2]["name"] is None and got[2]["email"] == "c@d.e"
    assert got[1]["_layer"] == "silver" and got[1]["_processed_at"] is not None


def test_standard_clean_without_key_keeps_all_rows(people):
    assert c.standard_clean(people.union(people)).count() == 8


def test_text_cleaning_needs_no_shuffle_and_keys_need_one(people):
    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange")

    assert exchanges(c.standard_clean(people, audit=False)) == 0
    assert exchanges(c.standard_clean(people, ["id"], audit=False)) == 1
