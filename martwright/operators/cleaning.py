"""Cleaning library. Each helper is one projection or one filter over the whole frame."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Which text columns are normalised, and what a phone number keeps.
EMAIL_MARK = "email"
PHONE_MARK = "phone"
NOT_A_DIGIT = "[^0-9]"
SILVER_LAYER = "silver"


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def _change(df: DataFrame, columns: Iterable[str], change: Callable[[Column], Column]) -> DataFrame:
    """Apply ``change`` to the listed columns that exist, in a single projection."""
    chosen = {c: change(F.col(f"`{c}`")) for c in _present(df, columns)}
    return df.withColumns(chosen) if chosen else df


def _blank_to_null(c: Column) -> Column:
    return F.when(F.length(F.trim(c)) > 0, c)


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column."""
    return _change(df, _strings(df), F.trim)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Blank strings become NULL; other strings keep their padding."""
    return _change(df, _strings(df), _blank_to_null)


def lower_strings(df: DataFrame) -> DataFrame:
    """Lower-case every string column."""
    return _change(df, _strings(df), F.lower)


def lower_emails(df: DataFrame) -> DataFrame:
    """Lower-case the string columns whose name mentions an e-mail."""
    return _change(df, [c for c in _strings(df) if EMAIL_MARK in c.lower()], F.lower)


def digits_only_phones(df: DataFrame) -> DataFrame:
    """Keep only digits in the string columns whose name mentions a phone."""
    return _change(
        df,
        [c for c in _strings(df) if PHONE_MARK in c.lower()],
        lambda c: F.regexp_replace(c, NOT_A_DIGIT, ""),
    )


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows with a NULL in any key column."""
    return df.na.drop(how="any", subset=keys)


def one_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep one whole row per key: the smallest, so a rerun picks the same survivor.

    An aggregate rather than a window: copies of a hot key already collapse to one row
    in each map task, before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    survivor = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return survivor.select(*[c if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def to_decimal(df: DataFrame, columns: list[str], precision: int = 18, scale: int = 4) -> DataFrame:
    """Decimal cast; text that is no number, or does not fit, becomes NULL."""
    kind = T.DecimalType(precision, scale)
    return _change(df, columns, lambda c: c.try_cast(kind))


def to_integer(df: DataFrame, columns: list[str]) -> DataFrame:
    """Integer cast; text that is no integer becomes NULL."""
    return _change(df, columns, lambda c: c.try_cast("int"))


def to_day(df: DataFrame, columns: list[str]) -> DataFrame:
    """Date cast; an impossible date becomes NULL."""
    return _change(df, columns, lambda c: c.try_cast("date"))


def to_instant(df: DataFrame, columns: list[str]) -> DataFrame:
    """Timestamp cast; an impossible time becomes NULL."""
    return _change(df, columns, lambda c: c.try_cast("timestamp"))


def keep_non_negative(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep rows whose listed columns are all NULL or at least zero."""
    tests = [F.col(c).isNull() | (F.col(c) >= 0) for c in _present(df, columns)]
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def fill_missing(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace NULL by a default per column; columns that do not exist are skipped.

    The column keeps its type, so a money column stays decimal.
    """
    wanted = {c: value for c, value in defaults.items() if c in df.columns}
    return df.select(
        *[
            F.coalesce(F.col(c), F.lit(wanted[c]).cast(kind)).alias(c) if c in wanted else c
            for c, kind in df.dtypes
        ]
    )


def capitalize(df: DataFrame, columns: list[str]) -> DataFrame:
    """First letter of each word upper case, the rest lower case."""
    return _change(df, columns, F.initcap)


def add_audit(df: DataFrame, layer: str = SILVER_LAYER) -> DataFrame:
    """Processing time and layer name."""
    return df.withColumns({"_processed_at": F.current_timestamp(), "_layer": F.lit(layer)})


def standard_clean(
    df: DataFrame,
    keys: list[str] | None = None,
    *,
    lower_case: bool = False,
    audit: bool = True,
) -> DataFrame:
    """The cleaning every source table gets: text rules, then keys, then audit columns.

    Text is trimmed, blanks become NULL, e-mails are lower-cased and phones reduced to digits,
    all in one projection.
    """

    def text(c: str) -> Column:
        value = F.nullif(F.trim(F.col(f"`{c}`")), F.lit(""))
        if lower_case or EMAIL_MARK in c.lower():
            value = F.lower(value)
        if PHONE_MARK in c.lower():
            value = F.regexp_replace(value, NOT_A_DIGIT, "")
        return value.alias(c)

    strings = set(_strings(df))
    df = df.select(*[text(c) if c in strings else F.col(f"`{c}`") for c in df.columns])
    if keys:
        df = df.transform(drop_null_keys, keys).transform(one_row_per_key, keys)
    return add_audit(df) if audit else df
