"""Hashed surrogate keys, the unknown member and change tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stored keys must stay stable between loads.
UNKNOWN_KEY = "UNKNOWN"
UNKNOWN_ID = -1
KEY_SEPARATOR = "||"
# Leading byte of a packed key: what follows is a hash, or other text.
_HASH, _TEXT = b"\x01", b"\x00"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: Column | str) -> Column:
    """SHA-256 hex of the parts as text, so a key never depends on other rows."""
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *[_col(p).cast("string") for p in parts]), 256)


def or_unknown(key: Column | str) -> Column:
    """The key, or the unknown member where a lookup found nothing."""
    return F.coalesce(_col(key), F.lit(UNKNOWN_KEY))


def text_keys(df: DataFrame) -> list[str]:
    """The key columns that hold text: hashes, the unknown member, or keys that a source brought."""
    return [name for name, kind in df.dtypes if name.endswith("_key") and kind == "string"]


def pack_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text keys as bytes, for the way through a shuffle: a hash takes 33 bytes instead of 64, which compression cannot
    shorten. Other text, NULL included, is kept as it is; equal keys stay equal."""

    def packed(name: str) -> Column:
        key = F.col(name)
        hashed = (F.length(key) == 64) & key.rlike("^[0-9a-f]{64}")
        return F.when(hashed, F.concat(F.lit(_HASH), F.unhex(key))).otherwise(F.concat(F.lit(_TEXT), key.cast("binary")))

    return df.withColumns({c: packed(c) for c in columns}) if columns else df


def unpack_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """The texts that ``pack_keys`` has packed."""

    def unpacked(name: str) -> Column:
        rest = F.expr(f"substring(`{name}`, 2)")
        return F.when(F.substring(name, 1, 1) == F.lit(_HASH), F.lower(F.hex(rest))).otherwise(rest.cast("string"))

    return df.withColumns({c: unpacked(c) for c in columns}) if columns else df


def surrogate_key_sql(*parts: str) -> str:
    """``surrogate_key`` over SQL expressions."""
    texts = ", ".join(f"CAST({p} AS STRING)" for p in parts)
    return f"sha2(concat_ws('{KEY_SEPARATOR}', {texts}), 256)"


def as_text(column: str) -> str:
    """Text form used when versions are compared: NULL and '' count as equal."""
    return f"coalesce(CAST({column} AS STRING), '')"


def change_hash(columns: list[str]) -> Column:
    """One hash over the tracked columns, for stores that keep it beside the row."""
    texts = ", ".join(as_text(f"`{c}`") for c in columns)
    return F.expr(f"sha2(concat_ws('{KEY_SEPARATOR}', {texts}), 256)")


def any_changed(old: str, new: str, columns: list[str], nulls_equal_blank: bool = True) -> str:
    """SQL test: does one of ``columns`` differ between the structs ``old`` and ``new``?"""

    def differs(name: str) -> str:
        a, b = f"{old}.`{name}`", f"{new}.`{name}`"
        return f"{as_text(a)} != {as_text(b)}" if nulls_equal_blank else f"NOT ({a} <=> {b})"

    return " OR ".join(differs(c) for c in columns)
