"""What the text operators share: the word rule, digests of words, blocks of documents."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of anything but ASCII white space, in Python ``bytes.split()``.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def n_words(text: Column) -> Column:
    """Number of words as long, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def in_bucket(key: Column, buckets: int, bucket: int) -> Column:
    """Is crc32 of the key, written as text, in the given bucket? False for NULL."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % buckets == bucket, F.lit(False))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8, empty for NULL."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-mixed uint64 for each uint64 (the finalizer of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
SHORT_WORD = 32  # bytes that are digested in arrays; longer words one by one
_KEYS = np.random.default_rng(20_240_229).integers(0, 2**64, 8, dtype=np.uint64) | np.uint64(1)


def _short_digests(joined: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of words of at most ``SHORT_WORD`` bytes that stand in an array of bytes, which goes on for seven bytes at least.

    Eight bytes at a time go into a state of 128 bits, whose halves are multiplied, crossed and mixed. A step maps
    the eight bytes one to one, and the length is part of the state from the start, so words of up to eight bytes never meet.
    """
    eights = np.ndarray((len(joined) - 7,), dtype="<u8", buffer=joined, strides=(1,))
    with np.errstate(over="ignore"):
        low, high = mix64(sizes.astype(np.uint64) * _KEYS[0]), mix64(sizes.astype(np.uint64) * _KEYS[1] + _KEYS[2])
        rows = np.arange(len(starts))
        for k in range(0, SHORT_WORD, 8):
            rows = rows[sizes[rows] > k]
            if not len(rows):
                break
            left = np.minimum(sizes[rows] - k, 8).astype(np.uint64)
            part = eights[starts[rows] + k] & (np.uint64(2**64 - 1) >> (np.uint64(64) - np.uint64(8) * left))
            a, b = low[rows], high[rows]
            low[rows] = mix64((a ^ part) * _KEYS[3] + b)
            high[rows] = mix64((b + part * _KEYS[4]) * _KEYS[5] ^ a)
        return mix64(low ^ (high * _KEYS[6])), mix64(high + low * _KEYS[7])


def word_digests(texts: list[bytes], piece: int = 1 << 19) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128-bit digests of all words of the texts, in order, as two uint64 arrays, and the number of words per text.

    Words of up to ``SHORT_WORD`` bytes are digested together, longer ones by BLAKE2b. Works through about ``piece``
    bytes at a time.
    """
    lows, highs, counts = [], [], []
    held: list[bytes] = []
    size = 0

    def flush() -> None:
        joined = np.frombuffer(b" ".join(held) + b" " * 8, dtype=np.uint8)
        space = _SPACE[joined]
        after_space = np.append(True, space[:-1])
        starts, ends = np.flatnonzero(~space & after_space), np.flatnonzero(space & ~after_space)
        borders = np.cumsum([len(t) + 1 for t in held])
        counts.append(np.diff(np.searchsorted(starts, borders), prepend=0))
        sizes = ends - starts
        low, high = _short_digests(joined, starts, np.minimum(sizes, SHORT_WORD))
        for i in np.flatnonzero(sizes > SHORT_WORD).tolist():
            low[i], high[i] = np.frombuffer(blake2b(joined[starts[i] : ends[i]], digest_size=16).digest(), dtype=np.uint64)
        lows.append(low)
        highs.append(high)

    for text in texts:
        if held and size + len(text) > piece:
            flush()
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        flush()
    none = np.empty(0, dtype=np.uint64)
    return (
        np.concatenate([none, *lows]),
        np.concatenate([none, *highs]),
        np.concatenate([np.empty(0, dtype=np.int64), *counts]),
    )


def windows64(words: np.ndarray, n: int) -> np.ndarray:
    """One uint64 for each ``n`` consecutive words, from the words' digests, by doubling the length."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        power, span, out, done = words, 1, None, 0
        while True:
            if n & span:
                if out is None:
                    out = power
                else:
                    m = len(words) - done - span + 1
                    out = mix64(out[:m] * np.uint64(0x9E3779B97F4A7C15) + power[done : done + m])
                done += span
            if done == n:
                return out if n > 1 else mix64(out)
            m = len(words) - 2 * span + 1
            power = mix64(power[:m] * np.uint64(0xC2B2AE3D27D4EB4F) + power[span : span + m])
            span *= 2


def groups_of(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal digests together, earliest first, and whether each is the first of its group."""
    order = np.argsort(h1, kind="stable")
    a, b = h1[order], h2[order]
    same, other = a[1:] == a[:-1], b[1:] != b[:-1]
    if (same & other).any():  # two digests that share a half: sort by both
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        same, other = a[1:] == a[:-1], b[1:] != b[:-1]
    return order, np.append(True, ~same | other) if len(order) else np.empty(0, dtype=bool)


def runs_of(batches: Iterator[pa.RecordBatch], limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that none carries many more than ``limit`` bytes of text; one row may be longer."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        start, total = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if total and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def total_chars(docs: DataFrame) -> int:
    """Characters of all texts; one number reaches the driver."""
    return docs.agg(F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0)).alias("n")).first()["n"]


def blocked(docs: DataFrame, block_chars: int) -> DataFrame:
    """``doc_id``, ``text`` and ``block``: documents dealt by hash into blocks of about ``block_chars`` characters.

    A block is what one Python call holds, so its size is fixed and the number of blocks grows with the data.
    """
    n = max(1, -(-total_chars(docs) // block_chars))
    # by id and text: NULL or repeated ids spread like any others
    block = F.pmod(F.xxhash64(F.lit("block"), "doc_id", "text"), F.lit(n)).cast("int")
    return docs.select("doc_id", "text").withColumn("block", block)
