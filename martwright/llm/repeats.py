"""Substring deduplication by seed and extend: winnowed anchors, extension both ways, maximal repeats.

Of every ``LENGTH`` consecutive words the smallest digest of its ``ANCHOR``-word runs is the seed, so equal
passages of that length have the same seed at the same place. Documents are held in blocks; anchors
that occur in one block only need no join. For an anchor found in several blocks, each block extends its
occurrences left and right to all windows of ``LENGTH`` words around it, and windows (96-bit digests
of the words) that agree across blocks are joined to their first occurrence: one row per window and block,
never a pair of documents. Overlapping windows then merge into maximal repeats.

A word is removed if a window over it also starts earlier, by (doc_id, position), in the input. Positions
of the kept words, and so the result, depend on the input alone.

Defined results: NULL and empty texts have no words and no repeats. Rows equal in doc_id and text are one
document: neither counts as earlier than the other. Different texts under one doc_id are ordered by a hash,
NULL ids come last. A text of any length is read whole, in one block. Extra columns are not read. An empty table gives an
empty result. Windows are compared by 96 bits (128 inside a block) of mixed digests of their words, so two different ones pass for
equal with a probability under 2^-95 for each pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.lines import row_of
from martwright.llm.text import blocked, groups_of, utf8, windows64, word_digests

LENGTH = 20
ANCHOR = 8
BLOCK_CHARS = 8_000_000


class Block:
    """The documents of one block in their order, as one run of words; windows never cross documents."""

    def __init__(self, table: pa.Table):
        # copies of a row are one document: their text is taken once, ``copy_of`` tells whose it is
        table = table.sort_by([("doc_id", "ascending"), ("row", "ascending")]).combine_chunks()  # NULL ids sort last
        self.table = table
        ids, rows = table.column("doc_id").to_pylist(), table.column("row").to_pylist()
        same = [i > 0 and ids[i] == ids[i - 1] and rows[i] == rows[i - 1] for i in range(len(ids))]
        self.copy_of = np.cumsum([not x for x in same]) - 1 if ids else np.empty(0, dtype=np.int64)
        first = [i for i, x in enumerate(same) if not x]
        self.ids, self.rows = [ids[i] for i in first], [rows[i] for i in first]
        texts = utf8(table.column("text"))
        self.texts = [texts[i] for i in first]
        self.low, self.high, sizes = word_digests(self.texts)
        self.starts = np.cumsum(sizes) - sizes
        self.sizes = sizes
        self.owner = np.repeat(np.arange(len(first)), sizes)

    def inside(self, length: int) -> np.ndarray:
        """Starts of windows that lie in one document."""
        n = len(self.owner) - length + 1
        return np.flatnonzero(self.owner[:n] == self.owner[length - 1 :]) if n > 0 else np.empty(0, dtype=np.int64)

    def seeds(self, at: np.ndarray, length: int, anchor: int) -> np.ndarray:
        """For windows starting at ``at``: the smallest digest of their anchors."""
        runs = windows64(self.low, anchor)
        width, span = length - anchor + 1, 1
        lowest = runs
        while 2 * span <= width:
            lowest = np.minimum(lowest[: len(lowest) - span], lowest[span:])
            span *= 2
        rest = width - span
        return np.minimum(lowest[at], lowest[at + rest]) if len(at) else np.empty(0, dtype=np.uint64)

    def digests(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        if not len(at):
            return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)
        return windows64(self.low, length)[at], windows64(self.high, length)[at]


def _anchors(length: int, anchor: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        block = Block(table)
        found = np.unique(block.seeds(block.inside(length), length, anchor))
        return pa.table({"anchor": found.view(np.int64), "block": np.full(len(found), key[0].as_py(), dtype=np.int32)})

    return run


def short(h2: np.ndarray) -> np.ndarray:
    """The half of the second digest that travels: 96 bits in all."""
    return (h2 >> np.uint64(32)).astype(np.uint32)


def _extend(length: int, anchor: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, anchors: pa.Table) -> pa.Table:
        block = Block(table)
        at = block.inside(length)
        shared = np.asarray(anchors.column("anchor")).view(np.uint64)
        at = at[np.isin(block.seeds(at, length, anchor), shared)] if len(shared) else at[:0]
        h1, h2 = block.digests(at, length)
        order, first = groups_of(h1, h2 >> np.uint64(32))
        lead = order[first]
        owner = block.owner[at[lead]]
        return pa.table(
            {
                "h1": h1[lead].view(np.int64),
                "h2": short(h2[lead]).view(np.int32),
                "block": np.full(len(lead), key[0].as_py(), dtype=np.int32),
                "doc_id": pa.array([block.ids[i] for i in owner], pa.int64()),
                "of": pa.array([block.rows[i] >> 32 for i in owner], pa.int32()),
            }
        )

    return run


def _remove(length: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, late: pa.Table) -> pa.Table:
        block = Block(table)
        at = block.inside(length)
        h1, h2 = block.digests(at, length)
        order, first = groups_of(h1, h2)
        removed = np.zeros(len(at), dtype=bool)
        removed[order] = ~first
        # windows that start earlier in another block
        l1, l2 = np.asarray(late.column("h1")).view(np.uint64), np.asarray(late.column("h2")).view(np.uint32)
        maybe = np.flatnonzero(np.isin(h1, l1)) if len(l1) else np.empty(0, dtype=np.int64)
        if len(maybe):
            gone = set(zip(l1.tolist(), l2.tolist(), strict=True))
            hit = [x in gone for x in zip(h1[maybe].tolist(), short(h2[maybe]).tolist(), strict=True)]
            removed[maybe[np.array(hit)]] = True
        edge = np.zeros(len(block.owner) + 1, dtype=np.int64)
        np.add.at(edge, at[removed], 1)
        np.add.at(edge, at[removed] + length, -1)
        covered = np.cumsum(edge[:-1]) > 0
        counts, spans, kept = [], [], []
        for text, start, size in zip(block.texts, block.starts.tolist(), block.sizes.tolist(), strict=True):
            mark = covered[start : start + size]
            step = np.flatnonzero(np.diff(mark.view(np.int8), prepend=0, append=0)).reshape(-1, 2).tolist()
            counts.append((size, int(mark.sum())))
            spans.append([{"start": a, "end": b} for a, b in step])
            words = text.split()
            for a, b in reversed(step):
                del words[a:b]
            kept.append(b" ".join(words))
        of = block.copy_of.tolist()
        return pa.table(
            {
                "doc_id": block.table.column("doc_id"),
                "row": block.table.column("row"),
                "n_words": pa.array([counts[i][0] for i in of], pa.int64()),
                "n_removed": pa.array([counts[i][1] for i in of], pa.int64()),
                "spans": pa.array([spans[i] for i in of], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept": pa.array([kept[i] for i in of], pa.binary()).cast(pa.string()),
            }
        )

    return run


def without_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: ``doc_id``, ``row``, ``n_words``, ``n_removed``, ``spans`` (of removed words, the
    maximal repeats) and ``kept`` (the other words, joined by one space).

    The texts are dealt to their blocks once; the three passes over them share that exchange.
    """
    by_block = blocked(docs, block_chars).withColumn("row", row_of(F.col("text"))).groupBy("block")
    anchors = by_block.applyInArrow(_anchors(length, anchor), "anchor long, block int").repartition("anchor")
    # both sides of each join below need all columns of one exchange, so it is made and filled once
    spread = [F.min("block").alias("low"), F.max("block").alias("high")]
    common = anchors.groupBy("anchor").agg(*spread).filter("low < high").select("anchor")
    seeds = anchors.join(common, "anchor").select("block", "anchor")
    windows = by_block.cogroup(seeds.groupBy("block")).applyInArrow(
        _extend(length, anchor), "h1 long, h2 int, block int, doc_id long, of int"
    ).repartition("h1", "h2")
    # across blocks the ids decide, then the upper half of the text's hash, by which a block orders its rows as well
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "of")
    firsts = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), *spread).filter("low < high")
    late = windows.join(firsts, ["h1", "h2"]).filter(~place.eqNullSafe(F.col("first"))).select("block", "h1", "h2")
    return by_block.cogroup(late.groupBy("block")).applyInArrow(
        _remove(length),
        "doc_id long, row long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept string",
    )
