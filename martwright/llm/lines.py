"""Line deduplication: range-partitioned line digests in, compressed bitmaps of lines to keep out.

Digests of lines travel, not lines: 128 bits, document and position are range-partitioned and sorted
by (digest, document), and each task streams over its sorted rows and decides run by run. A run that
touches a border of its range (a very common line fills several ranges) is left open; open runs are
settled by adding up one partial count per range. Only lines to drop are returned, then
gathered per document into a compressed bitmap; texts are read once more to apply it.

Two modes. ``min_documents=k`` drops every line whose key occurs in at least k documents;
``min_documents=None`` keeps the first occurrence of each key by (doc_id, position) and drops the rest.

Defined results: a NULL or empty text is one empty line. A key is the line without ASCII white space
at both ends and with A-Z in lower case; keys under ``min_chars`` characters are never dropped. Rows
that share a doc_id (NULL included) are one document when documents are counted; each row keeps its own
bitmap, and equal rows get equal bitmaps. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.llm.text import runs_of, utf8
from martwright.session import materialize

EDGE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOUND = "h1 long, h2 long, doc_id long, row long, pos int, drop boolean, documents long"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(EDGE)), UPPER, LOWER)


def row_of(text: Column) -> Column:
    """Tells apart rows that share a doc_id; rows equal in doc_id and text need no telling apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line that may be dropped: digest, document, position."""
    lines = docs.select(
        "doc_id", row_of(F.col("text")).alias("row"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line")
    )
    keyed = lines.select("doc_id", "row", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    return keyed.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc_id", "row", "pos"
    )


def _stream(min_documents: int | None):
    """Decide runs of equal digests in sorted rows. Memory holds one batch, and of an open run only
    its positions; an inner run longer than a batch is decided as soon as the count is reached."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        need = min_documents
        rest: pa.Table | None = None
        first = True
        run = None  # digest of the first run, which stays open

        def out(table: pa.Table, digest: np.ndarray, starts: np.ndarray, opened: np.ndarray):
            """Rows of whole runs; ``starts`` are run starts, ``opened`` tells which stay open."""
            n = table.num_rows
            ends = np.append(starts[1:], n)
            doc = _ids(table)
            new_doc = np.ones(n, dtype=np.int64)
            new_doc[1:] = doc[1:] != doc[:-1]
            new_doc[starts] = 1
            counts = np.add.reduceat(new_doc, starts) if n else np.empty(0, dtype=np.int64)
            per_row = np.repeat(np.arange(len(starts)), ends - starts)
            if need is None:
                drop = np.ones(n, dtype=bool)
                drop[starts] = False
            else:
                drop = counts[per_row] >= need
            is_open = opened[per_row]
            documents = np.zeros(n, dtype=np.int64)
            documents[starts] = counts
            keep = drop | is_open
            flag = pa.array(drop[keep], mask=is_open[keep])
            sub = table.filter(pa.array(keep))
            return pa.RecordBatch.from_arrays(
                [sub.column(c).combine_chunks() for c in ("h1", "h2", "doc_id", "row", "pos")]
                + [flag, pa.array(np.where(is_open, documents, 0)[keep])],
                names=["h1", "h2", "doc_id", "row", "pos", "drop", "documents"],
            )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table]).combine_chunks()
            if not table.num_rows:
                continue
            h = np.stack([table.column(c).to_numpy() for c in ("h1", "h2")])
            starts = np.flatnonzero(np.append(True, (h[:, 1:] != h[:, :-1]).any(axis=0)))
            last = int(starts[-1])
            if last == 0 and table.num_rows < 100_000:
                rest = table
                continue
            if last == 0:
                # one run longer than the buffer: pass it on as open, the counts add up later
                yield out(table.slice(0, table.num_rows), h, np.array([0]), np.array([True]))
                rest, run, first = None, tuple(h[:, 0]), False
                continue
            opened = np.zeros(len(starts) - 1, dtype=bool)
            opened[0] = first or run == tuple(h[:, 0])
            first, run = False, None
            yield out(table.slice(0, last), h[:, :last], starts[:-1], opened)
            rest = table.slice(last).combine_chunks()
        if rest is not None and rest.num_rows:
            yield out(rest, None, np.array([0]), np.array([True]))

    return decide


def _ids(table: pa.Table) -> np.ndarray:
    """doc_id as numbers that differ where the ids differ, NULL included."""
    column = table.column("doc_id")
    filled = column.fill_null(0).to_numpy()
    null = column.is_null().to_numpy()
    return np.where(null, np.int64(-(2**62)) - 1, filled)


def dropped_lines(docs: DataFrame, min_documents: int | None, min_chars: int = 1) -> DataFrame:
    """``doc_id``, ``row``, ``pos`` of every line to drop, written once to the shared folder."""
    found = (
        occurrences(docs, min_chars)
        .repartitionByRange("h1", "h2", "doc_id", "row", "pos")
        .sortWithinPartitions("h1", "h2", "doc_id", "row", "pos")
        .mapInArrow(_stream(min_documents), FOUND)
    )
    found = materialize(found, "lines")
    undecided = found.filter(F.col("drop").isNull())
    if min_documents is None:
        place = F.struct("doc_id", "row", "pos")
        firsts = undecided.groupBy("h1", "h2").agg(F.min(place).alias("first"))
        late = undecided.join(F.broadcast(firsts), ["h1", "h2"]).filter(place != F.col("first"))
    else:
        # Open runs touch a border of a range, so their digests number at most two per range: safe to broadcast.
        # The sum over ranges counts a document on a border twice; where it reaches the limit, count exactly
        likely = undecided.groupBy("h1", "h2").agg(F.sum("documents").alias("most")).filter(F.col("most") >= min_documents)
        documents = undecided.join(F.broadcast(likely), ["h1", "h2"]).select(
            "h1", "h2", F.coalesce("doc_id", F.lit(0).cast("long")).alias("d"), F.col("doc_id").isNull().alias("none")
        )
        common = documents.distinct().groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= min_documents)
        late = undecided.join(F.broadcast(common), ["h1", "h2"], "left_semi")
    columns = ["doc_id", "row", "pos"]
    return found.filter("drop").select(*columns).unionByName(late.select(*columns)).distinct()


@F.pandas_udf(T.BinaryType())
def _bitmap(dropped: pd.Series) -> pd.Series:
    """zlib of the bits, one per line up to the last dropped line: 1 means keep."""

    def one(places) -> bytes:
        bits = np.ones((int(max(places)) // 8 + 1) * 8, dtype=np.uint8)
        bits[np.asarray(places, dtype=np.int64)] = 0
        return zlib.compress(np.packbits(bits).tobytes(), 6)

    return dropped.map(one)


def keep_bitmaps(docs: DataFrame, min_documents: int | None, min_chars: int = 1) -> DataFrame:
    """``doc_id``, ``row``, ``keep`` (compressed bitmap; lines beyond its end stay) and ``n_dropped``,
    for documents that lose a line."""
    lost = dropped_lines(docs, min_documents, min_chars)
    per_doc = lost.groupBy("doc_id", "row").agg(F.collect_list("pos").alias("places"))
    return per_doc.select("doc_id", "row", _bitmap("places").alias("keep"), F.size("places").cast("long").alias("n_dropped"))


def _apply(at: int):
    """Cut the lines out of the text column, which is column number ``at``; the bitmap comes last."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in runs_of(iter([whole]), 16_000_000, f"c{at}"):
                texts = []
                for text, keep in zip(utf8(batch.column(at)), batch.column("keep").to_pylist(), strict=True):
                    if keep is not None:
                        lines = text.split(b"\n")
                        bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), dtype=np.uint8))
                        gone = set(np.flatnonzero(bits[: len(lines)] == 0).tolist())
                        text = b"\n".join([x for i, x in enumerate(lines) if i not in gone])
                    texts.append(text)
                columns = [c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != "keep"]
                columns[at] = pa.array(texts, type=pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=[n for n in batch.schema.names if n != "keep"])

    return cut


def drop_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``doc``, a struct of the document's columns with the lines gone from its text, and ``n_lines``
    (before) and ``n_dropped``."""
    at, names = docs.columns.index("text"), docs.columns
    rows = docs.select(
        *[docs[c].alias(f"c{i}") for i, c in enumerate(names)],
        F.size(F.split(F.coalesce(docs["text"], F.lit("")), "\n")).cast("long").alias("n_lines"),
        row_of(docs["text"]).alias("row"),
    )
    marks = bitmaps.select(F.col("doc_id").alias("of"), F.col("row").alias("of_row"), "keep", "n_dropped")
    same = F.col(f"c{names.index('doc_id')}").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row"))
    lost = F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped")
    fed = rows.join(marks, same, "left").select(*[f"c{i}" for i in range(len(names))], "n_lines", lost, "keep")
    done = fed.mapInArrow(_apply(at), fed.drop("keep").schema)
    doc = F.struct(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
    return done.select(doc.alias("doc"), "n_lines", "n_dropped")


def deduplicated(docs: DataFrame, min_documents: int | None, min_chars: int = 1) -> DataFrame:
    """The documents with the lines gone from their texts and all other columns kept."""
    return drop_lines(docs, keep_bitmaps(docs, min_documents, min_chars)).select("doc.*")
