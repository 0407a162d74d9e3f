"""DartMinHash near-duplicates: weighted five-word shingles, sparse signatures, banded joining, exact checks.

A shingle with weight w (its count in the text) is a region of w unit cells. Darts fall on each cell
with rate 1 per unit of rank; number, coordinate and rank of the darts of a cell depend on a
hash only, so equal cells of different texts receive the same darts. A text looks at darts up to a rank
at which every coordinate is likely to be hit, and keeps the earliest dart per coordinate: two texts
agree in a coordinate with probability equal to their weighted Jaccard similarity. The work is that
of the darts, not of shingles times coordinates.

Bands of coordinates join texts; a bucket holds texts of one band value and of sizes that allow the
similarity. No pairs of a bucket are made. First every bucket compares its texts with one hub, the text that
shares most with others, which is the centre of a group of copies; the links found make classes, and a bucket whose
texts are all in one class is done. What is left, buckets that still hold several classes, is cut into
blocks of bounded size: texts that are connected by such buckets meet, block by block, and each is compared
with those of other classes, by signature and then exactly on whole shingle counts. Only links that join two
classes leave a block. So every pair of texts that shares a bucket and has the similarity ends in one
class. Equal texts are collapsed beforehand.

A pair at 0.8 shares none of the 32 bands of five with probability (1 - 0.8^5)^32 < 4e-6, and agrees in under 0.6
of the 160 coordinates, which rules it out, with probability < 1e-8 (0.66 in blocks: < 1e-5).

Defined results: texts are compared by their words; a text under five words is one shingle of all its words.
Texts without words (NULL and empty included) are equal to each other and near nothing else. Repeated rows
are in one class. The class id is the smallest doc_id of the class (NULL if all are NULL). Extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.lines import row_of
from martwright.llm.links import components
from martwright.llm.text import mix64, runs_of, utf8, windows64, word_digests
from martwright.session import materialize

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 32, 5
# Signatures rule a pair out if they agree in fewer coordinates; in blocks, which see many near misses, sooner.
RULED_OUT, RULED_OUT_IN_BLOCKS = 0.6, 0.66
BLOCK_BYTES = 32_000_000  # cells of the texts of one block; two blocks meet in a task
# Rank intervals: one below 2^-8, doubling up to 1, then of length 1; never more than one dart expected.
LOW = 8
STEP = np.uint64(0x9E3779B97F4A7C15)


def interval(k: int) -> tuple[float, float]:
    if k == 0:
        return 0.0, 2.0**-LOW
    if k <= LOW:
        return 2.0 ** (k - 1 - LOW), 2.0 ** (k - LOW)
    return float(k - LOW), float(k - LOW + 1)


def counts_table(mean: float) -> np.ndarray:
    """Cumulative Poisson probabilities."""
    p, total, out = math.exp(-mean), 0.0, []
    for k in range(40):
        total += p
        out.append(total)
        p *= mean / (k + 1)
    return np.array(out)


def cells(words: np.ndarray, owner: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Unit cells of many texts: ``words`` are word digests, ``owner`` the number of their text, in order.

    The j-th occurrence of a shingle in a text is its j-th cell, the same one in every text.
    """
    shingles, of = [], []
    if len(words) >= n:
        whole = windows64(words, n)
        same = owner[: len(whole)] == owner[n - 1 :]
        shingles.append(whole[same])
        of.append(owner[: len(whole)][same])
    sizes = np.bincount(owner) if len(owner) else np.empty(0, dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    for k in range(1, n):
        short = np.flatnonzero(sizes == k)
        if len(short):
            with np.errstate(over="ignore"):
                h = np.full(len(short), k, dtype=np.uint64)
                for j in range(k):
                    h = h * STEP + words[starts[short] + j]
            shingles.append(mix64(h))
            of.append(short)
    if not shingles:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    shingle, of = np.concatenate(shingles), np.concatenate(of)
    key = shingle ^ mix64(of.astype(np.uint64) * STEP)
    order = np.argsort(key, kind="stable")
    first = np.append(True, key[order][1:] != key[order][:-1]) if len(order) else np.empty(0, dtype=bool)
    place = np.arange(len(order))
    nth = np.empty(len(order), dtype=np.uint64)
    nth[order] = place - np.maximum.accumulate(np.where(first, place, 0))
    with np.errstate(over="ignore"):
        return mix64(shingle + nth * np.uint64(0xD6E8FEB86659FD93)), of


def signatures(cell: np.ndarray, of: np.ndarray, texts: int, coordinates: int) -> np.ndarray:
    """The earliest dart of each coordinate, one row per text; texts without cells get zeros."""
    weight = np.bincount(of, minlength=texts)
    out = np.zeros((texts, coordinates), dtype=np.uint64)
    best = np.full((texts, coordinates), np.inf)
    open_ = weight > 0
    limit = np.zeros(texts)
    limit[open_] = (coordinates * math.log(coordinates) + 3 * coordinates) / weight[open_]
    while open_.any():
        mine = open_[of]
        c, o = cell[mine], of[mine]
        top = limit[o]
        k = 0
        while len(c):
            low, high = interval(k)
            near = top > low
            c, o, top = c[near], o[near], top[near]
            if not len(c):
                break
            with np.errstate(over="ignore"):
                seed = mix64(c + np.uint64(k + 1) * STEP)
            number = np.searchsorted(counts_table(high - low), (seed >> np.uint64(11)) * 2.0**-53, side="right")
            hit = number > 0
            number, base, text, stop = number[hit], seed[hit], o[hit], top[hit]
            for d in range(int(number.max(initial=0))):
                more = number > d
                with np.errstate(over="ignore"):
                    dart = mix64(base[more] ^ (np.uint64(d + 1) * STEP))
                    fine = mix64(dart + STEP)
                rank = low + (high - low) * ((fine >> np.uint64(11)) * 2.0**-53)
                inside = rank < stop[more]
                dart, rank, owner = dart[inside], rank[inside], text[more][inside]
                slot = owner * coordinates + ((dart >> np.uint64(32)) % np.uint64(coordinates)).astype(np.int64)
                np.minimum.at(best.reshape(-1), slot, rank)
                won = best.reshape(-1)[slot] == rank
                out.reshape(-1)[slot[won]] = dart[won]
            k += 1
        # texts with a coordinate that no dart has hit look further
        open_ = open_ & np.isinf(best).any(axis=1)
        limit[open_] *= 2
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One uint64 per text and band."""
    texts = len(signature)
    parts = signature.reshape(texts, bands, rows)
    with np.errstate(over="ignore"):
        key = np.arange(1, bands + 1, dtype=np.uint64) * STEP + np.zeros((texts, 1), dtype=np.uint64)
        for r in range(rows):
            key = mix64(key * np.uint64(31) + parts[:, :, r])
    return key


def split_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Digests of all words, the number of the text of each, and a 128-bit key of each text's words."""
    low, _, counts = word_digests(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    keys = [hashlib.blake2b(b" ".join(t.split()), digest_size=16).digest() for t in texts]
    return low, owner, keys


def _sketch(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs_of(batches, 2_000_000):
            texts = utf8(batch.column("text"))
            words, owner, keys = split_words(texts)
            cell, of = cells(words, owner)
            signed = signatures(cell, of, len(texts), bands * rows)
            found = band_keys(signed, bands, rows)
            sizes = np.bincount(of, minlength=len(texts))
            lists = [x if n else None for n, x in zip(sizes.tolist(), found.view(np.int64).tolist(), strict=True)]
            short = (signed >> np.uint64(16)).astype(np.uint16)  # bits that do not choose the coordinate
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row"),
                    pa.array(keys, pa.binary()),
                    pa.array(lists, pa.list_(pa.int64())),
                    pa.array([x.tobytes() for x in short], pa.binary()),
                    pa.array(sizes, pa.int64()),
                ],
                names=["doc_id", "row", "text_key", "bands", "signature", "cells"],
            )

    return run


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id``, ``row`` (of equal ids, tells texts apart), ``text_key`` (equal for equal words), ``bands``,
    ``signature`` (16 bits per coordinate) and ``cells`` (their number)."""
    read = docs.select("doc_id", "text", row_of(F.col("text")).alias("row"))
    shape = "doc_id long, row long, text_key binary, bands array<long>, signature binary, cells long"
    return read.mapInArrow(_sketch(bands, rows), shape)


def _cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in runs_of(batches, 2_000_000):
        texts = utf8(batch.column("text"))
        words, owner, keys = split_words(texts)
        cell, of = cells(words, owner)
        order = np.lexsort((cell, of))
        ends = np.cumsum(np.bincount(of, minlength=len(texts))).tolist()
        sorted_ = cell[order]
        rows = [(k, sorted_[a:b].tobytes()) for k, w, a, b in zip(keys, batch.column("text_key").to_pylist(), [0, *ends], ends, strict=False) if k == w]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in rows], pa.binary()), pa.array([c for _, c in rows], pa.binary())], names=["text_key", "cells"]
        )


def _jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Similarity of two texts by their sorted cells; a cell occurs once in a text."""
    both = np.concatenate([x, y])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(x) + len(y) - shared)


def _similarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("cells").to_pylist(), batch.column("hub_cells").to_pylist(), strict=True)
        found = [_jaccard(np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)) for a, b in pairs]
        yield pa.RecordBatch.from_arrays([batch.column("text_key"), batch.column("hub"), pa.array(found, pa.float64())], names=["text_key", "hub", "similarity"])


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(batch.num_rows, -1) for c in ("signature", "hub_signature"))
        yield pa.RecordBatch.from_arrays([batch.column("text_key"), batch.column("hub"), pa.array((a == b).mean(axis=1))], names=["text_key", "hub", "agreement"])


PAIR = "text_key binary, hub binary"


def compared(pairs: DataFrame, signed: DataFrame, cell_lists: DataFrame) -> DataFrame:
    """``similarity`` of pairs ``text_key, hub``: exact, or NULL where the signatures rule the pair out."""

    def both(pairs: DataFrame, side: DataFrame, column: str) -> DataFrame:
        hubs = side.select(F.col("text_key").alias("hub"), F.col(column).alias(f"hub_{column}"))
        return pairs.join(side.select("text_key", column), "text_key").join(hubs, "hub")

    judged = materialize(both(pairs, signed, "signature").mapInArrow(_agreement, f"{PAIR}, agreement double"), "judged")
    close = both(judged.filter(F.col("agreement") >= RULED_OUT).drop("agreement"), cell_lists, "cells")
    far = judged.filter(F.col("agreement") < RULED_OUT).select("text_key", "hub", F.lit(None).cast("double").alias("similarity"))
    return close.mapInArrow(_similarity, f"{PAIR}, similarity double").unionByName(far)


def links(sketched: DataFrame, docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Links ``a, b, similarity`` between different texts (by text_key) that join all texts of a class."""
    by_text = sketched.filter("bands IS NOT NULL").groupBy("text_key")
    bands = by_text.agg(F.first("bands").alias("bands"), F.first("cells").alias("cells"))
    bands = bands.select("text_key", "cells", F.explode("bands").alias("band"))
    crowded = lambda df, key: df.join(df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1"), key)
    # similar texts differ little in size: each text is filed under its size class and the next
    size_class = F.floor(F.log(F.col("cells")) / F.lit(math.log(1 / similar))).cast("int")
    filed = materialize(crowded(bands, "band").select("text_key", "band", F.explode(F.array(size_class, size_class + 1)).alias("size")), "filed")
    bucket = F.xxhash64("band", "size").alias("bucket")
    members = crowded(filed.select("text_key", bucket), "bucket")
    # texts that meet many others are the centre of their group, so they go first
    reach = F.sum("n").over(Window.partitionBy("text_key"))
    left = materialize(members.select("bucket", "text_key", reach.alias("reach")), "left")
    signed = by_text.agg(F.first("signature").alias("signature"), F.min(F.struct("doc_id", "row")).alias("one"))
    signed = materialize(signed.join(left.select("text_key").distinct(), "text_key", "left_semi"), "signed")
    wanted = signed.select("text_key", F.col("one.doc_id").alias("of"), F.col("one.row").alias("of_row"))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (row_of(F.col("text")) == F.col("of_row"))
    # repeated rows deliver their text once
    chosen = docs.select("doc_id", "text").join(wanted, same).select("text", "text_key").dropDuplicates(["text_key"])
    cell_lists = chosen.mapInArrow(_cells_of, "text_key binary, cells binary")
    cell_lists = materialize(cell_lists, "cells")
    hub = left.groupBy("bucket").agg(F.max(F.struct("reach", "text_key"))["text_key"].alias("hub"))
    pairs = left.join(hub, "bucket").filter("text_key <> hub")
    pairs = pairs.select(F.least("text_key", "hub").alias("text_key"), F.greatest("text_key", "hub").alias("hub")).distinct()
    result = materialize(compared(pairs, signed, cell_lists), "compared")
    linked = result.filter(F.col("similarity") >= similar).select(F.col("text_key").alias("a"), F.col("hub").alias("b"), "similarity")
    classes_so_far = components(linked.select("a", "b"))
    labelled = left.select("bucket", "text_key").join(classes_so_far, F.col("text_key") == F.col("node"), "left")
    labelled = labelled.select("bucket", "text_key", F.coalesce("root", "text_key").alias("label"))
    several = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("text_key").alias("b"))
    open_ = materialize(labelled.join(several.filter("low < high").select("bucket", "b"), "bucket"), "open")
    return linked.unionByName(_in_blocks(open_, signed, cell_lists, similar))


def _in_blocks(open_: DataFrame, signed: DataFrame, cell_lists: DataFrame, similar: float) -> DataFrame:
    """Links between classes among texts that are connected by buckets (rows ``bucket, text_key, label, b``)."""
    together = components(open_.select(F.col("text_key").alias("a"), "b"))
    texts = open_.select("text_key", "label").distinct().join(together, F.col("text_key") == F.col("node"))
    texts = texts.select("text_key", "label", F.col("root").alias("together")).join(signed.select("text_key", "signature"), "text_key")
    texts = materialize(texts.join(cell_lists, "text_key"), "texts")
    sizes = texts.groupBy("together").agg(F.ceil(F.sum(F.octet_length("cells")) / F.lit(BLOCK_BYTES)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("text_key"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = texts.join(sizes, "together").withColumn("block", block).withColumn("other", other)
    met = met.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "blocks")
    return met.groupBy("together", "i", "j").applyInArrow(_join_classes(similar), "a binary, b binary, similarity double")


def _join_classes(similar: float):
    def run(table: pa.Table) -> pa.Table:
        """Compare texts of different classes; of a pair of classes, one link is enough."""
        names = table.column("text_key").to_pylist()
        signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint16).reshape(len(names), -1)
        cells_ = [np.frombuffer(x, dtype=np.uint64) for x in table.column("cells").to_pylist()]
        block = np.asarray(table.column("block"))
        number = {}
        root = np.array([number.setdefault(x, len(number)) for x in table.column("label").to_pylist()])
        two = block.min() != block.max()
        links: list[tuple[bytes, bytes, float]] = []
        # texts of the smaller classes look for partners; when all classes but one have looked, all pairs are seen
        size = np.bincount(root)[root]
        order = np.lexsort((np.arange(len(names)), size))
        looked = np.zeros(len(names), dtype=bool)
        for i in order.tolist():
            looked[i] = True
            others = ~looked & (root != root[i])
            if two:
                others &= block != block[i]
            at = np.flatnonzero(others)
            if not len(at):
                continue
            agree = (signature[at] == signature[i]).mean(axis=1)
            at, agree = at[agree >= RULED_OUT_IN_BLOCKS], agree[agree >= RULED_OUT_IN_BLOCKS]
            for j in at[np.argsort(-agree, kind="stable")].tolist():
                if root[j] == root[i]:
                    continue
                found = _jaccard(cells_[i], cells_[j])
                if found >= similar:
                    links.append((names[i], names[j], found))
                    root[root == root[j]] = root[i]
        columns = list(zip(*links, strict=True)) if links else [[], [], []]
        kinds = [pa.binary(), pa.binary(), pa.float64()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["a", "b", "similarity"])

    return run


def classes(docs: DataFrame, similar: float = SIMILAR, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: ``doc_id``, ``row``, ``class_id``, ``class_size`` and ``stays`` (the class's one document)."""
    sketched = materialize(sketches(docs, bands, rows), "sketches")
    found = components(links(sketched, docs, similar).select("a", "b"))
    roots = sketched.select("doc_id", "row", "text_key").join(found, F.col("text_key") == F.col("node"), "left")
    members = roots.select("doc_id", "row", F.coalesce("root", "text_key").alias("root"))
    one = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    groups = members.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"), F.min(one).alias("one"))
    return members.join(groups, "root").select("doc_id", "row", "class_id", "class_size", one.eqNullSafe(F.col("one")).alias("stays"))


def one_of_each(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The documents, one of each class; of a class the one with the smallest doc_id, once."""
    chosen = classes(docs, similar).filter("stays").select(F.col("doc_id").alias("of"), F.col("row").alias("of_row")).distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    rows = rows.select("doc", F.col("doc.doc_id").alias("id"), row_of(F.col("doc.text")).alias("row"))
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row"))
    return rows.join(chosen, same, "left_semi").dropDuplicates(["id", "row"]).select("doc.*")
