"""Hard negatives by a vertical scan: dimensions in each anchor's own order, bounds from what remains.

Rows are packed into blocks that hold one column per dimension with its smallest and largest value. For an anchor a block's
dimensions are read in descending magnitude of the anchor's components, ``STEP`` at a time. After each step every
candidate has a partial score, and the least and most that the remaining dimensions can add follow from their smallest and
largest values. Candidates that cannot come among the best, or into any window, leave the bitmap; who stays to the end has its
exact score. A first pass finds each anchor's positives, a second one the rows in the windows below their scores.

Anchors meet all rows in cells: ``SLOT`` blocks by ``SUPER`` anchors at most, so a cell's memory does not depend
on the table. A cell returns its best rows only, and a ranking per anchor (or window) joins the cells.

Defined results: rows without an id or a label, without a vector, or with a NULL or non-finite component take no part. Rows
equal in all three count once; rows that share an id only are rows of their own, but never each other's positive
or negative. Equal scores are ordered by id, then by a digest of the row. Shorter vectors count as filled up with zeros; an empty one
scores 0. Components and scores beyond 64 bits count as the nearest 64-bit integer; all others are exact. An empty table gives no rows. Extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.session import materialize

BLOCK = 2048  # rows of a block
SLOT = 64  # blocks of a cell
GROUP = 256  # anchors that are packed together
SUPER = 128  # such groups of a cell
STEP = 8  # dimensions between two looks at the bounds

PACKED = "part int, seq int, n int, width int, dims int, ids binary, rows binary, labels binary, data binary"


def quantized(vector: str, scale: float) -> Column:
    """Components as integers: floor(scale * component)."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))


def usable(rows: DataFrame) -> DataFrame:
    """Of rows (``id``, ``label``, ``vector`` of floats), those that take part."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    known = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
    return rows.filter(known & F.forall("vector", lambda x: finite(x.cast("double"))))


def _pack(size: int, by_dimension: bool):
    """Rows of each partition in blocks of ``size``: the components of all rows, dimension after dimension or row after row."""

    def one(table: pa.Table, part: int, seq: int) -> pa.RecordBatch:
        vectors = table.column("ints").combine_chunks()
        lengths = np.asarray(vectors.value_lengths(), dtype=np.int64)
        dims = int(lengths.max())
        matrix = np.zeros((len(lengths), dims), dtype=np.int64)
        matrix[np.arange(dims) < lengths[:, None]] = np.asarray(vectors.flatten(), dtype=np.int64)
        most = max(int(matrix.max()), -int(matrix.min())) if matrix.size else 0
        width = 2 if most < 2**15 else 4 if most < 2**31 else 8
        data = (matrix.T if by_dimension else matrix).astype(f"<i{width}").tobytes()
        ids, rows, labels = (np.asarray(table.column(c).combine_chunks(), dtype="<i8").tobytes() for c in ("id", "row", "label"))
        values = (part, seq, len(lengths), width, dims, ids, rows, labels, data)
        return pa.RecordBatch.from_pydict({f.split()[0]: [v] for f, v in zip(PACKED.split(", "), values, strict=True)}, schema=_SCHEMA)

    def pack(batches):
        held, n, seq, part = [], 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            held.append(batch)
            n += batch.num_rows
            while n >= size:
                table = pa.Table.from_batches(held)
                yield one(table.slice(0, size), part, seq)
                held, n, seq = table.slice(size).to_batches(), n - size, seq + 1
        if n:
            yield one(pa.Table.from_batches(held), part, seq)

    return pack


_TYPES = {"int": pa.int32(), "binary": pa.binary()}
_SCHEMA = pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in PACKED.split(", ")])


def packed(rows: DataFrame, size: int, by_dimension: bool) -> DataFrame:
    """Rows (``id``, ``label``, ``ints``), each once, in written blocks."""
    once = rows.select(F.col("id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"), "ints").dropDuplicates()
    keyed = once.withColumns({"row": F.xxhash64("label", "ints"), "part": F.spark_partition_id()})
    return materialize(keyed.mapInArrow(_pack(size, by_dimension), PACKED), "blocks")


class Packed:
    """Unpacked blocks; numbers are doubles as long as all scores are exact in them, else Python integers."""

    def __init__(self, row: dict, by_dimension: bool):
        self.n, self.dims = row["n"], row["dims"]
        shape = (self.dims, self.n) if by_dimension else (self.n, self.dims)
        self.data = np.frombuffer(row["data"], dtype=f"<i{row['width']}").reshape(shape)
        self.ids, self.rows, self.labels = (np.frombuffer(row[c], dtype="<i8") for c in ("ids", "rows", "labels"))

    def most(self) -> int:
        return max(abs(int(self.data.max())), abs(int(self.data.min()))) if self.data.size else 0


def _in_64_bits(scores: np.ndarray) -> np.ndarray:
    return scores if scores.dtype != object else np.clip(scores, -(2**63), 2**63 - 1)


class Anchor:
    """An anchor's components in descending magnitude, with what the dimensions from each place on can add at least and most."""

    def __init__(self, vector: np.ndarray, low: np.ndarray, high: np.ndarray):
        order = np.argsort(-np.abs(vector), kind="stable")
        self.order = order[vector[order] != 0]
        self.values = vector[self.order]
        ends = self.values * low[self.order], self.values * high[self.order]
        nothing = vector[:0].sum(keepdims=True)
        self.least = np.concatenate([np.cumsum(np.minimum(*ends)[::-1])[::-1], nothing])
        self.most = np.concatenate([np.cumsum(np.maximum(*ends)[::-1])[::-1], nothing])

    def scan(self, columns: np.ndarray, candidates: np.ndarray, prune, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
        """Candidates that ``prune`` (given the least and most scores possible) lets through to the end, and their scores."""
        scores = np.zeros(len(candidates), dtype=columns.dtype)
        for start in range(0, len(self.order), step):
            dims = self.order[start : start + step]
            scores = scores + self.values[start : start + step] @ columns[np.ix_(dims, candidates)]
            after = start + len(dims)
            stays = prune(_in_64_bits(scores + self.least[after]), _in_64_bits(scores + self.most[after]))
            candidates, scores = candidates[stays], scores[stays]
            if not len(candidates):
                break
        return candidates, _in_64_bits(scores)


def _first(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((rows, ids, -scores))[:k]


def _best_of(k: int):
    """Lets through who may be among the ``k`` highest."""

    def prune(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        return most >= np.sort(least)[-k] if len(least) > k else np.ones(len(least), dtype=bool)

    return prune


def _columns(block: Packed, dims: int, plain: bool) -> np.ndarray:
    columns = np.zeros((dims, block.n), dtype=np.float64 if plain else object)
    columns[: block.dims] = block.data if plain else block.data.astype(object)
    return columns


def _cell(k: int, windows: bool, low: int, high: int):
    """All anchors of a cell against all its blocks: the best rows of the anchor's label, or those of other labels in its windows."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        out = {c: [] for c in ("anchor_id", "anchor_row", "window", "id", "row", "score")}
        groups = [(Packed(r, False), r["scores"]) for r in right.to_pylist()]
        for r in left.to_pylist():
            block = Packed(r, True)
            for group, known in groups:
                dims = max(block.dims, group.dims)
                plain = max(block.most(), 1) * max(group.most(), 1) * max(dims, 1) < 2**52
                columns = _columns(block, dims, plain)
                none = np.zeros(dims, dtype=columns.dtype)
                ends = (columns.min(axis=1), columns.max(axis=1)) if dims else (none, none)
                vectors = np.zeros((group.n, dims), dtype=columns.dtype)
                vectors[:, : group.dims] = group.data if plain else group.data.astype(object)
                for i in range(group.n):
                    a_id, a_row, label = int(group.ids[i]), int(group.rows[i]), group.labels[i]
                    if windows:
                        spans = sorted({s for s in known[i] if s >= 0}, reverse=True)
                        candidates = np.flatnonzero((block.labels != label) & (block.ids != a_id)) if spans else []
                    else:
                        candidates = np.flatnonzero((block.labels == label) & (block.ids != a_id))
                    if not len(candidates):
                        continue
                    anchor = Anchor(vectors[i], *ends)
                    if windows:
                        # low * span <= high * score, in whole numbers: score >= ceil(low * span / high)
                        floor, ceiling = -(-low * spans[-1] // high), spans[0]
                        found, scores = anchor.scan(columns, candidates, lambda least, most: (most >= floor) & (least <= ceiling))
                        parts = [(s, (scores >= -(-low * s // high)) & (scores <= s)) for s in spans] if len(found) else []
                    else:
                        found, scores = anchor.scan(columns, candidates, _best_of(k))
                        parts = [(0, np.ones(len(found), dtype=bool))]
                    for span, inside in parts:
                        at, of = found[inside], scores[inside]
                        best = _first(of, block.ids[at], block.rows[at], k)
                        out["id"] += block.ids[at[best]].tolist()
                        out["row"] += block.rows[at[best]].tolist()
                        out["score"] += [int(s) for s in of[best]]
                        for c, v in (("anchor_id", a_id), ("anchor_row", a_row), ("window", span)):
                            out[c] += [v] * len(best)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return run


SCORED = "anchor_id bigint, anchor_row bigint, window bigint, id bigint, row bigint, score bigint"


def _in_cells(blocks: DataFrame, groups: DataFrame, run) -> DataFrame:
    """Every block meets every anchor group once, in cells of bounded size; small tables are cut into as many cells as run at a time."""
    spark = blocks.sparkSession
    sizes = [df.agg(F.count("*"), F.coalesce(F.max("part"), F.lit(0)) + 1).first() for df in (blocks, groups)]
    slots = max(1, -(-sizes[0][0] // SLOT), min(sizes[0][0], 2 * spark.sparkContext.defaultParallelism))
    supers = max(1, -(-sizes[1][0] // SUPER))

    def dealt(df: DataFrame, parts: int, into: int) -> Column:
        return F.pmod(F.col("part") + F.col("seq") * parts, F.lit(into)).cast("int")

    def copies(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = blocks.withColumn("slot", dealt(blocks, sizes[0][1], slots)).withColumn("super", copies(supers))
    right = groups.withColumn("super", dealt(groups, sizes[1][1], supers)).withColumn("slot", copies(slots))
    return left.groupBy("slot", "super").cogroup(right.groupBy("slot", "super")).applyInArrow(run, SCORED)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "anchor_row", "window").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """For each anchor and each of its best ``positives`` rows of the same label, the best ``negatives`` rows of other labels whose
    score is at most the positive's and at least ``low`` / ``high`` of it.

    ``rows``: ``id``, ``label``, ``ints``. Columns: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.
    """
    blocks = packed(rows, BLOCK, True)
    anchors = packed(rows.filter(is_anchor), GROUP, False)
    unknown = F.lit(None).cast("array<array<bigint>>")
    best = _ranked(_in_cells(blocks, anchors.withColumn("scores", unknown), _cell(positives, False, low, high)), positives)
    best = materialize(best.select("anchor_id", "anchor_row", F.col("id").alias("positive_id"), F.col("row").alias("positive_row"), F.col("score").alias("window")), "positives")

    # each group of anchors gets its positives' scores, in the order of its anchors
    members = anchors.select("part", "seq", F.posexplode(_longs("ids", "n")).alias("at", "anchor_id"), _longs("rows", "n").alias("all_rows"))
    members = members.withColumn("anchor_row", F.get("all_rows", F.col("at"))).drop("all_rows")
    lists = best.groupBy("anchor_id", "anchor_row").agg(F.collect_set("window").alias("scores"))
    none = F.array().cast("array<bigint>")
    told = members.join(lists, ["anchor_id", "anchor_row"], "left").select("part", "seq", F.struct("at", F.coalesce("scores", none).alias("s")).alias("one"))
    told = told.groupBy("part", "seq").agg(F.transform(F.array_sort(F.collect_list("one")), lambda x: x["s"]).alias("scores"))
    found = _ranked(_in_cells(blocks, anchors.join(told, ["part", "seq"]), _cell(negatives, True, low, high)), negatives)
    return best.join(found, ["anchor_id", "anchor_row", "window"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        F.col("window").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def _longs(packed_ids: str, n: str) -> Column:
    """Packed little-endian 64-bit integers as an array."""
    hexed = F.hex(packed_ids)

    def number(i: Column) -> Column:
        digits = F.concat(*[F.substr(hexed, i * 16 + k, F.lit(2)) for k in range(15, 0, -2)])
        return F.conv(digits, 16, -10).cast("bigint")

    return F.transform(F.sequence(F.lit(0), F.col(n) - 1), number)
