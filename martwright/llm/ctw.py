"""Context-tree weighting: a byte model of the corpus, and the code length of every text under it.

A byte is eight binary decisions; each decision has a context tree over the last ``DEPTH`` bytes. A node
counts the zeros and ones seen in training text, its Krichevsky-Trofimov estimate is weighed against the
product of its children (one half each, before seeing data), and a prediction mixes the estimates of all
depths by the weights that follow. Depths never seen in training have no say. A text is framed by the
byte 0xFF, which UTF-8 never uses, before its start and as its end.

Everything that is learnt is a count per (context, byte) string of ``DEPTH + 1`` bytes: pieces of text count
theirs, Spark sums them, trees are weighed in groups that share the two nearest context bytes, and only
the two top levels (at most 256 x 255 nodes, whatever the corpus) pass the driver. To score, documents are held in
blocks; each block's distinct strings and words are joined with the model, so texts never meet the whole model
and the model may be larger than any machine.

Beside the model's score stands a base score: add-one-half unigram probabilities of words and text ends.

Defined results: NULL and empty texts are scored as their end alone (one token). Documents with a NULL id
are learnt from. Repeated rows count and score each. Extra columns are not read. An empty table gives
an empty result; without training text every decision has probability one half.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.text import blocked, groups_of, in_bucket, runs_of, utf8, word_digests
from martwright.session import materialize

DEPTH = 4
BLOCK_CHARS = 16_000_000
PIECE = 2_000_000  # bytes whose strings are counted at a time
FRAME = b"\xff"
HALF = math.log(0.5)
# lgamma over half steps is looked up; beyond the table Stirling's series is exact to double precision
_SMALL = np.array([math.lgamma(max(k, 1) / 2) for k in range(4096)])


def lgamma_half(k: np.ndarray) -> np.ndarray:
    """log Gamma(k / 2) for whole k of at least 1."""
    x = k / 2.0
    big = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(k < len(_SMALL), _SMALL[np.minimum(k, len(_SMALL) - 1).astype(np.int64)], big)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return lgamma_half(2 * zeros + 1) + lgamma_half(2 * ones + 1) - lgamma_half(2 * (zeros + ones) + 2) - math.log(math.pi)


def strings_of(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte to predict (each text's bytes, then its end): context and byte as one number, nearest
    context byte first and the predicted byte last; and how many there are per text."""
    frame = FRAME * depth
    joined = np.frombuffer(b"".join(frame + t + FRAME for t in texts), dtype=np.uint8).astype(np.uint64)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    n = len(joined)
    code = joined[depth:].copy()
    for back in range(1, depth + 1):
        code |= joined[depth - back : n - back] << np.uint64(8 * (depth + 1 - back))
    # the frames between two texts are not predicted
    between = (np.cumsum(sizes[:-1] + depth)[:, None] + np.arange(depth)).ravel() - depth
    wanted = np.ones(len(code), dtype=bool)
    wanted[between] = False
    return code[wanted], sizes


class Tree:
    """All nodes below contexts that are complete in the given strings, by depth.

    ``codes`` are distinct, ``counts`` may be 0 (a string to score that training never showed).
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depth: int, top: int):
        byte = (codes & np.uint64(255)).astype(np.uint64)
        self.depth, self.top, self.n = depth, top, len(codes)
        prefixes = [(np.uint64(1) << np.uint64(j)) | (byte >> np.uint64(8 - j)) for j in range(8)]
        bits = [((byte >> np.uint64(7 - j)) & np.uint64(1)).astype(bool) for j in range(8)]
        context = codes & ~np.uint64(255)
        keys = np.concatenate([context | p for p in prefixes])
        self.bit = np.concatenate(bits)
        number = np.tile(counts, 8).astype(np.float64)
        self.levels = {}
        zeros, ones, product = np.where(self.bit, 0, number), np.where(self.bit, number, 0), None
        for d in range(depth, top - 1, -1):
            node, inverse = np.unique(keys, return_inverse=True)
            zeros = np.bincount(inverse, weights=zeros, minlength=len(node))
            ones = np.bincount(inverse, weights=ones, minlength=len(node))
            kt = log_kt(zeros, ones)
            if product is None:
                weighted = kt
            else:
                product = np.bincount(inverse, weights=product, minlength=len(node))
                weighted = np.logaddexp(HALF + kt, HALF + product)
            self.levels[d] = (node, inverse, zeros, ones, np.exp(HALF + kt - weighted) if d < depth else np.ones(len(node)))
            product = weighted
            # the parent forgets the byte furthest back, which is the lowest of the context
            keys = ((node >> np.uint64(16)) << np.uint64(8)) | (node & np.uint64(255))
        self.weighted = product

    def log10(self, upper: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """log10 probability of each string's byte. ``upper``: zeros, ones and weights of the levels above, by node number."""
        path = {}
        where = None
        for d in range(self.depth, self.top - 1, -1):
            node, inverse, zeros, ones, weight = self.levels[d]
            where = inverse if where is None else inverse[where]
            path[d] = (zeros[where], ones[where], weight[where])
            last = node[where]
        for d in range(self.top - 1, -1, -1):
            last = ((last >> np.uint64(16)) << np.uint64(8)) | (last & np.uint64(255))
            path[d] = tuple(x[last.astype(np.int64)] for x in upper[d])
        mixed, deeper = None, None
        for d in range(self.depth, -1, -1):
            zeros, ones, weight = path[d]
            seen = zeros + ones > 0
            estimate = (np.where(self.bit, ones, zeros) + 0.5) / (zeros + ones + 1)
            mixed = estimate if mixed is None else np.where(deeper, weight * estimate + (1 - weight) * mixed, estimate)
            deeper = seen
        return np.log10(mixed).reshape(8, self.n).sum(axis=0)


def upper_levels(nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, products: np.ndarray, top: int):
    """Levels top-1 … 0 from the sums over their children; at most 256^(top-1) * 256 entries each."""
    levels = {}
    for d in range(top - 1, -1, -1):
        size = 256 ** (d + 1)
        z, o, p = (np.bincount(nodes, weights=x, minlength=size) for x in (zeros, ones, products))
        kt = log_kt(z, o)
        weighted = np.logaddexp(HALF + kt, HALF + p)
        levels[d] = (z, o, np.exp(HALF + kt - weighted))
        number = np.arange(size)
        nodes, zeros, ones, products = ((number >> 16) << 8) | (number & 255), z, o, weighted
    return levels


def _count(depth: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Strings of one task with their training counts; merged piece by piece, passed on when there are many."""
        codes, counts = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(counts)], names=["code", "n"])

        for batch in runs_of(batches, PIECE):
            texts, train = utf8(batch.column("text")), np.asarray(batch.column("train").to_pylist(), dtype=np.int64)
            found, sizes = strings_of(texts, depth)
            place, distinct = pd.factorize(found)
            seen = np.bincount(place, weights=np.repeat(train, sizes), minlength=len(distinct)).astype(np.int64)
            codes, at = np.unique(np.concatenate([codes, distinct]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([counts, seen]), minlength=len(codes)).astype(np.int64)
            if len(codes) > 2_000_000:
                yield out()
                codes, counts = codes[:0], counts[:0]
        if len(codes):
            yield out()

    return count


def string_counts(docs: DataFrame, train: Column, depth: int = DEPTH) -> DataFrame:
    """``code, n``: how often training text shows each string of ``depth + 1`` bytes that occurs anywhere."""
    read = docs.select("text", train.alias("train"))
    return read.mapInArrow(_count(depth), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


TOP = 2  # groups share this many nearest context bytes


def _tree(table: pa.Table, depth: int) -> Tree:
    return Tree(np.asarray(table.column("code")).view(np.uint64), np.asarray(table.column("n")), depth, TOP)


def _summits(depth: int):
    def run(table: pa.Table) -> pa.Table:
        tree = _tree(table, depth)
        node, _, zeros, ones, _ = tree.levels[TOP]
        above = (((node >> np.uint64(16)) << np.uint64(8)) | (node & np.uint64(255))).astype(np.int64)
        parent, at = np.unique(above, return_inverse=True)
        sums = [np.bincount(at, weights=x, minlength=len(parent)) for x in (zeros, ones, tree.weighted)]
        return pa.table({"node": parent, "zeros": sums[0], "ones": sums[1], "product": sums[2]})

    return run


def _predict(depth: int, upper):
    def run(table: pa.Table) -> pa.Table:
        return pa.table({"code": table.column("code"), "log10": _tree(table, depth).log10(upper.value)})

    return run


def model(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``code, log10``: the log10 probability of each string's last byte after the bytes before it."""
    by_context = counts.withColumn("context", F.shiftright("code", 8 * (depth + 1 - TOP))).groupBy("context")
    sums = (
        by_context.applyInArrow(_summits(depth), "node long, zeros double, ones double, product double")
        .groupBy("node")
        .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("product").alias("product"))
        .orderBy("node")
    )
    # at most 256 * 255 rows: one byte of context and the decisions of a byte
    rows = sums.collect()
    columns = [np.array([r[c] for r in rows], dtype=np.float64) for c in ("zeros", "ones", "product")]
    upper = upper_levels(np.array([r["node"] for r in rows], dtype=np.int64), *columns, TOP)
    shared = counts.sparkSession.sparkContext.broadcast(upper)
    return by_context.applyInArrow(_predict(depth, shared), "code long, log10 double")


class Tokens:
    """The words and ends of a block's texts, each by the number of its distinct token.

    Tokens are told apart by 96 bits of their digest; the end has digest 0.
    """

    def __init__(self, texts: list[bytes], train: np.ndarray):
        low, high, counts = word_digests(texts)
        ends = np.cumsum(counts)
        low, high = np.insert(low, ends, np.uint64(0)), np.insert(high >> np.uint64(32), ends, np.uint64(0))
        self.sizes = counts + 1
        order, first = groups_of(low, high)
        self.number = np.empty(len(order), dtype=np.int64)
        self.number[order] = np.cumsum(first) - 1
        self.h1, self.h2 = low[order[first]], high[order[first]]
        learnt = np.repeat(train, self.sizes)
        self.n = np.bincount(self.number, weights=learnt, minlength=len(self.h1)).astype(np.int64)

    @classmethod
    def of(cls, table: pa.Table) -> Tokens:
        return cls(utf8(table.column("text")), np.asarray(table.column("train").to_pylist(), dtype=bool))


def _block_words(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    tokens = Tokens.of(table)
    block = np.full(len(tokens.n), key[0].as_py(), dtype=np.int32)
    return pa.table(
        {
            "h1": tokens.h1.view(np.int64),
            "h2": tokens.h2.astype(np.uint32).view(np.int32),
            "n": tokens.n.astype(np.int32),
            "block": block,
            "at": np.arange(len(block), dtype=np.int32),
        }
    )


def _pieces(texts: list[bytes]) -> Iterator[list[int]]:
    held, size = [], 0
    for i, t in enumerate(texts):
        if held and size + len(t) > PIECE:
            yield held
            held, size = [], 0
        held.append(i)
        size += len(t)
    if held:
        yield held


def _strings(texts: list[bytes], depth: int) -> np.ndarray:
    """The distinct strings of a block, in order."""
    found = np.empty(0, dtype=np.uint64)
    for part in _pieces(texts):
        found = np.union1d(found, pd.unique(strings_of([texts[i] for i in part], depth)[0]))
    return found


def _block_strings(depth: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = _strings(utf8(table.column("text")), depth)
        block = np.full(len(found), key[0].as_py(), dtype=np.int32)
        return pa.table({"code": found.view(np.int64), "block": block, "at": np.arange(len(found), dtype=np.int32)})

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers of one task gathered by block: a row of two arrays instead of a row per answer."""

    def out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        block, at, value = (np.concatenate([np.asarray(b.column(c)) for b in held]) for c in ("block", "at", "value"))
        order = np.lexsort((at, block))
        block, at, value = block[order], at[order], value[order]
        starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        ends = np.append(starts[1:], len(block))
        spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(block[starts]),
                pa.array([at[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([value[a:b].tobytes() for a, b in spans], pa.binary()),
            ],
            names=["block", "at", "value"],
        )

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows > 1_000_000:
            yield out(held)
            held, rows = [], 0
    if held:
        yield out(held)


def _score(depth: int):
    def run(table: pa.Table, known: pa.Table) -> pa.Table:
        # answers come by their place in the block's own order: strings below zero, words from zero on
        at, value = (
            np.frombuffer(b"".join(known.column(c).to_pylist()), dtype=kind) for c, kind in (("at", np.int32), ("value", np.float64))
        )
        texts = utf8(table.column("text"))
        pieces = []
        for part in _pieces(texts):
            found, sizes = strings_of([texts[i] for i in part], depth)
            place, distinct = pd.factorize(found)
            pieces.append((part, place.astype(np.int32), distinct, np.cumsum(sizes) - sizes))
        codes = np.unique(np.concatenate([x[2] for x in pieces]))
        logs = np.zeros(len(codes))
        logs[-1 - at[at < 0]] = value[at < 0]
        # counts of words that other blocks count too, negative away from home; the block itself knows the rest
        tokens = Tokens.of(table)
        c = tokens.n.copy()
        c[at[at >= 0]] = np.abs(value[at >= 0]).astype(np.int64)
        away = np.zeros(len(c), dtype=bool)
        away[at[(at >= 0)]] = value[at >= 0] < 0
        distinct_here = int(((c > 0) & ~away).sum())
        starts = np.cumsum(tokens.sizes) - tokens.sizes
        hits = np.add.reduceat((c > 0).astype(np.int64)[tokens.number], starts)
        base = np.add.reduceat(np.log10(c + 0.5)[tokens.number], starts)
        score = np.zeros(len(texts))
        for part, place, distinct, begins in pieces:
            score[part] = np.add.reduceat(logs[np.searchsorted(codes, distinct)][place], begins)
        first = np.zeros(len(texts), dtype=np.int64)
        first[0] = distinct_here
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "train": table.column("train"),
                "n_tokens": tokens.sizes,
                "n_known": hits,
                "distinct_tokens": first,
                "base": base,
                "score": score,
            }
        )

    return run


def scored(docs: DataFrame, buckets: int = 5, held_out: int = 1, depth: int = DEPTH, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` (log10 of
    the model's probability of the text).

    Learnt from documents whose id is not in the held-out bucket.
    """
    train = ~in_bucket(F.col("doc_id"), buckets, held_out)
    counts = materialize(string_counts(docs, train, depth), "strings")
    logs = model(counts, depth)
    by_block = blocked(docs, block_chars).withColumn("train", train).groupBy("block")
    # Both sides of the join of words read all columns of their exchange, so it is made once. A word whose training
    # tokens all lie in one block is known there; of the others, the first such block is the home.
    words = by_block.applyInArrow(_block_words, "h1 long, h2 int, n int, block int, at int").repartition("h1", "h2")
    totals = words.groupBy("h1", "h2").agg(
        F.sum("n").alias("c"), F.min(F.when(F.col("n") > 0, F.col("block"))).alias("first"), F.min("at").alias("least")
    )
    shared = words.join(totals, ["h1", "h2"]).filter("c > n AND at >= least")
    c = F.col("c").cast("double")
    strings = by_block.applyInArrow(_block_strings(depth), "code long, block int, at int").join(logs, "code")
    known = shared.select("block", "at", F.when(F.col("block") == F.col("first"), c).otherwise(-c).alias("value")).unionByName(
        strings.select("block", (-1 - F.col("at")).alias("at"), F.col("log10").alias("value"))
    )
    known = known.mapInArrow(_packed, "block int, at binary, value binary")
    shape = "doc_id long, train boolean, n_tokens long, n_known long, distinct_tokens long, base double, score double"
    rows = materialize(by_block.cogroup(known.groupBy("block")).applyInArrow(_score(depth), shape), "scores")
    # two numbers of the whole corpus: training tokens, and distinct ones
    whole = rows.agg(F.sum(F.when(F.col("train"), F.col("n_tokens"))).alias("N"), F.sum("distinct_tokens").alias("V")).first()
    n, v = whole["N"] or 0, whole["V"] or 0
    return rows.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(math.log10(n + 0.5 * (v + 1)))).alias("base_score"),
        "score",
    )
