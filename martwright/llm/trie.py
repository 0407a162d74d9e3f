"""The prefix trie of conversations by fixed-length block hashing.

Conversations are cut into blocks of ``BLOCK`` turns. The name of a block is a digest of everything up to its end, so equal
names mean equal conversations so far, and one grouping by name leaves one row per distinct block with the number of its
members and the smallest of them. Only below prefixes where several blocks follow (where siblings diverge) are blocks
opened and compared turn by turn; everywhere else all turns of a block have the block's members.

Sums over subtrees need no walk through the trie. A node is represented by its smallest member, and whoever
represents a node represents all nodes further down its own path. With the depth at which a conversation begins to
represent, every subtree sum is a sum over members: a member adds the bytes of its turns from the node down to where it
begins, and 1 if it represents the leaf at its end.

Names are the exclusive or of keyed SHA-256 digests, one for each block and place, in 120 bits. The key is drawn
for each run, so no texts can be made to meet; it leaves no trace in the result. Exclusive or is summed in pieces, so a conversation
may hold any part of all turns: positions come from ranges of the sorted table, prefixes from pieces of ``PIECE`` blocks.

Defined results: turns come in the order of (turn, NULL first; role; text); NULL roles and texts are empty. Repeated rows
are turns of their own. Rows without a conversation belong to none. No rows, no trie. Texts of any length are read once and
travel with the sort. Extra columns play no part.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.text import utf8
from martwright.session import materialize

BLOCK = 4
PIECE = 1024
EMPTY = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``digest`` and ``bytes`` of every turn.

    The whole order is range-partitioned, so a long conversation spreads; each range numbers its rows, and what the
    first conversation of a range owes to earlier ranges is one row per range at most.
    """
    text = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row")
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    ranged = text.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in batches:
            ids = np.asarray(batch.column("conv_id"))
            if not len(ids):
                continue
            first = np.append(ids[0] != last, ids[1:] != ids[:-1])
            index = np.arange(len(ids))
            start = np.maximum.accumulate(np.where(first, index, -1))
            pos = np.where(start >= 0, index - start + 1, index + n + 1)
            last, n = ids[-1], int(pos[-1])
            roles, texts = utf8(batch.column("role")), utf8(batch.column("text"))
            digests = [hashlib.sha256(b"%d:%b%b" % (len(r), r, t)).digest() for r, t in zip(roles, texts, strict=True)]
            sizes = pc.cast(pc.binary_length(batch.column("text")), pa.int64())
            yield pa.RecordBatch.from_pydict(
                {"range": batch.column("range"), "conv_id": pa.array(ids, pa.int64()), "k": pa.array(pos, pa.int64()), "digest": pa.array(digests, pa.binary()), "bytes": sizes}
            )

    plain = ranged.withColumn("conv_id", F.col("conv_id").cast("bigint")).select("range", "conv_id", "role", "text")
    turns = materialize(plain.mapInArrow(number, "range int, conv_id bigint, k bigint, digest binary, bytes bigint"), "turns")
    counts = turns.groupBy("range", "conv_id").agg(F.max("k").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    owed = counts.withColumn("owed", F.sum("n").over(earlier)).filter("owed is not null").drop("n")
    # at most one row for each range
    return turns.join(F.broadcast(owed), ["range", "conv_id"], "left").select("conv_id", (F.col("k") + F.coalesce("owed", F.lit(0))).alias("pos"), "digest", "bytes")


def shared_heads(turns: DataFrame, group: int = 5, longest: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with a head in common, as turns (``conv_id``, ``depth``, ``digest``, ``bytes``, ``length``), and
    all conversations (``conv_id``, ``length``).

    The first h turns, h = crc32(conv_id) % (longest + 1), come from the first conversation of each ``group`` ids; the others are its own.
    """
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)).cast("bigint")
    counted = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    convs = counted.withColumns({"h": head, "base": F.col("conv_id") - F.col("conv_id") % group})
    bases = counted.select(F.col("conv_id").alias("base"), F.least(F.col("n"), F.lit(longest)).alias("has"))
    taken = F.least(F.col("h"), F.coalesce("has", F.lit(0)))
    own = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = convs.join(bases, "base", "left").select("conv_id", "base", "h", taken.alias("taken"), (taken + own).alias("length"))
    convs = materialize(convs, "conversations")
    heads = turns.filter(F.col("pos") <= longest).withColumnRenamed("conv_id", "base")
    first = heads.join(convs, "base").filter("pos <= taken").select("conv_id", F.col("pos").alias("depth"), "digest", "bytes", "length")
    rest = turns.withColumn("h", head).filter("pos > h").drop("h").join(convs, "conv_id")
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "digest", "bytes", "length")
    return first.unionByName(rest), convs.select("conv_id", "length")


def whole(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are, in the form of ``shared_heads``."""
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("length"))
    return turns.withColumnRenamed("pos", "depth").join(convs, "conv_id"), convs


def _upto(blocks: DataFrame, total, names: dict[str, Column]) -> DataFrame:
    """Add running totals over the blocks of each conversation, first by pieces of ``PIECE`` blocks, then inside them."""
    cut = blocks.withColumns({f"_{n}": v for n, v in names.items()}).withColumn("_piece", F.expr(f"block div {PIECE}"))
    before = Window.partitionBy("conv_id").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy("conv_id", "_piece").agg(*[total(f"_{n}").alias(f"_{n}") for n in names])
    carried = sums.select("conv_id", "_piece", *[total(f"_{n}").over(before).alias(f"_{n}_before") for n in names]).filter("_piece > 0")
    inside = Window.partitionBy("conv_id", "_piece").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    run = cut.withColumns({f"_{n}": total(f"_{n}").over(inside) for n in names}).join(carried, ["conv_id", "_piece"], "left")
    zero = F.lit(0).cast("bigint")
    both = {n: F.col(f"_{n}").bitwiseXOR(F.coalesce(f"_{n}_before", zero)) if total is F.bit_xor else F.col(f"_{n}") + F.coalesce(f"_{n}_before", zero) for n in names}
    return run.withColumns(both).drop("_piece", *[f"_{n}" for n in names], *[f"_{n}_before" for n in names])


def named_blocks(turns: DataFrame) -> DataFrame:
    """Blocks of each conversation: its turns, the names (x, y) of all up to its end, and of its parent (px, py)."""
    key = uuid.uuid4().hex
    block = F.expr(f"(depth - 1) div {BLOCK}").alias("block")
    packed = F.array_sort(F.collect_list(F.struct("depth", "digest", "bytes")))
    blocks = turns.groupBy("conv_id", block).agg(packed.alias("turns"), F.max("length").alias("length"))
    joined = F.concat(F.lit(key.encode()), F.col("block").cast("string").cast("binary"), F.lit(b":"), _joined(F.col("turns")))
    blocks = blocks.withColumn("_name", F.sha2(joined, 256))
    half = {"x": 1, "y": 16}
    own = {n: F.conv(F.substring("_name", start, 15), 16, 10).cast("bigint") for n, start in half.items()}
    named = _upto(blocks.withColumns({f"own_{n}": v for n, v in own.items()}).drop("_name"), F.bit_xor, {n: F.col(f"own_{n}") for n in half})
    parents = {f"p{n}": F.col(n).bitwiseXOR(F.col(f"own_{n}")) for n in half}
    return named.withColumns(parents).drop("own_x", "own_y")


def _joined(turns: Column) -> Column:
    return F.aggregate(turns, F.lit(b""), lambda all_, t: F.concat(all_, t["digest"]))


def ids_digest(members: DataFrame, keys: list[str]) -> DataFrame:
    """SHA-256 of each group's ``conv_id`` values, ascending and comma-joined, as ``ends_sha256``.

    Sorted ranges write pieces of joined numbers, which are hashed one after the other: a group of any size takes one
    piece of memory.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [np.asarray(batch.column(k)) for k in keys]
            ids = np.asarray(batch.column("conv_id"))
            if len(ids):
                starts = np.flatnonzero(np.append(True, reduce(np.logical_or, [c[1:] != c[:-1] for c in cols])))
                texts = [",".join(map(str, part.tolist())) for part in np.split(ids, starts[1:])]
                yield pa.RecordBatch.from_pydict({**{k: c[starts] for k, c in zip(keys, cols, strict=True)}, "first": ids[starts], "ids": texts})

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = {k: [] for k in [*keys, "ends_sha256"]}
            for *key, text in zip(*[batch.column(k).to_pylist() for k in [*keys, "ids"]], strict=True):
                if key == now:
                    state.update(b",")
                else:
                    _emit(done, keys, now, state)
                    now, state = key, hashlib.sha256()
                state.update(text.encode())
            yield pa.RecordBatch.from_pydict(done, schema=shape)
        done = {k: [] for k in [*keys, "ends_sha256"]}
        _emit(done, keys, now, state)
        yield pa.RecordBatch.from_pydict(done, schema=shape)

    shape = pa.schema([*[(k, pa.int64()) for k in keys], ("ends_sha256", pa.string())])
    ddl = ", ".join(f"{k} bigint" for k in keys)
    ordered = members.select(*keys, "conv_id").repartitionByRange(*keys, "conv_id").sortWithinPartitions(*keys, "conv_id")
    joined = ordered.mapInArrow(pieces, f"{ddl}, first bigint, ids string")
    return joined.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(hashed, f"{ddl}, ends_sha256 string")


def _emit(done: dict[str, list], keys: list[str], now: list | None, state) -> None:
    if now is not None:
        for k, v in zip(keys, now, strict=True):
            done[k].append(v)
        done["ends_sha256"].append(state.hexdigest())


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node: every distinct sequence of first turns, from the root of depth 0.

    ``turns`` and ``conversations`` as ``whole`` or ``shared_heads`` give them. Columns: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (bytes that members after the first need not
    repeat, over the subtree) and ``ends_sha256``.
    """
    rows = materialize(named_blocks(turns), "blocks")
    is_last = F.col("block") == F.expr(f"(length - 1) div {BLOCK}")
    distinct = rows.groupBy("x", "y").agg(
        F.first("px").alias("px"),
        F.first("py").alias("py"),
        F.first("block").alias("block"),
        F.first("turns").alias("turns"),
        F.count("*").alias("n"),
        F.min("conv_id").alias("m"),
        F.count_if(is_last).alias("n_ends"),
    )
    siblings = distinct.groupBy("px", "py").agg((F.count("*") > 1).alias("diverging"))
    blocks = materialize(distinct.join(siblings, ["px", "py"]).withColumn("size", F.size("turns")), "distinct_blocks")

    # turn by turn, but compared only where siblings diverge; a node is a place of a block, or of several that agree so far
    prefix = F.when(F.col("diverging"), F.sha2(_joined(F.slice("turns", 1, F.col("j"))), 256)).otherwise(F.lit(""))
    opened = blocks.select("*", F.explode(F.sequence(F.lit(1), F.col("size"))).alias("j")).withColumn("q", prefix)
    place = ["px", "py", "j", "q"]
    met = opened.filter("diverging").groupBy(*place).agg(F.min("m").alias("conv_id"), F.sum("n").alias("n_convs"))
    alone = opened.filter("not diverging").select(*place, F.col("m").alias("conv_id"), F.col("n").alias("n_convs"))
    depth = (F.col("block") * BLOCK + F.col("j")).alias("depth")
    nodes = met.unionByName(alone)
    with_depth = opened.select(*place, depth, "x", "y", "size", "m", "n", "n_ends").join(nodes, place)
    placed = materialize(with_depth, "nodes")

    # where a conversation begins to represent, and whether it represents the leaf at its end
    lowest = conversations.agg(F.min("conv_id").alias("conv_id")).filter("conv_id is not null")
    mine = placed.filter("m = conv_id").groupBy("conv_id").agg(
        F.min("depth").alias("begins"),
        F.max((F.col("j") == F.col("size")) & (F.col("n_ends") == F.col("n_convs"))).cast("bigint").alias("leaf"),
    )
    mine = mine.join(lowest.withColumn("lowest", F.lit(True)), "conv_id", "left")
    mine = materialize(mine.select("conv_id", F.when(F.col("lowest"), 0).otherwise(F.col("begins")).cast("bigint").alias("begins"), "leaf"), "begins")

    # what members add beyond a block, per block
    never = F.col("length") + 1
    theirs = rows.select("conv_id", "block", "x", "y", "turns", "length").join(mine, "conv_id", "left")
    early = F.aggregate("turns", F.lit(0).cast("bigint"), lambda s, t: s + F.when(t["depth"] < F.coalesce("begins", never), t["bytes"]).otherwise(0))
    summed = _upto(theirs.withColumn("early", early).drop("turns"), F.sum, {"upto": F.col("early")})
    total = theirs.groupBy("conv_id").agg(F.sum(early).alias("all_early"))
    beyond = summed.join(total, "conv_id").groupBy("x", "y").agg(
        F.sum(F.col("all_early") - F.col("upto")).alias("beyond"), F.sum(F.coalesce("leaf", F.lit(0))).alias("leaves")
    )

    # ends of conversations, by the name of their last block
    ends = ids_digest(rows.filter(is_last), ["x", "y"])
    known = blocks.join(beyond, ["x", "y"]).join(ends, ["x", "y"], "left").join(mine.select(F.col("conv_id").alias("m"), "begins"), "m", "left")
    tail = F.slice("turns", F.col("j"), F.col("size"))
    zero = F.lit(0).cast("bigint")
    rest = F.aggregate(tail, zero, lambda s, t: s + t["bytes"])
    first_only = F.aggregate(tail, zero, lambda s, t: s + F.when(t["depth"] < F.coalesce("begins", F.lit(2**62)), t["bytes"]).otherwise(0))
    saved = F.col("beyond") + (F.col("n") - 1) * rest + first_only
    open_known = known.select("*", F.explode(F.sequence(F.lit(1), F.col("size"))).alias("j")).withColumns({"q": prefix, "saved": saved})
    ended = F.max(F.when(F.col("j") == F.col("size"), F.col("ends_sha256")))
    sums_met = open_known.filter("diverging").groupBy(*place).agg(
        F.min("m").alias("conv_id"), F.first("block").alias("block"), F.sum("n").alias("n_convs"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), ended.alias("ends")
    )
    sums_alone = open_known.filter("not diverging").select(
        *place, F.col("m").alias("conv_id"), "block", F.col("n").alias("n_convs"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.when(F.col("j") == F.col("size"), F.col("ends_sha256")).alias("ends")
    )
    inner = materialize(sums_met.unionByName(sums_alone).select(*place, depth, "conv_id", "n_convs", "n_leaves", "saved_tokens", "ends"), "sums")

    # parents: oneself further up, but where a conversation begins; there the node before, or the block before
    begun = inner.join(mine.filter("begins > 0"), "conv_id").filter("depth = begins")
    first_turns = begun.filter("j = 1").select(F.col("conv_id").alias("c"), "depth", "px", "py")
    block_ends = blocks.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("m").alias("parent"))
    roots = lowest.select(F.lit(0).cast("bigint").alias("px"), F.lit(0).cast("bigint").alias("py"), F.col("conv_id").alias("parent"))
    by_block = first_turns.join(block_ends.unionByName(roots), ["px", "py"]).select("c", "depth", "parent")
    inside = begun.filter("j > 1").select("conv_id", "depth", "px", "py", "j", "q")
    # any block with this place also has the place before it
    through = opened.filter("diverging").select(*place, F.sha2(_joined(F.slice("turns", 1, F.col("j") - 1)), 256).alias("before")).dropDuplicates(place)
    up = inside.join(through, place).select(F.col("conv_id").alias("c"), "depth", "px", "py", (F.col("j") - 1).alias("j"), F.col("before").alias("q"))
    by_turn = up.join(met.select(*place, F.col("conv_id").alias("parent")), place).select("c", "depth", "parent")
    forks = materialize(by_block.unionByName(by_turn), "forks")

    branches = forks.groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("branches"))
    root = _root(inner, conversations)
    all_nodes = inner.select("conv_id", "depth", "n_convs", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256")).unionByName(root)
    goes_on = placed.filter("m = conv_id").groupBy("conv_id").agg(F.max("depth").alias("until"))
    return (
        all_nodes.join(branches, ["conv_id", "depth"], "left")
        .join(goes_on, "conv_id", "left")
        .join(forks.select(F.col("c").alias("conv_id"), "depth", "parent"), ["conv_id", "depth"], "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
            "n_convs",
            (F.coalesce("branches", F.lit(0)) + F.when(F.col("until") > F.col("depth"), 1).otherwise(0)).cast("bigint").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            "ends_sha256",
        )
    )


def _root(inner: DataFrame, conversations: DataFrame) -> DataFrame:
    """The root: every conversation is its member, also one without turns."""
    members = conversations.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    below = inner.filter("depth = 1").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    silent = ids_digest(conversations.filter("length = 0").withColumn("k", F.lit(0).cast("bigint")), ["k"]).select("ends_sha256")
    parts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [members, below, silent])
    row = parts.agg(*[F.max(c).alias(c) for c in ("conv_id", "n_convs", "n_leaves", "saved_tokens", "ends_sha256")]).filter("n_convs > 0")
    return row.select(
        "conv_id",
        F.lit(0).cast("bigint").alias("depth"),
        "n_convs",
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
