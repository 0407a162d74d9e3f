"""Edit-aware token counts: a segment tree of pre-tokens per document, updated where the text changed.

Byte-pair encoding never crosses a pre-token, and a pre-token depends only on the text from its start
to two characters past its end. So a document is kept as leaves of whole pre-tokens (``LEAF`` of them
when built) with characters and tokens per leaf, and a binary tree of sums above them. After a
batch of edits only the leaves that reach within two characters of an edit are split and encoded again,
and further leaves only until the new pre-tokens end where an old leaf ended; the sums above change
along their paths.

The state of a document is its text and the two arrays of its tree, so it can be stored and edited again.

Defined results: NULL or empty texts have no leaves and 0 tokens. Edits of one batch count in
characters of the text before the batch; they are clipped to the text, sorted by start, and one that begins
inside an earlier removal begins where that ends. NULL places or texts of an edit mean 0 and empty.
Repeated rows are counted each. Empty tables give empty results.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm.text import runs_of

LEAF = 64
REACH = 2  # characters past its end that a pre-token depends on
# Fixed value: the public pre-token pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TREE = "tree_chars array<long>, tree_tokens array<long>"
Edit = tuple[int, int, str]  # start, characters removed, text inserted


def ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """A vocabulary file of ``base64 rank`` lines; its size does not depend on any corpus."""
    lines = spark.read.text(path).collect()
    return {base64.b64decode(a): int(b) for a, b in (row["value"].split() for row in lines if row["value"])}


class Counter:
    """Tokens per pre-token; remembers what it has seen, up to a bound."""

    def __init__(self, vocabulary: dict[bytes, int], pattern: str = PATTERN, limit: int = 500_000):
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.limit = limit
        self.known: dict[str, int] = {}

    def tokens(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(self.known) >= self.limit:
                self.known.clear()
            if len(piece) < 100:
                self.known[piece] = n
        return n


class Tree:
    """Sums over leaves in heap order: node k has children 2k and 2k+1, the leaves are the second half."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.size = len(chars) // 2

    @classmethod
    def of_leaves(cls, chars: list[int], tokens: list[int]) -> Tree:
        size = 1
        while size < len(chars):
            size *= 2
        tree = cls(np.zeros(2 * size, dtype=np.int64), np.zeros(2 * size, dtype=np.int64))
        tree.chars[size : size + len(chars)] = chars
        tree.tokens[size : size + len(tokens)] = tokens
        tree._sum(size, 2 * size)
        return tree

    def _sum(self, low: int, high: int) -> None:
        """Renew the sums above nodes low … high-1 of one level."""
        while low > 1:
            low, high = low // 2, (high - 1) // 2 + 1
            for a in (self.chars, self.tokens):
                a[low:high] = a[2 * low : 2 * high : 2] + a[2 * low + 1 : 2 * high : 2]

    def put(self, leaf: int, chars: list[int], tokens: list[int]) -> None:
        """Replace neighbouring leaves and the sums on their paths."""
        at = self.size + leaf
        self.chars[at : at + len(chars)] = chars
        self.tokens[at : at + len(tokens)] = tokens
        self._sum(at, at + len(chars))

    def leaf_at(self, place: int) -> int:
        """The leaf with the character at ``place``; the last one with text if it lies beyond."""
        place = min(place, int(self.chars[1]) - 1)
        node = 1
        while node < self.size:
            node *= 2
            if place >= self.chars[node]:
                place -= int(self.chars[node])
                node += 1
        return node - self.size

    def start_of(self, leaf: int) -> int:
        """Characters before a leaf."""
        node, before = self.size + leaf, 0
        while node > 1:
            if node % 2:
                before += int(self.chars[node - 1])
            node //= 2
        return before

    def end_of(self, leaf: int) -> int:
        return self.start_of(leaf) + int(self.chars[self.size + leaf])

    def leaves(self) -> tuple[list[int], list[int]]:
        return self.chars[self.size :].tolist(), self.tokens[self.size :].tolist()


def grouped(pieces: list[tuple[int, int]], groups: int) -> tuple[list[int], list[int]]:
    """Share pieces of (chars, tokens) out to a number of leaves, in order."""
    per = -(-len(pieces) // groups) if pieces else 0
    parts = [pieces[k * per : (k + 1) * per] for k in range(groups)]
    return [sum(c for c, _ in p) for p in parts], [sum(t for _, t in p) for p in parts]


def build(text: str, count: Counter) -> Tree:
    pieces = count.pattern.findall(text)
    tokens = count.tokens
    chars, sums = [], []
    for k in range(0, len(pieces), LEAF):
        part = pieces[k : k + LEAF]
        chars.append(sum(map(len, part)))
        sums.append(sum(map(tokens, part)))
    return Tree.of_leaves(chars, sums)


def in_order(edits: list[Edit], n: int) -> list[Edit]:
    out, free = [], 0
    for start, removed, inserted in sorted((e for e in edits), key=lambda e: e[0]):
        begin = min(max(start, free, 0), n)
        end = min(max(begin, start + max(removed, 0)), n)
        out.append((begin, end - begin, inserted))
        free = end
    return out


def edit(text: str, tree: Tree, edits: list[Edit], count: Counter) -> tuple[str, Tree, int]:
    """The new text, its tree, and how many of its characters were encoded for that."""
    edits = in_order(edits, len(text))
    if not edits:
        return text, tree, 0
    parts, at = [], 0
    for start, removed, inserted in edits:
        parts += [text[at:start], inserted]
        at = start + removed
    new = "".join([*parts, text[at:]])
    if not text:
        return new, build(new, count), len(new)
    # leaves touched by each edit, overlapping ranges joined; each range knows by how much its edits grow the text
    ranges: list[list[int]] = []
    for start, removed, inserted in edits:
        low, high = tree.leaf_at(max(0, start - REACH)), tree.leaf_at(start + removed)
        grow = len(inserted) - removed
        if ranges and low <= ranges[-1][1]:
            ranges[-1][1] = max(ranges[-1][1], high)
            ranges[-1][2] += grow
        else:
            ranges.append([low, high, grow])
    changed: list[tuple[int, int, list[tuple[int, int]]]] = []
    encoded, shift, k = 0, 0, 0
    while k < len(ranges):
        low, high, grow = ranges[k]
        place = begin = tree.start_of(low) + shift
        goal = tree.end_of(high) + shift + grow
        pieces = []
        found = count.pattern.finditer(new, begin)
        while place != goal:
            if place < goal:
                piece = next(found).group()
                pieces.append((len(piece), count.tokens(piece)))
                place += len(piece)
                continue
            # a pre-token runs past the old border: take in the next leaf, and the next range if it begins there
            high += 1
            if k + 1 < len(ranges) and ranges[k + 1][0] <= high:
                k += 1
                high, grow = max(high, ranges[k][1]), grow + ranges[k][2]
            goal = tree.end_of(high) + shift + grow
        encoded += place - begin
        changed.append((low, high, pieces))
        shift += grow
        k += 1
    if all(len(pieces) <= 2 * LEAF * (high - low + 1) for low, high, pieces in changed):
        tree = Tree(tree.chars.copy(), tree.tokens.copy())
        for low, high, pieces in changed:
            tree.put(low, *grouped(pieces, high - low + 1))
        return new, tree, encoded
    # a leaf would grow too long: lay the leaves out anew, from known counts
    chars, tokens = tree.leaves()
    for low, high, pieces in reversed(changed):
        c, t = grouped(pieces, max(1, -(-len(pieces) // LEAF)))
        chars[low : high + 1], tokens[low : high + 1] = c, t
    kept = [(c, t) for c, t in zip(chars, tokens, strict=True) if c]
    return new, Tree.of_leaves([c for c, _ in kept], [t for _, t in kept]), encoded


MASKED = regex.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\+?\d[\d -]{6,}\d")


def redactions(text: str) -> list[Edit]:
    """Edits that mask e-mail addresses and long numbers and remove repeated lines."""
    edits: list[Edit] = []
    gone = []
    seen: set[str] = set()
    at = 0
    for line in text.split("\n"):
        if line.strip() and line in seen:
            gone.append((at, len(line) + 1))
        seen.add(line)
        at += len(line) + 1
    edits += [(start, length, "") for start, length in gone]
    k = 0
    for found in MASKED.finditer(text):
        start, end = found.span()
        while k < len(gone) and gone[k][0] + gone[k][1] <= start:
            k += 1
        if k == len(gone) or gone[k][0] >= end:
            edits.append((start, end - start, "<email>" if "@" in found.group() else "<number>"))
    return edits


def _texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def _with_trees(vocabulary, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(vocabulary.value, pattern)
        for batch in runs_of(batches, 4_000_000):
            trees = [build(t, count) for t in _texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array([t.chars for t in trees], pa.list_(pa.int64())), pa.array([t.tokens for t in trees], pa.list_(pa.int64()))],
                names=["doc_id", "text", "tree_chars", "tree_tokens"],
            )

    return run


def with_trees(docs: DataFrame, vocabulary: dict[bytes, int], pattern: str = PATTERN) -> DataFrame:
    """The stored state of each document: ``doc_id``, ``text``, ``tree_chars``, ``tree_tokens``.

    ``tree_tokens[1]`` is the token count of the whole text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return docs.select("doc_id", "text").mapInArrow(_with_trees(shared, pattern), f"doc_id long, text string, {TREE}")


def _apply(vocabulary, pattern: str, find: Callable[[str], list[Edit]] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(vocabulary.value, pattern)
        for batch in runs_of(batches, 4_000_000):
            out: list[list] = [[] for _ in range(6)]
            listed = [None] * batch.num_rows if find else batch.column("edits").to_pylist()
            trees = zip(batch.column("tree_chars"), batch.column("tree_tokens"), strict=True)
            for text, (chars, tokens), edits in zip(_texts(batch.column("text")), trees, listed, strict=True):
                tree = Tree(np.asarray(chars.values, dtype=np.int64), np.asarray(tokens.values, dtype=np.int64))
                todo = find(text) if find else [(e["start"] or 0, e["removed"] or 0, e["inserted"] or "") for e in edits or ()]
                new, after, encoded = edit(text, tree, todo, count)
                for column, x in zip(out, (new, after.chars, after.tokens, int(tree.tokens[1]), len(todo), encoded), strict=True):
                    column.append(x)
            kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, kind) for c, kind in zip(out, kinds, strict=True)]],
                names=["doc_id", "text", "tree_chars", "tree_tokens", "tokens_before", "n_edits", "chars_encoded"],
            )

    return run


def apply_edits(
    state: DataFrame,
    vocabulary: dict[bytes, int],
    edits: DataFrame | None = None,
    find: Callable[[str], list[Edit]] | None = None,
    pattern: str = PATTERN,
) -> DataFrame:
    """The state after one batch of edits, with ``tokens_before``, ``n_edits`` and ``chars_encoded``.

    Edits come as rows of ``doc_id, start, removed, inserted``, or from ``find``, which gets each text.
    """
    shared = state.sparkSession.sparkContext.broadcast(vocabulary)
    columns = ["doc_id", "text", "tree_chars", "tree_tokens"]
    shape = f"doc_id long, text string, {TREE}, tokens_before long, n_edits long, chars_encoded long"
    fed = state.select(*columns)
    if find is None:
        per_doc = edits.groupBy(F.col("doc_id").alias("of")).agg(F.collect_list(F.struct("start", "removed", "inserted")).alias("edits"))
        fed = fed.join(per_doc, F.col("doc_id").eqNullSafe(F.col("of")), "left").select(*columns, "edits")
    return fed.mapInArrow(_apply(shared, pattern, find), shape)
