"""Benchmark decontamination: a BM25 index of the test items, searched by every training passage.

Items are cut into sections of at most ``SECTION`` words; index terms are word pairs (case and outer
punctuation folded). Impacts are BM25 scores divided by the section's own full score, so one threshold
fits sections of any length. Every document is searched as overlapping passages of twice a section's
length, so any copied section lies whole in one of them. A passage is skipped only if the highest
impacts of its terms cannot add up to the threshold; the others run block-max WAND, which is exact.
Every passage retrieved is verified against the words around it: shared five-word shingles of the question
(all sentences of an item but the last) and of the answer (the last sentence). Passages near each other are
verified together; the place with the highest overlap counts. An overlap is the share of words that shared shingles cover, so
a changed word costs itself, not five shingles. A document leaks an item if it covers the share ``VERIFIED`` of both together,
or ``QUESTION`` of a question of at least ``ALONE`` words.

Document frequencies and lengths are counted by Spark over all items. Indexes are built for groups of items of about ``GROUP``
characters, which bounds what is broadcast; each group in turn is searched by all documents. Documents are never shuffled.

Defined results: NULL or empty texts and items without words match nothing. Repeated documents are
reported each for itself, repeated items under each of their ids. Items of one word are matched as that
word's pair with nothing, that is never. An empty table gives no matches. Texts of any length are searched whole, one
at a time. Extra columns of documents pass through ``decontaminated`` under any name and are not read by ``leaks``.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm.text import runs_of, utf8
from martwright.session import materialize

SECTION = 32
BLOCK = 16  # postings per block of a term's list
GROUP = 4_000_000  # characters of the items of one index
ALONE = 10  # words of a question that may decide without its answer
SHINGLE = 5
VERIFIED, QUESTION = 0.8, 0.9  # shares of the words of an item, or of its question alone
K1, B = 1.2, 0.75
EDGE = b".,;:!?\"'()[]{}<>*_-"
SENTENCE_END = re.compile(rb"[.!?]$")
FOUND = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, overlap double"


def fold(words: list[bytes]) -> list[bytes]:
    return [w.lower().strip(EDGE) for w in words]


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    """Runs of five words; a shorter text is one."""
    n = min(SHINGLE, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


class Item:
    """A test item: where the five-word shingles of its question and of its answer stand."""

    def __init__(self, item_id: int, words: list[bytes], cut: int):
        self.item_id, self.cut, self.words = item_id, cut, len(words)
        self.places: dict[tuple[bytes, ...], list[int]] = {}
        for start, part in ((0, words[:cut]), (cut, words[cut:])):
            n = min(SHINGLE, len(part))
            for i in range(len(part) - n + 1 if n else 0):
                self.places.setdefault(tuple(part[i : i + n]), []).append(start + i)
        self.sizes = {len(x) for x in self.places}

    def densest(self, near: list[bytes], width: int) -> tuple[int, int, int]:
        """Words of question and of answer that shared shingles cover within ``width`` words, where they are the most together, and
        the most of the question anywhere."""
        inside: deque[tuple[int, tuple[bytes, ...]]] = deque()
        held: Counter[tuple[bytes, ...]] = Counter()
        cover = [0] * self.words
        covered = [0, 0]
        most, alone = (0, 0), 0

        def mark(shingle: tuple[bytes, ...], by: int) -> None:
            for start in self.places[shingle]:
                for k in range(start, start + len(shingle)):
                    before, cover[k] = cover[k] > 0, cover[k] + by
                    covered[k >= self.cut] += (cover[k] > 0) - before

        for i in range(len(near)):
            for n in self.sizes:
                shingle = tuple(near[i : i + n])
                if shingle not in self.places:
                    continue
                while inside and inside[0][0] <= i - width:
                    gone = inside.popleft()[1]
                    held[gone] -= 1
                    if not held[gone]:
                        mark(gone, -1)
                inside.append((i, shingle))
                held[shingle] += 1
                if held[shingle] == 1:
                    mark(shingle, 1)
                    alone = max(alone, covered[0])
                    if sum(covered) > sum(most):
                        most = (covered[0], covered[1])
        return *most, alone


def parts_of(text: bytes) -> tuple[list[bytes], int, list[list[tuple[bytes, bytes]]]]:
    """The folded words of an item, where its last sentence begins, and the word pairs of its sections."""
    raw = text.split()
    words = fold(raw)
    ends = [i + 1 for i, w in enumerate(raw[:-1]) if SENTENCE_END.search(w)]
    size = math.ceil(len(words) / max(1, math.ceil(len(words) / SECTION))) if words else 1
    cut = [words[k : k + size] for k in range(0, len(words), size)]
    return words, ends[-1] if ends else len(words), [list(zip(part, part[1:])) for part in cut if len(part) > 1]


class Statistics:
    """Of all items: sections, their mean length in pairs, and the sections that hold each pair (of those asked for)."""

    def __init__(self, sections: int, mean: float, df: dict[tuple[bytes, bytes], int]):
        self.sections, self.mean, self.df = sections, mean, df

    def impact(self, pair: tuple[bytes, bytes], n: int, length: int) -> float:
        df = self.df[pair]
        return math.log(1 + (self.sections - df + 0.5) / (df + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * length / self.mean))


class Index:
    """Block-max inverted index over sections; ``search`` gets the distinct term numbers of a passage."""

    def __init__(self, items: list[tuple[int, bytes]], statistics: Statistics):
        sections: list[tuple[int, list[tuple[bytes, bytes]]]] = []
        self.items = []
        for number, (item_id, text) in enumerate(items):
            words, cut, found = parts_of(text)
            self.items.append(Item(item_id, words, cut))
            sections += [(number, pairs) for pairs in found]
        self.item_of = np.array([n for n, _ in sections], dtype=np.int64)
        postings: dict[tuple[bytes, bytes], list[tuple[int, float]]] = {}
        for s, (_, pairs) in enumerate(sections):
            scored = {t: statistics.impact(t, n, len(pairs)) for t, n in Counter(pairs).items()}
            whole = sum(scored.values())
            for t, x in scored.items():
                postings.setdefault(t, []).append((s, x / whole))
        self.words = {w: i for i, w in enumerate(sorted({w for t in postings for w in t}))}
        terms = sorted(postings, key=lambda t: (self.words[t[0]], self.words[t[1]]))
        self.codes = np.array([self.words[a] * len(self.words) + self.words[b] for a, b in terms], dtype=np.int64)
        self.sections = [np.array([s for s, _ in postings[t]], dtype=np.int64) for t in terms]
        self.impacts = [np.array([x for _, x in postings[t]]) for t in terms]
        self.top = np.array([x.max() for x in self.impacts]) if terms else np.empty(0)
        # for each block of postings: its last section and its highest impact
        self.block_last = [s[np.minimum(np.arange(BLOCK - 1, len(s) + BLOCK - 1, BLOCK), len(s) - 1)] for s in self.sections]
        self.block_top = [np.maximum.reduceat(x, np.arange(0, len(x), BLOCK)) for x in self.impacts]

    def terms(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Positions of word pairs that are index terms, and their term numbers."""
        get = self.words.get
        ids = np.array([get(w, -1) for w in words], dtype=np.int64)
        if len(ids) < 2 or not len(self.codes):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        code = ids[at] * len(self.words) + ids[at + 1]
        place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        hit = self.codes[place] == code
        return at[hit], place[hit]

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Sections with a score of at least ``threshold``, by block-max WAND."""
        found = []
        lists = [[int(self.sections[t][0]), t, 0] for t in terms]  # next section, term, place in its list

        def move(cursor: list[int], section: int) -> None:
            """To the first posting at or after ``section``, over whole blocks first."""
            _, t, at = cursor
            block = int(np.searchsorted(self.block_last[t], section))
            at = max(at, block * BLOCK)
            at += int(np.searchsorted(self.sections[t][at : at + BLOCK], section)) if at < len(self.sections[t]) else 0
            cursor[2] = at
            cursor[0] = int(self.sections[t][at]) if at < len(self.sections[t]) else -1

        while lists:
            lists.sort()
            bound, pivot = 0.0, -1
            for k, (_, t, _) in enumerate(lists):
                bound += self.top[t]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                break
            section = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == section:
                pivot += 1
            # the blocks that would hold this section: can they reach the threshold, and how far do they go?
            limit, until = 0.0, None
            for _, t, _ in lists[: pivot + 1]:
                block = int(np.searchsorted(self.block_last[t], section))
                if block < len(self.block_last[t]):
                    limit += self.block_top[t][block]
                    last = int(self.block_last[t][block])
                    until = last if until is None else min(until, last)
            if limit < threshold:
                skip = (section if until is None else max(section, until)) + 1
                if pivot + 1 < len(lists):
                    skip = min(skip, lists[pivot + 1][0])
                for cursor in lists[: pivot + 1]:
                    if cursor[0] < skip:
                        move(cursor, skip)
            else:
                score = 0.0
                for cursor in lists[: pivot + 1]:
                    if cursor[0] < section:
                        move(cursor, section)
                    if cursor[0] == section:
                        score += float(self.impacts[cursor[1]][cursor[2]])
                        move(cursor, section + 1)
                if score >= threshold:
                    found.append((section, score))
            lists = [x for x in lists if x[0] >= 0]
        return found

    def matches(self, text: bytes, threshold: float, verified: float) -> list[tuple[int, float, float, float, float]]:
        """Verified items of one text: item id, best score, and the highest overlap, of question, of answer, of both."""
        words = fold(text.split())
        at, term = self.terms(words)
        if not len(at):
            return []
        best: dict[int, float] = {}
        places: dict[int, set[int]] = {}
        # passages of 2 * SECTION words start every SECTION words; term k lies in passages (k // SECTION) and the one before
        order = np.concatenate([at // SECTION, at // SECTION - 1])
        which = np.concatenate([term, term])
        inside = (order >= 0) & (np.concatenate([at, at]) + 2 <= (order + 2) * SECTION)
        pairs = np.unique(np.stack([order[inside], which[inside]]), axis=1)
        if pairs.shape[1]:
            starts = np.flatnonzero(np.append(True, pairs[0, 1:] != pairs[0, :-1]))
            bounds = np.add.reduceat(self.top[pairs[1]], starts)
            ends = np.append(starts[1:], pairs.shape[1])
            for k in np.flatnonzero(bounds >= threshold).tolist():
                for section, score in self.search(pairs[1, starts[k] : ends[k]].tolist(), threshold):
                    item = int(self.item_of[section])
                    best[item] = max(score, best.get(item, 0.0))
                    places.setdefault(item, set()).add(int(pairs[0, starts[k]]))
        out = []
        for item, score in sorted(best.items()):
            known = self.items[item]
            reach = SHINGLE * known.words + 2 * SECTION
            spans: list[list[int]] = []
            for passage in sorted(places[item]):
                start, end = max(0, passage * SECTION - reach), (passage + 2) * SECTION + reach
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = end
                else:
                    spans.append([start, end])
            seen = [known.densest(words[i:j], 2 * (SECTION + reach)) for i, j in spans]
            q, a, _ = max(seen, key=lambda x: x[0] + x[1])
            alone = max(x[2] for x in seen)
            overlap = (q + a) / max(1, known.words)
            # a question of some length gives an item away without its answer
            asked = known.cut >= ALONE and alone >= QUESTION * known.cut
            if overlap >= verified or asked:
                share = lambda n, of: n / of if of else 1.0
                out.append((known.item_id, score, share(max(q, alone), known.cut), share(a, known.words - known.cut), overlap))
        return out


def _search(index, threshold: float, verified: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs_of(batches, 8_000_000):
            ids, texts = batch.column("doc_id").to_pylist(), utf8(batch.column("text"))
            rows = [(i, *m) for i, t in zip(ids, texts, strict=True) for m in index.value.matches(t, threshold, verified)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 4]
            names = [x.split()[0] for x in FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of each section, as one value each; a row without a pair tells the section's length."""
    for batch in batches:
        pairs, lengths = [], []
        for text in utf8(batch.column("text")):
            for section in parts_of(text)[2]:
                found = {b"\n".join(p) for p in section}
                pairs += [None, *found]
                lengths += [len(section), *[0] * len(found)]
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.binary()), pa.array(lengths, pa.int64())], names=["pair", "length"])


def index_groups(benchmark: DataFrame, group: int = GROUP) -> Iterator[Index]:
    """Indexes over groups of items of about ``group`` characters, with the statistics of all items; one is held at a time.

    Items are dealt to groups by hash, so a group's items and pairs, which come to the driver, are bounded however
    many items there are; which items share a group decides nothing.
    """
    known = benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    known = materialize(known, "items")
    total = known.agg(F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0))).first()[0]
    groups = max(1, -(-total // group))
    items = known.withColumn("group", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)))
    pairs = known.select("text").mapInArrow(_pairs, "pair binary, length long")
    df = materialize(pairs.groupBy("pair").agg(F.count("*").alias("df"), F.sum("length").alias("length")), "pairs")
    whole = df.filter("pair IS NULL").select("df", "length").first()
    if whole is None:
        return
    for g in range(groups):
        mine = items.filter(F.col("group") == g)
        rows = mine.select("item_id", "text").orderBy("item_id", "text").collect()
        if not rows:
            continue
        own = mine.select("text").mapInArrow(_pairs, "pair binary, length long").select("pair").distinct()
        counts = {tuple(bytes(r["pair"]).split(b"\n")): r["df"] for r in df.join(own, "pair", "left_semi").collect()}
        yield Index([(r["item_id"], r["text"].encode()) for r in rows], Statistics(whole["df"], whole["length"] / whole["df"], counts))


def _one_by_one(spark: SparkSession, indexes: Iterator[Index]) -> Iterator[tuple[Broadcast, bool]]:
    """Each index as a broadcast, and whether it is the last; an earlier one is taken back before the next one goes out."""
    held: Index | None = next(indexes, None)
    while held is not None:
        after = next(indexes, None)
        shared = spark.sparkContext.broadcast(held)
        yield shared, after is None
        if after is not None:
            shared.unpersist()
        held = after


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, verified: float = VERIFIED, group: int = GROUP) -> DataFrame:
    """One row per document and test item found in it: ``doc_id``, ``item_id``, the highest passage
    ``score`` (a share of the section's own BM25 score), ``question_overlap``, ``answer_overlap``, ``overlap``."""
    spark = docs.sparkSession
    read = docs.select(docs["doc_id"], docs["text"])
    found = spark.createDataFrame([], FOUND)
    for shared, last in _one_by_one(spark, index_groups(benchmark, group)):
        here = read.mapInArrow(_search(shared, threshold, verified), FOUND)
        found = found.unionByName(here if last else materialize(here, "leaks"))
    return found


def _clean(index, threshold: float, verified: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in runs_of(iter([whole]), 8_000_000, "searched_text"):
                bad = [bool(index.value.matches(t, threshold, verified)) for t in utf8(batch.column("searched_text"))]
                keep = batch.filter(pa.array([not x for x in bad], type=pa.bool_()))
                yield pa.RecordBatch.from_arrays(keep.columns[:-1], names=keep.schema.names[:-1])

    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, verified: float = VERIFIED, group: int = GROUP) -> DataFrame:
    """The documents in which no test item is found, with all their columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    clean = docs.select(*[docs[c].alias(n) for c, n in zip(docs.columns, names, strict=True)])
    text = names[docs.columns.index("text")]
    for shared, last in _one_by_one(docs.sparkSession, index_groups(benchmark, group)):
        kept = clean.withColumn("searched_text", F.col(text)).mapInArrow(_clean(shared, threshold, verified), clean.schema)
        clean = kept if last else materialize(kept, "clean")
    return clean.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
