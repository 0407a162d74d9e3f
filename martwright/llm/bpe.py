"""Byte-pair encoding in batched numpy merge rounds, and decoding.

For vocabularies whose words carry an end mark and whose white space is dropped. Texts are cut at white space; what
lies between is looked up in a table of pieces seen before, so only distinct new pieces are encoded. The symbols
of all their words lie in one flat array. A round finds the rank of every adjacent pair by binary search over the sorted
pair keys, takes the lowest rank of each word, and merges all places of that pair; words without a pair left go
out of the array. Words over ``LONG`` symbols, where a round per pair would read the word again and again, go through
the ranks in ascending order instead and touch only the places of each pair.

Both give the same merges as one at a time (lowest rank first, leftmost first) because a pair that contains a merged symbol
ranks behind the merge that made it; ``Vocabulary`` checks this.

Defined results: NULL or empty texts have no tokens and decode to the empty text. Special tokens count where their
exact string stands in a text. Repeated rows are encoded each, empty tables give empty results. A very long text is one
Python call of its own, whose memory is some ten times the text; long words cost n log n. Ids that the vocabulary lacks are
left out by decoding. A column of the input named like a new one is replaced; all others pass through.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType
from tokenizers import Tokenizer, models

from martwright.llm.text import runs_of

NONE = np.int64(1) << 60  # the rank of what is no pair
LONG = 2_000
# str.split() also cuts at these four, which are no white space in Unicode's sense
SEPARATORS = re.compile("[\x1c-\x1f]")
# The code points with Unicode's White_Space property.
WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def read_vocabulary(spark: SparkSession, path: str) -> str:
    """A ``tokenizer.json``; its size does not depend on any corpus."""
    return "\n".join(row["value"] for row in spark.read.text(path, wholetext=True).collect())


class Vocabulary:
    """Symbols, merges and special tokens of a ``tokenizer.json`` of kind BPE with word ends."""

    def __init__(self, source: str):
        told = json.loads(source)
        model = told["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.names = {n: t.encode() for t, n in {**vocab, **self.special}.items()}
        self.size = max(self.names) + 1
        self.inner = {t: n for t, n in vocab.items() if len(t) == 1}
        self.last = {t[0]: n for t, n in vocab.items() if len(t) == 1 + len(suffix) and t.endswith(suffix)} if suffix else self.inner
        self.left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        self.right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        self.product = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        keys = self.left * self.size + self.right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        made = np.full(self.size, -1, dtype=np.int64)
        made[self.product] = np.arange(len(merges))
        ahead = np.maximum(made[self.left], made[self.right]) > np.arange(len(merges))
        if ahead.any() or len(np.unique(self.product)) < len(merges):
            raise ValueError("a merge uses a symbol that a later merge makes, or two merges make the same one")
        self.normalizer = _component(told, "normalizer")
        self.pre_tokenizer = _component(told, "pre_tokenizer")
        self.plain = _plain(told)
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def normalized(self, text: str) -> str:
        return text if self.normalizer is None else self.normalizer.normalize_str(text)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` where there is no such merge."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        keys = left * self.size + right
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, self.order[place], NONE)


def _plain(told: dict):
    """What cuts lower-case printable ASCII into words, if the rules are known to leave such text as it is; else None."""
    rules = told["normalizer"] or {}
    kinds = [x["type"] for x in rules.get("normalizers", [rules] if rules else [])]
    steps = told["pre_tokenizer"].get("pretokenizers", [])
    if not {"Lowercase"} <= set(kinds) <= {"NFC", "Replace", "Lowercase"} or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
        return None
    split, pieces = steps
    if (split["behavior"], split["invert"], pieces["use_regex"], pieces["add_prefix_space"]) != ("Removed", True, False, False):
        return None
    if any(x.get("pattern") != {"Regex": r"\s+"} for x in rules["normalizers"] if x["type"] == "Replace"):
        return None
    return re.compile(split["pattern"]["Regex"].replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"), re.ASCII).findall


def _component(told: dict, name: str):
    """The library's own character rules (normal form, lower case, classes), which its Unicode tables define."""
    bare = json.loads(Tokenizer(models.BPE()).to_str())
    bare[name] = told[name]
    return getattr(Tokenizer.from_str(json.dumps(bare)), name)


def _every_other(places: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of ascending places, those that do not overlap when taken from the left; ``following`` is the next symbol's place."""
    if len(places) < 2:
        return places
    joined = np.append(False, following[:-1] == places[1:])
    index = np.arange(len(places))
    first = np.maximum.accumulate(np.where(joined, 0, index))
    return places[(index - first) % 2 == 0]


def merge_rounds(vocab: Vocabulary, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of many words after all merges, and their number per word."""
    word = np.repeat(np.arange(len(lengths)), lengths)
    done_symbols, done_words = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    while len(symbols):
        rank = np.full(len(symbols), NONE)
        rank[:-1] = vocab.ranks(symbols[:-1], symbols[1:])
        last = np.append(word[1:] != word[:-1], True)
        rank[last] = NONE
        starts = np.flatnonzero(np.append(True, last[:-1]))
        lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(symbols))))
        over = lowest == NONE
        done_symbols.append(symbols[over])
        done_words.append(word[over])
        places = np.flatnonzero((rank == lowest) & ~over)
        places = _every_other(places, places + 1)
        symbols[places] = vocab.product[rank[places]]
        stays = ~over
        stays[places + 1] = False
        symbols, word = symbols[stays], word[stays]
    found = np.concatenate(done_words)
    order = np.argsort(found, kind="stable")
    return np.concatenate(done_symbols)[order], np.bincount(found, minlength=len(lengths))


def merge_long(vocab: Vocabulary, symbols: np.ndarray) -> np.ndarray:
    """The same for one long word: ranks in ascending order, each with the places where its pair stands."""
    n = len(symbols)
    sym = np.append(symbols, -1)
    following, before = np.arange(1, n + 2), np.arange(-1, n)
    waiting: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def offer(places: np.ndarray) -> None:
        rank = vocab.ranks(sym[places], sym[following[places]])
        rank[following[places] >= n] = NONE
        places, rank = places[rank < NONE], rank[rank < NONE]
        order = np.argsort(rank, kind="stable")
        borders = np.flatnonzero(np.diff(rank[order])) + 1
        for part in np.split(order, borders) if len(order) else []:
            r = int(rank[part[0]])
            if r not in waiting:
                waiting[r] = []
                heapq.heappush(heap, r)
            waiting[r].append(places[part])

    offer(np.arange(n))
    while heap:
        r = heapq.heappop(heap)
        places = np.unique(np.concatenate(waiting.pop(r)))
        places = places[(sym[places] == vocab.left[r]) & (sym[following[places]] == vocab.right[r])]
        places = _every_other(places, following[places])
        gone = following[places]
        sym[places], sym[gone] = vocab.product[r], -1
        following[places] = following[gone]
        before[following[places]] = places
        near = np.concatenate([before[places], places])
        offer(np.unique(near[near >= 0]))
    return sym[sym >= 0]


def _gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The given stretches of an array, one after the other."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """Token ids of texts; keeps the ids of pieces between white space, up to a bound of characters."""

    def __init__(self, vocab: Vocabulary, limit: int = 3_000_000):
        self.vocab, self.limit = vocab, limit
        self._forget()

    def _forget(self) -> None:
        self.table: dict[str, int] = {}
        self.chars = 0
        self.starts = np.empty(0, dtype=np.int64)
        self.lengths = np.empty(0, dtype=np.int64)
        self.flat = np.empty(0, dtype=np.uint32)

    def _words(self, piece: str) -> list[str | int]:
        """The words of a piece in the vocabulary's byte alphabet; ids stand for special tokens."""
        vocab = self.vocab
        out: list[str | int] = []
        for part in vocab.specials.split(piece) if vocab.specials is not None else [piece]:
            if part in vocab.special:
                out.append(vocab.special[part])
            elif part:
                out.extend(w for w, _ in vocab.pre_tokenizer.pre_tokenize_str(vocab.normalized(part)))
        return out

    def _cut(self, pieces: list[str]) -> list[list[str | int]]:
        """The words of every piece. Plain ASCII takes a pattern, all other pieces go through the library in one string."""
        vocab = self.vocab
        cut: list[list[str | int]] = [[]] * len(pieces)
        others = []
        for i, p in enumerate(pieces):
            if vocab.specials is not None and vocab.specials.search(p):
                cut[i] = self._words(p)
            elif vocab.plain is not None and p.isascii() and p.isprintable():
                cut[i] = vocab.plain(p.lower())
            else:
                others.append(i)
                cut[i] = []
        if others:
            joined = vocab.normalized(" ".join([pieces[i] for i in others]))
            owner = np.cumsum(np.frombuffer(joined.encode("utf-32-le"), dtype="<u4") == 32)
            for w, (start, _) in vocab.pre_tokenizer.pre_tokenize_str(joined):
                cut[others[owner[start]]].append(w)
        return cut

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces, all their words at once."""
        cut = self._cut(pieces)
        words: dict[str | int, int] = {}
        which = np.array([words.setdefault(w, len(words)) for parts in cut for w in parts], dtype=np.int64)
        inner, last = self.vocab.inner, self.vocab.last
        lengths = np.array([1 if isinstance(w, int) else len(w) for w in words], dtype=np.int64)
        apart = {w: k for w, k in words.items() if isinstance(w, int) or len(w) > LONG}
        spelled = [s for w in words if w not in apart for s in (*map(inner.__getitem__, w[:-1]), last[w[-1]])]
        lengths[list(apart.values())] = 0
        symbols, counts = merge_rounds(self.vocab, np.array(spelled, dtype=np.int64), lengths)
        starts = np.cumsum(counts) - counts
        extra = []
        for w, k in apart.items():
            found = np.array([w]) if isinstance(w, int) else merge_long(self.vocab, np.array([*map(inner.__getitem__, w[:-1]), last[w[-1]]], dtype=np.int64))
            starts[k], counts[k] = len(symbols) + sum(map(len, extra)), len(found)
            extra.append(found)
        new = _gathered(np.concatenate([symbols, *extra]), starts[which], counts[which])
        ends = np.append(0, np.cumsum(counts[which]))[np.cumsum([len(parts) for parts in cut])]
        self.table.update(zip(pieces, range(len(self.table), len(self.table) + len(pieces)), strict=True))
        self.chars += sum(map(len, pieces))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.append(0, ends[:-1])])
        self.lengths = np.concatenate([self.lengths, np.diff(ends, prepend=0)])
        self.flat = np.concatenate([self.flat, new.astype(np.uint32)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and their number per text."""
        if self.chars > self.limit:
            self._forget()
        cut = [t.split() if not SEPARATORS.search(t) else [p for p in WHITE.split(t) if p] for t in texts]
        pieces = [p for parts in cut for p in parts]
        new = [p for p in dict.fromkeys(pieces) if p not in self.table]
        if new:
            self._learn(new)
        which = np.fromiter(map(self.table.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        ids = _gathered(self.flat, self.starts[which], self.lengths[which])
        ends = np.append(0, np.cumsum(self.lengths[which]))[np.cumsum([len(parts) for parts in cut], dtype=np.int64)]
        return ids, np.diff(ends, prepend=0)


@lru_cache(maxsize=1)
def _encoder(source: str) -> Encoder:
    return Encoder(Vocabulary(source))


def _with(batch: pa.RecordBatch, drop: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = {name: batch.column(name) for name in batch.schema.names if name not in {*drop, *new}}
    return pa.RecordBatch.from_pydict({**kept, **new})


def _fields(df: DataFrame, drop: list[str], new: str) -> str:
    names = [part.split()[0] for part in new.split(", ")]
    kept = StructType([f for f in df.schema.fields if f.name not in {*drop, *names}])
    return ", ".join(x for x in [kept.toDDL(), new] if x)


def encoded(docs: DataFrame, source: str, batch_bytes: int = 1 << 21) -> DataFrame:
    """``text`` replaced by ``ids`` (packed little-endian unsigned 32-bit integers) and ``n_tokens``."""
    value = docs.sparkSession.sparkContext.broadcast(source)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(value.value)
        for batch in runs_of(batches, batch_bytes):
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            ids, counts = encoder.encode(texts)
            offsets = np.append(0, np.cumsum(counts) * 4).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4"))])
            yield _with(batch, ["text"], {"ids": packed, "n_tokens": pa.array(counts, pa.int64())})

    return docs.mapInArrow(encode, _fields(docs, ["text"], "ids binary, n_tokens bigint"))


def decoded(encodings: DataFrame, source: str, batch_bytes: int = 1 << 21) -> DataFrame:
    """``ids`` replaced by ``text``: the tokens' strings joined by single spaces."""
    value = encodings.sparkSession.sparkContext.broadcast(source)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _encoder(value.value).vocab
        names = [vocab.names.get(n) for n in range(vocab.size)]
        for batch in runs_of(batches, batch_bytes, "ids"):
            texts = []
            for ids in batch.column("ids").to_pylist():
                numbers = np.frombuffer(ids or b"", dtype="<u4")
                known = [names[n] for n in numbers.tolist() if n < vocab.size]
                texts.append(b" ".join(x for x in known if x is not None) if None in known else b" ".join(known))
            yield _with(batch, ["ids"], {"text": pa.array(texts, pa.binary()).cast(pa.string())})

    return encodings.mapInArrow(decode, _fields(encodings, ["ids"], "text string"))
