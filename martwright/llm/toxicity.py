"""Toxicity by positive-unlabelled learning with a non-negative risk (numpy, logistic loss).

Confirmed toxic texts are the positives; unlabelled text is a mixture that holds the class prior's share
of positives. The risk of calling the unlabelled text negative is corrected by that share, and where the
corrected part turns negative (the model starts to fit the unlabelled positives as negatives) its
gradient is reversed. Features are hashed words and word beginnings; the weights, a table of fixed
size, are broadcast, and every whole text is scored where it is read.

Defined results: NULL and empty texts have no features and get the score of the intercept. Repeated rows
are scored each. Labels: a document is confirmed toxic if any of its label rows says 1; NULL labels and
NULL ids count as unlabelled and unknown. Of a repeated id's texts the smallest is learnt from. Long texts are read whole. Without any positive, every score is the prior. Extra columns are
not read. An empty table gives no scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.text import in_bucket, runs_of, utf8

BITS = 20
EDGE = b".,;:!?\"'()[]{}<>*#$%&_-"
POSITIVES, UNLABELLED = 4_000, 8_000  # the bound of the training sample, in documents
MIN_DOCUMENTS = 5  # a feature of fewer confirmed documents is left at weight 0
EVIDENCE = 4.0


class Features:
    """Distinct hashed features of a text. The memory of seen words is bounded."""

    def __init__(self, limit: int = 300_000):
        self.limit = limit
        self.known: dict[bytes, tuple[int, ...]] = {}

    def _word(self, raw: bytes) -> tuple[int, ...]:
        word = raw.strip(EDGE)
        if not word:
            return ()
        parts = [b"w" + word] + [b"%d" % n + word[:n] for n in (4, 5, 6) if len(word) >= n]
        return tuple(crc32(x) & ((1 << BITS) - 1) for x in parts)

    def __call__(self, text: bytes) -> np.ndarray:
        if len(self.known) > self.limit:
            self.known.clear()
        found: set[int] = set()
        for word in set(text.lower().split()):
            ids = self.known.get(word)
            if ids is None:
                ids = self.known[word] = self._word(word)
            found.update(ids)
        return np.fromiter(found, dtype=np.uint32, count=len(found))


@dataclass
class Model:
    weights: np.ndarray  # float32, one per feature
    intercept: float

    def score(self, features: np.ndarray) -> float:
        z = self.intercept + float(self.weights[features].sum(dtype=np.float64))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def gradient(w: np.ndarray, row: np.ndarray, column: np.ndarray, n_pos: int, n: int, prior: float) -> tuple[np.ndarray, float]:
    """Of the non-negative risk, and the corrected risk of unlabelled text as negative.

    ``row`` and ``column`` hold the features of ``n`` texts, the first ``n_pos`` confirmed; the last weight is the intercept.
    """
    is_pos, n_unl = np.arange(n) < n_pos, n - n_pos
    z = np.clip(np.bincount(row, weights=w[column], minlength=n) + w[-1], -50, 50)
    p = 1 / (1 + np.exp(-z))
    as_negative = np.logaddexp(0, z)
    corrected = as_negative[~is_pos].mean() - prior * as_negative[is_pos].mean()
    negative = np.where(is_pos, -prior * p / n_pos, p / n_unl)
    by_row = np.where(is_pos, prior * (p - 1) / n_pos, 0.0) + negative if corrected >= 0 else -negative
    return np.append(np.bincount(column, weights=by_row[row], minlength=len(w) - 1), by_row.sum()), corrected


def fit(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    steps: int = 200,
    rate: float = 0.1,
    ridge: float = 1e-4,
    evidence: float = EVIDENCE,
) -> Model:
    """Adam with a falling rate on the non-negative risk, all rows in each step.

    Only features that confirmed texts have ``evidence`` standard errors more often than unlabelled ones
    get a weight: words of every text would let the model tell the two samples apart one by one.
    """
    if not positive or not unlabelled:
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(prior / (1 - prior))))
    rows = positive + unlabelled
    n, n_pos, n_unl = len(positive) + len(unlabelled), len(positive), len(unlabelled)
    row = np.repeat(np.arange(n), [len(x) for x in rows])
    feature = np.concatenate(rows).astype(np.int64)
    among_pos = np.bincount(feature[row < n_pos], minlength=1 << BITS)
    among_unl = np.bincount(feature[row >= n_pos], minlength=1 << BITS)
    share = (among_unl + 1) / (n_unl + 1)
    excess = (among_pos / n_pos - share) / np.sqrt(share * (1 / n_pos + 1 / n_unl))
    chosen = (excess > evidence) & (among_pos >= MIN_DOCUMENTS)
    row, feature = row[chosen[feature]], feature[chosen[feature]]
    used, column = np.unique(feature, return_inverse=True)
    w = np.zeros(len(used) + 1)
    w[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        g, _ = gradient(w, row, column, n_pos, n, prior)
        g[:-1] += ridge * w[:-1]
        mean = 0.9 * mean + 0.1 * g
        square = 0.999 * square + 0.001 * g * g
        w -= rate * (1 - step / (steps + 1)) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = w[:-1]
    return Model(weights, float(w[-1]))


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = Features()
    for batch in runs_of(batches, 8_000_000):
        found = [features(t).tobytes() for t in utf8(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.binary())], names=["toxic", "features"])


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fit on at most ``positives`` documents that ``labels`` confirms and ``unlabelled`` sampled documents.

    The unlabelled part is drawn from all of ``docs`` without a look at labels; the prior is the share of confirmed among
    the labelled documents. Ids are drawn by a hash of the id; they are bounded and broadcast, so documents are read
    once and not shuffled. Of several texts under one id the smallest counts, so rows are bounded like ids.
    """
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.coalesce(F.max(F.when(F.col("toxic") == 1, 1)), F.lit(0)).alias("toxic"))
    n = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    prior = min(max((n["t"] or 0) / max(1, n["n"]), 1e-4), 0.5)

    def drawn(ids: DataFrame, k: int, kind: int) -> DataFrame:
        """The first ``k`` ids in the order of their hash; only some ``4 * k`` of them, by that hash, are sorted at all."""
        order = F.xxhash64(F.lit("sample" if kind else "unlabelled"), "doc_id")
        different = ids.agg(F.approx_count_distinct("doc_id")).first()[0]
        share = min(1.0, 4 * k / max(1, different))
        low = ids.select("doc_id").filter(order <= int(-(2**63) + share * (2**64 - 1)) if share < 1 else F.lit(True))
        return low.distinct().orderBy(order, "doc_id").limit(k).select(F.col("doc_id").alias("of"), F.lit(kind).alias("toxic"))

    chosen = drawn(known.filter("toxic = 1"), positives, 1).unionByName(drawn(docs.filter("doc_id IS NOT NULL"), unlabelled, 0))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("of"))
    texts = texts.groupBy("of", "toxic").agg(F.min("text").alias("text")).select("toxic", "text")
    parts: dict[int, list[np.ndarray]] = {0: [], 1: []}
    for row in texts.mapInArrow(_featurize, "toxic int, features binary").toLocalIterator():
        parts[row["toxic"]].append(np.frombuffer(row["features"], dtype=np.uint32))
    return fit(parts[1], parts[0], prior)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in runs_of(batches, 8_000_000):
            scores = [model.value.score(features(t)) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(_score(shared), "doc_id long, score double")


def learnable(rows: DataFrame, buckets: int = 3, held_out: int = 1) -> DataFrame:
    """Rows that may be learnt from: crc32 of the id is not in the held-out bucket."""
    return rows.filter(~in_bucket(F.col("doc_id"), buckets, held_out))
