import random
from zlib import crc32

import numpy as np
import pytest

from martwright.llm import toxicity
from tests_llm_words import words

BAD = ["awfulword", "nastyone", "vileterm", "uglyname"]


@pytest.fixture(scope="module")
def corpus(odd_rows):
    rng = random.Random(8)
    rows, labels = list(odd_rows), {}
    for k in range(1_500):
        ws = words(4_000 + k, rng.randrange(20, 120), 2_000)
        toxic = k % 8 == 0
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            ws.insert(rng.randrange(len(ws)), rng.choice(BAD).title() + rng.choice(["", ",", "."]))
        rows.append((1_000 + k, " ".join(ws)))
        labels[1_000 + k] = int(toxic)
    return rows, labels


@pytest.fixture(scope="module")
def label_table(spark, corpus):
    rows = [(i, 1, t, "x") for i, t in corpus[1].items()] + [(1_000, 0, 0, "x"), (None, 1, 1, "x"), (77_777, 0, 1, "x"), (1_001, 1, None, "x")]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_held_out_accuracy(docs_of, corpus, label_table):
    rows, labels = corpus
    docs = docs_of(rows)
    model = toxicity.train(toxicity.learnable(docs), toxicity.learnable(label_table))
    scores = [(r["doc_id"], r["score"]) for r in toxicity.score(docs, model).collect()]
    assert len(scores) == len(rows) and all(0 <= s <= 1 for _, s in scores)
    held = [(labels[i], s) for i, s in scores if i in labels and crc32(str(i).encode()) % 3 == 1]
    caught = [s >= 0.7 for y, s in held if y]
    assert sum(caught) >= 0.95 * len(caught) and not any(s >= 0.7 for y, s in held if not y)
    # equal texts, equal scores: nothing but the text is an input
    assert len({s for i, s in scores if i in (1, 6)}) == 1


def test_labels_of_held_out_rows_change_nothing(docs_of, corpus, label_table, spark):
    docs = docs_of(corpus[0])
    other = label_table.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = (toxicity.train(docs, toxicity.learnable(x)) for x in (label_table, other))
    assert (a.weights == b.weights).all() and a.intercept == b.intercept


def test_odd_tables(docs_of, corpus, label_table):
    none = label_table.filter("doc_id = -1")
    docs = docs_of(corpus[0])
    assert all(r["score"] < 0.7 for r in toxicity.score(docs, toxicity.train(docs, none)).collect())
    empty = docs_of([])
    assert toxicity.score(empty, toxicity.train(empty, label_table)).count() == 0


def test_sample_is_bounded(docs_of, corpus, label_table, monkeypatch):
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda p, u, prior: seen.update(p=len(p), u=len(u)))
    toxicity.train(docs_of(corpus[0]), label_table, positives=20, unlabelled=50)
    assert 18 <= seen["p"] <= 20 and 40 <= seen["u"] <= 50  # labels may lack a document


def test_one_id_with_very_many_rows(docs_of, spark, monkeypatch):
    """Rows that come to the driver are bounded like ids."""
    rows = [(1, f"row {k}") for k in range(4_000)] + [(2, "other")] + [(None, "none")] * 500
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda p, u, prior: seen.update(p=len(p), u=len(u)))
    toxicity.train(docs_of(rows), labels, positives=10, unlabelled=20)
    assert seen == {"p": 1, "u": 2}


def _risk(w, positive, unlabelled, prior):
    """The non-negative risk by its definition, and whether its correction is active."""
    margin = lambda rows: np.array([w[list(r)].sum() + w[-1] for r in rows])
    as_negative = np.logaddexp(0, margin(unlabelled)).mean() - prior * np.logaddexp(0, margin(positive)).mean()
    as_positive = prior * np.logaddexp(0, -margin(positive)).mean()
    return as_positive + as_negative if as_negative >= 0 else -as_negative


def test_gradient_against_finite_differences():
    rng = np.random.default_rng(3)
    signs = set()
    for trial in range(12):
        columns = 6
        positive = [np.unique(rng.integers(0, columns, 3)) for _ in range(15)]
        unlabelled = [np.unique(rng.integers(0, columns, 3)) for _ in range(25)]
        w = rng.normal(0, 2, columns + 1) - (4 if trial % 2 else 0)
        prior = 0.3 if trial % 3 else 0.9
        rows = positive + unlabelled
        row, column = np.repeat(np.arange(len(rows)), [len(x) for x in rows]), np.concatenate(rows)
        g, corrected = toxicity.gradient(w, row, column, len(positive), len(rows), prior)
        signs.add(bool(corrected >= 0))
        step = 1e-6
        for k in range(columns + 1):
            e = np.zeros(columns + 1)
            e[k] = step
            slope = (_risk(w + e, positive, unlabelled, prior) - _risk(w - e, positive, unlabelled, prior)) / (2 * step)
            assert abs(slope - g[k]) < 1e-5, (trial, k)
    assert signs == {True, False}  # the correction was seen on and off
