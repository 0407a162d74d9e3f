"""Registered queries that SQL does not check, against plain Python over the whole smallest tables."""

import math
from collections import Counter
from fractions import Fraction
from zlib import crc32

import numpy as np
import pandas as pd
import pytest

from martwright.llm.queries import (
    VOCABULARY,
    op1_token_counts,
    op2_context_tree_scores,
    op3_dartminhash,
    op7_toxicity,
    op8_source_mix,
)
from martwright.llm.tokens import Counter as TokenCounter
from martwright.llm.tokens import ranks
from test_dartminhash import shingled, similarity


@pytest.fixture(scope="module")
def docs(folder):
    return pd.read_parquet(f"{folder}/documents.parquet")


def bucket(doc_id, n):
    return crc32(str(doc_id).encode()) % n


def test_op1_counts_whole_texts(spark, folder, docs):
    encoding = TokenCounter(ranks(spark, VOCABULARY)).encoding
    want = {d: len(encoding.encode_ordinary(t or "")) for d, t in zip(docs.doc_id, docs.text, strict=True)}
    rows = op1_token_counts(spark, folder).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want and len(rows) == len(docs)
    assert all(r["n_tokens_after"] == r["n_tokens"] for r in rows if r["n_edits"] == 0)


def test_op2_columns_of_the_base(spark, folder, docs):
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    tokens = {d: [*(t or "").encode().translate(lower).split(), None] for d, t in zip(docs.doc_id, docs.text, strict=True)}
    c = Counter(w for d, ws in tokens.items() if bucket(d, 5) != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    rows = op2_context_tree_scores(spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ws = tokens[r["doc_id"]]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (bucket(r["doc_id"], 5) == 1, len(ws), sum(c[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0


def test_op3_classes_of_all_pairs(spark, folder, docs):
    sets = [shingled(t) for t in docs.text]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if root[i] != root[j] and (not sets[i] and not sets[j] or similarity(sets[i], sets[j]) >= 0.8):
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    members = {}
    for d, r in zip(docs.doc_id.tolist(), root, strict=True):
        members.setdefault(r, []).append(d)
    want = {d: (min(m), len(m), d == min(m)) for m in members.values() for d in m}
    got = {r["doc_id"]: (r["class_id"], r["class_size"], r["stays"]) for r in op3_dartminhash(spark, folder).collect()}
    assert got == want and any(size > 1 for _, size, _ in want.values())


def test_op7_contract_columns(spark, folder, docs):
    rows = op7_toxicity(spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs.doc_id.tolist())
    for r in rows:
        assert r["held_out"] == (bucket(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    by_text = {}
    for d, s in ((r["doc_id"], r["score"]) for r in rows):
        by_text.setdefault(docs.text[docs.doc_id == d].iloc[0], set()).add(s)
    assert all(len(s) == 1 for s in by_text.values())


def test_op8_sizes_and_targets(spark, folder, docs):
    size = {d: len((t or "").encode().split()) for d, t in zip(docs.doc_id, docs.text, strict=True)}
    names = sorted({s for s in docs.source if s is not None}, key=lambda s: s.encode()) + [None] * bool(docs.source.isna().any())
    of = {d: None if s is None else s for d, s in zip(docs.doc_id, docs.source, strict=True)}
    total = {s: sum(size[d] for d in size if of[d] == s) for s in names}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, full = {}, set()
    while True:
        left = Fraction(3, 2) * sum(total.values()) - sum(2 * total[s] for s in full)
        open_ = [s for s in names if s not in full]
        target = {s: Fraction(2 * total[s]) for s in full} | {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if target[s] > 2 * total[s]}
        if not over:
            break
        full |= over
    rows = op8_source_mix(spark, folder).collect()
    assert len(rows) == len(docs)
    taken = Counter()
    for r in rows:
        s = of[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], total[s]) and r["target"] == pytest.approx(float(target[s]), rel=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= max(1.0, 0.001 * float(target[s])) for s in names)
    assert np.isfinite([r["target"] for r in rows]).all()
