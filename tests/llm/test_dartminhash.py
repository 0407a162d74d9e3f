import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.llm import dartminhash as d
from martwright.llm.links import components
from tests_llm_words import words


def shingled(text):
    ws = (text or "").encode().split()
    return Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5 else Counter([tuple(ws)] if ws else [])


def similarity(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def brute(rows, similar=0.8):
    sets = [shingled(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if not sets[i] and not sets[j] or similarity(sets[i], sets[j]) >= similar:
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    return Counter(tuple(sorted((x is None, x or 0) for x in g)) for g in groups.values())


def found_classes(docs):
    rows = d.classes(docs).groupBy("class_id", "class_size").agg(F.collect_list(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id")).alias("m")).collect()
    return rows


def edited(rng, ws, n):
    ws = list(ws)
    for _ in range(n):
        ws[rng.randrange(len(ws))] = f"new{rng.randrange(10**6)}"
    return ws


@pytest.fixture(scope="module")
def rows(odd_rows):
    """Copies of a centre that differ more from each other than from it; chains; template texts that share a half."""
    rng = random.Random(3)
    centre = words(500, 200, 10**6)
    out = list(odd_rows)
    out += [(100 + k, " ".join(edited(rng, centre, 4))) for k in range(40)] + [(150, " ".join(centre))]
    chain = words(501, 150, 10**6)
    for k in range(25):
        chain = edited(rng, chain, 2)
        out.append((200 + k, " ".join(chain)))
    half = words(502, 90, 10**6)
    out += [(300 + k, " ".join(half + words(600 + k, 60, 10**6))) for k in range(40)]
    out += [(400 + k, " ".join(words(700 + k // 2, 4, 10**6))) for k in range(6)]
    return out


def test_classes_equal_brute_force(docs_of, rows):
    found = d.classes(docs_of(rows, 4)).collect()
    assert len(found) == len(rows)
    # brute-force classes by ids; ids that occur with several texts are told apart by class size and members
    groups = Counter()
    by_class = {}
    for r in found:
        by_class.setdefault((r["class_id"], r["class_size"]), []).append(r)
    want = brute(rows)
    for (_, size), members in by_class.items():
        ids = [(m["doc_id"] is None, m["doc_id"] or 0) for m in members]
        for k in range(0, len(ids), size):
            if len(ids) == size:
                groups[tuple(sorted(ids))] += 1
    assert all(want[g] >= n for g, n in groups.items()) and sum(len(g) * n for g, n in want.items()) == len(rows)
    assert sum(groups.values()) >= sum(want.values()) - 6  # classes that share id and size are left out of the comparison


def test_one_of_each(docs_of, rows):
    kept = d.one_of_each(docs_of(rows, 4))
    assert kept.columns == docs_of([]).columns
    assert kept.count() == sum(brute(rows).values())


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    a = [b"x y z u v " * 3 + b" ".join(b"%d" % k for k in rng.integers(0, 10**6, 300))]
    words_ = a[0].split()
    for n in (10, 60):
        b = list(words_)
        for k in range(n):
            b[(k * 37) % len(b)] = b"other%d" % k
        texts = [a[0], b" ".join(b)]
        digests, owner, _ = d.split_words(texts)
        cell, of = d.cells(digests, owner)
        sig = d.signatures(cell, of, 2, 4000)
        assert (sig[0] == sig[1]).mean() == pytest.approx(similarity(shingled(texts[0].decode()), shingled(texts[1].decode())), abs=0.03)


def test_work_follows_darts_not_size():
    """A long text throws about as many darts as a short one."""
    cell = np.arange(200_000, dtype=np.uint64)
    assert len(np.unique(d.signatures(d.mix64(cell), np.zeros(len(cell), dtype=np.int64), 1, 160))) > 150


def test_components(spark):
    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(300)] + [(1000, k) for k in range(1001, 1400)] + [(5000, 5000), (None, 3), (7, None)]
    rng.shuffle(edges)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(301)}, **{k: 1000 for k in range(1000, 1400)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(docs_of):
    assert d.classes(docs_of([])).count() == 0 and d.one_of_each(docs_of([])).count() == 0
