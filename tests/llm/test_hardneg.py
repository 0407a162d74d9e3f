"""Hard negatives against all pairs; the registered query against DuckDB is in test_llm_queries."""

import math
import random

import pytest
from pyspark.sql import functions as F

from martwright.llm import hardneg

SHAPE = "id long, label int, vector array<float>, row string, part string, score string, n string"


def brute(rows, scale=256, positives=5, negatives=5):
    known = {(i, c, tuple(math.floor(scale * x) for x in v)) for i, c, v in rows if None not in (i, c, v) and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in known:
        if a[0] % 100:
            continue
        scored = [(-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a[2], r[2], strict=False)))), r[0], r[1]) for r in known if r[0] != a[0]]
        for s, i, _ in sorted(x for x in scored if x[2] == a[1])[:positives]:
            inside = sorted(x for x in scored if x[2] != a[1] and 80 * -s <= 100 * -x[0] <= 100 * -s)
            out += [(a[0], i, k, x[1], -s, -x[0]) for k, x in enumerate(inside[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "r", "p", "s", "n") for r in rows], SHAPE).repartition(3)
    ints = hardneg.usable(df).select("id", "label", hardneg.quantized("vector", 256.0).alias("ints"), "row", "part")
    found = hardneg.hard_negatives(ints, F.col("id") % 100 == 0, **kw)
    return sorted(tuple(r) for r in found.collect())


def some(seed, n, dims=12, near=0.4):
    rng = random.Random(seed)
    centre = [rng.gauss(0, 1) for _ in range(dims)]
    return [(i, rng.randrange(4), [near * c + rng.gauss(0, 0.4) for c in centre]) for i in range(0, n * 4, 4)]


def float32(rows):
    import numpy as np

    return [(i, c, v and [None if x is None else float(np.float32(x)) for x in v]) for i, c, v in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(hardneg, "STEP", 3)
    rows = float32(some(seed, 400))
    want = brute(rows)
    assert len(want) > 50 and mined(spark, rows) == want


def test_many_cells(spark, monkeypatch):
    for name, value in {"BLOCK": 7, "SLOT": 2, "GROUP": 2, "SUPER": 1, "STEP": 2}.items():
        monkeypatch.setattr(hardneg, name, value)
    rows = float32(some(3, 300))
    assert mined(spark, rows) == brute(rows)


def test_ties_copies_and_odd_rows(spark):
    rows = some(4, 150)
    rows += [(i, i % 3, [0.5] * 12) for i in range(1000, 1300)]  # one very common vector
    rows += [rows[0], rows[0], (None, 1, [0.1] * 12), (3, None, [0.1] * 12), (7, 1, None), (9, 1, [0.1, None]), (11, 1, [float("nan")] * 12), (13, 1, [float("inf")] * 12)]
    rows += [(1400, 1, []), (1401, 1, [1.0]), (1500, 2, [0.0] * 12), (1600, 1, [-0.5] * 12), (1700, 9, [0.5] * 13)]
    rows += [(1800, 1, [0.4] * 12), (1800, 2, [0.3] * 12)]  # one id, two rows
    rows = float32(rows)
    assert mined(spark, rows) == brute(rows)


def test_large_components(spark):
    """Exact beyond doubles; scores beyond 64 bits count as the largest."""
    for top in (2**22, 2**40):
        rows = float32([(100 * i, i % 2, [float(top + i * top / 64), float(-(top // 2)), 1.0]) for i in range(40)])
        assert mined(spark, rows) == brute(rows)


def test_pruning_leaves_few(spark):
    """Most candidates leave before the last step."""
    import numpy as np

    rng = np.random.default_rng(5)
    columns = np.floor(rng.normal(0, 100, (64, 2000)))
    query = np.floor(rng.normal(0, 1, 64) * np.geomspace(400, 1, 64))
    seen = []

    def prune(least, most):
        seen.append(len(least))
        return hardneg._best_of(5)(least, most)

    anchor = hardneg.Anchor(query, columns.min(axis=1), columns.max(axis=1))
    found, scores = anchor.scan(columns, np.arange(2000), prune)
    exact = query @ columns
    assert set(np.argsort(-exact)[:5]) <= set(found) and (exact[found] == scores).all()
    assert seen[0] == 2000 and seen[-1] < 100


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [0.5]), (2, 2, [0.5])]) == []
    assert mined(spark, [(100, 1, [0.5])]) == []
