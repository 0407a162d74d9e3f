from collections import Counter

import pytest
from pyspark.sql import functions as F

from martwright.llm import mixing, quality


def measured(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    lines = [x for x in text.split("\n") if x.encode().split()]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(lines),
    )


def test_measurements_equal_brute_force(docs_of, odd_rows):
    rows = [*odd_rows, (20, "a b c a b c x"), (21, "x\nx\n \nx y#*$%&|<>"), (22, "a b"), (23, "z z z z")]
    ledger = quality.ledger(docs_of(rows))
    got = Counter((r["doc_id"], tuple(r[m] for m in quality.MEASURES)) for r in ledger.collect())
    assert got == Counter((r[0], measured(r[1])) for r in rows)


def test_policies_and_ablations(docs_of, odd_rows):
    ledger = quality.ledger(docs_of([*odd_rows, (30, "###  $$$ " * 60)])).cache()
    masks = {p: quality.mask_of(names) for p, names in quality.POLICIES.items()}
    bits = [r["failed_bits"] for r in ledger.collect()]
    for policy, mask in masks.items():
        kept = [r["kept"] for r in quality.apply_policy(ledger, policy).collect()]
        assert sum(kept) == sum(b & mask == 0 for b in bits)
        for r in quality.ablations(ledger, policy).collect():
            bit = quality.mask_of([r["rule"]])
            assert r["failed"] == sum(b & bit != 0 for b in bits)
            assert r["failed_alone"] == sum(b & mask == bit for b in bits)
            assert r["failed_with_others"] == r["failed"] - r["failed_alone"]


def test_keep_good_keeps_all_columns(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id IS NOT NULL").collect()) == [1, 5, 6, 7, 7, 8, 11]


def test_empty_tables(docs_of):
    empty = docs_of([])
    assert quality.ledger(empty).count() == 0 and quality.keep_good(empty).count() == 0
    assert mixing.Mix(empty).documents().count() == 0


def reshared(sizes, weights, budget, passes):
    """Give by weight, stop at the caps, give the excess again until nothing is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = budget * sum(sizes.values()) - sum(passes * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        target = {s: passes * sizes[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in names}
        above = {s for s in free if target[s] > passes * sizes[s]}
        if not above:
            return target
        capped |= above


@pytest.mark.parametrize("block", [1, 7, 64, 1024])
def test_mix_meets_targets(docs_of, odd_rows, block):
    rows = [(i, t, ["b", "a", None, "c", "é"][k % 5]) for k, (i, t) in enumerate(odd_rows)]
    found = mixing.Mix(docs_of(rows), block=block).documents().collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for i, t, s in rows:
        sizes[s] += len((t or "").encode().split())
    want = reshared(sizes, [3, 1, 2], 1.5, 2)
    taken = Counter()
    for r in found:
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6


def test_mix_repeats_and_schedule(docs_of, odd_rows):
    rows = [(i, t, "abc"[k % 3]) for k, (i, t) in enumerate(odd_rows)]
    runs = [sorted(mixing.Mix(docs_of(rows, p), block=16).documents().select("doc_id", "size", "taken").collect(), key=str) for p in (1, 5)]
    assert runs[0] == runs[1]
    mix = mixing.Mix(docs_of(rows), block=16)
    slots = mix.schedule().orderBy("slot").collect()
    assert len({s["slot"] for s in slots}) == len(slots) == mix.quotas().agg(F.sum("slots")).first()[0]
    # any stretch of the schedule holds the sources in nearly the target proportions
    share = Counter(s["place"] for s in slots)
    for n in (len(slots) // 7, len(slots) // 2):
        part = Counter(s["place"] for s in slots[:n])
        for p, whole in share.items():
            assert abs(part[p] - n * whole / len(slots)) < 12
    for p in share:
        ranks = [s["rank"] for s in slots if s["place"] == p]
        assert ranks == list(range(len(ranks)))
