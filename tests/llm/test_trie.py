"""The trie against nested dictionaries; the registered query against DuckDB is in test_llm_queries."""

import hashlib
import random
import zlib

import pytest

from martwright.llm import trie
from martwright.llm.queries import op13_prefix_trie

SHAPE = "conv_id long, turn long, role string, text string, block string, n string, m string, depth string"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SHAPE).repartition(3)


def brute(rows, rebuild):
    own = {}
    for conv, turn, role, text in sorted(
        (r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    ):
        own.setdefault(conv, []).append((role or "", text or ""))
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        convs[c] = own.get(base, [])[:h] + turns[h:] if rebuild else turns
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in children.get(node, [])]
        saved = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        totals[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
        ids = ",".join(map(str, sorted(ends.get(node, []))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), len(children.get(node, [])), *totals[node], hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def both(spark, rows, rebuild=True):
    turns = trie.numbered_turns(table_of(spark, rows))
    found = trie.prefix_trie(*(trie.shared_heads(turns) if rebuild else trie.whole(turns)))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=str), brute(rows, rebuild)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("rebuild", [True, False])
def test_random_conversations(spark, seed, rebuild):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 120), 70):
        length = rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 12, 17])
        lead = rng.randrange(length + 1)
        for t in range(length):
            same = t < lead
            rows.append((c, t if rng.random() < 0.9 else None, "user" if same else rng.choice(["user", "bot", None]), f"turn {t}" * 3 if same else rng.choice(["a", "ö", None, "", "long " * 50])))
    rows += [(None, 1, "user", "nobody's"), rows[0], rows[0], rows[5]]
    got, want = both(spark, rows, rebuild)
    assert got == want


def test_copies_prefixes_and_turnless(spark):
    base = [("user", f"line {k}") for k in range(10)]
    rows = [(c, t, *turn) for c in range(0, 400, 5) for t, turn in enumerate(base[: 4 + c % 7])]
    # without its base and with fewer turns than its head: rebuilt without turns
    rows += [(c, 0, "user", "x") for c in range(1001, 1040) if c % 5]
    got, want = both(spark, rows)
    assert got == want and want[0][0] == 0
    only_turnless = [r for r in rows if r[0] > 1000]
    assert both(spark, only_turnless)[0] == both(spark, only_turnless)[1]


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 3)
    rows = [(5, t, "user", f"turn {t % 17}") for t in range(300)] + [(10, t, "user", f"turn {t % 17}") for t in range(290)] + [(c, t, "bot", "hi") for c in range(20, 60) for t in range(3)]
    for rebuild in (True, False):
        got, want = both(spark, rows, rebuild)
        assert got == want


def test_long_texts_and_empty_table(spark):
    got, want = both(spark, [(1, 1, "user", "x" * 3_000_000), (2, 1, "user", "x" * 3_000_000), (3, 1, None, None), (4, None, "", "")], rebuild=False)
    assert got == want
    assert both(spark, []) == ([], [])


def test_common_ends_are_hashed_in_pieces(spark):
    rows = [(c, 0, "user", "same") for c in range(1, 25_000)]
    got, want = both(spark, rows, rebuild=False)
    assert got == want


def test_plan_has_no_cross_join(spark, folder):
    plan = op13_prefix_trie(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
