"""Digests of words: equal for equal words only, also where polynomial hashes meet; and the operators that rest on them."""

import random

import numpy as np
import pytest

from martwright.llm import ctw, dartminhash, repeats
from martwright.llm.text import SHORT_WORD, word_digests
from tests_llm_words import words


def thue_morse(n):
    """Two words of ``n`` letters whose difference every polynomial modulo 2^64 with an odd base maps to 0."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_digests_by_word():
    rng = random.Random(3)
    texts = []
    for _ in range(300):
        n = rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 31, 32, 33, 40, 100])
        texts.append(b" ".join(bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.choice([n, n, 1, 8]))) for _ in range(30)) + rng.choice([b"", b" ", b"\n\t"]))
    texts += [b"", b"   ", b"x" * SHORT_WORD, b"x" * (SHORT_WORD + 1)]
    whole = [w for t in texts for w in t.split()]
    for piece in (1 << 19, 50):
        low, high, counts = word_digests(texts, piece)
        assert counts.tolist() == [len(t.split()) for t in texts]
        seen = {}
        for w, a, b in zip(whole, low.tolist(), high.tolist(), strict=True):
            assert seen.setdefault(w, (a, b)) == (a, b)
        for half in (0, 1):
            assert len({d[half] for d in seen.values()}) == len(seen)


@pytest.mark.parametrize("n", [16, 32, 64, 1024, 4096])
def test_structured_words_do_not_meet(n):
    pair = [w.encode() for w in thue_morse(n)]
    low, high, _ = word_digests(pair)
    assert low[0] != low[1] and high[0] != high[1]


def test_all_words_of_two_letters():
    """Every word of up to twelve letters over two of them: no halves meet."""
    every = [bytes(97 + (k >> i & 1) for i in range(n)) for n in range(1, 13) for k in range(1 << n)]
    low, high, _ = word_digests([b" ".join(every)])
    assert len(np.unique(low)) == len(np.unique(high)) == len(every)


def test_operators_tell_structured_words_apart(docs_of):
    a, b = thue_morse(1024)
    lead = words(1, 25)
    other = words(2, 30)
    docs = docs_of([(1, " ".join([*other[:10], a, *lead[:9]])), (2, " ".join([*other[10:20], b, *lead[:9]])), (3, " ".join([a] * 3)), (4, " ".join([b] * 3))])
    windows = repeats.without_repeats(docs_of([(1, " ".join([a, *lead[:19]])), (2, " ".join([b, *lead[:19]])), (3, " ".join([a, *lead[:19]]))]))
    assert sorted((r["doc_id"], r["n_removed"]) for r in windows.collect()) == [(1, 0), (2, 0), (3, 20)]
    assert {r["doc_id"]: r["class_id"] for r in dartminhash.classes(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    scored = ctw.scored(docs_of([(k, t) for k in range(40) for t in [a if k % 2 else a + "x"]] + [(100 + k, b) for k in range(3)]))
    known = {r["doc_id"]: (r["n_tokens"], r["n_known"]) for r in scored.collect() if r["held_out"]}
    assert known and all(n == (2, 2) for d, n in known.items() if d < 100), known


def test_ids_that_hold_many_rows(docs_of, spark):
    """A third of all rows under one id and a third without any spread over the blocks; repeats are found all the same."""
    from martwright.llm.text import blocked

    rows = [(7, " ".join(words(k, 40, 10**6))) for k in range(200)] + [(None, " ".join(words(1_000 + k, 40, 10**6))) for k in range(200)]
    rows += [(1_000 + k, " ".join(words(2_000 + k, 40, 10**6))) for k in range(200)]
    rows += [(7, rows[3][1] + " more"), (None, rows[250][1] + " more"), (5_000, rows[3][1]), (5_001, rows[250][1])]
    dealt = blocked(docs_of(rows), 20_000).groupBy("block").count().collect()
    assert len(dealt) > 5 and max(r["count"] for r in dealt) < len(rows) / 3
    done = repeats.without_repeats(docs_of(rows), block_chars=20_000).collect()
    assert sum(r["n_removed"] for r in done) == 4 * 40


def test_repeated_rows_are_compared_once(docs_of, monkeypatch):
    """Two near texts, 60 rows each: one pair, however often the rows repeat."""
    text = words(9, 100, 10**6)
    near = [*text[:50], "changed", *text[51:]]
    seen = []
    compared = dartminhash.compared

    def counted(pairs, signed, cell_lists):
        seen.append((pairs.count(), cell_lists.count()))
        return compared(pairs, signed, cell_lists)

    monkeypatch.setattr(dartminhash, "compared", counted)
    rows = [(1, " ".join(text))] * 60 + [(2, " ".join(near))] * 60
    found = dartminhash.classes(docs_of(rows)).collect()
    assert {(r["doc_id"], r["class_id"], r["class_size"]) for r in found} == {(1, 1, 120), (2, 1, 120)}
    assert seen == [(1, 2)]
