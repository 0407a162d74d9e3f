import random

import pytest

from martwright.llm import tokens
from martwright.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def vocabulary(spark):
    return tokens.ranks(spark, VOCABULARY)


@pytest.fixture(scope="module")
def count(vocabulary):
    return tokens.Counter(vocabulary)


def full(count, text):
    return len(count.encoding.encode_ordinary(text))


def text_of(rng, n):
    parts = ["a", "b", " ", "  ", "\n", "1", "2", "'", "'re", "ll", ".", "!", "é", " the", "\t", "日本"]
    return "".join(rng.choice(parts) for _ in range(n))


@pytest.mark.parametrize("leaf", [1, 4, 64])
def test_edits_equal_full_encoding(count, monkeypatch, leaf):
    monkeypatch.setattr(tokens, "LEAF", leaf)
    rng = random.Random(leaf)
    for _ in range(400):
        text = text_of(rng, rng.randrange(0, 200))
        tree = tokens.build(text, count)
        for _ in range(3):
            edits = [(rng.randrange(0, len(text) + 2), rng.randrange(0, 9), text_of(rng, rng.choice([0, 1, 3, 60]))) for _ in range(rng.randrange(1, 5))]
            text, tree, _ = tokens.edit(text, tree, edits, count)
            assert tree.tokens[1] == full(count, text) and tree.chars[1] == len(text)
            assert (tree.tokens[1 : tree.size] == tree.tokens[2::2] + tree.tokens[3::2]).all()


def test_small_edit_of_long_text_is_cheap(count):
    text = " ".join(f"word{k} and more" for k in range(50_000))
    tree = tokens.build(text, count)
    after, changed, encoded = tokens.edit(text, tree, [(400_000, 3, "x")], count)
    assert encoded < 2_000 < len(text) and changed.tokens[1] == full(count, after)


def test_odd_documents(docs_of, odd_rows, vocabulary, count):
    state = tokens.with_trees(docs_of(odd_rows), vocabulary)
    got = sorted((r["text"] or "", r["tree_tokens"][1]) for r in state.collect())
    assert got == sorted((t or "", full(count, t or "")) for _, t in odd_rows)
    after = tokens.apply_edits(state, vocabulary, find=tokens.redactions).collect()
    assert len(after) == len(odd_rows) and all(r["tree_tokens"][1] == full(count, r["text"]) for r in after)


def test_edits_as_rows(spark, docs_of, vocabulary, count):
    docs = docs_of([(1, "one two three"), (2, None), (None, "abc"), (3, "same"), (3, "same")])
    edits = spark.createDataFrame(
        [(1, 4, 3, "2"), (1, 100, 5, " end"), (2, 0, 0, "new text"), (None, 1, None, None), (3, 0, 1, "S"), (9, 0, 0, "x")],
        "doc_id long, start int, removed int, inserted string",
    )
    rows = tokens.apply_edits(tokens.with_trees(docs, vocabulary), vocabulary, edits).collect()
    assert sorted(r["text"] for r in rows) == sorted(["one 2 three end", "new text", "abc", "Same", "Same"])
    assert all(r["tree_tokens"][1] == full(count, r["text"]) for r in rows)
    nothing = edits.filter("doc_id > 100")
    assert all(r["chars_encoded"] == 0 for r in tokens.apply_edits(tokens.with_trees(docs, vocabulary), vocabulary, nothing).collect())


def test_redactions():
    text = "mail a.b@c.org now\nsame line\nsame line\ncall +49 170 1234567 x"
    out = []
    at = 0
    for start, removed, inserted in sorted(tokens.redactions(text)):
        out += [text[at:start], inserted]
        at = start + removed
    assert "".join(out) + text[at:] == "mail <email> now\nsame line\ncall <number> x"


def test_empty_table(docs_of, vocabulary):
    assert tokens.apply_edits(tokens.with_trees(docs_of([]), vocabulary), vocabulary, find=tokens.redactions).count() == 0
