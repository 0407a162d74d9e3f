import random
from collections import Counter

import pytest

from martwright.llm import decontam
from martwright.llm.queries import op9_decontamination
from tests_llm_words import words


@pytest.fixture(scope="module")
def items():
    out = [(k, " ".join(words(k, 15 + k % 45, 3_000)) + ". " + " ".join(words(900 + k, 8, 3_000)) + ".") for k in range(120)]
    return [*out, (500, None), (501, ""), (502, "single"), (None, "no id " * 10), (503, out[3][1]), (504, " ".join(words(7_777, 400, 3_000)))]


@pytest.fixture(scope="module")
def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")


@pytest.fixture(scope="module")
def rows(items, odd_rows):
    text = {i: t for i, t in items if t}
    rng = random.Random(4)
    out = list(odd_rows)
    for k in range(60):
        around = words(2_000 + k, 200, 3_000)
        at = rng.randrange(200)
        out.append((100 + k, " ".join([*around[:at], *(text[k].upper() if k % 2 else text[k]).split(), *around[at:]])))
    out += [(200 + k, " ".join(words(3_000 + k, 300, 3_000))) for k in range(60)]
    out += [(300, text[5]), (300, text[5]), (301, " ".join(text[7].split()[:6])), (302, text[504]), (303, " ".join(words(1, 50)) + " " + text[3])]
    return out


def planted(r):
    return {100 + k: {k} | ({503} if k == 3 else set()) for k in range(60)} | {300: {5}, 302: {504}, 303: {3, 503}}


@pytest.mark.parametrize("group", [4_000_000, 9_000])
def test_planted_items_are_found(docs_of, benchmark, rows, group):
    found = decontam.leaks(docs_of(rows), benchmark, group=group).collect()
    got = {}
    for r in found:
        got.setdefault(r["doc_id"], set()).add(r["item_id"])
        assert r["overlap"] >= 0.8
    assert got == planted(rows)
    assert sum(r["doc_id"] == 300 for r in found) == 2
    clean = decontam.decontaminated(docs_of(rows), benchmark, group=group)
    assert clean.columns == docs_of([]).columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(i) for i, _ in rows if i not in planted(rows))


def test_a_partial_quote_long_before_the_full_copy(docs_of, benchmark, items):
    """Both places score 1.0 in a section, but for rounding; the later one holds the item. Scattered parts do not count."""
    text = {k: t.split() for k, t in items[10:45]}  # 33 to 67 words: two or three sections
    gap = lambda k, n: words(4_000 + k, n, 3_000)
    rows = []
    for k, t in text.items():
        early = t[: len(t) * 2 // 3]
        rows.append((k, " ".join([*gap(k, 40), *early, *gap(100 + k, 100), *early, *gap(200 + k, 2_000), *t, *gap(300 + k, 40)])))
        rows.append((1_000 + k, " ".join([*early, *gap(400 + k, 2_000), *early, *gap(500 + k, 2_000), *t[len(early) :]])))
    table = docs_of(rows)
    found = decontam.leaks(table, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(k, k) for k in text]
    assert all(r["overlap"] == r["question_overlap"] == r["answer_overlap"] == 1.0 and r["score"] > 0.999 for r in found)
    assert sorted(r["doc_id"] for r in decontam.decontaminated(table, benchmark).collect()) == [1_000 + k for k in text]


def test_search_equals_exhaustive_scoring(items):
    known = [(i, (t or "").encode()) for i, t in items if i is not None]
    sections = [pairs for _, t in known for pairs in decontam.parts_of(t)[2]]
    df = Counter(t for pairs in sections for t in set(pairs))
    index = decontam.Index(known, decontam.Statistics(len(sections), sum(map(len, sections)) / len(sections), df))
    rng = random.Random(6)
    for _ in range(300):
        terms = sorted(rng.sample(range(len(index.codes)), rng.randrange(1, 60)))
        if rng.random() < 0.7:  # most terms of one section
            section = rng.randrange(len(index.item_of))
            own = [t for t, s in enumerate(index.sections) if section in s]
            terms = sorted({*terms[:10], *own[: rng.randrange(1, len(own) + 1)]})
        scores = {}
        for t in terms:
            for s, x in zip(index.sections[t].tolist(), index.impacts[t].tolist()):
                scores[s] = scores.get(s, 0) + x
        for threshold in (0.2, 0.5):
            want = {s: x for s, x in scores.items() if x >= threshold + 1e-9}
            got = dict(index.search(terms, threshold))
            assert set(want) <= set(got) and all(abs(scores[s] - x) < 1e-9 for s, x in got.items())


def test_groups_decide_nothing(spark, docs_of):
    """Items that share a beginning make its words cheap for all, whichever group they are in."""
    lead = words(70, 17, 3_000)
    items = [(k, " ".join([*lead, *words(500 + k, 30, 3_000)]) + ". " + " ".join(words(800 + k, 9, 3_000))) for k in range(40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(k, " ".join([*words(9_000 + k, 50), *t.split(), *words(9_500 + k, 50)])) for k, t in items[:10]]
    rows += [(100 + k, " ".join([*lead, *words(9_700 + k, 100)])) for k in range(10)]
    found = {}
    for group in (4_000_000, 2_000, 5_000):
        table = decontam.leaks(docs_of(rows), benchmark, group=group)
        found[group] = sorted((r["doc_id"], r["item_id"], round(r["score"], 9), r["overlap"]) for r in table.collect())
    assert len(set(map(str, found.values()))) == 1
    assert [x[:2] for x in found[2_000]] == [(k, k) for k in range(10)]


def test_question_alone_and_changed_words(docs_of, benchmark, items):
    text = {k: t.split() for k, t in items[20:44]}  # questions of 35 to 59 words, answers of 8
    around = lambda k, part: " ".join([*words(6_000 + k, 60, 3_000), *part, *words(6_500 + k, 60, 3_000)])
    rows, want = [], []
    for k, t in text.items():
        rows.append((k, around(k, t[:-8])))  # the whole question
        changed = list(t)
        for at in (5, len(t) // 2, len(t) - 12):
            changed[at] = "changed"
        rows.append((1_000 + k, around(100 + k, changed)))
        want += [(k, k), (1_000 + k, k)]
        rows.append((2_000 + k, around(200 + k, t[-8:])))  # the answer alone is no leak
        rows.append((3_000 + k, around(300 + k, t[: len(t) // 2])))
    found = decontam.leaks(docs_of(rows), benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == sorted(want)


def test_query_equals_exhaustive_search(spark, folder):
    """Every item against every document: the query finds the items whose words are covered, and no others."""
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    want = set()
    for item in items:
        words_, cut, _ = decontam.parts_of(item["text"].encode())
        known = decontam.Item(item["item_id"], words_, cut)
        for doc in docs:
            near = decontam.fold((doc["text"] or "").encode().split())
            q, a, alone = known.densest(near, 2 * (decontam.SECTION + decontam.SHINGLE * known.words + 2 * decontam.SECTION))
            if q + a >= decontam.VERIFIED * known.words or (cut >= decontam.ALONE and alone >= decontam.QUESTION * cut):
                want.add((doc["doc_id"], item["item_id"]))
    assert want and {(r["doc_id"], r["item_id"]) for r in op9_decontamination(spark, folder).collect()} == want


def test_empty_tables(docs_of, benchmark, rows):
    assert decontam.leaks(docs_of([]), benchmark).count() == 0
    none = benchmark.filter("item_id = -1")
    assert decontam.leaks(docs_of(rows), none).count() == 0
    assert decontam.decontaminated(docs_of(rows), none).count() == len(rows)
