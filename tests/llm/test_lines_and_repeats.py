from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from martwright.llm import lines, repeats
from tests_llm_words import words


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


def without_common(rows, need, min_chars=1):
    seen = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            seen[key(line)].add(i)
    gone = {k for k, ids in seen.items() if len(k) >= min_chars and len(ids) >= need}
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        kept = [x for x in parts if key(x) not in gone]
        out.append((i, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.fixture(scope="module")
def line_rows(odd_rows):
    """One line in every document, so its run spans all ranges; lines around the limit."""
    shared = [f"line {k} of some documents" for k in range(12)]
    rows = []
    for i in range(300):
        own = [f"  Common LINE\t", f"own line {i}", *shared[: i % 13], "", "common line" if i % 2 else "other"]
        rows.append((i + 100, "\n".join(own)))
    return [*odd_rows, *rows]


@pytest.mark.parametrize("need", [2, 10])
def test_common_lines_leave(docs_of, line_rows, need):
    docs = docs_of(line_rows, 6)
    done = lines.drop_lines(docs, lines.keep_bitmaps(docs, min_documents=need))
    got = Counter((r["doc"]["doc_id"], r["n_lines"], r["n_dropped"], r["doc"]["text"]) for r in done.collect())
    assert got == without_common(line_rows, need)
    assert lines.deduplicated(docs, need).columns == docs.columns


def test_first_occurrence_stays(docs_of, line_rows):
    rows = [r for r in line_rows if r[0] is not None and r[0] >= 100]
    docs = docs_of(rows, 6)
    seen, want = set(), {}
    for i, t in sorted(rows):
        kept = [x for x in t.split("\n") if not key(x) or not (key(x) in seen or seen.add(key(x)))]
        want[i] = "\n".join(kept)
    got = {r["doc_id"]: r["text"] for r in lines.deduplicated(docs, None).select("doc_id", "text").collect()}
    assert got == want


def covered(rows, length):
    """Spans by definition: every window that also starts earlier."""
    order = sorted({(i is None, i, t or "") for i, t in rows}, key=lambda r: (r[0], r[1] if r[1] is not None else 0))
    first, out = set(), {}
    for none, i, t in order:
        ws = t.encode().split()
        marks = [False] * len(ws)
        for s in range(len(ws) - length + 1):
            w = tuple(ws[s : s + length])
            if w in first:
                marks[s : s + length] = [True] * length
            first.add(w)
        out[(i, t)] = (len(ws), sum(marks), b" ".join(w for w, m in zip(ws, marks) if not m).decode())
    return out


@pytest.mark.parametrize("chars", [2_000, 10_000_000])
def test_repeats_equal_brute_force(docs_of, odd_rows, chars):
    passage = " ".join(words(77, 60))
    rows = [r for r in odd_rows if r[0] not in (9, None)]  # one text per id: the order of others is by hash
    for k in range(40):
        a, b = words(200 + k, 30), words(300 + k, 25)
        cut = passage.split()[k % 30 : k % 30 + 19 + k % 20]
        rows.append((1000 - 7 * k, " ".join(a + cut + b)))
    rows += [(2000, passage), (2001, passage + " " + passage), (2002, "")]
    docs = docs_of(rows, 4)
    found = repeats.without_repeats(docs, block_chars=chars).collect()
    want = covered(rows, 20)
    assert len(found) == len(rows)
    text = dict(rows)
    for r in found:
        assert (r["n_words"], r["n_removed"], r["kept"]) == want[(r["doc_id"], text[r["doc_id"]] or "")]
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_odd_ids_and_empty_tables(docs_of, odd_rows):
    assert repeats.without_repeats(docs_of(odd_rows)).count() == len(odd_rows)
    empty = docs_of([])
    assert repeats.without_repeats(empty).count() == 0
    assert lines.deduplicated(empty, 10).count() == 0
    # NULL ids come last: the text with an id keeps its words
    rows = [(None, " ".join(words(5, 40))), (3, " ".join(words(5, 40)))]
    got = {r["doc_id"]: r["n_removed"] for r in repeats.without_repeats(docs_of(rows)).collect()}
    assert got == {None: 40, 3: 0}


def test_repeats_deal_texts_once(docs_of, odd_rows):
    """The passes over the texts share one exchange."""
    found = repeats.without_repeats(docs_of(odd_rows * 3), block_chars=3_000)
    found.agg(F.sum("n_removed")).collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
