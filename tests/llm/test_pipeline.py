"""The pipeline's stages against plain Python, stage by stage, and as a whole."""

from collections import Counter

import pytest

import corpus_pipeline
from martwright.llm import decontam
from martwright.session import materialize
from test_dartminhash import shingled, similarity
from test_lines_and_repeats import key
from test_quality_and_mixing import measured, reshared


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], folder), "stage"))
    return [df.collect() for df in out], [df.columns for df in out]


def kept_by_quality(text):
    words, chars, symbols, dup_lines, repeats, lines = measured(text)
    bad = [words < 50, 100 * repeats > 50 * words, 10 * symbols > words, 2 * dup_lines > lines, chars < 3 * words, chars > 12 * words]
    return not any(bad)


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_columns(stages):
    _, columns = stages
    assert all(c == columns[0] for c in columns[1:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "decontamination", "source mix"]


def test_quality_rules(stages):
    raw, good = (texts(x) for x in stages[0][:2])
    assert good == {i: t for i, t in raw.items() if kept_by_quality(t)} and len(good) < len(raw)


def test_line_dedup(stages):
    before, after = (texts(x) for x in stages[0][1:3])
    seen = {}
    for i, t in before.items():
        for line in t.split("\n"):
            seen.setdefault(key(line), set()).add(i)
    gone = {k for k, ids in seen.items() if k and len(ids) >= 10}
    assert after == {i: "\n".join(x for x in t.split("\n") if key(x) not in gone) for i, t in before.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in stages[0][2])


def test_near_dedup(stages):
    before, after = (texts(x) for x in stages[0][2:4])
    sets = {i: shingled(t) for i, t in before.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if similarity(sets[i], sets[j]) >= 0.8:
                a, b = sorted([find(i), find(j)])
                root[b] = a
    assert set(after) == {find(i) for i in ids} and len(after) < len(before)


def test_decontamination(stages, spark, folder):
    before, after = (texts(x) for x in stages[0][3:5])
    items = [decontam.fold(r["text"].encode().split()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    grams = [decontam.shingles(x) for x in items]
    bad = set()
    for i, t in before.items():
        own = decontam.shingles(decontam.fold(t.encode().split()))
        if any(len(g & own) >= 0.8 * len(g) for g in grams):
            bad.add(i)
    assert set(after) == set(before) - bad and bad


def test_source_mix(stages):
    before, after = stages[0][4:6]
    size = {r["doc_id"]: len(r["text"].encode().split()) for r in before}
    per_source = Counter()
    for r in before:
        per_source[r["source"]] += size[r["doc_id"]]
    want = reshared(per_source, [3, 1, 2], 1.5, 2)
    taken = Counter()
    for r in after:
        assert 0 < r["taken"] <= 2 * r["size"] and r["size"] == size[r["doc_id"]]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in want)


def test_run_equals_its_stages(stages, spark, folder):
    assert Counter(map(str, corpus_pipeline.run(spark, folder).collect())) == Counter(map(str, stages[0][-1]))


def test_empty_and_odd_documents(spark, folder, docs_of, odd_rows):
    for docs in (docs_of([]), docs_of(odd_rows)):
        count = docs.count()
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, folder), "odd")
        assert docs.count() <= count
