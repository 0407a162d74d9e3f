"""Batched merges against the tokenizers library, text by text, and digests of the registered query."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

from martwright.llm import bpe
from martwright.llm.queries import WORD_VOCABULARY, op12_bpe_round_trip


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_VOCABULARY)


@pytest.fixture(scope="module")
def source():
    return open(WORD_VOCABULARY, encoding="utf-8").read()


def odd_texts():
    rng = random.Random(5)
    some = [chr(c) for c in [0, 9, 10, 11, 0x1C, 0x1F, 0x20, 0x85, 0xA0, 0xAD, 0x130, 0x3A3, 0x301, 0x300, 0x1680, 0x2003, 0x200B, 0x2028, 0x3000, 0xFEFF, 0x1F600, 0x4E2D, 0xAC00, 0x1100, 0x1161, 0x660, 0xB2, 0x1E9E, 0x10D50]]
    letters = some + list("abcdefgEILNORST'’0123456789.,!?<|>-_ \n")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(1500)]
    marks = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|><|endoftext|>", "it's we'Ll they've I'M 'S''s", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "é́ ΑΣ ΣΑΣ İstanbul"]
    texts += marks + [a + m + b for m in marks for a, b in [("x", "y"), (" ", " "), ("<|", "|>")]]
    return texts + ["", " ", "\n\t"]


def test_encoder_equals_library(library, source):
    encoder = bpe.Encoder(bpe.Vocabulary(source), limit=300)  # forgets all the time
    texts = odd_texts()
    for start in range(0, len(texts), 97):
        part = texts[start : start + 97]
        ids, counts = encoder.encode(part)
        got = np.split(ids, np.cumsum(counts)[:-1])
        for text, mine, theirs in zip(part, got, library.encode_batch(part, add_special_tokens=False), strict=True):
            assert mine.tolist() == theirs.ids, repr(text)


@pytest.mark.parametrize("alphabet", ["ab", "a", "thesandr", "!?.-=", "qzjxkvbpygfwmucldrhsnioate"])
def test_long_words(library, source, alphabet, monkeypatch):
    rng = random.Random(7)
    vocab = bpe.Vocabulary(source)
    words = ["".join(rng.choice(alphabet) for _ in range(n)) for n in (1, 2, 3, 50, 2_001, 30_000)]
    ids, counts = bpe.Encoder(vocab).encode(words)
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [e.ids for e in library.encode_batch(words, add_special_tokens=False)]
    monkeypatch.setattr(bpe, "LONG", 0)  # short words the other way, too
    again, _ = bpe.Encoder(vocab).encode(words)
    assert again.tolist() == ids.tolist()


def test_a_million_symbols_without_white_space(library, source):
    rng = random.Random(8)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000))
    ids, _ = bpe.Encoder(bpe.Vocabulary(source)).encode([text])
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_merges_out_of_order_are_refused(source):
    broken = source.replace('"merges":[', '"merges":[["a","bc</w>"],', 1)
    if broken == source:
        import json

        told = json.loads(source)
        told["model"]["merges"] = told["model"]["merges"][::-1]
        broken = json.dumps(told)
    with pytest.raises((ValueError, KeyError)):
        bpe.Vocabulary(broken)


def test_encoded_and_decoded_frames(spark, docs_of, odd_rows, library, source):
    docs = docs_of([*odd_rows, *((1000 + i, t) for i, t in enumerate(odd_texts()))])
    codes = bpe.encoded(docs.withColumnRenamed("n_words", "n_tokens"), source)  # a clashing name gives way
    assert "text" not in codes.columns and codes.columns.count("n_tokens") == 1 and "kept" in codes.columns
    texts = bpe.decoded(codes, source)
    want = sorted((str(r["doc_id"]), *_expected(library, r["text"])) for r in docs.collect())
    ids = {(str(r["doc_id"]), hashlib.sha256(r["ids"]).hexdigest()) for r in codes.collect()}
    assert ids == {(w[0], w[2]) for w in want}
    assert sorted((str(r["doc_id"]), r["n_tokens"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in texts.collect()) == sorted((w[0], w[1], w[3]) for w in want)
    assert bpe.decoded(bpe.encoded(docs.limit(0), source), source).count() == 0
    unknown = spark.createDataFrame([(1, np.array([0, 99_999_999, 1], dtype="<u4").tobytes()), (2, None)], "doc_id long, ids binary")
    assert [r["text"] for r in bpe.decoded(unknown, source).orderBy("doc_id").collect()] == ['! "', ""]


def _expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_query_equals_library(spark, folder, library):
    docs = pd.read_parquet(f"{folder}/documents.parquet")
    want = sorted((d, *_expected(library, t)) for d, t in zip(docs.doc_id, docs.text, strict=True))
    got = sorted(tuple(r) for r in op12_bpe_round_trip(spark, folder).collect())
    assert got == want
