import base64
import gzip
import hashlib
import os
import random
import time
from collections import Counter

import pytest

from martwright.llm import warc
from martwright.session import shared_folder

PAGES = [
    (1, "http://a/1", "<html>one</html>"), (2, "http://a/2", "<html>two\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nx</html>"), (3, None, None),
    (4, "http://a/é x\r\ny", "<html>one</html>"), (5, "http://a/5", ""), (None, "http://a/n", "<html>one</html>"), (None, "u", "only null ids"),
    (6, "http://a/6", "long " * 200_000), (7, "http://a/7", "\x1f\x8b\x08 ünï"), (7, "http://a/7", "\x1f\x8b\x08 ünï"), (-8, "http://a/8", "<html>one</html>"),
]


def want(pages):
    firsts = {}
    for i, _, h in pages:
        if i is not None:
            firsts[h or ""] = min(i, firsts.get(h or "", i))
    out = Counter()
    for i, _, h in pages:
        data = (h or "").encode()
        first = firsts.get(h or "")
        again = first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out[(i, len(data), digest, "revisit" if again else "response", first if again else None)] += 1
    return out


def rows_of(found):
    return Counter(tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in found.collect())


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, payload string").repartition(3)


def test_round_trip(spark, pages):
    path = shared_folder(spark, "warc-test")
    warc.write(warc.with_records(pages), path, records_per_archive=2)
    found = warc.read(spark, path)
    assert found.filter("kind = 'gap'").count() == 0
    assert rows_of(warc.resolved(found)) == want(PAGES)
    kept = {r["page_id"]: bytes(r["payload"]).decode() for r in found.filter("record_type = 'response'").collect()}
    assert all(kept[i] == (h or "") for i, _, h in PAGES if i in kept and i is not None)


def test_small_payloads_are_responses(spark, pages):
    kinds = {(r["page_id"], r["record_type"]) for r in warc.with_records(pages, min_bytes=10**9).collect()}
    assert {k for _, k in kinds} == {"response"}


def one(page, html):
    return warc.record(page, f"http://x/{page}", html, warc.sha1(html), "response", None, "2020-01-01T00:00:00Z")


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_later_records(packed):
    parts = [one(k, b"<html>%d</html>" % k * (k + 1)) for k in range(6)]
    parts = [gzip.compress(p, mtime=0) for p in parts] if packed else parts
    ends = [sum(map(len, parts[: k + 1])) for k in range(6)]
    whole = b"".join(parts)
    pages = lambda data: [warc._page(f["warc-record-id"]) for _, _, k, f, _ in warc.salvage(data) if k == "record"]
    gaps = lambda data: [(o, n) for o, n, k, _, _ in warc.salvage(data) if k == "gap"]
    assert pages(whole) == list(range(6)) and gaps(whole) == []
    # a changed byte inside record 2
    bad = bytearray(whole)
    bad[(ends[1] + ends[2]) // 2 + 20] ^= 0x55
    assert pages(bytes(bad)) == [0, 1, 3, 4, 5]
    assert gaps(bytes(bad)) == [(ends[1], ends[2] - ends[1])]
    # bytes missing, junk between, a cut-off end
    cut = whole[: ends[0] + 40] + whole[ends[1] :]
    assert pages(cut) == [0, 2, 3, 4, 5] and gaps(cut) == [(ends[0], 40)]
    between = b"junk \x1f\x8b\x08 WARC/1.1\r\n more"
    junk = whole[: ends[2]] + between + whole[ends[2] :]
    assert pages(junk) == list(range(6)) and sum(n for _, n in gaps(junk)) == len(between)
    assert pages(whole[:-5]) == list(range(5)) and gaps(whole[:-5]) == [(ends[4], len(whole) - 5 - ends[4])]
    # records and gaps cover the archive
    for data in (whole, bytes(bad), cut, junk, whole[:-5], b"", b"no records at all"):
        spans = sorted({(o, n) for o, n, _, _, _ in warc.salvage(data)})
        assert sum(n for _, n in spans) == len(data)


def test_salvage_inside_members():
    """Several records in one member: a bad one, a flipped byte and a cut-off end cost no other record."""
    parts = [one(k, b"<html>%d</html>" % k * 200) for k in range(5)]
    ends = [sum(map(len, parts[: k + 1])) for k in range(5)]
    bad = bytearray(b"".join(parts))
    bad[ends[1] + len(parts[2]) // 2] ^= 1
    lead, tail = gzip.compress(one(90, b"lead"), mtime=0), gzip.compress(one(91, b"tail"), mtime=0)
    member = gzip.compress(bytes(bad), mtime=0)
    found = list(warc.salvage(lead + member + tail))
    assert [warc._page(f["warc-record-id"]) for _, _, k, f, _ in found if k == "record"] == [90, 0, 1, 3, 4, 91]
    assert [(o, n, f) for o, n, k, f, _ in found if k == "gap inside"] == [(len(lead), len(member), {"offset": ends[1], "length": len(parts[2])})]
    # stored blocks, so that a cut leaves all content before it
    stored = gzip.compress(b"".join(parts), 0, mtime=0)
    cut = stored[: ends[3] + 40]
    found = list(warc.salvage(lead + cut + tail))
    assert [warc._page(f["warc-record-id"]) for _, _, k, f, _ in found if k == "record"] == [90, 0, 1, 2, 3, 91]
    assert [(o, n, f["offset"]) for o, n, k, f, _ in found if k == "gap inside"] == [(len(lead), len(cut), ends[3])]
    spans = {(o, n) for o, n, *_ in found}
    assert sum(n for _, n in spans) == len(lead + cut + tail)
    # a record whose own digest is wrong is not saved by what follows it, nor one that ends where the content ends
    for at in (ends[0] + 60, ends[0] + len(parts[1]) // 2):  # in a field's name, in the payload
        flipped = bytearray(stored)
        flipped[at] ^= 1
        pages = [warc._page(f["warc-record-id"]) for _, _, k, f, _ in warc.salvage(bytes(flipped)) if k == "record"]
        assert pages == [0, 2, 3]


def test_reading_takes_time_in_proportion():
    rng = random.Random(1)

    def seconds(n):
        data = b"".join(gzip.compress(one(k, rng.randbytes(10_000)), 1, mtime=0) for k in range(n))
        start = time.process_time()
        assert sum(k == "record" for _, _, k, _, _ in warc.salvage(data)) == n
        return time.process_time() - start

    few = min(seconds(300) for _ in range(3))
    assert seconds(2_400) < 8 * few * 2 + 0.2


def test_damaged_archive_through_spark(spark, pages, tmp_path):
    parts = [gzip.compress(one(k, b"page %d" % k), mtime=0) for k in range(4)]
    parts[1] = parts[1][:30] + b"\0\0\0" + parts[1][33:]
    os.makedirs(tmp_path / "w")
    (tmp_path / "w" / "part-0").write_bytes(b"".join(parts))
    found = warc.read(spark, f"file://{tmp_path}/w")
    assert sorted(r["page_id"] for r in warc.resolved(found).collect()) == [0, 2, 3]
    gap = found.filter("kind = 'gap'").collect()
    assert [(r["offset"], r["length"]) for r in gap] == [(len(parts[0]), len(parts[1]))]


def test_empty_table(spark, pages):
    path = shared_folder(spark, "warc-empty")
    warc.write(warc.with_records(pages.filter("page_id = 99")), path)
    assert warc.resolved(warc.read(spark, path)).count() == 0
