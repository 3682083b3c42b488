import gzip
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from visitlens.llm import queries, warc


@pytest.fixture
def pages(spark):
    return lambda *rows: spark.createDataFrame(
        list(rows), "page_id long, url string, html string"
    )


def record(n, payload):
    return warc.archive_record(n, f"http://x/{n}", payload, sha256(payload).hexdigest(), None)


def found(data):
    records = [(r["page_id"], r["payload"]) for _, _, r in warc.salvage(data) if isinstance(r, dict)]
    gaps = [(s, e, r) for s, e, r in warc.salvage(data) if isinstance(r, str)]
    return records, gaps


@pytest.mark.parametrize("pack", [lambda r: r, gzip.compress])
def test_whole_archive(pack):
    parts = [pack(record(i, b"p%d" % i * 50)) for i in range(5)]
    records, gaps = found(b"".join(parts))
    assert records == [(i, b"p%d" % i * 50) for i in range(5)] and gaps == []


@pytest.mark.parametrize("pack", [lambda r: r, gzip.compress])
@pytest.mark.parametrize("harm", ["flip", "cut", "zero", "insert"])
def test_later_records_are_recovered(pack, harm):
    parts = [pack(record(i, bytes(range(256)) + b"p%d" % i * 50)) for i in range(5)]
    bad = bytearray(parts[2])
    middle = len(bad) // 2
    if harm == "flip":
        bad[middle] ^= 0xFF
    elif harm == "cut":
        del bad[middle:]
    elif harm == "zero":
        bad[:20] = bytes(20)
    else:
        bad[middle:middle] = b"junk"
    data = b"".join([*parts[:2], bytes(bad), *parts[3:]])
    records, gaps = found(data)
    assert [n for n, _ in records] == [0, 1, 3, 4]
    start = len(parts[0]) + len(parts[1])
    assert [(s, e) for s, e, _ in gaps] == [(start, start + len(bad))]


def test_damage_inside_a_member_of_many_records():
    parts = [record(i, sha256(b"%d" % i).digest() * 20) for i in range(6)]
    last = gzip.compress(record(9, b"last"))
    bad = bytearray(parts[2])
    bad[-40] ^= 0xFF
    inside = gzip.compress(b"".join([*parts[:2], bytes(bad), *parts[3:]]))
    records, gaps = found(inside + last)
    assert [n for n, _ in records] == [0, 1, 3, 4, 5, 9]
    assert gaps == [(0, len(inside), "digest")]
    for level in (0, 6):
        whole = gzip.compress(b"".join(parts), level)
        cut = whole[: len(whole) * 2 // 3]
        for data in (cut, cut + last):
            records, gaps = found(data)
            assert [n for n, _ in records][:2] == [0, 1]
            assert len({n for n, _ in records}) == len(records)
            assert gaps[0][:2] == (0, len(cut)) and len(gaps) == 1
        assert records[-1][0] == 9
        wrong = bytearray(whole)
        wrong[-6] ^= 1
        records, gaps = found(bytes(wrong) + last)
        assert [n for n, _ in records] == [0, 1, 2, 3, 4, 5, 9]
        assert [g[:2] for g in gaps] == [(0, len(whole))]


def test_truncated_end_and_junk():
    whole = gzip.compress(record(1, b"x" * 500))
    records, gaps = found(b"junk" + whole + whole[:60])
    assert [n for n, _ in records] == [1]
    assert [g[:2] for g in gaps] == [(0, 4), (4 + len(whole), 64 + len(whole))]
    assert found(b"") == ([], [])


def test_wrong_digest_is_a_gap():
    data = warc.archive_record(1, None, b"abc", "0" * 64, None)
    assert found(data)[1] == [(0, len(data), "digest")]


def test_query_matches_the_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    first = {}
    for r in sorted(rows):
        first.setdefault(r.html or "", r.page_id)
    got = {r.page_id: r for r in queries.op6_warc(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    for r in rows:
        payload = (r.html or "").encode()
        again = first[r.html or ""] != r.page_id and len(payload) >= 100
        assert tuple(got[r.page_id]) == (
            r.page_id, len(payload), sha256(payload).hexdigest(),
            "revisit" if again else "response", first[r.html or ""] if again else None,
        )


def test_cases(pages):
    big = "é" * 60
    rows = pages((3, "u", big), (1, None, big), (2, "u\r\nInjected: x", big), (4, "u", "small"),
                 (5, "u", "small"), (6, "u", None), (None, "u", ""), (7, "u", "\r\n\r\nWARC/1.1\r\n"))
    read = warc.round_trip(rows.withColumn("digest", F.lit(0)))
    got = {r.page_id: r for r in warc.records(read).collect()}
    assert len(got) == 8 and warc.quarantined(read).count() == 0
    assert [got[i].refers_to for i in (1, 2, 3)] == [None, 1, 1]
    assert got[3].payload_bytes == 120 and got[3].payload is None
    assert bytes(got[7].payload) == b"\r\n\r\nWARC/1.1\r\n"
    assert got[4].record_type == got[5].record_type == "response"
    assert got[None].payload_bytes == got[6].payload_bytes == 0


def test_empty_table(pages):
    assert warc.records(warc.round_trip(pages())).count() == 0


def test_files_are_plain_gzip(spark, pages, scratch):
    warc.write_archives(pages((1, "u", "x" * 200), (2, "u", "y")), f"{scratch}/warc")
    files = spark.read.format("binaryFile").load(f"{scratch}/warc").collect()
    text = b"".join(gzip.decompress(bytes(f.content)) for f in files)
    assert text.count(b"WARC/1.1\r\n") == 2
