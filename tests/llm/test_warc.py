import gzip
import hashlib
import random

import pytest

from edgeworks.llm import warc


def pages(spark):
    draw = random.Random(2)
    big = ["".join(draw.choices("abc <p>é\r\n", k=n)) for n in (1000, 1500, 4000)]
    html = [None, "", "x", "WARC/1.1\r\nWARC-Type: response\r\n\r\n", big[0], big[1], big[0], big[0], "small" * 10, "small" * 10, big[2] + "\r\n\r\nWARC/1.1\r\n", big[1] + "é"]
    rows = [(i * 3, f"http://h/{i} \r\n", h, "payload", 7) for i, h in enumerate(html)] + [(None, None, "lost", "p", 1), (99, "u", big[2], "p", 1), (99, "u", big[2], "p", 1)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string, payload string, digest int")


def expected(rows):
    out, last = [], {}
    for page, _, html, *_ in rows:
        raw = (html or "").encode()
        if len(raw) >= warc.REVISIT_BYTES and page is not None:
            last[raw] = max(last.get(raw, page), page)
    for page, _, html, *_ in rows:
        raw = (html or "").encode()
        to = last.get(raw)
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if to not in (None, page) else "response", to if to not in (None, page) else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    rows, docs = pages(spark)
    assert sorted(map(tuple, warc.round_trip(docs).collect()), key=str) == expected(rows)


def test_round_trip_by_shuffle(spark, path):
    rows, docs = pages(spark)
    found = warc.with_revisits(docs, broadcast_groups=0)
    assert {(r.page_id, r.refers_to) for r in found.collect()} == {(r[0], r[4]) for r in expected(rows)}


def test_payloads_come_back_whole(spark, path):
    rows, docs = pages(spark)
    warc.write_archives(docs, path, file_bytes=4000)
    back = warc.read_archives(spark, path).collect()
    assert all(r.gap is None for r in back) and len(back) == len(rows) and len({r.path for r in back}) > 1
    whole = sorted(bytes(r.payload) for r in back if r.record_type == "response")
    refers = {r[0] for r in expected(rows) if r[4] is None}
    assert whole == sorted((h or "").encode() for p, _, h, *_ in rows if p in refers)


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def record(i, body=b"hello", kind="response"):
    digest = hashlib.sha1(body).hexdigest()
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Block-Digest: sha1:{digest}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def ids(data):
    return [x.headers["warc-record-id"] for x in warc.salvage(data) if isinstance(x, warc.Record)]


def gaps(data):
    return [(x.start, x.end) for x in warc.salvage(data) if isinstance(x, warc.Gap)]


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_later_records_survive_a_damaged_one(pack):
    good = [pack(record(i, b"body %d " % i * 50)) for i in range(5)]
    edges = [sum(map(len, good[:i])) for i in range(6)]
    for at in (0, 12, 60, len(good[2]) // 2, len(good[2]) - 3):
        bad = bytearray(good[2])
        bad[at] ^= 0x55
        data = b"".join([*good[:2], bytes(bad), *good[3:]])
        assert [x for x in ids(data) if x != "<urn:page:2>"] == [f"<urn:page:{i}>" for i in (0, 1, 3, 4)]
        assert all(edges[2] <= a < b <= edges[3] for a, b in gaps(data))
    # Cut off in the middle, junk before, between and after, and a record cut short.
    assert ids(b"".join(good)[:edges[4] + 20]) == [f"<urn:page:{i}>" for i in range(4)]
    assert gaps(b"".join(good)[:edges[4] + 20]) == [(edges[4], edges[4] + 20)]
    junk = b"\x00junk WARC/1.1 \x1f\x8b\x08 x"
    data = junk + good[0] + junk + good[1][:-30] + good[2] + junk
    assert ids(data) == ["<urn:page:0>", "<urn:page:2>"] and len(gaps(data)) == 3


def test_a_member_may_hold_many_records():
    good = [record(i, b"body %d " % i * 50) for i in range(5)]
    places = [sum(map(len, good[:i])) for i in range(6)]
    for hurt in (0, 2, 4):
        bad = good.copy()
        bad[hurt] = bad[hurt].replace(b"body", b"bodi", 1)
        member = gzip.compress(b"".join(bad))
        data = gzip.compress(record(8)) + member + record(9)
        at = len(gzip.compress(record(8)))
        assert ids(data) == [f"<urn:page:{i}>" for i in (8, *(i for i in range(5) if i != hurt), 9)]
        assert [(x.start, x.end, x.inside, x.reason) for x in warc.salvage(data) if isinstance(x, warc.Gap)] == [(at, at + len(member), places[hurt], "block digest differs")]
        inner = [x for x in warc.salvage(data) if isinstance(x, warc.Record)][1:-1]
        assert [(x.start, x.end, x.inside) for x in inner] == [(at, at + len(member), places[i]) for i in range(5) if i != hurt]


def test_records_before_the_damage_of_a_member():
    draw = random.Random(5)
    good = [record(i, draw.randbytes(60_000)) for i in range(8)]
    data = bytearray(gzip.compress(b"".join(good)))
    data[300_000] ^= 0x55
    whole = bytes(data) + gzip.compress(record(9))
    found = ids(whole)
    assert found[:4] == [f"<urn:page:{i}>" for i in range(4)] and found[-1] == "<urn:page:9>"
    assert gaps(whole) == [(0, len(data))]


def test_an_archive_compressed_as_a_whole(spark, path):
    rows, docs = pages(spark)
    warc.records(warc.with_revisits(docs)).write.option("lineSep", warc.END).option("compression", "gzip").text(path)
    back = warc.read_archives(spark, path).collect()
    assert len(back) == len(rows) and all(r.gap is None for r in back)
    assert len({(r.path, r.inside) for r in back}) == len(rows)


def test_bytes_are_either_record_or_gap():
    draw = random.Random(4)
    data = bytearray(b"".join((gzip.compress if draw.random() < 0.5 else bytes)(record(i, draw.randbytes(200))) for i in range(30)))
    for _ in range(12):
        data[draw.randrange(len(data))] ^= 1 << draw.randrange(8)
    at = 0
    for x in warc.salvage(bytes(data)):
        assert x.start == at
        at = x.end
    assert at == len(data)


def test_a_version_line_inside_a_payload_is_no_record():
    inner = record(9)
    data = record(0, inner) + record(1)
    assert ids(data) == ["<urn:page:0>", "<urn:page:1>"]


def test_digests_in_base_32_and_header_faults():
    import base64

    body = b"abc"
    name = base64.b32encode(hashlib.sha1(body).digest()).decode()
    text = f"WARC/1.0\r\nWARC-Record-ID: a\r\nWARC-Block-Digest: sha1:{name}\r\nContent-Length: 3\r\n\r\n".encode() + body + b"\r\n\r\n"
    assert ids(text) == ["a"]
    assert "digest" in warc.parse_record(text.replace(b"abc\r", b"abd\r"))
    assert warc.parse_record(text.replace(b"Length: 3", b"Length: x")) == "no length"
    assert warc.parse_record(b"WARC/1.1\r\nA: b") == "header without end"
    assert list(warc.salvage(b"")) == []
