"""WARC writing, reading back and salvage of damaged archives."""

import gzip
import hashlib

from citymotion.llm import warc as W

LONG = "<p>é😀\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n" + "x" * 200
PAGES = [
    (5, "http://a", LONG), (3, "http://b\r\nEvil: 1", LONG), (3, "http://b2", LONG), (9, None, LONG), (None, "u", LONG),
    (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (7, "u", "a" * 100), (8, "u", "a" * 100), (10, "u", "a" * 99), (11, "u", "a" * 99),
]


def expected(pages):
    first = {}
    for i, _, t in pages:
        if i is not None and len((t or "").encode()) >= 100:
            first[t] = min(i, first.get(t, i))
    out = []
    for i, _, t in pages:
        b = (t or "").encode()
        f = first.get(t)
        again = f is not None and i != f
        out.append((str(i), len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def test_write_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string")
    path = f"file://{tmp_path}/w"
    W.write_warc(df, path, archive_bytes=3000)
    read = W.read_warc(spark, path)
    assert read.filter("quarantined IS NOT NULL").count() == 0
    got = [(str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in W.page_records(read).collect()]
    assert sorted(got, key=str) == expected(PAGES)
    W.write_warc(df.limit(0), path + "0")
    assert W.page_records(W.read_warc(spark, path + "0")).count() == 0


def rec(i, body, digest=True):
    d = f"WARC-Payload-Digest: sha256:{hashlib.sha256(body).hexdigest()}\r\n" if digest else ""
    return f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{i}>\r\n{d}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def ids(data):
    return [(h["warc-record-id"] if h else (o, n, why)) for o, n, h, _, why in W.salvage(data)]


def test_salvage_plain():
    a, b, c = (rec(i, bytes([64 + i]) * 50) for i in (1, 2, 3))
    assert ids(a + b + c) == [f"<urn:page:{i}>" for i in (1, 2, 3)]
    hurt = b.replace(b"Content-Length: 50", b"Content-Length: 51")
    assert ids(a + hurt + c) == ["<urn:page:1>", (len(a), len(b), "record does not end after its content length"), "<urn:page:3>"]
    flipped = b.replace(b"BBB", b"BXB", 1)
    assert ids(a + flipped + c)[1] == (len(a), len(b), "payload digest differs")
    assert ids(b"junk" + a + b[:-20]) == [(0, 4, "no version line"), "<urn:page:1>", (4 + len(a), len(b) - 20, "record does not end after its content length")]
    assert ids(a + b"\0" * 10 + c) == ["<urn:page:1>", (len(a), 10, "no version line"), "<urn:page:3>"]
    assert ids(b"") == [] and ids(b"x") == [(0, 1, "no version line")]


def test_salvage_gzip_members():
    m = [gzip.compress(rec(i, bytes(range(256)) * 4)) for i in (1, 2, 3, 4)]
    assert ids(b"".join(m)) == [f"<urn:page:{i}>" for i in (1, 2, 3, 4)]
    hurt = bytearray(m[1])
    hurt[len(hurt) // 2] ^= 0xFF
    found = ids(m[0] + bytes(hurt) + m[2] + rec(9, b"plain") + m[3][:-3])
    assert found[0] == "<urn:page:1>" and found[1][:2] == (len(m[0]), len(m[1])) and found[2:4] == ["<urn:page:3>", "<urn:page:9>"]
    assert found[4][2] == "gzip member has no end" and found[4][1] == len(m[3]) - 3


def test_salvage_inside_gzip_members():
    body = [hashlib.sha256(bytes([i, k])).digest() for i in range(6) for k in range(40)]
    r = [rec(i, b"".join(body[40 * i : 40 * i + 40])) for i in range(6)]
    names = [f"<urn:page:{i}>" for i in range(6)]
    hurt = r[2].replace(b"Content-Length: 1280", b"Content-Length: 1281")
    one = gzip.compress(b"".join(r[:2] + [hurt] + r[3:]), mtime=0)
    found = ids(one + gzip.compress(r[0], mtime=0))
    start, end = sum(map(len, r[:2])), sum(map(len, r[:3]))
    why = f"record does not end after its content length (inflated bytes {start} to {end} of a gzip member)"
    assert found == names[:2] + [(0, len(one), why)] + names[3:] + names[:1]
    for level in (0, 9):
        whole = gzip.compress(b"".join(r), level, mtime=0)
        bad_sum = whole[:-8] + bytes([whole[-8] ^ 1]) + whole[-7:]
        assert ids(bad_sum + gzip.compress(r[0], mtime=0)) == [(0, len(whole), "gzip member is damaged"), *names, names[0]]
        cut = len(whole) * 3 // 4
        assert ids(whole[:cut]) == [(0, cut, "gzip member has no end"), *names[:4]]


def test_headers_may_be_long():
    url = "http://a/" + "x" * 200_000 + "WARC/1.1"
    long = rec(2, b"two").replace(b"WARC-Type", f"WARC-Target-URI: {url}\r\nWARC-Type".encode())
    assert ids(rec(1, b"one") + long + rec(3, b"three")) == [f"<urn:page:{i}>" for i in (1, 2, 3)]
    open_end = b"WARC/1.0\r\nWARC-Type: resource\r\n"
    assert ids(open_end + rec(1, b"one")) == [(0, len(open_end), "header has no end"), "<urn:page:1>"]


def test_gaps_are_logged(spark, tmp_path):
    good, bad = rec(1, b"one"), rec(2, b"two").replace(b"two\r\n\r\n", b"tw")
    (tmp_path / "x.warc").write_bytes(good + bad + rec(3, b"three"))
    rows = W.read_warc(spark, f"file://{tmp_path}").orderBy("offset").collect()
    assert [r["quarantined"] is None for r in rows] == [True, False, True]
    assert rows[1]["offset"] == len(good) and rows[1]["length"] == len(bad) and bytes(rows[2]["payload"]) == b"three"


def test_a_member_beyond_the_limit_keeps_the_records_before_it(monkeypatch):
    import gzip

    monkeypatch.setattr(W, "INFLATED_MOST", 5000)
    block = b"x" * 700
    one = b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: 700\r\n\r\n" + block + b"\r\n\r\n"
    records = [one % i for i in range(20)]
    data = gzip.compress(b"".join(records)) + gzip.compress(records[7])
    rows = list(W.salvage(data))
    ids = [h["warc-record-id"] for _, _, h, _, _ in rows if h]
    whole = 5000 // len(records[0])
    assert ids[:-1] == [f"<urn:page:{i}>" for i in range(whole)] and ids[-1] == "<urn:page:7>"
    assert [reason for *_, reason in rows if reason] == ["gzip member holds over 5000 bytes"]
