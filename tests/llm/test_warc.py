from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import random
import zipfile
from collections import Counter

import pytest

from tallyward.llm import warc


def package(members, limit=warc.FULL32):
    return b"".join(warc.zip_package(members, limit))


@pytest.mark.parametrize("limit", [warc.FULL32, 60, 0])
def test_packages_are_zip_files(limit):
    members = [("a.txt", [b"one", b"two"]), ("dir/é", [b"x" * 100]), ("none", [])]
    data = package(members, limit)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None
        assert {n: z.read(n) for n in z.namelist()} == {n: b"".join(p) for n, p in members}
    reader = warc.ZipReader(io.BytesIO(data), len(data))
    assert {n: reader.read(n) for n in reader.members} == {n: b"".join(p) for n, p in members}


def test_reads_packages_of_others():
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("stored", b"abc" * 50)
        with z.open(zipfile.ZipInfo("wide"), "w", force_zip64=True) as member:
            member.write(b"q" * 10)
        z.writestr(zipfile.ZipInfo("packed"), b"z" * 500, zipfile.ZIP_DEFLATED)
        z.comment = b"PK a comment"
    reader = warc.ZipReader(buffer, len(buffer.getvalue()))
    assert reader.read("stored") == b"abc" * 50 and reader.read("wide") == b"q" * 10
    assert list(reader.pieces("stored", [(0, 3), (3, 6), (140, 10)])) == [b"abc", b"abcabc", b"cabcabcabc"]
    with pytest.raises(ValueError, match="compressed"):
        reader.read("packed")
    with pytest.raises(ValueError, match="ZIP"):
        warc.ZipReader(io.BytesIO(b"nothing"), 7)


def test_damage_is_seen():
    data = warc.record(1, "http://x/é y\r\n", b"payload", hashlib.sha1(b"payload").hexdigest(), None, False)
    found = warc.parse_record(data)
    assert (found["page"], found["url"], found["payload"]) == ("1", "http://x/é y\r\n", b"payload")
    bad = warc.record(1, None, b"payload", hashlib.sha1(b"other").hexdigest(), None, False)
    with pytest.raises(ValueError, match="differ"):
        warc.parse_record(bad)


def brute(rows):
    best = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if page is not None and len(raw) >= 1000:
            best[raw] = max(page, best.get(raw, page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        to = best.get(raw)
        to = None if to == page else to
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "response" if to is None else "revisit", to))
    return Counter(out)


def test_round_trip(spark):
    rng = random.Random(4)
    bodies = [None, "", "short", "x" * 999, "é" * 500, "y" * 1000, "z" * 300_000]
    rows = [(i, f"http://h/{i}\n?é", rng.choice(bodies)) for i in range(120)]
    rows += [(119, "again", rows[-1][2]), (None, None, "y" * 1000), (None, "u", "only" * 400)]
    df = spark.createDataFrame(
        [(*r, 1) for r in rows], "page_id bigint, url string, html string, sha1 int"
    ).repartition(3)
    for store in (warc.WarcStore(), warc.WarcStore(package_bytes=2000)):
        got = Counter(tuple(r) for r in warc.round_trip(df, store).collect())
        assert got == brute(rows)
    assert warc.round_trip(df.limit(0)).count() == 0


# Packages of others: several archives, real CDXJ, indexes that are packed or missing ---------------


def other_record(kind, name, uri, block, *more, http=True):
    lines = [
        "WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Target-URI: <{uri}>",
        *(["Content-Type: application/http; msgtype=response"] if http else ["content-type: text/plain"]),
        *more, f"Content-Length: {len(block)}",
    ]
    return "\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"


def other_package(path, index):
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nhello"
    exact = b"HTTP/1.0 200 OK\r\ncontent-length: 5\r\n\r\nworld"
    sha = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    archives = {
        "one.warc.gz": [
            other_record("warcinfo", "i", "", b"software: x", http=False),
            other_record("response", "a", "http://x.org/a", chunked),
            other_record("response", "b", "http://x.org/b?q", exact, f"WARC-Payload-Digest: sha1:{sha(b'world')}"),
        ],
        "two.warc": [
            other_record("resource", "c", "file:///c", b"\r\n\r\nplain", http=False),
            other_record("revisit", "d", "http://x.org/d", exact[:-5], f"WARC-Payload-Digest: sha1:{sha(b'world')}",
                         "WARC-Refers-To: <urn:uuid:b>"),
        ],
    }
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(zipfile.ZipInfo("datapackage.json"), b"{}", zipfile.ZIP_DEFLATED)
        lines = []
        for name, found in archives.items():
            at, parts = 0, []
            for i, data in enumerate(found):
                data = gzip.compress(data) if name.endswith(".gz") else data
                entry = {"offset": str(at), "length": str(len(data)), "filename": name, "status": "200"}
                lines.append(f"org,x)/{i} 20240101000000 {json.dumps(entry)}")
                parts.append(data)
                at += len(data)
            z.writestr(f"archive/{name}", b"".join(parts))
        text = "\n".join(["!meta line", *sorted(lines)]).encode()
        if index == "gzip":
            z.writestr("indexes/index.cdx.gz", gzip.compress(text))
        elif index == "deflated":
            z.writestr(zipfile.ZipInfo("indexes/index.cdxj"), text, zipfile.ZIP_DEFLATED)
        elif index == "lost":
            z.writestr("indexes/index.cdxj", text.replace(b"two.warc", b"three.warc"))


OTHERS = {
    ("i", "warcinfo", 11, None), ("a", "response", 5, None), ("b", "response", 5, None),
    ("c", "resource", 9, None), ("d", "revisit", 5, "urn:uuid:b"),
}


@pytest.mark.parametrize("index", ["gzip", "deflated", None])
def test_reads_archives_and_indexes_of_others(spark, tmp_path, index):
    for n in range(2):
        other_package(tmp_path / f"{n}.wacz", index)
    store = warc.WarcStore()
    manifest = store.packages(spark, str(tmp_path / "*.wacz"))
    got = store.read(manifest, str(tmp_path), payloads=True).collect()
    shown = Counter((r.page.removeprefix("urn:uuid:"), r.type, r.bytes, r.refers_to) for r in got)
    assert shown == Counter({x: 2 for x in OTHERS})
    assert {r.payload for r in got if r.type == "response"} == {b"hello", b"world"}
    assert {r.sha1 for r in got if r.type == "revisit"} == {hashlib.sha1(b"world").hexdigest()}
    assert {r.url for r in got} == {"", "http://x.org/a", "http://x.org/b?q", "file:///c", "http://x.org/d"}


def test_an_index_that_names_a_missing_archive(tmp_path):
    other_package(tmp_path / "x.wacz", "lost")
    data = (tmp_path / "x.wacz").read_bytes()
    with pytest.raises(ValueError, match="not there: three.warc"):
        list(warc.ZipReader(io.BytesIO(data), len(data)).records())


def test_archives_are_walked_in_pieces(monkeypatch, tmp_path):
    other_package(tmp_path / "x.wacz", None)
    data = (tmp_path / "x.wacz").read_bytes()
    whole = list(warc.ZipReader(io.BytesIO(data), len(data)).records())
    monkeypatch.setattr(warc, "READ_AT_ONCE", 7)
    assert list(warc.ZipReader(io.BytesIO(data), len(data)).records()) == whole and len(whole) == 5
    for stream in (warc.gzip_members, warc.plain_records):
        with pytest.raises(ValueError, match="ends within a record"):
            list(stream(iter([gzip.compress(b"x" * 99)[:20] if stream is warc.gzip_members else whole[3][:-9]])))


def test_index_lines_are_cdxj():
    line = warc.index_line("http://Www.Example.org/p?q=1", "00" * 20, 5, 9).decode()
    key, stamp, entry = line.split(" ", 2)
    assert key == "org,example,www)/p?q=1" and len(stamp) == 14
    assert json.loads(entry)["offset"] == "5" and json.loads(entry)["filename"] == "records.warc.gz"
