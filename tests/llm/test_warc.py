import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from hypothesis import given
from hypothesis import strategies as st

from outbreaklens.llm import warc

SCHEMA = "page_id long, url string, html string, payload_bytes string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def plain(rows, least=0):
    first = {}
    for page, _, html, _ in rows:
        if page is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(first.get(html or "", page), page)
    found = []
    for page, _, html, _ in rows:
        own = first.get(html or "", page)
        later = page is not None and own is not None and page > own
        found.append((page, len((html or "").encode()), digest(html), "revisit" if later else "response", own if later else None))
    return sorted(found, key=str)


ROWS = [
    (1, "http://a/", "<p>x</p>", "c"),
    (5, "http://b/", "<p>x</p>", "c"),
    (3, None, "<p>x</p>", "c"),
    (3, "http://b/ c\r\nX: y", "<p>x</p>", "c"),
    (9, "u", None, "c"),
    (2, "u", "", "c"),
    (None, "u", "<p>x</p>", "c"),
    (4, "u", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nb", "c"),
    (6, "u", "WARC/1.1\r\nWARC/1.1\r\n", "c"),
    (7, "u", "\r\n\r\n" * 5, "c"),
    (8, "u", "é😀" * 700_000, "c"),
    (10, "u", "long " * 30_000 + "\r\n\r\nWARC/1.1", "c"),
    (11, "u", "\r\n\r\nW" * 60_000, "c"),
]


@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(spark, least):
    found = warc.archived_pages(spark.createDataFrame(ROWS, SCHEMA), least=least).collect()
    assert sorted(map(tuple, found), key=str) == plain(ROWS, least)


def test_small_chunks_and_files(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    folder = f"file://{tmp_path}/w"
    warc.write(warc.marked(df), folder, chunk=1000)
    assert sorted(map(tuple, warc.read(spark, folder).collect()), key=str) == plain(ROWS)
    chunks = warc.read_chunks(spark, folder).collect()
    assert max(len(r["data"]) for r in chunks) <= 1000
    # Every file is a plain sequence of WARC records.
    kinds = []
    for path in Path(tmp_path, "w").glob("*.gz"):
        data = gzip.open(path).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            headers = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            size = int(headers[b"Content-Length"])
            assert rest[size : size + 4] == b"\r\n\r\n"
            data = rest[size + 4 :]
            kinds.append(headers[b"WARC-Type"])
    assert len(kinds) == len(chunks) and {b"response", b"continuation", b"revisit"} == set(kinds)


def test_running_digests(spark):
    rows = warc.chunk_table(warc.marked(spark.createDataFrame(ROWS, SCHEMA)), chunk=70_000).collect()
    parts = {}
    for r in sorted(rows, key=lambda r: (r["record"], r["chunk_no"])):
        if r["record_type"] != "revisit":
            parts[r["record"]] = parts.get(r["record"], b"") + bytes(r["data"])
            assert r["total_bytes"] == len(parts[r["record"]])
            assert r["total_sha1"] == base64.b32encode(hashlib.sha1(parts[r["record"]]).digest()).decode()


@given(st.lists(st.sampled_from([warc.VERSION, warc.FORMAT, warc.RECORD_END, b"W", b"\r\n", b"abc"]), max_size=30), st.integers(1, 40))
def test_no_chunk_holds_the_format_name(parts, size):
    payload = b"".join(parts)
    ends = warc.cuts(payload, size)
    chunks = [payload[a:b] for a, b in zip([0, *ends], ends)]
    assert b"".join(chunks) == payload and all(warc.FORMAT not in c and len(c) <= size for c in chunks)
    assert all(chunks) or payload == b""


def test_merged_pieces_and_damage():
    one = b"WARC-Type: response\r\nWARC-Record-ID: <a:b:1>\r\nContent-Length: 3\r\n\r\nabc"
    assert [b for _, b in warc.parse(one + warc.RECORD_START + one + warc.RECORD_END)] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(warc.parse(one[:-1]))
    good = [("r", 1, "response", None, 1, True, 3, digest("abc"), b"abc")]
    assert list(warc.assemble(iter(good))) == [(1, 3, digest("abc"), "response", None)]
    for bad in ([good[0][:4] + (2,) + good[0][5:]], [good[0][:5] + (False,) + good[0][6:]], [good[0][:8] + (b"abd",)]):
        with pytest.raises(ValueError):
            list(warc.assemble(iter(bad)))


def test_empty_table(spark):
    assert warc.archived_pages(spark.createDataFrame([], SCHEMA)).collect() == []
