from __future__ import annotations

import gzip
import hashlib
import io

import pytest
from corpus import SMALL, table

from tillstone.llm import queries, warc

PAGES = "page_id long, url string, html string"


def round_trip(spark, rows, **settings):
    folder = warc.new_folder(spark)
    archives = warc.write(spark.createDataFrame(rows, PAGES), folder, **settings)
    return archives, folder, sorted(warc.read(archives, folder, with_payload=True).collect(), key=str)


def test_round_trip(spark):
    long = "é<p>" * 400_000
    rows = [(1, "http://a/", "x" * 200), (3, "http://b/\r\nx: y", "x" * 200), (2, None, "short"), (5, "u", None), (4, "v", "short")]
    rows += [(6, "w", long), (7, "w", long), (None, "n", "x" * 200), (8, "q", "\r\n\r\nWARC/1.1\r\n" * 9)]
    _, _, got = round_trip(spark, rows)
    assert len(got) == len(rows)
    texts = {(i, u): h or "" for i, u, h in rows}
    first = {1: None, 3: 1, 2: None, 5: None, 4: None, 6: None, 7: 6, None: 1, 8: None}
    for r in got:
        text = texts[(r.page_id, "http://b/\r\nx: y" if r.page_id == 3 else r.url)].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(text), hashlib.sha256(text).hexdigest())
        assert r.refers_to == first[r.page_id]
        assert (r.record_type, r.payload) == (("response", text) if r.refers_to is None else ("revisit", b""))


def test_repeated_smallest_rows_are_responses_and_empty_tables(spark):
    _, _, got = round_trip(spark, [(1, "u", "y" * 100), (1, "u", "y" * 100), (2, "u", "y" * 100)])
    assert [(r.page_id, r.record_type) for r in got] == [(1, "response"), (1, "response"), (2, "revisit")]
    archives, _, got = round_trip(spark, [])
    assert (archives.count(), got) == (0, [])


def test_archives_are_split_and_plain_gzip(spark):
    archives, folder, got = round_trip(spark, [(i, "u", f"page {i} " * 500) for i in range(40)], archive_bytes=2_000)
    paths = [r.path for r in archives.collect()]
    assert len(got) == 40 and len(paths) > 5
    store, _ = warc.open_folder(folder)
    with store.open_input_stream(paths[0], compression=None) as raw:
        assert gzip.decompress(raw.read()).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")


def member(block: bytes = b"body", length: int | None = None, digest: str | None = None) -> bytes:
    digest = digest or hashlib.sha256(block).hexdigest()
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Block-Digest: sha256:{digest}\r\n"
    return gzip.compress((head + f"Content-Length: {len(block) if length is None else length}\r\n\r\n").encode() + block + b"\r\n\r\n")


def test_reader_takes_any_cut_of_members():
    data = b"".join(member(bytes([65 + i % 26]) * (i * 997)) for i in range(40))

    class Dribble(io.BytesIO):
        def read(self, size=-1):
            return super().read(min(size, 7))

    assert [len(p) for _, p in warc.read_records(Dribble(data))] == [i * 997 for i in range(40)]
    assert list(warc.read_records(io.BytesIO(b""))) == []


@pytest.mark.parametrize(
    "data",
    [member()[:-9], member(length=9), member(length=2), member(digest="0" * 64), member() + member()[:20], gzip.compress(b"HTTP/1.1\r\n")],
)
def test_reader_refuses_what_is_broken(data):
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(data)))


def test_query(spark):
    pages = table(SMALL, "pages")
    first: dict[str, int] = {}
    for page in sorted(pages, key=lambda p: p["page_id"]):
        first.setdefault(page["html"], page["page_id"])
    want = []
    for page in pages:
        raw = (page["html"] or "").encode()
        seen = first[page["html"]]
        again = len(raw) >= 100 and seen != page["page_id"]
        digest = hashlib.sha256(raw).hexdigest()
        want.append((page["page_id"], len(raw), digest, "revisit" if again else "response", seen if again else None))
    assert sorted(tuple(r) for r in queries.op6_warc(spark, SMALL).collect()) == sorted(want)
