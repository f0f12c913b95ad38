"""Archives: round trips, revisits, offsets, and streams of other writers."""

import base64
import gzip
import hashlib
import io
import json
from pathlib import Path

import pytest
from cases import LONG
from skyledger.llm import queries, warc
from skyledger.session import fresh_folder


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, least=0):
    first = {}
    for page, _, html in rows:
        key = html or ""
        if page is not None:
            first[key] = min(first.get(key, page), page)
    out = []
    for page, _, html in rows:
        key = html or ""
        again = page is not None and page != first[key] and len(key.encode()) >= least
        out.append((page, len(key.encode()), digest(html), "revisit" if again else "response",
                    first[key] if again else None))
    return sorted(map(str, out))


ROWS = [(5, "http://a/\r\nX: y", "<p>same</p>"), (3, None, "<p>same</p>"), (9, "u", "<p>same</p>"),
        (9, "u", "<p>same</p>"), (None, "n", None), (8, "ü", ""), (7, "z", None),
        (6, "long", LONG), (4, "long", LONG), (2, "crlf", "a\r\n\r\nWARC/1.1\r\n\r\nb"),
        (1, "zeichen", "é\u0000ü\U0001f389")]


def pages_of(spark, rows):
    return spark.createDataFrame(
        [(*row, "x", 1, "y") for row in rows],
        "page_id bigint, url string, html string, digest string, offset int, first string")


@pytest.mark.parametrize("least", [0, 12])
def test_reads_back_what_it_wrote(spark, least):
    found = warc.archive_pages(pages_of(spark, ROWS), least).collect()
    assert sorted(str(tuple(r)) for r in found) == expected(ROWS, least)


def test_empty_table(spark):
    assert warc.archive_pages(pages_of(spark, ROWS).limit(0)).count() == 0


def test_archives_are_one_stream_and_then_a_member_for_each_record(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4000)
    raw, clean = fresh_folder(spark, "warc-test"), fresh_folder(spark, "warc-test-members")
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * 50) for i in range(40)]
    archives = warc.write_archives(pages_of(spark, rows).coalesce(1), raw)
    index = warc.normalise(archives, raw, clean).collect()
    assert archives.count() > 1 and len(index) == 40
    folder = Path(clean.removeprefix("file:"))
    for name in {r.archive for r in index}:
        whole = (Path(raw.removeprefix("file:")) / name).read_bytes()
        stream = io.BytesIO(whole)
        one = warc.zlib.decompressobj(31)
        one.decompress(stream.read())
        assert one.eof and not one.unused_data
        data = (folder / name).read_bytes()
        assert gzip.decompress(data) == gzip.decompress(whole)
        lines = [json.loads(x) for x in (folder / f"{name}.idx").read_text().splitlines()]
        assert [(x["offset"], x["length"]) for x in lines] == sorted(
            (r.offset, r.length) for r in index if r.archive == name)
        for line in lines:
            member = data[line["offset"]:line["offset"] + line["length"]]
            record = gzip.decompress(member)
            assert record.startswith(b"WARC/1.1\r\n") and line["record_id"].encode() in record
    assert not [p for p in folder.iterdir() if p.name.startswith(".") and "crc" not in p.name]


def test_inflates_several_members_in_small_pieces(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    records = [warc.warc_record(i, "u", b"x" * i, warc.payload_digest(b"x" * i), None)
               for i in range(30)]
    data = b"".join(gzip.compress(b"".join(records[i:i + 3])) for i in range(0, 30, 3))
    found = list(warc._records(warc._inflated(io.BytesIO(data))))
    assert [record for _, record in found] == records
    with pytest.raises(ValueError, match="ends inside a record"):
        list(warc._records(iter([records[5][:-9]])))


def test_a_damaged_payload_is_noticed(spark):
    raw = fresh_folder(spark, "warc-damaged")
    record = warc.warc_record(1, "u", b"good", warc.payload_digest(b"good"), None)
    member = gzip.compress(record.replace(b"good", b"evil"))
    folder = Path(raw.removeprefix("file:"))
    folder.mkdir(parents=True)
    (folder / "a.warc.gz").write_bytes(member)
    index = spark.createDataFrame(
        [("a.warc.gz", 0, len(member))], "archive string, offset bigint, length bigint")
    with pytest.raises(Exception, match="the payload is damaged"):
        warc.read_records(index, raw).collect()


def test_query_covers_every_page(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = queries.op4_warc(spark, sf_dir).collect()
    assert sorted(str(tuple(r)) for r in found) == expected(
        [(p.page_id, p.url, p.html) for p in pages])
