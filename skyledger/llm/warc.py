"""WARC archives of web pages: written as one gzip stream, normalised to one member a record.

Pages are written to archives that are a single gzip stream each, as some crawlers leave them.
The normaliser inflates such a stream once, from start to end, writes every record again as a
gzip member of its own, and leaves a sidecar index of offsets, so that any record can be read
without the ones before it. Equal payloads are written once; later ones are revisit records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import materialize, slices
from skyledger.llm.hashing import filesystem
from skyledger.session import fresh_folder

# Bytes of payload after which an archive is closed; one larger record is an archive of its own.
ARCHIVE_BYTES = 32 << 20
# Payloads of at least so many bytes are written once.
LEAST_REVISIT = 0
CHUNK = 1 << 20
# The date of all records, since the pages have none.
DATE = "2024-01-01T00:00:00Z"
IDENTITY = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL name space


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, digest: str) -> str:
    """The same name whenever the record is written."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{digest}')}>"


def _one_line(text: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def warc_record(page_id, url: str | None, payload: bytes, digest: str, first) -> bytes:
    """A response record, or a revisit of the record of page `first` if that is not None."""
    fields = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": record_id(page_id, digest), "WARC-Date": DATE,
        "WARC-Target-URI": _one_line(url or ""), "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Page-ID": "" if page_id is None else str(page_id),
        "X-Payload-Length": str(len(payload))}
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if first is None:
        block += payload
    else:
        fields |= {"WARC-Profile": IDENTITY, "WARC-Refers-To": record_id(first, digest),
                   "X-Refers-To-Page-ID": str(first)}
    fields |= {"Content-Type": "application/http; msgtype=response",
               "Content-Length": str(len(block))}
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


class _Whole:
    """A file that appears under its name when it is complete, and not before."""

    def __init__(self, files: pa.fs.FileSystem, path: str) -> None:
        self._files, self._path = files, path
        folder, _, name = path.rpartition("/")
        files.create_dir(folder, recursive=True)
        self._draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
        self._out = files.open_output_stream(self._draft, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._out.close()
        self._files.move(self._draft, self._path)


def _writer(folder: str) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(folder)
        out, deflate, held, names = None, None, 0, []

        def finish() -> None:
            out.write(deflate.flush())
            out.close()

        for batch in slices(batches, "html"):
            for row in batch.to_pylist():
                payload = (row["html"] or "").encode()
                digest = payload_digest(payload)
                if out is not None and held + len(payload) > ARCHIVE_BYTES:
                    finish()
                    out = None
                if out is None:
                    # a task that runs again makes other names; only those it returns are read
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, held = _Whole(files, f"{root}/{names[-1]}"), 0
                    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                out.write(deflate.compress(warc_record(
                    row["page_id"], row["url"], payload, digest, row["first"])))
                held += len(payload)
        if out is not None:
            finish()
        yield pa.RecordBatch.from_pydict({"archive": pa.array(names, pa.string())})
    return run


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Write a record for each row of `pages` and return the names of the archives.

    Of rows with equal payloads of at least `least` bytes the smallest page_id is the response;
    the others, if their page_id differs, refer to it. Only the pages that refer to another are
    looked up when records are written.
    """
    payload = F.coalesce(pages["html"], F.lit(""))
    rows = pages.select(
        pages["page_id"].cast("bigint").alias("page_id"), pages["url"].alias("url"),
        pages["html"].alias("html"), F.sha1(payload.cast("binary")).alias("sha1"))
    keys = rows.where(F.octet_length(F.coalesce("html", F.lit(""))) >= least).select(
        "page_id", "sha1")
    groups = keys.groupBy("sha1").agg(
        F.min("page_id").alias("first"), F.max("page_id").alias("last"))
    copied = groups.where(F.col("last") > F.col("first")).drop("last")
    known = materialize(
        keys.join(copied, "sha1").where(F.col("page_id") > F.col("first")).distinct(), "revisits")
    placed = rows.join(known, ["page_id", "sha1"], "left").drop("sha1")
    return materialize(placed.mapInArrow(_writer(folder), "archive string"), "archives")


def _inflated(source) -> Iterator[bytes]:
    """The bytes of all gzip members of a file, one after the other, in bounded pieces."""
    inflate = zlib.decompressobj(31)
    while data := source.read(CHUNK):
        while data:
            yield inflate.decompress(data, CHUNK)
            while inflate.unconsumed_tail:
                yield inflate.decompress(inflate.unconsumed_tail, CHUNK)
            data = inflate.unused_data if inflate.eof else b""
            if inflate.eof:
                inflate = zlib.decompressobj(31)
    yield inflate.flush()


def _records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and whole bytes of each record of a WARC stream."""
    held = bytearray()

    def fill(size: int) -> bool:
        while len(held) < size:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while True:
        end = held.find(b"\r\n\r\n")
        while end < 0:
            if not fill(len(held) + 1):
                if held.strip():
                    raise ValueError("the archive ends inside a record's header")
                return
            end = held.find(b"\r\n\r\n")
        fields = {}
        for line in bytes(held[:end]).decode().split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.lower()] = value.strip()
        size = end + 4 + int(fields["content-length"]) + 4
        if not fill(size):
            raise ValueError("the archive ends inside a record")
        yield fields, bytes(held[:size])
        del held[:size]


def _index_line(fields: dict[str, str], offset: int, length: int) -> dict:
    return {"offset": offset, "length": length, "record_id": fields["warc-record-id"],
            "type": fields["warc-type"], "uri": fields.get("warc-target-uri", ""),
            "page_id": fields.get("x-page-id", "")}


def _normaliser(source: str, target: str) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(source)
        outputs, out_root = filesystem(target)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                out, lines = _Whole(outputs, f"{out_root}/{name}"), []
                with files.open_input_stream(f"{root}/{name}", compression=None) as data:
                    for fields, record in _records(_inflated(data)):
                        member = gzip.compress(record, 6, mtime=0)
                        lines.append(_index_line(fields, out.size, len(member)))
                        out.write(member)
                out.close()
                index = _Whole(outputs, f"{out_root}/{name}.idx")
                index.write("".join(json.dumps(line) + "\n" for line in lines).encode())
                index.close()
                yield pa.RecordBatch.from_pydict({
                    "archive": pa.array([name] * len(lines), pa.string()),
                    "offset": pa.array([line["offset"] for line in lines], pa.int64()),
                    "length": pa.array([line["length"] for line in lines], pa.int64())})
    return run


def normalise(archives: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite each archive of `source` record by record into `target`, with its index.

    Returns archive, offset and length of every record. One archive is one piece of work, of
    which a record and its compressed form are in memory at a time. A rewritten archive takes
    its name when it is whole, so a task that runs again replaces it by an equal one.
    """
    count = max(1, archives.count())
    return materialize(archives.repartition(count).mapInArrow(
        _normaliser(source, target), "archive string, offset bigint, length bigint"), "index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of indexed records.

    Each record is read by its offset alone. A response's payload is measured again and has to
    have the digest that its header states; a revisit states those of the payload it repeats.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(folder)
        name, source = None, None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["archive"] != name:
                    if source is not None:
                        source.close()
                    name = row["archive"]
                    source = files.open_input_file(f"{root}/{name}")
                source.seek(row["offset"])
                member = io.BytesIO(source.read(row["length"]))
                (fields, record), = _records(_inflated(member))
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                size = int(fields["x-payload-length"])
                if fields["warc-type"] == "response":
                    block = record[record.index(b"\r\n\r\n") + 4:-4]
                    payload = block[block.index(b"\r\n\r\n") + 4:]
                    if payload_digest(payload) != digest or len(payload) != size:
                        raise ValueError(f"{name} at {row['offset']}: the payload is damaged")
                first, page = fields.get("x-refers-to-page-id"), fields["x-page-id"]
                rows.append((int(page) if page else None, size, digest, fields["warc-type"],
                             int(first) if first else None))
            names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
        if source is not None:
            source.close()

    return index.mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, "
                                 "record_type string, refers_to bigint")


def archive_pages(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Write `pages`, normalise the archives, and read every record back.

    `pages` has page_id, url and html; other columns are not read, whatever their names. One
    row for each input row. A null html is an empty payload, a null url an empty one. Rows of
    the smallest page_id of a payload are all responses, if repeated; a null page_id neither
    refers nor is referred to. An empty table gives an empty result. A very long page is an
    archive of its own.
    """
    spark = pages.sparkSession
    raw, clean = fresh_folder(spark, "warc"), fresh_folder(spark, "warc-members")
    index = normalise(write_archives(pages, raw, least), raw, clean)
    return read_records(index, clean)
