"""Web archives: writing, normalising of whole-file gzip, and reading through a sidecar index.

A crawl is often handed over as one gzip stream per file, in which no record can be reached without inflating all
before it.  The normaliser inflates such a file once, in small pieces, writes every record as a gzip member of its
own and puts beside the file an index of offset and length, one line per record.

Files go to the shared folder under a name of the attempt and are then renamed, so a task that is run again, or
twice, leaves whole files only.  Memory follows the piece, not the record or the file.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as files
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace

PIECE = 1 << 18
LEVEL = 5
#: A file is closed once it holds this many bytes before compression.
FILE_BYTES = 64 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(uri: str) -> tuple[files.FileSystem, str]:
    return files.FileSystem.from_uri(uri)


class _Target:
    """A file that appears under its name when it is whole."""

    def __init__(self, uri: str):
        self.fs, self.path = _open(uri)
        self.draft = f"{self.path}.{uuid.uuid4().hex}.draft"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.draft, compression=None)

    def write(self, data: bytes) -> None:
        self.out.write(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.draft, self.path)


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _record_id(page: int | None, url: str, digest: str) -> str:
    return f"urn:x-page:{page}" if page is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {digest}')}"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record; a revisit has the HTTP header only."""
    place = quote(url or "", safe=":/?#[]@!$&'()*+,;=%~")
    block = HTTP if refers_to is not None else HTTP + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_record_id(page, place, digest)}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {place}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _writer(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, target, size = TaskContext.get().partitionId(), [], None, 0
        for batch in batches:
            for page, url, html, sha, refers in zip(*(c for c in batch.columns)):
                if target is None:
                    name = f"{folder}/part-{part:06d}-{len(made):05d}.warc.gz"
                    target, size, records = _Target(name), 0, 0
                    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = record(
                    page.as_py(), url.as_py(), html.as_buffer().to_pybytes() if html.is_valid else b"",
                    base32_sha1(sha.as_py()), refers.as_py(), date,
                )
                target.write(pack.compress(data))
                size, records = size + len(data), records + 1
                if size >= FILE_BYTES:
                    target.write(pack.flush())
                    target.close()
                    made.append((name, records))
                    target = None
        if target is not None:
            target.write(pack.flush())
            target.close()
            made.append((name, records))
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], ["file", "records"]
        )

    return run


class Inflated:
    """The bytes of a gzip file, of one member or many, in the order they come."""

    def __init__(self, stream):
        self.stream, self.inflate, self.buffer = stream, zlib.decompressobj(31), b""

    def _more(self) -> bool:
        while True:
            data = self.inflate.unconsumed_tail
            if self.inflate.eof:
                data = self.inflate.unused_data or self.stream.read(PIECE)
                if not data:
                    return False
                self.inflate = zlib.decompressobj(31)
            elif not data:
                data = self.stream.read(PIECE)
                if not data:
                    return False
            got = self.inflate.decompress(data, PIECE)
            if got:
                self.buffer += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with ``mark``; None at the end of the file."""
        seen = 0
        while (at := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if not self._more():
                return None
        at += len(mark)
        out, self.buffer = self.buffer[:at], self.buffer[at:]
        return out

    def pieces(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes."""
        while size:
            if not self.buffer and not self._more():
                raise ValueError("the file ends within a record")
            out, self.buffer = self.buffer[:size], self.buffer[size:]
            size -= len(out)
            yield out


def headers(head: bytes) -> dict[str, str]:
    """Field names in lower case with their values."""
    lines = head.decode("utf-8", "replace").strip("\r\n").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def normalise_file(source: str, target: str) -> int:
    """Rewrite one archive record by record; the index gets ``offset length type id`` lines."""
    fs, path = _open(source)
    out, index, count, offset = _Target(target), _Target(f"{target}.idx"), 0, 0
    with fs.open_input_stream(path, compression=None) as stream:
        data = Inflated(stream)
        while (head := data.until(b"\r\n\r\n")) is not None:
            fields = headers(head)
            pack, size = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
            size += _put(out, pack.compress(head))
            for piece in data.pieces(int(fields["content-length"]) + 4):
                size += _put(out, pack.compress(piece))
            size += _put(out, pack.flush())
            index.write(f"{offset} {size} {fields['warc-type']} {fields['warc-record-id']}\n".encode())
            offset, count = offset + size, count + 1
    out.close()
    index.close()
    return count


def _put(target: _Target, data: bytes) -> int:
    if data:
        target.write(data)
    return len(data)


def _normaliser(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column(0).to_pylist():
                target = f"{folder}/{source.rpartition('/')[2]}"
                yield pa.RecordBatch.from_arrays(
                    [pa.array([target]), pa.array([normalise_file(source, target)], pa.int64())], ["file", "records"]
                )

    return run


def _page(identity: str | None) -> int | None:
    kind, _, number = (identity or "").strip("<>").rpartition(":")
    return int(number) if kind == "urn:x-page" else None


def read_member(stream, offset: int, length: int) -> tuple[dict[str, str], int, str]:
    """Header fields, payload length and payload SHA-1 of the record at an offset."""
    stream.seek(offset)
    data = Inflated(_Part(stream, length))
    fields = headers(data.until(b"\r\n\r\n"))
    rest = int(fields["content-length"])
    http = data.until(b"\r\n\r\n")
    seen, size = hashlib.sha1(), 0
    for piece in data.pieces(rest - len(http)):
        seen.update(piece)
        size += len(piece)
    return fields, size, base64.b32encode(seen.digest()).decode()


class _Part:
    """The next ``left`` bytes of a stream."""

    def __init__(self, stream, left: int):
        self.stream, self.left = stream, left

    def read(self, size: int) -> bytes:
        data = self.stream.read(min(size, self.left))
        self.left -= len(data)
        return data


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "record_type", "payload_digest", "payload_bytes", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            fs, path = _open(uri)
            rows = []
            with fs.open_input_file(path) as data, fs.open_input_stream(f"{path}.idx", compression=None) as index:
                for line in _lines(index):
                    offset, length = map(int, line.split(" ", 2)[:2])
                    fields, size, digest = read_member(data, offset, length)
                    named = fields["warc-payload-digest"].removeprefix("sha1:")
                    response = fields["warc-type"] == "response"
                    if response and named != digest:
                        raise ValueError(f"{uri} at {offset}: the payload does not match its digest")
                    rows.append((
                        _page(fields["warc-record-id"]), fields["warc-type"], named, size if response else None,
                        _page(fields.get("warc-refers-to")),
                    ))
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _lines(stream) -> Iterator[str]:
    rest = b""
    while data := stream.read(PIECE):
        *whole, rest = (rest + data).split(b"\n")
        yield from (x.decode() for x in whole)


def with_revisits(pages: DataFrame, space: Workspace, *, least: int = 0) -> DataFrame:
    """page_id, url, html (null for revisits), sha1, refers_to: of equal payloads the largest page_id is kept whole.

    Payloads under ``least`` bytes, and rows without a page_id, stay whole; so do rows that repeat the page_id and
    payload of a kept one.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    slim = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))
    slim = slim.withColumn("sha1", F.sha1("html"))
    lead = slim.where(F.length("html") >= least).groupBy("sha1").agg(F.max("page_id").alias("lead"))
    lead = space.store(lead, "leads")  # so that a frequent payload can be split in the join
    refers = F.when(F.col("page_id") != F.col("lead"), F.col("lead"))
    return slim.join(lead, "sha1", "left").select(
        "page_id", "url", F.when(refers.isNull(), F.col("html")).alias("html"), "sha1", refers.alias("refers_to")
    )


def write_archives(records: DataFrame, folder: str, *, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One-stream archives under ``folder`` of the columns of ``with_revisits``; file and records of each."""
    return records.mapInArrow(_writer(folder, date), "file string, records long")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Every file of ``archives`` (column file) record by record under ``folder``, with its index; a task a file."""
    return _dealt(archives).mapInArrow(_normaliser(folder), "file string, records long")


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of normalised files by their index: page_id, record_type, payload_digest, payload_bytes, refers_to.

    Length and digest are those of the full payload; a revisit takes its length from the response it refers to.
    """
    kind = "page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long"
    return _dealt(archives).mapInArrow(_reader, kind)


def _dealt(archives: DataFrame) -> DataFrame:
    """The files over as many tasks; a number of its own keeps adaptive execution from putting them in one."""
    return archives.select("file").repartition(max(1, archives.count()), "file")


def round_trip(pages: DataFrame, *, least: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, normalise them and read them back; a row per page.

    A null html is an empty payload, a null url an empty one, a null page_id gets a record of its own.  Other columns
    are not looked at; an empty table gives no files and no rows.
    """
    space = Workspace(pages.sparkSession, "warc")
    whole = space.store(write_archives(with_revisits(pages, space, least=least), space.folder("whole")), "written")
    single = space.store(normalise(whole, space.folder("records")), "normalised")
    space.drop("whole", "written")
    found = space.store(read_archives(single), "found")
    space.drop("records", "normalised")
    full = found.where("record_type = 'response' and page_id is not null")
    full = full.groupBy("page_id", "payload_digest").agg(F.max("payload_bytes").alias("full_bytes"))
    full = full.select(F.col("page_id").alias("refers_to"), "payload_digest", "full_bytes")
    revisits = found.where("record_type = 'revisit'").join(full, ["refers_to", "payload_digest"])
    columns = ["page_id", "payload_digest", "record_type", "refers_to"]
    return found.where("record_type = 'response'").select("payload_bytes", *columns).union(
        revisits.select(F.col("full_bytes").alias("payload_bytes"), *columns)
    )
