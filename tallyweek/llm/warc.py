"""WARC archives: written, normalised to one gzip member per record, indexed and read back.

1. Payload digests are counted; of equal payloads the smallest page id is named. The
   join that tells every page whether it is the response or revisits it has
   grouped keys on one side, and adaptive execution splits a hot digest.
2. Each task streams its pages into monolithic archives: one gzip stream over many
   records, a new file after FILE_BYTES.
3. The normaliser inflates such a file once, as a stream, writes every record
   again as a gzip member of its own, and beside the file an offset index (one line
   a record: offset, length, type, id).
4. Reading goes through the index: seek, inflate one member, parse.

Files lie in the shared folder (or a given one), opened through pyarrow's file
systems by their URI. Names hold a random part, so an attempt that is repeated after a lost
executor never meets files of the first; only files named in a task's result are used.

Cases: null html is an empty payload, which counts as equal to other empty ones
(`least_bytes` 0); smaller payloads than `least_bytes` are responses; repeated page ids that are the smallest of
their payload are all responses; null page ids come last and are written as no id; a null
url is written as none; empty tables give no file and no rows; other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.common import scratch_path, written

FILE_BYTES = 64 << 20
_CHUNK = 1 << 20
_GZIP = 16 + zlib.MAX_WBITS


def digest_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """One WARC record; a revisit carries the length and digest of the payload but not the payload."""
    block = b"" if is_revisit else payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        *([f"WARC-Target-URI: {json.dumps(url)[1:-1]}"] if url is not None else []),
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest_base32(payload)}",
        f"X-Payload-Length: {len(payload)}",
        *(["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"] if is_revisit else []),
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"


def parse_header(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:] if line)


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _open(uri: str):
    return fs.FileSystem.from_uri(uri)


def with_references(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to, is_revisit) of every row."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # A payload that occurs once refers to nothing, so only repeated ones are named.
    first = rows.where(F.length("payload") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    first = written(first.where("n > 1").select("digest", "refers_to"), "first_pages")
    joined = rows.join(first, "digest", "left")
    revisits = F.col("refers_to").isNotNull() & (F.length("payload") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return joined.select("page_id", "url", "payload", F.when(revisits, F.col("refers_to")).alias("refers_to"), revisits.alias("is_revisit"))


def write_archives(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Monolithic archives in `folder`: (path, n_records) of every file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, out, size, n = [], None, 0, 0
        for b in batches:
            for page_id, url, payload, refers_to, is_revisit in zip(*(b.column(c) for c in ("page_id", "url", "payload", "refers_to", "is_revisit"))):
                if out is None:
                    uri = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz"
                    store, path = _open(uri)
                    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out, press = store.open_output_stream(path, compression=None), zlib.compressobj(6, zlib.DEFLATED, _GZIP)
                data = record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py(), is_revisit.as_py())
                out.write(press.compress(data))
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    out.write(press.flush())
                    out.close()
                    made.append((uri, n))
                    out, size, n = None, 0, 0
        if out is not None:
            out.write(press.flush())
            out.close()
            made.append((uri, n))
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], ["path", "n_records"])

    return written(rows.mapInArrow(run, "path string, n_records long"), "archives")


class Inflated(io.RawIOBase):
    """A gzip file of one or more members as a stream of bytes; memory does not grow with the file."""

    def __init__(self, source):
        self.source, self.engine, self.rest, self.out = source, zlib.decompressobj(_GZIP), b"", b""

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self.out:
            if self.engine.eof:
                self.rest, self.engine = self.engine.unused_data, zlib.decompressobj(_GZIP)
            data = self.rest or self.source.read(_CHUNK)
            if not data:
                return 0
            self.out = self.engine.decompress(data, _CHUNK)
            self.rest = self.engine.unconsumed_tail
        n = min(len(target), len(self.out))
        target[:n], self.out = self.out[:n], self.out[n:]
        return n


def records(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(header, header bytes, block) of each record of an inflated archive."""
    while True:
        lines = []
        while line := stream.readline():
            if line == b"\r\n" and lines:
                break
            if line != b"\r\n":
                lines.append(line)
        if not lines:
            return
        head = b"".join(lines)
        header = parse_header(head)
        yield header, head, stream.read(int(header["Content-Length"]))


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Every archive again with one gzip member per record: (path, index_path, n_records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for uri in b.column("path").to_pylist():
                to = f"{folder}/members-{uuid.uuid4().hex}.warc.gz"
                (store, path), (_, to_path) = _open(uri), _open(to)
                store.create_dir(to_path.rsplit("/", 1)[0], recursive=True)
                offset, n = 0, 0
                with store.open_input_stream(path, compression=None) as source, store.open_output_stream(to_path, compression=None) as out, store.open_output_stream(f"{to_path}.idx", compression=None) as index:
                    for header, head, block in records(io.BufferedReader(Inflated(source), _CHUNK)):
                        press = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
                        member = press.compress(head + b"\r\n" + block + b"\r\n\r\n") + press.flush()
                        out.write(member)
                        index.write(f"{offset}\t{len(member)}\t{header['WARC-Type']}\t{header['WARC-Record-ID']}\n".encode())
                        offset, n = offset + len(member), n + 1
                made.append((to, f"{to}.idx", n))
            columns = list(zip(*made)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.string(), pa.string(), pa.int64()))], ["path", "index_path", "n_records"])

    each = archives.select("path").repartition(max(1, archives.count()))
    return written(each.mapInArrow(run, "path string, index_path string, n_records long"), "normalised")


def read_archives(normalised: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of every record, by the index."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column("path").to_pylist():
                store, path = _open(uri)
                with store.open_input_file(path) as data, io.TextIOWrapper(store.open_input_stream(f"{path}.idx", compression=None), newline="\n") as index:
                    rows, size = [], 0
                    for line in index:
                        offset, length = map(int, line.split("\t")[:2])
                        data.seek(offset)
                        header, _, block = next(records(io.BufferedReader(io.BytesIO(zlib.decompress(data.read(length), _GZIP)))))
                        size += len(block)
                        rows.append(_row(header, block))
                        if len(rows) == 1000 or size > 8 * _CHUNK:
                            yield _batch(rows)
                            rows, size = [], 0
                    yield _batch(rows)

    def _row(header: dict[str, str], block: bytes) -> tuple:
        is_revisit, url = header["WARC-Type"] == "revisit", header.get("WARC-Target-URI")
        stated = header["WARC-Payload-Digest"].removeprefix("sha1:")
        if not is_revisit and digest_base32(block) != stated:
            raise ValueError(f"record {header['WARC-Record-ID']} does not match its digest")
        return (
            _page(header["WARC-Record-ID"]), None if url is None else json.loads(f'"{url}"'), int(header["X-Payload-Length"]) if is_revisit else len(block),
            stated, header["WARC-Type"], _page(header["WARC-Refers-To"]) if is_revisit else None, None if is_revisit else block,
        )

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

    each = normalised.select("path").repartition(max(1, normalised.count()))
    return each.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def archive(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, file_bytes: int = FILE_BYTES, **columns) -> DataFrame:
    """Pages written as WARC files under `folder`, normalised, and what they say: (path, index_path, n_records)."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return normalise(write_archives(with_references(pages, least_bytes=least_bytes, **columns), f"{folder}/monolithic", file_bytes), f"{folder}/members")
