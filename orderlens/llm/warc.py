"""WARC archives with a two-level capture index.

Writing: every task appends its records, each its own gzip member, to an archive of its own under a
fresh name in a folder that all executors share, and returns where each record lies. That table of
captures is stored once; an archive left by a failed or repeated attempt is named nowhere in it. Of
equal payloads of at least ``revisit_from`` bytes the one with the largest id is a response and the
others are revisit records that name it; only ids and digests are shuffled to find them.

Index: captures are range-partitioned and sorted by (reversed-host key, id). Each task writes one
index file: compressed blocks of ``LINES_PER_BLOCK`` lines, then its sparse directory (first entry,
place and length of every block), then the directory's length. The driver learns one line per index
file, as many as there are range partitions.

Reading: queries are range-partitioned and sorted like the index, so a task touches neighbouring
blocks. It finds the index file and then the block by binary search, reads that range only, and finds
the lines by binary search. The places found are sorted by archive and offset, and records are
fetched by range reads that join neighbours.

Defined results: a null payload is empty. A null or malformed address is a key like others. Rows that
repeat an id and payload are written and read back one by one, and are all responses if their id is
the largest. A null id never is the largest of several. Other columns play no part. An empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import struct
import urllib.parse
import zlib
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import stored
from orderlens.session import broadcast_if_small, scratch_folder

ARCHIVE_BYTES = 1 << 28
LINES_PER_BLOCK = 3000
READ_AHEAD = 1 << 22
NO_ID = -(1 << 63)

Place = tuple[str, int]


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))


def reversed_host_key(url: str | None) -> str:
    """``https://Blog.example.com/a?b#c`` -> ``com,example,blog)/a?b``."""
    address = (url or "").split("#", 1)[0]
    rest = address.split("://", 1)[-1]
    host, slash, path = rest.partition("/")
    host, question, query = host.partition("?")
    name = host.rsplit("@", 1)[-1].lower()
    name, colon, port = name.partition(":")
    reverse = ",".join(reversed(name.split(".")))
    return f"{reverse}{colon}{port}){question}{query}{slash}{path}" if rest else ")"


def _record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    uri = urllib.parse.quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        payload = b""
    body = http.encode() + payload
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode().split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}


def parse_record(raw: bytes) -> dict:
    """Page, full payload size and hex digest, type and target of a reference.

    A response's figures come from the payload as read, and must agree with its headers.
    """
    head, _, body = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    body = body[: int(warc["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    digest = base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = int(_headers(http)["content-length"])
    id_of = lambda x: int(x) if (x := x.removeprefix("<urn:page:").removesuffix(">")) else None
    if warc["warc-type"] == "response" and (
        len(payload) != size or hashlib.sha1(payload).hexdigest() != digest
    ):
        raise ValueError(f"damaged record {warc['warc-record-id']}")
    return {
        "page": id_of(warc["warc-record-id"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": warc["warc-type"],
        "refers_to": id_of(warc["warc-refers-to"]) if "warc-refers-to" in warc else None,
        "payload": payload,
    }


def plan_revisits(pages: DataFrame, revisit_from: int, key: str, html: str) -> DataFrame:
    """``page``, ``digest`` and ``refers_to`` of every record that repeats an earlier payload."""
    payload = F.coalesce(F.col(html), F.lit(""))
    large = stored(
        pages.where(F.octet_length(payload) >= revisit_from).select(
            F.col(key).alias("page"), F.sha1(payload.cast("binary")).alias("digest")
        )
    )
    shared = stored(
        large.groupBy("digest")
        .agg(F.max("page").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and refers_to is not null")
        .drop("n")
    )
    repeats = large.join(shared, "digest").where("not page <=> refers_to")
    return stored(repeats.select("page", "digest", "refers_to").distinct())


def write_archives(
    pages: DataFrame, folder: str, revisit_from: int, key: str, url: str, html: str
) -> DataFrame:
    """Write one record per row; returns ``surt``, ``page``, ``archive``, ``start`` and ``length``."""
    repeats = plan_revisits(pages, revisit_from, key, html)
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    source = pages.select(F.col(key).alias("page"), F.col(url).alias("url"), payload.alias("payload"))
    rows = source.withColumn("digest", F.sha1("payload")).alias("p").join(
        broadcast_if_small(repeats).alias("r"),
        F.col("p.page").eqNullSafe(F.col("r.page")) & (F.col("p.digest") == F.col("r.digest")),
        "left",
    ).select("p.page", "p.url", "p.payload", "r.refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        archive, out, at = "", None, 0
        for whole in batches:
            for first in range(0, whole.num_rows, 200):
                found = {n: [] for n in ("surt", "page", "archive", "start", "length")}
                for page, address, content, refers_to in zip(
                    *[c.to_pylist() for c in whole.slice(first, 200).columns], strict=True
                ):
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        archive, at = f"{uuid4()}.warc.gz", 0
                        out = system.open_output_stream(f"{root}/{archive}", compression=None)
                    member = gzip.compress(_record(page, address, content, refers_to), 6, mtime=0)
                    out.write(member)
                    for name, value in zip(
                        found, (reversed_host_key(address), page, archive, at, len(member)), strict=True
                    ):
                        found[name].append(value)
                    at += len(member)
                yield pa.RecordBatch.from_pydict(found, schema=_CAPTURE)
        if out is not None:
            out.close()

    return stored(rows.mapInArrow(write, "surt string, page long, archive string, start long, length long"))


_CAPTURE = pa.schema(
    [("surt", pa.string()), ("page", pa.int64()), ("archive", pa.string()), ("start", pa.int64()), ("length", pa.int64())]
)


def _sorted_by_key(captures: DataFrame) -> DataFrame:
    order = ["surt", F.coalesce("page", F.lit(NO_ID))]
    return captures.repartitionByRange(*order).sortWithinPartitions(*order)


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write the index files; returns ``file``, ``first_surt`` and ``first_page`` of each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        name, out, at = f"{uuid4()}.idx", None, 0
        directory: list[list] = []
        lines: list[list] = []

        def flush() -> None:
            nonlocal out, at, lines
            if not lines:
                return
            if out is None:
                system.create_dir(root, recursive=True)
                out = system.open_output_stream(f"{root}/{name}", compression=None)
            block = zlib.compress("\n".join(map(json.dumps, lines)).encode())
            directory.append([lines[0][0], lines[0][1], at, len(block)])
            out.write(block)
            at += len(block)
            lines = []

        for batch in batches:
            for surt, page, *where in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                lines.append([surt, NO_ID if page is None else page, *where])
                if len(lines) == LINES_PER_BLOCK:
                    flush()
        flush()
        if out is not None:
            packed = zlib.compress(json.dumps(directory).encode())
            out.write(packed + struct.pack("<q", len(packed)))
            out.close()
            first = directory[0]
            yield pa.RecordBatch.from_pydict(
                {"file": [name], "first_surt": [first[0]], "first_page": [first[1]]}
            )

    return stored(
        _sorted_by_key(captures).mapInArrow(write, "file string, first_surt string, first_page long")
    )


class IndexReader:
    """Looks captures up in the index files of a folder; keeps one directory and one block at hand."""

    def __init__(self, folder: str, files: list[tuple[str, int, str]]) -> None:
        self.system, self.root = _open(folder)
        self.files = sorted(files)
        self.firsts: list[Place] = [(s, p) for s, p, _ in self.files]
        self.open_file, self.open_block = -1, (-1, -1)

    def _directory(self, number: int) -> None:
        if number == self.open_file:
            return
        path = f"{self.root}/{self.files[number][2]}"
        size = self.system.get_file_info(path).size
        self.handle = self.system.open_input_file(path)
        length = struct.unpack("<q", self.handle.read_at(8, size - 8))[0]
        self.directory = json.loads(zlib.decompress(self.handle.read_at(length, size - 8 - length)))
        self.starts: list[Place] = [(s, p) for s, p, _, _ in self.directory]
        self.open_file = number

    def _block(self, number: int, block: int) -> None:
        if (number, block) != self.open_block:
            _, _, at, length = self.directory[block]
            text = zlib.decompress(self.handle.read_at(length, at)).decode()
            self.lines = [json.loads(x) for x in text.split("\n")]
            self.keys: list[Place] = [(x[0], x[1]) for x in self.lines]
            self.open_block = (number, block)

    def find(self, surt: str, page: int | None) -> Iterator[list]:
        """All captures of that key and id; equal ones may run on into later blocks and files."""
        wanted = (surt, NO_ID if page is None else page)
        number = max(0, bisect.bisect_left(self.firsts, wanted) - 1)
        while number < len(self.files) and self.firsts[number] <= wanted:
            self._directory(number)
            block = max(0, bisect.bisect_left(self.starts, wanted) - 1)
            while block < len(self.starts) and self.starts[block] <= wanted:
                self._block(number, block)
                at = bisect.bisect_left(self.keys, wanted)
                while at < len(self.keys) and self.keys[at] == wanted:
                    yield self.lines[at]
                    at += 1
                block += 1
            number += 1


def look_up(queries: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """``archive``, ``start`` and ``length`` of all captures of the given ``surt`` and ``page``."""
    # One row per index file, so as many as there were range partitions.
    files = [(r["first_surt"], r["first_page"], r["file"]) for r in index.collect()]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = IndexReader(folder, files)
        for batch in batches:
            found = [
                x[2:]
                for surt, page in zip(*[c.to_pylist() for c in batch.columns], strict=True)
                for x in reader.find(surt, page)
            ]
            if found:
                yield pa.RecordBatch.from_pydict(
                    dict(zip(("archive", "start", "length"), map(list, zip(*found, strict=True)), strict=True))
                )

    ordered = _sorted_by_key(queries.select("surt", "page").distinct())
    return stored(ordered.mapInArrow(find, "archive string, start long, length long"))


def fetch(places: DataFrame, folder: str) -> DataFrame:
    """Read records by range and parse them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        name, handle, ahead, ahead_at = "", None, b"", 0
        for batch in batches:
            rows = []
            for archive, start, length in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if archive != name:
                    name, ahead, ahead_at = archive, b"", 0
                    handle = system.open_input_file(f"{root}/{archive}")
                if not ahead_at <= start <= start + length <= ahead_at + len(ahead):
                    ahead, ahead_at = handle.read_at(max(length, READ_AHEAD), start), start
                member = ahead[start - ahead_at : start - ahead_at + length]
                rows.append(parse_record(gzip.decompress(member)))
            yield pa.RecordBatch.from_pydict(
                {f: pa.array([r[f] for r in rows], t) for f, t in _READ}
            )

    ordered = places.repartitionByRange("archive", "start").sortWithinPartitions("archive", "start")
    return ordered.mapInArrow(
        read,
        "page long, payload_bytes long, payload_digest string, record_type string, refers_to long",
    )


_READ = [
    ("page", pa.int64()),
    ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()),
    ("record_type", pa.string()),
    ("refers_to", pa.int64()),
]


def round_trip(
    pages: DataFrame,
    folder: str | None = None,
    revisit_from: int = 1000,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Archive every page under ``folder``, index the captures, and read all of them back."""
    folder = folder or scratch_folder(pages.sparkSession)
    captures = write_archives(pages, f"{folder}/archives", revisit_from, key, url, html)
    index = build_index(captures, f"{folder}/index")
    places = look_up(captures, index, f"{folder}/index")
    return fetch(places, f"{folder}/archives").withColumnRenamed("page", key)
