"""WARC archives with a two-level capture index.

Each task writes its records, one gzip member each, to files of its own.  The index
entries are sorted by reversed-host URL keys and packed into compressed blocks; a
sparse directory keeps the first and last key of every block.  A look-up finds its
blocks by binary search in the part of the directory that its keys span, reads those
blocks, and then reads the records by their ranges.

Files are reached through ``pyarrow.fs`` by the URI of the archive's folder, which
every executor must be able to open; only readers and writers of bytes can seek, and
Spark has none.  An entry names the file of the task that succeeded, so a task that is
lost and run again leaves at most a file that nothing points to.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import slices, written
from strandline.session import scratch_path

#: Payloads below this many bytes are always kept.
SMALL = 100
#: Entries in a block of the index.
BLOCK = 512
#: Records that lie together are read together, up to so many bytes.
TOGETHER = 4 << 20
#: A file of the archive is followed by another one beyond this size.
FILE_BYTES = 1 << 30
#: A task reads about this much of an archive back.
RANGE_BYTES = 64 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """The URL with its host reversed, without scheme, user, default port and
    fragment: http://www.example.com/a becomes com,example,www)/a."""
    if url is None:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname, parts.port
    except ValueError:
        host = None
    if not host:
        return ")" + quote(url, safe="/:?#[]@!$&'()*+,;=%~-._")
    default = {"http": 80, "https": 443}.get(parts.scheme)
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port != default else "")
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{key}){quote(rest, safe='/:?[]@!$&()*+,;=%~-._' + chr(39))}"


def record(kind: str, page: str, url: str, payload: bytes, digest: str, refers: str | None) -> bytes:
    """One record as a gzip member.  A revisit has the headers of the answer only."""
    block = HTTP if kind == "revisit" else HTTP + payload
    # Line ends in a URL would end its header.
    target = quote(url, safe="/:?#[]@!$&'()*+,;=%~-._")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}", f"Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return gzip.compress(head + block + b"\r\n\r\n", LEVEL, mtime=0)


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, by lower-case name, and block of a record."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    headers = dict(
        (k.lower(), v) for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")[1:])
    )
    return headers, rest[: int(headers["content-length"])]


@dataclass
class Archive:
    """Where an archive and its index are; ``page_type`` is the type of its page ids,
    ``ranges`` how many tasks read all of it."""

    folder: str
    directory: str
    page_type: str
    ranges: int = 1


def _opened(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    system, path = pyarrow.fs.FileSystem.from_uri(folder)
    return system, path.rstrip("/")


class _Files:
    """Files of one task: bytes go in, names and places come out."""

    def __init__(self, folder: str, suffix: str) -> None:
        self.folder, self.suffix = folder, suffix
        self.stream, self.name, self.at = None, "", 0

    def put(self, data: bytes) -> tuple[str, int, int]:
        if self.stream is None or self.at > FILE_BYTES:
            self.close()
            system, path = _opened(self.folder)
            system.create_dir(path, recursive=True)
            self.name, self.at = f"{uuid.uuid4().hex}.{self.suffix}", 0
            self.stream = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.stream.write(data)
        self.at += len(data)
        return self.name, self.at - len(data), len(data)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def marked(pages: DataFrame) -> DataFrame:
    """``pages`` (``page_id``, ``url``, ``html``) with ``digest`` of the payload and
    ``refers``: the smallest id among equal payloads of at least ``SMALL`` bytes, if
    this row has another one.

    Only digests that repeat are joined, so the pages stay where they are as long as
    Spark finds these few enough to send to all tasks.
    """
    hashed = pages.withColumn("digest", F.sha2("html", 256))
    large = F.octet_length("html") >= SMALL
    repeated = written(
        hashed.filter(large).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND first IS NOT NULL").select("digest", "first"),
        "warc-repeated",
    )
    other = large & ~F.col("page_id").eqNullSafe(F.col("first"))
    return hashed.join(repeated, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(other, F.col("first")).alias("refers")
    )


ENTRY = "key string, page string, file string, offset bigint, length bigint"


def archived(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> Archive:
    """Write a record for every row of ``pages``, and the index, to the shared folder.

    The payload is the page in UTF-8, empty for null.  Of equal payloads of at least
    ``SMALL`` bytes, rows with the smallest id are responses and others revisits of
    it; a row without an id is a revisit if one with an id has its payload.  An empty
    table makes an empty archive.
    """
    picked = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"),
        F.coalesce(html, F.lit("")).alias("html"),
    )
    kind = picked.schema["page_id"].dataType.simpleString()
    folder = scratch_path(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, "warc.gz")
        for whole in batches:
            for batch in slices(whole, 1000, 8 << 20):
                rows = []
                for page, at, html_, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                    name = "" if page is None else str(page)
                    what = "response" if refers is None else "revisit"
                    data = record(what, name, at or "", html_.encode(), digest, refers)
                    rows.append((url_key(at), name, *files.put(data)))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("key", "page", "file", "offset", "length"), r)) for r in rows]
                )
        files.close()

    entries = written(marked(picked).mapInArrow(write, ENTRY), "warc-entries")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, "cdx.z")
        pending: list[tuple] = []
        out: list[dict] = []

        def packed(rows: list[tuple]) -> dict:
            text = "".join("\t".join(map(str, r)) + "\n" for r in rows)
            file, offset, length = files.put(zlib.compress(text.encode(), LEVEL))
            first, last = rows[0][0], rows[-1][0]
            return dict(first=first, last=last, file=file, offset=offset, length=length)

        for batch in batches:
            pending += zip(*(c.to_pylist() for c in batch.columns))
            while len(pending) >= BLOCK:
                out.append(packed(pending[:BLOCK]))
                del pending[:BLOCK]
        if pending:
            out.append(packed(pending))
        files.close()
        if out:
            yield pa.RecordBatch.from_pylist(out)

    directory = scratch_path(pages.sparkSession, "warc-directory")
    (
        entries.repartitionByRange("key", "page", "file", "offset")
        .sortWithinPartitions("key", "page", "file", "offset")
        .mapInArrow(pack, "first string, last string, file string, offset bigint, length bigint")
        .write.parquet(directory)
    )
    size = entries.agg(F.sum("length")).first()[0] or 0
    return Archive(folder, directory, kind, -(-size // RANGE_BYTES) or 1)


def _blocks(archive: Archive, keys: list[bytes]) -> tuple[list[tuple], list[bytes], list[bytes]]:
    """The part of the directory that sorted ``keys`` span, in order: rows (file,
    offset, length), and the first and last keys."""
    system, path = _opened(archive.directory)
    data = pyarrow.dataset.dataset(path, filesystem=system, format="parquet")
    low, high = keys[0].decode(), keys[-1].decode()
    field = pyarrow.dataset.field
    found = data.to_table(filter=(field("first") <= high) & (field("last") >= low))
    rows = sorted(
        (r["first"].encode(), r["last"].encode(), r["file"], r["offset"], r["length"])
        for r in found.to_pylist()
    )
    return [r[2:] for r in rows], [r[0] for r in rows], [r[1] for r in rows]


def captures(archive: Archive, urls: DataFrame) -> DataFrame:
    """Index entries (``key``, ``page``, ``file``, ``offset``, ``length``) of all
    captures of the column ``url`` of ``urls``; repeated URLs count once.

    Keys are sorted and dealt out by ranges; each finds its blocks by binary search.
    Blocks are then dealt out anew, so a URL with very many captures is read by many
    tasks.
    """
    spark = urls.sparkSession

    @F.arrow_udf("string")
    def key_of(column: pa.Array) -> pa.Array:
        return pa.array([url_key(u) for u in column.to_pylist()], pa.string())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [k.encode() for k in batch.column(0).to_pylist()]
            if not keys:
                continue
            blocks, firsts, lasts = _blocks(archive, keys)
            wanted: dict[int, list[str]] = {}
            for key in keys:
                at = bisect.bisect_left(lasts, key)
                while at < len(blocks) and firsts[at] <= key:
                    wanted.setdefault(at, []).append(key.decode())
                    at += 1
            rows = [
                dict(zip(("file", "offset", "length"), blocks[at])) | {"keys": mine}
                for at, mine in wanted.items()
            ]
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _opened(archive.folder)
        for batch in batches:
            rows = []
            for file, offset, length, keys in zip(*(c.to_pylist() for c in batch.columns)):
                with system.open_input_file(f"{path}/{file}") as f:
                    text = zlib.decompress(f.read_at(length, offset)).decode()
                mine = set(keys)
                for line in text.split("\n")[:-1]:
                    key, page, name, at, n = line.split("\t")
                    if key in mine:
                        rows.append(dict(key=key, page=page, file=name, offset=int(at), length=int(n)))
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    keys = urls.select(key_of("url").alias("key")).distinct()
    blocks = keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(
        find, "file string, offset bigint, length bigint, keys array<string>"
    )
    deal = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(deal, "file", "offset").mapInArrow(read, ENTRY)


def read_back(archive: Archive, entries: DataFrame) -> DataFrame:
    """The records of ``entries``: ``page_id``, ``url``, ``record_type``,
    ``payload_bytes`` and ``payload_digest`` of the full payload (for responses
    measured on what was read), ``refers_to`` and the ``payload`` itself (null for
    revisits).  Ranges are sorted, and neighbouring ones read together."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _opened(archive.folder)
        name, f = None, None
        for batch in batches:
            places = list(zip(*(c.to_pylist() for c in batch.columns)))
            at = 0
            while at < len(places):
                file, begin, length = places[at]
                end, stop = begin + length, at + 1
                while (
                    stop < len(places) and places[stop][0] == file and places[stop][1] == end
                    and end - begin < TOGETHER
                ):
                    end += places[stop][2]
                    stop += 1
                if file != name:
                    if f is not None:
                        f.close()
                    name, f = file, system.open_input_file(f"{path}/{file}")
                data = memoryview(f.read_at(end - begin, begin))
                rows = []
                for _, offset, n in places[at:stop]:
                    rows.append(_row(*parsed(data[offset - begin : offset - begin + n])))
                at = stop
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _ROW)], list(_NAMES)
                )
        if f is not None:
            f.close()

    # A number that is given is kept: entries are small, what they stand for is not.
    deal = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        entries.select("file", "offset", "length")
        .repartitionByRange(max(deal, archive.ranges), "file", "offset")
        .sortWithinPartitions("file", "offset")
    )
    rows = ranged.mapInArrow(
        read,
        "page string, url string, record_type string, payload_bytes bigint, "
        "payload_digest string, refers string, payload binary",
    )
    typed = {c: F.nullif(F.col(c), F.lit("")).cast(archive.page_type) for c in ("page", "refers")}
    return rows.select(
        typed["page"].alias("page_id"), "url", "record_type", "payload_bytes", "payload_digest",
        typed["refers"].alias("refers_to"), "payload",
    )


_NAMES = ("page", "url", "record_type", "payload_bytes", "payload_digest", "refers", "payload")
_ROW = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())
_PAGE = re.compile(r"<urn:page:(.*)>")


def _row(headers: dict[str, str], block: bytes) -> tuple:
    page = _PAGE.fullmatch(headers["warc-record-id"])[1]
    kind = headers["warc-type"]
    if kind == "revisit":
        digest = headers["warc-payload-digest"].removeprefix("sha256:")
        refers = _PAGE.fullmatch(headers["warc-refers-to"])[1]
        size = int(headers["payload-length"])
        return page, headers["warc-target-uri"], kind, size, digest, refers, None
    payload = block.partition(b"\r\n\r\n")[2]
    digest = hashlib.sha256(payload).hexdigest()
    return page, headers["warc-target-uri"], kind, len(payload), digest, None, payload
