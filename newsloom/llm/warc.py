"""WARC archives with a two-level capture index.

Records are gzip members of their own in files of bounded size. The index sorts
captures by reversed-host URL key into compressed blocks (first level) and keeps
the first key of every block in a small directory (second level). A look-up
searches the directory by bisection, reads and searches one block, and then reads
only the byte range of the record. Keys are looked up in sorted order and by index
file, so very many keys are as good as one.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import stored
from newsloom.llm.files import NewFile, Ranges, shared_folder


@dataclass(frozen=True)
class ArchiveShape:
    """Bytes per archive file, captures per index block, and the least payload that is deduplicated."""

    file_bytes: int = 64 << 20
    block_captures: int = 1000
    least_shared_bytes: int = 100
    date: str = "2024-01-01T00:00:00Z"


_ID = "urn:newsloom:page:"
CAPTURES = "key string, page_id long, url string, file string, offset long, length long"
DIRECTORY = "first_key string, last_key string, file string, offset long, length long, n_captures long"


def url_key(url: str | None) -> str:
    """Reversed host, then port, path and query: captures of a site lie together.

    Blanks and control characters are escaped here, before anything is sorted.
    """
    return _header_safe(_reversed(url))


def _reversed(url: str | None) -> str:
    try:
        parts = urlsplit((url or "").strip())
        host = ",".join(reversed((parts.hostname or "").split(".")))
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return url or ""
    query = f"?{parts.query}" if parts.query else ""
    return f"{host}{port}){parts.path or '/'}{query}"


def _header_safe(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None, date: str) -> bytes:
    """One record: a whole response, or a revisit without payload that names the response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if original is None else 'revisit'}", f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_safe(url)}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if original is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_ID}{original}>"]
    block = http + payload if original is None else http
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parsed_record(member: bytes) -> dict[str, object]:
    """What a record says; size and digest are those of the payload it holds, or else what its headers state."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    whole = fields["WARC-Type"] == "response"
    number = fields["WARC-Record-ID"][len(_ID) + 1 : -1]
    refers = fields.get("WARC-Refers-To")
    return {
        "page_id": int(number) if number else None,
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": len(payload) if whole else int(re.search(rb"Content-Length: (\d+)", http)[1]),
        "payload_digest": hashlib.sha256(payload).hexdigest() if whole else fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "record_type": fields["WARC-Type"],
        "refers_to": int(refers[len(_ID) + 1 : -1]) if refers else None,
        "payload": payload if whole else None,
    }


def with_originals(pages: DataFrame, how: ArchiveShape) -> DataFrame:
    """Pages with their payload digest and, for revisits, the page they repeat.

    The least id per digest is found by counting before the shuffle; only digests
    that occur under several ids are joined back.
    """
    digest = F.sha2(F.coalesce(F.col("html"), F.lit("")).cast("binary"), 256)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", digest.alias("digest"))
    large = rows.filter((F.octet_length("html") >= how.least_shared_bytes) & F.col("page_id").isNotNull())
    shared = large.groupBy("digest").agg(F.min("page_id").alias("original"), F.max("page_id").alias("last")).filter("original <> last")
    revisit = F.when(F.col("page_id") != F.col("original"), F.col("original"))
    return rows.join(shared.select("digest", "original"), "digest", "left").withColumn("original", revisit)


def write_archives(pages: DataFrame, how: ArchiveShape | None = None) -> DataFrame:
    """Write one record per page; return the captures as a stored table.

    Null html is an empty payload; null urls have an empty key; null ids are never
    revisited; rows that repeat an id and payload are responses each.
    """
    how = how or ArchiveShape()
    folder = shared_folder(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file: NewFile | None = None
        for batch in batches:
            found: list[tuple] = []
            for row in batch.to_pylist():
                if file is not None and file.size >= how.file_bytes:
                    file.close()
                    file = None
                if file is None:
                    file = NewFile(folder, f"part-{TaskContext.get().partitionId():05d}", ".warc.gz")
                payload = (row["html"] or "").encode()
                member = _member(record_bytes(row["page_id"], row["url"], payload, row["digest"], row["original"], how.date))
                start = file.append(member)
                found.append((url_key(row["url"]), row["page_id"], row["url"], file.uri, start, len(member)))
            yield _rows(found, CAPTURES)
        if file is not None:
            file.close()

    return stored(with_originals(pages, how).mapInArrow(write, CAPTURES), "warc-captures")


def _rows(found: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    types = {"string": pa.string(), "long": pa.int64()}
    columns = zip(*found, strict=True) if found else ((),) * len(names)
    return pa.RecordBatch.from_arrays([pa.array(x, types[k]) for x, k in zip(columns, kinds, strict=True)], list(names))


def write_index(captures: DataFrame, how: ArchiveShape | None = None) -> DataFrame:
    """Write the sorted index blocks; return their directory as a stored table.

    Captures are range-partitioned by key and id, so a host or URL with very many
    captures spreads over several files.
    """
    how = how or ArchiveShape()
    folder = shared_folder(captures.sparkSession, "warc-index")
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ("key", "page_id", "file", "offset")
    ordered = captures.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file: NewFile | None = None
        lines: list[tuple[str, dict]] = []
        found: list[tuple] = []

        def flush() -> None:
            nonlocal file, lines
            if file is None:
                file = NewFile(folder, f"part-{TaskContext.get().partitionId():05d}", ".cdx")
            data = zlib.compress("\n".join(f"{key} {json.dumps(rest)}" for key, rest in lines).encode())
            found.append((lines[0][0], lines[-1][0], file.uri, file.append(data), len(data), len(lines)))
            lines = []

        for batch in batches:
            for row in batch.to_pylist():
                # a blank ends the key in its line, and keys have none
                lines.append((row.pop("key"), row))
                if len(lines) == how.block_captures:
                    flush()
        if lines:
            flush()
        if file is not None:
            file.close()
        yield _rows(found, DIRECTORY)

    return stored(ordered.mapInArrow(write, DIRECTORY), "warc-directory")


def _block(ranges: Ranges, entry: dict) -> tuple[list[str], list[str]]:
    data = zlib.decompress(ranges.read(entry["file"], entry["offset"], entry["length"])).decode()
    keys, rest = zip(*(line.split(" ", 1) for line in data.split("\n")), strict=True)
    return list(keys), list(rest)


def index_captures(directory: DataFrame) -> DataFrame:
    """All captures, read from the index blocks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges()
        for batch in batches:
            for entry in batch.to_pylist():
                keys, rest = _block(ranges, entry)
                yield _rows([(k, *json.loads(x).values()) for k, x in zip(keys, rest, strict=True)], CAPTURES)
        ranges.close()

    n = int(directory.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return directory.repartition(n, "file", "offset").mapInArrow(read, CAPTURES)


RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
_RECORD_FIELDS = [(c, {"long": pa.int64(), "string": pa.string()}[k]) for c, k in (x.split() for x in RECORDS.split(", "))]


def read_records(captures: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of captures by range reads, in the order they have in their files.

    Size and digest of responses are taken from the payload that was read; revisits
    only state theirs. ``payload`` may be left out.
    """
    schema = pa.schema([*_RECORD_FIELDS, ("payload", pa.binary())] if payloads else _RECORD_FIELDS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges()
        for batch in batches:
            held, size = [], 0
            for uri, start, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                record = parsed_record(ranges.read(uri, start, length))
                if not payloads:
                    del record["payload"]
                held.append(record)
                size += record["payload_bytes"] * payloads
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
            yield pa.RecordBatch.from_pylist(held, schema)
        ranges.close()

    places = captures.select("file", "offset", "length")
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # files may be large: their 8 MB stretches are dealt out
    dealt = places.repartition(n, "file", F.shiftright("offset", 23)).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(read, f"{RECORDS}, payload binary" if payloads else RECORDS)


def with_named_payloads(records: DataFrame) -> DataFrame:
    """Records without payloads, revisits with size and digest of the response they name.

    A revisit whose response is not there, or has another digest than the revisit
    states, has nulls.
    """
    records = stored(records.drop("payload"), "warc-records")
    responses = records.filter("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("_bytes")
    )
    named = records.filter("record_type = 'revisit'").join(responses.distinct(), ["refers_to", "payload_digest"], "left")
    found = named.withColumns({"payload_bytes": F.col("_bytes"), "payload_digest": F.when(F.col("_bytes").isNotNull(), F.col("payload_digest"))})
    return records.filter("record_type = 'response'").unionByName(found.drop("_bytes"))


def keys_of(pages: DataFrame) -> DataFrame:
    """The distinct ``key`` of all urls."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string())], ["key"])

    return pages.select("url").distinct().mapInArrow(keys, "key string").distinct()


def look_up_keys(directory: DataFrame, keys: DataFrame) -> DataFrame:
    """All captures of the distinct ``key`` of a table, by the directory.

    Index files follow each other in key order, one per partition of the index, so
    their first and last keys say which of them a key may be in. Its file's directory
    is searched by bisection for the block, and the block for the key.
    """
    files = directory.groupBy("file").agg(F.min("first_key").alias("first"), F.max("last_key").alias("last"))
    # as many rows as the index has partitions
    spans = sorted((r["first"], r["last"], r["file"]) for r in files.collect())
    firsts = [x[0] for x in spans]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, str]] = []
            for key in batch.column("key").to_pylist():
                # equal keys may reach over several files
                at = bisect.bisect_right(firsts, key) - 1
                while at >= 0 and spans[at][1] >= key:
                    found.append((spans[at][2], key))
                    at -= 1
            yield _rows(found, "file string, key string")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, own, names, held = Ranges(), [], [], (None, None)
        for batch in batches:
            found: list[tuple] = []
            for row in batch.to_pylist():
                key = row.pop("key")
                if key is None:
                    # directory rows come before the keys of their file
                    if own and own[-1]["file"] != row["file"]:
                        own, names = [], []
                    own.append(row)
                    names.append(row["first_key"])
                    continue
                # the first block that may hold the key; equal keys may reach over several blocks
                at = max(bisect.bisect_left(names, key) - 1, 0)
                while at < len(own) and names[at] <= key:
                    if own[at]["last_key"] >= key:
                        if held[0] is not own[at]:
                            held = own[at], _block(ranges, own[at])
                        listed, rest = held[1]
                        low, high = bisect.bisect_left(listed, key), bisect.bisect_right(listed, key)
                        found += [(key, *json.loads(x).values()) for x in rest[low:high]]
                        if len(found) > 4096:
                            yield _rows(found, CAPTURES)
                            found = []
                    at += 1
            yield _rows(found, CAPTURES)
        ranges.close()

    n = int(directory.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = keys.select("key").mapInArrow(deal, "file string, key string")
    blocks = directory.withColumn("key", F.lit(None).cast("string"))
    both = blocks.unionByName(asked, allowMissingColumns=True)
    return both.repartition(n, "file").sortWithinPartitions("file", F.asc_nulls_first("key"), "offset").mapInArrow(find, CAPTURES)


def look_up(directory: DataFrame, urls: list[str]) -> DataFrame:
    """The captures of the given urls (a short stated list)."""
    wanted = sorted({url_key(u) for u in urls})
    return look_up_keys(directory, directory.sparkSession.createDataFrame([(k,) for k in wanted], "key string"))
