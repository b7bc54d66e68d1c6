"""WARC archives in Zstandard form: writer with deduplicated payloads, and a validating reader.

An archive is a skippable frame (magic 0x184D2A5D) holding the dictionary, if
there is one, followed by one Zstandard frame for each record.  The writer trains
a small dictionary per archive on its first records.  The reader loads the
dictionary, finds each frame's end by walking its blocks, decodes that frame
alone, and checks the version line, the required headers, both lengths, the
closing blank lines and the payload digest.

Jobs: (1) payload digests shared by several rows, with the smallest id, from
light rows pre-aggregated before the shuffle; (2) rows joined to those digests
and written, an archive for each ARCHIVE_BYTES of records; committed rows name
the archives, so a lost or repeated task leaves at most an orphan file; (3) the
named archives are read.  No step gathers a group of copies.

Defined results: null html counts as an empty payload; payloads under
MIN_REVISIT bytes are always responses; rows that share both payload and smallest
id are all responses; a row without an id is never referred to, and revisits the
smallest id if there is one; a null url, or one with control characters or
spaces, is written percent-encoded or as a urn; an empty table gives no archives;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, filesystem, new_dir, written

MIN_REVISIT = 100
ARCHIVE_BYTES = 32 << 20
DICT_BYTES, DICT_SAMPLE, LEVEL = 32 << 10, 1 << 20, 3
DICT_MAGIC = (0x184D2A5D).to_bytes(4, "little")
FRAME_MAGIC = (0xFD2FB528).to_bytes(4, "little")
VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:x-page:"
RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
RECORD_DDL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


class WarcError(ValueError):
    """An archive breaks the format."""


def urn(page_id: int | None) -> str:
    return f"<{URN}{'none' if page_id is None else page_id}>"


def from_urn(text: str) -> int | None:
    if not text.startswith(f"<{URN}") or not text.endswith(">"):
        raise WarcError(f"not a record id of this writer: {text[:80]}")
    x = text[len(URN) + 1 : -1]
    return None if x == "none" else int(x)


#: A digest and a page id in a broadcast hash table.
SHARED_BYTES = 300


def record(page_id: int | None, url: str | None, payload: bytes | None, n_bytes: int, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One whole record with its closing blank lines; of a revisit the payload isn't written."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n_bytes + (b"" if revisit else payload or b"")
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else urn(page_id)[1:-1]
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> bytes:
    """A trained compression dictionary, or nothing where the samples are too few for one."""
    import zstandard

    pieces = [x[i : i + 4096] for x in samples for i in range(0, len(x), 4096)]
    size = sum(map(len, pieces))
    if len(pieces) < 32 or size < 8 * DICT_BYTES:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def archive(records: list[bytes]) -> bytes:
    import zstandard

    sample, size = [], 0
    for r in records:
        if size > DICT_SAMPLE:
            break
        sample.append(r[:65536])
        size += len(sample[-1])
    d = dictionary(sample)
    press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True, dict_data=zstandard.ZstdCompressionDict(d) if d else None)
    head = DICT_MAGIC + len(d).to_bytes(4, "little") + d if d else b""
    return head + b"".join(map(press.compress, records))


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at `at` ends, by its header and block sizes."""
    import zstandard

    if bytes(data[at : at + 4]) != FRAME_MAGIC:
        raise WarcError(f"no frame at byte {at}")
    flags = data[at + 4]
    at += zstandard.frame_header_size(bytes(data[at : at + 18]))
    last = False
    while not last:
        if at + 3 > len(data):
            raise WarcError("a frame is cut off")
        head = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = bool(head & 1), head >> 1 & 3, head >> 3
        at += 3 + (1 if kind == 1 else size)
    at += 4 * bool(flags & 4)
    if at > len(data):
        raise WarcError("a frame is cut off")
    return at


def records(data: bytes) -> Iterator[bytes]:
    """The decoded records of an archive, one frame at a time."""
    import zstandard

    view, at, d = memoryview(data), 0, None
    if data[:4] == DICT_MAGIC:
        at = 8 + int.from_bytes(data[4:8], "little")
        held = data[8:at]
        d = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(held, max_output_size=64 << 20) if held[:4] == FRAME_MAGIC else held)
    unpress = zstandard.ZstdDecompressor(dict_data=d) if d else zstandard.ZstdDecompressor()
    while at < len(view):
        end = frame_end(view, at)
        yield unpress.decompress(view[at:end])
        at = end


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, lower-cased, and block of a record whose form is checked."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] != VERSION:
        raise WarcError("no version line or no end of headers")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or name.lower() in headers:
            raise WarcError(f"a header line is broken or repeated: {line[:80]!r}")
        headers[name.lower()] = value.strip()
    for need in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if need not in headers:
            raise WarcError(f"no {need} header")
    n = headers["content-length"]
    if not n.isascii() or not n.isdigit() or len(rest) != int(n) + 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError("the block's length differs from its header's")
    return headers, rest[:-4]


def row(raw: bytes) -> dict:
    """What a record of this writer says of its page; lengths and digest are checked."""
    headers, block = parsed(raw)
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        raise WarcError(f"unexpected record type {kind}")
    http, mark, payload = block.partition(b"\r\n\r\n")
    length = next((int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    algorithm, _, digest = headers.get("warc-payload-digest", "").partition(":")
    if not mark or length is None or algorithm != "sha256":
        raise WarcError("no payload length or digest")
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise WarcError(f"the payload of {headers['warc-record-id']} differs from its headers")
    if kind == "revisit" and (payload or headers.get("warc-profile") != PROFILE):
        raise WarcError("a revisit record has a payload or another profile")
    return {"page_id": from_urn(headers["warc-record-id"]), "payload_bytes": length, "payload_digest": digest, "record_type": kind, "refers_to": from_urn(headers["warc-refers-to"]) if kind == "revisit" else None}


def _writer(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        held, size = [], 0

        def save() -> pa.RecordBatch:
            name, data = f"{uuid.uuid4().hex}.warc.zst", archive(held)
            with fs.open_output_stream(f"{base}/{name}", compression=None) as f:
                f.write(data)
            return pa.RecordBatch.from_pydict({"path": [name], "records": [len(held)], "bytes": [len(data)]}, schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

        for batch in batches:
            for x in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                raw = record(*x)
                held.append(raw)
                size += len(raw)
                if size >= ARCHIVE_BYTES:
                    yield save()
                    held, size = [], 0
        if held:
            yield save()

    return run


def write_archives(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write a record for each page; returns path (below folder), records, bytes of each archive, as a written table."""
    fs, base = filesystem(folder)
    fs.create_dir(base, recursive=True)
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha2("payload", 256))
    shared = own.where(F.octet_length("payload") >= min_revisit).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first")).where("n > 1 and first is not null").select("digest", "first")
    shared = written(shared, "shared", f"{folder}-shared")
    roles = own.join(broadcast_if_small(shared, SHARED_BYTES), "digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    revisit = F.coalesce(revisit, F.lit(False))
    light = F.when(~revisit, F.col("payload"))  # of a revisit only length and digest are written
    rows = roles.select("page_id", "url", light.alias("payload"), F.octet_length("payload").alias("n_bytes"), "digest", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))
    return written(rows.mapInArrow(_writer(folder), "path string, records long, bytes long"), "archives", f"{folder}-listed")


def _reader(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        for batch in batches:
            for path, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with fs.open_input_file(f"{base}/{path}") as f:
                    data = f.read()
                rows = [row(r) for r in records(data)]
                if n is not None and len(rows) != n:
                    raise WarcError(f"{path} has {len(rows)} records, not {n}")
                yield pa.RecordBatch.from_pylist(rows, schema=RECORD_SCHEMA)

    return run


def read_archives(listed: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record of the listed archives (path, records)."""
    tasks = max(1, listed.sparkSession.sparkContext.defaultParallelism, listed.count() // 8)
    return listed.select("path", "records").repartition(tasks).mapInArrow(_reader(folder), RECORD_DDL)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write new archives in the shared folder and read them back."""
    folder = new_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)
