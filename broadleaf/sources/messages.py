"""Message archives as a data source: S10 as a batch with byte ranges and pushed filters, and as a stream by message number.

An archive is a text file of messages in ascending order of their numbers.  Each message
starts with a mark line, `From <number> <time>`, then its headers, an empty line and its
body; body lines that look like a mark, quoted or not, get one more `>`.  An archive's name
has its first and last number and its earliest and latest time, so that a listing of names
is enough for offsets and for pruning.

    read(spark, root)            a batch: one partition for each `rangeBytes` of an archive
    stream(spark, root)          a stream: offsets are message numbers
    write(rows, root)            archives from rows (NUMBERED), one a partition

Messages are numbered by whoever writes them; an archive that comes later must have higher
numbers than those read before, or the stream doesn't see it.  Times are ISO text, so that
they compare as times do.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

NUMBERED = "number long, sent string, sender string, subject string, message_id string, body string"
COLUMNS = [c.split()[0] for c in NUMBERED.split(", ")]
SCHEMA = pa.schema([("number", pa.int64()), *((c, pa.string()) for c in COLUMNS[1:])])
HEADERS = {"Message-ID": "message_id", "From": "sender", "Subject": "subject"}
NAME = re.compile(r"messages-(\d+)-(\d+)-([0-9T]+)-([0-9T]+)-[0-9a-f]+\.mbox$")
MARK = re.compile(rb"^From (\d+) (\S+)$", re.M)
RANGE_BYTES, BATCH_ROWS, READ_BYTES = 8 << 20, 1000, 1 << 20


def store_of(root: str):
    """(file system, path) of a folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def packed_time(sent: str) -> str:
    return re.sub(r"[^0-9T]", "", sent)


@dataclass
class Archive:
    path: str
    size: int
    first: int
    last: int
    since: str
    until: str


def archives(root: str) -> list[Archive]:
    """Archives below a folder by their first number; files of other names aren't any."""
    from pyarrow import fs

    store, base = store_of(root)
    found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
    named = [(f, m) for f in found if (m := NAME.search(f.base_name))]
    return sorted((Archive(f.path, f.size, int(m[1]), int(m[2]), m[3], m[4]) for f, m in named), key=lambda a: (a.first, a.path))


@dataclass
class Range(InputPartition):
    """Messages whose marks start in bytes start to end - 1 of an archive, within bounds of number and packed time."""

    path: str
    start: int
    end: int
    numbers: tuple[int, int]
    times: tuple[str, str]


def ranges(found: Iterable[Archive], size: int, numbers: tuple[int, int], times: tuple[str, str]) -> list[Range]:
    """Ranges of archives that can hold a message within the bounds, both ends included."""
    some = [a for a in found if a.first <= numbers[1] and a.last >= numbers[0] and a.since <= times[1] and a.until >= times[0]]
    return [Range(a.path, s, min(s + size, a.size), numbers, times) for a in some for s in range(0, a.size, size)]


def messages(root: str, part: Range) -> Iterator[tuple[bytes, bytes, bytes]]:
    """Number, time and the rest of each message whose mark starts in the range; no more than a message over the range is read."""
    store, _ = store_of(root)
    with store.open_input_file(part.path) as f:
        f.seek(max(0, part.start - 1))
        lead, data = (b"" if part.start else b"\n"), b""
        at, done = part.start - (1 if part.start else 1), False  # the place in the archive of data's first byte
        data = lead
        mark = None
        while True:
            found = data.find(b"\nFrom ", 1 if mark is not None else 0)
            while found >= 0 and b"\n" in data[found + 1 :]:
                line = MARK.match(data, found + 1)
                if line is None:
                    found = data.find(b"\nFrom ", found + 1)
                    continue
                if mark is not None:
                    yield mark[0], mark[1], data[mark[2] : found + 1]
                at, data = at + found, data[found:]
                if at + 1 >= part.end:
                    return
                line = MARK.match(data, 1)
                mark = (line[1], line[2], line.end() + 1)
                found = data.find(b"\nFrom ", 1)
            if done:
                break
            if mark is None and len(data) > READ_BYTES:  # the end of a message of the range before
                at, data = at + len(data) - READ_BYTES, data[-READ_BYTES:]
            if mark is None and at + 1 >= part.end and found < 0:
                return
            more = f.read(READ_BYTES)
            done = not more
            data += more
        if mark is not None:
            yield mark[0], mark[1], data[mark[2] :]


def parsed(number: bytes, sent: bytes, rest: bytes) -> tuple:
    head, _, body = rest.partition(b"\n\n")
    given = dict(line.split(b": ", 1) for line in head.split(b"\n") if b": " in line)
    values = {c: given.get(h.encode(), b"").decode() for h, c in HEADERS.items()}
    body = re.sub(rb"^>(>*From )", rb"\1", body.removesuffix(b"\n"), flags=re.M).decode("utf-8", "surrogatepass")
    return int(number), sent.decode(), values["sender"], values["subject"], values["message_id"], body


def batches(root: str, part: Range) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for number, sent, rest in messages(root, part):
        if part.numbers[0] <= int(number) <= part.numbers[1] and part.times[0] <= packed_time(sent.decode()) <= part.times[1]:
            rows.append(parsed(number, sent, rest))
            size += len(rest)
        if len(rows) >= BATCH_ROWS or size >= RANGE_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), SCHEMA.types, strict=True)], schema=SCHEMA)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), SCHEMA.types, strict=True)], schema=SCHEMA)


ANY_NUMBER, ANY_TIME = (0, (1 << 63) - 1), ("", "~")


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.size = options["path"], int(options.get("rangebytes", RANGE_BYTES))
        self.numbers, self.times = list(ANY_NUMBER), list(ANY_TIME)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Bounds of number and sent prune archives and messages; Spark applies all filters again."""
        for f in filters:
            column = getattr(f, "attribute", ("",))
            bounds = {("number",): self.numbers, ("sent",): self.times}.get(tuple(column))
            if bounds is not None and isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                given = [v for v in (f.value if isinstance(f, In) else [f.value]) if v is not None]
                given = [packed_time(v) for v in given] if bounds is self.times else given
                if given and not isinstance(f, (LessThan, LessThanOrEqual)):
                    bounds[0] = max(bounds[0], min(given))
                if given and not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    # a given time may be the start of a longer text
                    bounds[1] = min(bounds[1], max(given) + "~" if bounds is self.times else max(given))
            yield f

    def partitions(self) -> list[Range]:
        return ranges(archives(self.root), self.size, tuple(self.numbers), tuple(self.times)) or [Range("", 0, 0, ANY_NUMBER, ANY_TIME)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return batches(self.root, partition) if partition.path else iter(())


class StreamReader(DataSourceStreamReader):
    """Offsets: the number that the next message has at least."""

    def __init__(self, options: dict[str, str]):
        self.root, self.size = options["path"], int(options.get("rangebytes", RANGE_BYTES))

    def initialOffset(self) -> dict:
        return {"next": 0}

    def latestOffset(self) -> dict:
        return {"next": max((a.last + 1 for a in archives(self.root)), default=0)}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return ranges(archives(self.root), self.size, (start["next"], end["next"] - 1), ANY_TIME)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return batches(self.root, partition)

    def commit(self, end: dict) -> None:
        pass


class Messages(DataSource):
    """Options: path, rangeBytes."""

    @classmethod
    def name(cls) -> str:
        return "message_archives"

    def schema(self) -> str:
        return NUMBERED

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(dict(self.options))


def registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(Messages)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def read(spark: SparkSession, root: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    return registered(spark).read.format("message_archives").option("rangeBytes", range_bytes).load(root)


def stream(spark: SparkSession, root: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    return registered(spark).readStream.format("message_archives").option("rangeBytes", range_bytes).load(root)


def write(rows: DataFrame, root: str, n: int) -> DataFrame:
    """Rows (NUMBERED) as n archives at most below root, dealt by number; returns path and messages of each. Header values are one line each."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, base = store_of(root)
        temp, out, seen = f"{base}/.{uuid.uuid4().hex}.tmp", None, 0
        for batch in parts:
            for number, sent, sender, subject, message_id, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    store.create_dir(base, recursive=True)
                    out, first, since, until = store.open_output_stream(temp, compression=None), number, packed_time(sent), packed_time(sent)
                last, seen, since, until = number, seen + 1, min(since, packed_time(sent)), max(until, packed_time(sent))
                line = lambda v: re.sub(r"\s+", " ", v or "")
                head = f"From {number} {sent}\nMessage-ID: {line(message_id)}\nFrom: {line(sender)}\nSubject: {line(subject)}\n\n".encode()
                out.write(head + re.sub(rb"^(>*From )", rb">\1", (body or "").encode("utf-8", "surrogatepass"), flags=re.M) + b"\n")
        if out is not None:
            out.close()
            path = f"{base}/messages-{first}-{last}-{since}-{until}-{TaskContext.get().partitionId():08x}.mbox"  # the same for every attempt
            store.move(temp, path)
            yield pa.RecordBatch.from_pydict({"path": [path], "messages": [seen]}, schema=pa.schema([("path", pa.string()), ("messages", pa.int64())]))

    dealt = rows.select(*COLUMNS).repartitionByRange(n, "number").sortWithinPartitions("number")
    return dealt.mapInArrow(run, "path string, messages long")
