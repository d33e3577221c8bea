"""Web archives as a Spark data source (format ``warc``): read in batches and streams, written with commit.

An archive is a row of records, in ``.warc.gz`` files of gzip members that each hold one
record or more.  Archives are streamed, never held whole.  Large ones are read by several
tasks: a first pass looks for the places where records (in ``.gz`` files: members that begin with one)
start and counts them, a second one reads byte ranges between such places.  Files are listed
and opened through ``pyarrow.fs``, so local paths and the URI schemes Arrow knows
(``hdfs``, ``s3``, ``gs``) all work.
"""

from __future__ import annotations

import fnmatch
import gzip
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

WARC_SCHEMA = "warc_file string, record_no long, url string, content_type string, content binary, error string"
# Rows and bytes of payload that are passed on together.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20
EXTENSIONS = (".warc", ".warc.gz")
#: Archives beyond this size are read by several tasks.
SPLIT_BYTES = 128 << 20
#: A larger record is an error instead of a row, as a value cannot hold it.
MAX_RECORD_BYTES = 1 << 30
#: Bytes that are read from a file, or passed over, at a time.
PIECE = 1 << 20
RECORD = b"WARC/"


@dataclass(frozen=True)
class ArchiveRange(InputPartition):
    """Records that start in [start, stop) of a file, from number ``first`` on; without ``stop`` to its end.

    ``exact``: a record starts at ``start``; else the first one from there on is looked for.
    """

    path: str
    start: int = 0
    stop: int | None = None
    first: int = 1
    exact: bool = True


def _plain(path: str) -> str:
    """Local URIs as plain paths."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def _filesystem(path: str):
    from pyarrow import fs

    path = _plain(path)
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _archive_sizes(path: str, pattern: str, recursive: bool) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change in nanoseconds) of the archives, in the order of their paths; one listing a folder.

    Names below the folder that begin with ``_`` or ``.`` are hidden, such as what a writer has not committed.
    """
    from pyarrow import fs

    path = _plain(path)
    filesystem, root = _filesystem(path)
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    info = filesystem.get_file_info(root)
    if info.type == fs.FileType.File:
        if not root.lower().endswith(EXTENSIONS):
            raise ValueError(f"not a .warc or .warc.gz file: {path}")
        return [(path, info.size, info.mtime_ns)]
    if info.type != fs.FileType.Directory:
        raise ValueError(f"no such file or directory: {path}")
    found = filesystem.get_file_info(fs.FileSelector(root, recursive=recursive))
    shown = lambda p: not any(part[:1] in ("_", ".") for part in p[len(root):].strip("/").split("/"))
    return sorted(
        (scheme + f.path, f.size, f.mtime_ns) for f in found
        if f.type == fs.FileType.File and shown(f.path)
        and f.base_name.lower().endswith(EXTENSIONS)
        and fnmatch.fnmatch(f.base_name, pattern)
    )


class _MemberBytes(io.RawIOBase):
    """The contents of the gzip members from ``start`` on, up to the first at or after ``stop`` that begins with a record."""

    def __init__(self, raw, start: int, stop: int | None):
        self.raw, self.stop = raw, stop
        self.ahead = b""  # Compressed bytes that were read and not used yet.
        self.at = start  # Where they stand in the file.
        self.member = start  # Where the current member starts.
        self.inflater = None
        self.end: int | None = None
        raw.seek(start)

    def readable(self) -> bool:
        return True

    def _more(self) -> bool:
        found = self.raw.read(PIECE)
        self.ahead += found
        return bool(found)

    def _next_member(self) -> bool:
        # Some writers fill up with zeros between members.
        while True:
            filled = len(self.ahead) - len(self.ahead.lstrip(b"\0"))
            self.ahead, self.at = self.ahead[filled:], self.at + filled
            if self.ahead or not self._more():
                break
        if self.ahead and self.stop is not None and self.at >= self.stop:
            while len(self.ahead) < PIECE and self._more():
                pass
            if _begins_record(self.ahead):
                self.end = self.at
                return False
        if not self.ahead:
            self.end = self.at
            return False
        self.member, self.inflater = self.at, zlib.decompressobj(31)
        return True

    def readinto(self, into) -> int:
        while True:
            if self.end is not None:
                return 0
            if self.inflater is None and not self._next_member():
                return 0
            if not self.ahead and not self._more():
                self.inflater, self.end = None, self.at
                raise EOFError("the last member is cut off")
            data, before = self.ahead, len(self.ahead)
            out = self.inflater.decompress(data, len(into))
            self.ahead = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
            self.at += before - len(self.ahead)
            if self.inflater.eof:
                self.inflater = None
            if out:
                into[:len(out)] = out
                return len(out)


def _begins_record(compressed: bytes) -> bool:
    """Whether a gzip member that begins with a record starts here."""
    if not compressed.startswith(b"\x1f\x8b\x08"):
        return False
    try:
        return zlib.decompressobj(31).decompress(compressed, len(RECORD)) == RECORD
    except zlib.error:
        return False


def _first_start(raw, start: int, stop: int | None, zipped: bool) -> int | None:
    """The first place in [start, stop) that looks like the start of a record (in zipped files: of a member with one)."""
    mark, lead = (b"\x1f\x8b\x08", 0) if zipped else (b"\n" + RECORD, 1)
    at = max(0, start - lead)
    raw.seek(at)
    held = b""
    while True:
        found = raw.read(PIECE)
        held += found
        place = held.find(mark)
        while place >= 0:
            if stop is not None and at + place + lead >= stop:
                return None
            if zipped and found and len(held) - place < PIECE // 2:
                break  # Not enough is here to unpack.
            if not zipped or _begins_record(held[place:place + PIECE]):
                return at + place + lead
            place = held.find(mark, place + 1)
        if not found or (stop is not None and place < 0 and at + len(held) >= stop + len(mark)):
            return None
        kept = len(held) - place if place >= 0 else len(mark) - 1
        at, held = at + len(held) - kept, held[len(held) - kept:]


def _headers(stream) -> dict[str, str]:
    """Header lines up to the blank line, names lower-cased."""
    found: dict[str, str] = {}
    while True:
        line = stream.readline()
        if line in (b"\r\n", b"\n", b""):
            return found
        name, sep, value = line.decode("utf-8", "replace").partition(":")
        if sep:
            found.setdefault(name.strip().lower(), value.strip())


def _skip(stream, n: int) -> int:
    """Pass over ``n`` bytes in pieces; returns how many were there."""
    left = n
    while left:
        found = len(stream.read(min(left, PIECE)))
        if not found:
            break
        left -= found
    return n - left


class RangeReader:
    """Records of one range: (headers, block, error).

    Blocks are read for response records only, and for none if ``counting``; others are passed
    over.  After a bad record reading goes on at the next one, after a member that cannot
    be unpacked at the next member with a record.  Once read, ``begin`` and ``end`` are the
    places of the first record and of the one behind the range; both null if none starts in it.
    """

    def __init__(self, part: ArchiveRange, counting: bool = False, max_bytes: int = MAX_RECORD_BYTES):
        self.part, self.counting, self.max_bytes = part, counting, max_bytes
        self.begin: int | None = None
        self.end: int | None = None

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
        filesystem, name = _filesystem(self.part.path)
        zipped = name.lower().endswith(".gz")
        with filesystem.open_input_file(name) as raw:
            at = self.part.start
            if not self.part.exact:
                at = _first_start(raw, at, self.part.stop, zipped)
            self.begin = at
            if at is not None:
                yield from self._members(raw, at) if zipped else self._plain(raw, at)

    def _members(self, raw, at: int | None):
        while at is not None and (self.part.stop is None or at < self.part.stop):
            members = _MemberBytes(raw, at, self.part.stop)
            try:
                yield from self._records(io.BufferedReader(members, PIECE))
                self.end = members.end
                return
            except (EOFError, zlib.error) as e:
                yield {}, b"", f"archive is damaged: {type(e).__name__}"
                at = _first_start(raw, members.member + 1, None, True)
                self.end = raw.size() if at is None else at

    def _plain(self, raw, at: int):
        stream = io.BufferedReader(raw, PIECE)
        stream.seek(at)
        yield from self._records(stream, raw.size())

    def _records(self, stream, size: int | None = None):
        """``size``: bytes of a plain file, in which places are known."""
        whole = True
        while True:
            at = stream.tell() if size is not None else 0
            line = stream.readline(PIECE)
            if size is not None:
                self.end = at
            if not line:
                return
            # A piece of a longer line begins no record.
            fresh, whole = whole, line.endswith(b"\n")
            if not fresh or not line.startswith(RECORD):
                continue
            if size is not None and self.part.stop is not None and at >= self.part.stop:
                return
            head = _headers(stream)
            length = head.get("content-length", "0")
            if not length.isdecimal():
                yield head, b"", f"bad content length: {length}"
                continue
            n = int(length)
            wanted = head.get("warc-type") == "response" and not self.counting
            if wanted and n <= self.max_bytes:
                block = stream.read(n)
                yield head, block, None if len(block) == n else "record is cut off"
                continue
            if size is None:
                there = _skip(stream, n)
            else:
                there = min(n, size - stream.tell())
                stream.seek(there, 1)
            error = f"record of {n} bytes is over the limit" if wanted else None
            yield head, b"", error if there == n else "record is cut off"


def _unchunk(body: bytes) -> bytes:
    out, at = [], 0
    try:
        while True:
            end = body.index(b"\r\n", at)
            size = int(body[at:end].split(b";")[0], 16)
            if size == 0:
                return b"".join(out)
            out.append(body[end + 2:end + 2 + size])
            at = end + 2 + size + 2
    except ValueError:
        return body  # Declared chunked, stored plain.


def _http_payload(block: bytes) -> tuple[str, bytes] | None:
    """(content type, decoded body) of an HTTP response block; None without HTTP headers."""
    import io

    stream = io.BytesIO(block)
    if not stream.readline().startswith(b"HTTP/"):
        return None
    head = _headers(stream)
    body = stream.read()
    if "chunked" in head.get("transfer-encoding", "").lower():
        body = _unchunk(body)
    encoding = head.get("content-encoding", "").lower()
    if encoding in ("gzip", "x-gzip", "deflate"):
        try:
            body = zlib.decompressobj(wbits=47).decompress(body)
        except zlib.error:
            pass  # Declared compressed, stored plain.
    return head.get("content-type", "").lower(), body


_NAMES = ["warc_file", "record_no", "url", "content_type", "content", "error"]


def _rows(part: ArchiveRange, max_records: int = 0, max_bytes: int = MAX_RECORD_BYTES) -> Iterator[tuple]:
    for number, (head, block, error) in enumerate(RangeReader(part, max_bytes=max_bytes), start=part.first):
        if max_records and number > max_records:
            return
        if error is not None:
            yield part.path, number, head.get("warc-target-uri", ""), None, None, error
        elif head.get("warc-type") == "response":
            payload = _http_payload(block)
            if payload is not None:
                yield part.path, number, head.get("warc-target-uri", ""), *payload, None


def _batches(rows: Iterator[tuple]) -> Iterator:
    """Arrow batches of bounded size."""
    import pyarrow as pa

    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[4] or b"")
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], _NAMES)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], _NAMES)


class _Options:
    def __init__(self, options: dict[str, str]):
        self.path = options.get("path", "")
        self.pattern = options.get("pathglobfilter", "*")
        self.recursive = options.get("recursivefilelookup", "false").lower() == "true"
        self.max_records = int(options.get("maxrecords", 0))
        self.max_bytes = int(options.get("maxrecordbytes", MAX_RECORD_BYTES))
        self.ranges = json.loads(options.get("ranges", "null"))
        self.max_files = int(options.get("maxfilespertrigger", 0))
        self.position = options.get("positionpath")

    def read(self, partition: ArchiveRange) -> Iterator:
        return _batches(_rows(partition, self.max_records, self.max_bytes))


class WarcReader(_Options, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        if self.ranges is not None:
            return [ArchiveRange(path, *r) for path, parts in self.ranges.items() for r in parts]
        return [ArchiveRange(p) for p, _, _ in _archive_sizes(self.path, self.pattern, self.recursive)]


class WarcStreamReader(_Options, DataSourceStreamReader):
    """Archives in the order of their time of change, then name, as they arrive.

    An offset names the last archive that has been read.  ``maxFilesPerTrigger`` limits the
    archives of a batch; with ``positionPath`` (a file) a restarted stream keeps to
    the limit from its first batch on.  An archive must be complete when it gets its name.
    """

    def _files(self) -> list[tuple[int, str]]:
        return sorted((changed, path) for path, _, changed in _archive_sizes(self.path, self.pattern, self.recursive))

    @staticmethod
    def _key(offset: dict) -> tuple[int, str]:
        return int(offset["changed"]), offset["file"]

    def initialOffset(self) -> dict:
        self._last = {"changed": "-1", "file": ""}
        return self._last

    def _reached(self) -> dict | None:
        if getattr(self, "_last", None) is None and self.position:
            filesystem, name = _filesystem(self.position)
            if filesystem.get_file_info(name).is_file:
                with filesystem.open_input_stream(name) as f:
                    self._last = json.loads(f.read())
        return getattr(self, "_last", None)

    def latestOffset(self) -> dict:
        files, reached = self._files(), self._reached()
        if reached is not None:
            files = [f for f in files if f > self._key(reached)]
            if not files:
                return reached
            files = files[:self.max_files or None]
        if not files:
            return {"changed": "-1", "file": ""}
        self._last = {"changed": str(files[-1][0]), "file": files[-1][1]}
        return self._last

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [ArchiveRange(path) for changed, path in self._files() if self._key(start) < (changed, path) <= self._key(end)]

    def commit(self, end: dict) -> None:
        if self.position:
            filesystem, name = _filesystem(self.position)
            with filesystem.open_output_stream(name) as f:
                f.write(json.dumps(end).encode())


@dataclass
class _WrittenArchive(WriterCommitMessage):
    name: str
    records: int


class WarcWriter(_Options, DataSourceArrowWriter):
    """Writes rows (url, content_type, content) as response records, one gzip member each, one archive a task.

    Tasks write to a hidden folder; only when all have ended are their archives moved to
    their places, and the former ones go if the output is overwritten.  After a failure
    the hidden folder goes and the output is as it was; archives of attempts that were
    repeated are never moved.  Rows without content are left out.
    """

    def __init__(self, options: dict[str, str], overwrite: bool):
        super().__init__(options)
        self.overwrite, self.run = overwrite, uuid.uuid4().hex

    def _place(self):
        filesystem, root = _filesystem(self.path)
        return filesystem, root.rstrip("/"), f"{root.rstrip('/')}/_writing-{self.run}"

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        filesystem, _, folder = self._place()
        filesystem.create_dir(folder, recursive=True)
        name, n = f"{uuid.uuid4().hex}.warc.gz", 0
        with filesystem.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for batch in iterator:
                for row in batch.select(["url", "content_type", "content"]).to_pylist():
                    if row["content"] is not None:
                        out.write(gzip.compress(_response_record(**row), 6))
                        n += 1
        return _WrittenArchive(name, n)

    def commit(self, messages) -> None:
        filesystem, root, folder = self._place()
        from pyarrow import fs

        filesystem.create_dir(root, recursive=True)
        old = [f.path for f in filesystem.get_file_info(fs.FileSelector(root)) if f.base_name.lower().endswith(EXTENSIONS)]
        written = [m for m in messages if m is not None and m.records]
        for i, m in enumerate(written):
            filesystem.move(f"{folder}/{m.name}", f"{root}/part-{i:05d}-{self.run}.warc.gz")
        for path in old if self.overwrite else ():
            filesystem.delete_file(path)
        self._clear(filesystem, folder)

    def abort(self, messages) -> None:
        filesystem, _, folder = self._place()
        self._clear(filesystem, folder)

    @staticmethod
    def _clear(filesystem, folder: str) -> None:
        from pyarrow import fs

        if filesystem.get_file_info(folder).type == fs.FileType.Directory:
            filesystem.delete_dir(folder)


def _response_record(url: str | None, content_type: str | None, content: bytes) -> bytes:
    block = f"HTTP/1.1 200 OK\r\nContent-Type: {content_type or ''}\r\n\r\n".encode() + content
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {url or ''}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


class WarcDataSource(DataSource):
    """Options: path, pathGlobFilter, recursiveFileLookup, maxRecords, maxRecordBytes; for streams also
    maxFilesPerTrigger and positionPath.

    ``maxRecords`` caps the records read per file, responses or not.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return WARC_SCHEMA

    def _own_options(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema) -> WarcReader:
        return WarcReader(self._own_options())

    def streamReader(self, schema) -> WarcStreamReader:
        return WarcStreamReader(self._own_options())

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self._own_options(), overwrite)


def _register(spark: SparkSession) -> None:
    import sys

    from pyspark import cloudpickle

    # Ship the classes themselves, so workers need no installed package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(WarcDataSource)


def _measured(batches) -> Iterator:
    """Where the records of each range begin and end, and how many there are."""
    import pandas as pd

    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            reader = RangeReader(ArchiveRange(row.path, row.start, row.stop, exact=bool(row.exact)), counting=True)
            n = sum(1 for _ in reader)
            out.append((row.path, row.start, row.stop, reader.begin, reader.end, n))
        yield pd.DataFrame(out, columns=["path", "start", "stop", "begin", "end", "n"]).astype({"begin": "Int64", "end": "Int64"})


def archive_ranges(spark: SparkSession, sizes: dict[str, int], split_bytes: int) -> dict[str, list[list[int]]]:
    """For each archive the ranges (start, stop, number of the first record) that tasks can read on their own.

    Tasks look for the first record of each piece of ``split_bytes`` and count from there.
    The places must join up: a piece that was begun where no record starts (its bytes
    looked like one) is measured again from where the piece before it has ended.  Only
    places and counts come to the driver, a few numbers per piece.
    """
    pieces = {(path, at): (at, min(at + split_bytes, size), at == 0) for path, size in sizes.items() for at in range(0, max(size, 1), split_bytes)}
    known: dict = {}
    wanted = list(pieces)
    while wanted:
        rows = [(path, at, *pieces[path, at]) for path, at in wanted]
        table = spark.createDataFrame(rows, "path string, piece long, start long, stop long, exact boolean").repartition(len(rows))
        found = table.select("path", "start", "stop", "exact").mapInPandas(
            _measured, "path string, start long, stop long, begin long, end long, n long")
        place = {(path, pieces[path, at][0], pieces[path, at][1]): (path, at) for path, at in wanted}
        for r in found.collect():
            known[place[r.path, r.start, r.stop]] = (r.begin, r.end, r.n)
        wanted = []
        for path, size in sizes.items():
            expected = 0
            for at in range(0, max(size, 1), split_bytes):
                start, stop, _ = pieces[path, at]
                begin, end, _ = known[path, at]
                if expected >= stop and stop < size:
                    known[path, at] = (None, None, 0)
                elif begin != expected and expected < stop:
                    pieces[path, at] = (expected, stop, True)
                    wanted.append((path, at))
                    break
                elif begin is not None:
                    expected = end
    out: dict[str, list[list[int]]] = {}
    for path, size in sizes.items():
        number, out[path] = 1, []
        for at in range(0, max(size, 1), split_bytes):
            begin, _, n = known[path, at]
            if n:
                out[path].append([begin, pieces[path, at][1], number])
                number += n
    return out


def read_warc(
    spark: SparkSession,
    path: str,
    pattern: str = "*",
    recursive: bool = False,
    max_records: int | None = None,
    errors: bool = False,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """HTTP responses of the archives under ``path``.

    Archives above ``split_bytes`` are read by several tasks, after a pass that finds and
    numbers their records.  Bad records are passed over; with ``errors`` they are rows
    too, with the column ``error`` and without a payload.
    """
    _register(spark)
    reader = spark.read.format("warc").option("pathGlobFilter", pattern)
    reader = reader.option("recursiveFileLookup", str(recursive).lower())
    if max_records:
        reader = reader.option("maxRecords", str(max_records))
    else:
        sizes = {p: size for p, size, _ in _archive_sizes(path, pattern, recursive)}
        if max(sizes.values(), default=0) > split_bytes:
            reader = reader.option("ranges", json.dumps(archive_ranges(spark, sizes, split_bytes)))
    records = reader.load(path)
    return records if errors else records.where("error is null").drop("error")


def stream_warc(
    spark: SparkSession, path: str, pattern: str = "*", recursive: bool = False, files_per_batch: int | None = None,
    position: str | None = None, errors: bool = False,
) -> DataFrame:
    """HTTP responses of the archives that arrive under ``path``, as a stream, one task an archive; see ``WarcStreamReader``."""
    _register(spark)
    reader = spark.readStream.format("warc").option("pathGlobFilter", pattern)
    reader = reader.option("recursiveFileLookup", str(recursive).lower())
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    if position:
        reader = reader.option("positionPath", position)
    records = reader.load(path)
    return records if errors else records.where("error is null").drop("error")


def write_warc(pages: DataFrame, path: str, url: str = "url", content: str = "content", content_type: str | None = None, mode: str = "overwrite") -> None:
    """Write pages as archives, one for each partition, see ``WarcWriter``."""
    _register(pages.sparkSession)
    kind = F.col(f"`{content_type}`") if content_type else F.lit("text/html; charset=utf-8")
    rows = pages.select(
        F.col(f"`{url}`").cast("string").alias("url"), kind.cast("string").alias("content_type"),
        F.lit(None).cast("string").alias("warc_file"), F.lit(None).cast("long").alias("record_no"),
        F.col(f"`{content}`").cast("binary").alias("content"), F.lit(None).cast("string").alias("error"))
    rows.select("warc_file", "record_no", "url", "content_type", "content", "error").write.format("warc").mode(mode).save(path)
