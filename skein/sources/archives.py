"""Archives of strict CSV: members of ZIP files, rows that keep their place, files that keep what could be read."""

from __future__ import annotations

import csv
import io
import json
import zipfile
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from skein.sources import registry
from skein.sources.records import Scanner, split_records  # noqa: F401

ROWS = "archive string, case_key string, member string, data_row int, record_ref string, names array<string>, fields array<string>, diagnostic string"
_SCHEMA = pa.schema([("archive", pa.string()), ("case_key", pa.string()), ("member", pa.string()), ("data_row", pa.int32()), ("record_ref", pa.string()), ("names", pa.list_(pa.string())), ("fields", pa.list_(pa.string())), ("diagnostic", pa.string())])
BATCH = 4096


def record_ref(member: str, row: int) -> str:
    from urllib.parse import quote

    return f"zip-member:{quote(member, safe='/-._~')}#data-row={row}"


def read_member(raw: bytes, header: list[str] | None):
    """(row, names, fields, diagnostic) of a CSV file: UTF-8 with or without a mark, strict quotes, an exact header.

    Rows of another width keep their fields and get WIDTH_MISMATCH; a failure of the file ends it with FILE_FAILED after the rows before it.
    """
    row = 0
    try:
        reader = csv.reader(io.StringIO(raw.decode("utf-8-sig"), newline=""), strict=True)
        names = next(reader, None)
        if names is None or (header is not None and names != header):
            yield 0, names, None, "HEADER_MISMATCH"
            return
        for row, fields in enumerate(reader, 1):
            yield row, names, fields, None if len(fields) == len(names) else "WIDTH_MISMATCH"
    except (UnicodeDecodeError, csv.Error):
        yield row + 1, None, None, "FILE_FAILED"


#: Bytes of members, as they are once inflated, that one task reads; bytes that it holds at once, besides one record.
RANGE, BLOCK = 32 << 20, 1 << 20


@dataclass
class Members(InputPartition):
    """What one task reads of an archive: members with the range of bytes, inflated, in which its records begin."""

    archive: str
    ranges: list[tuple[str, int, int]]


def _open(path: str):
    where, name = fs.FileSystem.from_uri(path)
    return where.open_input_file(name)


def read_range(stream, header: list[str] | None, start: int, end: int):
    """Rows of ``read_member`` whose records begin in a range of a member's bytes, read as a stream.

    What stands before the range is passed over by the parity of quotes, counted but not parsed, so rows keep their numbers.  Rows end where the member breaks, in whichever
    range that is.  No more than a block and a record is held.
    """
    scan, held, at, row, names = Scanner(), b"", 0, -1, None
    while True:
        block = stream.read(BLOCK)
        ends = scan.feed(block) if block else scan.finish()
        held += block
        whole, base = ends.tolist(), at
        for e in whole:
            row += 1
            first, at_record = row == 0, at
            if not first and (at_record < start or at_record >= end):
                at = e
                if at_record >= end:
                    return
                continue
            if scan.broken is not None and scan.broken < e and not (first and start > 0):
                # Where it breaks before this record, another range has told so.
                if scan.broken >= at_record:
                    yield max(row, 1), None, None, "FILE_FAILED"
                return
            record = held[at_record - base : e - base]
            at = e
            try:
                fields = next(csv.reader(io.StringIO(record.decode("utf-8-sig" if first else "utf-8"), newline=""), strict=True), [])
            except (UnicodeDecodeError, csv.Error):
                yield max(row, 1), None, None, "FILE_FAILED"
                return
            if first:
                names = fields
                if header is not None and names != header:
                    if start == 0:
                        yield 0, names, None, "HEADER_MISMATCH"
                    return
                continue
            yield row, names, fields, None if len(fields) == len(names) else "WIDTH_MISMATCH"
        held = held[at - base :]
        if not block:
            if row < 0 and start == 0:
                yield 0, None, None, "HEADER_MISMATCH"
            return


class ArchiveReader(DataSourceReader):
    """Ranges of members are planned from the archives' directories alone; each task opens its archive and reads its own members."""

    def __init__(self, options):
        self.paths = json.loads(options["paths"])
        self.headers = json.loads(options.get("headers", "null")) or {}
        self.range = int(options.get("range", RANGE))

    def partitions(self) -> list[Members]:
        out = []
        for path in self.paths:
            with _open(path) as f, zipfile.ZipFile(f) as z:
                some: list[tuple[str, int, int]] = []
                size = 0
                for info in sorted((i for i in z.infolist() if i.filename.lower().endswith(".csv")), key=lambda i: i.filename):
                    for start in range(0, max(info.file_size, 1), self.range):
                        if some and size + min(self.range, info.file_size - start) > self.range:
                            out.append(Members(path, some))
                            some, size = [], 0
                        some.append((info.filename, start, min(start + self.range, max(info.file_size, 1))))
                        size += some[-1][2] - start
                if some:
                    out.append(Members(path, some))
        return out or [Members("", [])]

    def read(self, partition: Members):
        if not partition.ranges:
            return
        rows: list[dict] = []
        with _open(partition.archive) as f, zipfile.ZipFile(f) as z:
            for member, start, end in partition.ranges:
                case, _, file = member.rpartition("/")
                with z.open(member) as stream:
                    for n, names, fields, wrong in read_range(stream, self.headers.get(file), start, end):
                        rows.append({"archive": partition.archive, "case_key": case.rpartition("/")[2], "member": member, "data_row": n, "record_ref": record_ref(member, n), "names": names, "fields": fields, "diagnostic": wrong})
                        if len(rows) == BATCH:
                            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                            rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


class ArchiveSource(DataSource):
    """``spark.read.format("skein_archive")``: rows of the CSV members of archives (options paths and headers as JSON, and range in bytes)."""

    @classmethod
    def name(cls) -> str:
        return "skein_archive"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def read_archives(spark: SparkSession, paths: list[str], headers: dict[str, list[str]] | None = None, range_bytes: int = RANGE) -> DataFrame:
    """All rows of the CSV members of the ZIP archives at ``paths`` (URIs that executors can open too); headers: the exact header by file name.

    A task reads some members, or a range of a large one, about ``range_bytes`` in all: none holds an archive or a member.
    """
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("skein_archive").option("paths", json.dumps(paths)).option("headers", json.dumps(headers)).option("range", str(range_bytes)).load()


def inventory(files: DataFrame) -> DataFrame:
    """(path, content) of archives to archive, sha256, member, case_key, known (whether the registry has the file), safe: one row a member."""
    schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("n_bytes", pa.int64())])

    def run(batches):
        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    rows = [{"archive": name, "member": i.filename, "n_bytes": i.file_size} for i in z.infolist() if not i.is_dir()]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    listed = files.select("path", "content").mapInArrow(run, "archive string, member string, n_bytes long")
    digest = files.select(F.col("path").alias("archive"), F.sha2("content", 256).alias("sha256"))
    file, folder = F.substring_index("member", "/", -1), F.element_at(F.split("member", "/"), -2)
    return listed.join(digest, "archive").select("archive", "sha256", "member", "n_bytes", F.when(F.contains("member", F.lit("/")), folder).alias("case_key"), file.isin(*registry.HEADERS).alias("known"), safe_member(F.col("member")).alias("safe"))


def safe_member(member: Column) -> Column:
    """Not empty, not absolute, no drive, no NUL, no step to a parent folder, whichever way the slashes lean."""
    path = F.replace(member, F.lit("\\"), F.lit("/"))
    return (F.length(path) > 0) & ~path.startswith("/") & ~path.rlike("^[A-Za-z]:") & ~F.contains(path, F.lit("\0")) & ~F.array_contains(F.split(path, "/"), "..")


def locate(ref: Column) -> tuple[Column, Column]:
    """The member and the data row that a record reference names; null for anything that is not one."""
    good = r"^zip-member:([A-Za-z0-9/._~%-]+)#data-row=([1-9][0-9]*)$"
    named = F.regexp_extract(ref, good, 1)
    member = F.when(named != "", F.try_url_decode(named))
    safe = F.coalesce(safe_member(member), F.lit(False))
    return F.when(safe, member), F.when(safe, F.regexp_extract(ref, good, 2).try_cast("int"))


def read_contents(files: DataFrame, headers: dict[str, list[str]] | None = None) -> DataFrame:
    """All rows of the CSV members of archives (path, content)."""

    def run(batches):
        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    rows: list[dict] = []
                    for member in sorted(m for m in z.namelist() if m.lower().endswith(".csv")):
                        case, _, file = member.rpartition("/")
                        for n, names, fields, wrong in read_member(z.read(member), (headers or {}).get(file)):
                            rows.append({"archive": name, "case_key": case.rpartition("/")[2], "member": member, "data_row": n, "record_ref": record_ref(member, n), "names": names, "fields": fields, "diagnostic": wrong})
                            if len(rows) == BATCH:
                                yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                                rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return files.select("path", "content").mapInArrow(run, ROWS)
