"""Canonical JSON lines with a manifest, written once and verified; archives and appended files that are the same bytes each time."""

from __future__ import annotations

import hashlib
import io
import uuid
import zipfile

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.operators.tables import Tables

#: Records of one part file at most: a part is read whole when it is verified.
PART = 1_000_000
#: Fixed time of all members of an archive.
STAMP = (1980, 1, 1, 0, 0, 0)


def _plain(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        raise TypeError("binary floating point has no canonical form: cast to decimal")
    if isinstance(kind, T.DecimalType):
        return value.cast("string")
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*(_plain(value[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name))))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _plain(x, kind.elementType))
    return value


def canonical_json(df: DataFrame) -> DataFrame:
    """One column ``value``: each row as compact JSON with sorted keys, nulls kept, decimals as text."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    return df.select(F.to_json(F.struct(*(_plain(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields)), {"ignoreNullFields": "false"}).alias("value"))


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _digests(spark: SparkSession, path: str) -> DataFrame:
    """file, sha256, n_records of the parts."""

    def run(batches):
        for b in batches:
            names = [p.rpartition("/")[2] for p in b.column("path").to_pylist()]
            raw = b.column("content").to_pylist()
            yield pa.RecordBatch.from_pydict({"file": names, "sha256": [hashlib.sha256(x).hexdigest() for x in raw], "n_records": pa.array([x.count(b"\n") for x in raw], pa.int64())})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records").select("path", "content")
    return files.mapInArrow(run, "file string, sha256 string, n_records long")


def write_once(df: DataFrame, path: str, order: list[str]) -> None:
    """Write canonical JSON lines in the order of the columns, and a manifest of their digests; a path that is there already is refused."""
    spark = df.sparkSession
    fs, at = _fs(spark, path)
    if fs.exists(at):
        raise FileExistsError(path)
    canonical_json(df.orderBy(*order)).write.option("maxRecordsPerFile", PART).text(f"{path}/records")
    _digests(spark, path).coalesce(1).write.json(f"{path}/manifest")


def verify(spark: SparkSession, path: str) -> DataFrame:
    """file, violation: MISSING_FILE, EXTRA_FILE, CHECKSUM_MISMATCH or COUNT_MISMATCH against the manifest; no rows if all is well."""
    told = spark.read.schema("file string, sha256 string, n_records long").json(f"{path}/manifest")
    both = told.alias("t").join(_digests(spark, path).alias("o"), F.col("t.file") == F.col("o.file"), "full")
    wrong = F.when(F.col("o.file").isNull(), "MISSING_FILE").when(F.col("t.file").isNull(), "EXTRA_FILE").when(F.col("t.n_records") != F.col("o.n_records"), "COUNT_MISMATCH").when(F.col("t.sha256") != F.col("o.sha256"), "CHECKSUM_MISMATCH")
    return both.select(F.coalesce("t.file", "o.file").alias("file"), wrong.alias("violation")).where("violation is not null")


def _add(z: zipfile.ZipFile, name: str, content: bytes) -> None:
    info = zipfile.ZipInfo(name, STAMP)
    info.compress_type, info.external_attr, info.create_system = zipfile.ZIP_DEFLATED, 0o644 << 16, 0
    z.writestr(info, content)


def archive_bytes(members: dict[str, bytes]) -> bytes:
    """A ZIP file that depends on its members' names and bytes alone."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name in sorted(members):
            _add(z, name, members[name])
    return out.getvalue()


def pack_archives(members: DataFrame) -> DataFrame:
    """(archive, member, content) to (path, content, sha256), one ZIP for each archive; an archive is held in one task's memory."""

    def run(t: pa.Table) -> pa.Table:
        raw = archive_bytes(dict(zip(t["member"].to_pylist(), t["content"].to_pylist())))
        return pa.table({"path": [t["archive"][0].as_py()], "content": pa.array([raw], pa.binary()), "sha256": [hashlib.sha256(raw).hexdigest()]})

    return members.select("archive", "member", "content").groupBy("archive").applyInArrow(run, "path string, content binary, sha256 string")


def write_archives(members: DataFrame, folder: str) -> DataFrame:
    """Write (archive, member, content) as ZIP files in a folder that executors can open: path, sha256, n_members.

    Members come sorted and go into the file one after another, so a task holds one member.  A file gets its name when it is whole: a task that is tried again writes
    the same bytes anew.
    """
    schema = pa.schema([("path", pa.string()), ("sha256", pa.string()), ("n_members", pa.int64())])

    def run(batches):
        where, base = fs.FileSystem.from_uri(folder)
        where.create_dir(base, recursive=True)
        at, n, out, z, digest = None, 0, None, None, None

        def close():
            z.close()
            out.close()
            where.move(f"{base}/{at}.{token}", f"{base}/{at}")
            return pa.RecordBatch.from_pylist([{"path": f"{folder.rstrip('/')}/{at}", "sha256": digest.hexdigest(), "n_members": n}], schema=schema)

        token = uuid.uuid4().hex
        for b in batches:
            for archive, member, content in zip(*(b.column(c).to_pylist() for c in ("archive", "member", "content"))):
                if archive != at:
                    if at is not None:
                        yield close()
                    at, n, digest = archive, 0, hashlib.sha256()
                    out = where.open_output_stream(f"{base}/{at}.{token}")
                    z = zipfile.ZipFile(_Watched(out, digest), "w", zipfile.ZIP_DEFLATED)
                _add(z, member, content)
                n += 1
        if at is not None:
            yield close()

    sorted_ = members.select("archive", "member", "content").repartition("archive").sortWithinPartitions("archive", "member")
    made = sorted_.mapInArrow(run, "path string, sha256 string, n_members long")
    return Tables(members.sparkSession).save(made)


class _Watched(io.RawIOBase):
    """A stream that is written once, from its start to its end, with the digest of what went by."""

    def __init__(self, out, digest):
        self.out, self.digest = out, digest

    def writable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return False

    def write(self, data) -> int:
        self.digest.update(data)
        self.out.write(bytes(data))
        return len(data)


def csv_line(*fields: Column) -> Column:
    """One CSV record without its end; fields are quoted where they must be, and null is empty."""
    text = [F.coalesce(f.cast("string"), F.lit("")) for f in fields]
    return F.concat_ws(",", *(F.when(t.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(t) for t in text))


def append_records(original: Column, records: Column) -> Column:
    """The original bytes of a file as they are, then the records (an array of binary); a line end goes before them only where one is missing."""
    end = F.encode(F.lit("\r\n"), "UTF-8")
    tail = F.substring(original, -1, 1)
    gap = F.when((F.length(original) == 0) | tail.isin(F.encode(F.lit("\n"), "UTF-8"), F.encode(F.lit("\r"), "UTF-8")), F.lit(b"")).otherwise(end)
    more = F.aggregate(records, F.lit(b""), lambda acc, x: F.concat(acc, x, end))
    return F.when(F.size(records) > 0, F.concat(original, gap, more)).otherwise(original)


