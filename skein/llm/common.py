"""Shared pieces of the corpus operators: table access, sizing, and array code over packed UTF-8 text.

The array code works on one ``uint8`` buffer that holds many documents end to end, with an
``int64`` array of boundaries, so that nothing loops over rows, words or bytes in Python.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that ends a word: 0x20 and 0x09 to 0x0D.
SEP = np.zeros(256, dtype=bool)
SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

UPPER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_AZ = UPPER_AZ.lower()

#: Bytes that the array code handles at once; temporaries take about 40 times as many.
SLAB = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Python workers get small batches, by rows and by bytes: a batch of long documents must fit beside its temporaries."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def texts(docs: DataFrame) -> DataFrame:
    """Only doc_id and text; a null text is empty.  Other columns, whatever their names, are dropped."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def size_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the bytes of a table; no job runs."""
    n = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return n if n < 1 << 60 else 0


def parts(df: DataFrame, each: int = 8 << 20) -> int:
    """Number of shuffle partitions: the session's, or more where a partition would pass ``each`` bytes."""
    conf = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(conf, -(-size_bytes(df) // each))


def shared(spark: SparkSession) -> str:
    """The folder that the cluster shares; where none is set and the master is local, as in tests, a new one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        now = spark.sparkContext._jsc.sc().getCheckpointDir()
        if now.isEmpty() and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = now.get() if now.isDefined() else tempfile.mkdtemp(prefix="skein-")
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(named)
    return named


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder."""
    shared(df.sparkSession)
    return df.checkpoint()


def _folder(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def ensure_folder(spark: SparkSession, *paths: str) -> None:
    """Make folders that a partitioned write left out for want of rows."""
    for p in paths:
        fs, at = _folder(spark, p)
        fs.mkdirs(at)


def delete(spark: SparkSession, *paths: str) -> None:
    """Delete tables in the shared folder that nothing reads any more."""
    for p in paths:
        fs, at = _folder(spark, p)
        fs.delete(at, True)


class Scratch:
    """Tables in the shared folder that cut the lineage, and are deleted as soon as nothing reads them any more."""

    def __init__(self, spark: SparkSession, kind: str):
        self.spark, self.folder, self.made = spark, f"{shared(spark)}/{kind}-{uuid.uuid4().hex}", {}

    def save(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{len(self.made)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.made[path] = out
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete these tables, and let Spark delete shuffle files that only finished jobs have read."""
        delete(self.spark, *(p for p, df in self.made.items() if any(df is t for t in tables)))
        release(self.spark)


def release(spark: SparkSession) -> None:
    """Let go of shuffle files of finished jobs: Spark deletes them when the driver's garbage is collected, and
    its scheduler holds the last job until there is another."""
    spark.range(1).write.format("noop").mode("overwrite").save()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# ---------------------------------------------------------------- packed text


def packed(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its boundaries, from 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(b: pa.RecordBatch, column: str, limit: int = SLAB):
    """A batch in slices of about ``limit`` bytes of a text column: each with its bytes and boundaries."""
    data, off = packed(b.column(column))
    for i, j in slabs(off, limit):
        yield b.slice(i, j - i), data[off[i] : off[j]], off[i : j + 1] - off[i]


def slabs(off: np.ndarray, limit: int = SLAB):
    """Runs of whole documents of about ``limit`` bytes: pairs of document numbers."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = ~SEP[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first = ink.copy()
    first[1:] &= ~ink[:-1] | edge[1:n]
    last = ink.copy()
    last[:-1] &= ~ink[1:] | edge[1:n]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(off, start, "right") - 1


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASES[seed]))


def powers(n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base of a hash and of its inverse, modulo 2 to the 64."""
    have = _POWERS.get(seed)
    if have is None or len(have[0]) < n:
        m = max(n, 1 << 16)
        base = _BASES[seed]
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(m, b, np.uint64)
            x[0] = 1
            both.append(np.cumprod(x, dtype=np.uint64))
        have = _POWERS[seed] = (both[0], both[1])
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit over all 64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Prefix sums of a polynomial hash over ``values`` (uint64)."""
    pw, _ = powers(len(values), seed)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * pw, out=out[1:])
    return out


def range_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """Mixed hashes of the ranges, equal for equal content whatever its place."""
    _, inv = powers(len(pre), seed)
    return mix((pre[end] - pre[start]) * inv[start] + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, with temporaries of about one slab."""
    out = np.empty(len(start), np.uint64)
    val, i = _values(seed), 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + SLAB, "right")))
        a = start[i]
        pre = prefix(val[data[a : end[j - 1]]], seed)
        out[i:j] = range_hash(pre, start[i:j] - a, end[i:j] - a, seed)
        i = j
    return out


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def shingles(data: np.ndarray, off: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of lower-cased documents, sorted by document and hash: (document, hash).

    A document with fewer words has its whole sequence as its one shingle; without words, none.
    """
    low = LOWER[data]
    s, e, d = words(low, off)
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    pre = prefix(word_hashes(low, s, e), 1)
    counts = np.bincount(d, minlength=len(off) - 1)
    first = np.concatenate(([0], np.cumsum(counts)))
    at = np.arange(len(s))
    whole = at + k <= first[d + 1]
    whole |= (at == first[d]) & (counts[d] < k)
    at = at[whole]
    doc = d[at]
    h = range_hash(pre, at, np.minimum(at + k, first[doc + 1]), 1)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[keep], h[keep]


def crc_of_id(doc_id: int | None) -> int:
    """crc32 of the id as text; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def crc_mod(column, mod: int):
    """The same as a Spark column."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % mod
