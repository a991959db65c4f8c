"""Questions and answers between chunks of documents and shards of keys.

Documents are dealt once, by a hash of their id, into chunks of a few megabytes.  A chunk asks each
shard of the key space about its own distinct keys in one packed row, and gets one packed row back.
A key that a third of all documents hold is thus asked about once by each chunk, never once by each
document, and the shuffles carry few, large rows.  All rounds of an operator read the same shuffle
files of the documents, as Spark reuses equal exchanges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm import common

ASK = "chunk int, shard int, keys binary, extra binary"
#: Stored bytes of the documents for each chunk and each shard, and how many there are of each at least.
CHUNK_BYTES, SHARD_BYTES = 5 << 19, 8 << 20
CHUNKS, SHARDS = 16, 8


def chunks_of(docs: DataFrame) -> int:
    """The number of chunks that documents are dealt into."""
    return CHUNKS + common.size_bytes(docs) // CHUNK_BYTES


def deal(docs: DataFrame) -> tuple[DataFrame, int]:
    """Documents with their chunk, dealt out by it; and the number of shards.

    Both numbers follow the size of the input, whatever the number of partitions: rows between chunks and shards
    are at most their product, and at most the number of keys.
    """
    shards = SHARDS + common.size_bytes(docs) // SHARD_BYTES
    chunk = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(chunks_of(docs))).cast("int")
    return docs.withColumn("chunk", chunk).repartition(common.parts(docs), "chunk"), int(shards)


def odd(n: int) -> int:
    """The next prime, so that ids with a common step are dealt evenly."""
    n = int(n)
    while any(n % i == 0 for i in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def ask(dealt: DataFrame, fn: Callable, answers: DataFrame | None = None) -> DataFrame:
    """fn(documents of a chunk, answers to it or None) returns rows of ASK."""
    return _run(dealt, fn, ASK, answers)


def finish(dealt: DataFrame, fn: Callable, schema: str, answers: DataFrame) -> DataFrame:
    return _run(dealt, fn, schema, answers)


def _run(dealt: DataFrame, fn: Callable, schema: str, answers: DataFrame | None) -> DataFrame:
    if answers is None:
        return dealt.groupBy("chunk").applyInArrow(lambda t: fn(t, None), schema)
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(fn, schema)


def answer(asked: DataFrame, fn: Callable, n: int) -> DataFrame:
    """fn(rows of ASK of one shard) returns as many answers, in the same order; dealt out by chunk, once for all readers."""

    def run(t: pa.Table) -> pa.Table:
        keys, extra = t["keys"].to_pylist(), t["extra"].to_pylist()
        out = fn(keys, extra)
        return pa.table({"chunk": t["chunk"], "shard": t["shard"], "keys": pa.array(out, pa.binary()), "extra": pa.nulls(len(keys), pa.binary())})

    parts = max(n, int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return asked.repartition(parts, "shard").groupBy("shard").applyInArrow(run, ASK).repartition(parts, "chunk")


def shard_of(keys: np.ndarray, n: int) -> np.ndarray:
    """The shard of a uint64 key: it never falls as the key grows."""
    return ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def cuts(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each shard's keys begin among sorted keys."""
    return np.searchsorted(shard_of(keys, n), np.arange(n + 1, dtype=np.uint64))


def rows(chunk: int, made: Iterator[tuple[int, bytes, bytes | None]]) -> pa.Table:
    made = list(made)
    return pa.table({
        "chunk": pa.array([chunk] * len(made), pa.int32()),
        "shard": pa.array([m[0] for m in made], pa.int32()),
        "keys": pa.array([m[1] for m in made], pa.binary()),
        "extra": pa.array([m[2] for m in made], pa.binary()),
    })


def joined(answers: pa.Table) -> bytes:
    """A chunk's answers, in the order of the shards."""
    got = sorted(zip(answers["shard"].to_pylist(), answers["keys"].to_pylist(), strict=True))
    return b"".join(k for _, k in got)


def tagged(*answers: DataFrame) -> DataFrame:
    """The answers of several rounds, each row with its round in ``extra``."""
    out = None
    for i, a in enumerate(answers):
        a = a.withColumn("extra", F.lit(str(i).encode()))
        out = a if out is None else out.unionByName(a)
    return out


def of_round(answers: pa.Table, i: int) -> pa.Table:
    return answers.filter(pc.equal(answers["extra"], pa.scalar(str(i).encode(), pa.binary())))


def bits(mask: np.ndarray) -> bytes:
    return mask.astype(np.uint8).tobytes()


def ordered(t: pa.Table) -> pa.Table:
    """A chunk's documents in an order that each round finds again."""
    t = t.append_column("bytes", pc.binary_length(t["text"]))
    return t.sort_by([("doc_id", "ascending"), ("bytes", "ascending"), ("text", "ascending")])
