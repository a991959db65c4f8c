"""Removal of repeated lines with levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm import common, rounds

#: Code points that a key must have.
LEAST = 10
#: Runs of a level that are merged into one of the next.
FAN = 2
#: Ranges of doc_id that are added one after another, and how many more each doubling of the input beyond so many bytes makes.
BATCHES, MORE_BEYOND = 4, 1 << 30

#: A line's two hashes, and a document: the first that holds it, or the first of a chunk.
KEY = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8")])

_ASKED = "batch int, shard int, keys binary"
_TOLD = "run boolean, number int, keys binary"


def line_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every line of packed texts; an empty text is one empty line."""
    n = len(off) - 1
    cut = np.flatnonzero(data == 0x0A)
    start = np.concatenate((off[:-1], cut + 1))
    doc = np.concatenate((np.arange(n), np.searchsorted(off, cut, "right") - 1))
    order = np.lexsort((start, doc))
    start, doc = start[order], doc[order]
    last = np.append(doc[1:] != doc[:-1], True) if n else np.zeros(0, bool)
    end = np.where(last, off[doc + 1], np.append(start[1:], 0) - 1) if n else start
    return start, end, doc


def line_keys(low: np.ndarray, start: np.ndarray, end: np.ndarray):
    """The two hashes of lines, stripped of white space at both ends, and which have code points enough.  ``low`` is lower-cased."""
    start, end = start.copy(), end.copy()
    blank = common.SEP[low]
    open_ = np.flatnonzero(start < end)
    for _ in range(16):
        open_ = open_[blank[start[open_]]]
        start[open_] += 1
        open_ = open_[start[open_] < end[open_]]
    if len(open_):
        ink = np.append(np.flatnonzero(~blank), len(low))
        start[open_] = np.minimum(ink[np.searchsorted(ink, start[open_])], end[open_])
    open_ = np.flatnonzero(start < end)
    for _ in range(16):
        open_ = open_[blank[end[open_] - 1]]
        end[open_] -= 1
        open_ = open_[start[open_] < end[open_]]
    if len(open_):
        ink = np.concatenate(([-1], np.flatnonzero(~blank)))
        end[open_] = np.maximum(ink[np.searchsorted(ink, end[open_]) - 1] + 1, start[open_])
    points = np.concatenate(([0], np.cumsum((low & 0xC0) != 0x80, dtype=np.int64)))
    enough = points[end] - points[start] >= LEAST
    h = np.zeros((2, len(start)), np.uint64)
    for seed in (0, 1):
        h[seed, enough] = common.word_hashes(low, start[enough], end[enough], seed)
    return h[0], h[1], enough


def _sorted(keys: np.ndarray) -> np.ndarray:
    """Keys in the order of both hashes and the document; runs that are sorted already are merged."""
    order = np.argsort(keys["h1"], kind="stable")
    h1 = keys["h1"][order]
    if len(keys) > 1 and (h1[1:] == h1[:-1]).any():
        order = np.lexsort((keys["doc"], keys["h2"], keys["h1"]))
    return keys[order]


def _open(column) -> list[np.ndarray]:
    return [np.frombuffer(x, KEY) for x in column.to_pylist()]


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, KEY), *parts])


def find(run: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each of sorted keys stands in a sorted run, or -1."""
    at, end = (np.searchsorted(run["h1"], keys["h1"], side) for side in ("left", "right"))
    out = np.full(len(keys), -1)
    open_ = np.flatnonzero(at < end)
    while len(open_):
        same = run["h2"][at[open_]] == keys["h2"][open_]
        out[open_[same]] = at[open_[same]]
        open_ = open_[~same]
        at[open_] += 1
        open_ = open_[at[open_] < end[open_]]
    return out


def firsts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of sorted keys are the first of equal ones, and the document of that one for each."""
    head = np.ones(len(keys), bool)
    head[1:] = (keys["h1"][1:] != keys["h1"][:-1]) | (keys["h2"][1:] != keys["h2"][:-1])
    return head, keys["doc"][head][np.cumsum(head) - 1] if len(keys) else keys["doc"]


def merge_anti_join(batch: np.ndarray, runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys of a batch that no run holds, with their first documents; those of the batch's rows (key, first document of a chunk) that come after
    the key's first document, and that document of each.  Each run is sorted and holds a key once, with its first document."""
    batch = _sorted(batch)
    head, _ = firsts(batch)
    keys = batch[head]
    first, new = keys["doc"].copy(), np.ones(len(keys), bool)
    for run in runs:
        at = find(run, keys)
        first[at >= 0], new[at >= 0] = run["doc"][at[at >= 0]], False
    first = first[np.cumsum(head) - 1] if len(batch) else first
    late = first < batch["doc"]
    return keys[new], batch[late], first[late]


class LineRuns:
    """Which document held each line first, as sorted runs in a shared folder.

    A run has one row for each shard of the hashes: its keys, sorted, with their first documents.  A batch meets all runs in one merge
    anti-join by shard, and its new keys are a run of level 0; ``fan`` runs of a level are compacted into one of the next.
    A key stands in one run only, since a batch adds none that a run holds.  Batches must come in ascending order of doc_id.
    """

    def __init__(self, spark: SparkSession, folder: str, chunks: int, fan: int = FAN):
        self.spark, self.folder, self.chunks, self.fan = spark, folder, chunks, fan
        self.levels: list[list[str]] = []
        self.made = 0

    def _path(self) -> str:
        self.made += 1
        return f"{self.folder}/step-{self.made}"

    def runs(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("number int, keys binary").parquet(*paths)

    def add(self, asked: DataFrame) -> str:
        """Take a batch (shard, keys: one row for each key and chunk, with the chunk's first document); returns a table of the keys that other chunks held first
        (number: chunk; keys, with the first document of all)."""
        chunks, path = self.chunks, self._path()

        def run(batch: pa.Table, runs: pa.Table) -> pa.Table:
            new, lost, first = merge_anti_join(_joined(_open(batch["keys"])), _open(runs["keys"]))
            shard = (batch if batch.num_rows else runs)["number"][0].as_py()
            out = [(True, shard, new.tobytes())] if len(new) else []
            chunk = lost["doc"] % chunks
            lost["doc"] = first
            order = np.argsort(chunk, kind="stable")
            cut = np.flatnonzero(np.diff(chunk[order], prepend=-1, append=-1))
            out += [(False, int(chunk[order[a]]), lost[order[a:b]].tobytes()) for a, b in zip(cut[:-1], cut[1:])]
            return pa.table({"run": pa.array([x[0] for x in out], pa.bool_()), "number": pa.array([x[1] for x in out], pa.int32()), "keys": pa.array([x[2] for x in out], pa.binary())})

        held = self._read(self.runs()) if self.runs() else self.spark.createDataFrame([], "number int, keys binary")
        batch = asked.select(F.col("shard").alias("number"), "keys")
        batch.groupBy("number").cogroup(held.groupBy("number")).applyInArrow(run, _TOLD).write.partitionBy("run").parquet(path)
        common.ensure_folder(self.spark, f"{path}/run=true", f"{path}/run=false")
        self._push(0, f"{path}/run=true")
        return f"{path}/run=false"

    def _push(self, level: int, path: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) == self.fan:
            old, to = self.levels[level], self._path()

            def compact(t: pa.Table) -> pa.Table:
                return pa.table({"number": t["number"][:1], "keys": pa.array([_sorted(_joined(_open(t["keys"]))).tobytes()], pa.binary())})

            self._read(old).groupBy("number").applyInArrow(compact, "number int, keys binary").write.parquet(to)
            self.levels[level] = []
            common.delete(self.spark, *old)
            self._push(level + 1, to)

    def drop(self) -> None:
        common.delete(self.spark, *self.runs())


def _lines(docs: pa.Table):
    """The documents of a chunk in slices, each with its lines and the keys of those that count."""
    for whole in docs.combine_chunks().to_batches():
        for b, data, off in common.slices(whole, "text"):
            start, end, doc = line_spans(data, off)
            h1, h2, counts = line_keys(common.LOWER[data], start, end)
            counts &= b.column("doc_id").is_valid().to_numpy(zero_copy_only=False)[doc]
            keys = np.empty(int(counts.sum()), KEY)
            keys["h1"], keys["h2"], keys["doc"] = h1[counts], h2[counts], b.column("doc_id").fill_null(0).to_numpy()[doc[counts]]
            yield b, data, start, end, doc, counts, keys


def _ask(cuts: np.ndarray, shards: int):
    """The line keys of a chunk of documents, by batch and shard: however many documents hold a key, it is asked about once, with the first of them."""

    def run(docs: pa.Table) -> pa.Table:
        keys = _joined([x[-1] for x in _lines(docs)])
        batch = np.searchsorted(cuts, keys["doc"])
        order = np.lexsort((keys["doc"], keys["h2"], keys["h1"], batch))
        keys, batch = keys[order], batch[order]
        head = firsts(keys)[0]
        head[1:] |= batch[1:] != batch[:-1]
        keys = keys[head]
        # Shards never fall as hashes grow, so each batch's keys are in the order of shards.
        at = batch[head] * np.int64(shards) + rounds.shard_of(keys["h1"], shards).astype(np.int64)
        cut = np.flatnonzero(np.diff(at, prepend=-1, append=-1))
        return pa.table({
            "batch": pa.array((at[cut[:-1]] // shards).astype(np.int32)),
            "shard": pa.array((at[cut[:-1]] % shards).astype(np.int32)),
            "keys": pa.array([keys[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])], pa.binary()),
        })

    return run


def _drop(docs: pa.Table, lost: pa.Table) -> pa.Table:
    """Texts of one chunk without the lines that an earlier document holds, in the chunk or as answered (keys, first document)."""
    slices = list(_lines(docs))
    told = _open(lost["keys"])
    every = _joined(told + [x[-1] for x in slices])
    order = np.lexsort((every["doc"], every["h2"], every["h1"]))
    late = np.empty(len(every), bool)
    late[order] = firsts(every[order])[1] < every["doc"][order]
    late = late[sum(map(len, told)) :]
    out = {"kept": [], "n_lines": [], "n_dropped": []}
    for b, data, start, end, doc, counts, keys in slices:
        n_lines = np.bincount(doc, minlength=b.num_rows)
        drop = np.zeros(len(doc), bool)
        drop[counts], late = late[: len(keys)], late[len(keys) :]
        n_dropped = np.bincount(doc, weights=drop, minlength=b.num_rows).astype(np.int64)
        stay = np.flatnonzero(~drop)
        last = np.append(doc[stay][1:] != doc[stay][:-1], True)[: len(stay)]
        size = end[stay] - start[stay] + ~last
        kept = data[np.minimum(common.ranges(start[stay], size), max(len(data) - 1, 0))]
        ends = np.cumsum(size)
        kept[ends[~last] - 1] = 0x0A
        off = np.concatenate(([0], np.cumsum(np.bincount(doc[stay], weights=size, minlength=b.num_rows)))).astype(np.int64)
        out["kept"].append(pa.LargeStringArray.from_buffers(b.num_rows, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(kept))).cast(pa.string()))
        out["n_lines"].append(pa.array(n_lines.astype(np.int64)))
        out["n_dropped"].append(pa.array(n_dropped))
    made = {k: pa.chunked_array(v, pa.string() if k == "kept" else pa.int64()) for k, v in out.items()}
    return pa.table({"doc_id": docs["doc_id"], "n_lines": made["n_lines"], "n_dropped": made["n_dropped"], "kept": made["kept"], "carried": docs["carried"]})


def dedup_lines(docs: DataFrame, batches: int | None = None, carry: bool = False) -> DataFrame:
    """Drop each line whose key an earlier document holds: doc_id, n_lines, n_dropped, kept.

    A key is the line without white space at its ends, with A-Z lower-cased; keys of fewer than 10 code
    points never count.  Documents go through ``LineRuns`` in ranges of doc_id (4, and one more for each doubling of the input beyond a
    gigabyte, unless ``batches`` says how many), which gives every document the lines that it loses.

    A null or empty text is one empty line.  Rows with the same doc_id count as one document, so they never
    drop each other's lines; rows without doc_id neither drop nor lose any.  Very long texts and lines are whole.  Other columns, whatever
    their names, are not read; with ``carry`` the whole row comes back in the struct ``carried``.  An empty table gives an empty table.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    size = common.size_bytes(docs)
    if batches is None:
        batches = BATCHES + max(0, (size // MORE_BEYOND).bit_length())
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)) if carry else F.lit(0)
    carried = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), row.alias("carried"))
    docs = common.texts(docs)
    chunks, shards = rounds.odd(rounds.CHUNKS + size // rounds.CHUNK_BYTES), rounds.SHARDS + size // rounds.SHARD_BYTES
    folder = f"{common.shared(spark)}/lines-{uuid.uuid4().hex}"
    cuts = docs.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)).first()[0] if batches > 1 else []
    cuts = np.array(sorted(set(cuts or [])), np.int64)
    named = docs.where("doc_id is not null").withColumn("number", F.pmod("doc_id", F.lit(int(chunks))).cast("int"))
    asked = named.repartition(common.parts(docs), "number").groupBy("number").applyInArrow(_ask(cuts, int(shards)), _ASKED)
    asked.write.partitionBy("batch").parquet(f"{folder}/asked")
    runs, lost = LineRuns(spark, folder, int(chunks)), []
    for i in range(len(cuts) + 1):
        common.ensure_folder(spark, f"{folder}/asked/batch={i}")
        lost.append(runs.add(spark.read.schema("shard int, keys binary").parquet(f"{folder}/asked/batch={i}")))
        common.delete(spark, f"{folder}/asked/batch={i}")
    runs.drop()
    lost = runs._read(lost)
    # Rows without doc_id lose nothing, so they are dealt by their texts.
    chunk = F.pmod(F.coalesce("doc_id", F.xxhash64("text")), F.lit(int(chunks))).cast("int")
    dealt = carried.withColumn("number", chunk).repartition(max(common.parts(docs), 1), "number")
    shape = T.StructType([*T._parse_datatype_string("doc_id long, n_lines long, n_dropped long, kept string").fields, carried.schema["carried"]])

    def run(docs: pa.Table, lost: pa.Table) -> pa.Table:
        return _drop(docs, lost)

    out = dealt.groupBy("number").cogroup(lost.groupBy("number")).applyInArrow(run, shape)
    return out if carry else out.drop("carried")
