"""Exact nearest neighbours by block products of int8 codes with error bounds."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm import common

#: Rows of a tile, candidates and queries.
TILE = 4096
QUERY_TILE = 2048
K = 20

_BLOCK = "side int, tile int, ids binary, codes binary, scales binary, errors binary, vectors binary, width int"


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and embedding (array of float, or of double) of the rows that take part."""
    v = F.col(vector)
    if "float" not in dict(embeddings.dtypes)[vector]:
        v = v.cast("array<double>")
    df = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding"))
    v = F.col("embedding")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.where(F.col("vec_id").isNotNull() & v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0))


def exponents(m: np.ndarray) -> np.ndarray:
    """The power of two that is at least the largest component of each row."""
    return np.frexp(np.abs(m).max(axis=1, initial=0))[1].astype(np.int64)


def quantise(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, the scale of each row, and the length of what the codes miss; components are below 1, as rows were divided by a power of two."""
    scale = np.abs(m).max(axis=1) / 127.0
    scale = np.where(scale > 0, scale, 1.0)
    codes = np.rint(m / scale[:, None]).astype(np.int8)
    error = np.sqrt(((m - codes * scale[:, None]) ** 2).sum(axis=1))
    return codes, scale, error


def _blocks(rows: int, side: int):
    """Pack the rows of a task, sorted by vec_id, into blocks of one width; of rows with one vec_id the least vector stays."""

    def pack(tile, width, part):
        ids = np.array([i for i, _ in part], np.int64)
        m = np.array([v for _, v in part])
        wide = m.astype(np.float64)
        codes, scale, error = quantise(np.ldexp(wide, -exponents(wide)[:, None]))
        return {"side": side, "tile": tile, "ids": ids.tobytes(), "codes": codes.tobytes(), "scales": scale.tobytes(), "errors": error.tobytes(), "vectors": m.tobytes(), "width": width}

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        tile = (task.partitionId() if task else 0) * 4096
        held: dict[int, list] = {}
        last = None
        for b in batches:
            for i, v in zip(b.column("vec_id").to_pylist(), b.column("embedding")):
                if i == last:
                    continue
                last = i
                x = v.values.to_numpy(zero_copy_only=False)
                part = held.setdefault(len(x), [])
                part.append((i, x))
                if len(part) == rows:
                    yield pa.RecordBatch.from_pylist([pack(tile, len(x), part)], schema=_SCHEMA)
                    tile += 1
                    held[len(x)] = []
        for width, part in held.items():
            if part:
                yield pa.RecordBatch.from_pylist([pack(tile, width, part)], schema=_SCHEMA)
                tile += 1

    return run


_SCHEMA = pa.schema([("side", pa.int32()), ("tile", pa.int32()), ("ids", pa.binary()), ("codes", pa.binary()), ("scales", pa.binary()), ("errors", pa.binary()), ("vectors", pa.binary()), ("width", pa.int32())])


def _open(row):
    width = row["width"]
    codes = np.frombuffer(row["codes"], np.int8).reshape(-1, width).astype(np.float32)
    get = lambda k, t: np.frombuffer(row[k], t)
    return get("ids", np.int64), codes, get("scales", np.float64), get("errors", np.float64), get("vectors", np.float32 if len(row["vectors"]) == 4 * len(row["codes"]) else np.float64).reshape(-1, width).astype(np.float64)


def survivors(q, c, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile that may be among a query's k largest products, whatever the quantisation hides.

    The product of codes is exact in float32 as long as 127 * 127 * width is below 2 to the 24; wider tiles use float64.
    Products are compared in units of the query's power of two and the tile's largest, so no bound overflows.
    """
    qi, qc, qs, qe, qv = q
    ci, cc, cs, ce, cv = c
    if qc.shape[1] > 1024:
        qc, cc = qc.astype(np.float64), cc.astype(np.float64)
    of_q, of_c = exponents(qv), exponents(cv)
    unit = np.ldexp(1.0, of_c - of_c.max(initial=0))
    cs, ce = cs * unit, ce * unit
    near = (qc @ cc.T).astype(np.float64) * qs[:, None] * cs[None, :]
    q_len = np.sqrt((np.ldexp(qv, -of_q[:, None]) ** 2).sum(1))
    c_len = np.sqrt((np.ldexp(cv, -of_c[:, None]) ** 2).sum(1)) * unit
    slack = qe[:, None] * c_len[None, :] + (q_len + qe)[:, None] * ce[None, :]
    slack += 1e-12 * q_len[:, None] * c_len[None, :]
    low = near - slack
    own = qi[:, None] == ci[None, :]
    low[own] = -np.inf
    if low.shape[1] > k:
        least = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
    else:
        least = np.full(len(qi), -np.inf)
    return np.nonzero((near + slack >= least[:, None]) & ~own)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of rows, in double precision; where components' products overflow, of the rows divided by powers of two."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = (q * c).sum(axis=1)
        odd = np.flatnonzero(~np.isfinite(out))
        if len(odd):
            of_q, of_c = exponents(q[odd]), exponents(c[odd])
            out[odd] = np.ldexp((np.ldexp(q[odd], -of_q[:, None]) * np.ldexp(c[odd], -of_c[:, None])).sum(axis=1), of_q + of_c)
    return out


def best(q, c, k: int):
    """The k best of a tile for each query, products in double precision on the vectors: query row, ids, scores."""
    a, b = survivors(q, c, k)
    if not len(a):
        return
    score = np.empty(len(a))
    for i in range(0, len(a), 1 << 16):
        s = slice(i, i + (1 << 16))
        score[s] = products(q[4][a[s]], c[4][b[s]])
    ids = c[0][b]
    order = np.lexsort((ids, -score, a))
    a, ids, score = a[order], ids[order], score[order]
    first = np.searchsorted(a, np.arange(len(q[0]) + 1))
    for i in range(len(q[0])):
        s = slice(first[i], min(first[i] + k, first[i + 1]))
        if s.start < s.stop:
            yield i, ids[s], score[s]


class Heaps:
    """The k best so far of each query of a tile: (minus score, vec_id), ascending."""

    def __init__(self, q, k: int):
        self.q, self.k = q, k
        self.best: list[list[tuple[float, int]]] = [[] for _ in q[0]]

    def meet(self, c) -> None:
        for a in range(0, len(self.best), 512):
            part = tuple(x[a : a + 512] for x in self.q)
            for i, ids, score in best(part, c, self.k):
                new = zip((-score).tolist(), ids.tolist())
                old = self.best[a + i]
                self.best[a + i] = heapq.nsmallest(self.k, heapq.merge(old, new)) if old else list(new)

    def batch(self) -> pa.RecordBatch:
        some = [i for i, x in enumerate(self.best) if x]
        return pa.record_batch({
            "query_id": pa.array(self.q[0][some]),
            "ids": pa.array([[v for _, v in self.best[i]] for i in some], pa.list_(pa.int64())),
            "scores": pa.array([[-s for s, _ in self.best[i]] for i in some], pa.list_(pa.float64())),
        })


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = K, vector: str = "embedding") -> DataFrame:
    """The k nearest rows of ``embeddings`` by inner product for each row of ``queries``: query_id, rank, vec_id, score.

    Both sides are packed into tiles of int8 codes, floats beside them.  Every pair of a query tile and a group of candidate
    tiles meets in one task; the product of codes with the bounds of its error leaves few pairs, whose scores are computed
    again on the vectors and kept in one heap for each query of a task; heaps merge the tasks' lists.  Nothing is lost to the codes, so recall is 1.

    Vectors that are null, zero, or hold null or non-finite components take no part; vectors of different widths are never compared.
    Components of any size may stand: a product beyond double precision is infinite, and ranks as such.
    A row is never its own neighbour: candidates with the query's vec_id are left out.  Of rows with one vec_id one stays (the
    least vector).  Ties go to the smaller vec_id.  Other columns are not read.  Empty tables give an empty table.
    """
    spark = embeddings.sparkSession
    common.prepare(spark)
    n = common.parts(embeddings)
    c, q = usable(embeddings, vector), usable(queries, vector)

    def tiles(df, rows, side, parts):
        dealt = df.repartition(parts, "vec_id").sortWithinPartitions("vec_id", "embedding")
        return dealt.mapInArrow(_blocks(rows, side), _BLOCK)

    query_parts = max(1, -(-queries.count() // (4 * QUERY_TILE)))
    # A query tile goes to every candidate group, and a candidate tile to every query group.
    across = tiles(q, QUERY_TILE, 0, query_parts).withColumn("row", F.pmod(F.floor(F.col("tile") / 4096), F.lit(query_parts)).cast("int")).withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    down = tiles(c, TILE, 1, n).withColumn("column", F.pmod(F.floor(F.col("tile") / 4096), F.lit(n)).cast("int")).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))))
    met = across.unionByName(down).repartition(n * query_parts, "row", "column").sortWithinPartitions("row", "column", "side", "tile")

    def meet(batches):
        at, held = None, []
        for b in batches:
            for row in b.to_pylist():
                if (row["row"], row["column"]) != at:
                    yield from (h.batch() for _, h in held)
                    at, held = (row["row"], row["column"]), []
                if row["side"] == 0:
                    held.append((row["width"], Heaps(_open(row), k)))
                    continue
                c = _open(row)
                for width, h in held:
                    if width == row["width"]:
                        h.meet(c)
        yield from (h.batch() for _, h in held)

    lists = met.mapInArrow(meet, "query_id long, ids array<long>, scores array<double>")
    lists = lists.repartition(n, "query_id").sortWithinPartitions("query_id")

    def merge(batches):
        def close():
            found = heapq.nsmallest(k, heapq.merge(*lists_)) if lists_ else []
            return pa.record_batch({
                "query_id": pa.array([at] * len(found), pa.int64()),
                "rank": pa.array(range(1, len(found) + 1), pa.int32()),
                "vec_id": pa.array([v for _, v in found], pa.int64()),
                "score": pa.array([-s for s, _ in found], pa.float64()),
            })

        at, lists_ = None, []
        for b in batches:
            for i, ids, scores in zip(*(b.column(x).to_pylist() for x in ("query_id", "ids", "scores"))):
                if i != at:
                    if lists_:
                        yield close()
                    at, lists_ = i, []
                lists_.append([(-s, v) for s, v in zip(scores, ids)])
                if len(lists_) == 64:
                    lists_ = [heapq.nsmallest(k, heapq.merge(*lists_))]
        if lists_:
            yield close()

    return lists.mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
