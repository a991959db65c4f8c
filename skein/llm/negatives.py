"""Hard negatives in score windows: product quantisation bounds every score, exact integer products complete each window."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm import common
from skein.llm.vectors import EXACT, LONG, clipped, finite, floats, greatest, integers, rows_of, scaled

POSITIVES, NEGATIVES = 5, 3
#: A negative's score, times 100, lies between these parts of the positive's.
LOW, HIGH = 50, 95
#: Rows that the codebooks are fitted on, at most; codewords of a codebook; components that one codeword stands for; rounds of fitting.
SAMPLE, WORDS, SPAN, FIT_ROUNDS = 4096, 256, 2, 6
#: Spans that share a residual norm.
JOINT = 4
#: Rows of an index tile; anchors that meet one at a time; anchors that share a task, and bytes of index that do.
TILE, ANCHORS, GROUP = 2048, 128, 4096
COLUMN = 32 << 20

_INDEX = "tile long, width int, kind string, ids binary, nameless binary, labels binary, codes binary, norms binary, vectors binary"
_FIELDS = ("ids", "nameless", "labels", "codes", "norms", "vectors")


def usable(embeddings: DataFrame, vector: str, label) -> DataFrame:
    """vec_id, label and embedding of the rows that take part."""
    df = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), floats(embeddings, vector).alias("embedding"))
    return df.where(F.col("label").isNotNull() & finite(F.col("embedding")))


# ---------------------------------------------------------------- codebooks


def _spans(width: int, span: int):
    return [slice(i, min(i + span, width)) for i in range(0, width, span)]


def _lloyd(x: np.ndarray, words: int) -> np.ndarray:
    """Codewords for one span: rounds of nearest codeword and mean, from distinct rows spread over the sample."""
    first = np.unique(x, axis=0)
    book = first[np.linspace(0, len(first) - 1, min(words, len(first))).astype(int)] if len(first) else np.zeros((1, x.shape[1]))
    for _ in range(FIT_ROUNDS if len(x) > len(book) else 0):
        near = _nearest(x, book)
        count = np.bincount(near, minlength=len(book))
        total = np.stack([np.bincount(near, weights=x[:, j], minlength=len(book)) for j in range(x.shape[1])], axis=1)
        book = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], book)
    return book


def _nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(1)[None, :] - 2 * (x @ book.T)).argmin(axis=1)


def fit(vectors: DataFrame, sample: int = SAMPLE, words: int = WORDS, span: int = SPAN) -> dict[int, list[np.ndarray]]:
    """Codebooks by width, from at most ``sample`` rows, by order of a hash: one for each span of components."""
    rows = vectors.orderBy(F.xxhash64("vec_id", "embedding"), "embedding").limit(sample).select("embedding").collect()
    by: dict[int, list] = {}
    for (v,) in rows:
        m = scaled(np.array(v, np.float64))
        if m.dtype != object and greatest(m) < 1 << 62:
            by.setdefault(len(m), []).append(m)
    return {width: [_lloyd(np.array(m)[:, s], words) for s in _spans(width, span)] for width, m in by.items()}


# ---------------------------------------------------------------- index


def _pack(tile: int, width: int, ids, nameless, labels, vectors: np.ndarray, books, span: int) -> dict:
    """A tile: codes and residual norms of spans beside the integers; of integers beyond 2 to the 62 the floats are held."""
    m = scaled(vectors)
    huge = m.dtype == object or greatest(m) >= 1 << 62
    spans = _spans(width, span)
    codes, norms = np.zeros((len(ids), len(spans)), np.uint8), np.zeros((len(ids), -(-len(spans) // JOINT)), np.float32)
    if huge:
        kind, body = "f8", vectors
    else:
        kind = next(k for k in ("i1", "i2", "i4", "i8") if greatest(m) < 1 << (8 * int(k[1]) - 1))
        body = m.astype(kind)
        books = books.get(width, [np.zeros((1, s.stop - s.start)) for s in spans])
        missed = np.zeros(norms.shape)
        for j, s in enumerate(spans):
            codes[:, j] = _nearest(m[:, s], books[j])
            missed[:, j // JOINT] += ((m[:, s] - books[j][codes[:, j]]) ** 2).sum(axis=1)
        # Rounded up, so that they stay bounds; lengths beyond a float32 are infinite, which bounds nothing.
        with np.errstate(over="ignore"):
            norms = np.nextafter((np.sqrt(missed) * (1 + 1e-9)).astype(np.float32), np.float32(np.inf))
    row = dict(zip(_FIELDS, (ids, nameless, labels, codes, norms, body)))
    return {"tile": tile, "width": width, "kind": kind} | {k: np.ascontiguousarray(v).tobytes() for k, v in row.items()}


def index(vectors: DataFrame, books, span: int) -> DataFrame:
    """All rows in tiles of one width, in the partitions in which they are read: no id or label gathers rows."""

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        tile = (task.partitionId() if task else 0) << 32
        held: dict[int, list] = {}
        schema = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]) for c in _INDEX.split(", ")])

        def close(width):
            nonlocal tile
            part = [np.concatenate(x) for x in zip(*held.pop(width))]
            tile += 1
            return pa.RecordBatch.from_pylist([_pack(tile - 1, width, *part, books, span)], schema=schema)

        for b in batches:
            flat, off = rows_of(b.column("embedding"))
            ids = b.column("vec_id")
            columns = ids.fill_null(LONG).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), b.column("label").to_numpy()
            widths = np.diff(off)
            for width in np.unique(widths).tolist():
                own = np.flatnonzero(widths == width)
                m = flat[(off[own][:, None] + np.arange(width)[None, :])]
                for i in range(0, len(own), TILE):
                    at = own[i : i + TILE]
                    held.setdefault(width, []).append((*(c[at] for c in columns), m[i : i + TILE]))
                    if sum(len(x[0]) for x in held[width]) >= TILE:
                        yield close(width)
        for width in list(held):
            yield close(width)

    return vectors.mapInArrow(run, _INDEX)


class Tile:
    """An index tile opened."""

    def __init__(self, row: dict):
        width = row["width"]
        get = lambda k, t: np.frombuffer(row[k], t)
        self.tile, self.width, self.huge = row["tile"], width, row["kind"] == "f8"
        self.ids, self.nameless, self.labels = get("ids", np.int64), get("nameless", bool), get("labels", np.int64)
        n = len(self.ids)
        self.codes, self.norms = get("codes", np.uint8).reshape(n, -1), get("norms", np.float32).reshape(n, -1)
        body = get("vectors", row["kind"]).reshape(n, width)
        self.vectors = integers(scaled(body)) if self.huge else body.astype(np.float64) if greatest(body) < EXACT else body.astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows as longs, exactly; those beyond a long become the nearest that it holds."""
    bound = a.shape[1] * greatest(a) * greatest(b)
    if bound < EXACT:
        return np.einsum("ij,ij->i", a.astype(np.float64), b.astype(np.float64)).astype(np.int64)
    if bound <= LONG:
        return (a.astype(np.int64) * b.astype(np.int64)).sum(axis=1)
    return clipped((integers(a).astype(object) * integers(b).astype(object)).sum(axis=1))


class Bounds:
    """Lookup tables of some anchors: lower and upper bounds of their scores with any tile of their width."""

    def __init__(self, anchors: np.ndarray, books, span: int):
        self.width = anchors.shape[1]
        spans = _spans(self.width, span)
        books = books.get(self.width, [np.zeros((1, s.stop - s.start)) for s in spans])
        self.huge = anchors.dtype == object or greatest(anchors) >= 1 << 62
        if not self.huge:
            a = anchors.astype(np.float64)
            self.tables = [a[:, s] @ b.T for s, b in zip(spans, books)]
            self.lengths = np.zeros((len(a), -(-len(spans) // JOINT)))
            for j, s in enumerate(spans):
                self.lengths[:, j // JOINT] += (a[:, s] ** 2).sum(axis=1)
            self.lengths = np.sqrt(self.lengths)
            self.books = [np.sqrt((b * b).sum(axis=1)) for b in books]

    def of(self, c: Tile) -> tuple[np.ndarray, np.ndarray]:
        """By Cauchy and Schwarz in each group of spans, with room for the rounding of the tables."""
        if self.huge or c.huge:
            shape = (self.n if self.huge else len(self.lengths), len(c.ids))
            return np.full(shape, -np.inf), np.full(shape, np.inf)
        near = np.zeros((len(self.lengths), len(c.ids)))
        size = c.norms.astype(np.float64)
        for j, t in enumerate(self.tables):
            near += t[:, c.codes[:, j]]
            size[:, j // JOINT] += 1e-12 * self.books[j][c.codes[:, j]]
        with np.errstate(invalid="ignore"):
            slack = np.nan_to_num(self.lengths @ size.T, nan=np.inf, posinf=np.inf)
        slack += 1e-9 * (slack + np.abs(near)) + 1e-6
        # Scores are clipped to longs, so their bounds are too: beyond, ids decide.
        return np.clip(near - slack, -(2.0**63), 2.0**63), np.clip(near + slack, -(2.0**63), 2.0**63)


class Best:
    """The first ``most`` (score, id) so far of each list, with the least score that may still enter."""

    def __init__(self, n: int, most: int):
        self.most, self.rows, self.least = most, [[] for _ in range(n)], np.full(n, -np.inf)

    def offer(self, who: np.ndarray, score: np.ndarray, nameless: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids, nameless, -score.astype(object) if (score == -LONG - 1).any() else -score, who))
        who, score, nameless, ids = who[order], score[order], nameless[order], ids[order]
        begin = np.flatnonzero(np.append(True, who[1:] != who[:-1])) if len(who) else []
        for i, j in zip(begin, np.append(begin[1:], len(who))):
            j = min(j, i + self.most)
            new = list(zip((-score[i:j].astype(object)).tolist(), nameless[i:j].tolist(), ids[i:j].tolist()))
            rows = sorted(self.rows[who[i]] + new)[: self.most]
            self.rows[who[i]] = rows
            if len(rows) == self.most:
                self.least[who[i]] = -float(rows[-1][0])


class Search:
    """Anchors of one width in a task, against tile after tile."""

    def __init__(self, row: dict, books, span: int):
        self.a = Tile(row)
        self.at = np.frombuffer(row["places"], np.int64)
        self.parts = [slice(i, i + ANCHORS) for i in range(0, len(self.at), ANCHORS)]
        self.bounds = []
        for p in self.parts:
            b = Bounds(self.a.vectors[p], books, span)
            b.n = len(self.at[p])
            self.bounds.append(b)

    def scores(self, p: slice, i: np.ndarray, c: Tile, j: np.ndarray):
        for k in range(0, len(i), 1 << 16):
            s = slice(k, k + (1 << 16))
            yield s, products(self.a.vectors[p][i[s]], c.vectors[j[s]])

    def other(self, p: slice, c: Tile) -> np.ndarray:
        """Pairs of different rows."""
        return (self.at[p][:, None] != np.arange(len(c.ids))[None, :]) if c.tile == self.a.tile else np.ones((len(self.at[p]), len(c.ids)), bool)


def _told(rows) -> list[dict]:
    return [{"score": -s, "nameless": n, "id": v} for s, n, v in rows]


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k] if values.shape[1] >= k else np.full(len(values), -np.inf)


class Positives(Search):
    """The first rows of each anchor's label."""

    def __init__(self, row, books, span, most):
        super().__init__(row, books, span)
        self.best = Best(len(self.at), most)

    def meet(self, c: Tile) -> None:
        for p, bounds in zip(self.parts, self.bounds):
            fits = (self.a.labels[p][:, None] == c.labels[None, :]) & self.other(p, c)
            low, high = bounds.of(c)
            least = np.maximum(self.best.least[p], _kth(np.where(fits, low, -np.inf), self.best.most))
            i, j = np.nonzero(fits & (high >= least[:, None]))
            for s, score in self.scores(p, i, c, j):
                self.best.offer(p.start + i[s], score, c.nameless[j[s]], c.ids[j[s]])

    def out(self) -> dict:
        some = [i for i, r in enumerate(self.best.rows) if r]
        return {"tile": [self.a.tile] * len(some), "place": self.at[some].tolist(), "found": [_told(self.best.rows[i]) for i in some]}


class Negatives(Search):
    """The first rows of other labels in each window of an anchor."""

    def __init__(self, row, books, span, most, low, high):
        super().__init__(row, books, span)
        windows = {w["place"]: w["found"] for w in row["windows"]}
        self.windows = [windows.get(p, []) for p in self.at.tolist()]
        self.depth = max((len(w) for w in self.windows), default=0)
        self.floor, self.ceiling, self.best = [], [], []
        for d in range(self.depth):
            score = [w[d]["score"] if d < len(w) else None for w in self.windows]
            # Whole numbers n with low * score <= 100 * n <= high * score; none where the anchor has no such positive.
            self.floor.append(clipped([LONG if s is None else -(-low * s // 100) for s in score]))
            self.ceiling.append(clipped([-LONG if s is None else high * s // 100 for s in score]))
            self.best.append(Best(len(self.at), most))

    def meet(self, c: Tile) -> None:
        for p, bounds in zip(self.parts, self.bounds):
            fits = self.a.labels[p][:, None] != c.labels[None, :]
            low, high = bounds.of(c)
            want = np.zeros(fits.shape, bool)
            for d in range(self.depth):
                # As longs turned to floats may be rounded, the ends of a window are moved apart.
                floor, ceiling = (x[d][p].astype(np.float64) for x in (self.floor, self.ceiling))
                floor, ceiling = floor - np.abs(floor) * 1e-15, ceiling + np.abs(ceiling) * 1e-15
                # Scores surely inside: the last of the first ``most`` of them is a floor for all.
                sure = _kth(np.where(fits & (high <= self.ceiling[d][p][:, None]), low, -np.inf), self.best[d].most)
                floor = np.maximum(floor, np.maximum(self.best[d].least[p] * (1 - 1e-15 * np.sign(self.best[d].least[p])), sure))
                want |= (high >= floor[:, None]) & (low <= ceiling[:, None]) & (floor <= ceiling)[:, None]
            i, j = np.nonzero(want & fits)
            for s, score in self.scores(p, i, c, j):
                who = p.start + i[s]
                for d in range(self.depth):
                    ok = np.flatnonzero((score >= self.floor[d][who]) & (score <= self.ceiling[d][who]))
                    self.best[d].offer(who[ok], score[ok], c.nameless[j[s]][ok], c.ids[j[s]][ok])

    def out(self) -> dict:
        name = lambda v, x: None if x else v
        rows = [(self.a.tile, place, d, name(a, x), name(w[d]["id"], w[d]["nameless"]), w[d]["score"], r) for d, best in enumerate(self.best) for place, a, x, w, r in zip(self.at.tolist(), self.a.ids.tolist(), self.a.nameless.tolist(), self.windows, best.rows) if r]
        return dict(zip(("tile", "place", "depth", "anchor_id", "positive_id", "positive_score"), map(list, list(zip(*rows))[:6] if rows else [[]] * 6))) | {"found": [_told(r) for *_, r in rows]}


_FOUND = pa.list_(pa.struct([("score", pa.int64()), ("nameless", pa.bool_()), ("id", pa.int64())]))
_FOUND_SQL = "found array<struct<score: long, nameless: boolean, id: long>>"


def _meet(index_: DataFrame, anchors: DataFrame, groups: int, columns: int, make, schema: pa.Schema, sql: str) -> DataFrame:
    """Every group of anchors meets every column of tiles in one task; what it finds comes out once."""
    extra = [c for c in anchors.columns if c not in index_.columns]
    across = anchors.withColumn("side", F.lit(0)).withColumn("row", F.pmod(F.xxhash64("tile"), F.lit(groups)).cast("int")).withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    down = index_.withColumn("side", F.lit(1)).withColumn("column", F.pmod(F.xxhash64("tile"), F.lit(columns)).cast("int")).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    for c in extra:
        down = down.withColumn(c, F.lit(None).cast(anchors.schema[c].dataType))
    met = across.unionByName(down).repartition(groups * columns, "row", "column").sortWithinPartitions("row", "column", "side", "tile")

    def run(batches):
        at, held = None, []

        def close():
            for s in held:
                got = s.out()
                if got["tile"]:
                    yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in schema], schema=schema)

        for b in batches:
            for row in b.to_pylist():
                if (row["row"], row["column"]) != at:
                    yield from close()
                    at, held = (row["row"], row["column"]), []
                if row["side"] == 0:
                    held.append(make(row))
                    continue
                same = [s for s in held if s.a.width == row["width"]]
                if same:
                    c = Tile(row)
                    for s in same:
                        s.meet(c)
        yield from close()

    return met.mapInArrow(run, sql)


def _first(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The first ``most`` over all tasks for each list, ranked from 1."""
    rows = found.select("*", F.inline("found")).drop("found")
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "nameless", "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(embeddings: DataFrame, anchor=None, label=None, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, vector: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """Hard negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components are floor(256 * x); a score is the integer inner product with the anchor, and the higher comes first, ties by smaller vec_id.
    ``anchor`` tells the anchors (a condition on vec_id, ``vec_id % 50 = 0`` unless given), ``label`` the label.  An anchor's positives are its first
    ``positives`` other rows of its label; for each, the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score are returned.

    All rows are indexed once, in tiles of the partitions that are read (no key gathers the rows of a label): codes of a product quantiser, whose codebooks are fitted on
    at most ``sample`` rows, with the residual norm of each span, and the exact integers.  Lookup tables of the anchors give every score up to the residual
    bound; only rows whose bounds can reach a list's first places, or a window, are scored on the integers, so results are exact whatever the codebooks.
    Anchors, a stated query set, meet all tiles twice: for positives, then within the windows.

    Rows with a null label, a null vector, or null or non-finite components take no part; vectors of different widths are never compared; a row of zero width
    scores 0.  Repeated rows are rows of their own: each is an anchor, and a positive of the other.  A row with a null vec_id can be a positive or a negative (its id
    stays null, after all other ids on ties), and no anchor.  Scores beyond a long count as the nearest long.  Other columns are
    not read.  Empty tables, no anchors, or no row in a window give no rows.
    """
    spark = embeddings.sparkSession
    common.prepare(spark)
    anchor = F.expr("vec_id % 50 = 0") if anchor is None else anchor
    vectors = usable(embeddings, vector, F.col("label") if label is None else label)
    books = fit(vectors, sample)
    scratch = common.Scratch(spark, "negatives")
    tiles = scratch.save(index(vectors, books, SPAN))
    # Of each tile with anchors, the whole tile stands for them, and their places.
    wanted = tiles.mapInArrow(_anchor_ids, "tile long, place long, vec_id long")
    places = wanted.where(F.coalesce(anchor, F.lit(False))).groupBy("tile").agg(F.sort_array(F.collect_list("place")).alias("places"))
    anchors = tiles.join(places, "tile").mapInArrow(_only_anchors, _INDEX + ", places binary")
    anchors = scratch.save(anchors)
    n = anchors.agg(F.sum(F.octet_length("places") / 8)).collect()[0][0] or 0
    groups = max(1, -(-int(n) // GROUP))
    columns = common.parts(tiles, COLUMN)

    schema = pa.schema([("tile", pa.int64()), ("place", pa.int64()), ("found", _FOUND)])
    found = _meet(tiles, anchors, groups, columns, lambda row: Positives(row, books, SPAN, positives), schema, f"tile long, place long, {_FOUND_SQL}")
    best = _first(found, ["tile", "place"], positives)
    entry = F.struct("rank", "score", "nameless", "id")
    lists = best.groupBy("tile", "place").agg(F.sort_array(F.collect_list(entry)).alias("found"))
    windows = scratch.save(lists.groupBy("tile").agg(F.collect_list(F.struct("place", "found")).alias("windows")))

    schema = pa.schema([("tile", pa.int64()), ("place", pa.int64()), ("depth", pa.int32()), ("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("found", _FOUND)])
    found = _meet(tiles, anchors.join(windows, "tile"), groups, columns, lambda row: Negatives(row, books, SPAN, negatives, low, high), schema, f"tile long, place long, depth int, anchor_id long, positive_id long, positive_score long, {_FOUND_SQL}")
    rows = _first(found, ["tile", "place", "depth"], negatives)
    out = scratch.save(rows.select("anchor_id", "positive_id", "rank", F.when(~F.col("nameless"), F.col("id")).alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    scratch.drop(tiles, anchors, windows)
    return out


def _anchor_ids(batches):
    for b in batches:
        for tile, ids, nameless in zip(*(b.column(c).to_pylist() for c in ("tile", "ids", "nameless"))):
            ids = np.frombuffer(ids, np.int64)
            yield pa.record_batch({"tile": pa.array(np.full(len(ids), tile)), "place": pa.array(np.arange(len(ids))), "vec_id": pa.array(ids, mask=np.frombuffer(nameless, bool))})


def _only_anchors(batches):
    """Cut a tile down to its anchors; ``places`` tells where they stood."""
    for b in batches:
        out = []
        for row in b.to_pylist():
            at = np.array(row["places"], np.int64)
            n = len(row["nameless"])
            cut = {k: b"".join(row[k][p * (len(row[k]) // n) : (p + 1) * (len(row[k]) // n)] for p in at.tolist()) for k in _FIELDS}
            out.append(row | cut | {"places": at.tobytes()})
        names = [c.split()[0] for c in _INDEX.split(", ")]
        kinds = {"tile": pa.int64(), "width": pa.int32(), "kind": pa.string()}
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([(k, kinds.get(k, pa.binary())) for k in (*names, "places")]))
