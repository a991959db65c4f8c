"""Text quality by a factorisation machine: weights and low-rank pairwise interactions of hashed words, structure and metadata."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm import common

#: Labelled documents that the machine is fitted on, at most.
SAMPLE = 20_000
#: Buckets of hashed words, rank of the interactions, tasks that learn side by side, rounds after which their machines are averaged.
BITS, RANK, TASKS, ROUNDS = 15, 8, 8, 8
#: Passes of a task over a batch of its rows in a round, rows of a step, step length, shrinkage.
PASSES, STEP_ROWS, RATE, RIDGE = 2, 32, 0.1, 1e-5
#: Share of labelled documents held out: crc32 of the id modulo FOLDS is 0.  A document is taken for good from this score on.
FOLDS, GOOD = 5, 0.3
#: Numbers of structure; each also falls into one of BINS buckets.
STRUCTURE = ("bytes", "words", "lines", "word_length", "capitals", "digits", "signs", "other_scripts", "spaces", "sentence_ends", "distinct_words", "commonest_word", "repeated_neighbours", "distinct_lines", "commonest_sign", "words_without_letters")
BINS = 12
#: Columns of documents whose size is an input beside the text.
METADATA = ("n_chars",)


def _width(metadata) -> int:
    n = len(STRUCTURE) + len(metadata)
    return (1 << BITS) + n * (1 + BINS)


def _share(a, b):
    return a / np.maximum(b, 1)


def _tops(doc: np.ndarray, key: np.ndarray, n: int):
    """Pairs (document, key) with their counts; for each document the number of distinct keys and the count of the commonest."""
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    at = np.flatnonzero(first)
    count = np.diff(np.append(at, len(doc)))
    most = np.zeros(n)
    np.maximum.at(most, doc[at], count)
    return doc[at], key[at], count, np.bincount(doc[at], minlength=n), most


def structure(data: np.ndarray, off: np.ndarray):
    """Numbers of structure of each document, between 0 and about 1, and its words: (matrix, document, hash, count)."""
    n, size = len(off) - 1, np.diff(off)
    s, e, d = common.words(data, off)
    hashes = common.word_hashes(common.LOWER[data], s, e)
    total = np.bincount(d, minlength=n)

    def count(mask):
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return sums[off[1:]] - sums[off[:-1]]

    letter = ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 128)
    capital, digit, space = (data >= 65) & (data <= 90), (data >= 48) & (data <= 57), common.SEP[data]
    sign = ~(letter | digit | space)
    letters = np.concatenate(([0], np.cumsum(letter, dtype=np.int64)))
    doc, key, times, distinct, most = _tops(d, hashes, n)
    again = np.zeros(len(d), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (d[1:] == d[:-1])
    # Lines: runs between line feeds.
    cut = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate((off[:-1][size > 0], cut + 1)))
    begin = begin[begin < len(data)]
    of = np.searchsorted(off, begin, "right") - 1
    end = np.minimum(np.append(begin[1:], len(data)), off[of + 1]) if len(begin) else begin
    _, _, _, lines, _ = _tops(of, common.word_hashes(data, begin, end), n)
    all_lines = np.bincount(of, minlength=n)
    at = np.flatnonzero(sign)
    _, _, _, _, top_sign = _tops(np.searchsorted(off, at, "right") - 1, data[at].astype(np.int64), n)
    ascii_letters = count(letter & (data < 128))
    out = np.stack([
        np.log1p(size) / 16, np.log1p(total) / 14, np.log1p(all_lines) / 10, np.minimum(_share(size, total) / 20, 2), _share(count(capital), ascii_letters), _share(count(digit), size), _share(count(sign), size),
        _share(count(data >= 128), size), _share(count(space), size), _share(count((data == 46) | (data == 33) | (data == 63)), total), _share(distinct, total), _share(most, total),
        _share(np.bincount(d, weights=again, minlength=n), total), _share(lines, all_lines), _share(top_sign, size), _share(np.bincount(d, weights=letters[e] == letters[s], minlength=n), total),
    ], axis=1)
    return out, doc, key, times


def features(b: pa.RecordBatch, metadata=METADATA):
    """Sparse rows of a batch: (document, feature, value), sorted by document.

    Words share one unit of length, by the logarithm of their counts; each number stands as it is and as its bin.
    """
    data, off = common.packed(b.column("text"))
    n = len(off) - 1
    m, doc, key, times = structure(data, off)
    told = [np.nan_to_num(b.column(f"meta_{i}").cast(pa.float64()).to_numpy(zero_copy_only=False), nan=-1.0) for i in range(len(metadata))]
    m = np.column_stack([m, *(np.log1p(np.maximum(t, 0)) / 16 - (t < 0) for t in told)])
    bucket = (key >> np.uint64(64 - BITS)).astype(np.int64)
    both, at = np.unique(doc * (1 << BITS) + bucket, return_inverse=True)
    value = np.log1p(np.bincount(at, weights=times, minlength=len(both)))
    doc, bucket = both >> BITS, both & ((1 << BITS) - 1)
    value /= np.sqrt(np.bincount(doc, weights=value * value, minlength=n))[doc]
    k = m.shape[1]
    bins = np.clip((m * BINS).astype(np.int64), 0, BINS - 1)
    base = (1 << BITS) + np.arange(k) * (1 + BINS)
    row = np.repeat(np.arange(n), k)
    doc = np.concatenate((doc, row, row))
    name = np.concatenate((bucket, np.tile(base, n), (base[None, :] + 1 + bins).ravel()))
    value = np.concatenate((value, m.ravel(), np.full(n * k, 0.5)))
    order = np.argsort(doc, kind="stable")
    return doc[order], name[order], value[order]


@dataclass
class Machine:
    """Intercept, weight of each feature, and its factors."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    @staticmethod
    def new(width: int, rank: int = RANK, seed: int = 11) -> Machine:
        return Machine(0.0, np.zeros(width), np.random.default_rng(seed).normal(0, 0.05, (width, rank)))

    def margins(self, doc: np.ndarray, name: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """Linear part and pairwise part: half of the square of the sum less the sum of squares, for each factor."""
        out = self.bias + np.bincount(doc, weights=self.weights[name] * value, minlength=n)
        for f in range(self.factors.shape[1]):
            part = self.factors[name, f] * value
            out += 0.5 * (np.bincount(doc, weights=part, minlength=n) ** 2 - np.bincount(doc, weights=part * part, minlength=n))
        return out

    def learn(self, rows: tuple, labels: np.ndarray, squares: np.ndarray, bias_square: float, seed: int) -> float:
        """One pass of steps on the logistic loss, each feature at the pace of its own past (``squares``)."""
        doc, name, value = rows
        first = np.searchsorted(doc, np.arange(len(labels) + 1))
        order = np.random.default_rng(seed).permutation(len(labels))
        for i in range(0, len(order), STEP_ROWS):
            own = order[i : i + STEP_ROWS]
            at = common.ranges(first[own], first[own + 1] - first[own])
            d, x = np.repeat(np.arange(len(own)), first[own + 1] - first[own]), value[at]
            names, j = np.unique(name[at], return_inverse=True)
            v = self.factors[names]
            part = v[j] * x[:, None]
            sums = np.stack([np.bincount(d, weights=part[:, f], minlength=len(own)) for f in range(v.shape[1])], axis=1)
            z = self.bias + np.bincount(d, weights=self.weights[names][j] * x, minlength=len(own)) + 0.5 * (sums**2).sum(1) - 0.5 * np.bincount(d, weights=(part * part).sum(1), minlength=len(own))
            g = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels[own]
            gx = g[d] * x
            slope = np.empty((len(names), 1 + v.shape[1]))
            slope[:, 0] = np.bincount(j, weights=gx, minlength=len(names)) + RIDGE * self.weights[names]
            for f in range(v.shape[1]):
                slope[:, 1 + f] = np.bincount(j, weights=gx * (sums[d, f] - part[:, f]), minlength=len(names))
            slope[:, 1:] += RIDGE * v
            squares[names] += slope * slope
            step = RATE * slope / np.sqrt(squares[names] + 1e-8)
            self.weights[names] -= step[:, 0]
            self.factors[names] -= step[:, 1:]
            bias_square += g.sum() ** 2
            self.bias -= RATE * g.sum() / np.sqrt(bias_square + 1e-8)
        return bias_square


def _pack(m: Machine) -> bytes:
    return np.concatenate(([m.bias], m.weights, m.factors.ravel())).astype(np.float32).tobytes()


def _unpack(data: np.ndarray, width: int) -> Machine:
    return Machine(float(data[0]), data[1 : 1 + width].copy(), data[1 + width :].reshape(width, -1).copy())


def _read(docs: DataFrame, metadata) -> DataFrame:
    """doc_id, text (null: empty) and the metadata that there is; a column that is not there counts as null."""
    told = [(F.col(c).cast("double") if c in docs.columns else F.lit(None).cast("double")).alias(f"meta_{i}") for i, c in enumerate(metadata)]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *told)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, metadata=METADATA) -> Machine:
    """Fit the machine on at most ``sample`` labelled documents outside the held-out fold, by order of a hash of their ids.

    The sample is turned into features once, in TASKS shares by hash of the text.  In each round every task goes on from the same machine
    over its own share; the machines, each of a fixed size, are averaged by numbers of rows.
    """
    width = _width(metadata)
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    own = own.groupBy("doc_id").agg(F.min("label").alias("label")).where(common.crc_mod(F.col("doc_id"), FOLDS) != 0)
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def rows_of(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                b = whole.slice(i, 256)
                doc, name, value = features(b, metadata)
                first = np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32)
                lists = lambda v, t: pa.ListArray.from_arrays(pa.array(first), pa.array(v, t))
                yield pa.record_batch({"share": b.column("share"), "mark": b.column("mark"), "label": b.column("label"), "names": lists(name, pa.int32()), "parts": lists(value, pa.float32())})

    # At most ``sample`` short rows, so a broadcast; of the rows of one doc_id, however many, one stays.
    told = [c for c in docs.columns if c != "doc_id"]
    sampled = docs.join(F.broadcast(own), "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct(*told)).alias("row")).select("label", "row.*")
    mark = F.xxhash64("text")
    sampled = sampled.withColumn("mark", mark).withColumn("share", F.pmod(mark, F.lit(TASKS)).cast("int"))
    scratch = common.Scratch(docs.sparkSession, "quality")
    rows = scratch.save(sampled.mapInArrow(rows_of, "share int, mark long, label int, names array<int>, parts array<float>"))
    n = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    machine = Machine.new(width)
    if len(n) < 2:
        # Nothing to tell apart: the share of good ones, or one half.
        machine.factors[:] = 0
        machine.bias = 0.0 if not n else (5.0 if 1 in n else -5.0)
        scratch.drop(rows)
        return machine
    machine.bias = float(np.log(n[1] / n[0]))
    dealt = rows.repartition(TASKS, "share").sortWithinPartitions("share", "mark", "label", "names")

    for turn in range(ROUNDS):
        start = _pack(machine)

        def learn(batches, start=start, turn=turn):
            m = _unpack(np.frombuffer(start, np.float32).astype(np.float64), width)
            squares, of_bias, n = np.zeros((width, 1 + RANK)), 0.0, 0
            for b in batches:
                names, parts = b.column("names"), b.column("parts")
                rows = np.repeat(np.arange(b.num_rows), np.diff(names.offsets.to_numpy())), names.flatten().to_numpy(), parts.flatten().to_numpy().astype(np.float64)
                for p in range(PASSES):
                    of_bias = m.learn(rows, b.column("label").to_numpy().astype(np.float64), squares, of_bias, 100 * turn + p)
                n += b.num_rows
            if n:
                yield pa.record_batch({"machine": pa.array([_pack(m)], pa.binary()), "rows": pa.array([n], pa.int64())})

        got = dealt.mapInArrow(learn, "machine binary, rows long").collect()
        got.sort(key=lambda r: (r[1], bytes(r[0])))
        total = sum(r[1] for r in got)
        machine = _unpack(sum(np.frombuffer(r[0], np.float32).astype(np.float64) * (r[1] / total) for r in got), width)
    scratch.drop(rows)
    return machine


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, metadata=METADATA) -> DataFrame:
    """Score whole texts for quality: doc_id, held_out, score (0 to 1, higher: good likelier), predicted (1 if score is 0.3 or more).

    A factorisation machine of second order: every feature has a weight and a few factors, and each pair of features interacts by the inner
    product of their factors.  By the identity of the square of a sum and the sum of squares, a document costs time linear in its
    distinct words.  Features are hashed words of the whole text, numbers of its structure (length, case, signs, repetition, lines) and the
    size that ``metadata`` columns declare; label, language, source and id are none.  It is fitted on at most ``sample`` labelled documents
    outside the held-out fold; every document is scored.

    Null and empty texts get the score of a text without words.  Very long texts are read whole.  Rows of labels that disagree about a document count
    as bad; labels other than 0 and 1 are ignored; without labels of both kinds all documents get one score.  Repeated rows are scored
    each, alike (of those of one labelled doc_id the smallest text is learned from); a null doc_id stays null, and is held out.  Metadata that is null or missing is a value of its own.  Other columns, whatever their names,
    are not read.  An empty table gives an empty table.
    """
    common.prepare(docs.sparkSession)
    docs = _read(docs, metadata)
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample, metadata))

    def run(batches):
        machine = shared.value
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                b = whole.slice(i, 256)
                z = machine.margins(*features(b, metadata), b.num_rows)
                score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                yield pa.record_batch({
                    "doc_id": b.column("doc_id"),
                    "held_out": pa.array([common.crc_of_id(x) % FOLDS == 0 for x in b.column("doc_id").to_pylist()], pa.bool_()),
                    "score": pa.array(score),
                    "predicted": pa.array((score >= GOOD).astype(np.int32)),
                })

    return docs.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
