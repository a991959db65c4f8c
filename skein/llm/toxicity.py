"""Toxicity by a support vector machine on gapped character subsequences, with Nystroem landmarks."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm import common

#: Bounds of the sample that the classifier is fitted on: labelled documents, and instances (words of their sentences) of each class.
SAMPLE, INSTANCES = 20_000, 3_000
LANDMARKS = 192
#: Share of the toxic documents that a marking word must be in; rounds in which the clean words of largest margin join.
MARK, HARD_ROUNDS = 0.01, 2
#: Lengths of the subsequences, each with the longest stretch that one may span; each gap costs a factor.
ORDERS, GAP = ((3, 5), (4, 7)), 0.6
#: Share of labelled documents held out: crc32 of the id modulo FOLDS is 0.
FOLDS = 5

_ALPHABET = 32


def _fold() -> np.ndarray:
    """Letters to 1-26 whatever their case, digits and signs that stand for letters likewise, bytes of other scripts to 27-31, the rest to 0."""
    out = np.zeros(256, np.int64)
    for i in range(26):
        out[65 + i] = out[97 + i] = i + 1
    for sign, letter in zip("013457@$!", "oieastasi"):
        out[ord(sign)] = ord(letter) - 96
    out[128:] = 27 + np.arange(128) % 5
    return out


FOLD = _fold()
_SHAPES = [(p, (0, *c, s), GAP ** (s - p + 1)) for p, longest in ORDERS for s in range(p - 1, longest) for c in combinations(range(1, s), p - 2)]
_SIZE = sum(_ALPHABET**p for p, _ in ORDERS)
_BASE = {3: 0, 4: _ALPHABET**3}


def subsequences(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """For each shape of gapped subsequence: the places where one begins, its number and its weight."""
    sym = FOLD[data]
    stop = np.repeat(end, end - start)
    at = common.ranges(start, end - start)
    for p, shape, weight in _SHAPES:
        i = at[at + shape[-1] < stop]
        number = np.zeros(len(i), np.int64)
        good = np.ones(len(i), bool)
        for o in shape:
            x = sym[i + o]
            number = number * _ALPHABET + x
            good &= x > 0
        yield i[good], number[good] + _BASE[p], weight


def _limit() -> float:
    """The sum of squared weights of a word of 24 letters."""
    return sum(max(24 - shape[-1], 0) * weight * weight for _, shape, weight in _SHAPES)


LIMIT = _limit()


def scale(squares: np.ndarray) -> np.ndarray:
    """The divisor of a word's features: the root of the sum of the squared weights of its subsequences, of at most 24 letters' worth, so
    that what a long word holds is not hidden by its length."""
    return np.sqrt(np.clip(squares, 1e-9, LIMIT))


@dataclass
class Features:
    """Gap-weighted subsequences of instances, sparse: instance, number, value; sorted by instance."""

    n: int
    row: np.ndarray
    number: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(words: list[bytes]) -> Features:
        data = np.frombuffer(b"".join(words), np.uint8)
        off = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
        squares = np.zeros(len(words))
        rows, numbers, values = [], [], []
        for at, number, weight in subsequences(data, off[:-1], off[1:]):
            row = np.searchsorted(off, at, "right") - 1
            squares += np.bincount(row, minlength=len(words)) * weight * weight
            rows.append(row)
            numbers.append(number)
            values.append(np.full(len(row), weight))
        row, number, value = (np.concatenate(x) for x in (rows, numbers, values))
        value /= scale(squares)[row]
        both, at = np.unique(row * _SIZE + number, return_inverse=True)
        return Features(len(words), both // _SIZE, both % _SIZE, np.bincount(at, weights=value, minlength=len(both)))

    def take(self, rows) -> Features:
        begin = np.searchsorted(self.row, np.arange(self.n + 1))
        rows = np.asarray(rows, np.int64)
        at = common.ranges(begin[rows], begin[rows + 1] - begin[rows])
        return Features(len(rows), np.repeat(np.arange(len(rows)), begin[rows + 1] - begin[rows]), self.number[at], self.value[at])

    def times(self, weights: np.ndarray) -> np.ndarray:
        """The inner product of each instance with weights of all subsequences."""
        return np.bincount(self.row, weights=self.value * weights[self.number], minlength=self.n)

    def sum(self, of_row: np.ndarray) -> np.ndarray:
        """Weights of all subsequences: the instances, each times its number."""
        return np.bincount(self.number, weights=self.value * of_row[self.row], minlength=_SIZE)


def kernel(a: Features, b: Features) -> np.ndarray:
    """Inner products of gap-weighted subsequence features."""
    return np.stack([a.times(b.sum(np.eye(1, b.n, j)[0])) for j in range(b.n)], axis=1) if b.n else np.zeros((a.n, 0))


@dataclass
class Model:
    """Weights of the subsequences, and of the document's features: intercept, largest margin, its hits."""

    weights: np.ndarray
    intercept: float
    document: np.ndarray

    def margins(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        total, squares = np.zeros(len(data) + 1), np.zeros(len(data) + 1)
        for at, number, weight in subsequences(data, start, end):
            total[at] += self.weights[number] * weight
            squares[at] += weight * weight
        sums, squares = (np.concatenate(([0.0], np.cumsum(x))) for x in (total, squares))
        return (sums[end] - sums[start]) / scale(squares[end] - squares[start]) + self.intercept


def _newton(x: np.ndarray, grad_hess, start: np.ndarray, steps: int = 60) -> np.ndarray:
    w = start
    for _ in range(steps):
        g, h, cost, again = grad_hess(w)
        step = np.linalg.solve(h, g)
        t = 1.0
        while t > 1e-4 and again(w - t * step) > cost:
            t /= 2
        w = w - t * step
        if np.abs(step).max() * t < 1e-7:
            break
    return w


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Squared-hinge support vector machine in the primal; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    reg = np.full(x.shape[1], ridge)
    reg[-1] = 1e-6

    def cost(w):
        m = np.maximum(0, 1 - y * (x @ w))
        return (weight * m * m).sum() + (reg * w * w).sum()

    def gh(w):
        m = 1 - y * (x @ w)
        on = m > 0
        g = -2 * ((weight * y * m)[on] @ x[on]) + 2 * reg * w
        h = 2 * (x[on] * weight[on, None]).T @ x[on] + 2 * np.diag(reg) + 1e-9 * np.eye(len(w))
        return g, h, cost(w), cost

    return _newton(x, gh, np.zeros(x.shape[1]))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])

    def cost(w):
        z = x @ w
        return (np.logaddexp(0, z) - y * z).sum() + ridge * (w[1:] ** 2).sum()

    def gh(w):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        reg = np.full(len(w), 2 * ridge)
        reg[0] = 1e-9
        return x.T @ (p - y) + reg * w, (x * (p * (1 - p))[:, None]).T @ x + np.diag(reg) + 1e-9 * np.eye(len(w)), cost(w), cost

    return _newton(x, gh, np.zeros(x.shape[1]))


def train_words(toxic: list[tuple[str, float]], clean: list[tuple[str, float]]) -> tuple[np.ndarray, float]:
    """Weights of subsequences and the intercept, from weighted words of toxic and of clean sentences."""
    words = [w.encode() for w, _ in [*toxic, *clean]]
    y = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    c = np.array([v for _, v in [*toxic, *clean]])
    for sign in (1, -1):
        c[y == sign] *= 1000 / max(c[y == sign].sum(), 1e-9)
    f = Features.of(words)
    marks = f.take(np.concatenate([spread(f.take(own), LANDMARKS // 2, own) for own in (np.flatnonzero(y > 0), np.flatnonzero(y < 0))]))
    value, vector = np.linalg.eigh(kernel(marks, marks))
    keep = value > 1e-6 * max(value.max(), 1e-9)
    root = vector[:, keep] / np.sqrt(value[keep])
    w = fit_svm(kernel(f, marks) @ root, y, c)
    return marks.sum(root @ w[:-1]).astype(np.float32), float(w[-1])


def spread(f: Features, n: int, names: np.ndarray) -> np.ndarray:
    """Landmarks far from each other, among all instances of a class: each the first, by weight, least like those already chosen."""
    own = np.sqrt(np.maximum(np.bincount(f.row, weights=f.value**2, minlength=f.n), 1e-12))
    chosen, nearest = [], np.full(f.n, -1.0)
    while len(chosen) < min(n, f.n):
        i = int(np.argmin(np.round(nearest, 3))) if chosen else 0
        chosen.append(i)
        nearest = np.maximum(nearest, f.times(f.sum(np.eye(1, f.n, i)[0])) / own / own[i])
        nearest[i] = np.inf
    return names[chosen]


def _spaced(s: np.ndarray, e: np.ndarray, d: np.ndarray):
    """Words, runs of single characters that one separator parts taken for one: insults may be spelled with gaps."""
    one = e - s == 1
    more = np.zeros(len(s), bool)
    more[1:] = one[1:] & one[:-1] & (s[1:] == e[:-1] + 1) & (d[1:] == d[:-1])
    first = np.flatnonzero(~more)
    return s[first], e[np.append(first[1:], len(s))[: len(first)] - 1], d[first]


def _document_words(b, lower: bool = False):
    """Distinct words of a batch, packed, with pairs (document, word)."""
    data, off = common.packed(b.column("text"))
    s, e, d = _spaced(*common.words(data, off))
    ink = np.zeros(len(data) + 1, np.int32)
    np.add.at(ink, s, 1)
    np.add.at(ink, e, -1)
    body = data[np.cumsum(ink[:-1]) > 0]
    body = common.LOWER[body] if lower else body
    ends = np.concatenate(([0], np.cumsum(e - s))).astype(np.int64)
    column = pa.LargeStringArray.from_buffers(len(s), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(body))).dictionary_encode()
    code = column.indices.to_numpy() if len(s) else np.zeros(0, np.int64)
    words, off = common.packed(column.dictionary)
    pairs = np.unique(d * max(1, len(off) - 1) + code)
    return column.dictionary, words, off, pairs // max(1, len(off) - 1), pairs % max(1, len(off) - 1), len(b.column("text"))


def document_features(model: Model, b) -> np.ndarray:
    """For each document its largest margin, and the logarithm of its number of distinct words with a positive one."""
    _, words, off, doc, code, n = _document_words(b)
    out = np.zeros((n, 2))
    out[:, 0] = -2.0
    if len(off) > 1:
        m = np.clip(model.margins(words, off[:-1], off[1:]), -2, 2)
        np.maximum.at(out[:, 0], doc, m[code])
        out[:, 1] = np.log1p(np.bincount(doc, weights=m[code] > 0, minlength=n))
    return out


def scores(model: Model, b) -> np.ndarray:
    z = model.document[0] + document_features(model, b) @ model.document[1:]
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _word_counts(batches):
    for b in batches:
        for i in range(0, b.num_rows, 256):
            part = b.slice(i, 256)
            names, _, _, doc, code, _ = _document_words(part, lower=True)
            toxic = part.column("toxic").to_numpy(zero_copy_only=False).astype(float)
            many = np.bincount(code, weights=toxic[doc], minlength=len(names)).astype(np.int64)
            all_ = np.bincount(code, minlength=len(names))
            yield pa.record_batch({"word": names.cast(pa.string()), "bad": pa.array(many), "good": pa.array(all_ - many)})


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit the model on at most ``sample`` labelled documents outside the held-out fold, by order of a hash of their ids."""
    spark = docs.sparkSession
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(common.crc_mod(F.col("doc_id"), FOLDS) != 0)
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.join(own, "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    scratch = common.Scratch(spark, "toxicity")
    rows = scratch.save(rows)
    n = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    empty = Model(np.zeros(_SIZE, np.float32), -1.0, np.array([-5.0, 0.0, 0.0]))
    if len(n) < 2:
        return empty
    counts = rows.mapInArrow(_word_counts, "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counts = scratch.save(counts)
    rate = (F.col("bad") + 0.01) / n[1] / ((F.col("bad") + 0.01) / n[1] + (F.col("good") + 0.5) / n[0])
    least = max(3, round(MARK * n[1]))
    bad = counts.where((F.col("bad") >= least) & (F.col("good") * n[1] * 50 <= F.col("bad") * n[0])).orderBy(F.desc(F.col("bad") * rate), "word").limit(INSTANCES).collect()
    free = counts.where(F.col("good") * n[1] >= F.col("bad") * n[0])
    good = free.orderBy(F.desc("good"), "word").limit(INSTANCES // 3).collect()
    good += free.where(F.col("good") < (good[-1]["good"] if good else 1)).orderBy(F.xxhash64("word"), "word").limit(INSTANCES // 3).collect()
    if not bad or not good:
        return empty
    toxic = [(r["word"], float(r["bad"])) for r in bad]
    clean = {r["word"]: float(r["good"]) ** 0.25 for r in good}
    for _ in range(HARD_ROUNDS):
        model = Model(*train_words(toxic, list(clean.items())), empty.document)

        def margin(batches, model=model):
            for b in batches:
                data, off = common.packed(b.column("word"))
                yield pa.record_batch({"word": b.column("word"), "margin": pa.array(model.margins(data, off[:-1], off[1:]))})

        hard = free.select("word").mapInArrow(margin, "word string, margin double").orderBy(F.desc("margin"), "word").limit(INSTANCES // 3).collect()
        clean |= {r["word"]: 2.0 for r in hard if r["margin"] > -0.9}
    model = Model(*train_words(toxic, list(clean.items())), empty.document)

    def measure(batches):
        for b in batches:
            f = document_features(model, b)
            yield pa.record_batch({"a": pa.array(f[:, 0]), "b": pa.array(f[:, 1]), "toxic": b.column("toxic").cast(pa.float64())})

    got = rows.mapInArrow(measure, "a double, b double, toxic double").toPandas().to_numpy()
    model.document = fit_logistic(got[:, :2], got[:, 2])
    scratch.drop(rows, counts)
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Score whole texts for toxicity: doc_id, held_out, score (0 to 1), predicted (1 if score is 0.5 or more).

    Words of the labelled documents' sentences are compared by a string kernel over gapped subsequences of three and four
    characters, so an insult with inserted or exchanged characters, or single characters with spaces, stays near itself.  Of toxic documents,
    the words that mark them, of clean ones, all words can be instances (``INSTANCES`` a class at most, of ``sample`` documents);
    a Nystroem map on landmarks among all instances feeds a support vector machine.  As the kernel is an inner product of features, the machine is one weight for each
    subsequence, and a document's score is a logistic function of its largest word margin and its number of hits.
    Words and texts of any length are read whole.  Label, language, source and id are no inputs.  Rows of labels that disagree about a
    document count as toxic; of words of one weight the smaller goes first.  Null and empty texts get the score of a text without words.  Repeated rows
    are scored each; a null doc_id stays null.  Labels other than 0 and 1 are ignored; without labels of both kinds nothing is
    predicted toxic.  Other columns are not read.  An empty table gives an empty table.
    """
    common.prepare(docs.sparkSession)
    docs = common.texts(docs)
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))

    def run(batches):
        model = shared.value
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                b = whole.slice(i, 256)
                score = scores(model, b)
                yield pa.record_batch({
                    "doc_id": b.column("doc_id"),
                    "held_out": pa.array([common.crc_of_id(x) % FOLDS == 0 for x in b.column("doc_id").to_pylist()], pa.bool_()),
                    "score": pa.array(score),
                    "predicted": pa.array((score >= 0.5).astype(np.int32)),
                })

    return docs.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``score_toxicity`` would not predict to be toxic."""
    common.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(common.texts(docs), labels, sample))

    def run(batches):
        model = shared.value
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                b = whole.slice(i, 256)
                yield b.filter(pa.array(scores(model, b) < 0.5))

    return docs.mapInArrow(run, docs.schema)
