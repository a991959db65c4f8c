"""The factorisation machine against brute force, and the classifier on odd rows."""

import math
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa

from skein.llm import quality

DIR = "/root/testdata/sf0.01"


def _batch(*texts):
    return pa.record_batch({"text": pa.array(texts, pa.string()), "meta_0": pa.array([None if t is None else float(len(t)) for t in texts], pa.float64())})


def test_margin_is_the_sum_over_all_pairs():
    b = _batch("a b b. C!", "", "x\nx\ny y y 12 ##", "é " * 30)
    doc, name, value = quality.features(b)
    m = quality.Machine.new(quality._width(quality.METADATA), 3)
    m.bias, m.weights = 0.3, np.random.default_rng(1).normal(0, 1, len(m.weights))
    got = m.margins(doc, name, value, 4)
    for i in range(4):
        own = [(name[k], value[k]) for k in np.flatnonzero(doc == i)]
        want = m.bias + sum(m.weights[j] * x for j, x in own) + sum(float(m.factors[a] @ m.factors[b]) * x * y for (a, x), (b, y) in combinations(own, 2))
        assert math.isclose(got[i], want, rel_tol=1e-9, abs_tol=1e-9)


def test_a_step_goes_down_the_slope():
    """One row, one step: each parameter moves against the numerical slope of its logistic loss, by RATE at most."""
    doc, name, value = quality.features(_batch("one two two THREE"))
    m = quality.Machine.new(quality._width(quality.METADATA), 2)
    loss = lambda m: math.log1p(math.exp(-m.margins(doc, name, value, 1)[0]))
    before, old, j = loss(m), m.factors.copy(), name[0]
    m.factors[j, 0] += 1e-5
    slope = (loss(m) - before) / 1e-5
    m.factors[j, 0] -= 1e-5
    m.learn((doc, name, value), np.array([1.0]), np.zeros((len(m.weights), 3)), 0.0, 0)
    assert loss(m) < before and (m.factors[j, 0] - old[j, 0]) * slope < 0 and abs(m.factors - old).max() <= quality.RATE + 1e-9


def test_structure_counts():
    text = "AB cd 12!\nAB cd 12!\nzz zz zz"
    data = np.frombuffer(text.encode(), np.uint8)
    m = quality.structure(data, np.array([0, len(data)]))[0][0]
    got = dict(zip(quality.STRUCTURE, m))
    want = {"bytes": math.log1p(len(text)) / 16, "words": math.log1p(9) / 14, "lines": math.log1p(3) / 10, "capitals": 4 / 14, "digits": 4 / len(text), "signs": 2 / len(text), "distinct_words": 4 / 9, "commonest_word": 3 / 9, "repeated_neighbours": 2 / 9, "distinct_lines": 2 / 3, "commonest_sign": 2 / len(text), "words_without_letters": 2 / 9, "spaces": 8 / len(text)}
    assert {k: round(got[k], 9) for k in want} == {k: round(v, 9) for k, v in want.items()}


def test_held_out_documents_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.score_quality(docs, labels).collect()}
    assert len(got) == docs.count()
    own = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for i, r in got.items())
    assert sum(q == r.predicted for q, r in own) >= 0.95 * len(own) and len(own) > 50


def test_odd_rows(spark):
    good, bad = ("plain words of a text here. " * 3, "### $$$ !!! ### $$$ " * 5)
    rows = [(i, good + str(i) if i % 2 else bad + str(i), "en", "s", 5, "label", "row") for i in range(1, 80)]
    rows += [(None, good, None, None, None, None, None), (90, None, None, None, None, None, None), (91, "", None, None, 0, None, None), (92, "long " * 400_000, None, None, None, None, None)] + rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, label string, quality string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 80)] + [(1, 0, 1), (3, 7, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(x) == 1 for i, x in by.items()) and [r.held_out for r in got if r.doc_id is None] == [True]
    assert sum(r.predicted == r.doc_id % 2 for r in got if r.doc_id and r.doc_id < 80) >= 70
    one = quality.score_quality(docs, labels.where("quality = 0")).collect()
    assert {r.predicted for r in one} == {0} and {r.predicted for r in quality.score_quality(docs, labels.limit(0)).collect()} == {1}
    assert quality.score_quality(docs.limit(0), labels).count() == 0
    assert quality.score_quality(docs.select("doc_id", "text"), labels).count() == len(rows)
