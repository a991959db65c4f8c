"""Removal of word sequences that occur more than once (count-min prefilter, then exact groups)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skein.llm import common, rounds

WINDOW = 35
GRAM = 8
#: Cells of each of the two rows of a shard's sketch.
WIDTH = 1 << 22

_U = np.uint64


def _read(t: pa.Table):
    t = rounds.ordered(t)
    data, off = common.packed(t["text"])
    s, e, d = common.words(data, off)
    return t, data, off, s, e, d, common.word_hashes(data, s, e)


def _lowest(h: np.ndarray, d: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows, and for each the place of the lowest hash among its grams, the first of equals."""
    n = len(h)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(d[: n - window + 1] == d[window - 1 :])
    g = common.range_hash(common.prefix(h, 1), np.arange(n - gram + 1), np.arange(gram, n + 1), 1)
    place = max(1, int(n).bit_length())
    low = (g >> _U(place) << _U(place)) | np.arange(len(g), dtype=np.uint64)
    width, have = window - gram + 1, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    return start, (low[start] & _U((1 << place) - 1)).astype(np.int64)


def _cells(h: np.ndarray, at: np.ndarray, gram: int, n: int) -> list[np.ndarray]:
    """The cells of grams in the two rows of the sketch."""
    pre = common.prefix(h, 1)
    g = common.range_hash(pre, at, at + gram, 1)
    out = []
    for seed in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        x = common.mix(g ^ _U(seed))
        out.append(rounds.shard_of(x, n) * _U(2 * WIDTH) + (x & _U(WIDTH - 1)))
    out[1] = out[1] + _U(WIDTH)
    return out


def _sketch(window: int, gram: int, n: int):
    """A chunk's partition sketch: the cells of its windows' lowest grams, and whether each was hit again."""

    def run(t: pa.Table, _) -> pa.Table:
        chunk = t["chunk"][0].as_py()
        *_, d, h = _read(t)
        _, at = _lowest(h, d, window, gram)
        cells, count = np.unique(np.concatenate(_cells(h, np.unique(at), gram, n)), return_counts=True)
        cut = np.searchsorted(cells, np.arange(n + 1, dtype=np.uint64) * _U(2 * WIDTH))
        local = (cells % _U(2 * WIDTH)).astype(np.uint32)
        return rounds.rows(chunk, ((i, local[a:b].tobytes(), rounds.bits(count[a:b] > 1)) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if a < b))

    return run


def _merge(keys: list[bytes], extra: list[bytes]) -> list[bytes]:
    """Add the partition sketches of a shard; which cells hold two or more."""
    total = np.zeros(2 * WIDTH, np.uint8)
    cells = [np.frombuffer(k, np.uint32) for k in keys]
    for c, x in zip(cells, extra):
        total[c] = np.minimum(total[c], 2) + 1 + np.frombuffer(x, np.uint8)
    return [rounds.bits(total[c] > 1) for c in cells]


def _flagged(t: pa.Table, got: pa.Table, window: int, gram: int, n: int):
    """The chunk's words, and the hashes of the windows that the sketch takes for repeated."""
    read = _read(t)
    h, d = read[-1], read[-2]
    start, at = _lowest(h, d, window, gram)
    places, back = np.unique(at, return_inverse=True)
    own = _cells(h, places, gram, n)
    cells = np.unique(np.concatenate(own))
    many = np.frombuffer(rounds.joined(got), np.uint8).astype(bool)
    held = [many[np.searchsorted(cells, c)] for c in own]
    start = start[(held[0] & held[1])[back]] if len(start) else start
    keys = common.range_hash(common.prefix(h, 0), start, start + window, 0)
    check = (common.range_hash(common.prefix(h, 1), start, start + window, 1) >> _U(32)).astype(np.uint32)
    return read, start, keys, check


def _distinct(keys: np.ndarray, check: np.ndarray):
    """Sorted distinct keys: their first places, their counts, and each key's number."""
    order = np.lexsort((check, keys))
    k, c = keys[order], check[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    number = np.empty(len(k), np.int64)
    number[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return k[first], c[first], np.diff(np.append(first, len(k))), number


_PAIR = np.dtype([("key", "<u8"), ("check", "<u4")])


def _windows(window: int, gram: int, n: int):
    """The windows that the sketch takes for repeated, each once a chunk, but not those that the chunk itself repeats."""

    def run(t: pa.Table, got: pa.Table) -> pa.Table:
        if not t.num_rows:
            return rounds.rows(0, iter(()))
        chunk = t["chunk"][0].as_py()
        _, _, keys, check = _flagged(t, got, window, gram, n)
        k, c, count, _ = _distinct(keys, check)
        pair = np.empty(len(k), _PAIR)
        pair["key"], pair["check"] = k, c
        cut = rounds.cuts(k, n)
        return rounds.rows(chunk, ((i, pair[a:b].tobytes(), rounds.bits(count[a:b] > 1)) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if a < b))

    return run


def _group(keys: list[bytes], extra: list[bytes]) -> list[bytes]:
    """Exact groups: which windows some chunk holds twice, or two chunks hold."""
    got = [np.frombuffer(k, _PAIR) for k in keys]
    every = np.concatenate(got)
    twice = np.concatenate([np.frombuffer(x, np.uint8) for x in extra])
    _, _, count, number = _distinct(every["key"], every["check"])
    again = np.zeros(len(count), bool)
    again[number[twice.astype(bool)]] = True
    many = (again | (count > 1))[number]
    return [rounds.bits(x) for x in np.split(many, np.cumsum([len(g) for g in got])[:-1])]


def _remove(window: int, gram: int, n: int):
    def run(t: pa.Table, both: pa.Table) -> pa.Table:
        (t, data, off, s, e, d, h), start, keys, check = _flagged(t, rounds.of_round(both, 0), window, gram, n)
        _, _, _, number = _distinct(keys, check)
        many = np.frombuffer(rounds.joined(rounds.of_round(both, 1)), np.uint8).astype(bool)
        start = start[many[number]] if len(start) else start
        hit = np.zeros(len(s) + 1, np.int64)
        np.add.at(hit, start, 1)
        np.add.at(hit, start + window, -1)
        gone = np.cumsum(hit[:-1]) > 0
        n_words = np.bincount(d, minlength=t.num_rows)
        n_removed = np.bincount(d[gone], minlength=t.num_rows)
        return pa.table({
            "doc_id": t["doc_id"],
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept": kept_words(data, s[~gone], e[~gone], d[~gone], t.num_rows),
        })

    return run


def kept_words(data: np.ndarray, s: np.ndarray, e: np.ndarray, d: np.ndarray, n: int) -> pa.Array:
    """For each of n documents its kept words, joined by one space."""
    edge = np.zeros(len(data) + 2, np.int64)
    np.add.at(edge, s, 1)
    np.add.at(edge, e, -1)
    take = np.cumsum(edge[:-1]) > 0
    after = e[:-1][d[1:] == d[:-1]] if len(d) else e
    out = np.append(data, np.uint8(32))
    out[after] = 32
    take[after] = True
    count = np.cumsum(np.concatenate(([0], take)))
    doc_start = np.searchsorted(d, np.arange(n + 1))
    place = np.append(s, len(data))
    off = count[place[doc_start]] if len(s) else np.zeros(n + 1, np.int64)
    return pa.StringArray.from_buffers(n, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(out[take])))


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Remove each word that a repeated window of ``window`` words covers: doc_id, n_words, n_removed, kept.

    A window counts as repeated when its word sequence also starts anywhere else, in its own document too.
    First each chunk sketches its windows: each window is entered under the lowest hash of its ``gram``-word
    grams, which every repeat of the window shares, so the merged count-min sketch (two rows of saturating
    counters, split into shards by hash) never falls below a window's count.  Then only windows whose
    estimate reaches two are grouped, by 96 bits of hash beside the shard, and nothing is lost.

    Null and empty texts have no words.  A document with fewer words than a window keeps them all.
    Repeated rows count as separate documents, even under one doc_id, and a null doc_id is like any other.
    Other columns of the input are not read.  An empty table gives an empty table.
    """
    common.prepare(docs.sparkSession)
    dealt, n = rounds.deal(common.texts(docs))
    seen = rounds.answer(rounds.ask(dealt, _sketch(window, gram, n)), _merge, n)
    asked = rounds.ask(dealt, _windows(window, gram, n), seen)
    both = rounds.tagged(seen, rounds.answer(asked, _group, n))
    return rounds.finish(dealt, _remove(window, gram, n), "doc_id long, n_words long, n_removed long, kept string", both)
