"""Removal of byte strings that an earlier document holds, by interval expansion on a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skein.llm import common, rounds

LENGTH = 50
#: Bytes of the strings by which equal windows meet; every window holds one, and equal windows the same.
ANCHOR = 24
#: A coarse run has a mean of 2 to the COARSE_BITS windows; COARSE_KEY bytes decide where one begins.
COARSE_BITS, COARSE_KEY = 8, 16
#: Bytes handled at once; temporaries of eight times as many should fit a core's cache.
STRETCH = 1 << 17
#: Chunks that must hold an anchor before its windows are dealt out one by one.
COMMON = 128
#: Bytes of the texts that one transform covers, unless one anchor has more.
BLOCK = 1 << 18
#: A null doc_id comes after all others.
LAST = np.iinfo(np.int64).max

_U = np.uint64


class _Chunk:
    """The packed documents of a chunk."""

    def __init__(self, t: pa.Table, length: int):
        self.t, self.length = rounds.ordered(t), length
        self.chunk = t["chunk"][0].as_py() if t.num_rows else 0
        self.data, self.off = common.packed(self.t["text"])
        self.ids = self.t["doc_id"].combine_chunks().fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)

    def owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, at, "right") - 1

    def coarse(self):
        """Runs of windows between cuts that the content sets: (first window, last, document, hash, check, -)."""
        out = []
        for a, x, valid in _slabs(self.data, self.off, self.length):
            pre, h = _grams(x, COARSE_KEY)
            cut = (h[: len(valid)] >> _U(64 - COARSE_BITS)) == 0
            lo, hi = _bounds(valid, cut)
            out.append((lo + a, hi + a, *_hashes(x, lo, hi + self.length, pre), lo))
        lo, hi, key, check, _ = _joined(out, 5)
        return lo, hi, self.owner(lo), key, check


def _slabs(data: np.ndarray, off: np.ndarray, length: int):
    """Stretches of packed texts: the first byte, the bytes with those of the last windows, and which bytes start a window."""
    for i, j in common.slabs(off, STRETCH):
        for a in range(int(off[i]), int(off[j]), 2 * STRETCH):
            b = min(a + 2 * STRETCH, int(off[j]))
            valid = np.ones(b - a, bool)
            for end in off[np.searchsorted(off, a, "right") : j + 1]:
                valid[max(0, end - length + 1 - a) : max(0, end - a)] = False
                if end >= b + length:
                    break
            if valid.any():
                x = data[a : min(b + length - 1, int(off[j]))]
                yield a, x, valid[: max(0, len(x) - length + 1)]


def _grams(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums, and polynomial hashes of all k-byte strings; only their high bits are well spread."""
    pre = common.prefix(common._values(0)[x])
    return pre, (pre[k:] - pre[:-k]) * common.powers(len(pre) - k)[1]


def _bounds(valid: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last windows of the runs that start where ``cut`` says, or after a gap."""
    start = valid & cut
    start[0] = valid[0]
    start[1:] |= valid[1:] & ~valid[:-1]
    last = valid.copy()
    last[:-1] &= ~valid[1:] | start[1:]
    return np.flatnonzero(start), np.flatnonzero(last)


def _hashes(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, pre: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each range of bytes; pre: the prefix sums of the first, if known."""
    pre = common.prefix(common._values(0)[x]) if pre is None else pre
    return common.range_hash(pre, lo, hi), common.range_hash(common.prefix(common._values(1)[x], 1), lo, hi, 1)


def _joined(out, n):
    if not out:
        return tuple(np.zeros(0, np.int64 if i in (0, 1) else np.uint64) for i in range(n))
    return tuple(np.concatenate(c) for c in zip(*out))


_COARSE = np.dtype([("key", "<u8"), ("check", "<u8"), ("doc", "<i8")])


def _first_of(key, check, doc):
    """Distinct (key, check), sorted, with the least document of each; and each row's number."""
    order = np.lexsort((doc, check, key))
    k, c = key[order], check[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    number = np.empty(len(k), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _ask_coarse(length: int, n: int):
    def run(t: pa.Table, _) -> pa.Table:
        c = _Chunk(t, length)
        _, _, doc, key, check = c.coarse()
        first, _ = _first_of(key, check, c.ids[doc])
        pair = np.empty(len(first), _COARSE)
        pair["key"], pair["check"], pair["doc"] = key[first], check[first], c.ids[doc[first]]
        cut = rounds.cuts(pair["key"], n)
        return rounds.rows(c.chunk, ((i, pair[a:b].tobytes(), None) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if a < b))

    return run


def _least(keys: list[bytes], _) -> list[bytes]:
    """The least document of each coarse run."""
    got = [np.frombuffer(k, _COARSE) for k in keys]
    every = np.concatenate(got)
    first, number = _first_of(every["key"], every["check"], every["doc"])
    out = every["doc"][first][number]
    return [x.tobytes() for x in np.split(out, np.cumsum([len(g) for g in got])[:-1])]


def _open(c: _Chunk, got: pa.Table):
    """Windows by byte that an earlier document's run settles; and first and last windows of the stretches that are open."""
    lo, hi, doc, key, check = c.coarse()
    ids = c.ids[doc]
    _, number = _first_of(key, check, ids)
    least = np.frombuffer(rounds.joined(got), np.int64)
    settled = least[number] < ids if len(ids) else np.zeros(0, bool)
    a, b = lo[~settled], hi[~settled]
    new = np.ones(len(a), bool)
    new[1:] = a[1:] != b[:-1] + 1
    first = np.flatnonzero(new)
    stretches = (a[first], b[np.append(first[1:], len(a)) - 1]) if len(a) else (a, b)
    return _cover(len(c.data), lo[settled], hi[settled] + 1), stretches


def _cover(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, lo, 1)
    np.add.at(edge, hi, -1)
    return np.cumsum(edge[:-1]) > 0


def _fine(c: _Chunk, stretches):
    """Runs of open windows with one anchor: first, last, document, hash, check, and the anchor's hash."""
    first, last = stretches
    size = last - first + c.length
    off = np.concatenate(([0], np.cumsum(size)))
    data = c.data[common.ranges(first, size)]
    out, k, width = [], ANCHOR, c.length - ANCHOR + 1
    for a, x, valid in _slabs(data, off, c.length):
        place = max(1, int(len(x)).bit_length())
        pre, h = _grams(x, k)
        low = (h >> _U(place) << _U(place)) | np.arange(len(h), dtype=np.uint64)
        have = 1
        while have * 2 <= width:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        if have < width:
            low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
        low = low[: len(valid)]
        cut = np.ones(len(valid), bool)
        cut[1:] = low[1:] != low[:-1]
        lo, hi = _bounds(valid, cut)
        q = (low[lo] & _U((1 << place) - 1)).astype(np.int64)
        out.append((lo + a, hi + a, *_hashes(x, lo, hi + c.length, pre), common.mix(h[q] ^ _U(0x94D049BB133111EB))))
    lo, hi, key, check, anchor = _joined(out, 5)
    back = (first - off[:-1])[np.searchsorted(off, lo, "right") - 1] if len(lo) else lo
    return lo + back, hi + back, c.owner(lo + back), key, check, anchor


def _ask_anchors(length: int, n: int):
    def run(t: pa.Table, got: pa.Table) -> pa.Table:
        if not t.num_rows:
            return rounds.rows(0, iter(()))
        c = _Chunk(t, length)
        anchors = np.unique(_fine(c, _open(c, got)[1])[-1])
        cut, low = rounds.cuts(anchors, n), anchors.astype(np.uint32)
        return rounds.rows(c.chunk, ((i, low[a:b].tobytes(), None) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if a < b))

    return run


def _held(keys: list[bytes], _) -> list[bytes]:
    """0: one chunk has the anchor, 1: several, 2: very many."""
    got = [np.frombuffer(k, np.uint32) for k in keys]
    _, number, count = np.unique(np.concatenate(got), return_inverse=True, return_counts=True)
    code = ((count > 1).astype(np.uint8) + (count >= COMMON))[number].astype(np.uint8)
    return [x.tobytes() for x in np.split(code, np.cumsum([len(g) for g in got])[:-1])]


def _doubtful(c: _Chunk, first: pa.Table, second: pa.Table):
    """Settled windows by byte, and the runs whose anchor other documents may hold; common anchors' windows singly."""
    settled, stretches = _open(c, first)
    lo, hi, doc, key, check, anchor = _fine(c, stretches)
    anchors, number = np.unique(anchor, return_inverse=True)
    code = np.frombuffer(rounds.joined(second), np.uint8)
    if not len(lo):
        return settled, (lo, hi, doc, key, check, anchor)
    ids = c.ids[doc]
    least, most = np.full(len(anchors), LAST), np.full(len(anchors), np.iinfo(np.int64).min)
    np.minimum.at(least, number, ids)
    np.maximum.at(most, number, ids)
    wide = code[number] == 2
    some = ((code > 0) | (least < most))[number] & ~wide
    run = [z[some] for z in (lo, hi, doc, key, check, anchor)]
    if wide.any():
        size = (hi - lo + 1)[wide]
        each = np.repeat(np.arange(len(size)), size)
        at = common.ranges(lo[wide], size)
        one, two = _window_hashes(c, at)
        run = [np.concatenate(z) for z in zip(run, (at, at, doc[wide][each], one, two, one))]
    return settled, tuple(run)


def _window_hashes(c: _Chunk, at: np.ndarray):
    """Two hashes of the windows at ascending places."""
    one, two = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
    for a in range(0, len(c.data), STRETCH):
        i, j = np.searchsorted(at, [a, a + STRETCH])
        if i < j:
            one[i:j], two[i:j] = _hashes(c.data[a : a + STRETCH + c.length], at[i:j] - a, at[i:j] - a + c.length)
    return one, two


_RUN = np.dtype([("anchor", "<u8"), ("key", "<u8"), ("doc", "<i8"), ("size", "<u4")])


def _distinct_runs(c: _Chunk, run):
    """Distinct runs sorted by anchor: first places, and each run's number."""
    lo, hi, doc, key, check, anchor = run
    return _first_of(anchor, key ^ check, c.ids[doc])


def _ask_runs(length: int, n: int):
    def run(t: pa.Table, got: pa.Table) -> pa.Table:
        if not t.num_rows:
            return rounds.rows(0, iter(()))
        c = _Chunk(t, length)
        _, own = _doubtful(c, rounds.of_round(got, 0), rounds.of_round(got, 1))
        first, _ = _distinct_runs(c, own)
        lo, hi, doc, key, check, anchor = (z[first] for z in own)
        out = np.empty(len(lo), _RUN)
        single = (anchor == key) & (lo == hi)
        out["anchor"], out["key"], out["doc"], out["size"] = anchor, key ^ check, c.ids[doc], np.where(single, 0, hi - lo + length)
        cut = rounds.cuts(out["anchor"], n)
        ends = np.cumsum(np.concatenate(([0], out["size"].astype(np.int64))))
        text = np.empty(ends[-1], np.uint8)
        at = common.ranges(lo, out["size"].astype(np.int64))
        text[:] = c.data[at]
        return rounds.rows(c.chunk, ((i, out[a:b].tobytes(), text[ends[a] : ends[b]].tobytes()) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if a < b))

    return run


def _settle(length: int):
    """For each run: how many values follow, then those: the least document of the run, or of each of its windows."""

    def run(keys: list[bytes], extra: list[bytes]) -> list[bytes]:
        got = [np.frombuffer(k, _RUN) for k in keys]
        every = np.concatenate(got)
        text = np.frombuffer(b"".join(extra), np.uint8)
        begin = np.cumsum(every["size"].astype(np.int64)) - every["size"]
        first, number = _first_of(every["anchor"], every["key"], every["doc"])
        kind = every[first]
        same = np.zeros(len(kind), bool)
        same[1:] = kind["anchor"][1:] == kind["anchor"][:-1]
        same[:-1] |= same[1:]
        same &= kind["size"] > 0
        count = np.where(same, kind["size"].astype(np.int64) - length + 1, 1)
        place = np.cumsum(count) - count
        least = np.repeat(kind["doc"], count)
        todo = np.flatnonzero(same)
        if len(todo):
            ends = np.cumsum(kind["size"][todo].astype(np.int64))
            group = np.cumsum(np.concatenate(([0], (kind["anchor"][todo][1:] != kind["anchor"][todo][:-1]).astype(int))))
            block = np.maximum.accumulate((ends // BLOCK)[np.searchsorted(group, group)])
            for b in np.unique(block):
                own = todo[block == b]
                pieces = [text[begin[i] : begin[i] + z] for i, z in zip(first[own], kind["size"][own])]
                found = earliest(pieces, kind["doc"][own], length)
                at = common.ranges(place[own], count[own])
                least[at] = found
        out, ends = [], np.cumsum([len(g) for g in got])
        for a, b in zip(ends - [len(g) for g in got], ends):
            mine = number[a:b]
            size = count[mine]
            at = common.ranges(place[mine], size)
            out.append(np.uint32(len(mine)).tobytes() + size.astype(np.uint32).tobytes() + least[at].tobytes())
        return out

    return run


def suffix_order(sym: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` symbols or more (0 to 256), and each one's place."""
    n, have = len(sym), 7
    key = np.zeros(n, np.uint64)
    for i in range(have):
        key <<= _U(9)
        key[: n - i] |= sym[i:].astype(np.uint64)
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
    while have < depth and rank.max(initial=0) < n - 1:
        after = np.zeros(n, np.int64)
        after[: n - have] = rank[have:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        have *= 2
    order = np.argsort(rank, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place


def common_prefixes(sym: np.ndarray, order: np.ndarray, place: np.ndarray, stop: int) -> np.ndarray:
    """Where neighbours in suffix order share fewer than ``stop`` symbols: their number, else -1 (so many or more).

    Breadth-first: level l holds the intervals of strings of l symbols; extending one to the left by a
    symbol c gives the interval of a string of l + 1, and the border at its right end, if no shorter string has set
    it, gets the value l.  Only intervals that set a border are extended again.  Symbol 0 separates texts.
    """
    n = len(sym)
    before = np.where(order > 0, sym[order - 1], 0).astype(np.int64)
    back = place[order - 1]
    out = np.full(n + 1, -1, np.int16)
    out[0] = out[n] = 0
    left, right = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for level in range(stop):
        size = right - left
        owner = np.repeat(np.arange(len(left)), size)
        row = common.ranges(left, size)
        if level:
            live = before[row] > 0
            owner, row = owner[live], row[live]
        if not len(row):
            break
        key = owner * 257 + before[row]
        by = np.argsort(key, kind="stable")
        key = key[by]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        head = np.flatnonzero(new)
        left = np.minimum.reduceat(back[row[by]], head)
        right = left + np.diff(np.append(head, len(key)))
        right, which = np.unique(right, return_index=True)
        left = left[which]
        fresh = out[right] < 0
        fresh |= level == 0
        left, right = left[fresh], right[fresh]
        out[right] = level
    return out


def earliest(pieces: list[np.ndarray], docs: np.ndarray, length: int) -> np.ndarray:
    """For each window of each piece, in turn, the least document among the pieces that hold it."""
    size = np.array([len(p) for p in pieces], np.int64)
    sym = np.zeros(size.sum() + len(size), np.uint16)
    begin = np.cumsum(size + 1) - size - 1
    at = common.ranges(begin, size)
    sym[at] = np.concatenate(pieces).astype(np.uint16) + 1
    order, place = suffix_order(sym, length)
    shared = common_prefixes(sym, order, place, length)
    group = np.cumsum(shared[:-1] >= 0) - 1
    windows = size - length + 1
    start = common.ranges(begin, windows)
    own = group[place[start]]
    least = np.full(group[-1] + 1, LAST)
    np.minimum.at(least, own, np.repeat(docs, windows))
    return least[own]


def _remove(length: int):
    def run(t: pa.Table, got: pa.Table) -> pa.Table:
        c = _Chunk(t, length)
        settled, own = _doubtful(c, rounds.of_round(got, 0), rounds.of_round(got, 1))
        lo, hi, doc, *_ = own
        sizes, least = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        third = rounds.of_round(got, 2)
        for _, x in sorted(zip(third["shard"].to_pylist(), third["keys"].to_pylist(), strict=True)):
            k = int(np.frombuffer(x, np.uint32, 1)[0])
            sizes.append(np.frombuffer(x, np.uint32, k, 4).astype(np.int64))
            least.append(np.frombuffer(x, np.int64, -1, 4 + 4 * k))
        sizes, least = np.concatenate(sizes), np.concatenate(least)
        if len(lo):
            _, number = _distinct_runs(c, own)
            place = (np.cumsum(sizes) - sizes)[number]
            size = hi - lo + 1
            each = np.repeat(np.arange(len(lo)), size)
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            value = least[place[each] + np.where(sizes[number][each] > 1, step, 0)]
            settled[(lo[each] + step)[value < c.ids[doc][each]]] = True
        start = np.flatnonzero(settled)
        gone = _cover(len(c.data), start, start + length)
        total = np.concatenate(([0], np.cumsum(gone)))
        removed = total[c.off[1:]] - total[c.off[:-1]]
        head = gone.copy()
        head[1:] &= ~gone[:-1]
        head[c.off[:-1][c.off[:-1] < len(gone)]] |= gone[c.off[:-1][c.off[:-1] < len(gone)]]
        heads = np.concatenate(([0], np.cumsum(head)))
        kept = c.data[~gone]
        off = c.off - total[c.off]
        return pa.table({
            "doc_id": c.t["doc_id"],
            "n_bytes": pa.array(np.diff(c.off), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(heads[c.off[1:]] - heads[c.off[:-1]], pa.int64()),
            "kept": pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(kept)]),
        })

    return run


def dedup_suffixes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts in a document with a smaller id.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (bytes).  Three rounds:
    runs of windows cut by content are compared whole, so that one copy of repeated text remains open;
    of the open windows, each goes under its anchor (the lowest hash among its 24-byte strings), and
    anchors of one document are dropped; the runs of windows under the others meet in the
    anchor's shard, where a Burrows-Wheeler transform of the distinct runs gets its common prefixes by
    threshold-bounded interval expansion, and each class of equal windows its least document.  Windows of an anchor
    that very many chunks hold are dealt out singly by hash, so that no group gathers in one task.

    A null text is empty; a null doc_id comes after all others.  Rows with the same doc_id never remove from
    each other.  Texts shorter than ``length`` bytes stay.  Other columns are not read.  An empty table gives an empty table.
    """
    if length < ANCHOR + 2:
        raise ValueError(f"length must be {ANCHOR + 2} or more")
    common.prepare(docs.sparkSession)
    dealt, n = rounds.deal(common.texts(docs))
    first = rounds.answer(rounds.ask(dealt, _ask_coarse(length, n)), _least, n)
    second = rounds.answer(rounds.ask(dealt, _ask_anchors(length, n), first), _held, n)
    third = rounds.answer(rounds.ask(dealt, _ask_runs(length, n), rounds.tagged(first, second)), _settle(length), n)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return rounds.finish(dealt, _remove(length), schema, rounds.tagged(first, second, third))
