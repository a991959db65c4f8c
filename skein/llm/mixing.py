"""Language-model scores by online logistic mixing of context bit predictors.

A token is told by bits: whether it follows its two predecessors in another document (A) and then which of those that do it is, by halves; else
whether any other document has it (B) and which it is, by halves of all tokens; else its bytes, bit by bit.  Every bit is predicted from the
counts of several contexts, whose log-odds are mixed by weights that a gate chooses and refined by adaptive probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm import common, rounds

#: Training documents: crc32 of the id modulo FOLDS is not HELD_OUT.
FOLDS, HELD_OUT = 5, 1
#: Kinds of text: the hash of a document's most frequent token modulo this; a document's kind is told first, at equal odds.
KINDS = 64
#: The byte that ends a word, and the hashes of a text's end and of what stands before its first token.
WORD_END, TEXT_END, START = 0x20, 0x1D8E4E27C47D124F, 0x6C62272E07BB0142
#: Bytes that the longest context of a spelled bit looks back at.
ORDERS = 3
#: Slots of the contexts of the bits A and B, each of the three of either.
SLOTS = 4096
PREDICTORS, BUCKETS = 3, 33
#: Gates: for spelled bits the place in the byte and how sure the two longest contexts are; for A what the last one was; for B the last two.
SPELL_GATES, A_GATES, B_GATES = 72, 3, 4
GATES = SPELL_GATES + A_GATES + B_GATES
#: Gates of bits that tell one of a range by halves: how many are left (in powers of two), and how sure the first context is.
HALVES = 8
HALF_GATES = HALVES * 3
#: Log-odds beyond which a context has been seen more than once without exception.
SURE = 3.2
PRIOR, REFINE_RATE = 0.05, 0.02
#: Curvature with which online steps of the weights begin, and the bits of a step.
STIFF, STEP = 50, 8192
#: Vectors that a task, and last the driver, sums at once of what chunks learn.
FAN_IN = 64
#: Codes of a token after its two predecessors: these are in no other document, or with other tokens only, or with this one; from HIT on
#: the code is the probability of this one among them, in steps of SHARE.
UNSEEN, MISS, HIT, SHARE = 0, 1, 2, 1.06

_U = np.uint64
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


# ---------------------------------------------------------------- tokens


class Tokens:
    """The tokens of packed texts in order, A-Z lower-cased: the words of each document and its end."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data = common.LOWER[data]
        s, e, d = common.words(self.data, off)
        self.n_docs = len(off) - 1
        count = np.bincount(d, minlength=self.n_docs)
        n = len(s) + self.n_docs
        at = np.arange(len(s)) + d
        self.hash = np.full(n, TEXT_END, np.uint64)
        self.hash[at] = common.word_hashes(self.data, s, e)
        self.s, self.e = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.s[at], self.e[at] = s, e
        self.doc = np.repeat(np.arange(self.n_docs), count + 1)
        self.begin = np.cumsum(count + 1) - (count + 1)
        self.place = np.arange(n) - self.begin[self.doc]
        # One stable sort gives distinct tokens, and the distinct tokens of each document with their number of times.
        order = np.argsort(self.hash, kind="stable")
        hashes, doc = self.hash[order], self.doc[order]
        token = np.append(True, hashes[1:] != hashes[:-1])[:n]
        pair = token | np.append(True, doc[1:] != doc[:-1])[:n]
        self.distinct = hashes[token]
        number = np.cumsum(token) - 1
        self.number, self.of_doc = np.empty(n, np.int64), np.empty(n, np.int64)
        self.number[order], self.of_doc[order] = number, np.cumsum(pair) - 1
        head = np.flatnonzero(pair)
        self.times = np.diff(np.append(head, n))
        self.pair_doc, self.pair_token = doc[head], number[head]
        # The last of equal documents in this order is the most frequent token, of equal ones the smaller hash.
        self.kind = np.zeros(self.n_docs, np.int64)
        best = np.argsort(self.times * np.int64(len(self.distinct) + 1) - self.pair_token, kind="stable")
        self.kind[self.pair_doc[best]] = (self.distinct[self.pair_token[best]] % _U(KINDS)).astype(np.int64)

    def before(self, k: int) -> np.ndarray:
        """The hash of the token k places before."""
        out = np.full(len(self.hash), START, np.uint64)
        out[k:] = self.hash[: len(out) - k]
        out[self.place < k] = START
        return out

    def kinds(self, trains: np.ndarray):
        """Distinct (token, kind of its document, how often that has it if it trains, else 0): token, kind, own, and the number of each, by pair of document
        and token."""
        own = (self.times * trains[self.pair_doc]).astype(np.uint64)
        keys, of = np.unique((self.pair_token * KINDS + self.kind[self.pair_doc]).astype(np.uint64) << _U(32) | own, return_inverse=True)
        both = (keys >> _U(32)).astype(np.int64)
        return both // KINDS, both % KINDS, (keys & _U(0xFFFFFFFF)).astype(np.int64), of

    def follows(self, trains: np.ndarray):
        """What stands after two predecessors: distinct hashes (24 bits of the predecessors and 24 of the token) and whether they are of training
        documents, sorted, with the number of those documents; and which is each token's, -1 without two predecessors."""
        deep = np.flatnonzero(self.place > 1)
        doc = self.doc[deep]
        with np.errstate(over="ignore"):
            context = common.mix(self.before(1)[deep] * _U(_ODD[0]) + common.mix(self.before(2)[deep] * _U(_ODD[1]) + _U(1)))
            every = (context >> _U(24) << _U(24)) | (self.hash[deep] * _U(_ODD[2]) >> _U(40))
        train = trains[doc]
        order = np.lexsort((doc, train, every))
        every, train, doc = every[order], train[order], doc[order]
        new = np.append(True, (every[1:] != every[:-1]) | (train[1:] != train[:-1]))[: len(every)]
        of = np.full(len(self.hash), -1, np.int64)
        of[deep[order]] = np.cumsum(new) - 1
        head = np.flatnonzero(new)
        docs = np.add.reduceat((new | np.append(True, doc[1:] != doc[:-1])[: len(doc)]).astype(np.int64), head) if len(head) else head
        return every[head], train[head], docs * train[head], of

    def openings(self, trains: np.ndarray):
        """How documents open: distinct hashes of first tokens and of first and second ones, sorted, with the number of training documents; which is
        each document's first token, and its first two (of a text of one token, the first again)."""
        second = self.begin + (np.diff(np.append(self.begin, len(self.hash))) > 1)
        with np.errstate(over="ignore"):
            one = common.mix(self.hash[self.begin] * _U(_ODD[0]) + _U(2))
            two = np.where(second > self.begin, common.mix(self.hash[second] * _U(_ODD[1]) + one), one)
        key, of = np.unique(np.concatenate((one, two)), return_inverse=True)
        weight = np.concatenate((trains, trains & (second > self.begin)))
        return key, np.bincount(of, weights=weight, minlength=len(key)), of[: self.n_docs], of[self.n_docs :]

    def spelled(self, at: np.ndarray):
        """For the bytes of tokens, each word's followed by WORD_END: token, and the byte with the ORDERS before it in one number."""
        size = self.e[at] - self.s[at] + 1
        off = np.concatenate(([0], np.cumsum(size)))
        out = np.full(off[-1], WORD_END, np.uint32)
        out[common.ranges(off[:-1], size - 1)] = self.data[common.ranges(self.s[at], size - 1)]
        place = np.arange(len(out)) - np.repeat(off[:-1], size)
        key = out.copy()
        for k in range(1, ORDERS + 1):
            before = np.zeros(len(out), np.uint32)
            before[k:] = out[: len(out) - k]
            before[place < k] = 0
            key |= before << np.uint32(8 * k)
        return np.repeat(np.arange(len(at)), size), key


# ---------------------------------------------------------------- mixing


@dataclass
class Mixer:
    """Mixing weights by gate, refined probabilities by gate and bucket."""

    weights: np.ndarray
    refined: np.ndarray

    @staticmethod
    def fresh(gates: int = GATES) -> Mixer:
        return Mixer(np.full((gates, PREDICTORS), 0.4), np.tile(1 / (1 + np.exp(-(np.arange(BUCKETS) / 2 - 8))), (gates, 1)))

    def predict(self, st: np.ndarray, gate: np.ndarray):
        """The probability of a one bit, mixed and refined, with what an update needs.  ``st`` has the log-odds of each predictor."""
        z = np.clip((self.weights[gate] * st).sum(axis=1), -30, 30)
        p = 1 / (1 + np.exp(-z))
        pos = np.clip((z + 8) * 2, 0, BUCKETS - 1.001)
        low = pos.astype(np.int64)
        share = pos - low
        low += gate.astype(np.int64) * BUCKETS
        flat = self.refined.ravel()
        q = (flat[low] * (1 - share) + flat[low + 1] * share + p) / 2
        return np.clip(q, 1e-6, 1 - 1e-6), p, low, share

    def log10(self, st: np.ndarray, gate: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """The log10 probability of each bit, in stretches that stay in the cache."""
        out = np.empty(len(bit))
        for a in range(0, len(bit), 4 * STEP):
            c = slice(a, a + 4 * STEP)
            p = self.predict(st[c], gate[c])[0]
            out[c] = np.log10(np.where(bit[c], p, 1 - p))
        return out


class Learner:
    """Learns a mixer online: Newton steps of the weights of each gate, and refined probabilities that move to what they see."""

    def __init__(self, gates: int = GATES):
        self.mixer = Mixer.fresh(gates)
        self.curve = np.tile(STIFF * np.eye(PREDICTORS), (gates, 1, 1))
        self.of_gate, self.of_cell = np.zeros(gates), np.zeros(gates * BUCKETS)

    def learn(self, st: np.ndarray, gate: np.ndarray, bit: np.ndarray, times: np.ndarray) -> None:
        weights, flat, gates = self.mixer.weights, self.mixer.refined.ravel(), len(self.of_gate)
        for a in range(0, len(bit), STEP):
            x, g, b, w = (v[a : a + STEP] for v in (st, gate, bit, times))
            _, p, low, share = self.mixer.predict(x, g)
            self.of_gate += np.bincount(g, weights=w, minlength=gates)
            miss, bend = w * (b - p), w * p * (1 - p)
            slope = np.stack([np.bincount(g, weights=miss * x[:, k], minlength=gates) for k in range(PREDICTORS)], axis=1)
            for k in range(PREDICTORS):
                for m in range(k + 1):
                    self.curve[:, k, m] += np.bincount(g, weights=bend * x[:, k] * x[:, m], minlength=gates)
                    self.curve[:, m, k] = self.curve[:, k, m]
            weights += np.linalg.solve(self.curve, slope[:, :, None])[:, :, 0]
            for cell, v in ((low, w * (1 - share)), (low + 1, w * share)):
                mass = np.bincount(cell, weights=v, minlength=len(flat))
                self.of_cell += mass
                seen = np.bincount(cell, weights=v * b, minlength=len(flat))
                like = mass**2 / np.maximum(np.bincount(cell, weights=v * v, minlength=len(flat)), 1e-9)
                flat += np.minimum(REFINE_RATE * like, 0.5) * np.where(mass > 0, seen / np.maximum(mass, 1e-9) - flat, 0)

    def sums(self) -> np.ndarray:
        w, r = self.mixer.weights.ravel(), self.mixer.refined.ravel()
        of = np.repeat(self.of_gate, PREDICTORS)
        return np.concatenate((w * of, of, r * self.of_cell, self.of_cell))


def merged(sums: np.ndarray) -> Mixer:
    """The means of what the chunks learned, weighted by the bits that they learned from."""
    out, fresh = [], Mixer.fresh()
    for start, a in ((fresh.weights.ravel(), 0), (fresh.refined.ravel(), 2 * GATES * PREDICTORS)):
        v, m = sums[a : a + len(start)], sums[a + len(start) : a + 2 * len(start)]
        out.append(np.where(m > 0, v / np.where(m > 0, m, 1), start))
    return Mixer(out[0].reshape(GATES, PREDICTORS), np.clip(out[1], 1e-6, 1 - 1e-6).reshape(GATES, BUCKETS))


def _log_odds(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.clip(np.log((n1 + PRIOR) / (n0 + PRIOR)), -12, 12)


def _how_sure(st: np.ndarray) -> np.ndarray:
    return (st != 0).astype(np.int64) + (np.abs(st) > SURE)


# ---------------------------------------------------------------- bits by halves


def _below(counts: np.ndarray):
    """How much is below a rank, from the counts by rank."""
    sums = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    return lambda _, rank: sums[rank]


def halves(low: np.ndarray, high: np.ndarray, at: np.ndarray, contexts: list):
    """The bits that tell each rank ``at`` of those from ``low`` up to ``high``: whether it is in the upper half, then of that half, until one rank is left.

    ``contexts``: for each predictor how much is below a rank, as a function of rows and ranks, and what is taken off the counts on a row's own path.
    Yields rows, log-odds by predictor, gate, bit.
    """
    rows, a, b = np.arange(len(at)), low, high
    ends = [(below(rows, a), below(rows, b), own) for below, own in contexts]
    while True:
        left = b - a > 1
        if not left.all():
            rows, a, b, ends = rows[left], a[left], b[left], [tuple(x[left] for x in e) for e in ends]
        if not len(rows):
            return
        mid = (a + b) // 2
        bit = at[rows] >= mid
        st = np.empty((len(rows), PREDICTORS))
        for k, (first, last, mine) in enumerate(ends):
            middle = contexts[k][0](rows, mid)
            st[:, k] = _log_odds(np.maximum(middle - first - mine * ~bit, 0), np.maximum(last - middle - mine * bit, 0))
            ends[k] = np.where(bit, middle, first), np.where(bit, last, middle), mine
        yield rows, st, np.minimum(np.log2(b - a).astype(np.int64), HALVES - 1) * 3 + _how_sure(st[:, 0]), bit
        a, b = np.where(bit, mid, a), np.where(bit, b, mid)


def _blocks(contexts: list, n: int):
    """Rows in stretches of bounded memory, with their contexts."""
    for a in range(0, n, 4 * STEP):
        c = slice(a, min(a + 4 * STEP, n))
        yield c, [(lambda rows, rank, f=f, a=a: f(a + rows, rank), own[c]) for f, own in contexts]


def learned(low: np.ndarray, high: np.ndarray, at: np.ndarray, contexts: list, weight: np.ndarray) -> Mixer:
    """The mixer of ``halves``, learned online from the rows, each ``weight`` times."""
    learner = Learner(HALF_GATES)
    for c, part in _blocks(contexts, len(at)):
        for rows, st, gate, bit in halves(low[c], high[c], at[c], part):
            learner.learn(st, gate, bit, weight[c][rows])
    return learner.mixer


def told(mixer: Mixer, low: np.ndarray, high: np.ndarray, at: np.ndarray, contexts: list) -> np.ndarray:
    """The log10 probability of each rank in its range."""
    out = np.zeros(len(at))
    for c, part in _blocks(contexts, len(at)):
        for rows, st, gate, bit in halves(low[c], high[c], at[c], part):
            out[c.start + rows] += mixer.log10(st, gate, bit)
    return out


# ---------------------------------------------------------------- spelled bits


class Spelling:
    """Counts of bytes in contexts of 1 to ORDERS bytes: sorted numbers (context and byte) with their counts, by order."""

    def __init__(self, keys: list[np.ndarray], counts: list[np.ndarray]):
        self.keys = keys
        self.sums = [np.concatenate(([0], np.cumsum(c, dtype=np.int64))) for c in counts]

    @staticmethod
    def local(key: np.ndarray, times: np.ndarray) -> Spelling:
        """From distinct numbers of the longest contexts and bytes."""
        keys, counts = [], []
        for k in range(1, ORDERS + 1):
            x, of = np.unique(key & _mask(k), return_inverse=True)
            keys.append(x)
            counts.append(np.bincount(of, weights=times, minlength=len(x)))
        return Spelling(keys, counts)

    def bits(self, key: np.ndarray, own: np.ndarray):
        """For the eight bits of each number's byte: log-odds by predictor, gate, bit.  ``own`` is taken off the counts on its path."""
        byte = key & np.uint32(255)
        ends = []
        for k in range(1, ORDERS + 1):
            context = (key & _mask(k)) & ~np.uint32(255)
            at = self.keys[k - 1], self.sums[k - 1]
            ends.append([context, *at, at[1][np.searchsorted(at[0], context)], at[1][np.searchsorted(at[0], context | np.uint32(255), "right")]])
        low = np.zeros(len(key), np.uint32)
        for i in range(8):
            half = np.uint32(128 >> i)
            bit = (byte & half) > 0
            st = np.empty((len(key), PREDICTORS))
            for k, x in enumerate(ends):
                context, keys, sums, a, b = x
                mid = sums[np.searchsorted(keys, context | (low + half))]
                n0, n1 = mid - a, b - mid
                st[:, k] = _log_odds(np.maximum(n0 - own * ~bit, 0), np.maximum(n1 - own * bit, 0))
                x[3], x[4] = np.where(bit, mid, a), np.where(bit, b, mid)
            gate = i * 9 + _how_sure(st[:, 1]) * 3 + _how_sure(st[:, 2])
            low = low + half * bit
            yield st, gate, bit


def _mask(k: int) -> np.uint32:
    return np.uint32((1 << 8 * (k + 1)) - 1)


# ---------------------------------------------------------------- bits A and B


def _last(x: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """The value k tokens before, 0 before the first."""
    out = np.zeros(len(x), np.int16)
    out[k:] = x[: len(x) - k]
    out[place < k] = 0
    return out


class Flags:
    """The bits A and B of tokens: which tokens have them, their contexts (three each, as slots) and gates."""

    def __init__(self, t: Tokens, code: np.ndarray, known: np.ndarray):
        state = np.minimum(code, HIT)  # 0 unseen, 1 miss, 2 hit
        a, b = state > 0, state < HIT
        self.asked = (a, b)
        self.bit = ((state == HIT)[a], known[b])
        begin = t.begin[t.doc]

        def tally(x):
            """How many tokens before this one in its document are so."""
            sums = np.cumsum(x, dtype=np.int32) - x
            return sums - sums[begin]

        def grade(part, whole, finer):
            return np.minimum(np.log2(whole + 1), 7).astype(np.int16) * 9 + np.minimum(8 * finer * part // np.maximum(whole, 1), 8).astype(np.int16)

        far = [_last(state, t.place, k) for k in range(1, 5)]
        self.slots = [np.stack([x[a] for x in (((far[0] * 3 + far[1]) * 3 + far[2]) * 3 + far[3], grade(tally(state == HIT), tally(state > 0), 1), t.kind[t.doc].astype(np.int16) * 3 + far[0])])]
        had = [_last(known, t.place, k) for k in range(1, 5)]
        word = (t.before(1) * _U(_ODD[1]) >> _U(52)).astype(np.int16)
        self.slots.append(np.stack([x[b] for x in ((((had[0] * 2 + had[1]) * 2 + had[2]) * 2 + had[3]) * 3 + far[0], grade(tally(~known), t.place, 2), word)]))
        self.gate = ((SPELL_GATES + far[0][a]).astype(np.int8), (SPELL_GATES + A_GATES + had[0] * 2 + had[1])[b].astype(np.int8))

    def counts(self, weight: np.ndarray) -> np.ndarray:
        """How often each slot had a zero and a one."""
        out = np.zeros((2, PREDICTORS, 2, SLOTS))
        for i, (m, bit) in enumerate(zip(self.asked, self.bit)):
            for k in range(PREDICTORS):
                for v in (0, 1):
                    out[i, k, v] = np.bincount(self.slots[i][k], weights=weight[m] * (bit == v), minlength=SLOTS)
        return out

    def inputs(self, counts: np.ndarray):
        """Log-odds by predictor, gate and bit of A, then of B."""
        for i in (0, 1):
            odds = _log_odds(counts[i, :, 0], counts[i, :, 1]).astype(np.float32)
            yield np.stack([odds[k][self.slots[i][k]] for k in range(PREDICTORS)], axis=1), self.gate[i], self.bit[i]


# ---------------------------------------------------------------- rounds

_OPENING = np.dtype([("key", "<u8"), ("count", "<u4")])
#: A key that several training documents of a chunk have: its place among the keys asked, and their number.
_SEVERAL = np.dtype([("at", "<u4"), ("count", "<u4")])
_COUNT = np.dtype([("key", "<u8"), ("count", "<u4"), ("own", "<u4"), ("kind", "u1")])
#: A token's training count, and its probability among the known tokens of its shard, as -log10 in steps of 1 / FINE, rounded up.
_TOLD = np.dtype([("total", "<u4"), ("steps", "<u2")])
FINE = 2048
_TOTALS = 3 + KINDS
#: Bytes of a key that tells what follows what.
_FOLLOW = 6


def _columns(records: np.ndarray) -> bytes:
    """Records column by column, which takes less room once compressed."""
    return b"".join(np.ascontiguousarray(records[name]).tobytes() for name in records.dtype.names)


def _records(raw: bytes, kind: np.dtype) -> np.ndarray:
    n = len(raw) // kind.itemsize
    out, at = np.empty(n, kind), 0
    for name in kind.names:
        out[name] = np.frombuffer(raw, kind[name], n, at)
        at += n * kind[name].itemsize
    return out


def _pack_follows(key: np.ndarray) -> bytes:
    return key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_FOLLOW].tobytes()


def _unpack_follows(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // _FOLLOW, 8), np.uint8)
    out[:, :_FOLLOW] = np.frombuffer(raw, np.uint8).reshape(-1, _FOLLOW)
    return out.view("<u8").ravel()


def _trains(t: pa.Table) -> np.ndarray:
    return np.array([common.crc_of_id(x) % FOLDS != HELD_OUT for x in t["doc_id"].to_pylist()], bool)


def _read(t: pa.Table):
    t = rounds.ordered(t)
    return t, Tokens(*common.packed(t["text"])), _trains(t)


def _rows(chunk: int, shard: np.ndarray, base: int, made) -> list:
    cut = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
    return [(base + int(shard[a]), *made(a, b)) for a, b in zip(cut[:-1], cut[1:])]


def _pack_counts(train: np.ndarray, count: np.ndarray) -> bytes:
    at = np.flatnonzero(count > 1)
    several = np.empty(len(at), _SEVERAL)
    several["at"], several["count"] = at, count[at]
    return np.packbits(train).tobytes() + several.tobytes()


def _unpack_counts(raw: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    train = np.unpackbits(np.frombuffer(raw, np.uint8, -(-n // 8)), count=n)
    count, several = train.astype(np.int64), np.frombuffer(raw[-(-n // 8) :], _SEVERAL)
    count[several["at"]] = several["count"]
    return train, count


def _ask(n: int):
    """A chunk's tokens by kind and own count with their training counts (shards 0 to n - 1), what follows what (n to 2 n - 1), and how documents open (2 n to
    3 n - 1).  Each is asked once a chunk, with the number of its documents."""

    def run(t: pa.Table, _) -> pa.Table:
        chunk = t["chunk"][0].as_py()
        _, tokens, trains = _read(t)
        token, kind, mine, of = tokens.kinds(trains)
        out = np.empty(len(token), _COUNT)
        out["key"], out["kind"], out["own"] = tokens.distinct[token], kind, mine
        out["count"] = np.bincount(of, weights=tokens.times * trains[tokens.pair_doc], minlength=len(token))
        made = _rows(chunk, rounds.shard_of(out["key"], n).astype(np.int64), 0, lambda a, b: (_columns(out[a:b]), None))
        key, train, count, _ = tokens.follows(trains)
        made += _rows(chunk, rounds.shard_of(key, n).astype(np.int64), n, lambda a, b: (_pack_follows(key[a:b]), _pack_counts(train[a:b], count[a:b])))
        opening, count_of, _, _ = tokens.openings(trains)
        first = np.empty(len(opening), _OPENING)
        first["key"], first["count"] = opening, count_of
        made += _rows(chunk, rounds.shard_of(opening, n).astype(np.int64), 2 * n, lambda a, b: (first[a:b].tobytes(), None))
        return rounds.rows(chunk, made)

    return run


def _answer_tokens(keys: list[bytes]) -> tuple[list[bytes], bytes]:
    """Answers as _TOLD, and the totals of the shard: distinct and all training tokens, by kind, and rows that have any.

    A known token is told among those of the shard by halves; its contexts are all documents, those of its kind, and the number of rows that have a token.
    """
    got = [_records(k, _COUNT) for k in keys]
    every = np.concatenate(got)
    distinct, number = np.unique(every["key"], return_inverse=True)
    n = len(distinct)
    total = np.bincount(number, weights=every["count"], minlength=n).astype(np.int64)
    rows = np.bincount(number, weights=every["count"] > 0, minlength=n)
    group, of = np.unique((number * KINDS + every["kind"]).astype(np.uint64) << _U(32) | every["own"].astype(np.uint64), return_inverse=True)
    weight = np.bincount(of, weights=every["count"], minlength=len(group))
    both = (group >> _U(32)).astype(np.int64)
    token, kind, own = both // KINDS, both % KINDS, (group & _U(0xFFFFFFFF)).astype(np.int64)
    known = np.flatnonzero(total[token] > own)
    # Ranks are those of tokens with a training count.
    some = total > 0
    rank, high = np.cumsum(some) - 1, int(some.sum())
    log10 = np.zeros(len(group))
    if len(known):
        at, in_kind = rank[token[known]], kind[known]
        sums = np.zeros((KINDS, high + 1), np.int64)
        sums[:, 1:] = np.bincount((kind * high + rank[token])[weight > 0], weights=weight[weight > 0], minlength=KINDS * high).reshape(KINDS, high).cumsum(axis=1)
        sums = sums.ravel()
        of_kind = lambda i, r: sums[in_kind[i] * (high + 1) + r]
        mine = own[known]
        contexts = [(_below(total[some]), mine), (of_kind, mine), (_below(rows[some]), np.minimum(mine, 1))]
        ends = np.zeros(len(known), np.int64), np.full(len(known), high)
        trained = weight[known] > 0
        mixer = learned(*(x[trained] for x in (*ends, at)), [contexts[0][:1] + (mine[trained],), (lambda i, r, back=np.flatnonzero(trained): of_kind(back[i], r), mine[trained]), contexts[2][:1] + (np.minimum(mine[trained], 1),)], weight[known][trained])
        log10[known] = told(mixer, *ends, at, contexts)
    out = np.empty(len(every), _TOLD)
    out["total"], out["steps"] = total[number], np.minimum(np.ceil(-log10 * FINE - 1e-6), 65535)[of]
    head = np.concatenate(([some.sum(), total.sum(), rows.sum()], np.bincount(every["kind"], weights=every["count"], minlength=KINDS)))
    return [_columns(x) for x in np.split(out, np.cumsum([len(g) for g in got])[:-1])], head.tobytes()


def _codes(any_: np.ndarray, this: np.ndarray) -> np.ndarray:
    """Codes of tokens that ``this`` other documents have after what ``any_`` have."""
    code = np.where(any_ > 0, MISS, UNSEEN)
    hit = this > 0
    code[hit] = HIT + np.minimum(np.ceil(np.log(any_[hit] / this[hit]) / np.log(SHARE) - 1e-9), 255 - HIT)
    return code.astype(np.uint8)


def _answer_follows(keys: list[bytes], counted: list[bytes], mixed: bool = False) -> list[bytes]:
    """Codes by the share of each token in the counts of what follows; ``mixed``: by its bits instead (``_follow_log10``).

    Rows are sorted once and keep only what they ask, a number of four bytes (which key, and whether of training documents); all else is by distinct key.
    """
    size = [len(k) // _FOLLOW for k in keys]
    every = np.concatenate([_unpack_follows(k) for k in keys])
    order = np.argsort(every, kind="stable").astype(np.int32)
    every = every[order]
    head = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    asks = np.repeat(np.arange(len(head), dtype=np.int32), np.diff(np.append(head, len(every)))) * np.int32(2)
    key = every[head]
    del every
    train, count = (np.concatenate(x) for x in zip(*(_unpack_counts(c, n) for c, n in zip(counted, size))))
    asks += train[order]
    count = count.astype(np.uint32)[order]
    del train
    total = np.add.reduceat(count, head, dtype=np.int64)
    rows = np.add.reduceat(count > 0, head, dtype=np.int32)
    asked = np.zeros(2 * len(key), bool)
    asked[asks] = True
    del count, head
    # What asks the same, a key as it is in held-out documents (even numbers) or in training ones, has one code.  A training document's own share is one of each.
    cell = np.flatnonzero(asked).astype(np.int32)
    which, own = cell >> 1, cell & 1
    del asked
    context = key >> _U(24)
    start = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
    whole = np.repeat(np.add.reduceat(total, start), np.diff(np.append(start, len(key))))
    del context
    this = total[which] - own
    code = _codes(whole[which] - own, this)
    del whole
    hit = this > 0
    del this
    if mixed and hit.any():
        steps = np.ceil(-_follow_log10(key, total, rows, which[hit], own[hit]) / np.log10(SHARE) - 1e-9)
        code[hit] = HIT + np.clip(steps, 0, 255 - HIT)
    of_cell = np.zeros(2 * len(key), np.uint8)
    of_cell[cell] = code
    out = np.empty(len(order), np.uint8)
    out[order] = of_cell[asks]
    return [x.tobytes() for x in np.split(out, np.cumsum(size)[:-1])]


def _follow_log10(key: np.ndarray, total: np.ndarray, rows: np.ndarray, which: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The log10 probability of tokens among those that follow the same two predecessors, by halves of these.

    Contexts: the training documents that have the token there, those of all predecessors of the shard, and the chunks that have it there.  Keys are distinct and
    sorted, each with its documents and chunks; asked is the key of number ``which``, with ``own`` of them taken off; training documents ask for a key as often as they have it.
    """
    some = total > 0
    at = (np.cumsum(some, dtype=np.int32) - 1)[which]
    key, total, rows = key[some], total[some], rows[some]
    new = np.append(True, (key[1:] ^ key[:-1]) >> _U(24) > 0)
    starts = np.flatnonzero(new).astype(np.int32)
    place = (np.cumsum(new, dtype=np.int32) - 1)[at]
    low, high = starts[place], np.append(starts[1:], len(key)).astype(np.int32)[place]
    del new, starts, place
    token = (key & _U(0xFFFFFF)).astype(np.uint32)
    del key
    order = np.argsort(token, kind="stable")
    token = token[order]
    head = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    anywhere = np.empty_like(total)
    anywhere[order] = np.repeat(np.add.reduceat(total[order], head), np.diff(np.append(head, len(order))))
    del token, order, head
    below = [_below(x) for x in (total, anywhere, rows)]
    trained = own > 0
    weight = total[at[trained]].astype(np.float64)
    del total, anywhere, rows
    mine = own[trained]
    mixer = learned(low[trained], high[trained], at[trained], [(f, mine) for f in below], weight)
    return told(mixer, low, high, at, [(f, own) for f in below])


def _answer_openings(keys: list[bytes]) -> list[bytes]:
    got = [np.frombuffer(k, _OPENING) for k in keys]
    every = np.concatenate(got)
    _, of = np.unique(every["key"], return_inverse=True)
    total = np.bincount(of, weights=every["count"])[of].astype(np.uint32)
    return [x.tobytes() for x in np.split(total, np.cumsum([len(g) for g in got])[:-1])]


def _answer(n: int):
    """Answers by chunk; and, for each shard of tokens, its totals as a row of chunk -1."""

    def run(t: pa.Table) -> pa.Table:
        shard, keys = t["shard"][0].as_py(), t["keys"].to_pylist()
        chunk = t["chunk"].to_pylist()
        if shard < n:
            out, head = _answer_tokens(keys)
            out, chunk = [*out, head], [*chunk, -1]
        elif shard < 2 * n:
            out = _answer_follows(keys, t["extra"].to_pylist(), mixed=True)
        else:
            out = _answer_openings(keys)
        return pa.table({"chunk": pa.array(chunk, pa.int32()), "shard": pa.array([shard] * len(out), pa.int32()), "keys": pa.array(out, pa.binary()), "extra": pa.nulls(len(out), pa.binary())})

    return run


def opening_codes(t: Tokens, trains: np.ndarray, n_train: int, totals: np.ndarray):
    """Codes of first and of second tokens, by document, from the totals of ``openings``: a first token comes after nothing in all training
    documents, a second one after its first token in those that open with that."""
    _, _, one, two = t.openings(trains)
    whole = np.full(t.n_docs, n_train) - trains
    first, both = totals[one].astype(np.int64) - trains, totals[two].astype(np.int64) - trains
    return _codes(whole, first), _codes(first, both)


class Chunk:
    """A chunk's tokens with their answers: totals, log10 probabilities in their shards, codes, and the bits A and B."""

    def __init__(self, t: pa.Table, answers: pa.Table, n: int):
        self.t, self.tokens, self.trains = _read(t)
        own = self.tokens
        parts = sorted(zip(answers["shard"].to_pylist(), answers["keys"].to_pylist(), strict=True))
        counts = np.concatenate([_records(k, _TOLD) for s, k in parts if s < n])
        codes = np.frombuffer(b"".join(k for s, k in parts if n <= s < 2 * n), np.uint8)
        openings = np.frombuffer(b"".join(k for s, k in parts if s >= 2 * n), np.uint32)
        counts = counts[own.kinds(self.trains)[3][own.of_doc]]
        self.total, self.in_shard = counts["total"].astype(np.int64), counts["steps"] / -FINE
        self.mine = own.times[own.of_doc] * self.trains[own.doc]
        self.code = np.empty(len(own.hash), np.uint8)
        of = own.follows(self.trains)[3]
        self.code[of >= 0] = codes[of[of >= 0]]
        # Every document has one end, so the end's count is the number of training documents.
        first, second = opening_codes(own, self.trains, int(self.total[np.flatnonzero(own.hash == _U(TEXT_END))[0]]), openings)
        self.code[own.begin] = first
        at = np.flatnonzero(own.place == 1)
        self.code[at] = second[own.doc[at]]
        self.known = self.total > self.mine
        self.flags = Flags(own, self.code, self.known)
        # Tokens that neither follow as before nor are known are spelled.
        self.new = np.flatnonzero((self.code < HIT) & ~self.known)
        self.of, key = own.spelled(self.new)
        train = self.trains[own.doc[self.new]][self.of]
        # Distinct numbers, apart for training and held-out documents, as the former take one off their counts.
        both, self.at = np.unique(key.astype(np.uint64) << _U(1) | train.astype(_U), return_inverse=True)
        self.key, self.train = (both >> _U(1)).astype(np.uint32), (both & _U(1)).astype(np.int64)
        self.times = np.bincount(self.at, minlength=len(both)).astype(np.float64)


_SPELT = np.dtype([("order", "u1"), ("key", "<u4"), ("count", "<u4")])


def _learn(n: int, shards: int):
    """What a chunk learns (shard -1: its mixer, and counts of the slots of A and B), and its spelled bytes by shard of contexts."""

    def run(t: pa.Table, answers: pa.Table) -> pa.Table:
        if not t.num_rows:
            return rounds.rows(-1, [])
        c = Chunk(t, answers, n)
        learner = Learner()
        weight = c.trains[c.tokens.doc].astype(np.float64)
        counts = c.flags.counts(weight)
        for m, (st, gate, bit) in zip(c.flags.asked, c.flags.inputs(counts)):
            learner.learn(st, gate, bit, weight[m])
        seen = Spelling.local(c.key, c.times * c.train)
        used = c.train > 0
        for st, gate, bit in seen.bits(c.key[used], np.ones(used.sum(), np.int64)):
            learner.learn(st, gate, bit, c.times[used])
        made = [(-1, np.concatenate((learner.sums(), counts.ravel())).tobytes(), None)]
        for k, (key, sums) in enumerate(zip(seen.keys, seen.sums)):
            out = np.empty(len(key), _SPELT)
            out["order"], out["key"], out["count"] = k + 1, key, np.diff(sums)
            shard = _context_shard(k + 1, key, shards)
            order = np.argsort(shard, kind="stable")
            shard, out = shard[order], out[order]
            made += _rows(0, shard, 0, lambda a, b, out=out: (out[a:b].tobytes(), None))
        return rounds.rows(t["chunk"][0].as_py(), made)

    return run


def _context_shard(order: int, key: np.ndarray, shards: int) -> np.ndarray:
    return rounds.shard_of(common.mix((key.astype(np.uint64) >> _U(8)) + (_U(order) << _U(40))), shards).astype(np.int64)


def _answer_spelt(t: pa.Table) -> pa.Table:
    """To each chunk, for every context that it asked about, all bytes with their total counts."""
    got = [np.frombuffer(k, _SPELT) for k in t["keys"].to_pylist()]
    every = np.concatenate(got)
    number, of = np.unique(every["order"].astype(np.uint64) << _U(32) | every["key"], return_inverse=True)
    count = np.bincount(of, weights=every["count"], minlength=len(number))
    some = np.empty(len(number), _SPELT)
    some["order"], some["key"], some["count"] = number >> _U(32), number & _U(0xFFFFFFFF), count
    context = number >> _U(8)
    head = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
    end = np.append(head[1:], len(context))
    where = np.cumsum(np.append(True, context[1:] != context[:-1])) - 1
    out, at = [], 0
    for g in got:
        asked = np.unique(where[of[at : at + len(g)]])
        at += len(g)
        x = some[common.ranges(head[asked], end[asked] - head[asked])]
        out.append(x[x["count"] > 0].tobytes())
    return pa.table({"chunk": t["chunk"], "shard": t["shard"], "keys": pa.array(out, pa.binary()), "extra": pa.nulls(len(out), pa.binary())})


def _sum(column) -> np.ndarray:
    return sum(np.frombuffer(x, np.float64) for x in column)


def _add(t: pa.Table) -> pa.Table:
    return pa.table({"at": t["at"][:1], "keys": pa.array([_sum(t["keys"].to_pylist()).tobytes()], pa.binary())})


def _collect(rows: DataFrame, many: int) -> np.ndarray | None:
    """The sum of the vectors in ``keys``, about ``many``: summed level by level, FAN_IN or so in a task, and as many by the driver."""
    rows = rows.select(F.xxhash64("chunk", "shard").alias("at"), "keys")
    while many > FAN_IN:
        many = -(-many // FAN_IN)
        rows = rows.withColumn("at", F.pmod("at", F.lit(many))).groupBy("at").applyInArrow(_add, "at long, keys binary")
    got = [r["keys"] for r in rows.select("keys").collect()]
    return _sum(got) if got else None


class Shards:
    """Which shard a token is in, told by halves of the shards: their training tokens, those of its kind, and their rows (a row of totals each)."""

    def __init__(self, totals: np.ndarray):
        self.n = len(totals)
        self.counts = counts = totals.astype(np.int64)
        self.of_kind = np.concatenate((np.zeros((1, KINDS), np.int64), np.cumsum(counts[:, 3:], axis=0)))
        shard, kind = np.nonzero(counts[:, 3:])
        self.mixer = learned(*self._asked(shard, kind, np.ones(len(shard), np.int64)), counts[shard, 3 + kind].astype(np.float64))

    def _asked(self, shard, kind, own):
        contexts = [(_below(self.counts[:, 1]), own), (lambda rows, rank: self.of_kind[rank, kind[rows]], own), (_below(self.counts[:, 2]), np.minimum(own, 1))]
        return np.zeros(len(shard), np.int64), np.full(len(shard), self.n), shard, contexts

    def log10(self, hashes: np.ndarray, kind: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The log10 probability of the shard of each token."""
        key, of = np.unique((rounds.shard_of(hashes, self.n) * _U(KINDS) + kind.astype(_U)) << _U(32) | own.astype(_U), return_inverse=True)
        both = (key >> _U(32)).astype(np.int64)
        return told(self.mixer, *self._asked(both // KINDS, both % KINDS, (key & _U(0xFFFFFFFF)).astype(np.int64)))[of]


@dataclass
class Model:
    """What is learned from all training documents: numbers of distinct and of all tokens, shards of tokens, mixer, slots of A and B."""

    distinct: int
    total: int
    shards: Shards
    mixer: Mixer
    slots: np.ndarray


def log10_scores(c: Chunk, model: Model, spelled: Spelling) -> np.ndarray:
    """The log10 probability of each token of a chunk."""
    own, out = c.tokens, np.zeros(len(c.code))
    for m, (st, gate, bit) in zip(c.flags.asked, c.flags.inputs(model.slots)):
        out[m] += model.mixer.log10(st, gate, bit)
    # After A, the bits among what follows two predecessors; openings and known tokens have those among all tokens: the shard's, then the token's in it.
    follows = (c.code >= HIT) & (own.place > 1)
    out[follows] -= (c.code[follows].astype(np.int64) - HIT) * np.log10(SHARE)
    named = np.flatnonzero(~follows & c.known)
    out[named] += c.in_shard[named] + model.shards.log10(own.hash[named], own.kind[own.doc[named]], c.mine[named])
    log_p = np.zeros(len(c.key))
    for st, gate, bit in spelled.bits(c.key, c.train):
        log_p += model.mixer.log10(st, gate, bit)
    out[c.new] += np.bincount(c.of, weights=log_p[c.at], minlength=len(c.new))
    return out


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"


def score_language(docs: DataFrame) -> DataFrame:
    """Score whole texts: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    Tokens are words, A-Z lower-cased, and one end for each text.  base_score is the unigram model with 0.5 added to all
    counts.  score is the log10 probability of the text, its kind (a hash of its most frequent token) told first.  Three contexts predict
    each bit: of A (the token follows its two predecessors in another training document) the last four A, the share of hits so far, and the
    kind; of B (another training document has the token) the last B, the share of new tokens so far, and the word before; of a spelled byte the
    last one, two and three bytes.  Their log-odds are mixed by gated weights and refined.  Chunks learn weights online and their mean is
    taken.  After A, a token is told among those that follow, by halves in the order of their hashes: each bit is predicted from the documents that
    have it there, those that have it after any predecessors of the shard, and the chunks.  After B (and after A of the first two tokens) it is told among all tokens: halves of
    the shards, then of the tokens of its shard, predicted from all documents, those of its kind, and rows of chunks.  These are mixed and refined alike,
    by weights that each shard learns online from all its rows; those of the shards themselves the driver learns from one row of totals a shard.

    All training documents (crc32 of the id modulo 5 is not 1) are counted, and what is gathered grows with them.  No document is scored by counts
    of itself: a training document's own are taken off first, so scores of both folds can be compared.  (Other tokens that it has after
    the same two predecessors stay in the whole that a share is of, which lowers the share.)  Predecessors are kept as 24 bits
    in a shard that the input sizes, next tokens as 24: fewer bits would let tokens take each other's share.

    Null and empty texts are one end.  Very long texts are scored whole.  Repeated rows count and are scored each.  A null doc_id is hashed
    as the empty text.  Of tokens as frequent in a document the smaller hash names the kind.  Other columns are not read.  An empty table
    gives an empty table.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    scratch = common.Scratch(spark, "mixing")
    docs = common.texts(docs)
    dealt, n = rounds.deal(docs)
    parts = max(3 * n, int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = rounds.ask(dealt, _ask(n)).repartition(parts, "shard")
    answers = scratch.save(asked.groupBy("shard").applyInArrow(_answer(n), rounds.ASK))
    common.release(spark)
    heads = answers.where("chunk = -1").select("shard", "keys").collect()
    if not heads:
        return spark.createDataFrame([], SCHEMA)
    totals = np.zeros((n, _TOTALS))
    for r in heads:
        totals[r["shard"]] = np.frombuffer(r["keys"], np.float64)
    answers = answers.where("chunk >= 0")
    lessons = scratch.save(dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_learn(n, n), rounds.ASK))
    common.release(spark)
    weights = _collect(lessons.where("shard = -1"), rounds.chunks_of(docs))
    cut = 2 * GATES * (PREDICTORS + BUCKETS)
    model = Model(int(totals[:, 0].sum()), int(totals[:, 1].sum()), Shards(totals), merged(weights[:cut]), weights[cut:].reshape(2, PREDICTORS, 2, SLOTS))
    shared = spark.sparkContext.broadcast(model)
    spelt = scratch.save(lessons.where("shard >= 0").repartition(parts, "shard").groupBy("shard").applyInArrow(_answer_spelt, rounds.ASK))
    scratch.drop(lessons)

    def run(t: pa.Table, got: pa.Table) -> pa.Table:
        model = shared.value
        spelled = np.frombuffer(b"".join(rounds.of_round(got, 1)["keys"].to_pylist()), _SPELT)
        spelled = spelled[np.lexsort((spelled["key"], spelled["order"]))]
        cut = np.searchsorted(spelled["order"], np.arange(1, ORDERS + 2))
        spelling = Spelling(*([spelled[x][a:b] for a, b in zip(cut[:-1], cut[1:])] for x in ("key", "count")))
        c = Chunk(t, rounds.of_round(got, 0), n)
        own, size = c.tokens, c.t.num_rows
        tally = lambda w: np.bincount(own.doc, weights=w, minlength=size)
        base = np.log10(c.total + 0.5) - np.log10(model.total + 0.5 * (model.distinct + 1))
        score = tally(log10_scores(c, model, spelling)) - np.log10(KINDS)
        n_bytes = tally(own.e - own.s + 1)
        return pa.table({
            "doc_id": c.t["doc_id"],
            "held_out": pa.array(~c.trains, pa.bool_()),
            "n_tokens": pa.array(np.bincount(own.doc, minlength=size).astype(np.int64)),
            "n_known": pa.array(tally(c.total > 0).astype(np.int64)),
            "train_tokens": pa.array([model.total] * size, pa.int64()),
            "base_score": pa.array(tally(base)),
            "score": pa.array(score),
            "n_bytes": pa.array(n_bytes.astype(np.int64)),
            "bits_per_byte": pa.array(-score * np.log2(10) / n_bytes),
        })

    return rounds.finish(dealt, run, SCHEMA, rounds.tagged(answers, spelt))
