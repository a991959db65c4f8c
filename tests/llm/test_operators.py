"""Small fixtures against brute force: nulls, empty and repeated rows, ties, clashing columns, empty tables."""

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from skein.llm import common, jaccard, lines, mixing, private
from skein.llm.decontaminate import find_contained
from skein.llm.jaccard import link_documents
from skein.llm.lines import dedup_lines
from skein.llm.mixing import score_language
from skein.llm.neighbours import nearest
from skein.llm.packing import default_vocabulary, encoder, pack, pack_documents
from skein.llm.private import base_spans, find_private
from skein.llm.substrings import dedup_substrings
from skein.llm.suffixes import dedup_suffixes, earliest
from skein.llm.toxicity import score_toxicity

LONG = " ".join(f"word{i}" for i in range(120))
TEXTS = [(1, LONG), (2, None), (3, ""), (4, LONG + " and a tail of other words"), (5, "be " * 60), (6, "Short line here\nanother one that is long\n\tSHORT LINE HERE "), (7, "short line here\nmail me at joe.b@mail.example.com or 10.0.0.256 and 1.2.3.4"), (8, LONG), (8, LONG), (None, LONG), (9, "x\n" * 30)]
SCHEMA = "doc_id long, text string, words string, key int, chunk string, score double"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "clash", 1, None, 0.5) for i, t in TEXTS], SCHEMA)


def test_lines(docs):
    got = {r.doc_id: r for r in dedup_lines(docs).collect()}
    assert got[7].n_dropped == 1 and got[6].n_dropped == 0 and got[9].n_dropped == 0
    assert got[2].n_lines == 1 and got[2].kept == "" and got[8].kept == "" and got[None].kept == LONG


def test_substrings(docs):
    windows = Counter(tuple(w[i : i + 35]) for _, t in TEXTS for w in [WORD.findall(t or "")] for i in range(len(w) - 34))
    want = []
    for i, t in TEXTS:
        w = WORD.findall(t or "")
        gone = {k + j for k in range(len(w) - 34) if windows[tuple(w[k : k + 35])] > 1 for j in range(35)}
        want.append((i, len(w), " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert sorted(map(str, ((r.doc_id, r.n_words, r.kept) for r in dedup_substrings(docs).collect()))) == sorted(map(str, want))


def test_suffixes(docs):
    order = lambda i: math.inf if i is None else i
    first: dict[bytes, float] = {}
    for i, t in TEXTS:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(first.get(b[k : k + 50], math.inf), order(i))
    want = []
    for i, t in TEXTS:
        b = (t or "").encode()
        gone = {k + j for k in range(len(b) - 49) if first[b[k : k + 50]] < order(i) for j in range(50)}
        want.append((i, len(gone), bytes(x for k, x in enumerate(b) if k not in gone)))
    assert sorted(map(str, ((r.doc_id, r.n_removed, bytes(r.kept)) for r in dedup_suffixes(docs).collect()))) == sorted(map(str, want))


def test_interval_expansion():
    pieces = [np.frombuffer(x, np.uint8) for x in (b"abcabcabc", b"xabcabcy", b"cabcab")]
    got = earliest(pieces, np.array([3, 1, 2]), 5)
    windows = [(bytes(p[i : i + 5]), d) for p, d in zip(pieces, (3, 1, 2)) for i in range(len(p) - 4)]
    assert got.tolist() == [min(d for w, d in windows if w == x) for x, _ in windows]


def test_jaccard(docs):
    got = {r.doc_id: r for r in link_documents(docs).collect()}
    assert got[4].component_id == got[8].component_id == 1 and got[2].component_id == 2 and got[3].n_shingles == 0 and got[None].component_id is None


@pytest.mark.parametrize("block", [8, 1024])
def test_jaccard_near_copies(spark, monkeypatch, block):
    """A group of near copies at all distances from their original, and texts that share only a passage with it."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = np.random.default_rng(11)
    texts = []
    for i in range(90):
        w = LONG.split()
        for k in rng.choice(len(w), rng.integers(0, 6), replace=False):
            w[k] = f"new{i}x{k}"
        texts.append(" ".join(w if i % 6 else [f"own{i}x{k}" for k in range(60)] + w[20:80]))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    got = link_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), label[i]) for i in range(len(sets))}
    assert 15 < len(set(label)) < 75


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(100)] + [(100, [0.0] * 8), (101, None), (102, [None] * 8), (103, [float("nan")] * 8), (104, [1.0, 2.0])]
    rows[7] = (7, rows[3][1])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(df, df.where("vec_id % 20 = 0"), 5).collect()
    m = np.array([r[1] for r in rows[:100]])
    for q in range(0, 100, 20):
        s = (m * m[q]).sum(axis=1)
        want = [i for i in np.lexsort((np.arange(100), -s)) if i != q][:5]
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == want


def test_packing(docs):
    rows = pack_documents(docs).collect()
    encode = encoder(default_vocabulary())
    assert sum(r.length for r in rows) == sum(len(encode(t or "")) + 1 for _, t in TEXTS)
    sizes = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sizes[r.sequence_id]
        sizes[r.sequence_id] += r.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in sizes.values())
    doc, start, length, seq, offset = pack(np.array([5000, 1, 2047, 2048, 700, 700, 700]))
    assert length.sum() == 5000 + 1 + 2047 + 2048 + 2100


def test_ids_match_the_tokenizers_library():
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(default_vocabulary())
    for text in (LONG, "Éleù ß\n\n  x  1234", " " * 40, ""):
        assert encoder(default_vocabulary())(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_language(docs):
    rows = score_language(docs).collect()
    assert len(rows) == len(TEXTS)
    train = [t for i, t in TEXTS if zlib.crc32(str(i if i is not None else "").encode()) % 5 != 1]
    assert rows[0].train_tokens == sum(len(WORD.findall(t or "")) + 1 for t in train)
    assert all(r.score < 0 for r in rows)


def _tokens(text):
    return [w.lower() for w in WORD.findall(text or "")] + [""]


def _held_out(i):
    return zlib.crc32(str(i if i is not None else "").encode()) % 5 == 1


def test_language_counts_match_brute_force(spark):
    """Fixed columns, beside a text of over 1 MiB, repeated rows and null ids, whatever shards the words are dealt to."""
    rng = np.random.default_rng(3)
    texts = [(i, " ".join("".join(rng.choice(list("abC"), rng.integers(1, 5))) for _ in range(30))) for i in range(60)] + TEXTS + [(3, "x" * 300 + f" {i}") for i in range(45)] + [(50, "zq " * 400_000)]
    count = Counter(w for i, t in texts if not _held_out(i) for w in _tokens(t))
    total = sum(count.values())
    want = []
    for i, t in texts:
        w = _tokens(t)
        base = sum(math.log10((count[x] + 0.5) / (total + 0.5 * (len(count) + 1))) for x in w)
        want.append((i if i is not None else -1, _held_out(i), len(w), sum(count[x] > 0 for x in w), total, round(base, 3)))
    got = score_language(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in got) == sorted(want)


def test_language_codes_match_brute_force():
    """The share of a token after its two predecessors in other training documents, by (chunk's) documents."""
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(list("abcd"), 40)) for _ in range(30)]
    trains = np.arange(30) % 3 > 0
    data, off = common.packed(pa.array(texts))
    t = mixing.Tokens(data, off)
    key, train, count, of = t.follows(trains)
    code = np.frombuffer(mixing._answer_follows([mixing._pack_follows(key)], [mixing._pack_counts(train, count)])[0], np.uint8)[of]
    opening = np.empty(len(t.openings(trains)[0]), mixing._OPENING)
    opening["key"], opening["count"] = t.openings(trains)[:2]
    first, second = mixing.opening_codes(t, trains, int(trains.sum()), np.frombuffer(mixing._answer_openings([opening.tobytes()])[0], np.uint32))
    code = np.where(t.place == 0, first[t.doc], np.where(t.place == 1, second[t.doc], code))
    grams = [[(["", ""] + _tokens(x))[k : k + 3] for k in range(len(_tokens(x)))] for x in texts]
    holds = [set(map(tuple, g)) for g in grams]
    at = 0
    for d, g in enumerate(grams):
        for x, y, z in g:
            others = [h for e, h in enumerate(holds) if trains[e] and e != d]
            this = sum((x, y, z) in h for h in others)
            whole = sum(u[:2] == (x, y) for e, h in enumerate(holds) if trains[e] for u in h) - trains[d]
            if this:
                assert code[at] >= mixing.HIT and abs((code[at] - mixing.HIT) * math.log(mixing.SHARE) - math.log(whole / this)) <= math.log(mixing.SHARE)
            else:
                assert code[at] == (mixing.MISS if whole else mixing.UNSEEN)
            at += 1
    assert at == len(code)


def test_language_asks_once_a_chunk():
    """Neither a first token, an opening nor a phrase that all documents have brings a row for each document to a shard."""
    texts = [f"w{i % 150} of {i % 3} one and the same phrase in all of them" for i in range(3000)]
    chunk = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts), "chunk": pa.array([0] * len(texts), pa.int32())})
    n = 8
    asked = mixing._ask(n)(chunk, None).to_pylist()
    follows = [len(r["keys"]) // mixing._FOLLOW for r in asked if n <= r["shard"] < 2 * n]
    openings = [len(r["keys"]) // mixing._OPENING.itemsize for r in asked if r["shard"] >= 2 * n]
    # After two predecessors: 450 times "3" after an opening, 3 times "one", 3 times "and", 7 more and the end; each of both folds.
    assert sum(follows) <= 2 * (450 + 3 + 3 + 8) and sum(openings) == 300 and max(openings) < 80


@pytest.mark.parametrize("many", [1, 64, 65, 5000])
def test_sums_by_levels(spark, many):
    rows = spark.range(500).selectExpr("cast(id AS int) AS chunk", "0 AS shard").collect()
    vectors = [(r.chunk, r.shard, np.array([r.chunk, 1.0]).tobytes()) for r in rows]
    got = mixing._collect(spark.createDataFrame(vectors, "chunk int, shard int, keys binary"), many)
    assert got.tolist() == [500 * 499 / 2, 500]
    assert mixing._collect(spark.createDataFrame([], "chunk int, shard int, keys binary"), many) is None


def test_language_learns(spark):
    """Texts of a fixed form that is held out cost fewer bits than by the base, and unknown words cost the more the longer they are."""
    texts = [(i, f"the quick brown fox number {i % 9} jumps over the lazy dog and runs home") for i in range(300)]
    texts += [(1000, "wxq"), (1001, "wxqwxqwxqvvkkj")]
    got = {r.doc_id: r for r in score_language(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    held = [r for r in got.values() if r.held_out and r.doc_id < 300]
    assert held and all(r.base_score < r.score < 0 for r in held) and got[1001].score < got[1000].score


def test_private(docs):
    got = {r.doc_id: r for r in find_private(docs).collect()}
    assert (got[7].n_email, got[7].n_ip) == (1, 1) and got[2].spans == ""
    assert base_spans("a@b@c.d 4111 1111 1111 1111 +1 (988) 555-2485") == [("email", 2, 7), ("card", 8, 27), ("phone", 28, 45)]


@pytest.mark.parametrize("in_memory", [100_000, 0])
def test_private_terms_away_from_their_value(spark, monkeypatch, in_memory):
    """A term that gives a value away is found in lines and documents without the value too, but not inside base spans."""
    monkeypatch.setattr(private, "IN_MEMORY", in_memory)
    texts = [f"line{i} Zorblax writes from z@example.com today {i}" for i in range(8)] + ["only Zorblax is here\nand ZORBLAX@mail.example.org\nzorblax", "nothing at all"] * 2
    texts += [f"calm words today from line {i}" for i in range(200)]
    got = {r.doc_id: r.spans for r in find_private(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert "term:6:13" in got[0] and got[8] == got[10] == "email:25:49,term:5:12,term:50:57" and got[9] == got[100] == ""


def test_private_counts_repeated_lines_alike(spark):
    """Repeated lines and rows count in all parts of a term's information, so they do not hide it."""
    texts = [(i, "\n".join([f"line{i} Zorblax writes from z@example.com"] * 40)) for i in range(6)] * 3
    texts += [(i, f"calm words from line {i}") for i in range(100, 300)]
    got = {r.doc_id: r.spans for r in find_private(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert "term:6:13" in got[0] and got[200] == ""


def test_contained(spark, docs):
    items = spark.createDataFrame([(1, " ".join(f"WORD{i}" for i in range(10, 30))), (2, "none of these words is there at all"), (3, None), (4, "of other words")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in find_contained(docs, items).collect()}
    assert got == {(1, 1), (4, 1), (8, 1), (4, 4)}


def test_contained_pools_the_rows_of_an_item(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(20)) for x in "ab")
    docs = spark.createDataFrame([(1, a), (2, b), (3, a + " between " + b)], "doc_id long, text string")
    items = spark.createDataFrame([(7, None), (7, a), (8, a), (8, b), (9, b), (9, b)], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_item) for r in find_contained(docs, items).collect()}
    assert got == {(1, 7, 16), (3, 7, 16), (3, 8, 32), (2, 9, 16), (3, 9, 16)}


def test_toxicity(spark):
    docs = spark.createDataFrame([(i, f"a calm text number {i} " + ("you idiot" if i % 2 else "my friend") + f" word{i % 7}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    got = score_toxicity(docs, labels).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got if r.held_out)
    assert {r.predicted for r in score_toxicity(docs, labels.limit(0)).collect()} == {0}


@pytest.mark.parametrize("run", [dedup_lines, dedup_substrings, dedup_suffixes, link_documents, pack_documents, find_private, score_language])
def test_empty_table(docs, run):
    assert run(docs.limit(0)).count() == 0


def test_a_line_in_all_documents_is_asked_about_once_a_chunk(spark):
    """No shard gets a row for each document that holds a line: one for each chunk, whatever the number of documents."""


    hot = "the same line in all documents"
    docs = pa.table({"doc_id": pa.array(range(3000), pa.int64()), "text": [f"{hot}\nown line of number {i}\n{hot}" for i in range(3000)]})
    asked = lines._ask(np.array([1000, 2000]), 4)(docs)
    keys = np.concatenate(lines._open(asked["keys"]))
    assert len(keys) == 3000 + 3 and np.unique(keys[["h1", "h2"]], return_counts=True)[1].max() == 3
    df = spark.createDataFrame([(i, f"{hot}\nown line of number {i}") for i in range(500)], "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in lines.dedup_lines(df).collect()}
    assert got == {i: (2, int(i > 0), f"own line of number {i}" if i else f"{hot}\nown line of number 0") for i in range(500)}


def test_copies_are_indexed_once_a_slab():
    """However many documents of a slab have one set, its signatures are sent once; and other sets' are those that they have alone."""
    texts = ["one two three four five six seven eight nine ten " * 3, "alpha beta gamma delta epsilon zeta eta theta"]
    batch = lambda *t: pa.record_batch({"text": pa.array(t)})
    sent = lambda b: sorted((s, k, x) for r in jaccard._index(5, 80, 4)(iter([b])) for s, ks, xs in zip(*(r.column(c).to_pylist() for c in ("shard", "keys", "signatures"))) for k, x in zip(np.frombuffer(ks, np.uint64).tolist(), np.frombuffer(xs, np.uint32).tolist()))
    assert sent(batch(*texts[:1] * 500, texts[1], "", None)) == sent(batch(*texts)) and len(sent(batch(*texts))) > 4


def _by_halves(mixer, low, high, at, below, own):
    """The log10 probability of a rank, bit by bit."""
    out = 0.0
    while high - low > 1:
        mid = (low + high) // 2
        bit = at >= mid
        odds = []
        for counts, mine in zip(below, own):
            n = [sum(counts[low:mid]), sum(counts[mid:high])]
            n[bit] -= mine
            odds.append(min(max(math.log((max(n[1], 0) + mixing.PRIOR) / (max(n[0], 0) + mixing.PRIOR)), -12), 12))
        gate = min(int(math.log2(high - low)), mixing.HALVES - 1) * 3 + (odds[0] != 0) + (abs(odds[0]) > mixing.SURE)
        p = mixer.predict(np.array([odds]), np.array([gate]))[0][0]
        out += math.log10(p if bit else 1 - p)
        low, high = (mid, high) if bit else (low, mid)
    return out


def test_language_tokens_by_mixed_bits(monkeypatch):
    """A known token, and one that follows, are told by mixed bits as brute force tells them; the probabilities of all tokens sum to 1, and learning moves the weights."""
    kept, learn = [], mixing.learned
    monkeypatch.setattr(mixing, "learned", lambda *a: kept.append(learn(*a)) or kept[-1])
    rng = np.random.default_rng(6)
    n = 50
    rows = np.empty(n * 8, mixing._COUNT)
    rows["key"] = np.repeat(np.sort(rng.integers(1, 1 << 60, n, dtype=np.uint64)), 8)
    rows["kind"], rows["own"] = np.tile([0, 0, 1, 1, 2, 2, 3, 3], n), np.tile([0, 2], 4 * n)
    rows["count"] = np.where(rows["own"] > 0, 2 * rng.integers(0, 9, n * 8) * (rng.random(n * 8) < 0.4), 0)
    got, head = mixing._answer_tokens([mixing._columns(rows[:160]), mixing._columns(rows[160:])])
    got = np.concatenate([mixing._records(x, mixing._TOLD) for x in got])
    log10 = got["steps"] / -mixing.FINE
    keys = np.unique(rows["key"])
    total = np.array([rows["count"][rows["key"] == k].sum() for k in keys])
    keys = keys[total > 0]
    all_, seen = ([int(f(rows[rows["key"] == k])) for k in keys] for f in (lambda r: r["count"].sum(), lambda r: (r["count"] > 0).sum()))
    for kind in range(4):
        of_kind = [int(rows["count"][(rows["key"] == k) & (rows["kind"] == kind)].sum()) for k in keys]
        fresh = [float(log10[(rows["key"] == k) & (rows["kind"] == kind) & (rows["own"] == 0)][0]) for k in keys]
        assert abs(sum(10**x for x in fresh) - 1) < 2e-3
        for own in (0, 2):
            for at, k in enumerate(keys):
                if all_[at] > own:
                    want = _by_halves(kept[0], 0, len(keys), at, (all_, of_kind, seen), (own, own, min(own, 1)))
                    assert abs(float(log10[(rows["key"] == k) & (rows["kind"] == kind) & (rows["own"] == own)][0]) - want) < 1 / mixing.FINE + 1e-6
    assert np.abs(kept[0].weights - 0.4).max() > 0.01
    assert np.frombuffer(head, np.float64)[:3].tolist() == [len(keys), sum(all_), sum(seen)]

    key = np.sort(rng.choice(np.arange(3 * 40, dtype=np.uint64), 90, replace=False))
    key = (key // np.uint64(40)) << np.uint64(24) | key % np.uint64(40)
    count = rng.integers(0, 6, 90)
    key, train, count = np.concatenate((key, key[count > 0])), np.concatenate((np.zeros(90, bool), np.ones((count > 0).sum(), bool))), np.concatenate((np.zeros(90, np.int64), count[count > 0]))
    order = np.lexsort((train, key))
    key, train, count = key[order], train[order], count[order]
    code = np.frombuffer(mixing._answer_follows([mixing._pack_follows(key)], [mixing._pack_counts(train, count)], mixed=True)[0], np.uint8)
    share = np.frombuffer(mixing._answer_follows([mixing._pack_follows(key)], [mixing._pack_counts(train, count)])[0], np.uint8)
    by = {k: int(count[key == k].sum()) for k in np.unique(key)}
    anywhere = Counter()
    for k, v in by.items():
        anywhere[int(k) & 0xFFFFFF] += v
    assert ((code < mixing.HIT) == (share < mixing.HIT)).all() and (code != share).any()
    for k, t, c in zip(key, train, code):
        inside = [x for x in by if int(x) >> 24 == int(k) >> 24 and by[x]]
        if by[k] > t:
            below = [by[x] for x in inside], [anywhere[int(x) & 0xFFFFFF] for x in inside], [1] * len(inside)
            want = _by_halves(kept[1], 0, len(inside), inside.index(k), below, (t, t, t))
            assert abs((c - mixing.HIT) * math.log10(mixing.SHARE) + want) <= math.log10(mixing.SHARE) + 1e-9


def test_language_shards_by_mixed_bits():
    """The probabilities of all shards sum to 1 for each kind, also for numbers of shards that are no power of two."""
    rng = np.random.default_rng(7)
    totals = np.zeros((11, mixing._TOTALS))
    totals[:, 3:] = rng.integers(0, 90, (11, mixing.KINDS)) * (rng.random((11, mixing.KINDS)) < 0.5)
    totals[:, 1], totals[:, 2] = totals[:, 3:].sum(axis=1), 20
    shards = mixing.Shards(totals)
    every = (np.arange(11, dtype=np.uint64) * np.uint64((1 << 64) // 11)) + np.uint64(1 << 40)
    for kind in range(mixing.KINDS):
        got = shards.log10(every, np.full(11, kind), np.zeros(11, np.int64))
        assert abs((10**got).sum() - 1) < 1e-6


def test_language_follows_in_little_memory():
    """A shard's answers take a bounded number of bytes for each key asked, whatever the number of keys, as two shards share an executor."""
    rng, n = np.random.default_rng(8), 1 << 18
    keys, counted = [], []
    for _ in range(4):
        key = np.sort((rng.integers(0, n // 2, n).astype(np.uint64) << np.uint64(24)) | rng.integers(0, 4, n).astype(np.uint64))
        train = rng.random(n) < 0.8
        keys.append(mixing._pack_follows(key))
        counted.append(mixing._pack_counts(train, train * rng.integers(1, 4, n)))
    tracemalloc.start()
    try:
        mixing._answer_follows(keys, counted, mixed=True)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 90 * 4 * n
