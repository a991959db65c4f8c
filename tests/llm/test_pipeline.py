"""run() of the pipeline, stage by stage against brute force; and long texts, ties and kernels of its operators."""

import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from skein.llm import toxicity
from skein.llm.lines import dedup_lines
from skein.llm.packing import LENGTH, default_vocabulary, encoder, pack_documents
from skein.llm.private import find_private
from skein.llm.toxicity import drop_toxic, score_toxicity

WORD = re.compile(r"[^\x20\x09-\x0d]+")
BLANK = " \t\n\x0b\x0c\r"
LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, row int"


def _corpus():
    rng = np.random.default_rng(17)
    word = lambda: "".join(rng.choice(list("bcdfghklmnprstvw"), 2)) + rng.choice(list("aeo")) + "".join(rng.choice(list("lmnrst"), 2))
    line = lambda n: " ".join(word() for _ in range(n))
    items = [line(30) for _ in range(6)]
    shared = ["A line that many share", "  a LINE that many share\t", "short one"]
    rows = []
    for i in range(200):
        text = "\n".join(line(int(rng.integers(8, 20))) for _ in range(4))
        if i % 5 == 0:
            text += "\n" + shared[i % 3]
        if i % 4 == 1:
            text += "\n" + line(4) + " you idiot " + line(3)
        rows.append([i, text])
    for i in (2, 6, 10):  # copies with one word changed
        words = rows[i][1].split(" ")
        words[9] = "changed"
        rows.append([300 + i, " ".join(words)])
    rows += [[400, rows[3][1]], [7, rows[7][1]], [7, rows[7][1]], [None, line(40)], [401, None], [402, ""], [403, " \n\n "], [404, line(30) + "\n" + items[0] + "\n" + line(20)]]
    half = items[1].split()
    rows += [[405, line(30) + " " + " ".join(half[:15])], [406, items[2].upper()], [407, line(9000)]]
    return [(d, t, "en", "s", len(t or ""), "clash", 1) for d, t in rows], [(i, t) for i, t in enumerate(items)] + [(9, None)]


def _after_lines(rows):
    place = lambda d: (d is None, d or 0)
    key = lambda x: x.strip(BLANK).translate(LOW)
    first = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                first[key(x)] = min(first.get(key(x), place(d)), place(d))
    return [(d, "\n".join(x for x in (t or "").split("\n") if first.get(key(x), place(d)) == place(d))) for d, t in rows]


def _shingles(text):
    w = [x.translate(LOW) for x in WORD.findall(text or "")]
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def _after_groups(rows):
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    sets = [_shingles(t) for _, t in rows]
    holders, label = defaultdict(list), list(range(len(rows)))
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for a, b in sorted({(a, b) for h in holders.values() for a, b in itertools.combinations(h, 2)}):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
            low, high = sorted((label[a], label[b]))
            label = [low if x == high else x for x in label]
    return [r for i, r in enumerate(rows) if label[i] == i]


def test_run_matches_brute_force(spark, tmp_path):
    docs, items = _corpus()
    d = str(tmp_path)
    table = spark.createDataFrame(docs, SCHEMA)
    labels = spark.createDataFrame([(r[0], 1, int("idiot" in (r[1] or ""))) for r in docs if r[0] is not None and r[0] < 200], "doc_id long, quality int, toxic int")
    for name, df in (("documents", table), ("labels", labels), ("benchmark", spark.createDataFrame(items, "item_id long, text string"))):
        df.write.parquet(f"{d}/{name}.parquet")
    kept = [(r.doc_id, r.text) for r in drop_toxic(table, labels).collect()]
    clean = [r for r in docs if "idiot" not in (r[1] or "")]
    assert not any("idiot" in (t or "") for _, t in kept) and len(kept) >= 0.95 * len(clean)
    rows = _after_groups(_after_lines(kept))
    tests = [_shingles(t) for _, t in items if t]
    leaks = {i for i, t in rows if any(100 * len(x & _shingles(t)) >= 80 * len(x) for x in tests)}
    assert leaks == {404, 406}
    encode = encoder(default_vocabulary())
    want = Counter((i, np.append(encode(t), np.uint32(1)).astype("<u4").tobytes()) for i, t in rows if i not in leaks)
    _check_pieces(corpus_pipeline.run(spark, d).collect(), want)


def _check_pieces(rows, want):
    """Pieces hold each id of each document once; sequences have no gap, and are full or a power of two."""
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert set(by) == {i for i, _ in want}
    for i, ids in want:
        n, mine = len(ids) // 4, by[i]
        assert {r.doc_tokens for r in mine} == {len(x) // 4 for j, x in want if j == i}
        if sum(k for (j, _), k in want.items() if j == i) == 1:
            assert [r.start for r in sorted(mine, key=lambda r: r.start)] == [0, *itertools.accumulate(r.length for r in sorted(mine, key=lambda r: r.start))][:-1]
            assert sum(r.length for r in mine) == n and all(r.ids_crc32 == zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) for r in mine)
    sizes = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sizes[r.sequence_id] and r.length > 0
        sizes[r.sequence_id] += r.length
    assert all(n <= LENGTH for n in sizes.values())
    padding = sum(LENGTH - n for n in sizes.values() if n & (n - 1))
    assert padding <= 0.02 * sum(sizes.values())


def test_stages_of_an_empty_table(spark, tmp_path):
    docs, items = _corpus()
    for name, df in (("documents", spark.createDataFrame(docs[:1], SCHEMA).limit(0)), ("labels", spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").limit(0)), ("benchmark", spark.createDataFrame(items, "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_packing_of_long_tied_and_repeated_texts(spark):
    """Ids of a text of some 100,000 tokens, of texts of one cost, and of rows of one doc_id, checked piece by piece."""
    from pyspark.sql import functions as F

    texts = [(1, "long words follow " * 30_000), (2, None), (3, "")] + [(i, "equal cost") for i in range(10, 60)]
    encode = encoder(default_vocabulary())
    want = Counter((i, np.append(encode(t or ""), np.uint32(1)).astype("<u4").tobytes()) for i, t in texts)
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in texts], "doc_id long, text string, length int, ids string")
    _check_pieces(pack_documents(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset").collect(), want)


def test_long_lines_and_values(spark):
    """One line of some 3 MB, and a line with thousands of values: nothing is cut."""
    wide = "mail " + " ".join(f"user{i}@host{i % 7}.example.com" for i in range(3000))
    texts = [(1, "word " * 600_000), (2, "word " * 600_000), (3, wide), (4, wide + "\n+1 (988) 555-2485")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in dedup_lines(docs).collect()}
    assert [got[i].kept for i in (1, 2, 3, 4)] == ["word " * 600_000, "", wide, "+1 (988) 555-2485"]
    found = {r.doc_id: r for r in find_private(docs).collect()}
    assert [found[i].n_email for i in (1, 2, 3, 4)] == [0, 0, 3000, 3000] and found[4].n_phone == 1


def _subsequences(word):
    out = Counter()
    sym = [int(toxicity.FOLD[b]) for b in word]
    for p, longest in toxicity.ORDERS:
        for at in itertools.combinations(range(len(sym)), p):
            span = at[-1] - at[0]
            if span < longest and all(sym[i] for i in at):
                out[tuple(sym[i] for i in at)] += toxicity.GAP ** (span - p + 1)
    return out


def test_kernel_matches_brute_force():
    """Gapped subsequences of all words, the kernel's products, and margins of weighted sums of instances."""
    words = [b"idiot", b"id1ot", b"i-d-i-o-t", b"friend", b"idxiot", b"ab", b"", "здравствуй".encode()]
    f = toxicity.Features.of(words)
    plain = [_subsequences(w) for w in words]
    raw = np.array([[sum(v * y[k] for k, v in x.items()) for y in plain] for x in plain])
    # A place's weight enters the divisor by itself, before equal subsequences of a word are added up.
    squares = []
    for w in words:
        sym = [int(toxicity.FOLD[b]) for b in w]
        squares.append(sum((toxicity.GAP ** (at[-1] - at[0] - p + 1)) ** 2 for p, longest in toxicity.ORDERS for at in itertools.combinations(range(len(sym)), p) if at[-1] - at[0] < longest and all(sym[i] for i in at)))
    by = toxicity.scale(np.array(squares))
    assert np.allclose(toxicity.kernel(f, f), raw / by[:, None] / by[None, :])


def test_toxicity_of_odd_rows(spark):
    docs = [(i, f"a calm text number {i} " + ("you idiot" if i % 2 else "my friend"), 0.1, 1) for i in range(200)]
    docs += [(500, None, 0.1, 1), (501, "", 0.1, 1), (502, "calm words here " * 50_000, 0.1, 1), (503, "calm words here " * 50_000 + "you idiot", 0.1, 1), (None, "my friend", 0.1, 1), (9, "you idiot", 0.1, 1), (9, "you idiot", 0.1, 1)]
    table = spark.createDataFrame(docs, "doc_id long, text string, score double, predicted int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(500, None), (None, 1)], "doc_id long, toxic int")
    got = score_toxicity(table, labels).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    one = {r.doc_id: r.predicted for r in got}
    assert (one[500], one[501], one[503], one[None], one[9]) == (0, 0, 1, 0, 1)
