"""Exact Jaccard join of word-shingle sets: universe partition, pigeonhole, one-deletion neighbourhoods."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm import common
from skein.llm.graph import components, merged, of_label
from skein.llm.rounds import shard_of

WORDS = 5
#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Ratio of the sizes in a band; segments beyond those that the pigeonhole needs, as a share and a number.
RATIO, SPARE = 1.5, 0.1
#: Bands up to this size index one-deletion neighbourhoods too.
DELETIONS = 48
#: Guess of how many times rarer a segment gets with each shingle that it holds; sets the costs of the allocation.
RARER = 8.0
LOOKS_UP, EXACT = 1, 2
#: Cells of a set's profile: how many of its shingles each part of the universe holds.
PROFILE = 256
#: Sets of a group that are compared at once, in the groups that verified pairs have left in several components.
BLOCK = 1024

_U = np.uint64


def bands(largest: int) -> np.ndarray:
    """The first size of each band, up to ``largest``."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(out[-1] * RATIO)))
    return np.array(out)


def allowed(size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """How many shingles a set of ``size`` and a linked one that is no smaller can differ by.

    With d different and s = both sizes, the link asks d * (100 + percent) <= s * (100 - percent); the larger has at
    most 100 / percent times the size of the smaller.
    """
    return (size * (100 + percent) * (100 - percent)) // (percent * (100 + percent))


def segments(edges: np.ndarray, band: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Number of segments of a band: more than its largest set may differ by, and some to spare for empty ones."""
    need = allowed(edges[band + 1] - 1, percent) + 1
    return np.where(need > 1, need + 1 + (need * SPARE).astype(np.int64), 1)


def signatures(doc: np.ndarray, h: np.ndarray, n_docs: int, percent: int = PERCENT):
    """Signatures of sets, given as (document, hash) sorted by both: arrays of document, signature, and flags.

    LOOKS_UP: the segments that a set looks up as the smaller of a pair.  One of them equals the partner's, or is one
    deletion away, since the allocated radii add up to more than the pair may differ by.  Without it: all its segments, in its own band
    and in those of its smaller partners.  EXACT: a segment itself, not its one-deletion neighbourhood; one of a pair must be.
    """
    size = np.bincount(doc, minlength=n_docs)
    edges = bands(int(size.max(initial=1)))
    own = np.searchsorted(edges, size, "right") - 1
    hm = common.mix(h ^ _U(0x5851F42D4C957F2D))
    out = [[], [], []]

    def put(d, sig, looks_up, exact):
        out[0].append(d)
        out[1].append(sig)
        out[2].append((np.broadcast_to(looks_up, len(d)) * LOOKS_UP + exact * EXACT).astype(np.uint8))

    step = 0
    while True:
        band = own - step
        live = (size > 0) & (band >= 0)
        live &= (edges[np.maximum(band, 0) + 1] - 1) * 100 >= size * percent
        if not live.any():
            break
        pick = live[doc]
        d, x = doc[pick], hm[pick]
        m = segments(edges, np.maximum(band, 0), percent)
        seg = (((h[pick] >> _U(32)) * m[d].astype(np.uint64)) >> _U(32)).astype(np.int64)
        width = np.where(live, m, 0)
        base = np.cumsum(width) - width
        total = int(width.sum())
        of = np.repeat(np.arange(n_docs), width)
        number = np.arange(total) - base[of]
        cell = base[d] + seg
        count = np.bincount(cell, minlength=total)
        ends = np.concatenate(([0], np.cumsum(count)))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)))
        content = sums[ends[1:]] - sums[ends[:-1]]
        salt = common.mix(((band[of].astype(np.uint64) + _U(1)) << _U(40)) + number.astype(np.uint64))
        exact = common.mix(content ^ salt)
        small = edges[np.maximum(band, 0) + 1] - 1 <= DELETIONS
        near = small[d]
        deleted = common.mix((content[cell[near]] - x[near]) ^ salt[cell[near]])
        if step:
            put(of, exact, False, True)
            put(d[near], deleted, False, False)
        else:
            radius = allocate(of, count, allowed(size, percent) + 1, small[of])
            put(of, exact, radius > 0, True)
            put(d[near], deleted, radius[cell[near]] > 1, False)
        step += 1
    return tuple(np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(out, (np.int64, np.uint64, np.uint8)))


def allocate(of: np.ndarray, count: np.ndarray, need: np.ndarray, small: np.ndarray) -> np.ndarray:
    """For each segment 0 (not looked up), 1 (itself) or 2 (its one-deletion neighbourhood too), at least cost.

    A look-up costs the matches expected of it.  Steps from 0 to 1 and from 1 to 2 each add one to the sum of radii, so a
    document takes its ``need`` cheapest steps.  Larger radii exist in small bands only.
    """
    n = np.minimum(count, 12).astype(float)
    first = RARER**-n
    second = np.where(small & (count > 1), (n + 1) * RARER ** -(n - 1) - first, np.inf)
    doc = np.concatenate((of, of))
    cost = np.concatenate((first, second))
    item = np.concatenate((np.arange(len(of)), np.arange(len(of))))
    order = np.lexsort((item, cost, doc))
    begin = np.searchsorted(doc[order], np.arange(len(need)))
    taken = order[np.arange(len(order)) - begin[doc[order]] < need[doc[order]]]
    return np.bincount(item[taken], minlength=len(of))


def _set_keys(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.bincount(doc, minlength=n)
    ends = np.concatenate(([0], np.cumsum(size)))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(common.mix(h ^ _U(0x2545F4914F6CDD1D)), dtype=np.uint64)))
    return common.mix((sums[ends[1:]] - sums[ends[:-1]]) + size.astype(np.uint64) * _U(0x9E3779B97F4A7C15)), size


def _summary(words: int):
    def run(batches):
        for b in batches:
            data, off = common.packed(b.column("text"))
            for i, j in common.slabs(off):
                doc, h = common.shingles(data[off[i] : off[j]], off[i : j + 1] - off[i], words)
                key, size = _set_keys(doc, h, j - i)
                part = b.slice(i, j - i)
                cell = doc * PROFILE + ((h >> _U(32)) % _U(PROFILE)).astype(np.int64)
                profile = np.minimum(np.bincount(cell, minlength=PROFILE * (j - i)), 255).astype(np.uint8)
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"),
                    "row": part.column("row"),
                    "n_shingles": pa.array(size.astype(np.int64)),
                    "key": pa.array(key.view(np.int64)),
                    "profile": pa.array([profile[k : k + PROFILE].tobytes() for k in range(0, len(profile), PROFILE)], pa.binary()),
                })

    return run


def _index(words: int, percent: int, n: int):
    """The signatures of a slab of documents, one row for each shard; of the documents of one set, however many, those of the first."""

    def run(batches):
        for b in batches:
            data, off = common.packed(b.column("text"))
            for i, j in common.slabs(off, 2 * common.SLAB):
                doc, h = common.shingles(data[off[i] : off[j]], off[i : j + 1] - off[i], words)
                key, _ = _set_keys(doc, h, j - i)
                once = np.zeros(j - i, bool)
                once[np.unique(key, return_index=True)[1]] = True
                doc, h = doc[once[doc]], h[once[doc]]
                d, sig, flags = signatures(doc, h, j - i, percent)
                shard = shard_of(sig, n)
                order = np.lexsort((d, shard))
                d, shard = d[order], shard[order]
                low = (sig[order].astype(np.uint32) << np.uint32(2)) | flags[order]
                keys = key[d]
                cut = np.searchsorted(shard, np.arange(n + 1, dtype=np.uint64))
                made = np.flatnonzero(np.diff(cut)).tolist()
                yield pa.record_batch({
                    "shard": pa.array(made, pa.int32()),
                    "keys": pa.array([keys[cut[s] : cut[s + 1]].tobytes() for s in made], pa.binary()),
                    "signatures": pa.array([low[cut[s] : cut[s + 1]].tobytes() for s in made], pa.binary()),
                })

    return run


def _meet(t: pa.Table) -> pa.Table:
    """Sets that share a signature: a star of pairs for each group (kind 0), and groups of three or more (kind 1 + flags)."""
    key = np.concatenate([np.frombuffer(x, np.uint64) for x in t["keys"].to_pylist()])
    sig = np.concatenate([np.frombuffer(x, np.uint32) for x in t["signatures"].to_pylist()])
    order = np.lexsort((key, sig >> 2))
    key, flags, sig = key[order], (sig[order] & 3).astype(np.uint8), sig[order] >> 2
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])
    at = np.flatnonzero(new)
    flags = np.bitwise_or.reduceat(flags, at)
    key, sig = key[at], sig[at]
    head = np.ones(len(key), bool)
    head[1:] = sig[1:] != sig[:-1]
    begin = np.flatnonzero(head)
    size = np.diff(np.append(begin, len(key)))
    good = (size > 1) & (np.bitwise_or.reduceat(flags, begin) == (LOOKS_UP | EXACT))
    group = np.repeat(np.arange(len(begin)), size)
    keep = good[group]
    key, group, flags = key[keep], group[keep], flags[keep]
    exact = np.flatnonzero(flags & EXACT)
    pivot_at = exact[np.searchsorted(group[exact], np.flatnonzero(good))]
    pivot = np.repeat(key[pivot_at], size[good])
    looks = np.repeat(flags[pivot_at] & LOOKS_UP, size[good]) | (flags & LOOKS_UP)
    real = (pivot != key) & (looks > 0)
    pairs = np.unique(np.stack([np.minimum(pivot, key), np.maximum(pivot, key)])[:, real], axis=1) if real.any() else np.zeros((2, 0), np.uint64)
    large = (size > 2)[group]
    key, group, flags = key[large], group[large], flags[large]
    heads = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    count = np.diff(np.append(heads, len(group)))
    name = common.mix(np.add.reduceat(common.mix(key + flags), heads)) if len(heads) else np.zeros(0, np.uint64)
    _, first = np.unique(name, return_index=True)
    chosen = np.zeros(len(heads), bool)
    chosen[first] = True
    chosen = np.repeat(chosen, count)
    gid, key, flags = np.repeat(name, count)[chosen], key[chosen], flags[chosen]
    return pa.table({
        "kind": pa.array(np.concatenate((np.zeros(pairs.shape[1], np.int32), 1 + flags.astype(np.int32)))),
        "a": pa.array(np.concatenate((pairs[0], gid)).view(np.int64)),
        "b": pa.array(np.concatenate((pairs[1], key)).view(np.int64)),
    })


def _apart(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The least number of shingles that sets with these profiles differ by."""
    return np.abs(one.astype(np.int16) - two.astype(np.int16)).sum(axis=1, dtype=np.int64)


def _profiles(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, PROFILE)


def _close(pairs: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """Of pairs of set keys (a, b) those that sizes and profiles let link."""

    def run(batches):
        for b in batches:
            far = _apart(_profiles(b.column("profile_a")), _profiles(b.column("profile_b")))
            size = b.column("n_a").to_numpy() + b.column("n_b").to_numpy()
            yield b.filter(pa.array(far * (100 + percent) <= size * (100 - percent))).select(["a", "b"])

    own = named.select("key", "n_shingles", "profile")
    pairs = pairs.join(own.toDF("a", "n_a", "profile_a"), "a").join(own.toDF("b", "n_b", "profile_b"), "b")
    pairs = pairs.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return pairs.mapInArrow(run, "a long, b long")


def _cell(t: pa.Table, percent: int, nearest: bool):
    """Pairs between the components of one group's block, or of two blocks, that sizes and profiles let link."""
    key, flags, size = (t[c].to_numpy() for c in ("key", "flags", "n_shingles"))
    label, block, profile = t["label"].to_numpy(), t["block"].to_numpy(), _profiles(t["profile"])
    n, whole = len(key), block.min() == block.max()
    best = np.full(n, np.iinfo(np.int64).max)
    for i in range(0, n, 64):
        row = np.arange(i, min(n, i + 64))[:, None]
        fits = (label[row] != label) & ((flags[row] | flags) == (LOOKS_UP | EXACT))
        fits &= 100 * np.minimum(size[row], size) >= percent * np.maximum(size[row], size)
        fits &= (row < np.arange(n)) & (whole | (block[row] != block))
        x, y = np.nonzero(fits)
        x += i
        for k in range(0, len(x), 8192):
            a, b = x[k : k + 8192], y[k : k + 8192]
            far = _apart(profile[a], profile[b])
            near = far * (100 + percent) <= (size[a] + size[b]) * (100 - percent)
            a, b, far = a[near], b[near], far[near] << 32
            if nearest:
                np.minimum.at(best, a, far | b)
                np.minimum.at(best, b, far | a)
            elif len(a):
                yield key[a], key[b]
    if nearest:
        a = np.flatnonzero(best < np.iinfo(np.int64).max)
        yield key[a], key[best[a] & 0xFFFFFFFF]


def _across(members: DataFrame, labels: DataFrame, named: DataFrame, percent: int, nearest: bool, shards: int) -> DataFrame:
    """Pairs (a < b) of sets of one group and different components that sizes and profiles let link; with ``nearest``,
    only each set's nearest in a block.

    Groups are split into blocks of about BLOCK sets, and every two blocks meet, so a task's memory is bounded.
    """
    members = members.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    mixed = members.groupBy("gid").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    members = members.join(mixed.select("gid", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "gid").join(named.select("key", "n_shingles", "profile"), "key")
    members = members.withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.withColumn("cell", F.xxhash64("gid", F.least("block", "other"), F.greatest("block", "other"))).drop("blocks", "other", "gid")

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("cell", "ascending"), ("key", "ascending")]).combine_chunks()
        cell = t["cell"].to_numpy()
        cuts = np.append(np.flatnonzero(np.append(True, cell[1:] != cell[:-1])), len(cell))
        found = [p for i, j in zip(cuts[:-1], cuts[1:]) for p in _cell(t.slice(i, j - i), percent, nearest)]
        a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.table({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})

    members = members.withColumn("shard", F.pmod("cell", F.lit(shards)).cast("int"))
    return members.repartition(shards, "shard").groupBy("shard").applyInArrow(run, "a long, b long").distinct()


def _verify(pairs: DataFrame, text_of: DataFrame, words: int, percent: int) -> DataFrame:
    """Of pairs of set keys (a, b) those that link, counted on the texts of one document of each key."""

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                sides = []
                for c in ("text_a", "text_b"):
                    data, off = common.packed(part.column(c))
                    sides.append(common.shingles(data, off, words))
                n = part.num_rows
                size = [np.bincount(d, minlength=n) for d, _ in sides]
                doc, h = (np.concatenate(x) for x in zip(*sides))
                order = np.lexsort((h, doc))
                doc, h = doc[order], h[order]
                same = (doc[1:] == doc[:-1]) & (h[1:] == h[:-1])
                both = np.bincount(doc[1:][same], minlength=n)
                linked = 100 * both >= percent * (size[0] + size[1] - both)
                yield pa.record_batch([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(linked))

    pairs = pairs.select("a", "b").join(text_of.toDF("b", "text_b"), "b").join(text_of.toDF("a", "text_a"), "a")
    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def link_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Link documents whose sets of distinct word shingles have a Jaccard similarity of ``percent`` or more.

    Returns doc_id, row (a hash of the text), n_shingles, set_key (documents with equal sets share it), component_key (linked sets share
    it), component_id (the smallest doc_id that links reach, its own included) and n_links (to other sets; a lower bound within large
    groups, where links that could not change a component are not counted).

    Sets fall into bands by size; a band hashes the universe of shingles into so many segments that of two
    linked sets at least one segment is equal or one deletion away, whichever radii the smaller one
    allocates.  Signatures meet in shards.  Of every group of sets with one signature a star of pairs is verified.  Where a
    group still spans several components, each set is verified against its nearest of another component by profile, and then
    all pairs that are left between components and that sizes and profiles let link: sets differ by no less than their
    profiles do, so no link that joins components is missed, and only such pairs leave the blocks of a group.

    A-Z is lower-cased.  A text of fewer words than ``words`` has its whole sequence as its one shingle.  Null, empty and blank texts
    have none and link with nothing.  Very long texts are read whole.  Repeated rows share a component.  Rows without doc_id come back with
    their own null as component and take no part.  Other columns are not read.  An empty table gives an empty table.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    scratch = common.Scratch(spark, "jaccard")
    docs = common.texts(docs).withColumn("row", F.xxhash64("text"))
    n = common.parts(docs)
    summary = scratch.save(docs.mapInArrow(_summary(words), "doc_id long, row long, n_shingles long, key long, profile binary"))
    full = summary.where("doc_id is not null and n_shingles > 0")
    named = scratch.save(full.groupBy("key").agg(F.min(F.struct("doc_id", "row")).alias("rep"), F.max("n_shingles").alias("n_shingles"), F.max("profile").alias("profile")))
    docs = docs.where("doc_id is not null")
    index = docs.mapInArrow(_index(words, percent, n), "shard int, keys binary, signatures binary")
    met = index.repartition(n, "shard").groupBy("shard").applyInArrow(_meet, "kind int, a long, b long")
    met = scratch.save(met.distinct())
    common.release(spark)
    stars = met.where("kind = 0").select("a", "b")
    held = stars.select(F.col("a").alias("key")).union(stars.select("b")).union(met.where("kind > 0").select("b")).distinct()
    reps = named.join(held, "key").select("key", "rep.doc_id", "rep.row")
    # Repeated rows agree in doc_id and text; one of them is read.
    text_of = scratch.save(docs.join(reps, ["doc_id", "row"]).groupBy("key").agg(F.first("text").alias("text")))
    common.release(spark)
    links = scratch.save(_verify(_close(stars, named, percent), text_of, words, percent).distinct())
    labels = components(links, scratch)

    members = met.where("kind > 0").select(F.col("a").alias("gid"), F.col("b").alias("key"), (F.col("kind") - 1).alias("flags"))
    rows = members.groupBy("gid").count().agg(F.sum(F.col("count") * F.ceil(F.col("count") / BLOCK))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // (8 * BLOCK) + 1)
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    for nearest in (True, False):
        across = scratch.save(_across(members, labels, named, percent, nearest, shards).join(tried, ["a", "b"], "left_anti"))
        if not across.isEmpty():
            more = scratch.save(_verify(across, text_of, words, percent))
            if not more.isEmpty():
                links, labels = links.union(more), merged(labels, more, scratch)
        tried = tried.union(across)
        common.release(spark)
    scratch.drop(text_of)

    first = named.select("key", F.col("rep.doc_id").alias("doc_id"))
    linked = labels.join(first, labels["node"] == first["key"]).select("node", "label", "doc_id")
    least = linked.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    degree = links.select(F.col("a").alias("key")).union(links.select("b")).groupBy("key").agg(F.count("*").alias("n_links"))
    found = first.join(of_label(linked.select("node", "label"), least, "label").withColumnRenamed("node", "key"), "key", "left").join(degree, "key", "left")
    found = scratch.save(found.select("key", F.coalesce("label", "key").alias("component_key"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    scratch.drop(met, named)
    usable = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("key"))
    out = summary.select("doc_id", "row", "n_shingles", usable.alias("key")).join(found, "key", "left")
    return out.select("doc_id", "row", "n_shingles", F.col("key").alias("set_key"), "component_key", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
