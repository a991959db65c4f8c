"""Short benchmark items inside long documents, by size-partitioned MinHash containment search; native operators only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm import common

WORDS = 5
THRESHOLD_PERCENT = 80
#: Shingles of a sketch beyond those that the largest item of its size partition may lack.
SPARE = 3
#: White space between words, as a regular expression.
BLANKS = "[\\x20\\x09-\\x0D]+"


def word_array(text: Column) -> Column:
    low = F.translate(text, common.UPPER_AZ, common.LOWER_AZ)
    return F.filter(F.split(low, BLANKS), lambda w: w != "")


def _grams(words: str, k: int) -> str:
    """Hashes of all runs of k words of the column ``words``, none if it has fewer."""
    picked = ", ".join(f"w[i + {j}]" if j else "w[i]" for j in range(k)).replace("w[", f"{words}[")
    return f"IF(size({words}) < {k}, cast(array() as array<bigint>), transform(sequence(0, greatest(size({words}), {k}) - {k}), i -> xxhash64({k}, {picked})))"


def item_shingles(items: DataFrame, k: int = WORDS) -> DataFrame:
    """item_id, n (distinct shingles), grams (their hashes); items without words drop out, rows of one item are pooled."""
    w = items.select("item_id", word_array(F.col("text")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(k))
    chosen = F.expr(" ".join(["CASE", *(f"WHEN size(w) = {j} THEN {_grams('w', j)}" for j in range(1, k)), f"ELSE {_grams('w', k)} END"]))
    w = w.select("item_id", size.alias("size"), F.array_distinct(chosen).alias("grams"))
    w = w.groupBy("item_id").agg(F.collect_set("size").alias("sizes"), F.array_distinct(F.flatten(F.collect_list("grams"))).alias("grams"))
    return w.select("item_id", "sizes", "grams", F.size("grams").cast("long").alias("n"))


def _rank(gram: str) -> str:
    """The place of a shingle in the MinHash order."""
    return f"xxhash64({gram}, 11)"


def item_sketches(shingled: DataFrame, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """The bottom of each item's MinHash order (gram, rank), its length set by the item's size partition: item_id, n, least, gram, rank.

    An item of n shingles that a document holds to ``percent`` lacks at most n * (100 - percent) / 100 of them.  Sizes are
    partitioned by powers of two; a partition's sketches have SPARE more than the shingles that its largest size may lack.  So a document
    that holds the item has at least ``least`` of the sketch, the length less what the item itself may lack.
    """
    top = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n").cast("double"))))
    need = (F.floor(top * (100 - percent) / 100) + SPARE).cast("int")
    ranked = F.expr(f"transform(array_sort(transform(grams, g -> named_struct('r', {_rank('g')}, 'g', g))), s -> s)")
    sketch = shingled.select("item_id", "n", F.slice(ranked, F.lit(1), need).alias("sketch"))
    least = F.greatest(F.lit(1), F.size("sketch") - F.floor(F.col("n") * (100 - percent) / 100).cast("int"))
    return sketch.select("item_id", "n", least.alias("least"), F.explode("sketch").alias("s")).select("item_id", "n", "least", F.col("s.g").alias("gram"), F.col("s.r").alias("rank"))


def _document_grams(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """doc_id, size (at least as large as the number of shingles), gram.  The array is exploded where it is made: a filter that Spark
    infers from exploding a column would be pushed into the lambda, and make the words again for each shingle."""
    w = docs.select("doc_id", word_array(F.col("text")).alias("w"))
    return w.select("doc_id", (F.size("w") * len(sizes)).alias("size"), F.explode(F.concat(*(F.expr(_grams("w", k)) for k in sizes))).alias("gram"))


def document_sketches(docs: DataFrame, sizes: list[int], rates: list[tuple[int, int]]) -> DataFrame:
    """The part of each document's MinHash order that sketches of items can reach: doc_id, gram, size.

    ``rates`` has, for each size partition of the items, the shingles that a document must have at least, and the highest rank in the
    partition's sketches.  A document is sketched down to the highest rank among the partitions that it is large enough for.
    """
    grams = _document_grams(docs, sizes)
    none = F.lit(None).cast("long")
    reach = F.greatest(none, none, *(F.when(F.col("size") >= n, F.lit(rank)) for n, rank in rates))
    return grams.where(F.expr(_rank("gram")) <= reach)


def find_contained(docs: DataFrame, items: DataFrame, words: int = WORDS, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """Documents that hold ``percent`` or more of an item's distinct word shingles: doc_id, item_id, n_shared, n_item, containment.

    Items are partitioned by size, and each has the bottom of its MinHash order for a sketch, as long as its partition needs.  Documents are
    sketched by the same order, as deep as the partitions reach that their size lets them hold.  Sketches meet in a join; a pair is a
    candidate if the containment of the sketch lets the item's containment be ``percent``, so none is lost.  Each candidate is then
    counted exactly, by all shingles of the item.  A-Z is lower-cased.  An item of fewer than ``words`` words is its whole sequence, held
    when it stands somewhere in the document.

    Null and empty texts hold nothing, and items without words are never found.  Rows without doc_id or item_id take no part.  Very long
    texts are read whole.  Items of equal texts are found each.
    Rows of one doc_id or one item_id: equal pairs are reported once, and the shingles of a document's or an item's rows are pooled.
    Other columns are not read, whatever their names.  Empty tables give an empty table.
    """
    scratch = common.Scratch(docs.sparkSession, "contained")
    docs = common.texts(docs).where("doc_id is not null")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    shingled = scratch.save(item_shingles(items.where("item_id is not null").distinct(), words))
    sizes = sorted({words, *(r[0] for r in shingled.select(F.explode("sizes").alias("size")).where(F.col("size") < words).distinct().collect())})
    sketches = scratch.save(item_sketches(shingled, percent))
    by_size = sketches.groupBy(F.ceil(F.log2(F.col("n").cast("double"))).alias("partition")).agg(F.min("n").alias("n"), F.max("rank").alias("rank"))
    # A document of several rows pools them, so any of its rows may be short: only its own part of an item need be there.
    pooled = docs.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0
    rates = [(1 if pooled else -(-r["n"] * percent // 100), r["rank"]) for r in by_size.collect()]
    held = F.col("size") * 100 >= F.col("n") * percent if not pooled else F.lit(True)
    met = document_sketches(docs, sizes, rates).join(sketches.drop("rank"), "gram").where(held)
    pairs = met.select("doc_id", "item_id", "least", "gram").distinct().groupBy("doc_id", "item_id").agg(F.count("*").alias("have"), F.max("least").alias("least"))
    pairs = scratch.save(pairs.where("have >= least").select("doc_id", "item_id"))
    suspects = docs.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")
    own = pairs.join(shingled.select("item_id", "n", F.explode("grams").alias("gram")), "item_id")
    shared = _document_grams(suspects, sizes).select("doc_id", "gram").distinct().join(own, ["doc_id", "gram"])
    counted = shared.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared"), F.max("n").alias("n_item"))
    held = counted.where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    return held.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))
