"""Scans of raw rows for a wanted set of names, and tables of counts by several groupings from one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter for each name, hashes of a name, and bits of the largest filter: beyond it names pass more often, and the join decides.
BITS_EACH, HASHES, MOST_BITS = 16, 4, 1 << 23


def _places(name: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), name), F.lit(bits)) for i in range(HASHES)]


def bloom_filter(names: DataFrame, bits: int) -> DataFrame:
    """One row with the words of a Bloom filter of the column ``name``: the bits are put together by an aggregate, so no task sees all names."""
    at = names.select(F.explode(F.array(*_places(F.col("name"), bits))).alias("at")).distinct()
    words = at.groupBy((F.floor(F.col("at") / 64)).cast("int").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("bits"))
    every = names.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"))
    return every.join(words, "word", "left").agg(F.transform(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))), lambda x: x["bits"]).alias("filter"))


def may_hold(filter_: Column, name: Column, bits: int) -> Column:
    """Whether a Bloom filter may hold a name; names that it was made of always pass."""
    out = F.lit(True)
    for at in _places(name, bits):
        word = F.get(filter_, F.shiftright(at, 6).cast("int"))
        out = out & (F.call_function("shiftrightunsigned", word, (at % 64).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return out


def bits_for(n: int) -> int:
    """Bits of a filter of ``n`` names: a power of two that follows their number, up to a bound."""
    return min(MOST_BITS, max(64, 1 << (n * BITS_EACH - 1).bit_length()))


def possible(rows: DataFrame, keys: list[list[str]], wanted: DataFrame, n: int) -> DataFrame:
    """Rows of which a key (texts by column names) may be among the ``n`` rows of ``wanted``: all where one is, and few others, which a join has to tell."""
    if not n:
        return rows.where(F.lit(False))
    bits = bits_for(n)
    key = lambda cs: F.xxhash64(*(F.col(c).cast("string") for c in cs))
    filter_, held = bloom_filter(wanted.select(key(wanted.columns).alias("name")), bits).scalar(), F.lit(False)
    # A generated column is worked out once a row; a plain one would be, with the texts it is made of, at each place of the filter.
    hashed = rows.select("*", F.explode(F.array(F.struct(*(key(cs).alias(f"k{i}") for i, cs in enumerate(keys))))).alias("_hashes"))
    for i in range(len(keys)):
        held = held | may_hold(filter_, F.col(f"_hashes.k{i}"), bits)
    return hashed.where(held).drop("_hashes")


def wanted_definitions(rows: DataFrame, pattern: str, wanted: DataFrame) -> DataFrame:
    """Names that rows (case_id, record, raw text) define, restricted to a wanted set: name, case_id, n_records, first_record.

    Every match of ``pattern`` in the raw text is tried against a Bloom filter of ``wanted`` (name) where it is found, so that what is shuffled to the exact semi-join is about the
    wanted names alone, however many others there are.  The filter's size follows the set's, counted first, up to a bound.
    """
    names = wanted.select("name").where("name is not null").distinct()
    bits = bits_for(names.count())
    found = rows.select("case_id", "record", F.explode(F.array_distinct(F.regexp_extract_all("raw", F.lit(pattern), F.lit(0)))).alias("name"))
    held = found.where(may_hold(bloom_filter(names, bits).scalar(), F.col("name"), bits))
    return held.join(names, "name", "left_semi").groupBy("name", "case_id").agg(F.count_distinct("record").alias("n_records"), F.min("record").alias("first_record"))


def summaries(df: DataFrame, sets: dict[str, list[str]], values: dict[str, list[str]], counts: dict[str, Column]) -> DataFrame:
    """Tables of counts by several groupings from one scan: table, the dimensions (null where a table has not got it), counts.

    ``sets``: the dimensions of each table; ``values``: the values of a dimension that a table always lists, with zeros where no row has them; values beyond them are listed where rows
    have them.  ``counts``: counting or summing columns by name; null counts as zero.
    """
    dims = sorted({d for ds in sets.values() for d in ds})
    keys = [[F.col(d) for d in ds] for ds in sets.values()]
    grouped = df.groupingSets(keys, *dims).agg(*(c.alias(n) for n, c in counts.items()), *(F.grouping(d).alias(f"_{d}") for d in dims))
    # A table is told by the dimensions that it groups by.
    is_ = lambda ds: [(F.col(f"_{d}") == int(d not in ds)) for d in dims]
    table = F.lit(None).cast("string")
    for name, ds in sets.items():
        on = F.lit(True)
        for c in is_(ds):
            on = on & c
        table = F.when(on, name).otherwise(table)
    got = grouped.withColumn("table", table).select("table", *dims, *counts)
    shells = None
    for name, ds in sets.items():
        if not ds or not all(d in values for d in ds):
            continue
        # A few fixed values for each dimension, so the shell of a table is small whatever the rows are.
        shell = df.sparkSession.range(1).select(F.lit(name).alias("table"))
        for d in dims:
            shell = shell.select("*", F.explode(F.array(*map(F.lit, values[d]))).alias(d)) if d in ds else shell.withColumn(d, F.lit(None).cast(df.schema[d].dataType))
        shells = shell if shells is None else shells.unionByName(shell)
    if shells is None:
        return got
    zeros = shells.select("*", *(F.lit(0).cast(got.schema[n].dataType).alias(n) for n in counts))
    return got.unionByName(zeros).groupBy("table", *dims).agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts))
