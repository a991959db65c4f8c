"""A corpus pipeline over ``documents``: toxicity, line dedup, near-duplicate join, benchmark decontamination, packing.

All stages but the last return the columns of documents, with whatever names they have.  Null and empty texts, very long ones and
extra columns pass every stage; an empty table gives an empty table.  Rows without doc_id are documents of their own: those of equal
texts count as one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import common
from skein.llm.decontaminate import find_contained
from skein.llm.jaccard import link_documents
from skein.llm.lines import dedup_lines
from skein.llm.packing import pack_documents
from skein.llm.toxicity import drop_toxic

#: Where the ids of rows without doc_id begin, within a stage: after all others, so that a document with an id stays.
NAMELESS = 1 << 62


def _named(docs: DataFrame) -> DataFrame:
    """The id that a stage knows a row by (id), a hash of its text (hash), and the row; rows without doc_id are known by their text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(NAMELESS) + F.pmod(F.xxhash64(text), F.lit(NAMELESS)))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return docs.select(own.alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"), row.alias("row"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic go.  Repeated rows are judged alike."""
    return drop_toxic(docs, common.table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; n_chars follows the text.  Rows of one doc_id do not drop each other's lines; rows
    without doc_id come after all others, and lose lines to them.  A null text becomes an empty one."""
    own = _named(docs)
    found = dedup_lines(own.select(F.col("id").alias("doc_id"), "text", "row"), carry=True)
    changed = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return found.select(*(changed[c].alias(c) if c in changed else F.col(f"carried.row.`{c}`").alias(c) for c in docs.columns))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the row with the smallest doc_id stays (of equal ones the smallest hash of the text), and of
    repeated rows one.  Texts without words link with nothing, so only repeated rows of theirs go."""
    own = _named(docs)
    found = link_documents(own.select(F.col("id").alias("doc_id"), "text")).select(F.col("doc_id").alias("id"), F.col("row").alias("hash"), "component_key")
    scratch = common.Scratch(spark, "stage")
    found = scratch.save(found.groupBy("id", "hash").agg(F.max("component_key").alias("group"), F.count("*").alias("times")))
    least = found.where("group is not null").groupBy("group").agg(F.min(F.struct("id", "hash")).alias("least"), F.count("*").alias("rows")).where("rows > 1")
    lost = found.join(least.drop("rows"), "group").where("struct(id, hash) <> least").select("id", "hash")
    rest = own.drop("text").join(lost, ["id", "hash"], "left_anti")
    again = found.where("times > 1").select("id", "hash")
    if not again.isEmpty():
        rest = rest.join(again, ["id", "hash"], "left_anti").unionByName(rest.join(again, ["id", "hash"], "left_semi").dropDuplicates(["id", "hash"]))
    return rest.select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.  The rows of a doc_id are one document, and go together; of rows without doc_id those
    of equal texts do."""
    own = _named(docs)
    leaks = find_contained(own.select(F.col("id").alias("doc_id"), "text"), common.table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("id")).distinct()
    return own.join(leaks, "id", "left_anti").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences.  Repeated rows are packed each; a null doc_id stays null."""
    pieces = pack_documents(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("jaccard_join", jaccard_join), ("decontamination", decontamination), ("packing", packing)]

#: SQL can express neither the classifier nor the tokenizer; tests/llm compares the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written, and the one before it deleted then."""
    docs = common.table(spark, sf_dir, "documents")
    folder = f"{common.shared(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{name}")
        if before:
            common.delete(spark, f"{folder}/{before}")
        before, docs = name, spark.read.schema(made.schema).parquet(f"{folder}/{name}")
        common.release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
