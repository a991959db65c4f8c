"""Exact reference resolution within and across cases; ambiguity is reported, never resolved by choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def resolve(requests: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Requests (request_id, keys, ref) against candidates (keys, ref, entity_type, identity_status).

    MISSING for an empty ref, UNRESOLVED without a candidate, AMBIGUOUS for several or for one that is not unique, else EXACT.
    """
    on = [*keys, "ref"]
    found = candidates.groupBy(*on).agg(F.count("*").alias("n_candidates"), F.max((F.col("identity_status") != "UNIQUE").cast("int")).alias("doubtful"), F.min("entity_type").alias("entity_type"))
    out = requests.join(found, on, "left").withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0)))
    state = F.when(F.coalesce("ref", F.lit("")) == "", "MISSING").when(F.col("n_candidates") == 0, "UNRESOLVED").when((F.col("n_candidates") > 1) | (F.col("doubtful") == 1), "AMBIGUOUS").otherwise("EXACT")
    return out.withColumn("status", state).withColumn("entity_type", F.when(F.col("status") == "EXACT", F.col("entity_type"))).drop("doubtful")


def across_cases(references: DataFrame, entities: DataFrame) -> DataFrame:
    """References (reference_id, case_id, ref) against entities (case_id, ref) of all cases: local and foreign counts, and a class.

    Every reference meets one row with the count of its ref in all cases and one with that in its own, however many cases hold it.
    """
    own = entities.groupBy("ref", "case_id").agg(F.count("*").alias("n_local"))
    total = own.groupBy("ref").agg(F.sum("n_local").alias("n"))
    out = references.join(total, "ref", "left").join(own, ["ref", "case_id"], "left")
    local = F.coalesce("n_local", F.lit(0))
    out = out.select("reference_id", "case_id", "ref", local.alias("n_local"), (F.coalesce("n", F.lit(0)) - local).alias("n_foreign"))
    kind = F.when(F.col("n_foreign") == 1, "UNIQUE_EXTERNAL").when(F.col("n_foreign") > 1, "MULTIPLE_EXTERNAL").when(F.col("n_local") > 0, "LOCAL_UNRESOLVED_ONLY").otherwise("UNDEFINED_GLOBAL")
    return out.withColumn("classification", kind)


def case_edges(pairs: DataFrame, witnesses: int = 5) -> DataFrame:
    """(source, target, ref) to one row for each pair of cases: counts, whether the reverse exists, first witnesses."""
    distinct = pairs.groupBy("source", "target", "ref").agg(F.count("*").alias("n"))
    first = distinct.withColumn("place", F.row_number().over(Window.partitionBy("source", "target").orderBy("ref"))).where(F.col("place") <= witnesses)
    first = first.groupBy("source", "target").agg(F.array_sort(F.collect_list("ref")).alias("witnesses"))
    edges = distinct.groupBy("source", "target").agg(F.sum("n").alias("n_references"), F.count("*").alias("n_distinct")).join(first, ["source", "target"])
    back = edges.select(F.col("target").alias("source"), F.col("source").alias("target"), F.lit(True).alias("reciprocal"))
    return edges.join(back, ["source", "target"], "left").withColumn("reciprocal", F.coalesce("reciprocal", F.lit(False)))
