"""Wanted definitions, summary tables, prohibitions of six operations, and the eleven gates of a reference."""

import pytest
from pyspark.sql import functions as F

from skein.operators import decisions, scans


def test_wanted_definitions_and_their_filter(spark):
    rows = spark.createDataFrame([(1, f"r{i}", f"Bus_ID=b{i % 50},x={i}") for i in range(400)] + [(2, "r", "b1 b1 b7"), (2, "s", None)], "case_id int, record string, raw string")
    wanted = spark.createDataFrame([("b1",), ("b7",), ("b999",), (None,), ("b1",)], "name string")
    got = {(r.name, r.case_id): (r.n_records, r.first_record) for r in scans.wanted_definitions(rows, "b[0-9]+", wanted).collect()}
    assert got == {("b1", 1): (8, "r1"), ("b7", 1): (8, "r107"), ("b1", 2): (1, "r"), ("b7", 2): (1, "r")}
    assert scans.wanted_definitions(rows, "b[0-9]+", wanted.limit(0)).count() == 0
    names = spark.range(500).select(F.concat(F.lit("n"), "id").alias("name"))
    held = scans.may_hold(scans.bloom_filter(names, 8192).scalar(), F.col("name"), 8192)
    assert names.where(held).count() == 500 and spark.range(500, 5000).select(F.concat(F.lit("n"), "id").alias("name")).where(held).count() < 100


def test_summaries_list_zeros_and_unknown_values(spark):
    df = spark.createDataFrame([("a", "x", 2), ("a", "y", 3), ("q", "x", 5), (None, "x", 1)], "k string, m string, v int")
    rows = scans.summaries(df, {"all": [], "by_k": ["k"], "both": ["k", "m"]}, {"k": ["a", "b"], "m": ["x", "y"]}, {"n": F.count("*"), "v": F.sum("v")}).collect()
    got = {(r.table, r.k, r.m): (r.n, r.v) for r in rows}
    assert len(got) == len(rows) and got == {("all", None, None): (4, 11), ("by_k", "a", None): (2, 5), ("by_k", "b", None): (0, 0), ("by_k", "q", None): (1, 5), ("by_k", None, None): (1, 1), ("both", "a", "x"): (1, 2), ("both", "a", "y"): (1, 3), ("both", "b", "x"): (0, 0), ("both", "b", "y"): (0, 0), ("both", "q", "x"): (1, 5), ("both", None, "x"): (1, 1)}


BOOLEANS = [x for _, _, on in decisions.PROHIBITIONS for x in on.replace("(", " ").replace(")", " ").split() if x.endswith(("confirmed", "approved", "requested", "conflict", "state", "head", "usable"))]
NAMES = sorted({*BOOLEANS, "s2_usable", "s0_full", "s2_full"})
COUNTS = ["target_count", "unreferenced_count", "source_line_count", "accepted_junction_count", "located_transformer_count"]
GOOD = {n: n.endswith(("confirmed", "approved", "head", "usable")) for n in NAMES} | {"target_count": 2, "unreferenced_count": 1, "source_line_count": 3, "accepted_junction_count": 1, "located_transformer_count": 1}


@pytest.mark.parametrize("change, flags, explicit, action, readiness, forbidden", [
    ({}, "A", None, "AUTO_SYNTHETIC_ELIGIBLE", "SYNTHETIC_ELIGIBLE", set()),
    ({"accepted_junction_count": 2}, "A", None, "ROLE_CONFIRMATION_REQUIRED", "ROLE_CONFIRMATION_REQUIRED", {"ATTACHMENT_REGION_UNDETERMINED"}),
    ({"mv_side_confirmed": None}, "A", None, "ROLE_CONFIRMATION_REQUIRED", "ROLE_CONFIRMATION_REQUIRED", {"UNKNOWN_TRANSFORMER_SIDE"}),
    ({}, "AD", None, "BLOCKED_BY_SOURCE_CONFLICT", "BLOCKED", {"EXISTING_NEGATIVE_SOURCE_EVIDENCE"}),
    ({}, "AD", ["AMBIGUOUS_IDENTITY"], "BLOCKED_BY_SOURCE_CONFLICT", "BLOCKED", {"AMBIGUOUS_IDENTITY"}),
    ({"valid_head": False}, "A", None, "INSUFFICIENT_STRUCTURE", "NOT_ELIGIBLE", {"NO_ACCEPTED_BACKBONE"}),
    ({"s0_full": True}, "", None, "ALREADY_TARGET_COMPLETE", "NOT_ELIGIBLE", set()),
    ({"target_count": 0}, "", None, "ROLE_CONFIRMATION_REQUIRED", "ROLE_CONFIRMATION_REQUIRED", set()),
    ({}, "C", None, "DETERMINISTIC_RULE_REVIEW", "RULE_REVIEW_REQUIRED", {"EXISTING_REFERENCE_REQUIRES_REVIEW"}),
])
def test_operations(spark, change, flags, explicit, action, readiness, forbidden):
    row = GOOD | change
    schema = ", ".join(f"{n} {'int' if n in COUNTS else 'boolean'}" for n in row) + ", flags array<string>, explicit array<string>"
    got, = decisions.evaluate_completion(spark.createDataFrame([(*row.values(), list(flags), explicit)], schema)).collect()
    of = {o.operation: o for o in got.operations}
    assert (got.action, got.readiness) == (action, readiness) and set(of["SYNTHETIC_ATTACHMENT_EDGE"].codes) == forbidden and of["SYNTHETIC_ATTACHMENT_EDGE"].eligible == (not forbidden)
    always = {"SYNTHETIC_JUNCTION": "HIGH_RISK_AUTHORIZATION_REQUIRED", "SYNTHETIC_COMPONENT_BRIDGE": "UNSAFE_COMPONENT_BRIDGE", "SYNTHETIC_TRANSFORMER": "HIGH_RISK_AUTHORIZATION_REQUIRED"}
    assert all(code in of[op].codes for op, code in always.items()) and ("DUPLICATE_GENERATION" in of["SYNTHETIC_TRANSFORMER"].codes) == (row["target_count"] > 0)


def test_every_gate_can_be_the_first(spark):
    names = [k for k, _ in decisions.CROSS_CASE_GATES]
    rows = [("UNIQUE", *[j >= i for j in range(len(names))]) for i in range(len(names) + 1)] + [("OTHER", *[True] * len(names)), ("UNIQUE", *[None] * len(names))]
    df = spark.createDataFrame(rows, "c string, " + ", ".join(f"{n} boolean" for n in names))
    got = [r[0] for r in df.select(decisions.cross_case_reason(F.col("c"), "UNIQUE", {n: F.col(n) for n in names})).collect()]
    assert got == [r for _, r in decisions.CROSS_CASE_GATES] + ["", "OTHER", ""]
