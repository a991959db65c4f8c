"""Decisions and checks: endpoint safety, strategies, set relations, stage guards, cohorts and actions, endpoint resolution,
identifier features, zero-filled matrices, overlapping groups, row numbers that no single task has to count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions import columns as C
from skein.operators import graphs

# Names that results carry.
STRATEGIES = ["S0", "S1", "S2", "S3_A", "S3_B"]
STATUSES = ["ACCEPTED", "AMBIGUOUS", "UNRESOLVED", "EXCLUDED", "UNSUPPORTED"]
STAGE_STEPS = [("OBSERVED", "ELIGIBLE"), ("ELIGIBLE", "PROPOSED")]
SEVERITY = {"AMBIGUOUS": "ERROR", "UNRESOLVED": "WARNING"}


def _known(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def endpoint_safety(assessment: Column, sides: list[tuple[Column, Column, Column]]) -> Column:
    """COMPATIBLE by assessment alone; CONFLICTING if a side (exact, voltage, voltage) has two positive voltages that do not go together;
    else UNKNOWN: nothing is proven by absent evidence."""
    conflict = F.lit(False)
    for exact, p, q in sides:
        conflict = conflict | _known(exact & (p > 0) & (q > 0) & ~C.voltage_compatible(p, q))
    proven = assessment.isin("COMPATIBLE_SOURCE_EVIDENCE", "DIFFERENT_ABSTRACTION_EVIDENCE")
    return F.when(proven, "COMPATIBLE").when(conflict, "CONFLICTING").otherwise("UNKNOWN")


def candidate_decisions(df: DataFrame, baseline: str, inner_exact: str, safety: str, state: str) -> DataFrame:
    """One row for each candidate and strategy, with the reason, whether it is projected, and whether it conducts."""
    every = df.withColumn("strategy", F.explode(F.array(*map(F.lit, STRATEGIES))))
    s, st = F.col("strategy"), F.coalesce(state, F.lit("UNKNOWN"))
    reason = C.first_reason(
        (F.col(baseline), "BASELINE_PRESERVED"), (s == "S0", "BASELINE_EXCLUDED"), (~F.col(inner_exact), "INNER_REFERENCE_NOT_EXACT"),
        ((s != "S1") & (F.col(safety) == "CONFLICTING"), "ENDPOINT_VOLTAGE_CONFLICT"), ((st == "UNKNOWN") & (s != "S3_A"), "UNKNOWN_STATE_EXCLUDED"),
        (st == "UNKNOWN", "UNKNOWN_PROJECTED_NOT_CONDUCTING"), (st == "OPEN", "OPEN_PROJECTED_NOT_CONDUCTING"), default="STRUCTURAL_SERIES_CANDIDATE",
    )
    out = every.withColumn("reason", reason)
    r = F.col("reason")
    out = out.withColumn("projected", r.contains("PROJECTED") | r.isin("BASELINE_PRESERVED", "STRUCTURAL_SERIES_CANDIDATE"))
    return out.withColumn("conducting", F.col("projected") & (st == "CLOSED"))


def voltage_relation(left: Column, right: Column) -> Column:
    """Of two sets: only sole, positive values are compared."""
    p, q = F.try_element_at(left, F.lit(1)), F.try_element_at(right, F.lit(1))
    sole = (F.size(left) == 1) & (F.size(right) == 1) & (p > 0) & (q > 0)
    return F.when(_known(sole), F.when(C.voltage_compatible(p, q), "COMPATIBLE").otherwise("CONFLICT")).otherwise("UNKNOWN")


def station_relation(left: Column, right: Column) -> Column:
    sole = (F.size(left) == 1) & (F.size(right) == 1)
    return F.when(_known(sole), F.when(left == right, "SAME_STATION").otherwise("CROSS_STATION")).otherwise("UNKNOWN")


def stage_errors(before: Column, after: Column, reason: Column, evidence: Column) -> Column:
    """Sorted codes of what forbids a step between stages; none if it is allowed."""
    step = F.lit(False)
    for p, q in STAGE_STEPS:
        step = step | _known((before == p) & (after == q))
    lacks = (F.size(F.coalesce(evidence, F.array())) == 0) | _known(F.exists(evidence, lambda e: F.coalesce(e, F.lit("")) == ""))
    return C.all_reasons((~step, "STEP_NOT_ALLOWED"), (F.trim(F.coalesce(reason, F.lit(""))) == "", "REASON_BLANK"), (lacks, "EVIDENCE_MISSING"))


def cohort(recognised: Column, rows: Column, unreferenced: Column) -> Column:
    zero = rows == 0
    return C.first_reason((zero & recognised, "ZERO_TRANSFORMER_ROWS"), (zero, "SOURCE_FILE_UNDETERMINED"), (unreferenced > 0, "HAS_UNREFERENCED_TRANSFORMER"), default="ALL_TARGETS_HAVE_REFERENCE")


def cohort_flags(name: Column, full: Column, constrained: Column, unreferenced: Column) -> Column:
    """A unreferenced targets, B no rows, C all referenced but not full, D constraints."""
    return C.all_reasons((unreferenced > 0, "A"), (name == "ZERO_TRANSFORMER_ROWS", "B"), ((name == "ALL_TARGETS_HAVE_REFERENCE") & ~full, "C"), (constrained, "D"))


def readiness(flags: Column, no_role: Column, review: Column) -> Column:
    """What is open, in its order; SOURCE_EVIDENCE_SUFFICIENT if nothing is."""
    has = lambda f: F.array_contains(flags, f)
    open_ = F.array_compact(F.array(F.when(no_role, F.lit("ROLE_UNDETERMINED")), F.when(has("D"), F.lit("BLOCKED_BY_CONFLICT")), F.when(has("A"), F.lit("NEEDS_SYNTHETIC_COMPLETION")), F.when(review, F.lit("NEEDS_RULE_REVIEW"))))
    return F.when(F.size(open_) == 0, F.array(F.lit("SOURCE_EVIDENCE_SUFFICIENT"))).otherwise(open_)


def completion_action(flags: Column, targets: Column, s0_full: Column, s2_full: Column, s0_usable: Column, s2_usable: Column, structure: Column, attachable: Column) -> Column:
    """What comes next for a case, of facts about its two baselines, its structure (head, lines, junction) and its attachment."""
    has = lambda f: F.array_contains(flags, f)
    gates = [
        (has("D"), "BLOCKED_BY_SOURCE_CONFLICT"), (has("B") | (targets == 0), "ROLE_CONFIRMATION_REQUIRED"), (s0_full, "ALREADY_TARGET_COMPLETE"),
        (has("C") | s2_full | (s2_usable & ~s0_usable), "DETERMINISTIC_RULE_REVIEW"), (~structure | ~(s0_usable | s2_usable), "INSUFFICIENT_STRUCTURE"),
        (has("A") & attachable, "AUTO_SYNTHETIC_ELIGIBLE"), (has("A"), "ROLE_CONFIRMATION_REQUIRED"),
    ]
    return C.first_reason(*gates, default="DETERMINISTIC_RULE_REVIEW")


def resolve_endpoints(endpoints: DataFrame, accounts: DataFrame) -> DataFrame:
    """Endpoints (case_id, raw and more) with status and, for the exact ones, the account.  ``accounts``: case_id, raw, account, sole.

    Accounts are counted by (case_id, raw) and by raw alone, so a raw text that many cases hold is joined once, not once for each.
    """
    mine = accounts.groupBy("case_id", "raw").agg(F.count("*").alias("_n"), F.min("sole").alias("_sole"), F.min("account").alias("_account"))
    # Local rows are decided first: what is left has no account in its own case, so any holder is a foreign one.
    any_ = accounts.select("raw").distinct().withColumn("_any", F.lit(True))
    out = endpoints.join(mine, ["case_id", "raw"], "left").join(any_, "raw", "left")
    blank = F.coalesce(F.col("raw"), F.lit("")) == ""
    exact = (F.col("_n") == 1) & F.col("_sole")
    status = F.when(blank, "NO_DECLARATION").when(_known(exact), "EXACT_CASE_LOCAL").when(F.col("_n").isNotNull(), "CASE_LOCAL_AMBIGUOUS").when(F.col("_any"), "EXTERNAL_DEFINED").otherwise("UNDEFINED_REFERENCE")
    return out.withColumn("status", status).withColumn("account", F.when(F.col("status") == "EXACT_CASE_LOCAL", F.col("_account"))).drop("_n", "_sole", "_account", "_any")


def identifier_features(a: Column, b: Column) -> dict[str, Column]:
    """Features of a pair of identifiers, for reports only; ``suffix_equal`` is a map from the width, as text."""
    shorter = F.least(F.length(a), F.length(b))
    places = F.sequence(F.lit(1), F.greatest(shorter, F.lit(1)))
    prefix = F.when(shorter > 0, F.size(F.filter(places, lambda i: F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i)))).otherwise(0).cast("long")
    digits = a.rlike("^[0-9]+$") & b.rlike("^[0-9]+$")
    bare = lambda t: F.regexp_replace(t, "^0+(?=.)", "")
    ends = [x for n in (1, 2, 3, 6) for x in (F.lit(str(n)), (shorter >= n) & (F.right(a, F.lit(n)) == F.right(b, F.lit(n))))]
    # The names that reports carry.
    return {
        "exact_same": (a == b) & (a != ""),
        "numeric_looking_but_different": digits & (a != b),
        "common_prefix_length": prefix,
        "differing_suffix_width": F.greatest(F.length(a), F.length(b)).cast("long") - prefix,
        "same_length": F.length(a) == F.length(b),
        "suffix_equal": F.create_map(*ends),
        "scientific_notation": C.suspicious_identifier(a) | C.suspicious_identifier(b),
        "leading_zero_only": digits & (a != b) & (bare(a) == bare(b)),
    }


def dominance(df: DataFrame, group: str, value: str) -> DataFrame:
    """For each group: n, the commonest values (all ties), purity to 6 places, the minority, and the purity's bucket.

    Values are counted first: a group is a few rows by then, whatever its size was.
    """
    count = df.groupBy(group, value).agg(F.count("*").alias("n"))
    one = count.groupBy(group).agg(F.sum("n").alias("n"), F.max("n").alias("_most"), F.collect_list(F.struct("n", value)).alias("_all"))
    ties = F.transform(F.filter("_all", lambda v: v["n"] == F.col("_most")), lambda v: v[value])
    out = one.select(group, "n", F.array_join(F.array_sort(ties), ",").alias("dominant"), F.bround(F.col("_most") / F.col("n"), 6).alias("purity"), (F.col("n") - F.col("_most")).alias("n_minority"), (F.col("_most") * 10 >= F.col("n") * 9).alias("_pure"))
    return out.withColumn("bucket", F.when(F.col("n_minority") == 0, "ONE_MOTIF").when(F.col("_pure"), "PURITY_GE_0_9").otherwise("MIXED")).drop("_pure")


def matrix(df: DataFrame, rule: str, rules: list[str], status: str, statuses: list[str]) -> DataFrame:
    """Counts of all rules with all statuses, 0 where none is; the dimensions are fixed lists."""
    cell = F.array(*(F.struct(F.lit(r).alias(rule), F.lit(s).alias(status)) for r in rules for s in statuses))
    every = df.sparkSession.range(1).select(F.inline(cell))
    return every.join(df.groupBy(rule, status).agg(F.count("*").alias("n")), [rule, status], "left").select(rule, status, F.coalesce("n", F.lit(0)).alias("n"))


def group_histogram(df: DataFrame, groups: str, value: str) -> DataFrame:
    """population, value, n for groups that overlap: a row counts in ALL and in each group of its array."""
    names = F.concat(F.array(F.lit("ALL")), F.coalesce(groups, F.array()))
    return df.select(F.explode(names).alias("population"), value).groupBy("population", value).agg(F.count("*").alias("n"))


def cohort_overlap(records: DataFrame, reason: str, owner: list[str], locator: str) -> DataFrame:
    """For each reason: distinct records (reason, owner, locator), owners, and owners that other reasons hold too."""
    own = records.groupBy(reason, *owner).agg(F.count_distinct(locator).alias("_n"))
    by = own.groupBy(*owner).agg(F.count("*").alias("_reasons"))
    return own.join(by, owner).groupBy(reason).agg(F.sum("_n").alias("n_records"), F.count("*").alias("n_owners"), F.count_if(F.col("_reasons") > 1).alias("n_overlapping"))


def numbered(df: DataFrame, member: list[str], order: list[str]) -> DataFrame:
    """Rows with ``row_index`` from 0 within their member.  Rows are dealt by range of (member, order), numbered within their part, and
    moved by what the parts before hold: one member may hold most rows."""
    parts = graphs._cut(df.repartitionByRange(*member, *order).withColumn("_part", F.spark_partition_id()))
    size = parts.groupBy(*member, "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*member).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    at = size.select(*member, "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy(*member, "_part").orderBy(*order))
    return parts.withColumn("_local", local).join(at, [*member, "_part"]).withColumn("row_index", F.col("_before") + F.col("_local") - 1).drop("_part", "_before", "_local")


def reference_issues(resolutions: DataFrame, raw: str, n: str) -> DataFrame:
    """Issue rows of references that are not exact, with severity; blank ones are absent, no issue."""
    value = F.nullif(raw, F.lit(""))
    code = F.when(F.col(n) > 1, "AMBIGUOUS").when(F.coalesce(n, F.lit(0)) == 0, "UNRESOLVED")
    severity = F.create_map(*(F.lit(x) for pair in SEVERITY.items() for x in pair))
    out = resolutions.withColumn(raw, value).withColumn("code", code).where(F.col(raw).isNotNull() & F.col("code").isNotNull())
    return out.withColumn("severity", severity[F.col("code")])


def topology_violations(nodes: DataFrame, edges: DataFrame, live: DataFrame, heads: DataFrame, claimed: DataFrame, usable: DataFrame) -> DataFrame:
    """violation, case_id, id of a published graph: nodes and heads (case_id, node), edges and live edges (case_id, edge_id, a, b), the nodes
    claimed to be reachable, and the cases claimed to be usable.  Reachability is found anew; each check is one anti-join."""
    on = ["case_id", "node"]
    kind = lambda df, name, id_: df.select(F.lit(name).alias("violation"), "case_id", F.col(id_).alias("id"))
    ids = nodes.select("case_id", F.col("node").alias("id")).unionByName(edges.select("case_id", F.col("edge_id").alias("id")))
    end = lambda c: nodes.select("case_id", F.col("node").alias(c)).distinct().withColumn(f"_{c}", F.lit(True))
    loose = edges.join(end("a"), ["case_id", "a"], "left").join(end("b"), ["case_id", "b"], "left").where("_a is null or _b is null")
    reached = graphs._cut(graphs.reach(heads, live).select(*on))
    good = live.select("case_id", F.col("a").alias("node")).distinct().join(reached, on, "left_semi").select("case_id").distinct()
    wrong = usable.withColumn("_c", F.lit(1)).join(good.withColumn("_g", F.lit(1)), "case_id", "full").where("_c is null or _g is null").withColumn("id", F.lit(""))
    found = [
        kind(ids.groupBy("case_id", "id").agg(F.count("*").alias("n")).where("n > 1"), "DUPLICATE_ID", "id"), kind(heads.join(nodes, on, "left_anti"), "MISSING_HEAD", "node"), kind(loose, "DANGLING_BRANCH", "edge_id"),
        kind(reached.join(claimed, on, "left_anti"), "REACHABLE_NOT_CLAIMED", "node"), kind(claimed.join(reached, on, "left_anti"), "CLAIMED_NOT_REACHABLE", "node"), kind(wrong, "USABLE_DISAGREES", "id"),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


# Operations that a completion may ask for, and what forbids each; the names are those of the columns of facts.
ANY_OPERATION = "*"
PROHIBITIONS = [
    (ANY_OPERATION, "OWNERSHIP_UNRESOLVED", "not ownership_confirmed or ownership_conflict"),
    (ANY_OPERATION, "CROSS_CASE_CONNECTION", "cross_case_requested"),
    (ANY_OPERATION, "KNOWN_OPEN_BYPASS", "open_bypass_requested"),
    (ANY_OPERATION, "STATE_UNDETERMINED", "unknown_switch_state"),
    (ANY_OPERATION, "VOLTAGE_UNDETERMINED", "not voltage_confirmed"),
    (ANY_OPERATION, "EXISTING_NEGATIVE_SOURCE_EVIDENCE", "array_contains(flags, 'D') and size(explicit) = 0"),
    ("SYNTHETIC_ATTACHMENT_EDGE", "NO_UNREFERENCED_TARGET", "unreferenced_count = 0"),
    ("SYNTHETIC_ATTACHMENT_EDGE", "UNKNOWN_TRANSFORMER_SIDE", "not mv_side_confirmed"),
    ("SYNTHETIC_ATTACHMENT_EDGE", "NO_ACCEPTED_BACKBONE", "not valid_head or not s0_usable"),
    ("SYNTHETIC_ATTACHMENT_EDGE", "ATTACHMENT_REGION_UNDETERMINED", "accepted_junction_count <> 1"),
    ("SYNTHETIC_ATTACHMENT_EDGE", "POLICY_APPROVAL_REQUIRED", "not placement_policy_approved"),
    ("SYNTHETIC_ATTACHMENT_EDGE", "EXISTING_REFERENCE_REQUIRES_REVIEW", "array_contains(flags, 'C')"),
    ("SYNTHETIC_LV_BUS", "NO_LOCATED_TRANSFORMER", "located_transformer_count = 0"),
    ("SYNTHETIC_LV_BUS", "UNKNOWN_TRANSFORMER_SIDE", "not lv_side_confirmed"),
    ("SYNTHETIC_LV_BUS", "POLICY_APPROVAL_REQUIRED", "not lv_policy_approved"),
    ("SYNTHETIC_TRANSFORMER", "DUPLICATE_GENERATION", "target_count > 0"),
    ("SYNTHETIC_TRANSFORMER", "ROLE_UNDETERMINED", "not distribution_role_confirmed"),
    ("SYNTHETIC_TRANSFORMER", "DEMAND_EVIDENCE_MISSING", "not demand_confirmed"),
    ("SYNTHETIC_TRANSFORMER", "DEVICE_COUNT_POLICY_REQUIRED", "not device_count_policy_approved"),
    ("SYNTHETIC_TRANSFORMER", "UNKNOWN_TRANSFORMER_SIDE", "not lv_side_confirmed"),
    ("SYNTHETIC_TRANSFORMER", "POLICY_APPROVAL_REQUIRED", "not capacity_source_policy_approved"),
    ("SYNTHETIC_TRANSFORMER", "HIGH_RISK_AUTHORIZATION_REQUIRED", "true"),
    ("SYNTHETIC_COMPONENT_BRIDGE", "UNSAFE_COMPONENT_BRIDGE", "true"),
    ("SYNTHETIC_JUNCTION", "HIGH_RISK_AUTHORIZATION_REQUIRED", "true"),
    ("SYNTHETIC_BACKBONE_EDGE", "HIGH_RISK_AUTHORIZATION_REQUIRED", "true"),
]
OPERATIONS = ["SYNTHETIC_ATTACHMENT_EDGE", "SYNTHETIC_JUNCTION", "SYNTHETIC_LV_BUS", "SYNTHETIC_TRANSFORMER", "SYNTHETIC_BACKBONE_EDGE", "SYNTHETIC_COMPONENT_BRIDGE"]


def operation_prohibitions(facts: DataFrame) -> DataFrame:
    """Facts with ``operations``: for each operation its name, whether it is eligible, and the sorted codes that forbid it.

    ``explicit`` codes forbid every operation.  A fact that is null is not known: whatever it would confirm stays unconfirmed, and a count counts as none.
    """
    flags, numbers = ([f.name for f in facts.schema if f.dataType.typeName() in kinds] for kinds in (("boolean",), ("integer", "long")))
    known = facts.na.fill(False, flags).na.fill(0, numbers)
    explicit = F.coalesce("explicit", F.array().cast("array<string>"))
    known = known.withColumn("explicit", explicit).withColumn("flags", F.coalesce("flags", F.array().cast("array<string>")))

    def of(name: str) -> Column:
        codes = F.array_union(C.all_reasons(*((F.expr(on), code) for op, code, on in PROHIBITIONS if op in (ANY_OPERATION, name))), F.col("explicit"))
        return F.struct(F.lit(name).alias("operation"), (F.size(codes) == 0).alias("eligible"), F.array_sort(codes).alias("codes"))

    return known.withColumn("operations", F.array(*map(of, OPERATIONS)))


# The readiness that an action leaves a case in.
ACTION_READINESS = {"BLOCKED_BY_SOURCE_CONFLICT": "BLOCKED", "ROLE_CONFIRMATION_REQUIRED": "ROLE_CONFIRMATION_REQUIRED", "ALREADY_TARGET_COMPLETE": "NOT_ELIGIBLE", "DETERMINISTIC_RULE_REVIEW": "RULE_REVIEW_REQUIRED", "INSUFFICIENT_STRUCTURE": "NOT_ELIGIBLE", "AUTO_SYNTHETIC_ELIGIBLE": "SYNTHETIC_ELIGIBLE"}


def evaluate_completion(facts: DataFrame) -> DataFrame:
    """``operation_prohibitions`` with the action that comes next (explicit codes and conflicts block first), the readiness that it leaves, and all codes."""
    f = operation_prohibitions(facts)
    c = F.col
    attach = F.exists("operations", lambda o: (o["operation"] == "SYNTHETIC_ATTACHMENT_EDGE") & o["eligible"])
    structure = c("valid_head") & (c("source_line_count") > 0) & (c("accepted_junction_count") > 0)
    blocked = (F.size("explicit") > 0) | c("ownership_conflict") | c("cross_case_requested") | c("open_bypass_requested")
    action = F.when(blocked, "BLOCKED_BY_SOURCE_CONFLICT").otherwise(completion_action(c("flags"), c("target_count"), c("s0_full"), c("s2_full"), c("s0_usable"), c("s2_usable"), structure, attach))
    names = F.create_map(*(F.lit(x) for pair in ACTION_READINESS.items() for x in pair))
    return f.withColumn("action", action).withColumn("readiness", F.element_at(names, F.col("action"))).withColumn("codes", F.array_sort(F.array_distinct(F.flatten(F.transform("operations", lambda o: o["codes"])))))


# Why a reference is not taken from another case, in the order in which it is asked; a reason may be given twice.
CROSS_CASE_GATES = [("many", "MULTIPLE_EXTERNAL_MATCH"), ("no_candidate", "NO_CANONICAL_CANDIDATE"), ("not_unique", "AMBIGUOUS_IDENTITY"), ("other_type", "TYPE_INCOMPATIBLE"), ("no_reference", "NO_CANONICAL_CANDIDATE"), ("other_voltage", "VOLTAGE_NOT_COMPATIBLE"), ("local", "ALSO_RESOLVES_CASE_LOCALLY"), ("blocked", "REFERRING_CASE_HARD_BLOCKER"), ("donor_blocked", "DONOR_CASE_HARD_BLOCKER"), ("other_tier", "TIER_NOT_MATERIALIZED")]


def cross_case_reason(classification: Column, wanted: str, holds: dict[str, Column]) -> Column:
    """The first of eleven gates that keeps a reference out (the first is its classification, unless that is the wanted one); empty if none does."""
    return F.when(classification != wanted, classification).otherwise(C.first_reason(*((F.coalesce(holds[k], F.lit(False)), r) for k, r in CROSS_CASE_GATES), default=""))
