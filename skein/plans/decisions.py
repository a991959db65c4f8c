"""Queries of decisions, checks and summaries over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import columns as C
from skein.operators import decisions, graphs, rules
from skein.plans import catalogue as K
from skein.plans.catalogue import _BOTH, _EDGES, _HEADS, _LIVE, _REACHED, _t, query
from skein.plans.rulebook import _ENDS, _GATE, _MOTIF, _TAGS, KEY, _ends, _tagged, q20_device_decision

# ---------------------------------------------------------------- safety and strategies

# Voltages that a number stands for; 3 is not a voltage, and 5 and more are unknown.
_KV = "CASE {0} WHEN 0 THEN 10.0 WHEN 1 THEN 10.5 WHEN 2 THEN 20.0 WHEN 3 THEN 0.0 WHEN 4 THEN 0.4 END::DECIMAL(10,2)"


def _kv(number: Column) -> Column:
    out = F.when(number == 0, "10.0")
    for k, v in ((1, "10.5"), (2, "20.0"), (3, "0.0"), (4, "0.4")):
        out = out.when(number == k, v)
    return out.cast("decimal(10,2)")


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    """Line items as candidates: safety of the two sides, state, baseline, inner references."""
    e = _ends(spark, d)
    exact = F.forall("states", lambda s: s == "EXACT")
    label, agree = rules.motif(*map(F.col, "abxy")), rules.matches(*map(F.col, "abxy"))
    e = e.withColumn("assessment", rules.assessment(rules.evidence_bucket(label, agree, exact, F.col("layer"), F.col("states"))))
    volt = lambda c: _kv(F.when(F.col(c) != "", F.col(c)).cast("int"))
    safety = decisions.endpoint_safety(F.col("assessment"), [(exact, volt("a"), volt("x")), (exact, volt("b"), volt("y"))])
    state = F.when(F.col("l_orderkey") % 5 == 0, "UNKNOWN").when(F.col("l_suppkey") % 3 == 0, "OPEN").otherwise("CLOSED")
    return e.select(*KEY, safety.alias("safety"), state.alias("state"), (F.col("l_partkey") % 13 == 0).alias("baseline"), exact.alias("inner_exact"))


_CANDIDATES = f"""{_ENDS}, {_MOTIF}, volts AS (SELECT *, {_KV.format("nullif(a, '')::INT")} AS va, {_KV.format("nullif(b, '')::INT")} AS vb, {_KV.format("nullif(x, '')::INT")} AS vx, {_KV.format("nullif(y, '')::INT")} AS vy FROM motifs),
sides AS (SELECT *, coalesce(va > 0 AND vx > 0 AND va <> vx AND NOT (va IN (10, 10.5) AND vx IN (10, 10.5)), false) OR coalesce(vb > 0 AND vy > 0 AND vb <> vy AND NOT (vb IN (10, 10.5) AND vy IN (10, 10.5)), false) AS apart FROM volts),
candidates AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN layer OR (state = 'EXACT' AND motif IN ('DIRECT', 'REVERSE')) THEN 'COMPATIBLE' WHEN state = 'EXACT' AND apart THEN 'CONFLICTING' ELSE 'UNKNOWN' END AS safety,
  CASE WHEN l_orderkey % 5 = 0 THEN 'UNKNOWN' WHEN l_suppkey % 3 = 0 THEN 'OPEN' ELSE 'CLOSED' END AS state, l_partkey % 13 = 0 AS baseline, state = 'EXACT' AS inner_exact FROM sides)"""


@query(f"WITH {_CANDIDATES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, safety FROM candidates")
def q59_endpoint_safety(spark, d):
    return _candidates(spark, d).select(*KEY, "safety")


@query(f"""WITH {_CANDIDATES}, s AS (SELECT unnest(['S0', 'S1', 'S2', 'S3_A', 'S3_B']) AS strategy), r AS (SELECT strategy, state, CASE WHEN baseline THEN 'BASELINE_PRESERVED' WHEN strategy = 'S0' THEN 'BASELINE_EXCLUDED' WHEN NOT inner_exact THEN 'INNER_REFERENCE_NOT_EXACT' WHEN strategy <> 'S1' AND safety = 'CONFLICTING' THEN 'ENDPOINT_VOLTAGE_CONFLICT'
  WHEN state = 'UNKNOWN' AND strategy <> 'S3_A' THEN 'UNKNOWN_STATE_EXCLUDED' WHEN state = 'UNKNOWN' THEN 'UNKNOWN_PROJECTED_NOT_CONDUCTING' WHEN state = 'OPEN' THEN 'OPEN_PROJECTED_NOT_CONDUCTING' ELSE 'STRUCTURAL_SERIES_CANDIDATE' END AS reason FROM candidates, s)
SELECT strategy, reason, state, count(*) AS n, count(*) FILTER (WHERE reason IN ('BASELINE_PRESERVED', 'STRUCTURAL_SERIES_CANDIDATE', 'UNKNOWN_PROJECTED_NOT_CONDUCTING', 'OPEN_PROJECTED_NOT_CONDUCTING')) AS n_projected, count(*) FILTER (WHERE reason IN ('BASELINE_PRESERVED', 'STRUCTURAL_SERIES_CANDIDATE') AND state = 'CLOSED') AS n_conducting FROM r GROUP BY ALL""")
def q60_candidate_decision(spark, d):
    made = decisions.candidate_decisions(_candidates(spark, d), "baseline", "inner_exact", "safety", "state")
    return made.groupBy("strategy", "reason", "state").agg(F.count("*").alias("n"), F.count_if("projected").alias("n_projected"), F.count_if("conducting").alias("n_conducting"))


@query(f"""WITH g AS (SELECT l_orderkey, list(DISTINCT {_KV.format('l_suppkey % 6')}) FILTER (WHERE l_returnflag = 'A' AND l_suppkey % 6 < 5) AS lv, list(DISTINCT {_KV.format('l_suppkey % 6')}) FILTER (WHERE l_returnflag <> 'A' AND l_suppkey % 6 < 5) AS rv,
  list(DISTINCT l_partkey % 3) FILTER (WHERE l_returnflag = 'A') AS ls, list(DISTINCT l_partkey % 3) FILTER (WHERE l_returnflag <> 'A') AS rs FROM lineitem GROUP BY ALL)
SELECT l_orderkey, CASE WHEN len(lv) = 1 AND len(rv) = 1 AND lv[1] > 0 AND rv[1] > 0 THEN CASE WHEN lv[1] = rv[1] OR (lv[1] IN (10, 10.5) AND rv[1] IN (10, 10.5)) THEN 'COMPATIBLE' ELSE 'CONFLICT' END ELSE 'UNKNOWN' END AS voltage,
  CASE WHEN len(ls) = 1 AND len(rs) = 1 THEN CASE WHEN ls[1] = rs[1] THEN 'SAME_STATION' ELSE 'CROSS_STATION' END ELSE 'UNKNOWN' END AS station FROM g""")
def q61_set_relations(spark, d):
    left = F.col("l_returnflag") == "A"
    volt, station = _kv(F.col("l_suppkey") % 6), F.col("l_partkey") % 3
    sets = [F.collect_set(F.when(side, v)).alias(n) for side, v, n in ((left, volt, "lv"), (~left, volt, "rv"), (left, station, "ls"), (~left, station, "rs"))]
    g = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(*sets)
    return g.select("l_orderkey", decisions.voltage_relation(F.col("lv"), F.col("rv")).alias("voltage"), decisions.station_relation(F.col("ls"), F.col("rs")).alias("station"))


@query("""WITH s AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'OBSERVED' WHEN 'O' THEN 'ELIGIBLE' ELSE 'PROPOSED' END AS before, CASE o_orderkey % 3 WHEN 0 THEN 'OBSERVED' WHEN 1 THEN 'ELIGIBLE' ELSE 'PROPOSED' END AS after, o_custkey % 7 = 0 AS blank, o_custkey % 5 = 0 AS bare FROM orders)
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN bare THEN 'EVIDENCE_MISSING' END, CASE WHEN blank THEN 'REASON_BLANK' END, CASE WHEN (before, after) NOT IN (('OBSERVED', 'ELIGIBLE'), ('ELIGIBLE', 'PROPOSED')) THEN 'STEP_NOT_ALLOWED' END], lambda x: x IS NOT NULL), ',') AS errors FROM s
WHERE bare OR blank OR (before, after) NOT IN (('OBSERVED', 'ELIGIBLE'), ('ELIGIBLE', 'PROPOSED'))""")
def q62_stage_guard(spark, d):
    status, turn = F.col("o_orderstatus"), F.col("o_orderkey") % 3
    before = F.when(status == "F", "OBSERVED").when(status == "O", "ELIGIBLE").otherwise("PROPOSED")
    after = F.when(turn == 0, "OBSERVED").when(turn == 1, "ELIGIBLE").otherwise("PROPOSED")
    reason = F.when(F.col("o_custkey") % 7 == 0, "  ").otherwise(F.col("o_orderpriority"))
    evidence = F.when(F.col("o_custkey") % 10 == 0, F.array().cast("array<string>")).when(F.col("o_custkey") % 5 == 0, F.array(status, F.lit(""))).otherwise(F.array(status))
    errors = decisions.stage_errors(before, after, reason, evidence)
    return _t(spark, d, "orders").select("o_orderkey", errors.alias("errors")).where(F.size("errors") > 0).select("o_orderkey", F.array_join("errors", ",").alias("errors"))


# ---------------------------------------------------------------- cohorts and actions


def _facts(spark: SparkSession, d: str) -> DataFrame:
    """Customers as cases: their orders are targets, of which those of status P have no reference."""
    o = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("targets"), F.count_if(F.col("o_orderstatus") == "P").alias("loose"), F.count_if(F.col("o_orderstatus") == "F").alias("s0"), F.count_if(F.col("o_totalprice") > 60000).alias("s2"), F.max("o_totalprice").alias("most"))
    rows = _t(spark, d, "customer").join(o, "c_custkey", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("targets", "loose", "s0", "s2")})
    n = F.col("targets")
    rows = rows.withColumns({"s0_full": (n > 0) & (F.col("s0") == n), "s2_full": (n > 0) & (F.col("s2") == n), "constrained": F.col("c_acctbal") < -500, "no_role": n == 0})
    rows = rows.withColumn("cohort", decisions.cohort(F.col("c_acctbal") > 0, n, F.col("loose")))
    return rows.withColumn("flags", decisions.cohort_flags(F.col("cohort"), F.col("s2_full"), F.col("constrained"), F.col("loose")))


_FACTS = """o AS (SELECT o_custkey AS c_custkey, count(*) AS targets, count(*) FILTER (WHERE o_orderstatus = 'P') AS loose, count(*) FILTER (WHERE o_orderstatus = 'F') AS s0, count(*) FILTER (WHERE o_totalprice > 60000) AS s2 FROM orders GROUP BY ALL),
z AS (SELECT c_custkey, c_acctbal, coalesce(targets, 0) AS targets, coalesce(loose, 0) AS loose, coalesce(s0, 0) AS s0, coalesce(s2, 0) AS s2 FROM customer LEFT JOIN o USING (c_custkey)),
y AS (SELECT *, CASE WHEN targets = 0 AND c_acctbal > 0 THEN 'ZERO_TRANSFORMER_ROWS' WHEN targets = 0 THEN 'SOURCE_FILE_UNDETERMINED' WHEN loose > 0 THEN 'HAS_UNREFERENCED_TRANSFORMER' ELSE 'ALL_TARGETS_HAVE_REFERENCE' END AS cohort FROM z),
facts AS (SELECT *, loose > 0 AS fa, cohort = 'ZERO_TRANSFORMER_ROWS' AS fb, cohort = 'ALL_TARGETS_HAVE_REFERENCE' AND s2 < targets AS fc, c_acctbal < -500 AS fd FROM y)"""


@query(f"""WITH {_FACTS} SELECT c_custkey, cohort, concat(CASE WHEN fa THEN 'A' END, CASE WHEN fb THEN 'B' END, CASE WHEN fc THEN 'C' END, CASE WHEN fd THEN 'D' END) AS flags,
CASE WHEN targets > 0 AND NOT fd AND NOT fa AND s0 = targets THEN 'SOURCE_EVIDENCE_SUFFICIENT' ELSE array_to_string(list_filter([CASE WHEN targets = 0 THEN 'ROLE_UNDETERMINED' END, CASE WHEN fd THEN 'BLOCKED_BY_CONFLICT' END, CASE WHEN fa THEN 'NEEDS_SYNTHETIC_COMPLETION' END, CASE WHEN targets = 0 OR s0 < targets THEN 'NEEDS_RULE_REVIEW' END], lambda x: x IS NOT NULL), ',') END AS readiness FROM facts""")
def q63_recovery_readiness(spark, d):
    ready = decisions.readiness(F.col("flags"), F.col("no_role"), ~F.col("s0_full"))
    return _facts(spark, d).select("c_custkey", "cohort", F.array_join("flags", "").alias("flags"), F.array_join(ready, ",").alias("readiness"))


@query(f"""WITH {_FACTS} SELECT c_custkey, CASE WHEN fd THEN 'BLOCKED_BY_SOURCE_CONFLICT' WHEN fb OR targets = 0 THEN 'ROLE_CONFIRMATION_REQUIRED' WHEN s0 = targets THEN 'ALREADY_TARGET_COMPLETE' WHEN fc OR s2 = targets OR (s2 > 0 AND s0 = 0) THEN 'DETERMINISTIC_RULE_REVIEW'
WHEN c_acctbal < 1000 OR (s0 = 0 AND s2 = 0) THEN 'INSUFFICIENT_STRUCTURE' WHEN fa AND c_custkey % 2 = 0 THEN 'AUTO_SYNTHETIC_ELIGIBLE' WHEN fa THEN 'ROLE_CONFIRMATION_REQUIRED' ELSE 'DETERMINISTIC_RULE_REVIEW' END AS action FROM facts""")
def q64_completion_action(spark, d):
    c = F.col
    action = decisions.completion_action(c("flags"), c("targets"), c("s0_full"), c("s2_full"), c("s0") > 0, c("s2") > 0, c("c_acctbal") >= 1000, c("c_custkey") % 2 == 0)
    return _facts(spark, d).select("c_custkey", action.alias("action"))


# ---------------------------------------------------------------- references


@query(f"""WITH {_GATE}, own AS (SELECT case_id, ref, count(*) AS n, bool_and(s_acctbal >= 0) AS sole, min(s_suppkey) AS account FROM entity GROUP BY ALL), e AS (SELECT reference_id, case_id, CASE WHEN o_orderpriority LIKE '5%' THEN '' ELSE ref END AS ref FROM refs)
SELECT reference_id, status, CASE WHEN status = 'EXACT_CASE_LOCAL' THEN account END AS account FROM (SELECT reference_id, account, CASE WHEN e.ref = '' THEN 'NO_DECLARATION' WHEN n = 1 AND sole THEN 'EXACT_CASE_LOCAL' WHEN n IS NOT NULL THEN 'CASE_LOCAL_AMBIGUOUS' WHEN e.ref IN (SELECT ref FROM entity) THEN 'EXTERNAL_DEFINED' ELSE 'UNDEFINED_REFERENCE' END AS status
  FROM e LEFT JOIN own ON own.case_id = e.case_id AND own.ref = e.ref)""")
def q65_endpoint_resolution(spark, d):
    customer = _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("case_id"))
    raw = F.when(F.col("o_orderpriority").startswith("5"), "").otherwise((F.col("o_orderkey") % 90).cast("string"))
    ends = _t(spark, d, "orders").join(customer, "o_custkey").select(F.col("o_orderkey").alias("reference_id"), "case_id", raw.alias("raw"))
    accounts = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("case_id"), (F.col("s_suppkey") % 70).cast("string").alias("raw"), F.col("s_suppkey").alias("account"), (F.col("s_acctbal") >= 0).alias("sole"))
    return decisions.resolve_endpoints(ends, accounts).select("reference_id", "status", "account")


@query(f"""WITH {_GATE}, own AS (SELECT case_id, ref, count(*) AS n FROM entity GROUP BY ALL), e AS (SELECT reference_id, case_id, CASE WHEN o_orderpriority LIKE '5%' THEN '' ELSE ref END AS raw FROM refs)
SELECT reference_id, raw, CASE WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'UNRESOLVED' END AS code, CASE WHEN n > 1 THEN 'ERROR' ELSE 'WARNING' END AS severity FROM e LEFT JOIN own ON own.case_id = e.case_id AND own.ref = e.raw WHERE raw <> '' AND n IS DISTINCT FROM 1""")
def q66_reference_issues(spark, d):
    customer = _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("case_id"))
    raw = F.when(F.col("o_orderpriority").startswith("5"), "").otherwise((F.col("o_orderkey") % 90).cast("string"))
    refs = _t(spark, d, "orders").join(customer, "o_custkey").select(F.col("o_orderkey").alias("reference_id"), "case_id", raw.alias("raw"))
    own = _t(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("case_id"), (F.col("s_suppkey") % 70).cast("string").alias("raw")).agg(F.count("*").alias("n"))
    return decisions.reference_issues(refs.join(own, ["case_id", "raw"], "left"), "raw", "n").select("reference_id", "raw", "code", "severity")


_COMMON = "len(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[:i] = b[:i]))::BIGINT"


@query(f"""WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber WHEN 7 THEN '' WHEN 6 THEN '1E' || l_suppkey ELSE l_suppkey::VARCHAR END AS a, CASE WHEN l_partkey % 4 = 0 THEN '00' || l_suppkey WHEN l_partkey % 4 = 1 THEN l_suppkey || '_1' ELSE l_partkey::VARCHAR END AS b FROM lineitem),
f AS (SELECT *, {_COMMON} AS common_prefix, regexp_full_match(a, '[0-9]+') AND regexp_full_match(b, '[0-9]+') AS digits FROM p)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, a = b AND a <> '' AS exact_same, digits AND a <> b AS numeric_looking_but_different, common_prefix AS common_prefix_length, greatest(len(a), len(b)) - common_prefix AS differing_suffix_width, len(a) = len(b) AS same_length, regexp_full_match(a, '[0-9]+E[0-9]+') AS scientific_notation,
  digits AND a <> b AND ltrim(a, '0') = ltrim(b, '0') AS leading_zero_only, {', '.join(f"len(a) >= {n} AND len(b) >= {n} AND right(a, {n}) = right(b, {n}) AS suffix_equal_{n}" for n in (1, 2, 3, 6))} FROM f""")
def q67_identifier_features(spark, d):
    supplier, part, turn = F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"), F.col("l_partkey") % 4
    a = F.when(F.col("l_linenumber") == 7, "").when(F.col("l_linenumber") == 6, F.concat(F.lit("1E"), supplier)).otherwise(supplier)
    b = F.when(turn == 0, F.concat(F.lit("00"), supplier)).when(turn == 1, F.concat(supplier, F.lit("_1"))).otherwise(part)
    pairs = _t(spark, d, "lineitem").select(*KEY, a.alias("a"), b.alias("b"))
    told = pairs.select(*KEY, *(v.alias(k) for k, v in decisions.identifier_features(F.col("a"), F.col("b")).items()))
    return told.select("*", *(F.element_at("suffix_equal", F.lit(str(n))).alias(f"suffix_equal_{n}") for n in (1, 2, 3, 6))).drop("suffix_equal")


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN epoch(o_orderdate)::BIGINT WHEN 1 THEN epoch(o_orderdate)::BIGINT - 28800 WHEN 2 THEN epoch(o_orderdate)::BIGINT + 12600 END AS epoch, CASE WHEN o_orderkey % 5 > 2 THEN 'INVALID_TIMESTAMP' END AS issue FROM orders""")
def q68_offset_timestamps(spark, d):
    turn = F.col("o_orderkey") % 5
    zone = F.when(turn == 0, "Z").when(turn == 1, "+08:00").when(turn == 2, "-03:30").when(turn == 3, "").otherwise(" tomorrow")
    text = F.concat(F.regexp_replace(F.col("o_orderdate").cast("string"), " ", "T"), zone)
    value, issue = C.to_instant(text)
    return _t(spark, d, "orders").select("o_orderkey", F.unix_seconds(value).alias("epoch"), issue.alias("issue"))


# ---------------------------------------------------------------- summaries


@query(f"""WITH {_ENDS}, {_MOTIF}, g AS (SELECT l_suppkey, motif, count(*) AS n FROM motifs GROUP BY ALL), m AS (SELECT *, max(n) OVER (PARTITION BY l_suppkey) AS most, sum(n) OVER (PARTITION BY l_suppkey) AS total FROM g)
SELECT l_suppkey, total::BIGINT AS n, string_agg(motif, ',' ORDER BY motif) FILTER (WHERE n = most) AS dominant, round_even(any_value(most::DOUBLE / total), 6) AS purity, (total - any_value(most))::BIGINT AS n_minority, CASE WHEN any_value(most) = total THEN 'ONE_MOTIF' WHEN any_value(most) * 10 >= total * 9 THEN 'PURITY_GE_0_9' ELSE 'MIXED' END AS bucket FROM m GROUP BY l_suppkey, total""")
def q69_motif_purity(spark, d):
    return decisions.dominance(_ends(spark, d).select("l_suppkey", rules.motif(*map(F.col, "abxy")).alias("motif")), "l_suppkey", "motif")


@query(f"""WITH r AS ({K._SQL['q20_device_decision']}), dims AS (SELECT x AS reason, y AS status FROM (SELECT unnest(['PROJECTED', 'IDENTITY_NOT_UNIQUE', 'INCOMPLETE_LINE_EVIDENCE', 'INCIDENT_IDENTITY_CONFLICT', 'DEGREE', 'DIRECTION', 'EXPLICIT_ENDPOINT_EVIDENCE', 'INCIDENT_REFERENCE_NOT_EXACT', 'NAME_VOLTAGE_CONFLICT']) AS x), (SELECT unnest(['ACCEPTED', 'AMBIGUOUS', 'UNRESOLVED', 'EXCLUDED', 'UNSUPPORTED']) AS y))
SELECT d.reason, d.status, count(l_partkey) AS n FROM dims d LEFT JOIN r USING (reason, status) GROUP BY ALL""")
def q70_decision_matrix(spark, d):
    return decisions.matrix(q20_device_decision(spark, d), "reason", ["PROJECTED", *rules.DEVICE_REASONS], "status", decisions.STATUSES)


@query(f"WITH {_TAGS} SELECT population, c_mktsegment, count(*) AS n FROM (SELECT 'ALL' AS population, c_custkey FROM customer UNION ALL SELECT tag, c_custkey FROM tags) JOIN customer USING (c_custkey) GROUP BY ALL")
def q71_group_histograms(spark, d):
    rows = _tagged(spark, d).join(_t(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    return decisions.group_histogram(rows, "tags", "c_mktsegment")


@query(f"""WITH {_TAGS}, rec AS (SELECT DISTINCT tag AS reason, c_nationkey, c_custkey, o_orderpriority AS locator FROM tags JOIN customer USING (c_custkey) JOIN orders ON o_custkey = c_custkey), many AS (SELECT c_custkey FROM rec GROUP BY ALL HAVING count(DISTINCT reason) > 1)
SELECT reason, count(*) AS n_records, count(DISTINCT c_custkey) AS n_owners, count(DISTINCT CASE WHEN c_custkey IN (SELECT c_custkey FROM many) THEN c_custkey END) AS n_overlapping FROM rec GROUP BY ALL""")
def q72_cohort_overlap(spark, d):
    tags = _tagged(spark, d).select("c_custkey", F.explode("tags").alias("reason"))
    nation = _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    orders = _t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("locator"))
    return decisions.cohort_overlap(tags.join(nation, "c_custkey").join(orders, "c_custkey"), "reason", ["c_nationkey", "c_custkey"], "locator")


@query("""WITH s AS (SELECT l_returnflag, count(*) AS n_source FROM lineitem WHERE l_linenumber = 1 GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, coalesce(n_source, 0) + row_number() OVER (PARTITION BY l_returnflag ORDER BY l_linenumber, l_orderkey, l_partkey, l_suppkey) - 1 AS row_index FROM lineitem LEFT JOIN s USING (l_returnflag) WHERE l_linenumber > 1""")
def q73_appended_row_index(spark, d):
    """Appended rows are numbered on from the source rows of their member."""
    item = _t(spark, d, "lineitem").select(*KEY, "l_returnflag")
    source = item.where("l_linenumber = 1").groupBy("l_returnflag").agg(F.count("*").alias("n_source"))
    added = decisions.numbered(item.where("l_linenumber > 1"), ["l_returnflag"], ["l_linenumber", "l_orderkey", "l_partkey", "l_suppkey"])
    return added.join(source, "l_returnflag", "left").select(*KEY, "l_returnflag", (F.coalesce("n_source", F.lit(0)) + F.col("row_index")).alias("row_index"))


# ---------------------------------------------------------------- topology checks


@query(f"""WITH RECURSIVE {_EDGES}, {_LIVE}, {_BOTH.format('live')}, {_HEADS}, {_REACHED}, nodes AS (SELECT c_nationkey AS case_id, 'c' || c_custkey AS node FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT s_nationkey, 's' || s_suppkey FROM supplier WHERE s_suppkey % 10 <> 3),
claimed AS (SELECT DISTINCT case_id, a AS node FROM both_ways), ids AS (SELECT case_id, node AS id FROM nodes UNION ALL SELECT case_id, edge_id FROM edges)
SELECT violation, case_id, count(*) AS n FROM (SELECT 'DUPLICATE_ID' AS violation, case_id FROM (SELECT case_id, id FROM ids GROUP BY ALL HAVING count(*) > 1)
  UNION ALL SELECT 'MISSING_HEAD', case_id FROM heads WHERE (case_id, node) NOT IN (SELECT (case_id, node) FROM nodes)
  UNION ALL SELECT 'DANGLING_BRANCH', case_id FROM edges WHERE (case_id, a) NOT IN (SELECT (case_id, node) FROM nodes) OR (case_id, b) NOT IN (SELECT (case_id, node) FROM nodes)
  UNION ALL SELECT 'REACHABLE_NOT_CLAIMED', case_id FROM (SELECT case_id, node FROM reached EXCEPT SELECT case_id, node FROM claimed) UNION ALL SELECT 'CLAIMED_NOT_REACHABLE', case_id FROM (SELECT case_id, node FROM claimed EXCEPT SELECT case_id, node FROM reached)
  UNION ALL SELECT 'USABLE_DISAGREES', case_id FROM (SELECT case_id, true AS usable FROM live GROUP BY ALL) u WHERE NOT EXISTS (SELECT 1 FROM live l JOIN reached r ON r.case_id = l.case_id AND r.node = l.a WHERE l.case_id = u.case_id)) GROUP BY ALL""")
def q74_topology_violations(spark, d):
    e = graphs._cut(K.edges(spark, d))
    live = e.where("status = 'F'")
    customers = _t(spark, d, "customer").where("c_acctbal >= 0").select(F.col("c_nationkey").alias("case_id"), F.concat(F.lit("c"), "c_custkey").alias("node"))
    suppliers = _t(spark, d, "supplier").where("s_suppkey % 10 <> 3").select(F.col("s_nationkey").alias("case_id"), F.concat(F.lit("s"), "s_suppkey").alias("node"))
    claimed = graphs.undirected(live).select("case_id", F.col("a").alias("node")).distinct()
    usable = live.select("case_id").distinct()
    found = decisions.topology_violations(customers.unionByName(suppliers), e, live, K.heads(spark, d), claimed, usable)
    return found.groupBy("violation", "case_id").agg(F.count("*").alias("n"))
