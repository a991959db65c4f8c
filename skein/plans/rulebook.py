"""Queries of ordered rules, counterfactual graphs and placement over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import graphs, identity, imports, references, rules, tables
from skein.plans import catalogue as K
from skein.plans.catalogue import _BOTH, _COVERAGE, _EDGES, _GROUPS, _HEADS, _LIVE, _TRAFFIC, _t, query
from skein.sinks import artifacts
from skein.sources import archives, registry

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# ---------------------------------------------------------------- motifs and evidence


def _ends(spark: SparkSession, d: str) -> DataFrame:
    """Line items as wedges: outer ends a and b, own ends x and y (some absent), and the four ends' reference states."""
    text = lambda key, m, gap: F.when(F.col(key) % m == gap, "").otherwise((F.col(key) % m).cast("string"))
    state = F.when(F.col("l_linenumber") == 7, "AMBIGUOUS").when(F.col("l_linenumber") == 6, "UNRESOLVED").when((F.col("x") == "") | (F.col("y") == ""), "MISSING").otherwise("EXACT")
    ends = _t(spark, d, "lineitem").select(*KEY, text("l_suppkey", 5, 9).alias("a"), text("l_partkey", 5, 9).alias("b"), text("l_orderkey", 6, 5).alias("x"), text("l_suppkey", 7, 6).alias("y"), (F.col("l_partkey") % 11 == 0).alias("layer"))
    return ends.withColumn("states", F.array(F.lit("EXACT"), state))


_ENDS = """ends AS (SELECT *, CASE WHEN l_linenumber = 7 THEN 'AMBIGUOUS' WHEN l_linenumber = 6 THEN 'UNRESOLVED' WHEN x = '' OR y = '' THEN 'MISSING' ELSE 'EXACT' END AS state FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_suppkey % 5)::VARCHAR AS a, (l_partkey % 5)::VARCHAR AS b, CASE l_orderkey % 6 WHEN 5 THEN '' ELSE (l_orderkey % 6)::VARCHAR END AS x, CASE l_suppkey % 7 WHEN 6 THEN '' ELSE (l_suppkey % 7)::VARCHAR END AS y, l_partkey % 11 = 0 AS layer FROM lineitem))"""
_MOTIF = """motifs AS (SELECT *, CASE WHEN x = '' AND y = '' THEN 'BOTH_MISSING' WHEN x = '' THEN 'X_MISSING' WHEN y = '' THEN 'Y_MISSING' WHEN (x, y) = (a, b) THEN 'DIRECT' WHEN (y, x) = (a, b) THEN 'REVERSE' WHEN x = y THEN 'X_EQUALS_Y'
  WHEN a NOT IN (x, y) AND b NOT IN (x, y) THEN 'BOTH_DIFFERENT' WHEN x = a AND x <> b AND y NOT IN (a, b) THEN 'X_A_ONLY' WHEN y = b AND y <> a AND x NOT IN (a, b) THEN 'Y_B_ONLY' WHEN x = b AND x <> a AND y NOT IN (a, b) THEN 'X_B_ONLY' WHEN y = a AND y <> b AND x NOT IN (a, b) THEN 'Y_A_ONLY' ELSE 'OTHER_PARTIAL' END AS motif FROM ends)"""


@query(f"WITH {_ENDS}, {_MOTIF} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, motif FROM motifs")
def q17_literal_motif(spark, d):
    return _ends(spark, d).select(*KEY, rules.motif(*map(F.col, "abxy")).alias("motif"))


@query(f"""WITH RECURSIVE {_EDGES}, {_BOTH.format('edges')}, {_HEADS}, {K._WALK}, c AS (SELECT case_id, node, min(root) AS component FROM walk GROUP BY ALL),
  pairs AS (SELECT u.case_id, u.node AS first, h.node AS second FROM (SELECT c_nationkey AS case_id, 'c' || c_custkey AS node FROM customer UNION ALL SELECT s_nationkey, 's' || s_suppkey FROM supplier) u LEFT JOIN heads h USING (case_id)),
  mid AS (SELECT p.case_id, p.first, p.second, min(m.b) AS witness FROM pairs p JOIN both_ways m ON m.case_id = p.case_id AND m.a = p.first JOIN both_ways n ON n.case_id = p.case_id AND n.a = m.b AND n.b = p.second GROUP BY ALL)
SELECT case_id, first, second, distance, CASE WHEN distance = '2' THEN witness END AS witness FROM (SELECT p.*, witness, CASE WHEN p.second IS NULL THEN 'UNRESOLVED' WHEN p.first = p.second THEN '0'
  WHEN EXISTS (SELECT 1 FROM both_ways e WHERE e.case_id = p.case_id AND e.a = p.first AND e.b = p.second) THEN '1' WHEN witness IS NOT NULL THEN '2' WHEN x.component = y.component THEN 'GT2' ELSE 'DISCONNECTED' END AS distance
  FROM pairs p LEFT JOIN mid USING (case_id, first, second) LEFT JOIN c x ON x.case_id = p.case_id AND x.node = p.first LEFT JOIN c y ON y.case_id = p.case_id AND y.node = p.second)""")
def q18_two_hop_relation(spark, d):
    customers = _t(spark, d, "customer").select(F.col("c_nationkey").alias("case_id"), F.concat(F.lit("c"), "c_custkey").alias("first"))
    suppliers = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("case_id"), F.concat(F.lit("s"), "s_suppkey").alias("first"))
    pairs = customers.unionByName(suppliers).join(K.heads(spark, d).withColumnRenamed("node", "second"), "case_id", "left")
    return graphs.relation(pairs, K.edges(spark, d))


@query(f"""WITH {_ENDS}, {_MOTIF}, b AS (SELECT *, CASE WHEN state = 'EXACT' AND motif = 'DIRECT' THEN 'EXACT_COMPATIBLE' WHEN state = 'EXACT' AND motif = 'REVERSE' THEN 'REVERSE_COMPATIBLE' WHEN layer THEN 'DIFFERENT_SOURCE_LAYER' WHEN state = 'AMBIGUOUS' THEN 'ENDPOINT_AMBIGUOUS' WHEN state = 'UNRESOLVED' THEN 'ENDPOINT_UNRESOLVED'
  WHEN motif = 'BOTH_MISSING' THEN 'BOTH_ENDPOINTS_MISSING' WHEN state = 'MISSING' THEN 'ONE_ENDPOINT_MISSING' WHEN x = a OR y = b OR x = b OR y = a THEN 'PARTIAL_COMPATIBLE' WHEN motif = 'BOTH_DIFFERENT' THEN 'BOTH_ENDPOINTS_DIFFERENT' ELSE 'OTHER' END AS bucket FROM motifs)
SELECT bucket, CASE WHEN bucket LIKE '%T_COMPATIBLE' OR bucket = 'REVERSE_COMPATIBLE' THEN 'COMPATIBLE_SOURCE_EVIDENCE' WHEN bucket LIKE '%LAYER' THEN 'DIFFERENT_ABSTRACTION_EVIDENCE' ELSE 'UNRESOLVED_SEMANTICS' END AS assessment, motif, count(*) AS n FROM b GROUP BY ALL""")
def q19_evidence_bucket(spark, d):
    exact = F.forall("states", lambda s: s == "EXACT")
    e = _ends(spark, d).withColumn("motif", rules.motif(*map(F.col, "abxy")))
    e = e.withColumn("bucket", rules.evidence_bucket(F.col("motif"), rules.matches(*map(F.col, "abxy")), exact, F.col("layer"), F.col("states")))
    return e.groupBy("bucket", rules.assessment(F.col("bucket")).alias("assessment"), "motif").agg(F.count("*").alias("n"))


_DEVICES = f"""{_GROUPS}, devices AS (SELECT l_partkey, l_suppkey, count(*) AS degree, count(*) FILTER (WHERE l_returnflag = 'N') AS n_out, bool_or(identity_status <> 'UNIQUE') AS conflict, bool_or(l_quantity < 2) AS malformed, bool_or(l_tax = 0) AS explicit FROM lineitem JOIN groups USING (l_orderkey, l_linenumber) GROUP BY ALL)"""


@query(f"""WITH {_DEVICES}, r AS (SELECT l_partkey, l_suppkey, CASE WHEN p_size > 45 THEN 'IDENTITY_NOT_UNIQUE' WHEN malformed THEN 'INCOMPLETE_LINE_EVIDENCE' WHEN conflict THEN 'INCIDENT_IDENTITY_CONFLICT' WHEN degree <> 2 THEN 'DEGREE' WHEN n_out <> 1 THEN 'DIRECTION' WHEN explicit THEN 'EXPLICIT_ENDPOINT_EVIDENCE' WHEN s_acctbal < 0 THEN 'INCIDENT_REFERENCE_NOT_EXACT' WHEN p_size < 5 THEN 'NAME_VOLTAGE_CONFLICT' ELSE 'PROJECTED' END AS reason
  FROM devices JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)
SELECT l_partkey, l_suppkey, reason, CASE reason WHEN 'PROJECTED' THEN 'ACCEPTED' WHEN 'IDENTITY_NOT_UNIQUE' THEN 'AMBIGUOUS' WHEN 'INCIDENT_REFERENCE_NOT_EXACT' THEN 'UNRESOLVED' ELSE 'EXCLUDED' END AS status FROM r""")
def q20_device_decision(spark, d):
    rows = identity.stamp(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], K.ITEM_FIELDS)
    made = rows.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("degree"), F.count_if(F.col("l_returnflag") == "N").alias("n_out"), F.max(F.col("identity_status") != "UNIQUE").alias("conflict"), F.max(F.col("l_quantity") < 2).alias("malformed"), F.max(F.col("l_tax") == 0).alias("explicit"))
    part = _t(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    supplier = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_acctbal")
    holds = {
        "IDENTITY_NOT_UNIQUE": F.col("p_size") > 45, "INCOMPLETE_LINE_EVIDENCE": F.col("malformed"), "INCIDENT_IDENTITY_CONFLICT": F.col("conflict"), "DEGREE": F.col("degree") != 2, "DIRECTION": F.col("n_out") != 1,
        "EXPLICIT_ENDPOINT_EVIDENCE": F.col("explicit"), "INCIDENT_REFERENCE_NOT_EXACT": F.col("s_acctbal") < 0, "NAME_VOLTAGE_CONFLICT": F.col("p_size") < 5,
    }
    out = made.join(part, "l_partkey").join(supplier, "l_suppkey").withColumn("reason", rules.device_reason(holds))
    return out.select("l_partkey", "l_suppkey", "reason", rules.reason_status(F.col("reason")).alias("status"))


# ---------------------------------------------------------------- counterfactual graphs

_WALKS = """ways AS (SELECT policy, case_id, a, b FROM overlay UNION SELECT policy, case_id, b, a FROM overlay), walk AS (SELECT policy, case_id, a AS root, a AS node FROM ways UNION SELECT w.policy, w.case_id, w.root, e.b FROM walk w JOIN ways e ON e.policy = w.policy AND e.case_id = w.case_id AND e.a = w.node)"""


@query(f"""WITH RECURSIVE {_EDGES}, overlay AS (SELECT 'before' AS policy, * FROM edges WHERE status = 'F' UNION ALL SELECT 'after', * FROM edges WHERE status IN ('F', 'P')), {_WALKS}
SELECT case_id, edge_id, a, b, before, after, after AND NOT before AS bypassed FROM (SELECT case_id, edge_id, a, b, EXISTS (SELECT 1 FROM walk w WHERE w.policy = 'before' AND w.case_id = e.case_id AND w.root = e.a AND w.node = e.b) AS before,
  EXISTS (SELECT 1 FROM walk w WHERE w.policy = 'after' AND w.case_id = e.case_id AND w.root = e.a AND w.node = e.b) AS after FROM edges e WHERE status = 'O')""")
def q27_open_cut_bypass(spark, d):
    e = graphs._cut(K.edges(spark, d))
    graph = lambda *s: e.where(F.col("status").isin(*s)).select("case_id", "a", "b")
    return graphs.bypassed(e.where("status = 'O'"), graph("F"), graph("F", "P"))


_DOMINANT = f"""{_TRAFFIC}, g AS (SELECT c_nationkey AS a, s_nationkey AS b, count(*) AS n FROM traffic WHERE c_nationkey <> s_nationkey GROUP BY ALL), dominant AS (SELECT g.a, g.b FROM g LEFT JOIN g h ON h.a = g.b AND h.b = g.a WHERE g.n > coalesce(h.n, 0) AND g.n > 1)"""


@query(f"""WITH RECURSIVE {_DOMINANT}, to_ AS (SELECT a, a AS b FROM dominant UNION SELECT b, b FROM dominant UNION SELECT t.a, d.b FROM to_ t JOIN dominant d ON d.a = t.b)
SELECT t.a AS nation, min(t.b) AS component FROM to_ t JOIN to_ u ON u.a = t.b AND u.b = t.a GROUP BY ALL""")
def q28_strong_components(spark, d):
    flow = K._foreign(spark, d).groupBy(F.col("source").alias("a"), F.col("target").alias("b")).agg(F.count("*").alias("n"))
    back = flow.select(F.col("a").alias("b"), F.col("b").alias("a"), F.col("n").alias("n_back"))
    more = flow.join(back, ["a", "b"], "left").where("n > coalesce(n_back, 0) and n > 1").select(F.lit(0).alias("case_id"), "a", "b")
    return graphs.strong_components(more).select(F.col("node").alias("nation"), "component")


@query(f"""WITH RECURSIVE {_COVERAGE}, s AS (SELECT policy, sum(n_reached)::BIGINT AS n_reached, sum(n_targets)::BIGINT AS n_targets, count(*) FILTER (WHERE status = 'FULL') AS n_full FROM coverage GROUP BY ALL)
SELECT s.policy, s.n_reached, s.n_targets, s.n_full, s.n_reached - z.n_reached AS delta, (round_even(s.n_reached::DECIMAL(38,10) / s.n_targets, 6))::DOUBLE AS ratio FROM s JOIN s z ON z.policy = 'S0'""")
def q29_strategy_comparison(spark, d):
    s = K.coverage(spark, d).groupBy("policy").agg(F.sum("n_reached").alias("n_reached"), F.sum("n_targets").alias("n_targets"), F.count_if(F.col("status") == "FULL").alias("n_full"))
    base = s.where("policy = 'S0'").select(F.col("n_reached").alias("base"))
    return s.join(F.broadcast(base)).select("policy", "n_reached", "n_targets", "n_full", (F.col("n_reached") - F.col("base")).alias("delta"), F.bround(F.col("n_reached") / F.col("n_targets"), 6).alias("ratio"))


TIES = ["tie", "normal", "unknown_type"]


@query(f"""WITH RECURSIVE {_EDGES}, tied AS (SELECT e.*, CASE split_part(edge_id, ':', 1)::BIGINT % 3 WHEN 0 THEN 'tie' WHEN 1 THEN 'normal' ELSE 'unknown_type' END AS tie FROM edges e), groups AS (SELECT unnest(['tie', 'normal', 'unknown_type']) AS g), {_HEADS},
overlay AS (SELECT 'only|' || g AS policy, case_id, a, b FROM tied, groups WHERE status = 'F' OR (status = 'O' AND tie = g) UNION ALL SELECT 'without|' || g, case_id, a, b FROM tied, groups WHERE status = 'F' OR (status = 'O' AND tie <> g) UNION ALL SELECT 'none', case_id, a, b FROM tied WHERE status = 'F' UNION ALL SELECT 'all', case_id, a, b FROM tied WHERE status IN ('F', 'O')),
ways AS (SELECT policy, case_id, a, b FROM overlay UNION SELECT policy, case_id, b, a FROM overlay), names AS (SELECT 'only|' || g AS policy FROM groups UNION ALL SELECT 'without|' || g FROM groups UNION ALL SELECT 'none' UNION ALL SELECT 'all'),
r AS (SELECT policy, case_id, node FROM heads, names UNION SELECT r.policy, r.case_id, w.b FROM r JOIN ways w ON w.policy = r.policy AND w.case_id = r.case_id AND w.a = r.node),
n AS (SELECT names.policy, count(node) FILTER (WHERE node LIKE 'c%') AS n FROM names LEFT JOIN r USING (policy) GROUP BY ALL)
SELECT g AS tie_group, o.n - z.n AS gain_alone, f.n - w.n AS loss_without FROM groups JOIN n o ON o.policy = 'only|' || g JOIN n w ON w.policy = 'without|' || g JOIN n z ON z.policy = 'none' JOIN n f ON f.policy = 'all'""")
def q30_tie_group_effect(spark, d):
    order = F.substring_index("edge_id", ":", 1).cast("long") % 3
    tie = F.when(order == 0, "tie").when(order == 1, "normal").otherwise("unknown_type")
    e = K.edges(spark, d).where("status in ('F', 'O')").withColumn("tie", tie)
    live, closed = F.lit(True), F.col("status") == "F"
    policies = {"none": closed, "all": live} | {f"only-{g}": closed | (F.col("tie") == g) for g in TIES} | {f"without-{g}": closed | (F.col("tie") != g) for g in TIES}
    named = F.array_compact(F.array(*(F.when(c, F.lit(p)) for p, c in policies.items())))
    keyed = e.select(F.explode(named).alias("policy"), "case_id", "a", "b").select(F.concat_ws("|", "policy", "case_id").alias("case_id"), "a", "b")
    starts = K.heads(spark, d).select(F.explode(F.array(*map(F.lit, policies))).alias("policy"), "case_id", "node").select(F.concat_ws("|", "policy", "case_id").alias("case_id"), "node")
    got = graphs.reached(starts, keyed).groupBy(F.substring_index("case_id", "|", 1).alias("policy")).agg(F.count_if(F.col("node").startswith("c")).alias("n"))
    one = got.agg(*(F.sum(F.when(F.col("policy") == p, F.col("n")).otherwise(0)).alias(p) for p in policies))
    effects = F.array(*(F.struct(F.lit(g).alias("tie_group"), (F.col(f"only-{g}") - F.col("none")).alias("gain_alone"), (F.col("all") - F.col(f"without-{g}")).alias("loss_without")) for g in TIES))
    return one.select(F.inline(effects))


# ---------------------------------------------------------------- blockers


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    """Customers with the tags that keep them from being served, by priority."""
    order = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("n_unknown"), F.count_if(F.col("o_orderstatus") == "O").alias("n_open"), F.count_if(F.col("o_orderstatus") == "F").alias("n_closed"))
    known = lambda c: F.coalesce(c, F.lit(False))
    holds = {"missing_source": F.col("n").isNull(), "switch_unknown": known(F.col("n_unknown") > 0), "tie_unresolved": known(F.col("n_open") > 5), "topology_disconnected": known(F.col("n_closed") == 0), "transformer_unreachable": F.col("c_acctbal") < 0}
    return _t(spark, d, "customer").join(order, "c_custkey", "left").select("c_custkey", rules.blockers(holds).alias("tags"))


_TAGS = """o AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'P') AS n_unknown, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_closed FROM orders GROUP BY ALL),
tags AS (SELECT c_custkey, 1 AS place, 'missing_source' AS tag FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT o_custkey, 2, 'switch_unknown' FROM o WHERE n_unknown > 0 UNION ALL SELECT o_custkey, 3, 'tie_unresolved' FROM o WHERE n_open > 5 UNION ALL SELECT o_custkey, 4, 'topology_disconnected' FROM o WHERE n_closed = 0 UNION ALL SELECT c_custkey, 5, 'transformer_unreachable' FROM customer WHERE c_acctbal < 0)"""


@query(f"WITH {_TAGS} SELECT tag, count(*) FILTER (WHERE place = first) AS n_primary, count(*) AS n_overlapping FROM (SELECT *, min(place) OVER (PARTITION BY c_custkey) AS first FROM tags) GROUP BY ALL")
def q33_blocker_tags(spark, d):
    return rules.tag_summary(_tagged(spark, d), "tags")


@query(f"WITH {_TAGS} SELECT x.tag AS first, y.tag AS second, count(*) AS n FROM tags x JOIN tags y USING (c_custkey) WHERE x.tag < y.tag GROUP BY ALL")
def q34_overlap_pairs(spark, d):
    return rules.tag_pairs(_tagged(spark, d), "tags")


# ---------------------------------------------------------------- recovery and placement


@query(f"""WITH RECURSIVE {_EDGES}, {_LIVE}, {_BOTH.format('live')}, {K._WALK}, c AS (SELECT case_id, node, min(root) AS component FROM walk GROUP BY ALL)
SELECT case_id, node, n_components, CASE n_components WHEN 0 THEN 'NO_COMPONENT' WHEN 1 THEN 'ATTACH' ELSE 'NON_UNIQUE' END AS outcome, CASE n_components WHEN 1 THEN component END AS component
FROM (SELECT e.case_id, e.b AS node, count(DISTINCT c.component) AS n_components, min(c.component) AS component FROM edges e LEFT JOIN c ON c.case_id = e.case_id AND c.node = e.a WHERE NOT EXISTS (SELECT 1 FROM live l WHERE l.case_id = e.case_id AND l.b = e.b) GROUP BY ALL)""")
def q38_unique_attachment(spark, d):
    e = graphs._cut(K.edges(spark, d))
    live = e.where("status = 'F'")
    label = graphs.components(live).select("case_id", F.col("node").alias("a"), "component")
    loose = e.join(live.select("case_id", "b").distinct(), ["case_id", "b"], "left_anti").select("case_id", "a", F.col("b").alias("node")).distinct()
    found = loose.join(label, ["case_id", "a"], "left").groupBy("case_id", "node").agg(F.count_distinct("component").alias("n_components"), F.min("component").alias("least"))
    n = F.col("n_components")
    return found.select("case_id", "node", "n_components", F.when(n == 0, "NO_COMPONENT").when(n == 1, "ATTACH").otherwise("NON_UNIQUE").alias("outcome"), F.when(n == 1, F.col("least")).alias("component"))


@query(f"""WITH RECURSIVE {_EDGES}, {_HEADS}, overlay AS (SELECT 'S0' AS policy, case_id, a, b FROM edges WHERE status = 'F' UNION ALL SELECT 'S1', case_id, a, b FROM edges WHERE status IN ('F', 'O')), ways AS (SELECT policy, case_id, a, b FROM overlay UNION SELECT policy, case_id, b, a FROM overlay),
r AS (SELECT policy, case_id, node FROM heads, (SELECT DISTINCT policy FROM overlay) UNION SELECT r.policy, r.case_id, w.b FROM r JOIN ways w ON w.policy = r.policy AND w.case_id = r.case_id AND w.a = r.node),
m AS (SELECT case_id, node, bool_and(policy <> 'S0') AS fresh FROM r GROUP BY ALL)
SELECT e.case_id, edge_id, a, b FROM edges e JOIN m x ON x.case_id = e.case_id AND x.node = a JOIN m y ON y.case_id = e.case_id AND y.node = b WHERE status = 'P' AND (x.fresh OR y.fresh)""")
def q39_overlay_recovery(spark, d):
    e = graphs._cut(K.edges(spark, d))
    old = graphs.reached(K.heads(spark, d), e.where("status = 'F'")).select("case_id", "node", F.lit(False).alias("fresh"))
    both = old.unionByName(graphs.reached(K.heads(spark, d), e.where("status in ('F', 'O')")).select("case_id", "node", F.lit(True).alias("fresh")))
    mapped = graphs._cut(both.groupBy("case_id", "node").agg(F.min("fresh").alias("fresh")))
    end = lambda side: mapped.select("case_id", F.col("node").alias(side), F.col("fresh").alias(f"fresh_{side}"))
    return e.where("status = 'P'").join(end("a"), ["case_id", "a"]).join(end("b"), ["case_id", "b"]).where("fresh_a or fresh_b").select("case_id", "edge_id", "a", "b")


_GATE = """entity AS (SELECT s_nationkey AS case_id, (s_suppkey % 70)::VARCHAR AS ref, s_suppkey, s_acctbal FROM supplier), refs AS (SELECT o_orderkey AS reference_id, c_nationkey AS case_id, (o_orderkey % 90)::VARCHAR AS ref, o_totalprice, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query(f"""WITH {_GATE}, counted AS (SELECT r.*, count(s_suppkey) FILTER (WHERE e.case_id = r.case_id) AS n_local, count(s_suppkey) FILTER (WHERE e.case_id <> r.case_id) AS n_foreign, min(s_suppkey) FILTER (WHERE e.case_id <> r.case_id) AS donor FROM refs r LEFT JOIN entity e USING (ref) GROUP BY ALL)
SELECT reference_id, CASE WHEN n_foreign > 1 THEN 'MULTIPLE_EXTERNAL' WHEN n_foreign = 0 AND n_local > 0 THEN 'LOCAL_UNRESOLVED_ONLY' WHEN n_foreign = 0 THEN 'UNDEFINED_GLOBAL' WHEN s_acctbal < 0 THEN 'AMBIGUOUS_IDENTITY' WHEN o_orderpriority LIKE '1%' AND s_suppkey % 2 = 0 THEN 'TYPE_INCOMPATIBLE'
  WHEN o_totalprice > 300000 THEN 'VOLTAGE_NOT_COMPATIBLE' WHEN n_local > 0 THEN 'ALSO_RESOLVES_CASE_LOCALLY' WHEN c.case_id % 9 = 0 THEN 'REFERRING_CASE_HARD_BLOCKER' WHEN s_nationkey % 9 = 1 THEN 'DONOR_CASE_HARD_BLOCKER' WHEN x.n_regionkey <> y.n_regionkey THEN 'TIER_NOT_MATERIALIZED' ELSE '' END AS reason
FROM counted c LEFT JOIN supplier ON n_foreign = 1 AND s_suppkey = donor LEFT JOIN nation x ON x.n_nationkey = c.case_id LEFT JOIN nation y ON y.n_nationkey = s_nationkey""")
def q43_cross_case_gate(spark, d):
    region = _t(spark, d, "nation").select(F.col("n_nationkey").alias("case_id"), F.col("n_regionkey").alias("region"))
    entities = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("case_id"), (F.col("s_suppkey") % 70).cast("string").alias("ref"), "s_suppkey", "s_acctbal")
    customer = _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("case_id"))
    refs = _t(spark, d, "orders").join(customer, "o_custkey").select(F.col("o_orderkey").alias("reference_id"), "case_id", (F.col("o_orderkey") % 90).cast("string").alias("ref"), "o_totalprice", "o_orderpriority")
    # A ref with one foreign entity has at most two cases that hold it: one donor by ref and case is enough.
    donors = entities.join(region, "case_id", "left").groupBy("ref", F.col("case_id").alias("donor_case")).agg(F.min(F.struct("s_suppkey", "s_acctbal", "region")).alias("donor"))
    known = references.across_cases(refs, entities).select("reference_id", "n_local", "n_foreign", "classification")
    rows = refs.join(known, "reference_id").join(region, "case_id", "left")
    sole = rows.where("n_foreign = 1").join(donors, "ref", "left").where("donor_case <> case_id")
    rows = sole.unionByName(rows.where("n_foreign <> 1"), allowMissingColumns=True)
    holds = {
        "NO_CANONICAL_CANDIDATE": F.col("donor").isNull(), "AMBIGUOUS_IDENTITY": F.col("donor.s_acctbal") < 0, "TYPE_INCOMPATIBLE": F.col("o_orderpriority").startswith("1") & (F.col("donor.s_suppkey") % 2 == 0),
        "VOLTAGE_NOT_COMPATIBLE": F.col("o_totalprice") > 300000, "ALSO_RESOLVES_CASE_LOCALLY": F.col("n_local") > 0, "REFERRING_CASE_HARD_BLOCKER": F.col("case_id") % 9 == 0, "DONOR_CASE_HARD_BLOCKER": F.col("donor_case") % 9 == 1,
        "TIER_NOT_MATERIALIZED": F.col("region") != F.col("donor.region"),
    }
    return rows.select("reference_id", rules.cross_case_gate(F.col("classification"), "UNIQUE_EXTERNAL", holds).alias("reason"))


@query("""WITH port AS (SELECT l_partkey, l_orderkey, (l_suppkey % 10)::VARCHAR AS raw FROM lineitem), told AS (SELECT o_orderkey, (o_custkey % 10)::VARCHAR AS raw, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS value FROM orders),
g AS (SELECT l_orderkey % 500 AS case_id, p.raw, count(*) AS n_ports, count(*) FILTER (WHERE l_partkey % 3 = 0 AND t.raw IS DISTINCT FROM p.raw) AS n_mismatched, min(value) AS low, max(value) AS high FROM port p LEFT JOIN told t ON o_orderkey = l_orderkey GROUP BY ALL)
SELECT case_id, raw, n_ports, n_mismatched, CASE WHEN n_mismatched > 0 THEN 'WITHHELD' ELSE 'PROPOSED' END AS outcome, CASE WHEN n_mismatched = 0 AND low = high THEN low END AS value, CASE WHEN n_mismatched > 0 THEN 'EVIDENCE_JOIN_MISMATCH' WHEN low IS NULL THEN 'VALUE_ABSENT' WHEN low <> high THEN 'VALUE_CONFLICT' END AS reason FROM g""")
def q45_placement_withholding(spark, d):
    item = _t(spark, d, "lineitem").select("l_partkey", F.col("l_orderkey").alias("o_orderkey"), (F.col("l_suppkey") % 10).cast("string").alias("raw"))
    order = _t(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 10).cast("string").alias("told"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("value"))
    ports = item.select("o_orderkey", "raw", (F.col("o_orderkey") % 500).alias("case_id"), (F.col("l_partkey") % 3 == 0).alias("strict"))
    # Ports that are not strict take the raw value that they declare.
    asked = ports.select("o_orderkey", "raw", "strict").distinct().join(order, "o_orderkey", "left")
    evidence = asked.select("o_orderkey", "raw", "strict", F.when(F.col("strict"), F.col("told")).otherwise(F.col("raw")).alias("_told"), "value")
    return rules.withhold(ports.withColumn("_told", F.col("raw")), evidence, ["case_id", "raw"], ["o_orderkey", "raw", "strict"], "_told", "value")


@query(f"""WITH RECURSIVE {_EDGES}, {_LIVE}, {_BOTH.format('live')}, {K._WALK}, c AS (SELECT case_id, node, min(root) AS component FROM walk GROUP BY ALL),
hop AS (SELECT DISTINCT case_id, component AS node, 0 AS hops FROM c UNION SELECT h.case_id, e.b, hops + 1 FROM hop h JOIN both_ways e ON e.case_id = h.case_id AND e.a = h.node WHERE hops < 40), depth AS (SELECT case_id, node, min(hops) AS depth FROM hop GROUP BY ALL),
ways AS (SELECT case_id, a, b, edge_id FROM live UNION ALL SELECT case_id, b, a, edge_id FROM live),
tree AS (SELECT w.case_id, w.a AS node, min((w.b, w.edge_id)) AS up FROM ways w JOIN depth x ON x.case_id = w.case_id AND x.node = w.a JOIN depth y ON y.case_id = w.case_id AND y.node = w.b WHERE y.depth = x.depth - 1 GROUP BY ALL),
above AS (SELECT case_id, node, node AS top, 0 AS far FROM depth UNION ALL SELECT v.case_id, v.node, t.up[1], far + 1 FROM above v JOIN tree t ON t.case_id = v.case_id AND t.node = v.top)
SELECT e.case_id, edge_id, min(x.far + y.far + 1)::INT AS length FROM live e JOIN above x ON x.case_id = e.case_id AND x.node = e.a JOIN above y ON y.case_id = e.case_id AND y.node = e.b AND y.top = x.top WHERE (e.case_id, edge_id) NOT IN (SELECT (case_id, up[2]) FROM tree) GROUP BY ALL""")
def q54_cycle_basis(spark, d):
    return graphs.cycle_basis(graphs._cut(K.edges(spark, d).where("status = 'F'").select("case_id", "edge_id", "a", "b")))


# ---------------------------------------------------------------- import and archives


def _members(spark: SparkSession, d: str) -> DataFrame:
    """An archive for each region, in it a folder for each nation, with a file of buses (customers) and one of stations (regions)."""
    nation = _t(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    customer = _t(spark, d, "customer").join(nation, "c_nationkey")
    key = F.when(F.col("c_custkey") % 50 == 0, "").otherwise((F.col("c_custkey") % 700).cast("string"))
    named = F.when(F.col("c_custkey") % 13 == 0, "none").otherwise(F.concat(F.lit("st"), "n_regionkey"))
    source = F.when(F.col("c_custkey") % 11 == 0, "perhaps").when(F.col("c_custkey") % 2 == 0, "TRUE").otherwise("false")
    bus = customer.select("n_regionkey", "c_nationkey", F.col("c_custkey").alias("place"), artifacts.csv_line(key, F.concat("c_mktsegment", F.lit(', "the" one')), F.col("c_acctbal").cast("decimal(18,2)"), F.lit(""), named, source).alias("line"), F.lit("02_Bus.csv").alias("file"))
    station = nation.select("n_regionkey", "c_nationkey", F.lit(0).cast("long").alias("place"), artifacts.csv_line(F.concat(F.lit("st"), "n_regionkey"), F.lit(""), F.lit("x"), F.lit("10"), F.lit(""), F.lit("")).alias("line"), F.lit("01_Station.csv").alias("file"))
    lines = bus.unionByName(station).groupBy("n_regionkey", "c_nationkey", "file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), "\r\n").alias("body"))
    head = F.element_at(F.create_map(*(F.lit(x) for f in ("01_Station.csv", "02_Bus.csv") for x in (f, ",".join(registry.header(f))))), F.col("file"))
    return lines.select(F.format_string("region%d.zip", "n_regionkey").alias("archive"), F.concat(F.lit("cases/n"), "c_nationkey", F.lit("/"), "file").alias("member"), F.encode(F.concat(head, F.lit("\r\n"), "body"), "UTF-8").alias("content"))


def _rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the archives, written as files and read again by ranges of members."""
    made = artifacts.write_archives(_members(spark, d), f"{tables.Tables(spark).folder}/archives")
    paths = [r.path for r in made.select("path").collect()]
    return archives.read_archives(spark, sorted(paths), registry.headers()).withColumn("archive", F.substring_index("archive", "/", -1))


_BUS = """bus AS (SELECT 'n' || c_nationkey AS case_key, CASE WHEN c_custkey % 50 <> 0 THEN (c_custkey % 700)::VARCHAR END AS id, c_mktsegment || ', "the" one' AS name, c_acctbal::DECIMAL(18,2) AS kv, c_custkey % 13 = 0 AS lost, c_custkey % 11 = 0 AS odd, c_custkey % 2 = 0 AS source, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS data_row, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


@query(f"""WITH {_BUS} SELECT 'region' || n_regionkey || '.zip' AS archive, 'zip-member:cases/' || case_key || '/02_Bus.csv#data-row=' || data_row AS record_ref, data_row::INT AS data_row, id AS bus_id, name AS bus_name, kv::DOUBLE AS base_kv, CASE WHEN NOT odd THEN source::VARCHAR END AS is_source FROM bus""")
def q55_archive_round_trip(spark, d):
    rows = imports.typed(_rows(spark, d), "02_Bus.csv")
    return rows.select("archive", "record_ref", "data_row", F.col("Bus_ID").alias("bus_id"), F.col("Bus_Name").alias("bus_name"), F.col("Bus_BaseKV").cast("double").alias("base_kv"), F.col("Bus_IsSource").cast("string").alias("is_source"))


@query(f"""WITH {_BUS}, g AS (SELECT case_key, id, count(*) AS n FROM bus WHERE id IS NOT NULL GROUP BY ALL)
SELECT case_key, CASE WHEN id IS NULL THEN 'REJECTED' WHEN n > 1 THEN 'DUPLICATE' WHEN lost THEN 'UNRESOLVED' ELSE 'MAPPED' END AS category, count(*) AS n_rows, sum((kv <= 0)::INT + odd::INT)::BIGINT AS n_issues FROM bus LEFT JOIN g USING (case_key, id) GROUP BY ALL""")
def q56_import_categories(spark, d):
    rows = _rows(spark, d)
    bus = imports.with_identity(imports.typed(rows, "02_Bus.csv"), "Bus_ID")
    station = imports.published(imports.with_identity(imports.typed(rows, "01_Station.csv"), "Station_ID"), "Station_ID").select("case_key", F.col("Station_ID").alias("Bus_Station_ID"), F.lit(True).alias("resolved"))
    out = imports.categories(bus.join(station, ["case_key", "Bus_Station_ID"], "left"), "Bus_ID", F.coalesce("resolved", F.lit(False)))
    return out.groupBy("case_key", "category").agg(F.count("*").alias("n_rows"), F.sum(F.size("issues")).cast("long").alias("n_issues"))


@query("SELECT n.n_nationkey AS case_key, 'region' || n.n_regionkey || '.zip' AS archive, f AS file, 'cases/n' || n.n_nationkey || '/' || f AS member, true AS known, true AS safe FROM nation n, (SELECT unnest(['01_Station.csv', '02_Bus.csv']) AS f) WHERE f LIKE '01%' OR n_nationkey IN (SELECT c_nationkey FROM customer)")
def q57_archive_inventory(spark, d):
    found = archives.inventory(artifacts.pack_archives(_members(spark, d)))
    return found.select(F.substring("case_key", 2, 9).cast("int").alias("case_key"), "archive", F.substring_index("member", "/", -1).alias("file"), "member", "known", "safe")


# ---------------------------------------------------------------- seven policies

# The policies, each with the states that conduct and whether tie branches and branches of unproven safety count.
POLICIES = {"S0": ("F", True, True), "S2": ("FO", True, True), "S2_NORMAL_ONLY": ("FO", False, True), "SEMANTIC_CONSERVATIVE": ("FO", True, False), "SEMANTIC_OPTIMISTIC": ("FO", True, True), "S2_UNKNOWN_NONCONDUCTING": ("FO", True, True), "S2_UNKNOWN_CONDUCTING": ("FOP", True, True)}


def _policy_rule(states: str, ties: bool, unproven: bool, tie: Column, proven: Column) -> Column:
    new = F.col("status") != "F"
    rule = F.col("status").isin(*states)
    rule = rule if ties else rule & (~new | ~tie)
    return rule if unproven else rule & (~new | proven)


_POLICY_SQL = " UNION ALL ".join(f"SELECT '{p}' AS policy, case_id, a, b FROM e WHERE contains('{s}', status){'' if t else ' AND (status = ' + chr(39) + 'F' + chr(39) + ' OR NOT tie)'}{'' if u else ' AND (status = ' + chr(39) + 'F' + chr(39) + ' OR proven)'}" for p, (s, t, u) in POLICIES.items())


@query(f"""WITH RECURSIVE {_EDGES}, {_HEADS}, e AS (SELECT *, split_part(edge_id, ':', 1)::BIGINT % 3 = 0 AS tie, split_part(edge_id, ':', 3)::BIGINT % 2 = 0 AS proven FROM edges), overlay AS ({_POLICY_SQL}), names AS (SELECT unnest({list(POLICIES)}) AS policy),
ways AS (SELECT policy, case_id, a, b FROM overlay UNION SELECT policy, case_id, b, a FROM overlay), r AS (SELECT policy, case_id, node FROM heads, names UNION SELECT r.policy, r.case_id, w.b FROM r JOIN ways w ON w.policy = r.policy AND w.case_id = r.case_id AND w.a = r.node),
got AS (SELECT policy, case_id, count(*) FILTER (WHERE node LIKE 'c%') AS n FROM r GROUP BY ALL), total AS (SELECT case_id, count(DISTINCT b) AS n FROM edges GROUP BY ALL),
c AS (SELECT policy, h.case_id, coalesce(t.n, 0) AS n_targets, coalesce(g.n, 0) AS n_reached, u.n IS NOT NULL AS doubtful FROM heads h CROSS JOIN names LEFT JOIN total t USING (case_id) LEFT JOIN got g USING (policy, case_id) LEFT JOIN (SELECT case_id, count(*) AS n FROM edges WHERE status = 'P' GROUP BY ALL) u USING (case_id))
SELECT policy, case_id, n_targets, n_reached, CASE WHEN n_targets > 0 AND n_targets = n_reached THEN 'FULL' WHEN n_reached > 0 THEN 'PARTIAL' ELSE 'FAILED' END AS goal,
  CASE WHEN n_targets > 0 AND n_targets = n_reached THEN NULL WHEN doubtful AND policy <> 'S2_UNKNOWN_CONDUCTING' THEN 'switch_unknown' WHEN n_targets = 0 THEN 'topology_disconnected' ELSE 'transformer_unreachable' END AS primary_reason FROM c""")
def q58_policy_coverage(spark, d):
    e = graphs._cut(K.edges(spark, d))
    part = lambda n: F.element_at(F.split("edge_id", ":"), n).cast("long")
    tie, proven = part(1) % 3 == 0, part(3) % 2 == 0
    named = F.array_compact(F.array(*(F.when(_policy_rule(*how, tie, proven), F.lit(p)) for p, how in POLICIES.items())))
    keyed = e.select(F.explode(named).alias("policy"), "case_id", "a", "b").select(F.concat_ws("|", "policy", "case_id").alias("case_id"), "a", "b")
    starts = K.heads(spark, d).select(F.explode(F.array(*map(F.lit, POLICIES))).alias("policy"), "case_id", "node")
    got = graphs.reached(starts.select(F.concat_ws("|", "policy", "case_id").alias("case_id"), "node"), keyed).groupBy(F.col("case_id").alias("key")).agg(F.count_if(F.col("node").startswith("c")).alias("n_reached"))
    total = e.groupBy("case_id").agg(F.count_distinct("b").alias("n_targets"), F.max(F.col("status") == "P").alias("doubtful"))
    out = starts.withColumn("key", F.concat_ws("|", "policy", "case_id")).join(got, "key", "left").join(total, "case_id", "left").na.fill(0, ["n_targets", "n_reached"])
    full = (F.col("n_targets") > 0) & (F.col("n_targets") == F.col("n_reached"))
    tags = rules.blockers({"switch_unknown": F.coalesce("doubtful", F.lit(False)) & (F.col("policy") != "S2_UNKNOWN_CONDUCTING"), "topology_disconnected": F.col("n_targets") == 0, "transformer_unreachable": F.lit(True)})
    return out.select("policy", "case_id", "n_targets", "n_reached", F.when(full, "FULL").when(F.col("n_reached") > 0, "PARTIAL").otherwise("FAILED").alias("goal"), F.when(~full, F.get(tags, F.lit(0))).alias("primary_reason"))
