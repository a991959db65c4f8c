"""The catalogue of queries over the driver's tables, each with its SQL.

A case is a nation; its nodes are suppliers (s...) and customers (c...), its branches the line items between the two, which
conduct when the order's status is F; a reference crosses cases where supplier and customer differ in nation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import columns as C
from skein.operators import graphs, identity, references

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


ITEM_FIELDS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def traffic(spark: SparkSession, d: str) -> DataFrame:
    """Line items with both ends and both cases.  Orders meet their customers first, so line items, by far the most, are not dealt by customer."""
    item = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    order = _t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    customer = _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    supplier = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return item.join(order.join(customer, "o_custkey"), "l_orderkey").join(supplier, "l_suppkey")


def edges(spark: SparkSession, d: str) -> DataFrame:
    """case_id, edge_id, a (supplier), b (customer), status."""
    t = traffic(spark, d).where("c_nationkey = s_nationkey")
    name = F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return t.select(F.col("c_nationkey").alias("case_id"), name.alias("edge_id"), F.concat(F.lit("s"), "l_suppkey").alias("a"), F.concat(F.lit("c"), "o_custkey").alias("b"), F.col("o_orderstatus").alias("status"))


def heads(spark: SparkSession, d: str) -> DataFrame:
    s = _t(spark, d, "supplier")
    return s.groupBy(F.col("s_nationkey").alias("case_id")).agg(F.min(F.concat(F.lit("s"), "s_suppkey")).alias("node"))


_TRAFFIC = """traffic AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""
_EDGES = _TRAFFIC + """, edges AS (SELECT c_nationkey AS case_id, concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS edge_id, 's' || l_suppkey AS a, 'c' || o_custkey AS b, o_orderstatus AS status FROM traffic WHERE c_nationkey = s_nationkey)"""
_BOTH = """both_ways AS (SELECT DISTINCT case_id, a, b FROM (SELECT case_id, a, b FROM {0} UNION ALL SELECT case_id, b, a FROM {0}))"""
_HEADS = """heads AS (SELECT s_nationkey AS case_id, min('s' || s_suppkey) AS node FROM supplier GROUP BY ALL)"""
_LIVE = """live AS (SELECT * FROM edges WHERE status = 'F')"""
_REACHED = """reached AS (SELECT case_id, node FROM heads UNION SELECT r.case_id, e.b FROM reached r JOIN both_ways e ON e.case_id = r.case_id AND e.a = r.node)"""
_WALK = """walk AS (SELECT case_id, a AS root, a AS node FROM both_ways UNION SELECT w.case_id, w.root, e.b FROM walk w JOIN both_ways e ON e.case_id = w.case_id AND e.a = w.node)"""
_STATUS = "CASE WHEN n_rows = 1 THEN 'UNIQUE' WHEN n_variants = 1 THEN 'DUPLICATE_IDENTICAL' ELSE 'DUPLICATE_CONFLICT' END"
_GROUPS = f"""groups AS (SELECT *, {_STATUS} AS identity_status FROM (SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(DISTINCT (l_partkey, l_suppkey, l_quantity, l_extendedprice)) AS n_variants FROM lineitem GROUP BY ALL))"""


@query(f"WITH {_GROUPS} SELECT l_orderkey, l_linenumber, n_rows, n_variants, identity_status FROM groups")
def q01_identity_classification(spark, d):
    return identity.classify_groups(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ITEM_FIELDS)


@query(f"WITH {_GROUPS} SELECT identity_status, count(*) AS n_groups, sum(n_rows)::BIGINT AS n_rows, max(n_variants) AS most_variants FROM groups GROUP BY ALL")
def q02_identity_conflicts(spark, d):
    groups = identity.classify_groups(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ITEM_FIELDS)
    return groups.groupBy("identity_status").agg(F.count("*").alias("n_groups"), F.sum("n_rows").alias("n_rows"), F.max("n_variants").alias("most_variants"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1")
def q03_representative_row(spark, d):
    return identity.representatives(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"], ["l_partkey", "l_suppkey"])


@query("SELECT sha256(text) AS text_id, count(*) AS n_rows, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1")
def q04_duplicate_documents(spark, d):
    return _t(spark, d, "documents").groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("text_id")).agg(F.count("*").alias("n_rows"), F.min("doc_id").alias("first_doc")).where("n_rows > 1")


@query(f"""WITH {_GROUPS} SELECT category, count(*) AS n_rows FROM (SELECT CASE WHEN l_quantity <= 0 OR l_discount > 0.09 THEN 'REJECTED'
  WHEN identity_status <> 'UNIQUE' THEN 'DUPLICATE' WHEN s_suppkey IS NULL THEN 'UNRESOLVED' ELSE 'MAPPED' END AS category
  FROM lineitem JOIN groups USING (l_orderkey, l_linenumber) LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) ON l_suppkey = s_suppkey) GROUP BY ALL""")
def q05_row_accounting(spark, d):
    rows = identity.stamp(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ITEM_FIELDS)
    owner = _t(spark, d, "supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").alias("l_suppkey"), F.lit(True).alias("resolved"))
    gates = ((F.col("l_quantity") <= 0) | (F.col("l_discount") > 0.09), "REJECTED"), (F.col("identity_status") != "UNIQUE", "DUPLICATE"), (F.col("resolved").isNull(), "UNRESOLVED")
    return rows.join(owner, "l_suppkey", "left").select(C.first_reason(*gates, default="MAPPED").alias("category")).groupBy("category").agg(F.count("*").alias("n_rows"))


@query("SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'UNRESOLVED' ELSE 'EXACT' END AS status FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey")
def q06_reference_resolution(spark, d):
    requests = _t(spark, d, "orders").select("o_orderkey", F.lit(0).alias("case_id"), F.col("o_custkey").cast("string").alias("ref"))
    candidates = _t(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.lit(0).alias("case_id"), F.col("c_custkey").cast("string").alias("ref"), F.lit("CUSTOMER").alias("entity_type"), F.lit("UNIQUE").alias("identity_status"))
    return references.resolve(requests, candidates, ["case_id"]).select("o_orderkey", "status")


@query("""WITH c AS (SELECT p_partkey AS k, 'PART' AS t FROM part UNION ALL SELECT s_suppkey, 'SUPPLIER' FROM supplier UNION ALL SELECT c_custkey, 'CUSTOMER' FROM customer),
  g AS (SELECT k, count(*) AS n, min(t) AS t FROM c GROUP BY k)
SELECT o_orderkey, CASE WHEN n IS NULL THEN 'UNRESOLVED' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'EXACT' END AS status, coalesce(n, 0) AS n_candidates, CASE WHEN n = 1 THEN t END AS entity_type FROM orders LEFT JOIN g ON k = o_orderkey""")
def q07_multi_type_resolution(spark, d):
    ids = None
    for name, key in (("part", "p_partkey"), ("supplier", "s_suppkey"), ("customer", "c_custkey")):
        one = _t(spark, d, name).select(F.lit(0).alias("case_id"), F.col(key).cast("string").alias("ref"), F.lit(name.upper()).alias("entity_type"), F.lit("UNIQUE").alias("identity_status"))
        ids = one if ids is None else ids.unionByName(one)
    requests = _t(spark, d, "orders").select("o_orderkey", F.lit(0).alias("case_id"), F.col("o_orderkey").cast("string").alias("ref"))
    return references.resolve(requests, ids, ["case_id"]).select("o_orderkey", "status", F.col("n_candidates").cast("long").alias("n_candidates"), "entity_type")


_SEVERITY = [("DISCOUNT_HIGH", "WARNING"), ("QUANTITY_LOW", "INFO"), ("TAX_ZERO", "ERROR")]


@query("""SELECT code, severity, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN l_discount > 0.08 THEN 'DISCOUNT_HIGH' END, CASE WHEN l_quantity < 2 THEN 'QUANTITY_LOW' END, CASE WHEN l_tax = 0 THEN 'TAX_ZERO' END], lambda x: x IS NOT NULL)) AS code FROM lineitem)
  JOIN (VALUES ('DISCOUNT_HIGH', 'WARNING'), ('QUANTITY_LOW', 'INFO'), ('TAX_ZERO', 'ERROR')) AS s(code, severity) USING (code) GROUP BY ALL""")
def q08_quality_issues(spark, d):
    gates = C.all_reasons((F.col("l_discount") > 0.08, "DISCOUNT_HIGH"), (F.col("l_quantity") < 2, "QUANTITY_LOW"), (F.col("l_tax") == 0, "TAX_ZERO"))
    severity = spark.createDataFrame(_SEVERITY, "code string, severity string")
    issues = _t(spark, d, "lineitem").select(F.explode(gates).alias("code")).groupBy("code").agg(F.count("*").alias("n"))
    return issues.join(severity, "code").select("code", "severity", "n")


@query("""SELECT event_id, k AS n_value, CASE WHEN raw IS NOT NULL AND k IS NULL THEN 'NOT_A_POSITIVE_INTEGER' END AS issue FROM (SELECT event_id, json_extract_string(props, '$.k') AS raw, CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) > 0 THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events)""")
def q09_typed_conversion(spark, d):
    value, wrong = C.positive_integer(F.get_json_object("props", "$.k"))
    return _t(spark, d, "events").select("event_id", value.alias("n_value"), wrong.alias("issue"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, metric, value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME metric VALUE value)")
def q10_unpivot(spark, d):
    return _t(spark, d, "lineitem").unpivot(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], ["l_quantity", "l_discount", "l_tax"], "metric", "value")


@query("""WITH one AS (SELECT c_nationkey, c_mktsegment, CASE WHEN count(DISTINCT c_acctbal) = 1 THEN min(c_acctbal) END AS v, count(*) AS n FROM customer GROUP BY ALL)
SELECT c_nationkey, max(v) FILTER (WHERE c_mktsegment = 'BUILDING') AS building, max(n) FILTER (WHERE c_mktsegment = 'BUILDING') AS n_building, max(v) FILTER (WHERE c_mktsegment = 'MACHINERY') AS machinery, max(n) FILTER (WHERE c_mktsegment = 'MACHINERY') AS n_machinery FROM one GROUP BY ALL""")
def q11_pivot_settings(spark, d):
    one = _t(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(identity.single_or_null("c_acctbal").alias("v"), F.count("*").alias("n"))
    pick = lambda c, s: F.max(F.when(F.col("c_mktsegment") == s, F.col(c)))
    return one.groupBy("c_nationkey").agg(pick("v", "BUILDING").alias("building"), pick("n", "BUILDING").alias("n_building"), pick("v", "MACHINERY").alias("machinery"), pick("n", "MACHINERY").alias("n_machinery"))


@query("SELECT o_custkey, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN min(o_orderstatus) END AS only_status FROM orders GROUP BY ALL")
def q12_single_or_null(spark, d):
    return _t(spark, d, "orders").groupBy("o_custkey").agg(identity.single_or_null("o_orderstatus").alias("only_status"))


@query("""SELECT s_suppkey, 'supplier:' || sha256('["v1","' || s_nationkey || '","' || s_suppkey || '"]') AS entity_id FROM supplier""")
def q13_content_identity(spark, d):
    return _t(spark, d, "supplier").select("s_suppkey", C.content_id("supplier", F.lit("v1"), F.col("s_nationkey"), F.col("s_suppkey")).alias("entity_id"))


def _degrees(spark, d):
    e = edges(spark, d)
    ends = e.select("case_id", F.col("a").alias("node"), "edge_id", F.lit(1).alias("side")).union(e.select("case_id", "b", "edge_id", F.lit(2)))
    return ends.groupBy("case_id", "node").agg(F.count_distinct("edge_id").alias("degree"), F.sum(F.when(F.col("side") == 1, 1).otherwise(0)).alias("n_out"))


_DEGREES = "degrees AS (SELECT case_id, node, count(DISTINCT edge_id) AS degree, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS n_out FROM (SELECT case_id, a AS node, edge_id, 1 AS side FROM edges UNION ALL SELECT case_id, b, edge_id, 2 FROM edges) GROUP BY ALL)"


@query(f"WITH {_EDGES}, {_DEGREES} SELECT case_id, CASE WHEN degree > 3 THEN 'GT3' ELSE degree::VARCHAR END AS bucket, count(*) AS n_nodes FROM degrees GROUP BY ALL")
def q14_incidence_degree(spark, d):
    bucket = F.when(F.col("degree") > 3, "GT3").otherwise(F.col("degree").cast("string"))
    return _degrees(spark, d).groupBy("case_id", bucket.alias("bucket")).agg(F.count("*").alias("n_nodes"))


@query(f"WITH {_EDGES}, {_DEGREES} SELECT case_id, CASE n_out WHEN 0 THEN 'IN_IN' WHEN 1 THEN 'IN_OUT' ELSE 'OUT_OUT' END AS direction, count(*) AS n_nodes FROM degrees WHERE degree = 2 GROUP BY ALL")
def q15_direction_classes(spark, d):
    direction = F.when(F.col("n_out") == 0, "IN_IN").when(F.col("n_out") == 1, "IN_OUT").otherwise("OUT_OUT")
    return _degrees(spark, d).where("degree = 2").groupBy("case_id", direction.alias("direction")).agg(F.count("*").alias("n_nodes"))


@query("""WITH o AS (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'A') AS n_in, count(*) FILTER (WHERE l_returnflag = 'R') AS n_out, min(l_suppkey) FILTER (WHERE l_returnflag = 'A') AS x, min(l_suppkey) FILTER (WHERE l_returnflag = 'R') AS y FROM lineitem GROUP BY ALL)
SELECT l_orderkey, x, y, CASE WHEN x = y THEN 'SAME' ELSE 'DIFFERENT' END AS motif FROM o WHERE n_in = 1 AND n_out = 1""")
def q16_wedge_candidates(spark, d):
    flag = F.col("l_returnflag")
    o = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_if(flag == "A").alias("n_in"), F.count_if(flag == "R").alias("n_out"), F.min(F.when(flag == "A", F.col("l_suppkey"))).alias("x"), F.min(F.when(flag == "R", F.col("l_suppkey"))).alias("y"))
    return o.where("n_in = 1 and n_out = 1").select("l_orderkey", "x", "y", F.when(F.col("x") == F.col("y"), "SAME").otherwise("DIFFERENT").alias("motif"))


@query("SELECT c_custkey, c_nationkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def q21_unpublished_identities(spark, d):
    return _t(spark, d, "customer").select("c_custkey", "c_nationkey").join(_t(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query(f"WITH RECURSIVE {_EDGES}, {_LIVE}, {_BOTH.format('live')}, {_HEADS}, {_REACHED} SELECT case_id, node FROM reached")
def q22_conducting_reachability(spark, d):
    return graphs.reached(heads(spark, d), edges(spark, d).where("status = 'F'"))


@query(f"""WITH RECURSIVE {_EDGES}, {_LIVE}, {_BOTH.format('live')}, {_HEADS}, hop AS (SELECT case_id, node, 0 AS hops FROM heads UNION SELECT h.case_id, e.b, hops + 1 FROM hop h JOIN both_ways e ON e.case_id = h.case_id AND e.a = h.node WHERE hops < 30)
SELECT case_id, node, min(hops) AS hops FROM hop GROUP BY ALL""")
def q23_reachability_hops(spark, d):
    return graphs.reach(heads(spark, d), edges(spark, d).where("status = 'F'"))


@query(f"WITH RECURSIVE {_EDGES}, {_LIVE}, {_BOTH.format('live')}, {_WALK} SELECT case_id, node, min(root) AS component FROM walk GROUP BY ALL")
def q24_connected_components(spark, d):
    return graphs.components(edges(spark, d).where("status = 'F'"))


@query(f"""WITH RECURSIVE {_EDGES}, {_BOTH.format('edges')}, {_WALK}, c AS (SELECT case_id, node, min(root) AS component FROM walk GROUP BY ALL)
SELECT case_id, n_nodes, n_components, n_edges, n_edges - n_nodes + n_components AS cycle_rank FROM (SELECT case_id, count(*) AS n_nodes, count(DISTINCT component) AS n_components FROM c GROUP BY ALL) JOIN (SELECT case_id, count(*) AS n_edges FROM edges GROUP BY ALL) USING (case_id)""")
def q25_cycle_rank(spark, d):
    return graphs.cycle_rank(edges(spark, d))


@query(f"""WITH {_EDGES}, p AS (SELECT case_id, least(a, b) AS x, greatest(a, b) AS y, count(*) AS n FROM edges GROUP BY ALL), g AS (SELECT case_id, node, count(*) AS d FROM (SELECT case_id, a AS node FROM edges UNION ALL SELECT case_id, b FROM edges) GROUP BY ALL)
SELECT case_id, n_edges, n_loops, parallel_excess, max_degree FROM (SELECT case_id, sum(n)::BIGINT AS n_edges, sum(CASE WHEN x = y THEN n ELSE 0 END)::BIGINT AS n_loops, sum(n - 1)::BIGINT AS parallel_excess FROM p GROUP BY ALL) JOIN (SELECT case_id, max(d) AS max_degree FROM g GROUP BY ALL) USING (case_id)""")
def q26_graph_profile(spark, d):
    return graphs.profile(edges(spark, d))


def coverage(spark: SparkSession, d: str) -> DataFrame:
    """Reached customers among those with a branch, for each case and policy (F alone, F and O, all)."""
    e = edges(spark, d)
    policies = spark.createDataFrame([("S0", "F"), ("S1", "F"), ("S1", "O"), ("S2", "F"), ("S2", "O"), ("S2", "P")], "policy string, status string")
    keyed = e.join(F.broadcast(policies), "status").select(F.concat_ws("|", "policy", "case_id").alias("case_id"), "a", "b")
    names = policies.select("policy").distinct()
    starts = heads(spark, d).join(F.broadcast(names)).select(F.concat_ws("|", "policy", "case_id").alias("case_id"), "node")
    got = graphs.reached(starts, keyed).where("node like 'c%'").groupBy("case_id").agg(F.count("*").alias("n_reached"))
    targets = e.groupBy("case_id").agg(F.count_distinct("b").alias("n_targets"))
    every = heads(spark, d).select("case_id").join(F.broadcast(names)).join(targets, "case_id", "left").withColumn("key", F.concat_ws("|", "policy", "case_id"))
    out = every.join(got.withColumnRenamed("case_id", "key"), "key", "left").select("case_id", "policy", F.coalesce("n_targets", F.lit(0)).alias("n_targets"), F.coalesce("n_reached", F.lit(0)).alias("n_reached"))
    gates = (F.col("n_targets") == 0, "NO_SOURCE_TARGET"), (F.col("n_reached") == F.col("n_targets"), "FULL"), (F.col("n_reached") > 0, "PARTIAL")
    return out.withColumn("status", C.first_reason(*gates, default="FAILED"))


_COVERAGE = f"""{_EDGES}, policies AS (SELECT * FROM (VALUES ('S0', 'F'), ('S1', 'F'), ('S1', 'O'), ('S2', 'F'), ('S2', 'O'), ('S2', 'P')) AS v(policy, status)), {_HEADS},
pe AS (SELECT policy, case_id, a, b FROM edges JOIN policies USING (status) UNION SELECT policy, case_id, b, a FROM edges JOIN policies USING (status)), names AS (SELECT DISTINCT policy FROM policies),
r AS (SELECT policy, case_id, node FROM heads, names UNION SELECT r.policy, r.case_id, pe.b FROM r JOIN pe ON pe.policy = r.policy AND pe.case_id = r.case_id AND pe.a = r.node),
got AS (SELECT policy, case_id, count(*) AS n FROM r WHERE node LIKE 'c%' GROUP BY ALL), targets AS (SELECT case_id, count(DISTINCT b) AS n FROM edges GROUP BY ALL),
coverage AS (SELECT case_id, policy, n_targets, n_reached, CASE WHEN n_targets = 0 THEN 'NO_SOURCE_TARGET' WHEN n_reached = n_targets THEN 'FULL' WHEN n_reached > 0 THEN 'PARTIAL' ELSE 'FAILED' END AS status
  FROM (SELECT h.case_id, names.policy, coalesce(targets.n, 0) AS n_targets, coalesce(got.n, 0) AS n_reached FROM heads h CROSS JOIN names LEFT JOIN targets USING (case_id) LEFT JOIN got ON got.case_id = h.case_id AND got.policy = names.policy))"""


@query(f"WITH RECURSIVE {_COVERAGE} SELECT * FROM coverage")
def q31_coverage_status(spark, d):
    return coverage(spark, d)


@query(f"WITH RECURSIVE {_COVERAGE} SELECT b.status AS before, t.status AS after, count(*) AS n_cases FROM coverage b JOIN coverage t USING (case_id) WHERE b.policy = 'S0' AND t.policy = 'S2' GROUP BY ALL")
def q32_coverage_transitions(spark, d):
    c = graphs._cut(coverage(spark, d))
    before = c.where("policy = 'S0'").select("case_id", F.col("status").alias("before"))
    return before.join(c.where("policy = 'S2'").select("case_id", F.col("status").alias("after")), "case_id").groupBy("before", "after").agg(F.count("*").alias("n_cases"))


@query("""WITH o AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open FROM orders GROUP BY ALL)
SELECT c_custkey, array_to_string(list_sort(list_filter([CASE WHEN c_acctbal < 0 THEN 'NEGATIVE_BALANCE' END, CASE WHEN n IS NULL THEN 'NO_ORDER' END, CASE WHEN n_open > 5 THEN 'MANY_OPEN' END], lambda x: x IS NOT NULL)), ',') AS prohibitions,
  CASE WHEN n IS NULL THEN 'INSUFFICIENT' WHEN c_acctbal < 0 THEN 'BLOCKED' WHEN n_open > 5 THEN 'REVIEW' ELSE 'ELIGIBLE' END AS cohort FROM customer LEFT JOIN o ON o_custkey = c_custkey""")
def q35_eligibility_rules(spark, d):
    o = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "O").alias("n_open"))
    none, negative, many = F.col("n").isNull(), F.col("c_acctbal") < 0, F.col("n_open") > 5
    rules = C.all_reasons((negative, "NEGATIVE_BALANCE"), (none, "NO_ORDER"), (many, "MANY_OPEN"))
    cohort = C.first_reason((none, "INSUFFICIENT"), (negative, "BLOCKED"), (many, "REVIEW"), default="ELIGIBLE")
    return _t(spark, d, "customer").join(o, "c_custkey", "left").select("c_custkey", F.array_join(rules, ",").alias("prohibitions"), cohort.alias("cohort"))


@query("SELECT l_partkey, CASE array_to_string(list_sort(list(DISTINCT l_returnflag)), '') WHEN 'A' THEN 'A_ONLY' WHEN 'R' THEN 'R_ONLY' WHEN 'N' THEN 'N_ONLY' WHEN 'AR' THEN 'A_AND_R' ELSE 'OTHER' END AS composition FROM lineitem GROUP BY ALL")
def q36_reference_composition(spark, d):
    kinds = F.array_join(F.array_sort(F.collect_set("l_returnflag")), "")
    named = F.when(kinds == "A", "A_ONLY").when(kinds == "R", "R_ONLY").when(kinds == "N", "N_ONLY").when(kinds == "AR", "A_AND_R").otherwise("OTHER")
    return _t(spark, d, "lineitem").groupBy("l_partkey").agg(named.alias("composition"))


@query(f"WITH {_EDGES} SELECT e.case_id, edge_id, a, b, status, n > 1 AS withdrawn FROM edges e JOIN (SELECT case_id, least(a, b) AS x, greatest(a, b) AS y, count(*) AS n FROM edges GROUP BY ALL) p ON p.case_id = e.case_id AND x = least(a, b) AND y = greatest(a, b)")
def q37_parallel_withdrawal(spark, d):
    return graphs.parallel_withdrawal(edges(spark, d))


_CROSS = """entity AS (SELECT s_nationkey AS case_id, (s_suppkey % 40)::VARCHAR AS ref FROM supplier), refs AS (SELECT o_orderkey AS reference_id, c_nationkey AS case_id, (o_orderkey % 60)::VARCHAR AS ref FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query(f"""WITH {_CROSS} SELECT reference_id, case_id, ref, n_local, n_foreign, CASE WHEN n_foreign = 1 THEN 'UNIQUE_EXTERNAL' WHEN n_foreign > 1 THEN 'MULTIPLE_EXTERNAL' WHEN n_local > 0 THEN 'LOCAL_UNRESOLVED_ONLY' ELSE 'UNDEFINED_GLOBAL' END AS classification
FROM (SELECT reference_id, r.case_id, r.ref, count(*) FILTER (WHERE e.case_id = r.case_id) AS n_local, count(*) FILTER (WHERE e.case_id <> r.case_id) AS n_foreign FROM refs r LEFT JOIN entity e USING (ref) GROUP BY ALL)""")
def q40_cross_case_classification(spark, d):
    entities = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("case_id"), (F.col("s_suppkey") % 40).cast("string").alias("ref"))
    customer = _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("case_id"))
    refs = _t(spark, d, "orders").join(customer, "o_custkey").select(F.col("o_orderkey").alias("reference_id"), "case_id", (F.col("o_orderkey") % 60).cast("string").alias("ref"))
    return references.across_cases(refs, entities)


def _foreign(spark, d):
    t = traffic(spark, d).where("c_nationkey <> s_nationkey")
    return t.select(F.col("c_nationkey").alias("source"), F.col("s_nationkey").alias("target"), F.concat(F.lit("s"), "l_suppkey").alias("ref"))


@query(f"""WITH {_TRAFFIC}, g AS (SELECT c_nationkey AS source, s_nationkey AS target, count(*) AS n_references, count(DISTINCT l_suppkey) AS n_distinct, array_to_string(list_sort(list(DISTINCT 's' || l_suppkey))[1:5], ',') AS witnesses FROM traffic WHERE c_nationkey <> s_nationkey GROUP BY ALL)
SELECT *, EXISTS (SELECT 1 FROM g h WHERE h.source = g.target AND h.target = g.source) AS reciprocal FROM g""")
def q41_case_edge_graph(spark, d):
    return references.case_edges(_foreign(spark, d)).withColumn("witnesses", F.array_join("witnesses", ","))


_STRICT = f"""{_TRAFFIC}, h AS (SELECT c_nationkey AS source, s_nationkey AS target, count(*) AS n FROM traffic WHERE c_nationkey <> s_nationkey GROUP BY ALL), t AS (SELECT source, sum(n) AS total, count(*) AS targets FROM h GROUP BY ALL), g AS (SELECT source, target FROM h JOIN t USING (source) WHERE 10 * n * targets >= 13 * total),
mutual AS (SELECT source, target FROM g WHERE source < target AND (target, source) IN (SELECT (source, target) FROM g))"""


def _mutual(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of cases each of which has 1.3 times its mean number of references to the other."""
    n = _foreign(spark, d).groupBy("source", "target").agg(F.count("*").alias("n"))
    total = n.groupBy("source").agg(F.sum("n").alias("total"), F.count("*").alias("targets"))
    return graphs.mutual(n.join(total, "source").where("10 * n * targets >= 13 * total"))


@query(f"WITH {_STRICT} SELECT source, target FROM mutual")
def q42_mutual_pairs(spark, d):
    return _mutual(spark, d)


@query(f"""WITH RECURSIVE {_STRICT}, ways AS (SELECT source AS a, target AS b FROM mutual UNION SELECT target, source FROM mutual), walk AS (SELECT a AS root, a AS node FROM ways UNION SELECT root, b FROM walk JOIN ways ON a = node)
SELECT node AS nation, min(root) AS cluster FROM walk GROUP BY ALL""")
def q42b_partition_clusters(spark, d):
    pairs = _mutual(spark, d).select(F.lit(0).alias("case_id"), F.col("source").alias("a"), F.col("target").alias("b"))
    return graphs.components(pairs).select(F.col("node").alias("nation"), F.col("component").alias("cluster"))


@query("SELECT l_partkey, l_suppkey, min(l_orderkey) AS first_ref, array_to_string(list_sort(list(DISTINCT l_orderkey)), ',') AS record_ids FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def q44_append_plan(spark, d):
    g = _t(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.min("l_orderkey").alias("first_ref"), F.array_join(F.array_sort(F.collect_set("l_orderkey")), ",").alias("record_ids"), F.count("*").alias("n"))
    return g.where("n > 1").drop("n")


@query("""SELECT c_nationkey AS case_id, o_orderstatus AS status, CASE WHEN o_totalprice > 200000 THEN 'T1' WHEN o_totalprice > 50000 THEN 'T2' END AS tier, count(*) AS n_records FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def q46_ledger_summary(spark, d):
    customer = _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("case_id"))
    tier = F.when(F.col("o_totalprice") > 200000, "T1").when(F.col("o_totalprice") > 50000, "T2")
    return _t(spark, d, "orders").join(customer, "o_custkey").groupBy("case_id", F.col("o_orderstatus").alias("status"), tier.alias("tier")).agg(F.count("*").alias("n_records"))


@query("SELECT c_nationkey AS case_id, count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL ORDER BY n_orders DESC, case_id LIMIT 5")
def q47_top5_cases(spark, d):
    customer = _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("case_id"))
    return _t(spark, d, "orders").join(customer, "o_custkey").groupBy("case_id").agg(F.count("*").alias("n_orders")).orderBy(F.desc("n_orders"), "case_id").limit(5)


@query("SELECT o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) <= 3")
def q48_first3_examples(spark, d):
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("o_orderpriority").orderBy("o_orderkey"))
    return _t(spark, d, "orders").select("o_orderpriority", "o_orderkey", place.alias("place")).where("place <= 3").drop("place")


@query("SELECT l_returnflag, n, n_orders, (round_even(100.0::DECIMAL(38,10) * n / t, 6))::DOUBLE AS percentage FROM (SELECT l_returnflag, count(*) AS n, count(DISTINCT l_orderkey) AS n_orders, (SELECT count(*) FROM lineitem) AS t FROM lineitem GROUP BY ALL)")
def q49_distribution(spark, d):
    item = _t(spark, d, "lineitem")
    total = item.agg(F.count("*").alias("t"))
    g = item.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_distinct("l_orderkey").alias("n_orders"))
    return g.join(F.broadcast(total)).select("l_returnflag", "n", "n_orders", F.bround(F.lit(100.0) * F.col("n") / F.col("t"), 6).alias("percentage"))


@query("""WITH g AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL) SELECT l_suppkey, max(n) AS most, array_to_string(list_sort(list(l_returnflag) FILTER (WHERE n = m)), ',') AS modes, (sum(n) - max(n))::BIGINT AS minority FROM (SELECT *, max(n) OVER (PARTITION BY l_suppkey) AS m FROM g) GROUP BY l_suppkey""")
def q50_motif_dominance(spark, d):
    g = _t(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"))
    return g.groupBy("l_suppkey").agg(F.max("n").alias("most"), F.array_sort(F.collect_list(F.struct("n", "l_returnflag"))).alias("all"), F.sum("n").alias("total")).select("l_suppkey", "most", F.expr("array_join(transform(filter(all, x -> x.n = most), x -> x.l_returnflag), ',')").alias("modes"), (F.col("total") - F.col("most")).alias("minority"))


@query(f"""WITH {_GROUPS} SELECT violation, count(*) AS n FROM (SELECT 'DUPLICATE_ID' AS violation FROM groups WHERE n_rows > 1 UNION ALL SELECT 'DANGLING_ORDER' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') UNION ALL SELECT 'DANGLING_SUPPLIER' FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)) GROUP BY ALL""")
def q51_integrity_violations(spark, d):
    item = _t(spark, d, "lineitem")
    double = identity.classify_groups(item, ["l_orderkey", "l_linenumber"], ITEM_FIELDS).where("n_rows > 1").select(F.lit("DUPLICATE_ID").alias("violation"))
    orders = _t(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    suppliers = _t(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    one = item.join(orders, "l_orderkey", "left_anti").select(F.lit("DANGLING_ORDER").alias("violation"))
    two = item.join(suppliers, "l_suppkey", "left_anti").select(F.lit("DANGLING_SUPPLIER").alias("violation"))
    return double.unionByName(one).unionByName(two).groupBy("violation").agg(F.count("*").alias("n"))


@query("SELECT key, side FROM (SELECT c_custkey AS key, 'MISSING' AS side FROM customer WHERE c_acctbal < 5000 EXCEPT SELECT o_custkey, 'MISSING' FROM orders) UNION ALL SELECT key, side FROM (SELECT DISTINCT o_custkey AS key, 'EXTRA' AS side FROM orders EXCEPT SELECT c_custkey, 'EXTRA' FROM customer WHERE c_acctbal < 5000)")
def q52_inventory_difference(spark, d):
    expected = _t(spark, d, "customer").where("c_acctbal < 5000").select(F.col("c_custkey").alias("key"))
    return identity.difference(expected, _t(spark, d, "orders").select(F.col("o_custkey").alias("key")).distinct())


@query("""WITH e AS (SELECT l_partkey AS key, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL), o AS (SELECT l_partkey AS key, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
SELECT key, CASE WHEN coalesce(e.n, 0) > coalesce(o.n, 0) THEN 'MISSING' ELSE 'EXTRA' END AS side, abs(coalesce(e.n, 0) - coalesce(o.n, 0)) AS n FROM e FULL JOIN o USING (key) WHERE coalesce(e.n, 0) <> coalesce(o.n, 0)""")
def q52b_multiset_difference(spark, d):
    keys = lambda flag: _t(spark, d, "lineitem").where(F.col("l_returnflag") == flag).select(F.col("l_partkey").alias("key"))
    return identity.difference(keys("A"), keys("R")).groupBy("key", "side").agg(F.count("*").alias("n"))


@query(f"""WITH RECURSIVE {_EDGES}, {_LIVE}, {_BOTH.format('live')}, {_HEADS}, hop AS (SELECT case_id, node, 0 AS hops FROM heads UNION SELECT h.case_id, e.b, hops + 1 FROM hop h JOIN both_ways e ON e.case_id = h.case_id AND e.a = h.node WHERE hops < 3)
SELECT case_id, node, min(hops) AS hops, min(hops) > 2 AS depth_exceeded FROM hop GROUP BY ALL""")
def q53_bounded_closure(spark, d):
    return graphs.reach(heads(spark, d), edges(spark, d).where("status = 'F'"), most=3).withColumn("depth_exceeded", F.col("hops") > 2)


def entry(spark: SparkSession, d: str) -> DataFrame:
    """Coverage of each case over uniquely identified branches."""
    return coverage(spark, d)
