"""Queries of the strategy experiment over the driver's tables, each with its SQL, which builds the graph of every scenario whole and walks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import experiments as X
from skein.operators.tables import Tables
from skein.plans.catalogue import _t, query


def _sources(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Customers are nodes of 20 cases, in chains that every third key breaks; urgent orders are switches between a customer and one of those before, every eleventh in the base; every
    fifth goes on to the next switch of its customer instead, every thirteenth names nothing."""
    col = F.col
    c = _t(spark, d, "customer").select((col("c_custkey") % 20).alias("case_id"), col("c_custkey").alias("k"), "c_mktsegment")
    node = lambda k: F.concat(F.lit("n"), k.cast("string"))
    o = _t(spark, d, "orders").where("o_orderpriority = '1-URGENT' and o_custkey >= 20")
    o = o.select((col("o_custkey") % 20).alias("case_id"), col("o_orderkey").alias("key"), node(col("o_custkey")).alias("near"), node(F.expr("o_custkey - 20 * (1 + o_orderkey % (o_custkey div 20))")).alias("far"), F.expr("decode(o_orderstatus, 'F', 'CLOSED', 'O', 'OPEN', 'UNKNOWN')").alias("state"), F.expr("lead(o_orderkey) over (partition by o_custkey order by o_orderkey)").alias("next"))
    # Written once: cases, branches, lines and candidates all read the orders, and only one of them asks for the next.
    o = Tables(spark).save(o.withColumn("baseline", col("key") % 11 == 0))
    inner = lambda key, side: F.concat(F.lit("s"), key.cast("string"), F.lit(side))
    own = col("key").cast("string")
    at = lambda key, side: F.when(key % 11 == 0, inner(key, side))
    named = lambda key: F.when(key % 11 != 0, key.cast("string"))
    none, on = F.lit(None).cast("string"), col("key") % 5 == 0
    line = lambda n, node1, node2, target1, target2: o.select("case_id", F.concat(own, F.lit(n)).alias("line"), node1.alias("node1"), node2.alias("node2"), target1.alias("target1"), target2.alias("target2"))
    first = line(":1", col("near"), at(col("key"), ":in"), none, named(col("key")))
    second = line(":2", at(col("key"), ":out"), F.when(on, at(col("next"), ":in")).when(col("key") % 13 != 0, col("far")), named(col("key")), F.when(on, named(col("next"))))
    third = line(":3", col("near"), col("far"), none, none).where(F.split("line", ":")[0].cast("long") % 97 == 0)
    switches = o.where("baseline").select("case_id", F.lit("switch").alias("kind"), inner(col("key"), ":in").alias("a"), inner(col("key"), ":out").alias("b"), (col("state") == "CLOSED").alias("conducting"))
    chain = c.where("k >= 20 and k % 3 <> 0").select("case_id", F.lit("line").alias("kind"), node(col("k")).alias("a"), node(col("k") - 20).alias("b"), F.lit(True).alias("conducting"))
    candidates = o.select("case_id", own.alias("owner"), "baseline", (col("key") % 3 != 0).alias("inner_exact"), F.expr("decode(key % 7, 0, 'CONFLICTING', 1, 'COMPATIBLE', 'UNKNOWN')").alias("safety"), "state", F.expr("case key % 4 when 0 then true when 1 then null else false end").alias("is_tie"))
    return {
        "cases": o.groupBy("case_id").agg(F.count("*").alias("total_switches")), "heads": c.where("k < 20 and k % 7 <> 3").select("case_id", node(col("k")).alias("node")),
        "targets": c.where("c_mktsegment = 'BUILDING'").select("case_id", node(col("k")).alias("node")), "branches": chain.unionByName(switches),
        "lines": first.unionByName(second).unionByName(third), "made": X.judged(candidates),
    }


_JUDGED = """o AS (SELECT o_custkey % 20 AS case_id, o_orderkey AS key, 'n' || o_custkey AS near, 'n' || (o_custkey - 20 * (1 + o_orderkey % (o_custkey // 20))) AS far, CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'OPEN' ELSE 'UNKNOWN' END AS state, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS next,
  o_orderkey % 11 = 0 AS baseline, CASE o_orderkey % 4 WHEN 0 THEN 'tie' WHEN 1 THEN 'unknown_type' ELSE 'normal' END AS tie_group FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey >= 20),
strategies AS (SELECT unnest(['S0', 'S1', 'S2', 'S3_A', 'S3_B']) AS strategy),
judged AS (SELECT *, CASE WHEN baseline THEN true WHEN strategy = 'S0' OR key % 3 = 0 OR (strategy <> 'S1' AND key % 7 = 0) THEN false ELSE state <> 'UNKNOWN' OR strategy = 'S3_A' END AS projected FROM o, strategies)"""
_COVERED = f"""{_JUDGED}, groups AS (SELECT unnest(['normal', 'tie', 'unknown_type']) AS g), variants AS (SELECT 'all' AS variant UNION ALL SELECT how || ':' || g FROM groups, (SELECT unnest(['only', 'without']) AS how)),
cases AS (SELECT case_id, count(*) AS total FROM o GROUP BY ALL), scenarios AS (SELECT * FROM cases, strategies, variants),
heads AS (SELECT c_custkey % 20 AS case_id, 'n' || c_custkey AS node FROM customer WHERE c_custkey < 20 AND c_custkey % 7 <> 3),
chosen AS (SELECT case_id, strategy, variant, key, state FROM judged, variants WHERE projected AND NOT baseline AND (variant = 'all' OR variant = 'only:' || tie_group OR (variant LIKE 'without:%' AND variant <> 'without:' || tie_group))),
ends AS (SELECT case_id, NULL AS key1, near AS node1, key AS key2, NULL AS node2 FROM o UNION ALL SELECT case_id, key, NULL, CASE WHEN key % 5 = 0 THEN next END, CASE WHEN key % 5 <> 0 AND key % 13 <> 0 THEN far END FROM o UNION ALL SELECT case_id, NULL, near, NULL, far FROM o WHERE key % 97 = 0),
stood AS (SELECT s.case_id, s.strategy, s.variant, 'line' AS kind, CASE WHEN e.key1 IS NULL THEN node1 WHEN c1.key IS NOT NULL OR e.key1 % 11 = 0 THEN 's' || e.key1 || ':out' END AS a, CASE WHEN e.key2 IS NULL THEN node2 WHEN c2.key IS NOT NULL OR e.key2 % 11 = 0 THEN 's' || e.key2 || ':in' END AS b
  FROM scenarios s JOIN ends e USING (case_id) LEFT JOIN chosen c1 ON c1.case_id = s.case_id AND c1.strategy = s.strategy AND c1.variant = s.variant AND c1.key = e.key1 LEFT JOIN chosen c2 ON c2.case_id = s.case_id AND c2.strategy = s.strategy AND c2.variant = s.variant AND c2.key = e.key2),
edges AS (SELECT * FROM stood WHERE a IS NOT NULL AND b IS NOT NULL UNION ALL SELECT case_id, strategy, variant, 'line', 'n' || c_custkey, 'n' || (c_custkey - 20) FROM scenarios JOIN customer ON c_custkey % 20 = case_id WHERE c_custkey >= 20 AND c_custkey % 3 <> 0
  UNION ALL SELECT case_id, strategy, variant, 'switch', 's' || key || ':in', 's' || key || ':out' FROM chosen WHERE state = 'CLOSED' UNION ALL SELECT case_id, strategy, variant, 'switch', 's' || key || ':in', 's' || key || ':out' FROM scenarios JOIN o USING (case_id) WHERE baseline AND state = 'CLOSED'),
ways AS (SELECT case_id, strategy, variant, a, b FROM edges UNION SELECT case_id, strategy, variant, b, a FROM edges),
seen AS (SELECT case_id, strategy, variant, node FROM scenarios JOIN heads USING (case_id) UNION SELECT w.case_id, w.strategy, w.variant, w.b FROM seen s JOIN ways w ON w.case_id = s.case_id AND w.strategy = s.strategy AND w.variant = s.variant AND w.a = s.node),
reached AS (SELECT case_id, strategy, variant, count(*) AS n FROM seen WHERE node IN (SELECT 'n' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY ALL),
usable AS (SELECT DISTINCT case_id, strategy, variant, 1 AS usable FROM edges e SEMI JOIN seen s ON s.case_id = e.case_id AND s.strategy = e.strategy AND s.variant = e.variant AND s.node = e.a WHERE kind = 'line'),
had AS (SELECT case_id, count(*) AS n, count(*) FILTER (WHERE state = 'CLOSED') AS closed FROM o WHERE baseline GROUP BY ALL), more AS (SELECT case_id, strategy, variant, count(*) AS n, count(*) FILTER (WHERE state = 'CLOSED') AS closed FROM chosen GROUP BY ALL),
covered AS (SELECT case_id, strategy, variant, coalesce(had.n, 0) + coalesce(more.n, 0) AS switch_projected_count, coalesce(had.closed, 0) + coalesce(more.closed, 0) AS switch_conducting_count, total - coalesce(had.n, 0) - coalesce(more.n, 0) AS switch_excluded_count,
  CASE WHEN heads.node IS NULL THEN 0 ELSE 1 END AS cases_with_feeder_head, coalesce(usable, 0) AS cases_with_usable_subgraph, coalesce(reached.n, 0) AS reachable_transformers, CASE WHEN reached.n > 0 THEN 1 ELSE 0 END AS cases_with_reachable_transformers
  FROM scenarios LEFT JOIN had USING (case_id) LEFT JOIN more USING (case_id, strategy, variant) LEFT JOIN heads USING (case_id) LEFT JOIN usable USING (case_id, strategy, variant) LEFT JOIN reached USING (case_id, strategy, variant))"""


@query(f"WITH RECURSIVE {_COVERED} SELECT case_id, strategy, variant, switch_projected_count, switch_conducting_count, switch_excluded_count, cases_with_feeder_head::BIGINT AS cases_with_feeder_head, cases_with_usable_subgraph::BIGINT AS cases_with_usable_subgraph, reachable_transformers, cases_with_reachable_transformers::BIGINT AS cases_with_reachable_transformers FROM covered")
def q94_strategy_coverage(spark, d):
    return X.coverage(**_sources(spark, d))


def _impact_sql() -> str:
    of = lambda strategy, variant, name: f"sum({name}) FILTER (WHERE strategy = {strategy} AND variant = {variant})"
    gain = ", ".join(f"({of('p.strategy', chr(39) + 'only:' + chr(39) + ' || g', n)} - {of(chr(39) + 'S0' + chr(39), chr(39) + 'all' + chr(39), n)})::BIGINT AS gain_{n}" for n in X.IMPACTS)
    loss = ", ".join(f"({of('p.strategy', chr(39) + 'all' + chr(39), n)} - {of('p.strategy', chr(39) + 'without:' + chr(39) + ' || g', n)})::BIGINT AS loss_{n}" for n in X.IMPACTS)
    return f"WITH RECURSIVE {_COVERED} SELECT p.strategy, g AS tie_group, {gain}, {loss} FROM covered c, strategies p, groups GROUP BY p.strategy, g".replace("WHERE strategy =", "WHERE c.strategy =")


@query(_impact_sql())
def q95_tie_group_impact(spark, d):
    return X.group_impact(X.coverage(**_sources(spark, d)))


@query(f"""WITH {_JUDGED}, every AS (SELECT * FROM (SELECT DISTINCT case_id FROM o), strategies, (SELECT unnest(['normal', 'tie', 'unknown_type']) AS tie_group), (SELECT unnest(['CLOSED', 'OPEN', 'UNKNOWN']) AS state))
SELECT e.case_id, e.strategy, e.tie_group, e.state, count(j.key) AS candidate_count, count(*) FILTER (WHERE projected) AS projected_count, count(*) FILTER (WHERE projected AND j.state = 'CLOSED') AS conducting_count
FROM every e LEFT JOIN judged j ON j.case_id = e.case_id AND j.strategy = e.strategy AND j.tie_group = e.tie_group AND j.state = e.state GROUP BY ALL""")
def q96_tie_group_states(spark, d):
    s = _sources(spark, d)
    return X.group_states(s["made"], s["cases"])
