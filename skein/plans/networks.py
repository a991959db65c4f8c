"""Queries of forests, bridges, risks, overlays, gates, incidence and closures over the driver's tables, each with its SQL.

The SQL searches plainly: a walk for each blocked edge, edges taken one after another for the forest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import decisions, forests, graphs, overlays, recovery, references, scans, topology
from skein.plans import catalogue as K
from skein.plans.catalogue import _BOTH, _EDGES, _HEADS, _LIVE, _t, query

# ---------------------------------------------------------------- bridges and forests


@query(f"""WITH RECURSIVE {_EDGES}, {_LIVE}, {_HEADS}, ways AS (SELECT case_id, edge_id, a, b FROM live UNION ALL SELECT case_id, edge_id, b, a FROM live),
starts AS (SELECT case_id, edge_id AS blocked, 'head' AS side, node FROM live JOIN heads USING (case_id) UNION ALL SELECT case_id, edge_id, 'end', a FROM live UNION ALL SELECT case_id, '', 'head', node FROM heads),
w AS (SELECT case_id, blocked, side, node FROM starts UNION SELECT w.case_id, w.blocked, w.side, e.b FROM w JOIN ways e ON e.case_id = w.case_id AND e.a = w.node AND e.edge_id <> w.blocked),
n AS (SELECT case_id, blocked, count(*) AS n_nodes, count(*) FILTER (WHERE node LIKE 'c%') AS n_targets FROM w WHERE side = 'head' GROUP BY ALL)
SELECT l.case_id, l.edge_id, NOT EXISTS (SELECT 1 FROM w WHERE side = 'end' AND w.case_id = l.case_id AND blocked = l.edge_id AND node = l.b) AS bridge, f.n_nodes - n.n_nodes AS lost_nodes, f.n_targets - n.n_targets AS lost_targets
FROM live l JOIN n ON n.case_id = l.case_id AND n.blocked = l.edge_id JOIN n f ON f.case_id = l.case_id AND f.blocked = ''""")
def q75_blocked_edges(spark, d):
    live = graphs._cut(K.edges(spark, d).where("status = 'F'"))
    return forests.blocked_edges(live, K.heads(spark, d), live.select("case_id", F.col("b").alias("node")))


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    """All branches: those of open orders are added, those of odd line numbers are switches."""
    line = F.element_at(F.split("edge_id", ":"), 2).cast("int")
    return K.edges(spark, d).select("case_id", "edge_id", "a", "b", F.when(line % 2 == 1, "switch").otherwise("line").alias("kind"), (F.col("status") == "O").alias("added"))


_RANKED = _EDGES + """, ranked AS (SELECT case_id, edge_id, a, b, CASE WHEN split_part(edge_id, ':', 2)::INT % 2 = 1 THEN 'switch' ELSE 'line' END AS kind, status = 'O' AS added, row_number() OVER (PARTITION BY case_id ORDER BY status = 'O', edge_id) AS i FROM edges),
names AS (SELECT case_id, list(node ORDER BY node) AS names FROM (SELECT case_id, a AS node FROM ranked UNION SELECT case_id, b FROM ranked) GROUP BY ALL),
kruskal AS (SELECT case_id, 0::BIGINT AS i, range(1, len(names) + 1) AS labels, false AS taken FROM names UNION ALL
  SELECT case_id, i, CASE WHEN la = lb THEN labels ELSE list_transform(labels, lambda x: CASE WHEN x = la THEN lb ELSE x END) END, la <> lb
  FROM (SELECT k.case_id, e.i, k.labels, k.labels[list_position(n.names, e.a)] AS la, k.labels[list_position(n.names, e.b)] AS lb FROM kruskal k JOIN ranked e ON e.case_id = k.case_id AND e.i = k.i + 1 JOIN names n ON n.case_id = k.case_id)),
tree AS (SELECT r.* FROM ranked r JOIN kruskal k ON k.case_id = r.case_id AND k.i = r.i WHERE taken), closing AS (SELECT r.* FROM ranked r JOIN kruskal k ON k.case_id = r.case_id AND k.i = r.i WHERE NOT taken),
branch AS (SELECT case_id, a, b FROM tree UNION ALL SELECT case_id, b, a FROM tree),
climb AS (SELECT DISTINCT case_id, a AS root, a AS node, NULL::VARCHAR AS back, 0 AS hops FROM closing UNION ALL SELECT c.case_id, c.root, e.b, c.node, hops + 1 FROM climb c JOIN branch e ON e.case_id = c.case_id AND e.a = c.node WHERE e.b IS DISTINCT FROM c.back),
sizes AS (SELECT c.*, hops + 1 AS size FROM closing c JOIN climb p ON p.case_id = c.case_id AND p.root = c.a AND p.node = c.b)"""


@query(f"WITH RECURSIVE {_RANKED} SELECT case_id, edge_id, added, size::BIGINT AS size FROM sizes")
def q76_fundamental_cycles(spark, d):
    edges = graphs._cut(_ranked(spark, d))
    found = forests.cycle_sizes(edges, ("added", "edge_id"))
    return found.join(edges.select("case_id", "edge_id", "added"), ["case_id", "edge_id"]).select("case_id", "edge_id", "added", F.col("length").alias("size"))


def _stations(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers and customers with roles and places; places with the regions of the nations that share a remainder."""
    s = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("case_id"), F.concat(F.lit("s"), "s_suppkey").alias("node"), F.when(F.col("s_suppkey") % 5 == 0, "feeder-head/mv").otherwise("junction/bus").alias("role"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("p"), F.col("s_suppkey") % 9)).alias("place"))
    key = F.col("c_custkey")
    role = F.when(key % 4 == 0, "transformer-mv/mv").when(key % 4 == 1, "switch-port/in").when(key % 4 == 2, "junction/bus").otherwise("load")
    c = _t(spark, d, "customer").select(F.col("c_nationkey").alias("case_id"), F.concat(F.lit("c"), "c_custkey").alias("node"), role.alias("role"), F.when(key % 11 == 0, F.concat(F.lit("p"), key % 9)).alias("place"))
    regions = _t(spark, d, "nation").select(F.concat(F.lit("p"), F.col("n_nationkey") % 12).alias("place"), F.concat_ws("|", "n_nationkey", "n_regionkey").alias("region"))
    return s.unionByName(c), regions


@query(f"""WITH RECURSIVE {_RANKED}, {_HEADS},
nodes AS (SELECT s_nationkey AS case_id, 's' || s_suppkey AS node, CASE WHEN s_suppkey % 5 = 0 THEN 'feeder-head/mv' ELSE 'junction/bus' END AS role, CASE WHEN s_suppkey % 2 = 0 THEN 'p' || (s_suppkey % 9) END AS place FROM supplier
  UNION ALL SELECT c_nationkey, 'c' || c_custkey, ['transformer-mv/mv', 'switch-port/in', 'junction/bus', 'load'][c_custkey % 4 + 1], CASE WHEN c_custkey % 11 = 0 THEN 'p' || (c_custkey % 9) END FROM customer),
places AS (SELECT case_id, node, place, n_nationkey || '|' || n_regionkey AS region FROM nodes JOIN nation ON place = 'p' || (n_nationkey % 12)),
ends AS (SELECT case_id, edge_id, a AS node, b AS other FROM ranked UNION ALL SELECT case_id, edge_id, b, a FROM ranked),
far AS (SELECT case_id, edge_id, 'a' AS side, a AS node FROM ranked WHERE added AND kind = 'switch' UNION ALL SELECT case_id, edge_id, 'b', b FROM ranked WHERE added AND kind = 'switch'),
w AS (SELECT case_id, '' AS blocked, 'head' AS side, node FROM heads UNION ALL SELECT case_id, edge_id, side, node FROM far UNION SELECT w.case_id, w.blocked, w.side, e.other FROM w JOIN ends e ON e.case_id = w.case_id AND e.node = w.node AND e.edge_id <> w.blocked),
token AS (SELECT DISTINCT w.case_id, blocked, side, place, region FROM w JOIN places USING (case_id, node) WHERE side <> 'head'),
crossed AS (SELECT r.case_id, r.edge_id, EXISTS (SELECT 1 FROM w WHERE w.case_id = r.case_id AND blocked = r.edge_id AND side = 'a' AND node = r.b) AS alternate FROM ranked r WHERE EXISTS (SELECT 1 FROM token x JOIN token y ON y.case_id = x.case_id AND y.blocked = x.blocked AND x.side = 'a' AND y.side = 'b' AND x.place <> y.place AND x.region <> y.region WHERE x.case_id = r.case_id AND x.blocked = r.edge_id)),
degree AS (SELECT n.case_id, n.node, role, count(e.edge_id) AS degree FROM nodes n LEFT JOIN ends e USING (case_id, node) GROUP BY ALL),
ok AS (SELECT case_id, node, role IN ('feeder-head/mv', 'junction/bus', 'switch-port/in', 'switch-port/out', 'transformer-mv/mv') AS ok FROM nodes),
sized AS (SELECT case_id, size, added, count(*) AS n FROM sizes GROUP BY ALL)
SELECT d.case_id, count(*) AS nodes, max(degree) AS largest_degree, count(*) FILTER (WHERE degree > CASE WHEN role LIKE 'switch-port/%' THEN 2 WHEN role = 'transformer-mv/mv' THEN 1 ELSE 4 END) AS above_limit,
  (SELECT count(*) FROM ranked r WHERE r.case_id = d.case_id) AS edges, (SELECT count(*) FROM ranked r JOIN ok x ON x.case_id = r.case_id AND x.node = r.a JOIN ok y ON y.case_id = r.case_id AND y.node = r.b WHERE r.case_id = d.case_id AND NOT (x.ok AND y.ok)) AS unsupported, 0 AS dangling,
  (SELECT count(*) FROM sizes s WHERE s.case_id = d.case_id) AS cycles, (SELECT count(*) FROM sizes s WHERE s.case_id = d.case_id AND added) AS new_cycles,
  (SELECT count(*) FROM sizes s WHERE s.case_id = d.case_id AND added AND NOT EXISTS (SELECT 1 FROM w WHERE side = 'head' AND w.case_id = s.case_id AND w.node = s.a)) AS isolated_new_cycles,
  coalesce((SELECT string_agg(size || ':' || n, ',' ORDER BY size) FROM sized s WHERE s.case_id = d.case_id AND NOT added), '') AS old_sizes, coalesce((SELECT string_agg(size || ':' || n, ',' ORDER BY size) FROM sized s WHERE s.case_id = d.case_id AND added), '') AS new_sizes,
  (SELECT count(*) FROM crossed c WHERE c.case_id = d.case_id) AS crossings, (SELECT count(*) FROM crossed c WHERE c.case_id = d.case_id AND alternate) AS alternate_crossings,
  (SELECT count(*) FROM (SELECT node FROM places p WHERE p.case_id = d.case_id GROUP BY node HAVING count(*) > 1)) AS shared_places,
  (SELECT count(DISTINCT region) FROM places p JOIN w ON w.case_id = p.case_id AND w.node = p.node AND side = 'head' WHERE p.case_id = d.case_id AND split_part(region, '|', 1) <> d.case_id::VARCHAR) AS foreign_regions
FROM degree d GROUP BY d.case_id""")
def q77_risk_metrics(spark, d):
    nodes, regions = _stations(spark, d)
    return forests.risk_metrics(nodes, _ranked(spark, d), K.heads(spark, d), regions)


# ---------------------------------------------------------------- overlays

_LAYERS = """layers AS (SELECT unnest(['physical', 'conducting']) AS layer), times AS (SELECT unnest(['before', 'after']) AS time),
over AS (SELECT layer, time, g.case_id, g.a, g.b FROM graph g, layers, times WHERE (g.closed OR layer = 'physical') AND (NOT g.more OR time = 'after')),
both_over AS (SELECT DISTINCT * FROM (SELECT layer, time, case_id, a, b FROM over UNION ALL SELECT layer, time, case_id, b, a FROM over)),
walks AS (SELECT layer, time, case_id, node AS root, node FROM points, layers, times UNION SELECT w.layer, w.time, w.case_id, w.root, e.b FROM walks w JOIN both_over e ON e.layer = w.layer AND e.time = w.time AND e.case_id = w.case_id AND e.a = w.node),
label AS (SELECT layer, time, case_id, node, min(root) AS label FROM walks GROUP BY ALL),
shape AS (SELECT layer, time, case_id, count(DISTINCT label) AS parts, max(n) AS largest FROM (SELECT *, count(*) OVER (PARTITION BY layer, time, case_id, label) AS n FROM label) GROUP BY ALL),
extra AS (SELECT layer, l.case_id, count(g.a) AS n FROM (SELECT DISTINCT layer, case_id FROM label) l LEFT JOIN graph g ON g.case_id = l.case_id AND g.more AND (g.closed OR layer = 'physical') GROUP BY ALL),
ranks AS (SELECT x.layer, x.case_id, e.n - x.parts + y.parts AS delta, x.parts AS parts_before, y.parts AS parts_after, x.largest AS largest_before, y.largest AS largest_after FROM shape x JOIN shape y ON y.layer = x.layer AND y.case_id = x.case_id AND y.time = 'after' JOIN extra e ON e.layer = x.layer AND e.case_id = x.case_id WHERE x.time = 'before'),
cut AS (SELECT g.* FROM graph g JOIN label p ON p.layer = 'conducting' AND p.time = 'before' AND p.case_id = g.case_id AND p.node = g.a JOIN label q ON q.layer = 'conducting' AND q.time = 'before' AND q.case_id = g.case_id AND q.node = g.b JOIN label r ON r.layer = 'conducting' AND r.time = 'after' AND r.case_id = g.case_id AND r.node = g.a JOIN label s ON s.layer = 'conducting' AND s.time = 'after' AND s.case_id = g.case_id AND s.node = g.b WHERE NOT g.closed AND NOT g.more AND p.label <> q.label AND r.label = s.label)"""


def _closed(spark: SparkSession, d: str) -> DataFrame:
    """Branches with whether they conduct: all but those of each fourth line number."""
    return K.edges(spark, d).withColumn("closed", F.element_at(F.split("edge_id", ":"), 2).cast("int") % 4 != 0)


@query(f"""WITH RECURSIVE {_EDGES}, graph AS (SELECT case_id, a, b, split_part(edge_id, ':', 2)::INT % 4 <> 0 AS closed, status = 'P' AS more FROM edges WHERE status IN ('F', 'P')),
points AS (SELECT s_nationkey AS case_id, 's' || s_suppkey AS node FROM supplier UNION SELECT c_nationkey, 'c' || c_custkey FROM customer), {_LAYERS},
headed AS (SELECT time, case_id, count(*) FILTER (WHERE n > 1) AS several FROM (SELECT time, case_id, label, count(*) AS n FROM label JOIN (SELECT s_nationkey AS case_id, 's' || s_suppkey AS node FROM supplier WHERE s_suppkey % 2 = 0) USING (case_id, node) WHERE layer = 'conducting' GROUP BY ALL) GROUP BY ALL)
SELECT p.case_id, p.delta AS physical_rank_delta, c.delta AS conducting_rank_delta, (SELECT count(*) FROM cut WHERE cut.case_id = p.case_id) AS open_cuts_bypassed, coalesce(h.several, 0) - coalesce(k.several, 0) AS new_multiple_head_components,
  p.parts_before AS components_before, p.parts_after AS components_after, p.largest_before, p.largest_after
FROM ranks p JOIN ranks c ON c.case_id = p.case_id AND c.layer = 'conducting' LEFT JOIN headed h ON h.case_id = p.case_id AND h.time = 'after' LEFT JOIN headed k ON k.case_id = p.case_id AND k.time = 'before' WHERE p.layer = 'physical'""")
def q78_overlay_diagnostics(spark, d):
    e = graphs._cut(_closed(spark, d).where("status in ('F', 'P')"))
    nodes, _ = _stations(spark, d)
    heads = _t(spark, d, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_nationkey").alias("case_id"), F.concat(F.lit("s"), "s_suppkey").alias("node"))
    return overlays.diagnostics(nodes, e.where("status = 'F'"), e.where("status = 'P'"), heads)


def _placement(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Base nodes and branches, proposed lines and anchors: each third customer is an anchor with one port, or two where its key is even."""
    customer = _t(spark, d, "customer").select(F.col("c_nationkey").alias("case_id"), F.col("c_custkey").alias("key"), F.concat(F.lit("c"), "c_custkey").alias("node"))
    port = lambda side: F.concat("node", F.lit(f":{side}"))
    anchors = customer.where("key % 3 = 0").select("case_id", F.col("node").alias("anchor_id"), port("in").alias("in_port"), F.when(F.col("key") % 2 == 0, port("out")).alias("out_port"), (F.col("key") % 4 != 0).alias("closed"))
    supplier = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("case_id"), F.concat(F.lit("s"), "s_suppkey").alias("node"))
    e = _closed(spark, d).withColumn("key", F.substring("b", 2, 20).cast("long")).withColumn("line", F.element_at(F.split("edge_id", ":"), 2).cast("int"))
    anchored = F.col("key") % 3 == 0
    end = F.when(~anchored, F.col("b")).when((F.col("key") % 2 == 0) & (F.col("line") % 2 == 0), F.concat("b", F.lit(":out"))).otherwise(F.concat("b", F.lit(":in")))
    proposals = e.where("status <> 'F' and length(edge_id) % 3 = 0").select("case_id", F.col("edge_id").alias("line_id"), "a", end.alias("b"))
    return supplier.unionByName(customer.where("key % 3 <> 0").select("case_id", "node")), e.where((F.col("status") == "F") & ~anchored & (F.col("line") % 3 == 0)), proposals, anchors


_PLACED = f"""{_EDGES}, c AS (SELECT *, substr(b, 2)::BIGINT AS key, split_part(edge_id, ':', 2)::INT AS line FROM edges),
proposals AS (SELECT *, count(*) OVER (PARTITION BY case_id, least(a, b), greatest(a, b)) > 1 AS twin FROM (SELECT case_id, edge_id AS line_id, a, CASE WHEN key % 3 <> 0 THEN b WHEN key % 2 = 0 AND line % 2 = 0 THEN b || ':out' ELSE b || ':in' END AS b FROM c WHERE status <> 'F' AND length(edge_id) % 3 = 0)),
anchors AS (SELECT c_nationkey AS case_id, 'c' || c_custkey AS anchor_id, 'c' || c_custkey || ':in' AS in_port, CASE WHEN c_custkey % 2 = 0 THEN 'c' || c_custkey || ':out' END AS out_port, c_custkey % 4 <> 0 AS closed FROM customer WHERE c_custkey % 3 = 0),
asked AS (SELECT DISTINCT case_id FROM proposals WHERE NOT twin),
graph AS (SELECT case_id, a, b, line % 4 <> 0 AS closed, false AS more FROM c JOIN asked USING (case_id) WHERE status = 'F' AND key % 3 <> 0 AND line % 3 = 0 UNION ALL SELECT case_id, a, b, true, true FROM proposals WHERE NOT twin UNION ALL SELECT case_id, in_port, out_port, closed, true FROM anchors JOIN asked USING (case_id) WHERE out_port IS NOT NULL),
points AS (SELECT case_id, node FROM (SELECT s_nationkey AS case_id, 's' || s_suppkey AS node FROM supplier UNION SELECT c_nationkey, 'c' || c_custkey FROM customer WHERE c_custkey % 3 <> 0 UNION SELECT case_id, in_port FROM anchors UNION SELECT case_id, out_port FROM anchors WHERE out_port IS NOT NULL) JOIN asked USING (case_id)), {_LAYERS},
gate AS (SELECT case_id, CASE WHEN bool_or(delta > 0) THEN 'PLACEMENT_WOULD_CREATE_CYCLE' WHEN bool_or(cut) THEN 'PLACEMENT_WOULD_BYPASS_OPEN_CUT' END AS gate FROM (SELECT *, case_id IN (SELECT case_id FROM cut) AS cut FROM ranks) GROUP BY case_id),
decided AS (SELECT p.case_id, line_id, a, b, CASE WHEN twin THEN 'PARALLEL_DUPLICATE_DECLARATION_NOT_REPRESENTABLE' ELSE gate END AS reason FROM proposals p LEFT JOIN gate USING (case_id))"""


@query(f"WITH RECURSIVE {_PLACED} SELECT case_id, line_id, a, b, reason FROM decided")
def q79_placement_gate(spark, d):
    return overlays.gate_placements(*_placement(spark, d))[0].select("case_id", "line_id", "a", "b", "reason")


@query(f"""WITH RECURSIVE {_PLACED}, used AS (SELECT case_id, a AS port FROM decided WHERE reason IS NULL UNION SELECT case_id, b FROM decided WHERE reason IS NULL)
SELECT case_id, anchor_id, CASE WHEN gate IS NOT NULL THEN 'WITHDRAWN_BY_CYCLE_GATE' WHEN (case_id, in_port) IN (SELECT (case_id, port) FROM used) OR (case_id, coalesce(out_port, in_port)) IN (SELECT (case_id, port) FROM used) THEN 'PROPOSED' ELSE 'WITHDRAWN_UNUSED_ANCHOR' END AS status FROM anchors LEFT JOIN gate USING (case_id)""")
def q80_anchor_status(spark, d):
    return overlays.gate_placements(*_placement(spark, d))[1].select("case_id", "anchor_id", "status")


@query(f"""WITH {_EDGES}, old AS (SELECT case_id, edge_id, a, b FROM edges WHERE status = 'F' AND edge_id LIKE '%:1:%'), new AS (SELECT case_id, edge_id, CASE WHEN length(edge_id) % 2 = 0 THEN a ELSE b END AS a, CASE WHEN length(edge_id) % 2 = 0 THEN b ELSE a END AS b FROM edges WHERE status = 'O' AND case_id % 4 <> 0),
told AS (SELECT c_nationkey AS case_id, c_mktsegment AS reason FROM customer WHERE c_custkey % 40 = 0)
SELECT case_id, edge_id, 'BEFORE' AS origin, CASE WHEN EXISTS (SELECT 1 FROM new n WHERE n.case_id = o.case_id AND least(n.a, n.b) = least(o.a, o.b) AND greatest(n.a, n.b) = greatest(o.a, o.b)) THEN 'STILL_VALID' WHEN case_id IN (SELECT case_id FROM told WHERE reason = 'BUILDING') OR case_id IN (SELECT case_id FROM new) THEN 'SUPERSEDED_BY_BETTER_PLACEMENT' WHEN case_id IN (SELECT case_id FROM told WHERE reason IN ('MACHINERY', 'FURNITURE')) THEN 'NOW_AMBIGUOUS' ELSE 'INVALID' END AS status FROM old o
UNION ALL SELECT case_id, edge_id, 'NEW', 'NEW_ON_PLACEMENT_COUNTERFACTUAL' FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.case_id = n.case_id AND o.a = n.a AND o.b = n.b)""")
def q81_replay(spark, d):
    e = graphs._cut(K.edges(spark, d))
    swap = F.length("edge_id") % 2 == 0
    new = e.where("status = 'O' and case_id % 4 <> 0").select("case_id", "edge_id", F.when(swap, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(swap, F.col("b")).otherwise(F.col("a")).alias("b"))
    told = _t(spark, d, "customer").where("c_custkey % 40 = 0").select(F.col("c_nationkey").alias("case_id"), F.col("c_mktsegment").alias("reason"))
    return overlays.replay(e.where("status = 'F' and edge_id like '%:1:%'"), new, told, "BUILDING", ["MACHINERY", "FURNITURE"])


# ---------------------------------------------------------------- incidence and closures


@query("""WITH RECURSIVE r AS (SELECT s_nationkey AS case_id, concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id, 'c' || (o_custkey % 97) AS x, CASE WHEN l_linenumber < 5 THEN 's' || (l_suppkey % 31) ELSE '' END AS y FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey WHERE l_quantity = 1),
ways AS (SELECT case_id, x AS a, y AS b FROM r WHERE y <> '' UNION SELECT case_id, y, x FROM r WHERE y <> ''), w AS (SELECT case_id, x AS root, x AS node FROM r UNION SELECT w.case_id, w.root, b FROM w JOIN ways ON ways.case_id = w.case_id AND a = node), label AS (SELECT case_id, node, min(root) AS label FROM w GROUP BY ALL)
SELECT r.case_id, row_id, min(row_id) OVER (PARTITION BY r.case_id, label) AS component FROM r JOIN label ON label.case_id = r.case_id AND node = x""")
def q82_incidence_components(spark, d):
    item = _t(spark, d, "lineitem").where("l_quantity = 1").join(_t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey").join(_t(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    names = F.array(F.concat(F.lit("c"), F.col("o_custkey") % 97), F.when(F.col("l_linenumber") < 5, F.concat(F.lit("s"), F.col("l_suppkey") % 31)).otherwise(""))
    return graphs.incidence_components(item.select(F.col("s_nationkey").alias("case_id"), F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"), names.alias("names")))


@query("""WITH RECURSIVE ways AS (SELECT 'p' || l_partkey AS a, 's' || l_suppkey AS b FROM lineitem WHERE l_quantity < 4 UNION SELECT 's' || l_suppkey, 'o' || l_orderkey FROM lineitem WHERE l_quantity > 48 UNION SELECT 'o' || l_orderkey, 'p' || l_partkey FROM lineitem),
w AS (SELECT 'p' || p_partkey AS seed, 'p' || p_partkey AS node, 0 AS depth FROM part WHERE p_size = 1 UNION SELECT seed, b, depth + 1 FROM w JOIN ways ON a = node WHERE depth < 4)
SELECT seed, node, min(depth) AS depth, min(depth) > 3 AS depth_exceeded FROM w GROUP BY ALL HAVING node <> seed""")
def q83_seed_closures(spark, d):
    item = _t(spark, d, "lineitem")
    part, supplier, order = (F.concat(F.lit(k), c) for k, c in (("p", "l_partkey"), ("s", "l_suppkey"), ("o", "l_orderkey")))
    way = lambda df, a, b: df.select(a.alias("source"), b.alias("target"))
    ways = way(item.where("l_quantity < 4"), part, supplier).unionByName(way(item.where("l_quantity > 48"), supplier, order)).unionByName(way(item, order, part))
    return graphs.closure(_t(spark, d, "part").where("p_size = 1").select(F.concat(F.lit("p"), "p_partkey").alias("seed")), ways, 3)


@query(f"""WITH RECURSIVE {_EDGES}, {_LIVE}, {_BOTH.format('live')}, {K._WALK}, c AS (SELECT case_id, node, min(root) AS component FROM walk GROUP BY ALL), j AS (SELECT s_nationkey AS case_id, 's' || s_suppkey AS node FROM supplier WHERE s_suppkey % 3 = 0)
SELECT case_id, component, count(*) AS n_nodes, count(*) FILTER (WHERE (case_id, node) IN (SELECT (case_id, node) FROM j)) AS n_junctions, min(node) FILTER (WHERE (case_id, node) IN (SELECT (case_id, node) FROM j)) AS candidate FROM c GROUP BY ALL""")
def q84_junction_candidates(spark, d):
    junctions = _t(spark, d, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_nationkey").alias("case_id"), F.concat(F.lit("s"), "s_suppkey").alias("node"))
    return graphs.junction_candidates(K.edges(spark, d).where("status = 'F'"), junctions)


# ---------------------------------------------------------------- recovery


def _sources(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Orders as switches between two customers of a case, their line items as lines, customers as buses; a case is a remainder of the customer's key."""
    none = F.lit(None).cast("string")
    bus = lambda key: F.concat(F.lit("c"), key)
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("cust"), (F.col("o_custkey") % 20).alias("case_id"), "o_orderstatus", "o_orderpriority")
    far = bus(F.col("cust") + 20)
    # Line items meet their orders once; what is written are their keys, and the rows are spelled out as they are read.
    one = graphs._cut(o.join(_t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.count("*").alias("n")), "key"))
    turn = F.col("key") % 5 == 3
    state = F.when(F.col("o_orderstatus") == "F", "Closed").when(F.col("o_orderstatus") == "O", "Open").otherwise("Ajar")
    switch = one.select("case_id", F.when(F.col("key") % 11 == 0, "TRANSFORMER").when(F.col("key") % 13 == 0, "ACCESS_POINT").otherwise("SWITCH").alias("kind"), F.concat(F.lit("r"), "key").alias("record"), F.concat(F.lit("o"), "key").alias("entity_id"), (F.col("key") % 17 != 0).alias("unique"),
        F.when(turn, far).otherwise(bus("cust")).alias("end1"), F.when(F.col("n") == 1, "").when(turn, bus("cust")).when(F.col("key") % 5 == 4, none).otherwise(far).alias("end2"), state.alias("state"), F.when(F.col("o_orderpriority").startswith("1"), "TRUE").otherwise("false").alias("tie"), none.alias("voltage"))
    item = graphs._cut(_t(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_partkey", "l_suppkey").join(o.select("key", "cust", "case_id"), "key"))
    first = F.col("l_linenumber") == 1
    name = F.concat_ws(":", "key", "l_linenumber", "l_partkey", "l_suppkey")
    line = item.select("case_id", F.lit("LINE").alias("kind"), F.concat(F.lit("l"), name).alias("record"), F.concat(F.lit("l"), name).alias("entity_id"), (F.col("l_partkey") % 23 != 0).alias("unique"), F.when(first, bus("cust")).otherwise(F.concat(F.lit("o"), "key")).alias("end1"), F.when(first, F.concat(F.lit("o"), "key")).otherwise(far).alias("end2"), none.alias("state"), none.alias("tie"), none.alias("voltage"))
    key = F.col("c_custkey")
    bus_ = _t(spark, d, "customer").select((key % 20).alias("case_id"), F.when(key % 29 == 0, "REGION").otherwise("BUS").alias("kind"), bus("c_custkey").alias("record"), bus("c_custkey").alias("entity_id"), (key % 19 != 0).alias("unique"), none.alias("end1"), none.alias("end2"), none.alias("state"), none.alias("tie"), F.when(key % 7 == 0, "110").when(key % 7 == 1, "10").otherwise("").alias("voltage"))
    cases = spark.range(20).select(F.col("id").alias("case_id"), F.lit("10.5").cast("decimal(38,18)").alias("nominal"), (F.col("id") != 18).alias("headed"), F.when(F.col("id") == 19, F.array(F.lit("HARD"))).alias("hard"), (F.col("id") == 17).alias("malformed"))
    kept = switch.where(F.substring("entity_id", 2, 20).cast("long") % 31 == 0).select("case_id", "kind", "entity_id")
    ports = line.select("case_id", "record", F.explode(F.array(F.struct(F.lit(1).alias("side"), F.col("end1").alias("node")), F.struct(F.lit(2).alias("side"), F.col("end2").alias("node")))).alias("p")).select("case_id", "record", "p.*").where("node like 'c%'")
    present = line.where("record like '%7'").select("case_id", F.col("entity_id").alias("line_id"))
    return switch.unionByName(line).unionByName(bus_), cases, kept, ports, present


_RECOVERY = """o AS (SELECT o_orderkey AS key, o_custkey % 20 AS case_id, 'c' || o_custkey AS near, 'c' || (o_custkey + 20) AS far, o_orderstatus, o_orderpriority, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
bus AS (SELECT c_custkey % 20 AS case_id, 'c' || c_custkey AS raw, CASE WHEN c_custkey % 29 = 0 THEN 'REGION' ELSE 'BUS' END AS kind, c_custkey % 7 = 0 AS wrong FROM customer WHERE c_custkey % 19 <> 0),
line AS (SELECT o.case_id, o.key, 'l' || concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line_id, l_partkey % 23 <> 0 AS uniq, l_linenumber = 1 AS first, near, far, count(*) OVER (PARTITION BY o.case_id, concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS same FROM lineitem JOIN o ON l_orderkey = o.key),
inc AS (SELECT case_id, key, count(*) AS n_ends, count(DISTINCT line_id) AS n_lines, count(*) FILTER (WHERE first) AS n_in, count(*) FILTER (WHERE NOT first) AS n_out, bool_and(uniq) AS lines_unique FROM line GROUP BY ALL),
dev AS (SELECT o.*, i.* EXCLUDE (case_id, key), CASE WHEN o.key % 11 = 0 THEN 'TRANSFORMER' WHEN o.key % 13 = 0 THEN 'ACCESS_POINT' ELSE 'SWITCH' END AS kind, CASE WHEN o.key % 5 = 3 THEN far ELSE near END AS end1, CASE WHEN n = 1 THEN '' WHEN o.key % 5 = 3 THEN near WHEN o.key % 5 = 4 THEN NULL ELSE far END AS end2,
  o.key % 17 <> 0 AS sole, o.key % 31 = 0 AS kept, o_orderstatus IN ('F', 'O') AS known, o_orderpriority NOT LIKE '1%' AS ordinary FROM o JOIN inc i ON i.case_id = o.case_id AND i.key = o.key),
e AS (SELECT dev.*, p.kind AS p_kind, p.wrong AS p_wrong, q.kind AS q_kind, q.wrong AS q_wrong, x.kind AS x_kind, x.wrong AS x_wrong, y.kind AS y_kind, y.wrong AS y_wrong FROM dev LEFT JOIN bus p ON p.case_id = dev.case_id AND p.raw = CASE WHEN n_in > 0 THEN near END LEFT JOIN bus q ON q.case_id = dev.case_id AND q.raw = end1 LEFT JOIN bus x ON x.case_id = dev.case_id AND x.raw = CASE WHEN n_out > 0 THEN far END LEFT JOIN bus y ON y.case_id = dev.case_id AND y.raw = end2),
f AS (SELECT *, kind = 'SWITCH' AS switch, kind = 'SWITCH' AND n_lines = 2 AS series, n_in = 1 AND n_out = CASE WHEN n_lines = 2 THEN 1 ELSE 0 END AS sided, CASE WHEN kind = 'SWITCH' THEN CASE n_lines WHEN 2 THEN 'SERIES_SWITCH_RECOVERY' WHEN 1 THEN 'SWITCH_TERMINAL_REPRESENTATION' ELSE 'OTHER_DETERMINISTIC_REVIEW' END WHEN kind = 'TRANSFORMER' THEN CASE WHEN n_lines > 1 THEN 'MULTI_INCOMING_TRANSFORMER_REVIEW' ELSE 'REFERENCED_TRANSFORMER_RECOVERY' END ELSE 'ACCESS_POINT_RECOVERY' END AS family FROM e),
g AS (SELECT *, list_sort(list_distinct(list_filter([CASE WHEN n_lines > 2 THEN 'INCIDENCE_NOT_SUPPORTED' END, CASE WHEN case_id = 17 THEN 'MALFORMED_LINE_EVIDENCE' END, CASE WHEN NOT known THEN 'KNOWN_STATE_REQUIRED' END, CASE WHEN NOT ordinary THEN 'ORDINARY_SWITCH_REQUIRED' END, CASE WHEN case_id = 18 THEN 'ACCEPTED_HEAD_REQUIRED' END,
  CASE WHEN n_lines > 2 OR n_ends <> n_lines OR NOT lines_unique THEN 'FULL_UNIQUE_INCIDENCE_REQUIRED' END, CASE WHEN NOT sided THEN 'INCIDENCE_DIRECTION_REQUIRED' END,
  CASE WHEN sided AND (p_kind IS NULL OR q_kind IS NULL OR (series AND (x_kind IS NULL OR y_kind IS NULL))) THEN 'EXACT_OUTER_REFERENCE_REQUIRED' END, CASE WHEN sided AND ((p_kind IS NOT NULL AND q_kind IS NOT NULL AND near <> end1) OR (series AND x_kind IS NOT NULL AND y_kind IS NOT NULL AND far <> end2)) THEN 'DIRECT_DECLARATIONS_REQUIRED' END,
  CASE WHEN sided AND ((p_kind = 'REGION' AND q_kind IS NOT NULL) OR (series AND x_kind = 'REGION' AND y_kind IS NOT NULL)) THEN 'UNSUPPORTED_OUTER_ENTITY_TYPE' END, CASE WHEN sided AND ((p_kind IS NOT NULL AND q_kind IS NOT NULL AND (p_wrong OR q_wrong)) OR (series AND x_kind IS NOT NULL AND y_kind IS NOT NULL AND (x_wrong OR y_wrong))) THEN 'INCOMPATIBLE_VOLTAGE' END,
  CASE WHEN sided AND NOT series AND coalesce(end2, '') <> '' THEN 'REMOTE_ENDPOINT_NOT_EMPTY' END], lambda r: r IS NOT NULL))) AS asks FROM f),
judged AS (SELECT case_id, kind, 'o' || key AS key, family, CASE WHEN NOT series THEN family WHEN NOT ordinary THEN 'SERIES_TIE_OR_UNKNOWN_TYPE' WHEN n_in <> 1 OR n_out <> 1 THEN 'SERIES_INVALID_INCIDENCE' WHEN p_kind IS NULL OR q_kind IS NULL OR x_kind IS NULL OR y_kind IS NULL THEN 'SERIES_UNRESOLVED_ENDPOINT' WHEN near = end1 AND far = end2 THEN 'SERIES_EXACT_DIRECT' WHEN near = end2 AND far = end1 THEN 'SERIES_EXACT_REVERSE' ELSE 'SERIES_DIFFERENT_OR_PARTIAL_ENDPOINT' END AS variant,
  CASE WHEN NOT sole OR case_id = 19 THEN 'REJECTED' WHEN kept AND kind <> 'ACCESS_POINT' THEN 'BASELINE_PRESERVED' WHEN NOT switch THEN 'NEEDS_REVIEW' WHEN len(asks) = 0 THEN 'ACCEPTED' WHEN list_has_any(asks, ['INCOMPATIBLE_VOLTAGE', 'FULL_UNIQUE_INCIDENCE_REQUIRED', 'MALFORMED_LINE_EVIDENCE']) THEN 'REJECTED' ELSE 'NEEDS_REVIEW' END AS status,
  array_to_string(CASE WHEN NOT sole OR case_id = 19 THEN list_filter([CASE WHEN case_id = 19 THEN 'HARD' END, CASE WHEN NOT sole THEN 'IDENTITY_NOT_UNIQUE' END], lambda r: r IS NOT NULL) WHEN kind = 'TRANSFORMER' THEN [CASE WHEN kept THEN 'EXISTING_V1_MV_ATTACHMENT' WHEN n_lines > 1 THEN 'MULTIPLE_POSSIBLE_PORTS' ELSE 'DECLARED_REFERENCE_PORT_SEMANTICS_UNPROVEN' END]
    WHEN NOT switch THEN ['ACCESS_POINT_PHYSICAL_ROLE_UNPROVEN'] WHEN kept THEN ['EXISTING_V1_SWITCH'] WHEN len(asks) > 0 THEN asks WHEN series THEN ['EXACT_DIRECT_SERIES'] ELSE ['EXACT_LEAF_UNBOUND_REMOTE'] END, ',') AS reasons, n_lines, o_orderstatus FROM g)"""


@query(f"WITH {_RECOVERY} SELECT case_id, kind, key, family, variant, status, reasons, n_lines, status = 'ACCEPTED' AND o_orderstatus = 'F' AS conducting FROM judged")
def q85_recovery_candidates(spark, d):
    accounts, cases, kept, _, _ = _sources(spark, d)
    return recovery.candidates(accounts, cases, kept).withColumn("reasons", F.array_join("reasons", ","))


@query(f"""WITH {_RECOVERY} SELECT l.case_id, line_id, CASE WHEN first THEN near ELSE j.key || ':out' END AS a, CASE WHEN first THEN j.key || ':in' ELSE far END AS b, 1 AS n_dependencies FROM line l JOIN judged j ON j.case_id = l.case_id AND j.key = 'o' || l.key AND status = 'ACCEPTED' WHERE uniq AND same = 1 AND line_id NOT LIKE '%7' AND l.case_id <> 19""")
def q86_recovered_lines(spark, d):
    accounts, cases, kept, ports, present = _sources(spark, d)
    return recovery.recovered_lines(accounts, cases, recovery.candidates(accounts, cases, kept), ports, present)


# ---------------------------------------------------------------- scans, summaries, contracts


@query("""WITH raw AS (SELECT l_suppkey % 40 AS case_id, concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS record, concat('p', l_partkey, ',s', l_suppkey, ',o', l_orderkey % 100) AS raw FROM lineitem),
found AS (SELECT DISTINCT case_id, record, unnest(regexp_extract_all(raw, '[ps][0-9]+')) AS name FROM raw), wanted AS (SELECT 'p' || p_partkey AS name FROM part WHERE p_size = 1 UNION SELECT 's' || s_suppkey FROM supplier WHERE s_acctbal < 0 UNION SELECT 'nowhere')
SELECT name, case_id, count(DISTINCT record) AS n_records, min(record) AS first_record FROM found SEMI JOIN wanted USING (name) GROUP BY ALL""")
def q87_wanted_definitions(spark, d):
    item = _t(spark, d, "lineitem")
    raw = F.concat(F.lit("p"), "l_partkey", F.lit(",s"), "l_suppkey", F.lit(",o"), F.col("l_orderkey") % 100)
    rows = item.select((F.col("l_suppkey") % 40).alias("case_id"), F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("record"), raw.alias("raw"))
    wanted = _t(spark, d, "part").where("p_size = 1").select(F.concat(F.lit("p"), "p_partkey").alias("name")).unionByName(_t(spark, d, "supplier").where("s_acctbal < 0").select(F.concat(F.lit("s"), "s_suppkey").alias("name"))).unionByName(spark.range(1).select(F.lit("nowhere").alias("name")))
    return scans.wanted_definitions(rows, "[ps][0-9]+", wanted)


_SETS = {"all": [], "status": ["status"], "status_band": ["status", "band"], "band_flag": ["band", "flag"], "nation": ["nation"]}
_VALUES = {"status": ["F", "O", "P", "X"], "band": ["LOW", "MIDDLE", "HIGH"], "flag": ["A", "N", "R", "Z"]}


def _sets_sql() -> str:
    dims = ["status", "band", "flag", "nation"]
    out = []
    for name, ds in _SETS.items():
        on = " AND ".join(f"i.{d} = s.{d}" for d in ds) or "true"
        shell = ", ".join(f"(SELECT unnest({_VALUES[d]}) AS {d})" for d in ds if d in _VALUES) if ds and all(d in _VALUES for d in ds) else f"(SELECT DISTINCT {', '.join(ds)} FROM i)" if ds else "(SELECT 1)"
        columns = ", ".join(f"s.{d}" if d in ds else f"NULL AS {d}" for d in dims)
        columns_of = ", ".join(f"s.{d}" for d in ds)
        out.append(f"SELECT '{name}' AS \"table\", {columns}, count(i.q) AS n, coalesce(sum(i.q), 0)::BIGINT AS quantity, count(i.q) FILTER (WHERE i.flag = 'R') AS returned FROM (SELECT * FROM {shell}) s LEFT JOIN i ON {on} {'GROUP BY ' + columns_of if ds else ''}")
    return " UNION ALL ".join(out)


@query(f"""WITH i AS (SELECT o_orderstatus AS status, CASE WHEN l_quantity < 17 THEN 'LOW' WHEN l_quantity < 34 THEN 'MIDDLE' ELSE 'HIGH' END AS band, l_returnflag AS flag, c_nationkey AS nation, l_quantity AS q FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey) {_sets_sql()}""")
def q88_summary_tables(spark, d):
    customer = _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    order = _t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.col("o_orderstatus").alias("status"))
    item = _t(spark, d, "lineitem").select("l_orderkey", F.col("l_quantity").cast("long").alias("q"), F.col("l_returnflag").alias("flag"))
    band = F.when(F.col("q") < 17, "LOW").when(F.col("q") < 34, "MIDDLE").otherwise("HIGH")
    rows = item.join(order, "l_orderkey").join(customer, "o_custkey").withColumn("band", band)
    return scans.summaries(rows, _SETS, _VALUES, {"n": F.count("*"), "quantity": F.sum("q"), "returned": F.count_if(F.col("flag") == "R")})


_KNOWN = {
    "ownership_confirmed": "key % 7 <> 0", "ownership_conflict": "key % 53 = 0", "cross_case_requested": "key % 59 = 0", "open_bypass_requested": "key % 61 = 0", "unknown_switch_state": "loose > 0", "voltage_confirmed": "key % 5 <> 0", "mv_side_confirmed": "key % 3 <> 0", "lv_side_confirmed": "key % 4 <> 0",
    "valid_head": "balance > 0", "placement_policy_approved": "key % 2 = 0", "lv_policy_approved": "key % 6 <> 0", "distribution_role_confirmed": "key % 8 <> 0", "demand_confirmed": "key % 9 <> 0", "device_count_policy_approved": "key % 10 <> 0", "capacity_source_policy_approved": "key % 12 <> 0",
    "s0_usable": "closed > 0", "s2_usable": "closed + open > 0", "s0_full": "targets > 0 AND closed = targets", "s2_full": "targets > 0 AND closed + open = targets",
}
_COUNTED = {"target_count": "targets", "unreferenced_count": "loose", "source_line_count": "targets", "accepted_junction_count": "key % 3", "located_transformer_count": "closed"}
_CONTRACT = """o AS (SELECT o_custkey, count(*) AS targets, count(*) FILTER (WHERE o_orderstatus = 'P') AS loose, count(*) FILTER (WHERE o_orderstatus = 'F') AS closed, count(*) FILTER (WHERE o_orderstatus = 'O') AS open FROM orders GROUP BY ALL),
b AS (SELECT c_custkey AS key, c_acctbal AS balance, coalesce(targets, 0) AS targets, coalesce(loose, 0) AS loose, coalesce(closed, 0) AS closed, coalesce(open, 0) AS open FROM customer LEFT JOIN o ON o_custkey = c_custkey),
facts AS (SELECT *, loose > 0 AS fa, targets = 0 AS fb, key % 13 = 0 AS fc, balance < -500 AS fd, key % 71 = 0 AS banned, """ + ", ".join(f"{v} AS {k}" for k, v in (_KNOWN | _COUNTED).items()) + " FROM b)"


def _codes_sql(operation: str) -> str:
    plain = lambda on: on.replace("array_contains(flags, 'C')", "fc").replace("array_contains(flags, 'D') and size(explicit) = 0", "fd AND NOT banned")
    cases = [f"CASE WHEN {plain(on)} THEN '{code}' END" for op, code, on in decisions.PROHIBITIONS if op in (decisions.ANY_OPERATION, operation)]
    return f"list_sort(list_distinct(list_filter([{', '.join(cases)}, CASE WHEN banned THEN 'AMBIGUOUS_IDENTITY' END], lambda x: x IS NOT NULL)))"


def _contract(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("o_orderstatus")
    o = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("targets"), F.count_if(s == "P").alias("loose"), F.count_if(s == "F").alias("closed"), F.count_if(s == "O").alias("open"))
    b = _t(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance")).join(o, "key", "left").na.fill(0, ["targets", "loose", "closed", "open"])
    flags = F.array_compact(F.array(F.when(F.col("loose") > 0, F.lit("A")), F.when(F.col("targets") == 0, F.lit("B")), F.when(F.expr("key % 13 = 0"), F.lit("C")), F.when(F.expr("balance < -500"), F.lit("D"))))
    explicit = F.when(F.expr("key % 71 = 0"), F.array(F.lit("AMBIGUOUS_IDENTITY")))
    return b.select("*", flags.alias("flags"), explicit.alias("explicit"), *(F.expr(v).alias(k) for k, v in (_KNOWN | _COUNTED).items()))


@query(f"WITH {_CONTRACT} SELECT key, operation, len(codes) = 0 AS eligible, array_to_string(codes, ',') AS codes FROM (" + " UNION ALL ".join(f"SELECT key, '{op}' AS operation, {_codes_sql(op)} AS codes FROM facts" for op in decisions.OPERATIONS) + ")")
def q89_operation_prohibitions(spark, d):
    f = decisions.operation_prohibitions(_contract(spark, d)).select("key", F.inline("operations"))
    return f.withColumn("codes", F.array_join("codes", ","))


@query(f"""WITH {_CONTRACT} SELECT key, action, CASE action {' '.join(f"WHEN '{a}' THEN '{r}'" for a, r in decisions.ACTION_READINESS.items())} END AS readiness, n_codes FROM (SELECT key, CASE WHEN banned OR fd OR ownership_conflict OR cross_case_requested OR open_bypass_requested THEN 'BLOCKED_BY_SOURCE_CONFLICT' WHEN fb THEN 'ROLE_CONFIRMATION_REQUIRED' WHEN s0_full THEN 'ALREADY_TARGET_COMPLETE'
  WHEN fc OR s2_full OR (s2_usable AND NOT s0_usable) THEN 'DETERMINISTIC_RULE_REVIEW' WHEN NOT valid_head OR source_line_count = 0 OR NOT (s0_usable OR s2_usable) OR accepted_junction_count = 0 THEN 'INSUFFICIENT_STRUCTURE' WHEN fa AND len({_codes_sql("SYNTHETIC_ATTACHMENT_EDGE")}) = 0 THEN 'AUTO_SYNTHETIC_ELIGIBLE' WHEN fa THEN 'ROLE_CONFIRMATION_REQUIRED' ELSE 'DETERMINISTIC_RULE_REVIEW' END AS action,
  len(list_distinct(flatten([{', '.join(_codes_sql(op) for op in decisions.OPERATIONS)}])))::INT AS n_codes FROM facts)""")
def q90_completion_readiness(spark, d):
    return decisions.evaluate_completion(_contract(spark, d)).select("key", "action", "readiness", F.size("codes").alias("n_codes"))


_GATED = """entity AS (SELECT s_nationkey AS case_id, (s_suppkey % 70)::VARCHAR AS ref, s_suppkey, s_acctbal FROM supplier), refs AS (SELECT o_orderkey AS reference_id, c_nationkey AS case_id, (o_orderkey % 90)::VARCHAR AS ref, o_totalprice, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query(f"""WITH {_GATED}, n AS (SELECT ref, case_id, count(*) AS n, min((s_suppkey, s_acctbal)) AS one FROM entity GROUP BY ALL), t AS (SELECT ref, sum(n) AS n FROM n GROUP BY ALL),
r AS (SELECT refs.*, coalesce(n.n, 0) AS local, coalesce(t.n, 0) - coalesce(n.n, 0) AS foreign_, (SELECT min(one) FROM n m WHERE m.ref = refs.ref AND m.case_id <> refs.case_id) AS donor, (SELECT min(m.case_id) FROM n m WHERE m.ref = refs.ref AND m.case_id <> refs.case_id) AS donor_case FROM refs LEFT JOIN n ON n.ref = refs.ref AND n.case_id = refs.case_id LEFT JOIN t ON t.ref = refs.ref)
SELECT reference_id, CASE WHEN foreign_ > 1 THEN 'MULTIPLE_EXTERNAL' WHEN foreign_ = 0 AND local > 0 THEN 'LOCAL_UNRESOLVED_ONLY' WHEN foreign_ = 0 THEN 'UNDEFINED_GLOBAL' WHEN reference_id % 41 = 0 THEN 'MULTIPLE_EXTERNAL_MATCH' WHEN reference_id % 43 = 0 THEN 'NO_CANONICAL_CANDIDATE' WHEN donor[2] < 0 THEN 'AMBIGUOUS_IDENTITY' WHEN o_orderpriority LIKE '1%' AND donor[1] % 2 = 0 THEN 'TYPE_INCOMPATIBLE' WHEN donor[1] % 19 = 0 THEN 'NO_CANONICAL_CANDIDATE'
  WHEN o_totalprice > 300000 THEN 'VOLTAGE_NOT_COMPATIBLE' WHEN local > 0 THEN 'ALSO_RESOLVES_CASE_LOCALLY' WHEN case_id % 9 = 0 THEN 'REFERRING_CASE_HARD_BLOCKER' WHEN donor_case % 9 = 1 THEN 'DONOR_CASE_HARD_BLOCKER' WHEN case_id % 5 <> donor_case % 5 THEN 'TIER_NOT_MATERIALIZED' ELSE '' END AS reason FROM r""")
def q91_cross_case_gates(spark, d):
    entities = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("case_id"), (F.col("s_suppkey") % 70).cast("string").alias("ref"), "s_suppkey", "s_acctbal")
    customer = _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("case_id"))
    refs = _t(spark, d, "orders").join(customer, "o_custkey").select(F.col("o_orderkey").alias("reference_id"), "case_id", (F.col("o_orderkey") % 90).cast("string").alias("ref"), "o_totalprice", "o_orderpriority")
    donors = entities.groupBy("ref", F.col("case_id").alias("donor_case")).agg(F.min(F.struct("s_suppkey", "s_acctbal")).alias("donor"))
    known = references.across_cases(refs, entities).select("reference_id", "n_local", "n_foreign", "classification")
    rows = refs.join(known, "reference_id")
    # A reference with one foreign entity has at most two cases that hold it.
    sole = rows.where("n_foreign = 1").join(donors, "ref").where("donor_case <> case_id")
    rows = sole.unionByName(rows.where("n_foreign <> 1"), allowMissingColumns=True)
    key, donor = F.col("reference_id"), F.col("donor.s_suppkey")
    holds = {
        "many": key % 41 == 0, "no_candidate": key % 43 == 0, "not_unique": F.col("donor.s_acctbal") < 0, "other_type": F.col("o_orderpriority").startswith("1") & (donor % 2 == 0), "no_reference": donor % 19 == 0, "other_voltage": F.col("o_totalprice") > 300000,
        "local": F.col("n_local") > 0, "blocked": F.col("case_id") % 9 == 0, "donor_blocked": F.col("donor_case") % 9 == 1, "other_tier": F.col("case_id") % 5 != F.col("donor_case") % 5,
    }
    return rows.select("reference_id", decisions.cross_case_reason(F.col("classification"), "UNIQUE_EXTERNAL", holds).alias("reason"))


# ---------------------------------------------------------------- interpretation


def _interpreted(spark: SparkSession, d: str) -> topology.Topology:
    """Orders as switches or transformers that mostly name nothing, their line items as lines from one customer (a bus) to another or to their nation's remainder (a station); suppliers as feeders."""
    none = F.lit(None).cast("string")
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("cust"), (F.col("o_custkey") % 20).alias("case_id"), "o_orderstatus")
    row = lambda df, kind, record, id_, unique=F.lit(True), name=none, end1=none, end2=none, state=none, voltage=none: df.select("case_id", kind.alias("kind"), record.alias("record"), id_.alias("entity_id"), unique.alias("unique"), name.alias("name"), end1.alias("end1"), end2.alias("end2"), state.alias("state"), voltage.alias("voltage"))
    key = F.concat(F.lit("o"), "key")
    kind = F.when(F.col("key") % 11 == 0, "ACCESS_POINT").when(F.col("key") % 3 == 0, "TRANSFORMER").otherwise("SWITCH")
    state = F.when(F.col("o_orderstatus") == "F", "Closed").when(F.col("o_orderstatus") == "O", "Open").otherwise("Ajar")
    device = row(o, kind, F.concat(F.lit("r"), "key"), key, F.col("key") % 17 != 0, end1=F.when(F.col("key") % 7 == 0, F.concat(F.lit("c"), "cust")), state=state)
    item = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_partkey", "l_suppkey").join(o, "key")
    name = F.concat_ws(":", "key", "l_linenumber", "l_partkey", "l_suppkey")
    first, near, far = F.col("l_linenumber") == 1, F.concat(F.lit("c"), "cust"), F.concat(F.lit("c"), F.col("cust") + 20)
    line = row(item, F.lit("LINE"), F.concat(F.lit("l"), name), F.when(F.col("l_partkey") % 31 != 0, F.concat(F.lit("l"), name)), F.col("l_partkey") % 23 != 0, end1=F.when(~first, key).when(F.col("key") % 4 == 0, F.concat(F.lit("t"), F.col("case_id"))).otherwise(near), end2=F.when(first, key).when(F.col("key") % 13 == 0, "").otherwise(far))
    c = _t(spark, d, "customer").withColumn("case_id", F.col("c_custkey") % 20)
    ck = F.col("c_custkey")
    bus = row(c, F.lit("BUS"), F.concat(F.lit("c"), ck), F.concat(F.lit("c"), ck), ck % 19 != 0, end1=F.concat(F.lit("t"), "case_id"), voltage=F.when(ck % 7 == 0, "110").when(ck % 7 == 1, "10").when(ck % 7 == 2, "ten").otherwise(""))
    every = spark.range(20).withColumnRenamed("id", "case_id")
    station = row(every, F.lit("STATION"), F.concat(F.lit("t"), "case_id"), F.concat(F.lit("t"), "case_id"))
    head = _t(spark, d, "customer").groupBy((ck % 20).alias("case_id")).agg(F.max(F.when(ck % 19 != 0, ck)).alias("cust"))
    feeder = row(head.where("case_id <> 3"), F.lit("FEEDER"), F.concat(F.lit("f"), "case_id"), F.concat(F.lit("f"), "case_id"), F.col("case_id") != 5, name=F.when(F.col("case_id") == 8, "20kV line").otherwise(F.lit("line")), end1=F.when(F.col("case_id") == 6, "gone").otherwise(F.concat(F.lit("c"), "cust")))
    cases = every.select("case_id", F.when(F.col("case_id") % 8 == 0, "north 10 kV").otherwise("x110kvar").alias("name"), F.lit("10.5").cast("decimal(38,18)").alias("fallback"))
    return topology.interpret(device.unionByName(line).unionByName(bus).unionByName(station).unionByName(feeder), cases)


_INTERPRETED = """o AS (SELECT o_orderkey AS key, o_custkey AS cust, o_custkey % 20 AS case_id, o_orderstatus FROM orders),
line AS (SELECT o.case_id, o.key, l_linenumber = 1 AS first, 'l' || concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS record, l_partkey % 31 <> 0 AS has_id, l_partkey % 23 <> 0 AS uniq, cust,
  CASE WHEN l_linenumber > 1 THEN 'o' || key WHEN key % 4 = 0 THEN 't' || o.case_id ELSE 'c' || cust END AS end1, CASE WHEN l_linenumber = 1 THEN 'o' || key WHEN key % 13 = 0 THEN '' ELSE 'c' || (cust + 20) END AS end2 FROM lineitem JOIN o ON l_orderkey = o.key),
lines AS (SELECT *, has_id AND count(*) OVER (PARTITION BY case_id, record) = 1 AS once FROM line),
inc AS (SELECT case_id, raw, count(*) AS ends, count(DISTINCT CASE WHEN has_id THEN record END) AS n, count(*) FILTER (WHERE side = 1) AS outgoing, count(*) FILTER (WHERE side = 2) AS incoming, bool_and(once) AS once FROM (SELECT *, 1 AS side, end1 AS raw FROM lines UNION ALL SELECT *, 2, end2 FROM lines) WHERE raw LIKE 'o%' GROUP BY ALL),
head AS (SELECT c AS case_id, c = 8 AS conflict, CASE WHEN c = 3 THEN 'MISSING_FEEDER' WHEN c = 5 THEN 'AMBIGUOUS_FEEDER' WHEN c = 6 THEN 'INVALID_FEEDER_BUS' WHEN c = 8 THEN 'NAME_VOLTAGE_CONFLICT' END AS reason, CASE WHEN c = 3 THEN '' ELSE 'f' || c END AS owner FROM range(20) AS r(c)),
device AS (SELECT o.case_id, o.key, kind, CASE WHEN kind = 'ACCESS_POINT' THEN 'ACCESS_POINT_UNSUPPORTED' WHEN o.key % 17 = 0 THEN 'IDENTITY_NOT_UNIQUE' WHEN NOT coalesce(once, true) THEN 'INCIDENT_IDENTITY_CONFLICT' WHEN coalesce(n, 0) <> need THEN kind || '_DEGREE' WHEN incoming <> 1 OR outgoing <> need - 1 OR ends <> need THEN kind || '_DIRECTION' WHEN o.key % 7 = 0 THEN 'EXPLICIT_ENDPOINT_EVIDENCE' WHEN o.case_id = 8 THEN 'NAME_VOLTAGE_CONFLICT' END AS reason
  FROM (SELECT *, CASE WHEN key % 11 = 0 THEN 'ACCESS_POINT' WHEN key % 3 = 0 THEN 'TRANSFORMER' ELSE 'SWITCH' END AS kind, CASE WHEN key % 3 = 0 THEN 1 ELSE 2 END AS need FROM o) o LEFT JOIN inc i ON i.case_id = o.case_id AND i.raw = 'o' || o.key),
bus AS (SELECT c_custkey % 20 AS case_id, 'c' || c_custkey AS raw, c_custkey % 19 <> 0 AS sole, c_custkey % 7 AS v FROM customer),
ends AS (SELECT e.case_id, e.record, e.side, CASE WHEN e.raw = '' THEN 'MISSING_REFERENCE' WHEN e.raw LIKE 'c%' AND b.raw IS NULL THEN 'UNRESOLVED_REFERENCE' WHEN (e.raw LIKE 'c%' AND NOT b.sole) OR (e.raw LIKE 'o%' AND e.key % 17 = 0) THEN 'IDENTITY_NOT_UNIQUE' WHEN e.case_id = 8 THEN 'NAME_VOLTAGE_CONFLICT' WHEN b.v = 2 THEN 'INVALID_VOLTAGE_EVIDENCE' WHEN b.v = 0 THEN 'BUS_VOLTAGE_CONFLICT'
  WHEN e.raw LIKE 't%' AND e.case_id IN (3, 5, 6, 8) THEN 'NO_FEEDER_HEAD' WHEN e.raw LIKE 'o%' THEN d.reason END AS reason FROM (SELECT *, 1 AS side, end1 AS raw FROM lines UNION ALL SELECT *, 2, end2 FROM lines) e LEFT JOIN bus b ON b.case_id = e.case_id AND b.raw = e.raw LEFT JOIN device d ON d.case_id = e.case_id AND 'o' || d.key = e.raw),
whole AS (SELECT l.case_id, l.record, CASE WHEN NOT l.uniq OR NOT l.once THEN 'IDENTITY_NOT_UNIQUE' WHEN EXISTS (SELECT 1 FROM ends e WHERE e.case_id = l.case_id AND e.record = l.record AND e.reason IS NOT NULL) THEN 'LINE_ENDPOINT_EXCLUDED' END AS reason FROM lines l),
said AS (SELECT case_id, 'FEEDER_HEAD' AS rule, owner, NULL::INT AS side, reason FROM head UNION ALL SELECT case_id, kind, 'o' || key, NULL, reason FROM device UNION ALL SELECT case_id, 'LINE_END', record, side, reason FROM ends UNION ALL SELECT case_id, 'LINE', record, NULL, reason FROM whole)"""


@query(f"""WITH {_INTERPRETED} SELECT *, CASE WHEN reason IS NULL THEN 'PROJECTED' WHEN reason IN ('AMBIGUOUS_FEEDER', 'IDENTITY_NOT_UNIQUE') THEN 'AMBIGUOUS' WHEN reason IN ('MISSING_REFERENCE', 'UNRESOLVED_REFERENCE', 'MISSING_FEEDER', 'INVALID_FEEDER_BUS', 'NO_FEEDER_HEAD') THEN 'UNRESOLVED' WHEN reason LIKE '%UNSUPPORTED' THEN 'UNSUPPORTED' ELSE 'EXCLUDED' END AS status FROM said""")
def q92_topology_decisions(spark, d):
    return _interpreted(spark, d).decisions


@query(f"""WITH RECURSIVE {_INTERPRETED}, node_of AS (SELECT e.case_id, e.record, e.side, CASE WHEN raw LIKE 't%' THEN 'head:f' || e.case_id WHEN raw LIKE 'c%' THEN 'bus:' || raw WHEN d.kind = 'TRANSFORMER' THEN 'transformer:' || raw ELSE 'switch:' || raw || CASE side WHEN 2 THEN ':in' ELSE ':out' END END AS node FROM (SELECT *, 1 AS side, end1 AS raw FROM lines UNION ALL SELECT *, 2, end2 FROM lines) e LEFT JOIN device d ON d.case_id = e.case_id AND 'o' || d.key = raw),
b AS (SELECT w.case_id, x.node AS a, y.node AS b FROM whole w JOIN node_of x ON x.case_id = w.case_id AND x.record = w.record AND x.side = 1 JOIN node_of y ON y.case_id = w.case_id AND y.record = w.record AND y.side = 2 WHERE reason IS NULL UNION ALL SELECT d.case_id, 'switch:o' || d.key || ':in', 'switch:o' || d.key || ':out' FROM device d JOIN o ON o.key = d.key WHERE kind = 'SWITCH' AND reason IS NULL AND o_orderstatus = 'F'),
ways AS (SELECT case_id, a, b FROM b UNION SELECT case_id, b, a FROM b), r AS (SELECT case_id, 'head:' || owner AS node FROM head WHERE reason IS NULL UNION SELECT r.case_id, w.b FROM r JOIN ways w ON w.case_id = r.case_id AND w.a = r.node) SELECT case_id, node FROM r""")
def q93_topology_reached(spark, d):
    return _interpreted(spark, d).reached()
