"""Graphs by case: reachability, hops, components, cycle rank.  Edges are never collapsed; case_id is always a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators.tables import Tables


def _cut(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder that the cluster shares."""
    return Tables(df.sparkSession).save(df)


def undirected(edges: DataFrame) -> DataFrame:
    return edges.select("case_id", "a", "b").union(edges.select("case_id", F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def reach(heads: DataFrame, edges: DataFrame, most: int | None = None) -> DataFrame:
    """(case_id, node, hops) of all nodes that the heads (case_id, node) reach, breadth first; ``most`` bounds the hops.

    A round joins the frontier alone, and is written once: what was seen is the union of the rounds, never written again.  It takes as many rounds
    as there are hops; where only membership is asked, ``reached`` takes their logarithm.
    """
    t = Tables(edges.sparkSession)
    both = t.save(undirected(edges))
    rounds = [t.save(heads.select("case_id", "node").distinct().withColumn("hops", F.lit(0)))]
    seen = rounds[0]
    while most is None or len(rounds) <= most:
        step = rounds[-1].withColumnRenamed("node", "a").join(both, ["case_id", "a"]).select("case_id", F.col("b").alias("node")).distinct()
        # On the next hop there are only neighbours of the last: of what was seen, the last two rounds can meet them again.
        for last in rounds[-2:]:
            step = step.join(last, ["case_id", "node"], "left_anti")
        found, n = t.count(step.withColumn("hops", F.lit(len(rounds))), F.lit(True))
        if not n:
            break
        rounds.append(found)
        seen = seen.unionByName(found)
    t.drop(both)
    return seen


def reached(heads: DataFrame, edges: DataFrame) -> DataFrame:
    """(case_id, node) of all nodes that the heads reach over edges without direction: the heads' components, and the heads themselves."""
    label = components(edges)
    served = label.join(heads.select("case_id", "node"), ["case_id", "node"], "left_semi").select("case_id", "component").distinct()
    return label.join(served, ["case_id", "component"], "left_semi").select("case_id", "node").unionByName(heads.select("case_id", "node")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(case_id, node, component): the least node of the same component, by contraction.

    In a round each node hooks to the neighbour that a hash of the round puts first, if that comes before itself, and then goes three hooks further; nodes
    with one image become one.  The hash makes chains short and leaves at most half of the nodes that have edges, on average, whatever the graph: rounds grow
    with the logarithm of the nodes, and each works on what the last has left of the edges.  Least neighbours are found before the shuffle, and a join has each node
    once on one side, so adaptive execution can split the edges of a node that has very many.
    """
    t = Tables(edges.sparkSession)
    nodes = t.save(edges.select("case_id", F.col("a").alias("node")).union(edges.select("case_id", "b")).distinct())
    now = t.save(edges.where("a <> b").select("case_id", F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    maps, left = [], True
    while left:
        place = lambda c: F.struct(F.xxhash64(F.lit(len(maps)), c).alias("place"), F.col(c).alias("node"))
        ends = now.select("case_id", F.col("u").alias("node"), F.col("v").alias("other")).union(now.select("case_id", "v", "u"))
        first = ends.groupBy("case_id", "node").agg(F.min(place("other")).alias("first"))
        up = t.save(first.select("case_id", "node", F.when(F.col("first") < place("node"), F.col("first.node")).otherwise(F.col("node")).alias("up")))
        over = up.select("case_id", F.col("node").alias("up"), F.col("up").alias("image"))
        far = up
        for _ in range(3):
            far = far.join(over, ["case_id", "up"]).select("case_id", "node", F.col("image").alias("up"))
        maps.append(t.save(far.withColumnRenamed("up", "image")))
        side = lambda c: maps[-1].select("case_id", F.col("node").alias(c), F.col("image").alias(f"new_{c}"))
        moved = now.join(side("u"), ["case_id", "u"]).join(side("v"), ["case_id", "v"]).where("new_u <> new_v")
        step, left = t.count(moved.select("case_id", F.least("new_u", "new_v").alias("u"), F.greatest("new_u", "new_v").alias("v")).distinct(), F.lit(True))
        t.drop(now, up)
        now = step
    found = nodes.withColumn("root", F.col("node"))
    for m in maps:
        found = found.join(m.withColumnRenamed("node", "root"), ["case_id", "root"], "left").select("case_id", "node", F.coalesce("image", "root").alias("root"))
    found = t.save(found)
    least = found.groupBy("case_id", "root").agg(F.min("node").alias("component"))
    out = t.save(found.join(least, ["case_id", "root"]).select("case_id", "node", "component"))
    t.drop(found, nodes, *maps)
    return out


def cycle_rank(edges: DataFrame) -> DataFrame:
    """n_nodes, n_edges, n_components and cycle_rank = edges - nodes + components for each case; parallels and loops count."""
    found = components(edges)
    nodes = found.groupBy("case_id").agg(F.count("*").alias("n_nodes"), F.count_distinct("component").alias("n_components"))
    count = edges.groupBy("case_id").agg(F.count("*").alias("n_edges"))
    return nodes.join(count, "case_id").withColumn("cycle_rank", F.col("n_edges") - F.col("n_nodes") + F.col("n_components"))


def profile(edges: DataFrame) -> DataFrame:
    """Loops, excess parallels and the largest degree for each case."""
    pair = [F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")]
    pairs = edges.select("case_id", *pair).groupBy("case_id", "x", "y").agg(F.count("*").alias("n"))
    flat = pairs.groupBy("case_id").agg(F.sum("n").alias("n_edges"), F.sum(F.when(F.col("x") == F.col("y"), F.col("n")).otherwise(0)).alias("n_loops"), F.sum(F.col("n") - 1).alias("parallel_excess"))
    ends = edges.select("case_id", F.col("a").alias("node")).union(edges.select("case_id", "b"))
    degree = ends.groupBy("case_id", "node").agg(F.count("*").alias("d")).groupBy("case_id").agg(F.max("d").alias("max_degree"))
    return flat.join(degree, "case_id")


def mutual(edges: DataFrame) -> DataFrame:
    """Pairs (source, target) that also stand the other way round, each once."""
    back = edges.select(F.col("target").alias("source"), F.col("source").alias("target"))
    return edges.select("source", "target").distinct().join(back.distinct(), ["source", "target"], "left_semi").where("source < target")


def parallel_withdrawal(edges: DataFrame) -> DataFrame:
    """Edges with whether their whole group is withdrawn: more than one edge between the same two nodes."""
    pair = edges.withColumn("x", F.least("a", "b")).withColumn("y", F.greatest("a", "b"))
    count = pair.groupBy("case_id", "x", "y").agg(F.count("*").alias("n"))
    return pair.join(count, ["case_id", "x", "y"]).withColumn("withdrawn", F.col("n") > 1).drop("x", "y", "n")


def relation(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Pairs (case_id, first, second) with distance 0, 1, 2, GT2, DISCONNECTED or UNRESOLVED (a node is null), and the least common neighbour.

    Common neighbours are looked for from the end with fewer neighbours.
    """
    both = _cut(undirected(edges).where("a <> b"))
    degree = both.groupBy("case_id", F.col("a").alias("node")).agg(F.count("*").alias("degree"))
    label = components(edges).select("case_id", "node", "component")
    node = degree.join(label, ["case_id", "node"])
    pairs = pairs.select("case_id", "first", "second").distinct()
    for side in ("first", "second"):
        pairs = pairs.join(node.select("case_id", F.col("node").alias(side), F.col("degree").alias(f"degree_{side}"), F.col("component").alias(f"component_{side}")), ["case_id", side], "left")
    pairs = _cut(pairs)
    less = F.coalesce("degree_first", F.lit(0)) <= F.coalesce("degree_second", F.lit(0))
    apart = pairs.where("component_first = component_second and first <> second").select("case_id", "first", "second", F.when(less, F.col("first")).otherwise(F.col("second")).alias("a"), F.when(less, F.col("second")).otherwise(F.col("first")).alias("other"))
    step = apart.join(both, ["case_id", "a"]).select("case_id", "first", "second", "other", F.col("b").alias("a"))
    next_ = step.where("a = other").select("case_id", "first", "second", F.lit(True).alias("adjacent"))
    shared = step.join(both.withColumnRenamed("b", "other"), ["case_id", "a", "other"], "left_semi").groupBy("case_id", "first", "second").agg(F.min("a").alias("witness"))
    out = pairs.join(next_, ["case_id", "first", "second"], "left").join(shared, ["case_id", "first", "second"], "left")
    distance = F.when(F.col("first").isNull() | F.col("second").isNull(), "UNRESOLVED").when(F.col("first") == F.col("second"), "0").when(F.col("adjacent"), "1").when(F.col("witness").isNotNull(), "2").when(F.col("component_first") == F.col("component_second"), "GT2").otherwise("DISCONNECTED")
    return out.select("case_id", "first", "second", distance.alias("distance"), F.when(distance == "2", F.col("witness")).alias("witness"))


def strong_components(edges: DataFrame) -> DataFrame:
    """(case_id, node, component): the least node that a node reaches and is reached from.

    The least label that reaches a node is spread forward; of each label's nodes those that also reach its root form a component and leave.
    """
    ends = edges.select("case_id", F.col("a").alias("node")).union(edges.select("case_id", "b"))
    left, arcs = _cut(ends.distinct()), _cut(edges.select("case_id", "a", "b").where("a <> b").distinct())
    done = None
    while not left.isEmpty():
        labels = _cut(left.withColumn("label", F.col("node")))
        while True:
            come = arcs.join(labels.withColumnRenamed("node", "a"), ["case_id", "a"]).groupBy("case_id", F.col("b").alias("node")).agg(F.min("label").alias("come"))
            step = _cut(labels.join(come, ["case_id", "node"], "left").select("case_id", "node", "label", F.least("label", "come").alias("next")))
            labels = step.select("case_id", "node", F.col("next").alias("label"))
            if step.where("label <> next").isEmpty():
                break
        near = labels.select("case_id", F.col("node").alias("a"), "label").join(arcs, ["case_id", "a"])
        near = _cut(near.join(labels.select("case_id", F.col("node").alias("b"), "label"), ["case_id", "b", "label"]).select("case_id", "a", "b", "label"))
        got = front = _cut(labels.where("node = label"))
        while True:
            back = front.withColumnRenamed("node", "b").join(near, ["case_id", "b", "label"]).select("case_id", F.col("a").alias("node"), "label").distinct()
            front = _cut(back.join(got, ["case_id", "node"], "left_anti"))
            if front.isEmpty():
                break
            got = _cut(got.unionByName(front))
        found = got.withColumnRenamed("label", "component")
        done = found if done is None else done.unionByName(found)
        left = _cut(left.join(got, ["case_id", "node"], "left_anti"))
        arcs = _cut(arcs.join(left.withColumnRenamed("node", "a"), ["case_id", "a"], "left_semi").join(left.withColumnRenamed("node", "b"), ["case_id", "b"], "left_semi").select("case_id", "a", "b"))
    return done if done is not None else left.withColumn("component", F.col("node"))


def forest(edges: DataFrame) -> DataFrame:
    """(case_id, node, parent, depth, edge_id): breadth-first trees from the least node of each component; the parent is the least
    neighbour one level up, over the least edge.  Roots have no parent."""
    roots = components(edges).select("case_id", F.col("component").alias("node")).distinct()
    depth = _cut(reach(roots, edges))
    ways = edges.select("case_id", "a", "b", "edge_id").union(edges.select("case_id", "b", "a", "edge_id"))
    up = ways.join(depth.select("case_id", F.col("node").alias("a"), F.col("hops").alias("depth")), ["case_id", "a"]).join(depth.select("case_id", F.col("node").alias("b"), F.col("hops").alias("above")), ["case_id", "b"]).where("above = depth - 1")
    best = up.groupBy("case_id", F.col("a").alias("node")).agg(F.min(F.struct("b", "edge_id")).alias("up"))
    return depth.join(best, ["case_id", "node"], "left").select("case_id", "node", F.col("up.b").alias("parent"), F.col("hops").alias("depth"), F.col("up.edge_id").alias("edge_id"))


def cycle_basis(edges: DataFrame) -> DataFrame:
    """(case_id, edge_id, length): for each edge outside the breadth-first forest the length of the cycle that it closes; loops have 1, parallels 2.

    Ancestors 1, 2, 4, ... levels up are found by doubling; the deeper end of an edge rises to the other's level, and then both rise while they differ.
    """
    t = Tables(edges.sparkSession)
    tree = t.save(forest(edges))
    levels, (now, left) = [], t.count(tree.select("case_id", "node", F.col("parent").alias("above")), F.col("above").isNotNull())
    while left:
        levels.append(now.where("above is not null"))
        far = now.select("case_id", F.col("node").alias("above"), F.col("above").alias("far"))
        now, left = t.count(now.join(far, ["case_id", "above"], "left").select("case_id", "node", F.col("far").alias("above")), F.col("above").isNotNull())
    rest = edges.select("case_id", "edge_id", "a", "b").join(tree.where("edge_id is not null").select("case_id", "edge_id"), ["case_id", "edge_id"], "left_anti")
    depth = lambda c: tree.select("case_id", F.col("node").alias(c), F.col("depth").alias(f"depth_{c}"))
    rest = rest.join(depth("a"), ["case_id", "a"]).join(depth("b"), ["case_id", "b"])
    low = F.col("depth_a") >= F.col("depth_b")
    now = rest.select("case_id", "edge_id", F.when(low, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(low, F.col("b")).otherwise(F.col("a")).alias("b"), F.greatest("depth_a", "depth_b").alias("deep"), F.least("depth_a", "depth_b").alias("high"))
    now = now.withColumn("length", F.col("deep") - F.col("high") + 1)
    over = lambda level, c: level.select("case_id", F.col("node").alias(c), F.col("above").alias(f"above_{c}"))
    for i in reversed(range(len(levels))):
        rises = F.col("deep") - F.col("high") >= 1 << i
        now = now.join(over(levels[i], "a"), ["case_id", "a"], "left").withColumn("a", F.when(rises, F.col("above_a")).otherwise(F.col("a"))).withColumn("deep", F.when(rises, F.col("deep") - (1 << i)).otherwise(F.col("deep"))).drop("above_a")
    now = t.save(now)
    for i in reversed(range(len(levels))):
        now = now.join(over(levels[i], "a"), ["case_id", "a"], "left").join(over(levels[i], "b"), ["case_id", "b"], "left")
        rises = F.coalesce(F.col("above_a") != F.col("above_b"), F.lit(False))
        now = now.withColumn("a", F.when(rises, F.col("above_a")).otherwise(F.col("a"))).withColumn("b", F.when(rises, F.col("above_b")).otherwise(F.col("b"))).withColumn("length", F.col("length") + F.when(rises, 2 << i).otherwise(0)).drop("above_a", "above_b")
    return now.select("case_id", "edge_id", (F.col("length") + F.when(F.col("a") != F.col("b"), 2).otherwise(0)).alias("length"))


def bypassed(cuts: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Open edges (case_id, edge_id, a, b) with whether their ends hang together before and after an overlay."""
    every = before.withColumn("when", F.lit("before")).unionByName(after.withColumn("when", F.lit("after")))
    keyed = components(every.select(F.concat_ws("|", "when", "case_id").alias("case_id"), "a", "b"))
    out = cuts.select("case_id", "edge_id", "a", "b")
    for when in ("before", "after"):
        mine = keyed.where(F.col("case_id").startswith(f"{when}|")).select(F.substring_index("case_id", "|", -1).cast(cuts.schema["case_id"].dataType).alias("case_id"), "node", "component")
        for side in ("a", "b"):
            out = out.join(mine.select("case_id", F.col("node").alias(side), F.col("component").alias(f"_{side}")), ["case_id", side], "left")
        out = out.withColumn(when, (F.col("a") == F.col("b")) | F.coalesce(F.col("_a") == F.col("_b"), F.lit(False))).drop("_a", "_b")
    return out.withColumn("bypassed", F.col("after") & ~F.col("before"))


def incidence_components(rows: DataFrame) -> DataFrame:
    """(case_id, row_id, component) of rows (case_id, row_id, names) that hang together by raw names they share; the component is the least row in it.

    Rows and names are both nodes, so a name in a million rows has a million edges and makes no pairs of rows.  Null and empty names connect nothing; a row
    without names is a component of its own.
    """
    t = Tables(rows.sparkSession)
    own = t.save(rows.select("case_id", F.concat(F.lit("r:"), F.col("row_id").cast("string")).alias("node"), "row_id", "names"))
    links = own.select("case_id", F.col("node").alias("a"), F.explode("names").alias("name")).where("name <> ''").select("case_id", "a", F.concat(F.lit("n:"), "name").alias("b"))
    label = components(links).where("node like 'r:%'")
    found = own.join(label, ["case_id", "node"], "left").select("case_id", "row_id", F.coalesce("component", "node").alias("component"))
    least = found.groupBy("case_id", "component").agg(F.min("row_id").alias("least"))
    return found.join(least, ["case_id", "component"]).select("case_id", "row_id", F.col("least").alias("component"))


def closure(seeds: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    """(seed, node, depth, depth_exceeded) of all nodes that each seed reaches along edges (source, target), breadth first; the seed itself is left out.

    Nodes one beyond ``most`` are told as exceeded and not followed.  The frontier is keyed by seed: each has its own visited nodes, kept as the union of the rounds, so
    that ways back and cycles end.  Seeds that are no source reach nothing.
    """
    if most < 0:
        raise ValueError("the depth of a closure is 0 or more")
    t = Tables(edges.sparkSession)
    ways = t.save(edges.select("source", "target").distinct())
    seen = front = t.save(seeds.select("seed", F.col("seed").alias("node"), F.lit(0).alias("depth")).distinct())
    for depth in range(1, most + 2):
        step = front.withColumnRenamed("node", "source").join(ways, "source").select("seed", F.col("target").alias("node")).distinct()
        front, n = t.count(step.join(seen, ["seed", "node"], "left_anti").withColumn("depth", F.lit(depth)), F.lit(True))
        if not n:
            break
        seen = seen.unionByName(front)
    t.drop(ways)
    return seen.where("depth > 0").withColumn("depth_exceeded", F.col("depth") > most)


def junction_candidates(edges: DataFrame, junctions: DataFrame) -> DataFrame:
    """(case_id, component, n_nodes, n_junctions, candidate) for each component: its junctions (case_id, node), and the least of them; null where it has none."""
    found = components(edges).join(junctions.select("case_id", "node", F.lit(True).alias("junction")).distinct(), ["case_id", "node"], "left")
    return found.groupBy("case_id", "component").agg(F.count("*").alias("n_nodes"), F.count_if("junction").alias("n_junctions"), F.min(F.when(F.col("junction"), F.col("node"))).alias("candidate"))
