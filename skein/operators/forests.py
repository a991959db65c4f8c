"""Rooted forests: minimum spanning forest, tour, ancestors, subtree sums, bridges and fundamental cycles, in rounds logarithmic in the nodes.

Nothing walks a tree step by step: forests grow by Borůvka's rounds, are rooted by ranking an Euler tour, and ancestors and sums over
subtrees double their reach each round.  Every join is on a node, an arc or an edge, each of which stands once on one side, so adaptive execution can
split the other side where a node has very many edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.operators.tables import Tables

#: Groups in which the arcs that leave a node are put in order, so that no task orders all arcs of one node.
_GROUPS = 256


def _ends(df: DataFrame, *more: str) -> DataFrame:
    """Each edge from both ends: node, other."""
    return df.select("case_id", F.col("u").alias("node"), F.col("v").alias("other"), *more).unionByName(df.select("case_id", F.col("v").alias("node"), F.col("u").alias("other"), *more))


def _roots(up: DataFrame, t: Tables) -> DataFrame:
    """(case_id, node, up) with up moved to the root of its tree; roots point to themselves.  A round goes four times as far as the last."""
    table, moved = t.save(up), True
    while moved:
        now = table.select("case_id", "node", "up")
        above = now.select("case_id", F.col("node").alias("up"), F.col("up").alias("next"))
        step = now
        for _ in range(3):
            step = step.join(above, ["case_id", "up"]).select("case_id", "node", F.col("next").alias("up"), F.col("up").alias("was"))
        # Where the last step moved, there may be more above.
        step, moved = t.count(step, F.col("up") != F.col("was"))
        t.drop(table)
        table = step
    return table.select("case_id", "node", "up")


def spanning_forest(edges: DataFrame, t: Tables, order: tuple[str, ...] = ("edge_id",)) -> tuple[DataFrame, DataFrame]:
    """The edges (case_id, edge_id, a, b) of the minimum spanning forest by ``order``, and the tree (case_id, node, tree) of each node that has one.

    Borůvka's rounds: every tree takes its least edge, trees that took each other's meet, and of the edges between two trees only the least
    remains; trees at least halve in number.  ``order`` ends with what tells edges apart; edges of one rank are told apart by their ends.
    """
    rank = F.struct(*order, F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    now = t.save(edges.where("a <> b").select("case_id", F.col("a").alias("u"), F.col("b").alias("v"), F.struct(rank.alias("rank"), "edge_id", "a", "b").alias("edge")))
    taken, maps = [], []
    while True:
        best = _ends(now, "edge").groupBy("case_id", "node").agg(F.min(F.struct("edge", "other")).alias("best"))
        pick, n = t.count(best.select("case_id", "node", F.col("best.other").alias("up"), F.col("best.edge").alias("edge")), F.lit(True))
        taken.append(pick.select("case_id", "edge.*").drop("rank"))
        if not n:
            break
        other = pick.select("case_id", F.col("node").alias("up"), F.col("edge.rank").alias("rank"))
        met = (F.col("edge.rank") == F.col("rank")) & (F.col("node") < F.col("up"))
        root = _roots(pick.join(other, ["case_id", "up"]).select("case_id", "node", F.when(met, F.col("node")).otherwise(F.col("up")).alias("up")), t)
        maps.append(root)
        side = lambda c: root.select("case_id", F.col("node").alias(c), F.col("up").alias(f"new_{c}"))
        moved = now.join(side("u"), ["case_id", "u"]).join(side("v"), ["case_id", "v"]).where("new_u <> new_v")
        step = t.save(moved.groupBy("case_id", F.least("new_u", "new_v").alias("u"), F.greatest("new_u", "new_v").alias("v")).agg(F.min("edge").alias("edge")))
        t.drop(now)
        now = step
    tree = maps[0].withColumnRenamed("up", "tree") if maps else taken[0].select("case_id", F.col("a").alias("node"), F.col("b").alias("tree"))
    for later in maps[1:]:
        tree = tree.join(later.select("case_id", F.col("node").alias("tree"), F.col("up").alias("top")), ["case_id", "tree"], "left").select("case_id", "node", F.coalesce("top", "tree").alias("tree"))
    forest = taken[0]
    for more in taken[1:]:
        forest = forest.unionByName(more)
    return t.save(forest.distinct()), t.save(tree)


def _next_out(arcs: DataFrame) -> DataFrame:
    """For each arc the one that leaves its tail next, in a ring: by group of a hash, then by name."""
    arcs = arcs.withColumn("group", F.pmod(F.xxhash64("edge_id"), F.lit(_GROUPS)))
    within = Window.partitionBy("case_id", "tail", "group").orderBy("edge_id", "back")
    ring = Window.partitionBy("case_id", "tail").orderBy("group")
    firsts = arcs.groupBy("case_id", "tail", "group").agg(F.min(F.struct("edge_id", "back")).alias("first"))
    firsts = firsts.select("case_id", "tail", "group", F.coalesce(F.lead("first").over(ring), F.first("first").over(ring)).alias("after"), F.first("first").over(ring).alias("start"))
    return arcs.withColumn("then", F.lead(F.struct("edge_id", "back")).over(within)).join(firsts, ["case_id", "tail", "group"]).withColumn("then", F.coalesce("then", "after")).drop("group", "after")


def rooted(forest: DataFrame, tree: DataFrame, heads: DataFrame, t: Tables) -> DataFrame:
    """(case_id, node, tree, parent, edge_id, enter, leave): each tree from its head, or else its least node.

    The tour of a tree follows each arc with the next one that leaves its point; an arc's rank from the end doubles its reach each round.  The arc that comes
    first of an edge's two goes down.  A node's subtree are the nodes that enter between its own enter and leave.
    """
    arcs = forest.select("case_id", "edge_id", F.lit(False).alias("back"), F.col("a").alias("tail"), F.col("b").alias("point")).unionByName(forest.select("case_id", "edge_id", F.lit(True).alias("back"), F.col("b").alias("tail"), F.col("a").alias("point")))
    top = tree.join(heads.select("case_id", "node", F.lit(0).alias("later")).distinct(), ["case_id", "node"], "left")
    top = t.save(top.groupBy("case_id", "tree").agg(F.min(F.struct(F.coalesce("later", F.lit(1)), "node")).getField("node").alias("root")))
    out = t.save(_next_out(arcs))
    # The tour goes on from an arc with the arc that leaves after its own way back; at the root's first arc it ends.
    starts = out.join(top.select("case_id", F.col("root").alias("tail")), ["case_id", "tail"], "left_semi").select("case_id", F.col("start.edge_id").alias("edge_id"), F.col("start.back").alias("back"), F.lit(True).alias("ends")).distinct()
    after = out.select("case_id", "edge_id", (~F.col("back")).alias("back"), F.col("then.edge_id").alias("next_id"), F.col("then.back").alias("next_back"))
    after = after.join(starts.select("case_id", F.col("edge_id").alias("next_id"), F.col("back").alias("next_back"), "ends"), ["case_id", "next_id", "next_back"], "left")
    gone = F.col("ends").isNotNull()
    now, left = t.count(after.select("case_id", "edge_id", "back", F.when(~gone, F.col("next_id")).alias("next_id"), F.when(~gone, F.col("next_back")).alias("next_back"), F.when(gone, 0).otherwise(1).cast("long").alias("rank")), F.col("next_id").isNotNull())
    while left:
        # A round goes four times as far as the last.
        ahead = now.select("case_id", F.col("edge_id").alias("next_id"), F.col("back").alias("next_back"), F.col("next_id").alias("far_id"), F.col("next_back").alias("far_back"), F.col("rank").alias("more"))
        step = now
        for _ in range(3):
            step = step.join(ahead, ["case_id", "next_id", "next_back"], "left").select("case_id", "edge_id", "back", F.col("far_id").alias("next_id"), F.col("far_back").alias("next_back"), (F.col("rank") + F.coalesce("more", F.lit(0))).alias("rank"))
        step, left = t.count(step, F.col("next_id").isNotNull())
        t.drop(now)
        now = step
    ranks = now.groupBy("case_id", "edge_id").agg(F.max(F.when(~F.col("back"), F.col("rank"))).alias("there"), F.max(F.when(F.col("back"), F.col("rank"))).alias("home"))
    down = F.col("there") > F.col("home")
    nodes = forest.join(ranks, ["case_id", "edge_id"]).select("case_id", F.when(down, F.col("b")).otherwise(F.col("a")).alias("node"), F.when(down, F.col("a")).otherwise(F.col("b")).alias("parent"), "edge_id", (-F.greatest("there", "home")).alias("enter"), (-F.least("there", "home")).alias("leave"))
    ends = F.lit(1 << 62)
    found = tree.join(nodes, ["case_id", "node"], "left").select("case_id", "node", "tree", "parent", "edge_id", F.coalesce("enter", -ends).alias("enter"), F.coalesce("leave", ends).alias("leave"))
    found = t.save(found)
    t.drop(out, now, top)
    return found


def ancestors(nodes: DataFrame, t: Tables) -> tuple[list[DataFrame], DataFrame]:
    """For 1, 2, 4, ... levels up the ancestor of each node that has one (case_id, node, above, enter, leave), and (case_id, node, depth)."""
    own = nodes.select("case_id", F.col("node").alias("parent"), F.col("enter").alias("p_enter"), F.col("leave").alias("p_leave"))
    first = nodes.join(own, ["case_id", "parent"], "left").select("case_id", "node", F.col("parent").alias("above"), F.col("p_enter").alias("enter"), F.col("p_leave").alias("leave"), F.col("parent").isNotNull().cast("long").alias("depth"))
    levels, (now, left) = [], t.count(first, F.col("above").isNotNull())
    while left:
        levels.append(now.where("above is not null").drop("depth"))
        far = now.select("case_id", F.col("node").alias("above"), F.col("above").alias("far"), F.col("enter").alias("far_enter"), F.col("leave").alias("far_leave"), F.col("depth").alias("more"))
        step = now.join(far, ["case_id", "above"], "left").select("case_id", "node", F.col("far").alias("above"), F.col("far_enter").alias("enter"), F.col("far_leave").alias("leave"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        now, left = t.count(step, F.col("above").isNotNull())
    return levels, now.select("case_id", "node", "depth")


def meeting(pairs: DataFrame, nodes: DataFrame, levels: list[DataFrame], t: Tables) -> DataFrame:
    """Pairs (case_id, a, b and more) of nodes of one tree with the lowest node above both (meet): a climbs while it is not above b."""
    at_b = nodes.select("case_id", F.col("node").alias("b"), F.col("enter").alias("b_enter"))
    now = pairs.join(at_b, ["case_id", "b"]).withColumn("at", F.col("a"))
    for i, level in enumerate(reversed(levels)):
        now = now.join(level.withColumnRenamed("node", "at"), ["case_id", "at"], "left")
        short = F.col("above").isNotNull() & ~F.col("b_enter").between(F.col("enter"), F.col("leave"))
        now = now.withColumn("at", F.when(short, F.col("above")).otherwise(F.col("at"))).drop("above", "enter", "leave")
        if i % 6 == 5:
            now = t.save(now)
    own = nodes.select("case_id", F.col("node").alias("at"), "parent", "enter", "leave")
    over = F.col("b_enter").between(F.col("enter"), F.col("leave"))
    return now.join(own, ["case_id", "at"]).withColumn("meet", F.when(over, F.col("at")).otherwise(F.col("parent"))).drop("at", "parent", "enter", "leave", "b_enter")


def subtree_sums(values: DataFrame, levels: list[DataFrame], t: Tables, by: tuple[str, ...] = ()) -> DataFrame:
    """Sums over the subtree of each node, of (case_id, node, and numbers), apart for each ``by``; nodes without any value below are left out.

    A round adds to each node what those 1, 2, 4, ... levels below have gathered from as many levels.
    """
    keys = ["case_id", "node", *by]
    numbers = [c for c in values.columns if c not in keys]
    add = lambda df: df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in numbers))
    now = t.save(add(values))
    for level in levels:
        up = now.join(level.select("case_id", "node", "above"), ["case_id", "node"]).select("case_id", F.col("above").alias("node"), *by, *numbers)
        step = t.save(add(now.unionByName(up)))
        t.drop(now)
        now = step
    return now


class Forest:
    """A graph's forest with what its operators share.  Edges: case_id, edge_id, a, b; each keeps its own identity, loops and parallels too."""

    def __init__(self, edges: DataFrame, heads: DataFrame, order: tuple[str, ...] = ("edge_id",)):
        self.t = Tables(edges.sparkSession)
        self.edges = self.t.save(edges)
        self.tree_edges, tree = spanning_forest(self.edges, self.t, order)
        loose = self.edges.where("a = b").select("case_id", F.col("a").alias("node"), F.col("a").alias("tree")).distinct().join(tree, ["case_id", "node"], "left_anti")
        self.nodes = rooted(self.tree_edges, self.t.save(tree.unionByName(loose)), heads, self.t)
        self.levels, self.depth = ancestors(self.nodes, self.t)

    def closing(self) -> DataFrame:
        """The edges outside the forest, with the meeting point of their ends and the size of the cycle that each closes (a loop's is 1)."""
        rest = self.edges.join(self.tree_edges.select("case_id", "edge_id"), ["case_id", "edge_id"], "left_anti")
        found = meeting(rest, self.nodes, self.levels, self.t)
        for c in ("a", "b", "meet"):
            found = found.join(self.depth.select("case_id", F.col("node").alias(c), F.col("depth").alias(f"{c}_depth")), ["case_id", c])
        size = F.col("a_depth") + F.col("b_depth") - 2 * F.col("meet_depth") + 1
        return self.t.save(found.withColumn("size", size).drop("a_depth", "b_depth", "meet_depth"))

    def below(self, closing: DataFrame, more: DataFrame | None = None) -> DataFrame:
        """For each node that is not a root (case_id, node, tree, edge_id) how many edges outside the forest bypass the edge above it (cover), with sums of ``more``
        (case_id, node, numbers) over its subtree.

        Such an edge counts 1 at both ends and -2 where their paths meet, so in sums over subtrees it counts on the path between them alone.
        """
        one = lambda c, n: closing.select("case_id", F.col(c).alias("node"), F.lit(n).cast("long").alias("cover"))
        values = one("a", 1).unionByName(one("b", 1)).unionByName(one("meet", -2))
        numbers = ["cover"]
        if more is not None:
            numbers += [c for c in more.columns if c not in ("case_id", "node")]
            values = values.unionByName(more, allowMissingColumns=True).na.fill(0, numbers)
        sums = subtree_sums(values, self.levels, self.t)
        return self.nodes.where("parent is not null").select("case_id", "node", "tree", "edge_id").join(sums, ["case_id", "node"], "left").na.fill(0, numbers)

    def bridges(self, closing: DataFrame) -> DataFrame:
        """The forest's edges without which a tree falls apart, each as the node below it (case_id, node, tree, edge_id)."""
        return self.below(closing).where("cover = 0").drop("cover")


def cycle_sizes(edges: DataFrame, order: tuple[str, ...] = ("edge_id",)) -> DataFrame:
    """(case_id, edge_id, length): the fundamental cycles of the minimum spanning forest, one for each edge outside it; loops have 1, parallels 2."""
    forest = Forest(edges, edges.select("case_id", F.col("a").alias("node")).limit(0), order)
    return forest.closing().select("case_id", "edge_id", F.col("size").alias("length"))


def blocked_edges(edges: DataFrame, heads: DataFrame, targets: DataFrame) -> DataFrame:
    """What the head of a case no longer reaches when one edge is blocked, for all edges at once: case_id, edge_id, bridge, lost_nodes, lost_targets.

    Only bridges of the head's tree lose anything: the nodes, and the ``targets`` (case_id, node), of the subtree below.  A search for each edge is
    not needed.
    """
    f = Forest(edges.select("case_id", "edge_id", "a", "b"), heads)
    counts = f.nodes.select("case_id", "node").join(targets.select("case_id", "node", F.lit(1).alias("target")).distinct(), ["case_id", "node"], "left")
    counts = counts.select("case_id", "node", F.lit(1).cast("long").alias("lost_nodes"), F.coalesce("target", F.lit(0)).cast("long").alias("lost_targets"))
    own = f.nodes.join(heads.select("case_id", "node"), ["case_id", "node"], "left_semi").select("case_id", "tree", F.lit(True).alias("served")).distinct()
    lost = f.below(f.closing(), counts).where("cover = 0").join(own, ["case_id", "tree"], "left").select("case_id", "edge_id", F.coalesce("served", F.lit(False)).alias("served"), "lost_nodes", "lost_targets")
    out = f.edges.select("case_id", "edge_id").join(lost, ["case_id", "edge_id"], "left")
    count = lambda c: F.when(F.col("served"), F.col(c)).otherwise(0).cast("long").alias(c)
    return f.t.save(out.select("case_id", "edge_id", F.col("served").isNotNull().alias("bridge"), count("lost_nodes"), count("lost_targets")))


# ---------------------------------------------------------------- risks

# Roles that a path may pass, and the degree from which a node of a role is reviewed.
SUPPORTED = ["feeder-head/mv", "junction/bus", "switch-port/in", "switch-port/out", "transformer-mv/mv"]
DEGREE_LIMITS = {"switch-port/": 2, "transformer-mv/mv": 1}
OTHER_LIMIT = 4


def degree_limit(role: Column) -> Column:
    return F.when(role.startswith("switch-port/"), DEGREE_LIMITS["switch-port/"]).when(role == "transformer-mv/mv", DEGREE_LIMITS["transformer-mv/mv"]).otherwise(OTHER_LIMIT)


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes (case_id, node, role) with their degree (a loop counts twice) and whether it is above the limit of the role."""
    ends = edges.select("case_id", F.col("a").alias("node")).unionByName(edges.select("case_id", F.col("b").alias("node"))).groupBy("case_id", "node").agg(F.count("*").alias("degree"))
    found = nodes.join(ends, ["case_id", "node"], "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    return found.withColumn("above_limit", F.col("degree") > degree_limit(F.col("role")))


def _differing(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys for which a place on the left and one on the right differ in both place and region; a row is a distinct (key, place, region).

    A place on the left has such a partner if some on the right are left over once those of its place, and of its region, are taken away:
    counts by place and by region, never pairs.
    """
    n = lambda *by: right.groupBy(*key, *by).agg(F.count("*").alias("n_" + "_".join(by or ("all",))))
    seen = left.join(n(), key).join(n("place"), [*key, "place"], "left").join(n("region"), [*key, "region"], "left").join(n("place", "region"), [*key, "place", "region"], "left")
    less = lambda c: F.coalesce(c, F.lit(0))
    return seen.where(F.col("n_all") - less("n_place") - less("n_region") + less("n_place_region") > 0).select(*key).distinct()


def crossings(f: Forest, closing: DataFrame, bridges: DataFrame, places: DataFrame) -> DataFrame:
    """Added switch edges whose two sides, with the edge taken out, hold places of different regions: case_id, edge_id, alternate_path.

    ``places``: case_id, node, place, region (several rows where a place is in several regions).  An edge that is no bridge leaves its tree whole, so both
    sides are the tree; a bridge parts the subtree below from the rest of the tree.
    """
    switches = f.edges.where("added and kind = 'switch'").select("case_id", "edge_id")
    in_tree = places.join(f.nodes.select("case_id", "node", "tree"), ["case_id", "node"])
    whole = f.t.save(in_tree.groupBy("case_id", "tree", "place", "region").agg(F.count("*").alias("n")))
    below = subtree_sums(in_tree.select("case_id", "node", "place", "region", F.lit(1).cast("long").alias("n")), f.levels, f.t, ("place", "region"))
    cut = f.t.save(bridges.join(switches, ["case_id", "edge_id"], "left_semi"))
    inner = f.t.save(cut.join(below, ["case_id", "node"]).select("case_id", "tree", "edge_id", "place", "region", "n"))
    outer = cut.join(whole, ["case_id", "tree"]).join(inner.withColumnRenamed("n", "inside"), ["case_id", "tree", "edge_id", "place", "region"], "left").where("n > coalesce(inside, 0)")
    token = lambda df, *key: df.select("case_id", *key, "place", "region")
    parted = _differing(token(inner, "edge_id"), token(outer, "edge_id"), ["case_id", "edge_id"])
    mixed = _differing(token(whole, "tree"), token(whole, "tree"), ["case_id", "tree"])
    around = f.edges.join(switches, ["case_id", "edge_id"], "left_semi").join(cut.select("case_id", "edge_id"), ["case_id", "edge_id"], "left_anti")
    around = around.join(f.nodes.select("case_id", F.col("node").alias("a"), "tree"), ["case_id", "a"]).join(mixed, ["case_id", "tree"], "left_semi")
    return parted.withColumn("alternate_path", F.lit(False)).unionByName(around.select("case_id", "edge_id", F.lit(True).alias("alternate_path")))


def risk_metrics(nodes: DataFrame, edges: DataFrame, heads: DataFrame, regions: DataFrame) -> DataFrame:
    """Risks of a what-if graph by case.  Nodes: case_id, node, role, place; edges: case_id, edge_id, a, b, kind, added; heads: case_id, node;
    regions: place, region (text that begins with the region's own case and a bar).

    Cycles are those of the forest that takes old edges first, so an old cycle keeps its size whatever is added; new ones are closed by added
    edges, and are isolated where the head does not reach them.  Beside them: nodes above the degree that their role allows, edges at
    roles that no path may pass, added switches that join different regions, places in several regions, and foreign regions that the head reaches.
    A case without edges has its nodes counted; edges at nodes that are not given are counted as dangling, and take no further part.
    """
    own = nodes.select("case_id", "node").distinct()
    known = lambda c: own.select("case_id", F.col("node").alias(c), F.lit(True).alias(f"known_{c}"))
    told = edges.join(known("a"), ["case_id", "a"], "left").join(known("b"), ["case_id", "b"], "left").withColumn("dangling", F.col("known_a").isNull() | F.col("known_b").isNull()).drop("known_a", "known_b")
    t = Tables(edges.sparkSession)
    told = t.save(told.withColumn("added", F.coalesce("added", F.lit(False))))
    f = Forest(told.where("not dangling").drop("dangling"), heads, ("added", "edge_id"))
    closing = f.closing()
    bridges = t.save(f.bridges(closing))
    served = f.nodes.join(heads, ["case_id", "node"], "left_semi").select("case_id", "tree").distinct()
    reached = t.save(f.nodes.join(served, ["case_id", "tree"], "left_semi").select("case_id", "node").unionByName(heads.select("case_id", "node")).distinct())

    at = closing.join(reached.select("case_id", F.col("node").alias("a"), F.lit(True).alias("seen")), ["case_id", "a"], "left")
    sizes = at.groupBy("case_id", "size", "added").agg(F.count("*").alias("n"), F.count_if(F.col("seen").isNull()).alias("n_isolated"))
    of = lambda on: F.array_sort(F.collect_list(F.when(on, F.struct("size", "n"))))
    by_size = sizes.groupBy("case_id").agg(F.sum("n").alias("cycles"), F.sum(F.when(F.col("added"), F.col("n")).otherwise(0)).alias("new_cycles"), F.sum(F.when(F.col("added"), F.col("n_isolated")).otherwise(0)).alias("isolated_new_cycles"), of(~F.col("added")).alias("old_sizes"), of(F.col("added")).alias("new_sizes"))

    role = lambda c: nodes.select("case_id", F.col("node").alias(c), F.col("role").isin(SUPPORTED).alias(f"ok_{c}"))
    paths = told.where("not dangling").join(role("a"), ["case_id", "a"]).join(role("b"), ["case_id", "b"]).groupBy("case_id").agg(F.count("*").alias("edges"), F.count_if(~(F.col("ok_a") & F.col("ok_b"))).alias("unsupported"))
    dangling = told.where("dangling").groupBy("case_id").agg(F.count("*").alias("dangling"))
    degree = degrees(nodes, told.where("not dangling")).groupBy("case_id").agg(F.count("*").alias("nodes"), F.max("degree").alias("largest_degree"), F.count_if("above_limit").alias("above_limit"))

    places = t.save(nodes.where("place is not null").select("case_id", "node", "place").join(regions.select("place", "region").distinct(), "place"))
    crossed = crossings(f, closing, bridges, places).groupBy("case_id").agg(F.count("*").alias("crossings"), F.count_if("alternate_path").alias("alternate_crossings"))
    several = places.groupBy("case_id", "node").agg(F.count("*").alias("n")).groupBy("case_id").agg(F.count_if(F.col("n") > 1).alias("shared_places"))
    foreign = places.join(reached, ["case_id", "node"], "left_semi").where(F.substring_index("region", "|", 1) != F.col("case_id").cast("string")).groupBy("case_id").agg(F.count_distinct("region").alias("foreign_regions"))

    out = degree
    for part in (paths, dangling, by_size, crossed, several, foreign):
        out = out.join(part, "case_id", "left")
    counts = [c for c in out.columns if c not in ("case_id", "old_sizes", "new_sizes")]
    pairs = lambda c: F.coalesce(F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["size"].cast("string"), x["n"].cast("string"))), ","), F.lit("")).alias(c)
    return out.select("case_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), pairs("old_sizes"), pairs("new_sizes"))
