"""What additions would do to a graph: labels of the base's components are found once, and the additions join labels only.

Layers: every edge is physical; conducting ones alone are the conducting layer.  The work after the base's components follows the additions,
not the base.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators import graphs
from skein.operators.tables import Tables

LAYERS = ("physical", "conducting")


def _layered(edges: DataFrame) -> DataFrame:
    """Each edge (case_id, a, b, closed) in its layers: layer, case_id, a, b."""
    closed = F.when(F.coalesce("closed", F.lit(False)), F.array(*map(F.lit, LAYERS))).otherwise(F.array(F.lit(LAYERS[0])))
    return edges.select(F.explode(closed).alias("layer"), "case_id", "a", "b")


def _labels(edges: DataFrame) -> DataFrame:
    """(layer, case_id, node, label) of the nodes that have edges in a layer: one call for all layers."""
    key = F.struct("layer", "case_id")
    found = graphs.components(edges.select(key.alias("case_id"), "a", "b"))
    return found.select("case_id.layer", "case_id.case_id", "node", F.col("component").alias("label"))


class Overlay:
    """Components of a base and of the base with additions.

    ``labels``: layer, case_id, node, before, after, for all ``nodes`` (case_id, node) and all ends of edges; a node without edges is a component of its own.
    """

    def __init__(self, nodes: DataFrame, base: DataFrame, additions: DataFrame):
        self.t = Tables(base.sparkSession)
        self.base, self.additions = self.t.save(base), self.t.save(additions)
        ends = lambda df, c: df.select("case_id", F.col(c).alias("node"))
        every = nodes.select("case_id", "node")
        for df in (self.base, self.additions):
            every = every.unionByName(ends(df, "a")).unionByName(ends(df, "b"))
        layers = F.explode(F.array(*map(F.lit, LAYERS))).alias("layer")
        every = every.distinct().select(layers, "case_id", "node")
        known = _labels(_layered(self.base))
        self.before = self.t.save(every.join(known, ["layer", "case_id", "node"], "left").select("layer", "case_id", "node", F.coalesce("label", "node").alias("before")))
        over = self.lift(_layered(self.additions), self.before, "before").select("layer", "case_id", F.col("before_a").alias("a"), F.col("before_b").alias("b"))
        self.joined = self.t.save(over)
        top = _labels(self.joined.where("a <> b")).select("layer", "case_id", F.col("node").alias("before"), F.col("label").alias("after"))
        self.labels = self.t.save(self.before.join(top, ["layer", "case_id", "before"], "left").withColumn("after", F.coalesce("after", "before")))

    @staticmethod
    def lift(edges: DataFrame, labels: DataFrame, *columns: str) -> DataFrame:
        """Edges (layer, case_id, a, b and more) with the labels of both ends."""
        for side in ("a", "b"):
            edges = edges.join(labels.select("layer", "case_id", F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns)), ["layer", "case_id", side])
        return edges

    def bypassed(self) -> DataFrame:
        """Open edges of the base (case_id, edge_id and the like) whose ends hang together only with the additions."""
        cuts = self.base.where("not coalesce(closed, false)").withColumn("layer", F.lit("conducting"))
        return self.lift(cuts, self.labels, "before", "after").where("before_a <> before_b and after_a = after_b").select(*self.base.columns)

    def ranks(self) -> DataFrame:
        """By layer and case: additions, how many of them join components, and so by how much the cycle rank grows."""
        made = self.joined.groupBy("layer", "case_id").agg(F.count("*").alias("additions"))
        parts = self.labels.groupBy("layer", "case_id").agg(F.count_distinct("before").alias("components_before"), F.count_distinct("after").alias("components_after"))
        out = parts.join(made, ["layer", "case_id"], "left").withColumn("additions", F.coalesce("additions", F.lit(0)))
        merges = F.col("components_before") - F.col("components_after")
        return out.withColumn("rank_delta", F.col("additions") - merges)


def diagnostics(nodes: DataFrame, base: DataFrame, additions: DataFrame, heads: DataFrame) -> DataFrame:
    """For each case what the additions would change: cycle ranks of both layers, open edges bypassed, components with several heads, numbers of components and the largest.

    Base and additions: case_id, a, b, closed; heads: case_id, node.  A graph across cases is one case of its own: give all rows one case_id.
    Heads that are no nodes count for nothing.
    """
    o = Overlay(nodes, base, additions)
    ranks = o.ranks()
    one = lambda layer, *columns: ranks.where(F.col("layer") == layer).select("case_id", *columns)
    out = one("physical", F.col("rank_delta").alias("physical_rank_delta"), F.col("components_before"), F.col("components_after"))
    out = out.join(one("conducting", F.col("rank_delta").alias("conducting_rank_delta")), "case_id")
    headed = o.labels.where("layer = 'conducting'").join(heads.select("case_id", "node").distinct(), ["case_id", "node"], "left_semi")
    several = None
    for when in ("before", "after"):
        n = headed.groupBy("case_id", when).agg(F.count("*").alias("n")).where("n > 1").groupBy("case_id").agg(F.count("*").alias(f"several_{when}"))
        largest = o.labels.where("layer = 'physical'").groupBy("case_id", when).agg(F.count("*").alias("n")).groupBy("case_id").agg(F.max("n").alias(f"largest_{when}"))
        out = out.join(n, "case_id", "left").join(largest, "case_id", "left")
    cuts = o.bypassed().groupBy("case_id").agg(F.count("*").alias("open_cuts_bypassed"))
    out = out.join(cuts, "case_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    several = (zero("several_after") - zero("several_before")).alias("new_multiple_head_components")
    return out.select("case_id", "physical_rank_delta", "conducting_rank_delta", zero("open_cuts_bypassed").alias("open_cuts_bypassed"), several, "components_before", "components_after", "largest_before", "largest_after")


# Why a proposal is withdrawn, and how its anchors end.
PARALLEL, CYCLE, BYPASS = "PARALLEL_DUPLICATE_DECLARATION_NOT_REPRESENTABLE", "PLACEMENT_WOULD_CREATE_CYCLE", "PLACEMENT_WOULD_BYPASS_OPEN_CUT"
UNUSED_ANCHOR, GATED_ANCHOR = "WITHDRAWN_UNUSED_ANCHOR", "WITHDRAWN_BY_CYCLE_GATE"


def gate_placements(base_nodes: DataFrame, base: DataFrame, proposals: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Withdraw what may not be placed: decisions on proposals (with reason, null where they stay) and on anchors (with status).

    Proposals: case_id, line_id, a, b; anchors: case_id, anchor_id, in_port, out_port (null: one port), closed.  Order of withdrawal:
    a group of proposals between the same two ends goes whole; then a case whose additions, ports and what joins them included, would raise a cycle rank, or
    else close a way around an open edge of the base, loses all that are left; then anchors that no proposal attaches to go.  Nothing ever picks one of several.
    The base is labelled once; proposals and anchors join its labels.  A case without proposals left has nothing to be gated for.
    """
    t = Tables(base.sparkSession)
    pair = [F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")]
    alone = proposals.select("*", *pair)
    twins = alone.groupBy("case_id", "low", "high").agg(F.count("*").alias("n"))
    first = t.save(alone.join(twins, ["case_id", "low", "high"]).withColumn("reason", F.when(F.col("n") > 1, PARALLEL)).drop("low", "high", "n"))
    left = first.where("reason is null").select("case_id", "a", "b", F.lit(True).alias("closed"))
    asked = left.select("case_id").distinct()
    inner = anchors.where("out_port is not null").join(asked, "case_id", "left_semi").select("case_id", F.col("in_port").alias("a"), F.col("out_port").alias("b"), "closed")
    ports = anchors.join(asked, "case_id", "left_semi").select("case_id", F.explode(F.array_compact(F.array("in_port", "out_port"))).alias("node"))
    own = lambda df: df.join(asked, "case_id", "left_semi")
    o = Overlay(own(base_nodes).select("case_id", "node").unionByName(ports), own(base).select("case_id", "a", "b", "closed"), left.unionByName(inner))
    cycles = o.ranks().groupBy("case_id").agg(F.max(F.col("rank_delta") > 0).alias("cycle"))
    cuts = o.bypassed().select("case_id", F.lit(True).alias("cut")).distinct()
    gate = cycles.join(cuts, "case_id", "left").select("case_id", F.when(F.col("cycle"), CYCLE).when(F.col("cut"), BYPASS).alias("gate"))
    decided = t.save(first.join(gate, "case_id", "left").withColumn("reason", F.coalesce("reason", "gate")).drop("gate"))
    used = decided.where("reason is null").select("case_id", F.explode(F.array("a", "b")).alias("port")).distinct()
    port = anchors.select("case_id", "anchor_id", F.explode(F.array_compact(F.array("in_port", "out_port"))).alias("port"))
    held = port.join(used, ["case_id", "port"], "left_semi").select("case_id", "anchor_id", F.lit(True).alias("held")).distinct()
    gone = gate.where("gate is not null").select("case_id", F.lit(True).alias("gated"))
    status = F.when(F.col("gated"), GATED_ANCHOR).when(F.col("held"), "PROPOSED").otherwise(UNUSED_ANCHOR)
    kept = anchors.join(gone, "case_id", "left").join(held, ["case_id", "anchor_id"], "left").withColumn("status", status).drop("gated", "held")
    return decided, kept


# How a proposed edge fares when it is worked out again.
STILL, SUPERSEDED, AMBIGUOUS, INVALID, NEW = "STILL_VALID", "SUPERSEDED_BY_BETTER_PLACEMENT", "NOW_AMBIGUOUS", "INVALID", "NEW_ON_PLACEMENT_COUNTERFACTUAL"


def replay(before: DataFrame, after: DataFrame, reasons: DataFrame, reachable: str, ambiguous: list[str]) -> DataFrame:
    """Edges (case_id, edge_id, a, b) of two workings matched by their ends whatever their order: case_id, edge_id, origin, status.

    ``reasons``: case_id, reason, of the second working.  An edge of the first is still valid if its pair stands in the second; superseded if its case is ``reachable``
    already or has other edges; ambiguous for one of the ``ambiguous`` reasons; else invalid.  Edges of the second that the first lacks, ends in order, are new.
    """
    pair = lambda df: df.select("case_id", F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct()
    same = pair(after).withColumn("same", F.lit(True))
    some = after.select("case_id", F.lit(True).alias("some")).distinct()
    told = reasons.groupBy("case_id").agg(F.max(F.col("reason") == reachable).alias("near"), F.max(F.col("reason").isin(ambiguous)).alias("doubt"))
    old = before.withColumn("low", F.least("a", "b")).withColumn("high", F.greatest("a", "b")).join(same, ["case_id", "low", "high"], "left").join(some, "case_id", "left").join(told, "case_id", "left")
    status = F.when(F.col("same"), STILL).when(F.col("near") | F.col("some"), SUPERSEDED).when(F.col("doubt"), AMBIGUOUS).otherwise(INVALID)
    new = after.join(before.select("case_id", "a", "b").distinct(), ["case_id", "a", "b"], "left_anti")
    return old.select("case_id", "edge_id", F.lit("BEFORE").alias("origin"), status.alias("status")).unionByName(new.select("case_id", "edge_id", F.lit("NEW").alias("origin"), F.lit(NEW).alias("status")))
