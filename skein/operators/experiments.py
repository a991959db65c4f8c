"""What projecting more switches would reach: each strategy, and each of its tie groups alone or left out, with its lines derived again.

Components of the base are found once.  A scenario (a strategy and a variant) is a set of additions that joins their labels only, so the work
follows what the scenarios add, not the scenarios times the base.  Additions carry the set of their scenarios as the bits of one number, and what holds in all
scenarios that have a switch (a line from its port to a node of the base, the way through it) is contracted before any scenario is told apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.operators import decisions, graphs
from skein.operators.tables import Tables

# Names that results carry.
GROUPS = ["normal", "tie", "unknown_type"]
STATES = ["CLOSED", "OPEN", "UNKNOWN"]
IMPACTS = ["reachable_transformers", "cases_with_reachable_transformers", "cases_with_usable_subgraph"]

VARIANTS = ["all", *(f"{how}:{g}" for how in ("only", "without") for g in GROUPS)]
_KEY = ["case_id", "strategy", "variant"]


def tie_group(is_tie: Column) -> Column:
    return F.when(is_tie, "tie").when(~is_tie, "normal").otherwise("unknown_type")


def judged(candidates: DataFrame) -> DataFrame:
    """Candidates (case_id, owner, baseline, inner_exact, safety, state, is_tie) by strategy, with reason, projected, conducting and their tie group."""
    made = decisions.candidate_decisions(candidates, "baseline", "inner_exact", "safety", "state")
    return made.withColumn("tie_group", tie_group(F.col("is_tie"))).withColumn("state", F.coalesce("state", F.lit("UNKNOWN")))


def group_states(made: DataFrame, cases: DataFrame) -> DataFrame:
    """For each case, strategy, tie group and state, zeros included: candidates, those projected, those conducting.  A switch of the base counts as projected.
    States other than the three are left out, as no strategy tells them apart."""
    every = cases.select("case_id").distinct()
    for name, values in (("strategy", decisions.STRATEGIES), ("tie_group", GROUPS), ("state", STATES)):
        every = every.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    key = ["case_id", "strategy", "tie_group", "state"]
    n = made.groupBy(*key).agg(F.count("*").alias("candidate_count"), F.count_if("projected").alias("projected_count"), F.count_if("conducting").alias("conducting_count"))
    return every.join(n, key, "left").na.fill(0, ["candidate_count", "projected_count", "conducting_count"])


def _bits(strategy: Column, group: Column) -> Column:
    """The scenarios of a strategy that have a switch of a tie group: bit number strategy * len(VARIANTS) + variant."""
    of_group = F.lit(0).cast("long")
    for g in GROUPS:
        has = [v == "all" or v == f"only:{g}" or (v.startswith("without:") and v != f"without:{g}") for v in VARIANTS]
        of_group = F.when(group == g, F.lit(sum(1 << i for i, x in enumerate(has) if x)).cast("long")).otherwise(of_group)
    out = F.lit(0).cast("long")
    for i, name in enumerate(decisions.STRATEGIES):
        out = F.when(strategy == name, F.shiftleft(of_group, i * len(VARIANTS))).otherwise(out)
    return out


def _scenarios(bits: Column) -> Column:
    """The numbers of the scenarios in a set, as an array."""
    every = F.array(*map(F.lit, range(len(decisions.STRATEGIES) * len(VARIANTS))))
    return F.filter(every, lambda i: F.call_function("getbit", bits, i) == 1)


def port(owner: Column, side: Column) -> Column:
    """A line that names a switch at its second end comes in there, at its first end it goes out."""
    return F.concat(F.lit("added:"), owner, F.when(side == 2, ":in").otherwise(":out"))


def _additions(t: Tables, lines: DataFrame, chosen: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What switches add: edges (case_id, a, b, bits) between labels of the base, ports that have none counting as such, and nodes with a line of their own
    (case_id, node, bits).

    Lines: case_id, line, node1, node2 (what the base has there), target1, target2 (the switch named there exactly, only where the base has no node).  A line
    stands if both ends have a node or a chosen switch, so a line between two added switches needs both.  A port with lines to nodes of the base is one
    with the least of their labels wherever its switch is added, and the ports of a switch that always conducts are one if only one of them has such a line.
    """
    col = F.col
    switches = chosen.where("owner is not null").groupBy("case_id", "owner").agg(F.bit_or("bits").alias("bits"), F.bit_or(F.when(col("conducting"), col("bits")).otherwise(0)).alias("live"))
    half = [lines.where(f"node{m} is not null and node{n} is null and target{n} is not null").select("case_id", col(f"target{n}").alias("owner"), F.lit(n).alias("side"), col(f"node{m}").alias("node")) for n, m in ((1, 2), (2, 1))]
    half = half[0].unionByName(half[1]).join(labels, ["case_id", "node"], "left").select("case_id", "owner", "side", F.coalesce("component", "node").alias("label"))
    # All about a switch meets in one shuffle: itself (side 0), and its lines to nodes of the base.
    of = Window.partitionBy("case_id", "owner")
    met = half.unionByName(switches.withColumn("side", F.lit(0)), allowMissingColumns=True)
    met = met.select("case_id", "owner", "side", "label", F.max("bits").over(of).alias("bits"), F.max("live").over(of).alias("live"), *(F.min(F.when(col("side") == n, col("label"))).over(of).alias(f"at{n}") for n in (1, 2))).where("case_id is not null and bits is not null")
    own = {n: port(col("owner"), F.lit(n)) for n in (1, 2)}
    whole = F.when(col("live") == col("bits"), F.coalesce("at1", "at2", own[2]))
    met = t.save(met.select("case_id", "owner", "side", "label", "bits", "live", *(F.coalesce(f"at{n}", whole, own[n]).alias(f"at{n}") for n in (1, 2))))
    added = met.where("side = 0").select("case_id", "owner", "bits", "live", "at1", "at2")
    end = lambda n: added.select("case_id", col("owner").alias(f"target{n}"), col(f"at{n}").alias("ab"[n - 1]), col("bits").alias(f"bits{n}"))
    both = lines.where("node1 is null and node2 is null and target1 is not null and target2 is not null").select("case_id", "target1", "target2")
    both = both.join(end(1), ["case_id", "target1"]).join(end(2), ["case_id", "target2"]).select("case_id", "a", "b", col("bits1").bitwiseAND(col("bits2")).alias("bits")).where("bits <> 0")
    both = t.save(both)
    side = F.when(col("side") == 1, col("at1")).otherwise(col("at2"))
    edges = met.where("side > 0").select("case_id", col("label").alias("a"), side.alias("b"), "bits").unionByName(added.where("live <> 0").select("case_id", col("at1").alias("a"), col("at2").alias("b"), col("live").alias("bits"))).unionByName(both)
    edges = edges.where("a <> b").groupBy("case_id", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.bit_or("bits").alias("bits"))
    lined = met.where("side > 0").select("case_id", col("label").alias("node"), "bits").unionByName(both.select("case_id", col("a").alias("node"), "bits"))
    return edges, lined.groupBy("case_id", "node").agg(F.bit_or("bits").alias("bits"))


def coverage(cases: DataFrame, heads: DataFrame, targets: DataFrame, branches: DataFrame, lines: DataFrame, made: DataFrame) -> DataFrame:
    """For each case, strategy and variant: switches projected, conducting and excluded, whether there is a head, whether it reaches a line, transformers reached.

    Cases: case_id, total_switches; heads and targets (transformers): case_id, node; branches of the base: case_id, kind (line or switch), a, b,
    conducting; lines that are no branches: as in ``_additions``, of unique identity and two ends; made: as ``judged`` gives it.  Identities are unique by case.

    A line whose both ends have nodes stands in every scenario.  Of cases only those in ``cases`` are reported; one without a head reaches nothing.  Null case_ids join
    nothing.
    """
    t = Tables(cases.sparkSession)
    col = F.col
    chosen = made.where("projected and not baseline").select("case_id", "strategy", "tie_group", "owner", "conducting", _bits(col("strategy"), col("tie_group")).alias("bits"))
    standing = lines.where("node1 is not null and node2 is not null").select("case_id", F.lit("line").alias("kind"), F.col("node1").alias("a"), F.col("node2").alias("b"), F.lit(True).alias("conducting"))
    base = t.save(branches.select("case_id", "kind", "a", "b", F.coalesce("conducting", F.lit(False)).alias("conducting")).unionByName(standing))
    live = base.where("conducting")
    labels = graphs.components(live.select("case_id", "a", "b"))
    edges, joined = _additions(t, lines, chosen, labels)

    # Of each component of the base: its transformers, whether it has a line, and the scenarios that bring it one.
    label = lambda df: df.join(labels, ["case_id", "node"], "left").select("case_id", F.coalesce("component", "node").alias("node"))
    none = F.lit(0).cast("long")
    worth = label(targets.select("case_id", "node").distinct()).select("case_id", "node", F.lit(1).alias("target"), F.lit(False).alias("lined"), none.alias("bits"))
    worth = worth.unionByName(label(live.where("kind = 'line'").select("case_id", F.col("a").alias("node")).distinct()).select("case_id", "node", F.lit(0).alias("target"), F.lit(True).alias("lined"), none.alias("bits")))
    worth = worth.unionByName(joined.select("case_id", "node", F.lit(0).alias("target"), F.lit(False).alias("lined"), "bits"))
    worth = worth.groupBy("case_id", "node").agg(F.sum("target").alias("targets"), F.max("lined").alias("lined"), F.bit_or("bits").alias("joined"))

    every = cases.select("case_id", "total_switches").withColumn("strategy", F.explode(F.array(*map(F.lit, decisions.STRATEGIES)))).withColumn("variant", F.explode(F.array(*map(F.lit, VARIANTS))))
    added = t.save(edges.select("case_id", "a", "b", F.explode(_scenarios(col("bits"))).alias("scenario")))
    starts = t.save(cases.select("case_id").distinct().join(label(heads.select("case_id", "node").distinct()), "case_id").select("case_id", "node").distinct())
    starts = starts.withColumn("scenario", F.explode(F.array(*map(F.lit, range(len(decisions.STRATEGIES) * len(VARIANTS))))))
    key = F.struct("case_id", "scenario").alias("case_id")
    seen = graphs.reached(starts.select(key, "node"), added.select(key, "a", "b")).select("case_id.*", "node").join(worth, ["case_id", "node"])
    found = seen.groupBy("case_id", "scenario").agg(F.sum("targets").alias("reachable_transformers"), F.max(col("lined") | (F.call_function("getbit", col("joined"), col("scenario")) == 1)).alias("usable"))
    name = lambda names, n: F.element_at(F.array(*map(F.lit, names)), n.cast("int") + 1)
    found = found.select("case_id", name(decisions.STRATEGIES, F.floor(col("scenario") / len(VARIANTS))).alias("strategy"), name(VARIANTS, col("scenario") % len(VARIANTS)).alias("variant"), "reachable_transformers", "usable")

    had = base.where("kind = 'switch'").groupBy("case_id").agg(F.count("*").alias("had"), F.count_if("conducting").alias("had_conducting"))
    more = chosen.groupBy("case_id", "strategy", "bits").agg(F.count("*").alias("more"), F.count_if("conducting").alias("more_conducting"))
    more = more.select("case_id", "strategy", "more", "more_conducting", F.explode(_scenarios(col("bits"))).alias("scenario")).withColumn("variant", name(VARIANTS, col("scenario") % len(VARIANTS)))
    more = more.groupBy(*_KEY).agg(F.sum("more").alias("more"), F.sum("more_conducting").alias("more_conducting"))
    headed = heads.select("case_id", F.lit(True).alias("headed")).distinct()
    out = every.join(had, "case_id", "left").join(more, _KEY, "left").join(headed, "case_id", "left").join(found, _KEY, "left").na.fill(0, ["had", "had_conducting", "more", "more_conducting", "reachable_transformers"])
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    projected = F.col("had") + F.col("more")
    return out.select(
        *_KEY, projected.alias("switch_projected_count"), (F.col("had_conducting") + F.col("more_conducting")).alias("switch_conducting_count"), (F.col("total_switches") - projected).alias("switch_excluded_count"),
        flag(F.col("headed")).alias("cases_with_feeder_head"), flag(F.col("usable")).alias("cases_with_usable_subgraph"), "reachable_transformers", flag(F.col("reachable_transformers") > 0).alias("cases_with_reachable_transformers"),
    )


def group_impact(covered: DataFrame, *by: str) -> DataFrame:
    """By strategy, tie group and ``by``: what the group alone gains over the base, and what is lost without it.  The base is what strategy S0 has."""
    of = lambda variant, name: F.sum(F.when(F.col("variant") == variant, F.col(name)).otherwise(0))
    sums = covered.groupBy(*by, "strategy").agg(*(of(v, name).alias(f"{v}|{name}") for v in VARIANTS for name in IMPACTS))
    base = sums.where("strategy = 'S0'").select(*by, *(F.col(f"`all|{name}`").alias(f"base|{name}") for name in IMPACTS))
    joined = sums.join(base, list(by)) if by else sums.crossJoin(F.broadcast(base))
    col = lambda v, name: F.col(f"`{v}|{name}`")
    rows = F.array(*(F.struct(
        F.lit(g).alias("tie_group"),
        *((col(f"only:{g}", name) - col("base", name)).alias(f"gain_{name}") for name in IMPACTS),
        *((col("all", name) - col(f"without:{g}", name)).alias(f"loss_{name}") for name in IMPACTS),
    ) for g in GROUPS))
    return joined.select(*by, "strategy", F.inline(rows))
