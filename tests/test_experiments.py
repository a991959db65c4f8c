"""Strategies with lines derived again: a line between two switches needs both, groups work together, and all scenarios agree with a plain walk."""

import random

from skein.operators import decisions, experiments as X

CANDIDATE = "case_id int, owner string, baseline boolean, inner_exact boolean, safety string, state string, is_tie boolean"
LINE = "case_id int, line string, node1 string, node2 string, target1 string, target2 string"


def _run(spark, cases, heads, targets, branches, lines, candidates):
    make = spark.createDataFrame
    made = X.judged(make(candidates, CANDIDATE))
    got = X.coverage(make(cases, "case_id int, total_switches int"), make(heads, "case_id int, node string"), make(targets, "case_id int, node string"), make(branches, "case_id int, kind string, a string, b string, conducting boolean"), make(lines, LINE), made)
    return got, made


def _series():
    """head - s1 - s2 - t, with a line between the switches: s1 is normal, s2 a tie.  Case 2 has no head, case 3 no candidates at all."""
    lines = [(c, *x) for c in (1, 2) for x in (("l1", "h", None, None, "s1"), ("l2", None, None, "s1", "s2"), ("l3", None, "t", "s2", None), ("l4", "h", None, None, None))]
    candidates = [(c, s, False, True, "UNKNOWN", "CLOSED", tie) for c in (1, 2) for s, tie in (("s1", False), ("s2", True))]
    return [(1, 2), (2, 2), (3, 0)], [(1, "h"), (3, "h")], [(1, "t"), (2, "t"), (3, "h")], [(1, "line", "h", "x", False)], lines, candidates


def test_switches_in_series_need_each_other(spark):
    got, _ = _run(spark, *_series())
    got = got.cache()
    at = {(r.case_id, r.strategy, r.variant): r for r in got.collect()}
    assert len(at) == 3 * 5 * 7
    whole = at[1, "S2", "all"]
    assert (whole.switch_projected_count, whole.switch_conducting_count, whole.switch_excluded_count, whole.reachable_transformers, whole.cases_with_usable_subgraph) == (2, 2, 0, 1, 1)
    # One switch alone gets the line at its own side, never the line to the other switch.
    alone, other = at[1, "S2", "only:normal"], at[1, "S2", "only:tie"]
    assert (alone.switch_projected_count, alone.reachable_transformers, alone.cases_with_usable_subgraph) == (1, 0, 1)
    assert (other.reachable_transformers, other.cases_with_usable_subgraph) == (0, 0)
    assert all(at[1, "S0", v].switch_projected_count == 0 and at[1, "S0", v].cases_with_usable_subgraph == 0 for v in X.VARIANTS)
    assert all((r.reachable_transformers, r.cases_with_feeder_head, r.cases_with_usable_subgraph) == (0, 0, 0) for k, r in at.items() if k[0] == 2)
    # A target may be the head itself.
    assert all((r.reachable_transformers, r.cases_with_usable_subgraph) == (1, 0) for k, r in at.items() if k[0] == 3)
    impact = {(r.case_id, r.strategy, r.tie_group): r for r in X.group_impact(got, "case_id").collect()}
    assert [(impact[1, "S2", g].gain_reachable_transformers, impact[1, "S2", g].loss_reachable_transformers) for g in X.GROUPS] == [(0, 1), (0, 1), (0, 0)]
    overall = {(r.strategy, r.tie_group): r for r in X.group_impact(got).collect()}
    assert len(overall) == 15 and overall["S2", "normal"].gain_cases_with_usable_subgraph == 1
    got.unpersist()


def test_states_are_zero_filled(spark):
    cases, *_, candidates = _series()
    made = X.judged(spark.createDataFrame([*candidates, (1, "b", True, False, "CONFLICTING", None, None)], CANDIDATE))
    got = {(r.case_id, r.strategy, r.tie_group, r.state): r[4:] for r in X.group_states(made, spark.createDataFrame(cases, "case_id int, total int")).collect()}
    assert len(got) == 3 * 5 * 3 * 3
    assert got[1, "S0", "tie", "CLOSED"] == (1, 0, 0) and got[1, "S1", "tie", "CLOSED"] == (1, 1, 1)
    assert got[1, "S0", "unknown_type", "UNKNOWN"] == (1, 1, 0) and got[3, "S1", "tie", "OPEN"] == (0, 0, 0)


def _walk(nodes, edges):
    seen = set(nodes)
    while True:
        more = {y for a, b in edges for x, y in ((a, b), (b, a)) if x in seen} - seen
        if not more:
            return seen
        seen |= more


def test_random_cases_match_a_walk_of_every_scenario(spark):
    rng = random.Random(5)
    cases, heads, targets, branches, lines, candidates = [], [], [], [], [], []
    for c in range(12):
        nodes = [f"n{i}" for i in range(9)]
        owners = [f"s{i}" for i in range(7)]
        cases.append((c, 9))
        if c % 5:
            heads.append((c, rng.choice(nodes)))
        targets += [(c, n) for n in rng.sample(nodes, 4)]
        branches += [(c, "line", *rng.sample(nodes, 2), rng.random() < 0.8) for _ in range(4)] + [(c, "switch", "n0", "n1", rng.choice([True, False, None]))]
        candidates += [(c, o, o == "s0", rng.random() < 0.8, rng.choice(["COMPATIBLE", "CONFLICTING", "UNKNOWN"]), rng.choice(["CLOSED", "CLOSED", "OPEN", "UNKNOWN", None]), rng.choice([True, False, None])) for o in owners]
        for i in range(16):
            ends = [(rng.choice(nodes), None) if rng.random() < 0.45 else (None, rng.choice([*owners[1:], None])) for _ in (1, 2)]
            lines.append((c, f"l{i}", ends[0][0], ends[1][0], ends[0][1], ends[1][1]))
    got, made = _run(spark, cases, heads, targets, branches, lines, candidates)
    chosen = [(r.case_id, r.strategy, r.owner, r.tie_group, r.conducting) for r in made.where("projected and not baseline").collect()]
    want = {}
    for c, _ in cases:
        for s in decisions.STRATEGIES:
            for v in X.VARIANTS:
                how, _, g = v.partition(":")
                on = {o: closed for case, strategy, o, group, closed in chosen if (case, strategy) == (c, s) and (how == "all" or (group == g) == (how == "only"))}
                base = [b for b in branches if b[0] == c]
                place = lambda node, target, side, on=on: f"{target}:{side}" if target in on else node
                wires = [(x[2], x[3]) for x in base if x[1] == "line" and x[4]]
                wires += [w for w in ((place(x[2], x[4], "out"), place(x[3], x[5], "in")) for x in lines if x[0] == c) if None not in w]
                gear = [(x[2], x[3]) for x in base if x[1] == "switch" and x[4]] + [(f"{o}:in", f"{o}:out") for o, closed in on.items() if closed]
                start = [n for case, n in heads if case == c]
                seen = _walk(start, wires + gear)
                n = sum(case == c and t in seen for case, t in targets)
                had = [x[4] for x in base if x[1] == "switch"]
                projected = len(had) + len(on)
                want[c, s, v] = (projected, sum(map(bool, had)) + sum(on.values()), 9 - projected, len(start), int(any(a in seen for a, _ in wires)), n, int(n > 0))
    assert {(r.case_id, r.strategy, r.variant): tuple(r[3:]) for r in got.collect()} == want
    assert len({w[5] for w in want.values()}) > 2


def test_no_candidates_and_no_rows(spark):
    got, made = _run(spark, [(1, 0)], [(1, "h")], [], [], [], [])
    assert {tuple(r[3:]) for r in got.collect()} == {(0, 0, 0, 1, 0, 0, 0)}
    none, _ = _run(spark, [], [], [], [], [], [])
    assert none.count() == 0 and made.count() == 0


def test_scenarios_take_an_edge_for_a_switch(spark, monkeypatch):
    """Ports and lines to nodes of the base are contracted before scenarios are told apart: a closed switch is one edge in each that has it, an open one none."""
    asked, reached = [], X.graphs.reached
    monkeypatch.setattr(X.graphs, "reached", lambda heads, edges: asked.append(edges.count()) or reached(heads, edges))
    candidates = [(1, f"s{i}", False, True, "UNKNOWN", "CLOSED" if i % 2 else "OPEN", bool(i % 3)) for i in range(20)]
    lines = [x for i in range(20) for x in ((1, f"l{i}", f"n{i}", None, None, f"s{i}"), (1, f"m{i}", None, f"n{i + 1}", f"s{i}", None))]
    got, _ = _run(spark, [(1, 20)], [(1, "n1")], [(1, f"n{i}") for i in range(21)], [], lines, candidates)
    at = {(r.strategy, r.variant): r for r in got.collect()}
    # n1 and n2 hang together by s1, a tie; every closed switch is in four strategies, and in four variants of each.
    assert asked == [10 * 4 * 4]
    assert [at["S1", v].reachable_transformers for v in ("all", "only:tie", "without:tie")] == [2, 2, 1] and at["S0", "all"].reachable_transformers == 1
    assert at["S1", "without:tie"].cases_with_usable_subgraph == 1 and at["S1", "only:unknown_type"].cases_with_usable_subgraph == 0
