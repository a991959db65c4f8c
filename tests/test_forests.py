"""Forests, bridges, risks, overlays and closures against plain searches on small random graphs, and rounds on a long path."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from skein.operators import forests, graphs, overlays
from skein.operators.tables import Tables

EDGE = "case_id int, edge_id string, a string, b string, kind string, added boolean"


def _graph(seed, nodes=14, edges=22, cases=9):
    r = random.Random(seed)
    out = []
    for case in range(cases):
        for i in range(edges - 7 * (case % 3)):
            a, b = (f"n{r.randrange(nodes):02}" for _ in "ab")
            out.append((case, f"e{i:02}", a, b, r.choice(["line", "switch"]), r.random() < 0.5))
    r.shuffle(out)
    return out


def _search(edges, start, without=None):
    near = defaultdict(set)
    for e in edges:
        if e[1] != without:
            near[e[2]].add(e[3])
            near[e[3]].add(e[2])
    seen, left = {start}, [start]
    while left:
        for x in near[left.pop()] - seen:
            seen.add(x)
            left.append(x)
    return seen


def _by_case(edges):
    out = defaultdict(list)
    for e in edges:
        out[e[0]].append(e)
    return out


def _basis(edges):
    """Edge to cycle size: an edge closes a cycle if smaller edges of the tree already join its ends."""
    tree, out = [], {}
    for e in sorted(edges, key=lambda e: (e[5], e[1])):
        hops, left = {e[2]: 0}, [e[2]]
        for x in left:
            for f in tree:
                for p, q in ((f[2], f[3]), (f[3], f[2])):
                    if p == x and q not in hops:
                        hops[q] = hops[x] + 1
                        left.append(q)
        if e[3] in hops:
            out[e[1]] = hops[e[3]] + 1
        else:
            tree.append(e)
    return out


def test_cycle_sizes(spark):
    edges = _graph(1)
    got = {(r.case_id, r.edge_id): r.length for r in forests.cycle_sizes(spark.createDataFrame(edges, EDGE), ("added", "edge_id")).collect()}
    assert got == {(c, k): n for c, own in _by_case(edges).items() for k, n in _basis(own).items()}
    breadth = graphs.cycle_basis(spark.createDataFrame(edges, EDGE)).groupBy("case_id").count().collect()
    assert {r.case_id: r["count"] for r in breadth} == Counter(c for c, _ in got)


def test_every_blocked_edge(spark):
    edges = _graph(4, edges=16)
    heads, targets = [(c, ["n00", "n03", "zz"][c % 3]) for c in range(9)], [(c, f"n{i:02}") for c in range(9) for i in range(0, 14, 3)]
    df = spark.createDataFrame(edges, EDGE)
    got = {(r.case_id, r.edge_id): (r.bridge, r.lost_nodes, r.lost_targets) for r in forests.blocked_edges(df, spark.createDataFrame(heads, "case_id int, node string"), spark.createDataFrame(targets, "case_id int, node string")).collect()}
    want = {}
    for case, own in _by_case(edges).items():
        head = dict(heads)[case]
        full = _search(own, head)
        for e in own:
            lost = full - _search(own, head, e[1])
            want[case, e[1]] = (e[3] not in _search(own, e[2], e[1]), len(lost), len(lost & {t for c, t in targets if c == case}))
    assert got == want and any(x[1] > 1 for x in want.values())


def _risks(nodes, edges, head, regions):
    """Roles and places by node, as a search for each edge finds them."""
    basis, seen = _basis(edges), _search(edges, head)
    new = {e[1] for e in edges if e[5]}
    degree = Counter(x for e in edges for x in (e[2], e[3]))
    limit = lambda role: 2 if role.startswith("switch-port/") else 1 if role == "transformer-mv/mv" else 4
    tokens = lambda ns: {(nodes[n][1], r) for n in ns for r in regions.get(nodes[n][1], ())}
    cross = Counter()
    for e in edges:
        if e[5] and e[4] == "switch":
            left, right = (tokens(_search(edges, x, e[1])) for x in (e[2], e[3]))
            if any(p != q and r != s for p, r in left for q, s in right):
                cross[e[3] in _search(edges, e[2], e[1])] += 1
    case = str(edges[0][0])
    return {
        "nodes": len(nodes), "edges": len(edges), "cycles": len(basis), "new_cycles": len(new & set(basis)), "isolated_new_cycles": sum(e[1] in basis and e[5] and e[2] not in seen for e in edges),
        "largest_degree": max(degree.values()), "above_limit": sum(degree[n] > limit(r) for n, (r, _) in nodes.items()), "unsupported": sum(not {nodes[e[2]][0], nodes[e[3]][0]} <= set(forests.SUPPORTED) for e in edges),
        "crossings": sum(cross.values()), "alternate_crossings": cross[True], "shared_places": sum(len(regions.get(p, ())) > 1 for _, p in nodes.values()), "foreign_regions": len({r for _, r in tokens(seen) if r.split("|")[0] != case}), "dangling": 0,
        **{f"{k}_sizes": ",".join(f"{s}:{n}" for s, n in sorted(Counter(basis[e] for e in basis if (e in new) == (k == "new")).items())) for k in ("old", "new")},
    }


def test_risk_metrics(spark):
    edges = _graph(6, nodes=16, edges=18)
    r = random.Random(6)
    roles = [*forests.SUPPORTED, "other"]
    nodes = {(c, f"n{i:02}"): (r.choice(roles), f"p{i % 7}" if i % 2 else None) for c in range(9) for i in range(16)}
    regions = {f"p{i}": r.sample(["0|a", "0|b", "1|a", "2|c"], r.choice([0, 1, 1, 2])) for i in range(7)}
    df = lambda rows, s: spark.createDataFrame(rows, s)
    got = forests.risk_metrics(df([(*k, *v) for k, v in nodes.items()], "case_id int, node string, role string, place string"), df(edges, EDGE), df([(c, "n01") for c in range(9)], "case_id int, node string"), df([(p, x) for p, rs in regions.items() for x in rs], "place string, region string")).collect()
    for row in got:
        own = _by_case(edges)[row.case_id]
        want = _risks({n: v for (c, n), v in nodes.items() if c == row.case_id}, own, "n01", regions)
        assert {k: row[k] for k in want} == want
    assert len(got) == 9


def test_risks_of_a_new_parallel_loop_and_regions(spark):
    """An old edge, a new parallel and a new loop at a node of its own; then one new switch between two regions, and between two names of one."""
    df = lambda rows, s: spark.createDataFrame(rows, s)
    nodes = df([(1, n, "junction/bus", n) for n in "abc"], "case_id int, node string, role string, place string")
    heads, none = df([(1, "a")], "case_id int, node string"), df([], "place string, region string")
    edges = [(1, "base", "a", "b", "line", False), (1, "parallel", "a", "b", "line", True), (1, "loop", "c", "c", "line", True)]
    row, = forests.risk_metrics(nodes, df([*edges, (1, "far", "a", "zz", "line", True)], EDGE), heads, none).collect()
    assert (row.new_cycles, row.new_sizes, row.old_sizes, row.isolated_new_cycles, row.largest_degree, row.dangling) == (2, "1:1,2:1", "", 1, 2, 1)
    switch = df([(1, "s", "a", "b", "switch", True)], EDGE)
    row, = forests.risk_metrics(nodes, switch, heads, df([("a", "1|f"), ("b", "9|f")], "place string, region string")).collect()
    assert (row.crossings, row.alternate_crossings, row.foreign_regions) == (1, 0, 1)
    shared = df([(1, n, "junction/bus", "same") for n in "ab"], "case_id int, node string, role string, place string")
    row, = forests.risk_metrics(shared, switch, heads, df([("same", "1|f"), ("same", "9|f")], "place string, region string")).collect()
    assert (row.crossings, row.shared_places) == (0, 2)


def test_a_long_path_takes_few_rounds(spark, monkeypatch):
    n, made = 3000, []
    monkeypatch.setattr(Tables, "count", lambda self, df, c, f=Tables.count: made.append(1) or f(self, df, c))
    names = [f"n{i:05}" for i in range(n)]
    random.Random(3).shuffle(names)
    edges = spark.createDataFrame([(1, f"e{i:05}", names[i], names[i + 1], "line", False) for i in range(n - 1)], EDGE)
    heads = spark.createDataFrame([(1, names[0])], "case_id int, node string")
    assert graphs.reached(heads, edges).count() == n and len(made) <= 40
    made.clear()
    got = forests.blocked_edges(edges, heads, heads.limit(0))
    assert sorted(r.lost_nodes for r in got.collect()) == list(range(1, n)) and len(made) <= 110


def test_hops_and_empty_graphs(spark):
    edges = spark.createDataFrame([(1, f"e{i}", a, b, "line", False) for i, (a, b) in enumerate(["ab", "bc", "cd", "ad", "xx"])], EDGE)
    heads = spark.createDataFrame([(1, "a"), (2, "q")], "case_id int, node string")
    assert {(r.case_id, r.node): r.hops for r in graphs.reach(heads, edges).collect()} == {(1, "a"): 0, (1, "b"): 1, (1, "d"): 1, (1, "c"): 2, (2, "q"): 0}
    assert graphs.reach(heads, edges, most=1).count() == 4 and graphs.reached(heads, edges).count() == 5
    none = edges.limit(0)
    assert graphs.components(none).count() == forests.cycle_sizes(none).count() == forests.blocked_edges(none, heads, heads).count() == graphs.cycle_basis(none).count() == 0


BASE = "case_id int, a string, b string, closed boolean"


def test_diagnostics(spark):
    df = lambda rows, s=BASE: spark.createDataFrame(rows, s)
    nodes = df([(1, x) for x in "abcd"] + [(2, "a")], "case_id int, node string")
    heads = df([(1, "a"), (1, "b"), (1, "gone")], "case_id int, node string")
    got = {r.case_id: r for r in overlays.diagnostics(nodes, df([(1, "a", "b", False), (1, "b", "c", True)]), df([(1, "a", "c", True)]), heads).collect()}
    assert got[1].asDict() == {"case_id": 1, "physical_rank_delta": 1, "conducting_rank_delta": 0, "open_cuts_bypassed": 1, "new_multiple_head_components": 1, "components_before": 2, "components_after": 2, "largest_before": 3, "largest_after": 3}
    assert (got[2].physical_rank_delta, got[2].components_before, got[2].largest_after) == (0, 1, 1)


def test_diagnostics_against_searches(spark, seed=1):
    r = random.Random(seed)
    row = lambda k: [(k, f"{x}", e[2], e[3], "", r.random() < 0.6) for x, e in enumerate(_graph(seed + 10 * k, 12, 9, 1))]
    base, more = row(0), [(0, f"m{x}", e[2], e[3], "", e[5]) for x, e in enumerate(row(3))]
    nodes = [f"n{i:02}" for i in range(12)]
    df = lambda rows, s=BASE: spark.createDataFrame([(e[0], e[2], e[3], e[5]) for e in rows], s)
    got, = overlays.diagnostics(spark.createDataFrame([(0, n) for n in nodes], "case_id int, node string"), df(base), df(more), spark.createDataFrame([(0, n) for n in nodes[::3]], "case_id int, node string")).collect()
    live = lambda es: [e for e in es if e[5]]
    parts = lambda es: {frozenset(_search(es, n)) for n in nodes}
    rank = lambda es: len(es) - len(nodes) + len(parts(es))
    heads = lambda es: sum(len(p & set(nodes[::3])) > 1 for p in parts(es))
    cut = sum(e[3] not in _search(live(base), e[2]) and e[3] in _search(live(base + more), e[2]) for e in base if not e[5])
    assert tuple(got)[1:] == (rank(base + more) - rank(base), rank(live(base + more)) - rank(live(base)), cut, heads(live(base + more)) - heads(live(base)), len(parts(base)), len(parts(base + more)), max(map(len, parts(base))), max(map(len, parts(base + more))))


def test_gates(spark):
    """Case 1: a parallel pair goes whole, and its anchor; 2: a way around an open edge; 3: a ring of lines that declare each other; 4: one that stays, with
    an anchor of two ports of which one is used, and an anchor that nothing uses."""
    df = lambda rows, s: spark.createDataFrame(rows, s)
    nodes = df([(c, f"j{i}") for c in (1, 2, 3, 4, 5) for i in (1, 2)], "case_id int, node string")
    base = df([(2, "j1", "j2", False), (5, "j1", "j2", True)], BASE)
    lines = [(1, "L1", "j1", "A1"), (1, "L2", "A1", "j1"), (2, "L1", "j1", "S1i"), (2, "L2", "S1o", "j2"), (3, "L1", "j1", "A"), (3, "L2", "A", "B"), (3, "L3", "B", "j1"), (4, "L1", "j1", "S1i"), (5, "L1", "j1", "A"), (5, "L2", "A", "j2")]
    anchors = [(1, "A1", "A1", None, True), (2, "S1", "S1i", "S1o", True), (3, "A", "A", None, True), (3, "B", "B", None, True), (4, "S1", "S1i", "S1o", False), (4, "X", "X1", None, True), (5, "A", "A", None, True)]
    made, kept = overlays.gate_placements(nodes, base, df(lines, "case_id int, line_id string, a string, b string"), df(anchors, "case_id int, anchor_id string, in_port string, out_port string, closed boolean"))
    why = {(r.case_id, r.line_id): r.reason for r in made.collect()}
    # A way around an open edge closes a physical ring too, so the ring is told first.
    assert why == {(c, x): w for c, xs, w in ((1, "12", overlays.PARALLEL), (2, "12", overlays.CYCLE), (3, "123", overlays.CYCLE), (4, "1", None), (5, "12", overlays.CYCLE)) for x in map("L".__add__, xs)}
    status = {(r.case_id, r.anchor_id): r.status for r in kept.collect()}
    assert status == {(1, "A1"): overlays.UNUSED_ANCHOR, (2, "S1"): overlays.GATED_ANCHOR, (3, "A"): overlays.GATED_ANCHOR, (3, "B"): overlays.GATED_ANCHOR, (4, "S1"): "PROPOSED", (4, "X"): overlays.UNUSED_ANCHOR, (5, "A"): overlays.GATED_ANCHOR}


def test_replay(spark):
    df = lambda rows, s="case_id int, edge_id string, a string, b string": spark.createDataFrame(rows, s)
    got = overlays.replay(df([(c, f"o{c}", "h", "x") for c in range(1, 6)]), df([(1, "n1", "x", "h"), (3, "n3", "h", "y")]), df([(2, "REACHABLE"), (4, "SEVERAL"), (5, "else")], "case_id int, reason string"), "REACHABLE", ["SEVERAL"])
    assert {(r.edge_id, r.status) for r in got.collect()} == {("o1", overlays.STILL), ("o2", overlays.SUPERSEDED), ("o3", overlays.SUPERSEDED), ("o4", overlays.AMBIGUOUS), ("o5", overlays.INVALID), ("n1", overlays.NEW), ("n3", overlays.NEW)}


def test_incidence_components(spark):
    rows = [(1, 10, ["x", "y"]), (1, 11, ["y", None]), (1, 12, ["", None]), (1, 13, ["z"]), (2, 14, ["y"]), (1, 15, []), (1, 16, None)] + [(3, i, ["hub", f"own{i}"]) for i in range(500)]
    got = {(r.case_id, r.row_id): r.component for r in graphs.incidence_components(spark.createDataFrame(rows, "case_id int, row_id long, names array<string>")).collect()}
    assert got == {(1, 10): 10, (1, 11): 10, (1, 12): 12, (1, 13): 13, (2, 14): 14, (1, 15): 15, (1, 16): 16} | {(3, i): 0 for i in range(500)}


def test_closures_by_seed(spark):
    ways = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("b", "a"), ("x", "x"), ("p", "q"), ("p", "r"), ("q", "s"), ("r", "s")], "source string, target string")
    seeds = spark.createDataFrame([("a",), ("c",), ("x",), ("p",), ("lost",), ("a",)], "seed string")
    told = lambda most: sorted((r.seed, r.node, r.depth, r.depth_exceeded) for r in graphs.closure(seeds, ways, most).collect())
    assert told(2) == [("a", "b", 1, False), ("a", "c", 2, False), ("a", "d", 3, True), ("c", "d", 1, False), ("c", "e", 2, False), ("p", "q", 1, False), ("p", "r", 1, False), ("p", "s", 2, False)]
    assert [x for x in told(0) if x[0] == "a"] == [("a", "b", 1, True)]
    with pytest.raises(ValueError):
        graphs.closure(seeds, ways, -1)


def test_branches_are_worked_out_once(spark, monkeypatch):
    """Queries that use their branches twice give operators a written table, so line items meet their orders once; and they meet no customers, as orders do."""
    from skein.plans import catalogue, networks

    d, given = "/root/testdata/sf0.001", []
    monkeypatch.setattr(networks.forests, "blocked_edges", lambda edges, heads, targets: given.extend((edges, targets)))
    monkeypatch.setattr(networks.forests, "cycle_sizes", lambda edges, order: given.append(edges) or edges.select("case_id", "edge_id", F.lit(1).alias("length")))
    networks.q75_blocked_edges(spark, d)
    given.append(networks.q76_fundamental_cycles(spark, d))
    assert len(given) == 4 and not any("lineitem" in f for df in given for f in df.inputFiles())
    plan = catalogue.traffic(spark, d)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda name: next(len(line) - len(line.lstrip(" :+-")) for line in plan if "Relation" in line and f"{name}#" in line)
    assert depth("c_custkey") > depth("l_partkey")
