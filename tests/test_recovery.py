"""Recovery of a direct pair of lines at a switch, and what keeps others out: each change of the fixture has its reason."""

import random

from skein.operators import graphs, recovery, scans
from skein.plans import networks

ACCOUNT = "case_id int, kind string, record string, entity_id string, unique boolean, end1 string, end2 string, state string, tie string, voltage string"


def _fixture():
    row = lambda kind, name, a=None, b=None, state=None, tie=None, voltage=None: (1, kind, f"r-{name}", name, True, a, b, state, tie, voltage)
    return {"a": row("BUS", "a", voltage="10"), "b": row("BUS", "b", voltage="10.5"), "s": row("SWITCH", "s", "a", "b", "Closed", "FALSE"), "in": row("LINE", "in", "a", "s"), "out": row("LINE", "out", "s", "b"), "t": row("TRANSFORMER", "t"), "u": row("TRANSFORMER", "u", "a")}


def _judge(spark, cases):
    """One call for all: each case is (rows, options); returns judged devices and lines by case."""
    rows = [(i, *r[1:]) for i, (own, _) in enumerate(cases) for r in own]
    told = [(i, o.get("hard"), o.get("headed", True), o.get("malformed", False)) for i, (_, o) in enumerate(cases)]
    accounts = spark.createDataFrame(rows, ACCOUNT)
    about = spark.createDataFrame(told, "case_id int, hard array<string>, headed boolean, malformed boolean").selectExpr("*", "cast(10.5 as decimal(38,18)) as nominal")
    kept = spark.createDataFrame([(i, *k) for i, (_, o) in enumerate(cases) for k in o.get("kept", ())], "case_id int, kind string, entity_id string")
    judged = graphs._cut(recovery.candidates(accounts, about, kept))
    ports = spark.createDataFrame([(i, *p) for i in range(len(cases)) for p in (("r-in", 1, "node-a"), ("r-out", 2, "node-b"))], "case_id int, record string, side int, node string")
    lines = recovery.recovered_lines(accounts, about, judged, ports, spark.createDataFrame([], "case_id int, line_id string")).collect()
    by = lambda got, i: [r for r in got if r.case_id == i]
    found = judged.collect()
    return [({r.key: r for r in by(found, i)}, sorted((r.line_id, r.a, r.b, r.n_dependencies) for r in by(lines, i))) for i in range(len(cases))]


def _with(**changes):
    rows = _fixture()
    names = [c.split()[0] for c in ACCOUNT.split(", ")]
    for key, change in changes.items():
        rows[key] = tuple(change.get(n, v) for n, v in zip(names, rows[key]))
    return list(rows.values())


def test_a_direct_pair_is_accepted_with_its_lines(spark):
    rows, mixed = _with(), _with()
    random.Random(1).shuffle(mixed)
    (got, lines), (other, same) = _judge(spark, [(rows, {}), (mixed, {})])
    assert (got["s"].variant, got["s"].status, got["s"].reasons, got["s"].conducting) == ("SERIES_EXACT_DIRECT", "ACCEPTED", ["EXACT_DIRECT_SERIES"], True)
    assert lines == [("in", "node-a", "s:in", 1), ("out", "s:out", "node-b", 1)]
    # A transformer that nothing names is no candidate; one that names a bus is to be reviewed.
    assert "t" not in got and got["u"].reasons == ["DECLARED_REFERENCE_PORT_SEMANTICS_UNPROVEN"]
    assert same == lines and {k: r[1:] for k, r in other.items()} == {k: r[1:] for k, r in got.items()}


CHANGES = [
    ({"s": {"end1": "b", "end2": "a"}}, [], {}, "NEEDS_REVIEW", ["DIRECT_DECLARATIONS_REQUIRED"]),
    ({"s": {"state": "Ajar"}}, [], {}, "NEEDS_REVIEW", ["KNOWN_STATE_REQUIRED"]),
    ({"s": {"tie": ""}}, [], {}, "NEEDS_REVIEW", ["ORDINARY_SWITCH_REQUIRED"]),
    ({"b": {"voltage": "110"}}, [], {}, "REJECTED", ["INCOMPATIBLE_VOLTAGE"]),
    ({"b": {"unique": False}}, [], {}, "NEEDS_REVIEW", ["EXACT_OUTER_REFERENCE_REQUIRED"]),
    ({"b": {"kind": "REGION"}}, [], {}, "NEEDS_REVIEW", ["UNSUPPORTED_OUTER_ENTITY_TYPE"]),
    ({"out": {"unique": False}}, [], {}, "REJECTED", ["FULL_UNIQUE_INCIDENCE_REQUIRED"]),
    ({"out": {"end1": "b", "end2": "s"}}, [], {}, "NEEDS_REVIEW", ["INCIDENCE_DIRECTION_REQUIRED"]),
    ({}, [(1, "LINE", "r-x", "x", True, "s", "b", None, None, None)], {}, "REJECTED", ["FULL_UNIQUE_INCIDENCE_REQUIRED", "INCIDENCE_DIRECTION_REQUIRED", "INCIDENCE_NOT_SUPPORTED"]),
    ({}, [(1, "SWITCH", "r-s2", "s", True, "a", "b", "Closed", "FALSE", None)], {}, "REJECTED", ["IDENTITY_NOT_UNIQUE"]),
    ({}, [(1, "BUS", "r-s2", "s", True, None, None, None, None, None)], {}, "REJECTED", ["IDENTITY_NOT_UNIQUE"]),
    ({}, [], {"hard": ["TWO_FEEDERS"]}, "REJECTED", ["TWO_FEEDERS"]),
    ({}, [], {"headed": False}, "NEEDS_REVIEW", ["ACCEPTED_HEAD_REQUIRED"]),
    ({}, [], {"malformed": True}, "REJECTED", ["MALFORMED_LINE_EVIDENCE"]),
    ({}, [], {"kept": [("SWITCH", "s")]}, "BASELINE_PRESERVED", ["EXISTING_V1_SWITCH"]),
]


def test_what_keeps_a_switch_out(spark):
    got = _judge(spark, [(_with(**changes) + more, options) for changes, more, options, _, _ in CHANGES])
    for (found, lines), (*_, status, reasons) in zip(got, CHANGES):
        assert (found["s"].status, found["s"].reasons, lines) == (status, reasons, [])


def test_a_leaf_may_name_nothing_remote(spark):
    leaf, remote = ([r for r in rows if r[3] != "out"] for rows in (_with(s={"end2": ""}), _with()))
    (got, lines), (other, none) = _judge(spark, [(leaf, {}), (remote, {})])
    assert (got["s"].family, got["s"].status, lines) == (recovery.LEAF, "ACCEPTED", [("in", "node-a", "s:in", 1)])
    assert (other["s"].reasons, none) == (["REMOTE_ENDPOINT_NOT_EMPTY"], [])


def test_lines_of_a_device_are_counted_by_name(spark):
    """Rows that share a name count once at a device, whichever of identity and record the name is, and so does a line of which both ends name it."""
    r = random.Random(5)
    rows = [(r.randrange(3), "LINE", r.choice(["x1", "x2", f"r{i}"]), r.choice([None, "", f"l{i % 40}", f"l{i}"]), True, r.choice(["d0", "d1", "d2", "b", ""]), r.choice(["d0", "d1", "d2", None]), None, None, None) for i in range(300)]
    rows += [(c, "SWITCH", f"r-{k}", k, True, "b", "", "Open", "false", None) for c in range(3) for k in ("d0", "d1", "d2", "d3")]
    cases = spark.createDataFrame([(c, None, True, False) for c in range(3)], "case_id int, hard array<string>, headed boolean, malformed boolean").selectExpr("*", "cast(10.5 as decimal(38,18)) as nominal")
    judged = recovery.candidates(spark.createDataFrame(rows, ACCOUNT), cases, spark.createDataFrame([], "case_id int, kind string, entity_id string"))
    want = {(c, k): {line[3] or line[2] for line in rows if line[0] == c and line[1] == "LINE" and k in line[5:7]} for c in range(3) for k in ("d0", "d1", "d2", "d3")}
    assert {(g.case_id, g.key): g.n_lines for g in judged.collect()} == {k: len(v) for k, v in want.items()}


def test_a_filter_lets_all_wanted_keys_pass(spark):
    rows = spark.range(2000).selectExpr("id % 7 as case_id", "cast(id as string) as a", "case when id % 3 = 0 then cast(id + 1 as string) end as b")
    wanted = spark.createDataFrame([(3, "3"), (4, "4"), (1, "1000")], "case_id int, key string")
    got = {r.a for r in scans.possible(rows, [["case_id", "a"], ["case_id", "b"]], wanted, 3).collect()}
    assert {"3", "4"} <= got and len(got) < 200
    assert not scans.possible(rows, [["case_id", "a"]], wanted.where("false"), 0).count()


def _stages(spark) -> dict[int, int]:
    """Bytes that each stage has written to shuffles."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    stages = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}


def test_lines_are_dealt_once_by_name_and_once_by_ends(spark, tmp_path):
    """What is shuffled for a line stays small: texts are summed up before devices meet them, and lines follow after a filter of the accepted few."""
    d = "/root/testdata/sf0.01"
    n = spark.read.parquet(f"{d}/lineitem.parquet").count()
    for q in (networks.q86_recovered_lines, networks.q85_recovery_candidates):
        last = max(_stages(spark))
        q(spark, d).write.parquet(str(tmp_path / q.__name__))
        assert sum(b for k, b in _stages(spark).items() if k > last) < 80 * n, q.__name__
