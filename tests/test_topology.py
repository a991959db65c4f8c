"""Interpretation of a small feeder, and what each change of its rows keeps out."""

from skein.operators import topology

ACCOUNT = "case_id int, kind string, record string, entity_id string, unique boolean, name string, end1 string, end2 string, state string, voltage string"
COLUMNS = [c.split()[0] for c in ACCOUNT.split(", ")]


def _rows():
    row = lambda kind, name, a=None, b=None, state=None, voltage=None: dict(zip(COLUMNS, (1, kind, f"r-{name}", name, True, "plain", a, b, state, voltage)))
    return {"f": row("FEEDER", "f", "head"), "st": row("STATION", "st"), "head": row("BUS", "head", "st"), "j": row("BUS", "j", voltage="10"), "l1": row("LINE", "l1", "st", "sw"), "sw": row("SWITCH", "sw", state="Closed"), "l2": row("LINE", "l2", "sw", "j"), "l3": row("LINE", "l3", "j", "t"), "t": row("TRANSFORMER", "t")}


def _run(spark, cases):
    """One call for all: each case is a change of the rows of its own."""
    out, names = [], []
    for i, (change, more, name) in enumerate(cases):
        rows = _rows()
        for key, values in change.items():
            rows[key] = rows[key] | values
        out += [r | {"case_id": i} for r in (*rows.values(), *({**dict.fromkeys(COLUMNS), "unique": True, **m} for m in more))]
        names.append((i, name))
    accounts = spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in out], ACCOUNT)
    return topology.interpret(accounts, spark.createDataFrame(names, "case_id int, name string").selectExpr("*", "cast(10.5 as decimal(38,18)) as fallback"))


def test_a_feeder_from_head_to_transformer(spark):
    got = _run(spark, [({}, [], "feeder 10kV")])
    why = {(r.rule, r.owner, r.side): r.reason for r in got.decisions.collect()}
    assert set(why.values()) == {None} and len(why) == 1 + 2 + 6 + 3
    assert {r.node: r.role for r in got.nodes.collect()} == {"head:f": "feeder-head/mv", "switch:sw:in": "switch-port/in", "switch:sw:out": "switch-port/out", "bus:j": "junction/bus", "transformer:t": "transformer-mv/mv"}
    assert {(r.a, r.b, r.conducting) for r in got.branches.collect()} == {("head:f", "switch:sw:in", True), ("switch:sw:in", "switch:sw:out", True), ("switch:sw:out", "bus:j", True), ("bus:j", "transformer:t", True)}
    assert got.reached().count() == 5


CHANGES = [
    ({"sw": {"state": "Open"}}, [], "x", ("SWITCH", "sw", None), None, 2),
    ({"l1": {"end1": "missing"}}, [], "x", ("LINE_END", "r-l1", 1), "UNRESOLVED_REFERENCE", 1),
    ({"l1": {"end1": ""}}, [], "x", ("LINE_END", "r-l1", 1), "MISSING_REFERENCE", 1),
    ({"j": {"voltage": "20"}}, [], "x", ("LINE_END", "r-l2", 2), "BUS_VOLTAGE_CONFLICT", 3),
    ({"j": {"voltage": "ten"}}, [], "x", ("LINE_END", "r-l2", 2), "INVALID_VOLTAGE_EVIDENCE", 3),
    ({"j": {"voltage": "20"}}, [], "20 kV", ("LINE_END", "r-l2", 2), None, 5),
    ({}, [], "10kV and 20kV", ("SWITCH", "sw", None), "NAME_VOLTAGE_CONFLICT", 0),
    ({"sw": {"end1": "st"}}, [], "x", ("SWITCH", "sw", None), "EXPLICIT_ENDPOINT_EVIDENCE", 1),
    ({"l2": {"end1": "j", "end2": "sw"}}, [], "x", ("SWITCH", "sw", None), "SWITCH_DIRECTION", 1),
    ({"l3": {"end1": "t", "end2": "j"}}, [], "x", ("TRANSFORMER", "t", None), "TRANSFORMER_DIRECTION", 4),
    ({}, [{"kind": "LINE", "record": "r-l4", "entity_id": "l4", "end1": "sw", "end2": "j"}], "x", ("SWITCH", "sw", None), "SWITCH_DEGREE", 1),
    ({}, [{"kind": "LINE", "record": "r-l2b", "entity_id": "l2", "end1": "j", "end2": "j"}], "x", ("SWITCH", "sw", None), "INCIDENT_IDENTITY_CONFLICT", 1),
    ({}, [{"kind": "LINE", "record": "r-bad"}], "x", ("TRANSFORMER", "t", None), "INCOMPLETE_LINE_EVIDENCE", 1),
    ({}, [{"kind": "SWITCH", "record": "r-sw2", "entity_id": "sw"}], "x", ("SWITCH", "sw", None), "IDENTITY_NOT_UNIQUE", 1),
    ({}, [{"kind": "BUS", "record": "r-sw2", "entity_id": "sw"}], "x", ("LINE_END", "r-l2", 1), "AMBIGUOUS_REFERENCE", 1),
    ({"head": {"end1": "other"}}, [], "x", ("LINE_END", "r-l1", 1), "STATION_CHAIN_MISMATCH", 1),
    ({"f": {"end1": "gone"}}, [], "x", ("LINE_END", "r-l1", 1), "NO_FEEDER_HEAD", 0),
    ({}, [{"kind": "FEEDER", "record": "r-g", "entity_id": "g", "end1": "head"}], "x", ("FEEDER_HEAD", "f", None), "AMBIGUOUS_FEEDER", 0),
    ({}, [{"kind": "ACCESS_POINT", "record": "r-ap", "entity_id": "ap"}], "x", ("ACCESS_POINT", "ap", None), "ACCESS_POINT_UNSUPPORTED", 5),
]


def test_what_a_stage_rejects(spark):
    got = _run(spark, [c[:3] for c in CHANGES])
    said = got.decisions.collect()
    why = {(r.case_id, r.rule, r.owner, r.side): r.reason for r in said}
    reached = {r.case_id: r["count"] for r in got.reached().groupBy("case_id").count().collect()}
    for i, (*_, decision, reason, n) in enumerate(CHANGES):
        assert (i, why[(i, *decision)], reached.get(i, 0)) == (i, reason, n)
    assert all((r.reason is None) == (r.status == "PROJECTED") for r in said)


def test_lines_are_written_once(spark, monkeypatch):
    """Beside the accounts, written tables hold each line once: neither its ends nor what is repeated nowhere are written again."""
    made, save = [], topology.Tables.save
    monkeypatch.setattr(topology.Tables, "save", lambda self, df: made.append(save(self, df)) or made[-1])
    lines = spark.range(300).selectExpr("id % 3 AS case_id", "'LINE' AS kind", "concat('l', id) AS record", "concat('l', id) AS entity_id", "true AS unique", "'' AS name", "concat('b', id % 30) AS end1", "concat('b', id % 29) AS end2", "'' AS state", "'' AS voltage")
    cases = spark.range(3).selectExpr("id AS case_id", "'10 kV' AS name", "cast(10.5 AS decimal(38, 18)) AS fallback")
    got = topology.interpret(lines, cases)
    assert sum(df.count() for df in made) <= 2 * 300 + 2 * 3
    assert got.decisions.where("rule = 'LINE_END'").count() == 600 and got.decisions.where("rule = 'LINE' and reason = 'LINE_ENDPOINT_EXCLUDED'").count() == 300
