"""Rows of all kinds become equipment, terminals, details and windings; repeated and conflicting ids, and what is wrong with a field, stay visible."""

from pyspark.sql import functions as F

from skein.operators import equipment as E

RAW = "archive string, case_key string, member string, data_row long, record_ref string, fields array<string>, diagnostic string"


def _rows(spark, *rows):
    return spark.createDataFrame([("a.zip", "c1", f"c1/{E.FILES[kind]}" if kind in E.FILES else kind, n, f"{kind}#{n}", list(fields), wrong) for n, (kind, fields, wrong) in enumerate(rows, 1)], RAW)


TRANSFORMER = ["t1", "a", "", "", "100", "10", "0.4", "1", "2", "D", "yn", "3", "r"]


def test_every_kind_has_its_ends_and_details(spark):
    rows = _rows(
        spark, ("SWITCH", ["s1", "a", "", "", "Closed", "TRUE", "630", "maybe", "", "", "", ""], None), ("DISCONNECTOR", ["d1", "a", "b", "Open"], None), ("EARTHING_SWITCH", ["e1", "a", "half"], None),
        ("ACCESS_POINT", ["p1", "a", "", "x", "0"], None), ("LINE", ["l1", "a", "b", "", "", "m", "0", "1", "2", "1.5"], None), ("TRANSFORMER", TRANSFORMER, None), ("LOAD", ["w1", "1e5", "", "1", "2", "-1.5"], None),
        ("DER", ["g1", "a", "", "PV", "-1", "5", "1", "", "q"], None), ("c1/02_Bus.csv", ["b"], None), ("LINE", ["l2"], "WIDTH_MISMATCH"))
    made = E.mapped(rows)
    got = {r.kind: r for r in made.collect()}
    assert len(got) == 8 and got["LINE"].source_id == "l1"
    assert [got[k].ends for k in ("SWITCH", "EARTHING_SWITCH", "LINE", "LOAD")] == [["a", None], ["a"], ["a", "b"], ["1e5"]]
    device = got["SWITCH"].switching_device
    assert (device.normal_state, device.observed_state, device.is_tie, int(device.rated_current_a), device.measurement_capable) == ("CLOSED", None, True, 630, None)
    assert got["DISCONNECTOR"].switching_device.normal_state == "OPEN" and got["EARTHING_SWITCH"].switching_device.observed_state == "UNKNOWN"
    assert got["LINE"].line.number_of_circuits is None and got["LINE"].transformer is None and got["DER"].der.der_type == "PV"
    wrong = {k: [(i.field, i.code) for i in r.issues] for k, r in got.items()}
    assert wrong["SWITCH"] == [("Switch_HasMeasurement", "SOURCE_VALUE_PARSE_FAILED")] and wrong["EARTHING_SWITCH"] == [("EarthingSwitch_State", "SOURCE_ENUM_UNKNOWN")]
    assert wrong["LINE"] == [("Line_Length_km", "SOURCE_VALUE_OUT_OF_RANGE"), ("Line_NumCircuits", "SOURCE_VALUE_PARSE_FAILED")]
    assert wrong["LOAD"] == [("Load_Bus", "SOURCE_IDENTIFIER_SUSPICIOUS_FORMAT"), ("Load_PF", "SOURCE_VALUE_OUT_OF_RANGE")] and wrong["DER"] == [("DER_RatedCapacity_kVA", "SOURCE_VALUE_OUT_OF_RANGE")]
    assert wrong["ACCESS_POINT"] == wrong["TRANSFORMER"] == []
    done = E.assembled(made).cache()
    joined = E.windings(done).join(E.terminals(done).select("terminal_id", "terminal_no", "raw_ref", "ref_status"), "terminal_id").collect()
    assert sorted((r.winding_no, r.terminal_no, float(r.rated_voltage_kv), r.connection, r.raw_ref, r.ref_status) for r in joined) == [(1, 1, 10.0, "D", "a", "UNRESOLVED"), (2, 2, 0.4, "yn", None, "MISSING")]
    assert E.terminals(done).count() == 2 + 2 + 1 + 1 + 2 + 2 + 1 + 1
    done.unpersist()


def test_repeated_ids(spark):
    """Equal rows publish the first place and keep all their issues about it; differing ones publish nothing; ids of other kinds are other ids."""
    odd = [*TRANSFORMER[:5], "0", *TRANSFORMER[6:]]
    other = ["t2", *TRANSFORMER[1:]]
    done = E.assembled(E.mapped(_rows(spark, ("TRANSFORMER", odd, None), ("TRANSFORMER", odd, None), ("TRANSFORMER", other, None), ("TRANSFORMER", [*other[:12], "s"], None), ("DISCONNECTOR", ["t1", "a", "b", ""], None), ("LOAD", ["", "a", "", "1", "2", "1"], None), ("LOAD", ["", "a", "", "1", "2", "1"], None)))).cache()
    rows = {r.data_row: r for r in done.collect()}
    assert [rows[i].published for i in range(1, 8)] == [True, False, False, False, True, False, False]
    assert rows[1].equipment_id == rows[2].equipment_id is not None and rows[3].equipment_id is None and rows[6].equipment_id is None
    assert len({rows[1].equipment_id, rows[5].equipment_id}) == 2
    found = E.issues(done).collect()
    assert sorted((r.data_row, r.code, r.equipment_id is not None) for r in found) == [
        (1, "SOURCE_ID_DUPLICATE_IDENTICAL", True), (1, "SOURCE_VALUE_OUT_OF_RANGE", True), (2, "SOURCE_ID_DUPLICATE_IDENTICAL", True), (2, "SOURCE_VALUE_OUT_OF_RANGE", True),
        (3, "SOURCE_ID_DUPLICATE_CONFLICT", False), (4, "SOURCE_ID_DUPLICATE_CONFLICT", False), (6, E.MISSING_ID, False), (7, E.MISSING_ID, False)]
    assert len({r.issue_id for r in found}) == len(found)
    assert sorted(r.category for r in E.row_categories(done).collect()) == ["DUPLICATE"] * 4 + ["MAPPED"] + ["REJECTED"] * 2
    assert E.windings(done).count() == 2
    done.unpersist()


def test_no_rows(spark):
    done = E.assembled(E.mapped(spark.createDataFrame([], RAW)))
    assert done.count() == E.terminals(done).count() == E.windings(done).count() == E.issues(done).count() == 0


def test_windings_meet_their_terminals_without_a_join(spark):
    """Windings with their terminals and details are what joining them gives, and read the assembled rows once."""
    other = ["t2", "", "b", "", "0", "10", "x", "1", "2", "D", "yn", "3", "r"]
    rows = _rows(spark, ("TRANSFORMER", TRANSFORMER, None), ("TRANSFORMER", TRANSFORMER, None), ("TRANSFORMER", other, None), ("TRANSFORMER", ["t3", *other[1:]], None), ("TRANSFORMER", ["t3", *TRANSFORMER[1:]], None), ("LINE", ["l1", "a", "b", "", "", "m", "0", "1", "2", "1.5"], None))
    done = E.assembled(E.mapped(rows)).localCheckpoint()
    at = E.terminals(done).select("terminal_id", "raw_ref", "ref_status")
    rated = done.select("equipment_id", "transformer.rated_capacity_kva").distinct()
    want = E.windings(done).join(at, "terminal_id").join(rated, "equipment_id")
    got = E.windings_at(done).withColumn("rated_capacity_kva", F.col("transformer.rated_capacity_kva")).select(want.columns)
    assert got.count() == 4 and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
