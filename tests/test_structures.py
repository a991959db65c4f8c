import zipfile
from io import BytesIO

import pytest
from pyspark.sql import functions as F

from skein.operators import graphs, imports, references, rules
from skein.sinks import artifacts
from skein.sources import archives, registry


def _edges(spark, *pairs):
    return spark.createDataFrame([(1, f"e{i:02}", a, b) for i, (a, b) in enumerate(pairs)], "case_id int, edge_id string, a string, b string")


def test_strong_components(spark):
    e = _edges(spark, "ab", "bc", "ca", "cd", "de", "ed", "ef", "gg")
    assert {r.node: r.component for r in graphs.strong_components(e).collect()} == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d", "f": "f", "g": "g"}
    assert graphs.strong_components(e.limit(0)).count() == 0


def test_cycle_basis_counts_loops_and_parallels(spark):
    e = _edges(spark, "ab", "ab", "bc", "cd", "da", "xx", "yz")
    got = sorted(r.length for r in graphs.cycle_basis(e).collect())
    assert got == [1, 2, 4]
    assert sum(r.cycle_rank for r in graphs.cycle_rank(e).collect()) == len(got)


def test_relation_of_pairs(spark):
    e = _edges(spark, "ab", "bc", "cd", "xy")
    pairs = spark.createDataFrame([(1, p, q) for p, q in ("aa", "ab", "ac", "ad", "ax")] + [(1, "a", None), (1, "q", "a")], "case_id int, first string, second string")
    got = {(r.first, r.second): (r.distance, r.witness) for r in graphs.relation(pairs, e).collect()}
    assert got == {("a", "a"): ("0", None), ("a", "b"): ("1", None), ("a", "c"): ("2", "b"), ("a", "d"): ("GT2", None), ("a", "x"): ("DISCONNECTED", None), ("a", None): ("UNRESOLVED", None), ("q", "a"): ("DISCONNECTED", None)}


def test_open_cut_bypass(spark):
    cuts = _edges(spark, "ac", "ax", "zz")
    got = {r.a + r.b: (r.before, r.after, r.bypassed) for r in graphs.bypassed(cuts, _edges(spark, "ab").drop("edge_id"), _edges(spark, "ab", "bc").drop("edge_id")).collect()}
    assert got == {"ac": (False, True, True), "ax": (False, False, False), "zz": (True, True, False)}


@pytest.mark.parametrize("ends, motif", [(("1", "2", "1", "2"), "DIRECT"), (("1", "2", "2", "1"), "REVERSE"), (("1", "2", None, ""), "BOTH_MISSING"), (("1", "2", "", "2"), "X_MISSING"), (("1", "2", "3", None), "Y_MISSING"), (("1", "2", "3", "3"), "X_EQUALS_Y"), (("1", "2", "1", "3"), "X_A_ONLY"), (("1", "2", "3", "1"), "Y_A_ONLY"), (("1", "2", "3", "4"), "BOTH_DIFFERENT"), ((None, None, "3", "4"), "BOTH_DIFFERENT"), (("1", "1", "1", "3"), "OTHER_PARTIAL")])
def test_motifs(spark, ends, motif):
    df = spark.createDataFrame([ends], "a string, b string, x string, y string")
    assert df.select(rules.motif(*map(F.col, "abxy"))).collect()[0][0] == motif


def test_references_across_cases(spark):
    refs = spark.createDataFrame([(1, 1, "x"), (2, 2, "x"), (3, 3, "y"), (4, 1, "z"), (5, 1, None)], "reference_id int, case_id int, ref string")
    entities = spark.createDataFrame([(1, "x"), (2, "x"), (2, "x"), (3, "y"), (3, "y")], "case_id int, ref string")
    got = {r.reference_id: (r.n_local, r.n_foreign, r.classification) for r in references.across_cases(refs, entities).collect()}
    assert got == {1: (1, 2, "MULTIPLE_EXTERNAL"), 2: (2, 1, "UNIQUE_EXTERNAL"), 3: (2, 0, "LOCAL_UNRESOLVED_ONLY"), 4: (0, 0, "UNDEFINED_GLOBAL"), 5: (0, 0, "UNDEFINED_GLOBAL")}


@pytest.mark.parametrize("kind, text, value, code", [("positive", "10.5", "10.5", None), ("positive", "-1", "-1", "SOURCE_VALUE_OUT_OF_RANGE"), ("number", "ten", None, "SOURCE_VALUE_PARSE_FAILED"), ("number", "", None, None), ("factor", "1.2", "1.2", "SOURCE_VALUE_OUT_OF_RANGE"), ("integer", "2.5", None, "SOURCE_VALUE_PARSE_FAILED"), ("integer", "3", "3", None), ("boolean", "TRUE", "true", None), ("boolean", "yes", None, "SOURCE_VALUE_PARSE_FAILED"), ("state", "Open", "OPEN", None), ("state", "ajar", "UNKNOWN", "SOURCE_ENUM_UNKNOWN"), ("reference", "0", "0", "SOURCE_REFERENCE_INVALID_LITERAL"), ("identifier", "1E5", "1E5", "SOURCE_IDENTIFIER_SUSPICIOUS_FORMAT"), ("phase", "A", None, "SOURCE_ENUM_UNKNOWN")])
def test_converters(spark, kind, text, value, code):
    got = spark.createDataFrame([(text,)], "t string").select(*(c.cast("string") for c in imports.convert(kind, F.col("t")))).collect()[0]
    plain = got[0].rstrip("0").rstrip(".") if got[0] and "." in got[0] else got[0]
    assert (plain, got[1]) == (value, code)


def test_archives_are_the_same_bytes_and_keep_their_rows(spark):
    body = {"cases/n1/05_Feeder.csv": b"\xef\xbb\xbf" + ",".join(registry.header("05_Feeder.csv")).encode() + b'\r\nf1,"a, ""b""\nc",b1\r\nf2,x', "cases/n1/zz.csv": b"q\n1\n"}
    raw = artifacts.archive_bytes(body)
    assert raw == artifacts.archive_bytes(dict(reversed(body.items()))) and zipfile.ZipFile(BytesIO(raw)).testzip() is None
    files = spark.createDataFrame([("a.zip", bytearray(raw))], "path string, content binary")
    rows = archives.read_contents(files, registry.headers())
    got = imports.typed(rows, "05_Feeder.csv").collect()
    assert [(r.Feeder_ID, r.Feeder_Name, r.data_row) for r in got] == [("f1", 'a, "b"\nc', 1)]
    assert {(r.member[-6:], r.known) for r in archives.inventory(files).collect()} == {("er.csv", True), ("zz.csv", False)}
    assert imports.case_status(rows, ["05_Feeder.csv", "02_Bus.csv"]).select("n_diagnostics", "n_missing", "status").collect()[0] == (1, 1, "INCOMPLETE")


def test_locators(spark):
    refs = [archives.record_ref("cäse n/05 Feeder.csv", 3), "zip-member:../x.csv#data-row=1", "zip-member:/x.csv#data-row=1", "zip-member:C:/x.csv#data-row=1", "zip-member:x.csv#data-row=0", "x", None]
    got = spark.createDataFrame([(r,) for r in refs], "r string").select(*archives.locate(F.col("r"))).collect()
    assert [tuple(r) for r in got] == [("cäse n/05 Feeder.csv", 3)] + [(None, None)] * 6


def test_artifacts_are_written_once_and_verified(spark, tmp_path):
    path = str(tmp_path / "made")
    df = spark.createDataFrame([(2, "b", None), (1, "a", "1.50")], "n int, t string, v string").withColumn("v", F.col("v").cast("decimal(9,2)"))
    artifacts.write_once(df, path, ["n"])
    assert spark.read.text(f"{path}/records").orderBy("value").collect()[0].value == '{"n":1,"t":"a","v":"1.50"}'
    assert artifacts.verify(spark, path).count() == 0
    with pytest.raises(FileExistsError):
        artifacts.write_once(df, path, ["n"])
    part = next((tmp_path / "made" / "records").glob("part-*"))
    part.write_bytes(part.read_bytes().replace(b'"a"', b'"z"'))
    (tmp_path / "made" / "records" / f".{part.name}.crc").unlink(missing_ok=True)
    assert [r.violation for r in artifacts.verify(spark, path).collect()] == ["CHECKSUM_MISMATCH"]
    with pytest.raises(TypeError):
        artifacts.canonical_json(df.withColumn("f", F.lit(1.5)))


def test_appended_records_leave_the_original_bytes(spark):
    df = spark.createDataFrame([(bytearray(x),) for x in (b"a\r\n", b"a\n", b"a", b"")], "o binary")
    rows = F.array(F.encode(F.lit("x"), "UTF-8"), F.encode(F.lit("y"), "UTF-8"))
    assert [bytes(r[0]) for r in df.select(artifacts.append_records(F.col("o"), rows)).collect()] == [b"a\r\nx\r\ny\r\n", b"a\nx\r\ny\r\n", b"a\r\nx\r\ny\r\n", b"x\r\ny\r\n"]
    assert bytes(df.select(artifacts.append_records(F.col("o"), F.slice(rows, 1, 0))).collect()[2][0]) == b"a"


def test_settings_and_measurements(spark):
    s = spark.createDataFrame([("c", "k", "1"), ("c", "k", "1"), ("c", "m", "1"), ("c", "m", "2")], "case_key string, key string, value string")
    assert {(r.name, r.value, r.conflicting) for r in imports.settings(s, ["case_key"], "key", "value").collect()} == {("k", "1", False), ("m", None, True)}
    m = spark.createDataFrame([("c", 1.0, None, "2024-01-01T00:00:00+08:00"), ("d", 2.0, 3.0, "2024-01-01T00:00:00")], "case_key string, i double, p double, at string")
    assert {(r.case_key, r.time_known, r.metric, r.value) for r in imports.measurements(m, ["case_key"], ["i", "p"], "at").collect()} == {("c", True, "i", 1.0), ("d", False, "i", 2.0), ("d", False, "p", 3.0)}
