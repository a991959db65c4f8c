"""Equipment from source rows: one row becomes a piece of equipment, its terminals, its details and, for transformers, two windings.

All kinds go through one projection of one scan: a row's file tells its kind, and the details of other kinds are null.  Identity takes one shuffle by case, kind and id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import columns as C
from skein.operators import identity
from skein.operators.imports import FACTS, convert
from skein.sources import registry

# Kinds and their files, details by kind, and codes that issues carry.
FILES = {"SWITCH": "03_Switch.csv", "DISCONNECTOR": "04_Disconnector.csv", "EARTHING_SWITCH": "06_EarthingSwitch.csv", "ACCESS_POINT": "07_AccessPoint.csv", "LINE": "08_Line.csv", "TRANSFORMER": "09_Transformer.csv", "LOAD": "10_Load.csv", "DER": "11_DER.csv"}
_DEVICE = {"normal_state": "NormalState", "observed_state": "State", "is_tie": "IsTie", "rated_current_a": "RatedCurrent_A", "measurement_capable": "HasMeasurement"}
DETAILS = {
    "switching_device": (["SWITCH", "DISCONNECTOR", "EARTHING_SWITCH"], _DEVICE),
    "line": (["LINE"], {"line_type": "Type", "model": "Model", "length_km": "Length_km", "r1_ohm_per_km": "R1_ohm_per_km", "x1_ohm_per_km": "X1_ohm_per_km", "number_of_circuits": "NumCircuits"}),
    "transformer": (["TRANSFORMER"], {"rated_capacity_kva": "RatedCapacity_kVA", "r_pct": "R_pct", "x_pct": "X_pct", "number_of_taps": "NumTaps", "tap_range_raw": "TapRange"}),
    "access_point": (["ACCESS_POINT"], {"user_type": "UserType", "contract_capacity_kva": "ContractCapacity_kVA"}),
    "load": (["LOAD"], {"active_power_kw": "P_kW", "reactive_power_kvar": "Q_kVAR", "power_factor": "PF"}),
    "der": (["DER"], {"der_type": "Type", "rated_capacity_kva": "RatedCapacity_kVA", "rated_power_kw": "RatedPower_kW", "power_factor": "PF", "connection": "ConnType", "control_mode": "ControlMode"}),
}
WINDINGS = {1: ("HighVoltage_kV", "ConnHV"), 2: ("LowVoltage_kV", "ConnLV")}
MISSING_ID, DUPLICATE_IDENTICAL, DUPLICATE_CONFLICT = "SOURCE_REQUIRED_VALUE_MISSING", "SOURCE_ID_DUPLICATE_IDENTICAL", "SOURCE_ID_DUPLICATE_CONFLICT"
#: Types of details whose field some kinds of a group do not have.
_TYPES = {"state": "string", "boolean": "boolean", "positive": "decimal(38,18)"}


def _field(kind: str, ending: str) -> str | None:
    names = registry.header(FILES[kind])
    name = f"{names[0].removesuffix('_ID')}_{ending}"
    return name if name in names else None


def _made(kind: str) -> dict[str, tuple[Column, Column, Column]]:
    """Of each field of a kind: text, value, code of its issue."""
    texts = {n: F.get("fields", F.lit(i)) for i, n in enumerate(registry.header(FILES[kind]))}
    return {n: (t, *convert(registry.converter(n), t)) for n, t in texts.items()}


def mapped(rows: DataFrame) -> DataFrame:
    """Rows of equipment files read in full: FACTS, kind, source_id, ends (an array of raw references, null where absent), a struct of details by kind, windings, issues, fields.

    Rows of other files and rows with a diagnostic are left to their own operators.  A text that does not convert leaves null and an issue (field, code, observed); an empty id leaves a null source_id
    and MISSING_ID.  Values out of range are kept, with their issue.
    """
    file = F.substring_index("member", "/", -1)
    every = {kind: _made(kind) for kind in FILES}
    kinds = F.create_map(*(F.lit(x) for kind, f in FILES.items() for x in (f, kind)))
    kind = F.col("kind")

    def of_kind(what: dict[str, Column]) -> Column:
        out = F.lit(None)
        for k, v in what.items():
            out = F.when(kind == k, v).otherwise(out)
        return out

    def ends(k: str) -> Column:
        return F.array(*(F.when(t != "", t) for n, (t, _, _) in every[k].items() if registry.converter(n) == "reference"))

    def found(k: str) -> Column:
        issue = lambda n, code, t: F.when(code.isNotNull(), F.struct(F.lit(n).alias("field"), code.alias("code"), t.alias("observed")))
        first, (text, _, _) = next(iter(every[k].items()))
        none = F.coalesce(text, F.lit("")) == ""
        return F.array_compact(F.array(issue(first, C.issue(none, MISSING_ID), F.coalesce(text, F.lit(""))), *(issue(n, code, t) for n, (t, _, code) in every[k].items())))

    def detail(kinds_: list[str], fields: dict[str, str]) -> Column:
        one = {}
        for k in kinds_:
            values = []
            for name, ending in fields.items():
                field = _field(k, ending)
                plain = next(f for f in (_field(x, ending) for x in kinds_) if f)
                values.append((every[k][field][1] if field else F.lit(None).cast(_TYPES.get(registry.converter(plain), "string"))).alias(name))
            one[k] = F.struct(*values)
        return of_kind(one)

    def winding(n: int, volt: str, conn: str) -> Column:
        t = every["TRANSFORMER"]
        return F.struct(F.lit(n).alias("winding_no"), t[f"Transformer_{volt}"][1].alias("rated_voltage_kv"), t[f"Transformer_{conn}"][1].alias("connection"))

    own = rows.where(F.col("diagnostic").isNull()).withColumn("kind", F.element_at(kinds, file)).where("kind is not null")
    key = F.get("fields", F.lit(0))
    windings = F.when(kind == "TRANSFORMER", F.array(*(winding(n, *w) for n, w in WINDINGS.items())))
    return own.select(
        *FACTS, "kind", F.when(key != "", key).alias("source_id"), of_kind({k: ends(k) for k in FILES}).alias("ends"),
        *(detail(*d).alias(name) for name, d in DETAILS.items()), windings.alias("windings"), of_kind({k: found(k) for k in FILES}).alias("issues"), "fields",
    )


_GROUP = ["archive", "case_key", "kind", "source_id"]


def assembled(made: DataFrame) -> DataFrame:
    """Rows with identity_status of (archive, case, kind, id), ``published`` (the row of the lowest place stands for its group, unless its rows differ), and equipment_id, the
    id of what stands for the row; rows without an id, or in conflict, have none.  Only ids shuffle with content hashes; a group is never gathered.
    """
    content = F.sha2(F.to_json(F.struct("fields")), 256)
    place = F.struct("member", "data_row", "record_ref")
    groups = made.where("source_id is not null").groupBy(*_GROUP).agg(F.count("*").alias("n_rows"), F.min(content).alias("least"), F.max(content).alias("most"), F.min(place).alias("first"))
    status = F.when(F.col("n_rows") == 1, identity.UNIQUE).when(F.col("least") == F.col("most"), identity.IDENTICAL).otherwise(identity.CONFLICT)
    stands = F.col("identity_status") != identity.CONFLICT
    out = made.join(groups.select(*_GROUP, status.alias("identity_status"), "first"), _GROUP, "left")
    out = out.withColumn("published", F.coalesce(stands & (F.col("first") == place), F.lit(False)))
    return out.withColumn("equipment_id", F.when(stands, C.content_id("equipment", *(F.col(c) for c in _GROUP), F.col("first.record_ref")))).drop("first")


def terminals(done: DataFrame) -> DataFrame:
    """Terminals of published equipment, numbered from 1: equipment_id, terminal_no, terminal_id, raw_ref, ref_status (MISSING or UNRESOLVED, as nothing is resolved yet)."""
    flat = done.where("published").select("archive", "case_key", "kind", "source_id", "equipment_id", F.posexplode("ends").alias("n", "raw_ref")).withColumn("terminal_no", F.col("n") + 1).drop("n")
    return flat.withColumn("terminal_id", _terminal("terminal_no")).withColumn("ref_status", _ref_status())


def _ref_status() -> Column:
    return F.when(F.col("raw_ref").isNull(), "MISSING").otherwise("UNRESOLVED")


def _terminal(number: str) -> Column:
    return C.content_id("terminal", F.col("equipment_id"), F.col(number))


def windings(done: DataFrame) -> DataFrame:
    """Two windings of each published transformer, each at the terminal of its number."""
    return _windings(done.where("published and kind = 'TRANSFORMER'").select("archive", "case_key", "source_id", "equipment_id", F.inline("windings")))


def windings_at(done: DataFrame) -> DataFrame:
    """``windings`` with the details of their transformer and the raw_ref and ref_status of their terminal, which stand in the same row: nothing is joined."""
    own = done.where("published and kind = 'TRANSFORMER'").select("archive", "case_key", "source_id", "equipment_id", "transformer", "ends", F.inline("windings"))
    own = own.where(F.col("winding_no") <= F.size("ends")).withColumn("raw_ref", F.get("ends", F.col("winding_no") - 1)).drop("ends")
    return _windings(own.withColumn("ref_status", _ref_status()))


def _windings(flat: DataFrame) -> DataFrame:
    return flat.withColumn("winding_id", C.content_id("winding", F.col("equipment_id"), F.col("winding_no"))).withColumn("terminal_id", _terminal("winding_no"))


def issues(done: DataFrame) -> DataFrame:
    """All issues of all rows: their fields', and one for each row of a repeated identity.  Each is about what stands for its row (equipment_id, null where nothing does) and
    keeps its own row, so equal rows keep an issue each: FACTS, kind, equipment_id, field, code, observed, issue_id."""
    names = F.create_map(*(F.lit(x) for k, f in FILES.items() for x in (k, registry.key_of(f))))
    code = F.when(F.col("identity_status") == identity.IDENTICAL, DUPLICATE_IDENTICAL).when(F.col("identity_status") == identity.CONFLICT, DUPLICATE_CONFLICT)
    twice = F.when(code.isNotNull(), F.struct(F.element_at(names, F.col("kind")).alias("field"), code.alias("code"), F.col("source_id").alias("observed")))
    flat = done.select(*FACTS, "kind", "equipment_id", F.inline(F.concat("issues", F.array_compact(F.array(twice)))))
    return flat.withColumn("issue_id", C.content_id("issue", *(F.col(c) for c in ("archive", "equipment_id", "field", "code", "record_ref"))))


def row_categories(done: DataFrame) -> DataFrame:
    """Rows with their category: REJECTED without an id, DUPLICATE beside others of its id, RECOVERABLE with issues, else MAPPED."""
    return done.withColumn("category", C.first_reason((F.col("source_id").isNull(), "REJECTED"), (F.col("identity_status") != identity.UNIQUE, "DUPLICATE"), (F.size("issues") > 0, "RECOVERABLE"), default="MAPPED"))
