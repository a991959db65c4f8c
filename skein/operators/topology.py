"""Interpretation of source rows as a graph, in stages: heads, devices, line ends, lines.  Each stage has its decisions, and what it rejects goes on with its reason.

Every stage is a few joins by case and raw text; rejected rows are never dropped, as the next stage has to say why it could not use them.  Lines, which are most of the
rows, meet what they name once at each end and stay whole from there on; only what is repeated, found by counts, is looked at by identity or record again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import columns as C
from skein.operators import graphs
from skein.operators.rules import absent
from skein.operators.tables import Tables

# Voltages that names tell, the pattern that finds them, and the status of each reason that is not plainly excluded.
NAMED_VOLTAGE = r"(?i)(?<![\d.])(10|20)\s*kv(?![a-z])"
VOLTAGES = {"10": "10.5", "20": "20"}
STATUS = {"AMBIGUOUS_REFERENCE": "AMBIGUOUS", "AMBIGUOUS_FEEDER": "AMBIGUOUS", "IDENTITY_NOT_UNIQUE": "AMBIGUOUS", "MISSING_REFERENCE": "UNRESOLVED", "UNRESOLVED_REFERENCE": "UNRESOLVED", "MISSING_FEEDER": "UNRESOLVED", "INVALID_FEEDER_BUS": "UNRESOLVED", "NO_FEEDER_HEAD": "UNRESOLVED", "ACCESS_POINT_UNSUPPORTED": "UNSUPPORTED", "CONNECTION_UNSUPPORTED": "UNSUPPORTED"}
DEVICES = ["SWITCH", "TRANSFORMER", "ACCESS_POINT"]
TARGETS = ["BUS", "STATION", *DEVICES]


def status_of(reason: Column) -> Column:
    names = F.create_map(*(F.lit(x) for pair in STATUS.items() for x in pair))
    return F.when(reason.isNull(), "PROJECTED").otherwise(F.coalesce(F.element_at(names, reason), F.lit("EXCLUDED")))


def _first(*gates: tuple[Column, str]) -> Column:
    """The reason of the first gate that holds; null if none does."""
    out = F.lit(None).cast("string")
    for on, reason in reversed(gates):
        out = F.when(F.coalesce(on, F.lit(False)), reason).otherwise(out)
    return out


def _end_reason(raw: Column, side: int) -> Column:
    """Why a line's end has no node: of what it names (``to``), of its case, or of the device there."""
    col = F.col
    kind = col("to.target")
    value, broken = C.to_decimal(col("to.voltage"))
    fits = C.voltage_accepted(value, col("nominal"))
    bus, station = kind == "BUS", kind == "STATION"
    why = _first(
        (absent(raw), "MISSING_REFERENCE"), (col("to.kinds").isNull(), "UNRESOLVED_REFERENCE"), (col("to.kinds") > 1, "AMBIGUOUS_REFERENCE"), (~col("to.sole"), "IDENTITY_NOT_UNIQUE"), (col("conflict"), "NAME_VOLTAGE_CONFLICT"),
        (bus & (broken.isNotNull() | (value <= 0)), "INVALID_VOLTAGE_EVIDENCE"), (bus & value.isNotNull() & ~fits, "BUS_VOLTAGE_CONFLICT"), (station & F.lit(side != 1), "STATION_DIRECTION"), (station & col("head").isNull(), "NO_FEEDER_HEAD"),
        (station & ~F.coalesce(col("head_station") == raw, F.lit(False)), "STATION_CHAIN_MISMATCH"), (kind == "ACCESS_POINT", "ACCESS_POINT_UNSUPPORTED"),
    )
    return F.coalesce(why, F.when(kind.isin("SWITCH", "TRANSFORMER"), col("to.device_reason")))


def _place(raw: Column, side: int) -> Column:
    kind = F.col("to.target")
    port = ":in" if side == 2 else ":out"
    return F.when(kind == "BUS", F.concat(F.lit("bus:"), raw)).when(kind == "STATION", F.col("head")).when(kind == "SWITCH", F.concat(F.lit("switch:"), raw, F.lit(port))).otherwise(F.concat(F.lit("transformer:"), raw))


@dataclass
class Topology:
    """decisions: case_id, rule, owner, side (of a line's end), status, reason; nodes: case_id, node, role, owner, voltage; branches: case_id, branch, role, a, b, conducting."""

    decisions: DataFrame
    nodes: DataFrame
    branches: DataFrame
    heads: DataFrame

    def reached(self) -> DataFrame:
        """Nodes that the head of a case reaches over conducting branches."""
        return graphs.reached(self.heads.select("case_id", "node"), self.branches.where("conducting").select("case_id", "a", "b"))


def interpret(accounts: DataFrame, cases: DataFrame) -> Topology:
    """Accounts: case_id, kind, record, entity_id, unique, name, end1, end2, state, voltage (text).  A bus names its station in end1, a feeder its bus in end1; a line with null in all
    fields has a null entity_id and null ends.  Cases: case_id, name, fallback (decimal).

    A name's voltage goes before the fallback; names that tell two forbid all devices and ends.  A case has a head if one unique feeder names one unique bus.  A switch stands
    between one incoming and one outgoing line, a transformer at the end of one, if all that names them is exact and they name nothing themselves.  A line stands if both its ends do.  Repeated rows are decided each.
    """
    t = Tables(accounts.sparkSession)
    accounts = t.save(accounts)
    col, given = F.col, lambda c: ~absent(F.col(c))
    # What a raw text names: kinds, rows, and whether it is one row of a unique identity.
    ids = accounts.where(col("kind").isin(TARGETS) & given("entity_id")).groupBy("case_id", col("entity_id").alias("raw")).agg(F.count_distinct("kind").alias("kinds"), F.min("kind").alias("target"), F.count("*").alias("rows"), F.min("unique").alias("unique"), F.min("voltage").alias("voltage"), F.min("end1").alias("station"))
    ids = t.save(ids.withColumn("sole", (col("rows") == 1) & col("unique")))
    named = lambda c, tag: ids.select("case_id", col("raw").alias(c), *(col(x).alias(f"{tag}_{x}") for x in ("kinds", "target", "sole", "voltage", "station")))

    # Heads.
    feeder = accounts.where("kind = 'FEEDER'").groupBy("case_id").agg(F.count("*").alias("feeders"), F.min("unique").alias("feeder_unique"), F.min("entity_id").alias("feeder"), F.min("end1").alias("head_bus"), F.concat_ws(" ", F.collect_set("name")).alias("feeder_name"))
    head = cases.join(feeder, "case_id", "left").join(named("head_bus", "bus"), ["case_id", "head_bus"], "left")
    told = F.array_distinct(F.regexp_extract_all(F.concat_ws(" ", "name", "feeder_name"), F.lit(NAMED_VOLTAGE), F.lit(1)))
    volts = F.create_map(*(F.lit(x) for pair in VOLTAGES.items() for x in pair))
    nominal = F.when(F.size("told") == 1, F.element_at(volts, F.get("told", F.lit(0))).cast("decimal(38,18)")).otherwise(col("fallback"))
    exact = (col("bus_kinds") == 1) & (col("bus_target") == "BUS") & col("bus_sole")
    reason = _first((col("feeders").isNull(), "MISSING_FEEDER"), ((col("feeders") != 1) | ~col("feeder_unique"), "AMBIGUOUS_FEEDER"), (~F.coalesce(exact, F.lit(False)), "INVALID_FEEDER_BUS"), (F.size("told") > 1, "NAME_VOLTAGE_CONFLICT"))
    malformed = accounts.where("kind = 'LINE' and entity_id is null and end1 is null and end2 is null").select("case_id", F.lit(True).alias("malformed")).distinct()
    head = head.withColumn("told", told).join(malformed, "case_id", "left").select("case_id", reason.alias("reason"), nominal.alias("nominal"), (F.size("told") > 1).alias("conflict"), F.coalesce("feeder", F.lit("")).alias("owner"), F.when(exact, col("bus_station")).alias("head_station"), F.coalesce("malformed", F.lit(False)).alias("malformed"))
    head = t.save(head.withColumn("node", F.when(col("reason").isNull(), F.concat(F.lit("head:"), "owner"))))
    about = head.select("case_id", "nominal", "conflict", "malformed", col("node").alias("head"), "head_station")

    # Devices, with what the lines at them tell.
    line = accounts.where("kind = 'LINE'")
    several = lambda df, c: t.save(df.where(col(c).isNotNull()).groupBy("case_id", c).agg(F.count("*").alias("n")).where("n > 1").select("case_id", c, F.lit(True).alias("more")))
    line = line.join(several(line.where(given("entity_id")), "entity_id"), ["case_id", "entity_id"], "left").select("case_id", "record", "entity_id", "unique", "end1", "end2", (given("entity_id") & col("more").isNull()).alias("once"))
    # Where all lines at a text have identities of their own, each is one of its lines, even if it names the text twice; else their number is not asked.
    sides = F.array(*(F.struct(F.lit(n).alias("side"), col(f"end{n}").alias("raw"), (F.lit(n == 2) & (col("end1") == col("end2"))).alias("again")) for n in (1, 2)))
    at = line.select("case_id", "once", F.explode(sides).alias("e")).select("case_id", "once", "e.*").where(given("raw")).groupBy("case_id", "raw")
    at = at.agg(F.count("*").alias("ends"), (F.count("*") - F.count_if("again")).alias("lines"), F.count_if(col("side") == 1).alias("outgoing"), F.count_if(col("side") == 2).alias("incoming"), F.min("once").alias("once"))
    own = accounts.where(col("kind").isin(DEVICES)).withColumn("key", F.when(given("entity_id"), col("entity_id")).otherwise(col("record")))
    device = own.groupBy("case_id", "kind", "key").agg(F.count("*").alias("rows"), F.min("unique").alias("unique"), F.max(given("end1") | given("end2")).alias("explicit"), F.min("state").alias("state"), F.min(given("entity_id")).alias("named"))
    device = device.join(at.withColumnRenamed("raw", "key"), ["case_id", "key"], "left").na.fill(0, ["ends", "lines", "outgoing", "incoming"]).join(ids.select("case_id", col("raw").alias("key"), "kinds"), ["case_id", "key"], "left").join(about, "case_id")
    switch = col("kind") == "SWITCH"
    degree = F.when(switch, 2).otherwise(1)
    prefix = lambda what: F.concat(F.when(switch, "SWITCH").otherwise("TRANSFORMER"), F.lit(what))
    why = _first(
        (col("kind") == "ACCESS_POINT", "ACCESS_POINT_UNSUPPORTED"), ((col("rows") != 1) | ~col("unique") | ~col("named"), "IDENTITY_NOT_UNIQUE"), (col("malformed"), "INCOMPLETE_LINE_EVIDENCE"), (~col("once"), "INCIDENT_IDENTITY_CONFLICT"),
        (col("lines") != degree, "_DEGREE"), ((col("incoming") != 1) | (col("outgoing") != degree - 1) | (col("ends") != degree), "_DIRECTION"), (col("explicit"), "EXPLICIT_ENDPOINT_EVIDENCE"), (col("kinds") != 1, "INCIDENT_REFERENCE_NOT_EXACT"), (col("conflict"), "NAME_VOLTAGE_CONFLICT"),
    )
    device = device.withColumn("reason", why)
    device = t.save(device.select("case_id", "kind", "key", "nominal", F.when(col("reason").startswith("_"), prefix(col("reason"))).otherwise(col("reason")).alias("reason"), F.upper("state").alias("state")))

    # Line ends: what each names, and the node that it has there.
    why_device = device.select("case_id", col("kind").alias("target"), col("key").alias("raw"), col("reason").alias("device_reason"))
    target = t.save(ids.join(why_device, ["case_id", "target", "raw"], "left"))
    whole = line.join(about.select("case_id", "nominal", "conflict", "head", "head_station"), "case_id")
    for n in (1, 2):
        to = target.select("case_id", col("raw").alias(f"end{n}"), F.struct("kinds", "target", "sole", "voltage", "device_reason").alias("to"))
        whole = whole.join(to, ["case_id", f"end{n}"], "left").withColumn(f"reason{n}", _end_reason(col(f"end{n}"), n)).withColumn(f"target{n}", col("to.target"))
        whole = whole.withColumn(f"node{n}", F.when(col(f"reason{n}").isNull(), _place(col(f"end{n}"), n))).drop("to")
    whole = t.save(whole.drop("conflict", "head", "head_station"))
    e = whole.select("case_id", "record", "nominal", F.explode(F.array(*(F.struct(F.lit(n).alias("side"), col(f"end{n}").alias("raw"), col(f"target{n}").alias("target"), col(f"reason{n}").alias("reason"), col(f"node{n}").alias("node")) for n in (1, 2)))).alias("e")).select("case_id", "record", "nominal", "e.*")

    # Lines.  Rows of one record share their ends, as all rows of it say together what it joins.
    shared = several(whole, "record")
    both = whole.join(shared, ["case_id", "record"], "left_semi").groupBy("case_id", "record").agg(F.max(col("reason1").isNotNull() | col("reason2").isNotNull()).alias("all_excluded"), F.max("node1").alias("all_node1"), F.max("node2").alias("all_node2"), F.lit(True).alias("more"))
    whole = whole.where("entity_id is not null or end1 is not null or end2 is not null").join(t.save(both), ["case_id", "record"], "left")
    excluded = F.when(col("more"), col("all_excluded")).otherwise(col("reason1").isNotNull() | col("reason2").isNotNull())
    whole = whole.select("case_id", "record", "entity_id", _first((~col("unique") | ~col("once"), "IDENTITY_NOT_UNIQUE"), (excluded, "LINE_ENDPOINT_EXCLUDED")).alias("reason"), *(F.when(col("more"), col(f"all_node{n}")).otherwise(col(f"node{n}")).alias(f"node{n}") for n in (1, 2)))

    side = F.lit(None).cast("int")
    said = lambda df, rule, owner, side=side: df.select("case_id", rule.alias("rule"), owner.alias("owner"), side.alias("side"), status_of(col("reason")).alias("status"), "reason")
    decisions = said(head, F.lit("FEEDER_HEAD"), col("owner")).unionByName(said(device, col("kind"), col("key"))).unionByName(said(e, F.lit("LINE_END"), col("record"), col("side"))).unionByName(said(whole, F.lit("LINE"), col("record")))
    node = lambda df, node, role, owner: df.select("case_id", node.alias("node"), F.lit(role).alias("role"), owner.alias("owner"), "nominal")
    good = device.where("reason is null")
    nodes = node(head.where("node is not null"), col("node"), "feeder-head/mv", col("owner")).unionByName(node(good.where("kind = 'TRANSFORMER'"), F.concat(F.lit("transformer:"), "key"), "transformer-mv/mv", col("key")))
    for port in ("in", "out"):
        nodes = nodes.unionByName(node(good.where("kind = 'SWITCH'"), F.concat(F.lit("switch:"), "key", F.lit(f":{port}")), f"switch-port/{port}", col("key")))
    nodes = nodes.unionByName(node(e.where("reason is null and target = 'BUS'"), col("node"), "junction/bus", col("raw")).distinct()).withColumnRenamed("nominal", "voltage")
    branch = lambda df, name, role, a, b, conducting: df.select("case_id", name.alias("branch"), F.lit(role).alias("role"), a.alias("a"), b.alias("b"), conducting.alias("conducting"))
    key = F.concat(F.lit("switch:"), "key")
    branches = branch(good.where("kind = 'SWITCH'"), key, "switch/internal", F.concat(key, F.lit(":in")), F.concat(key, F.lit(":out")), F.coalesce(col("state") == "CLOSED", F.lit(False))).unionByName(branch(whole.where("reason is null"), F.concat(F.lit("line:"), "entity_id"), "line/connection", col("node1"), col("node2"), F.lit(True)))
    return Topology(decisions, nodes, branches, head.where("node is not null").select("case_id", "node"))
