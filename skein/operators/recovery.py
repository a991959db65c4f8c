"""Deterministic recovery: devices claim ports where the source declares each connection twice, alike; lines follow accepted claims.

Candidates of a family are judged by all their evidence at once.  A claim that one line alone makes on a side is accepted; contested or
incomplete claims stay, with every reason.  Nothing is picked by order, so the rows' order never matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import columns as C
from skein.operators import scans
from skein.operators.rules import absent
from skein.operators.tables import Tables

# Families, variants, statuses and reasons that results carry.
SERIES, LEAF, OTHER = "SERIES_SWITCH_RECOVERY", "SWITCH_TERMINAL_REPRESENTATION", "OTHER_DETERMINISTIC_REVIEW"
REFERENCED, SEVERAL, ACCESS = "REFERENCED_TRANSFORMER_RECOVERY", "MULTI_INCOMING_TRANSFORMER_REVIEW", "ACCESS_POINT_RECOVERY"
FATAL = ["INCOMPATIBLE_VOLTAGE", "FULL_UNIQUE_INCIDENCE_REQUIRED", "MALFORMED_LINE_EVIDENCE"]
OUTER_KINDS = ["BUS", "STATION", "SWITCH", "TRANSFORMER"]
DEVICES = ["SWITCH", "TRANSFORMER", "ACCESS_POINT"]


def _holders(accounts: DataFrame) -> DataFrame:
    """What a raw text names in its case, where exactly one row, of a unique identity, has it: case_id, raw, kind, voltage."""
    one = accounts.where("coalesce(entity_id, '') <> ''").groupBy("case_id", F.col("entity_id").alias("raw")).agg(F.count("*").alias("n"), F.min("unique").alias("unique"), F.min("kind").alias("kind"), F.min("voltage").alias("voltage"))
    return one.where("n = 1 and unique").select("case_id", "raw", "kind", "voltage")


def _outer(devices: DataFrame, holders: DataFrame, line_side: str, device_side: str, tag: str) -> DataFrame:
    """Beside the far end of a line and the device's own end: what each of the two names."""
    for raw, name in ((line_side, f"{tag}_far"), (device_side, f"{tag}_own")):
        named = holders.select("case_id", F.col("raw").alias(raw), F.col("kind").alias(f"{name}_kind"), F.col("voltage").alias(f"{name}_voltage"))
        devices = devices.join(named, ["case_id", raw], "left")
    return devices


def _key() -> Column:
    """What a row goes by: its identity, or its record where it has none."""
    return F.when(absent(F.col("entity_id")), F.col("record")).otherwise(F.col("entity_id"))


def _texts(accounts: DataFrame, kept: DataFrame) -> DataFrame:
    """What each text of a case stands for, one row a text (case_id, raw): rows that have it as identity, devices that go by it, lines that do."""
    held, kind = ~absent(F.col("entity_id")), F.col("kind")
    rows = accounts.select("case_id", _key().alias("raw"), held.alias("held"), "kind", "unique", "voltage", "end1", "end2", "state", "tie")
    rows = rows.unionByName(kept.where("entity_id is not null").select("case_id", F.col("entity_id").alias("raw"), F.col("kind").alias("kept")), allowMissingColumns=True)
    of = lambda on, c: F.min(F.when(on, F.col(c))).alias(c)
    return rows.groupBy("case_id", "raw").agg(
        F.count_if("held").alias("n"), of(F.col("held"), "unique"), of(F.col("held"), "kind"), of(F.col("held"), "voltage"), F.count_if(kind == "LINE").alias("same"), *(F.count_if(kind == k).alias(f"n_{k}") for k in DEVICES),
        *(of(kind == "SWITCH", c) for c in ("end1", "end2", "state", "tie")), F.max(F.when(kind == "TRANSFORMER", ~absent(F.col("end1")) | ~absent(F.col("end2")))).alias("names"),
        *(F.max(F.col("kept") == k).alias(f"kept_{k}") for k in DEVICES),
    )


def _named(accounts: DataFrame) -> DataFrame:
    """What names each text of a case, one row a text (case_id, raw): rows of any kind, and lines by side.

    The least far end of a side tells all that is asked of it, as two already contest a side.  ``n_rows`` counts lines by row, once where both ends name the text.
    """
    line, far = F.col("kind") == "LINE", F.col("far")
    ends = F.array(*(F.struct(F.lit(n).alias("side"), F.col(a).alias("raw"), F.col(b).alias("far"), again.alias("again")) for n, a, b, again in ((1, "end1", "end2", F.lit(False)), (2, "end2", "end1", F.col("end1").eqNullSafe(F.col("end2"))))))
    rows = accounts.select("case_id", line.alias("line"), _key().isNotNull().alias("told"), "unique", F.explode(ends).alias("end")).select("case_id", "line", "told", "unique", "end.*").where("coalesce(raw, '') <> ''")
    into, out_of = F.col("line") & (F.col("side") == 2), F.col("line") & (F.col("side") == 1)
    got = rows.groupBy("case_id", "raw").agg(F.count_if(into).alias("n_in"), F.count_if(out_of).alias("n_out"), F.count_if(F.expr("line and told and not again")).alias("n_rows"), F.min(F.when(F.col("line"), F.col("unique"))).alias("lines_unique"), F.min(F.when(into, far)).alias("far1"), F.min(F.when(out_of, far)).alias("far2"))
    return got.withColumn("named", F.lit(True))


def _repeats(accounts: DataFrame, shared: DataFrame, n: int) -> DataFrame:
    """Rows of lines that go by the name of another row at the same text, beyond the first of each name: case_id, raw, n_again.  ``shared``: the ``n`` names of several lines."""
    line = accounts.where("kind = 'LINE'").select("case_id", _key().alias("name"), F.array_distinct(F.array("end1", "end2")).alias("ends")).where("name is not null")
    # All rows of a name pass the filter or none, so counts by name are whole.
    line = scans.possible(line, [["case_id", "name"]], shared.select("case_id", "raw"), n)
    by = line.select("case_id", "name", F.explode("ends").alias("raw")).where("coalesce(raw, '') <> ''").groupBy("case_id", "raw", "name").agg(F.count("*").alias("rows")).where("rows > 1")
    return by.groupBy("case_id", "raw").agg(F.sum(F.col("rows") - 1).alias("n_again"))


def candidates(accounts: DataFrame, cases: DataFrame, kept: DataFrame) -> DataFrame:
    """Judge every switch, transformer and access point: case_id, kind, key, family, variant, status, reasons, n_lines, conducting.

    ``accounts``: case_id, kind, record, entity_id, unique, end1, end2, state, tie, voltage (text; null or empty: absent).  ``cases``: case_id, nominal (decimal),
    headed, hard (codes that forbid all), malformed.  ``kept``: case_id, kind, entity_id of devices that the accepted graph has already.

    A repeated identity stays a whole group, never a chosen row.  A transformer that nothing names and that names nothing is no candidate.
    Lines are counted by device before they meet it, so a device in a million lines is one row when it is judged.

    Rows are dealt by text twice, once by what they go by and once by what they name, and each text is summed up before and after; the two sums meet where
    they lie.  What is kept of them, devices and named holders, is written once.  Names of lines are told apart only where several lines share one.
    """
    t = Tables(accounts.sparkSession)
    device = sum((F.col(f"n_{k}") for k in DEVICES), F.lit(0)) > 0
    met = _texts(accounts, kept).join(_named(accounts), ["case_id", "raw"], "left")
    texts, n_shared = t.count(met.where(device | (F.col("same") > 1) | (F.col("named") & F.col("unique") & (F.col("n") == 1))), F.col("same") > 1)

    holders = texts.where("n = 1 and unique and named").select("case_id", "raw", "kind", "voltage")
    alone = F.coalesce((F.col("n") == 1) & F.col("unique"), F.lit(False)).alias("alone")
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"n_{k}").alias("n"), F.col(f"kept_{k}").alias("kept")) for k in DEVICES))).alias("device")
    d = texts.select("case_id", F.col("raw").alias("key"), alone, *("end1", "end2", "state", "tie", "names", "named", "n_in", "n_out", "n_rows", "lines_unique", "far1", "far2"), kinds).select("*", "device.*").drop("device").where("n > 0")
    d = d.na.fill(0, ["n_in", "n_out", "n_rows"]).where("kind <> 'TRANSFORMER' or named or names").withColumn("n_lines", F.col("n_rows"))
    if n_shared:
        d = d.join(_repeats(accounts, texts.where("same > 1"), n_shared).withColumnRenamed("raw", "key"), ["case_id", "key"], "left").withColumn("n_lines", F.col("n_rows") - F.coalesce("n_again", F.lit(0))).drop("n_again")
    d = d.withColumn("n_ends", F.col("n_in") + F.col("n_out")).join(cases, "case_id")
    # Outer ends are asked about where lines enter and leave a single switch; elsewhere no answer changes what is said of it.
    asked = (F.col("kind") == "SWITCH") & (F.col("n") == 1) & _sided()
    rest = d.where(~asked).select("*", *(F.lit(None).cast(holders.schema[c].dataType).alias(f"{tag}_{end}_{c}") for tag in ("in", "out") for end in ("far", "own") for c in ("kind", "voltage")))
    return _judged(_outer(_outer(d.where(asked), holders, "far1", "end1", "in"), holders, "far2", "end2", "out").unionByName(rest))


def _sided() -> Column:
    """One line enters, and one leaves where there are two."""
    return (F.col("n_in") == 1) & (F.col("n_out") == F.when(F.col("n_lines") == 2, 1).otherwise(0))


def _judged(d: DataFrame) -> DataFrame:
    yes = lambda c: F.coalesce(c, F.lit(False))
    col = F.col
    switch, transformer = col("kind") == "SWITCH", col("kind") == "TRANSFORMER"
    family = F.when(switch & (col("n_lines") == 2), SERIES).when(switch & (col("n_lines") == 1), LEAF).when(switch, OTHER).when(transformer & (col("n_lines") > 1), SEVERAL).when(transformer, REFERENCED).otherwise(ACCESS)
    series = family == SERIES
    sole = (col("n") == 1) & yes(col("alone"))
    ordinary = yes(F.upper("tie") == "FALSE")
    exact = {k: col(f"{k}_kind").isNotNull() for k in ("in_far", "in_own", "out_far", "out_own")}
    all_exact = exact["in_far"] & exact["in_own"] & exact["out_far"] & exact["out_own"]
    same = lambda a, b: yes(col(a) == col(b))
    variant = (F.when(~series | (col("n") > 1), family).when(~ordinary, "SERIES_TIE_OR_UNKNOWN_TYPE").when((col("n_in") != 1) | (col("n_out") != 1), "SERIES_INVALID_INCIDENCE").when(~all_exact, "SERIES_UNRESOLVED_ENDPOINT")
        .when(same("far1", "end1") & same("far2", "end2"), "SERIES_EXACT_DIRECT").when(same("far1", "end2") & same("far2", "end1"), "SERIES_EXACT_REVERSE").otherwise("SERIES_DIFFERENT_OR_PARTIAL_ENDPOINT"))

    count, sided = F.when(series, 2).otherwise(1), _sided()
    decimal = lambda c: C.to_decimal(c)[0]
    wrong = lambda c: ~absent(col(c)) & ~yes(C.voltage_compatible(decimal(col(c)), col("nominal")))

    def outer(tag: str, far: str, own: str, asked: Column) -> list[tuple[Column, str]]:
        """What an outer end lacks: both declarations, alike, of something else that a line may meet, at the case's voltage."""
        asked = asked & sided
        both = asked & exact[f"{tag}_far"] & exact[f"{tag}_own"]
        return [
            (asked & ~(exact[f"{tag}_far"] & exact[f"{tag}_own"]), "EXACT_OUTER_REFERENCE_REQUIRED"), (both & ~same(far, own), "DIRECT_DECLARATIONS_REQUIRED"), (both & same(far, "key"), "SELF_ENDPOINT_UNPROVEN"),
            (both & ~col(f"{tag}_far_kind").isin(OUTER_KINDS), "UNSUPPORTED_OUTER_ENTITY_TYPE"), (both & (wrong(f"{tag}_far_voltage") | wrong(f"{tag}_own_voltage")), "INCOMPATIBLE_VOLTAGE"),
        ]

    asks = C.all_reasons(
        (family == OTHER, "INCIDENCE_NOT_SUPPORTED"), (yes(col("malformed")), "MALFORMED_LINE_EVIDENCE"), (~yes(F.upper("state").isin("OPEN", "CLOSED")), "KNOWN_STATE_REQUIRED"), (~ordinary, "ORDINARY_SWITCH_REQUIRED"),
        (~yes(col("nominal") > 0), "MV_VOLTAGE_REQUIRED"), (~yes(col("headed")), "ACCEPTED_HEAD_REQUIRED"), ((col("n_ends") != count) | (col("n_lines") != count) | ~yes(col("lines_unique")), "FULL_UNIQUE_INCIDENCE_REQUIRED"),
        (~sided, "INCIDENCE_DIRECTION_REQUIRED"), *outer("in", "far1", "end1", F.lit(True)), *outer("out", "far2", "end2", series),
        (sided & ~series & ~absent(col("end2")), "REMOTE_ENDPOINT_NOT_EMPTY"), (sided & series & (F.coalesce("end1", F.lit("")) == F.coalesce("end2", F.lit(""))), "COLLAPSED_ENDPOINTS_UNPROVEN"),
    )
    hard = F.coalesce("hard", F.array().cast("array<string>"))
    kept = yes(col("kept"))
    rejected = ~sole | (F.size(hard) > 0)
    reasons = (F.when(rejected, F.array_sort(F.array_distinct(F.concat(hard, F.when(~sole, F.array(F.lit("IDENTITY_NOT_UNIQUE"))).otherwise(F.array().cast("array<string>"))))))
        .when(transformer & kept, F.array(F.lit("EXISTING_V1_MV_ATTACHMENT"))).when(transformer & (col("n_lines") > 1), F.array(F.lit("MULTIPLE_POSSIBLE_PORTS"))).when(transformer, F.array(F.lit("DECLARED_REFERENCE_PORT_SEMANTICS_UNPROVEN")))
        .when(~switch, F.array(F.lit("ACCESS_POINT_PHYSICAL_ROLE_UNPROVEN"))).when(kept, F.array(F.lit("EXISTING_V1_SWITCH")))
        .when(F.size("asks") > 0, col("asks")).when(series, F.array(F.lit("EXACT_DIRECT_SERIES"))).otherwise(F.array(F.lit("EXACT_LEAF_UNBOUND_REMOTE"))))
    status = (F.when(rejected, "REJECTED").when(kept & (switch | transformer), "BASELINE_PRESERVED").when(~switch, "NEEDS_REVIEW").when(F.size("asks") == 0, "ACCEPTED")
        .when(F.arrays_overlap("asks", F.array(*map(F.lit, FATAL))), "REJECTED").otherwise("NEEDS_REVIEW"))
    out = d.withColumn("asks", asks).select("case_id", "kind", "key", family.alias("family"), variant.alias("variant"), status.alias("status"), reasons.alias("reasons"), "n_lines", F.upper("state").alias("state"))
    return out.withColumn("conducting", (F.col("status") == "ACCEPTED") & F.coalesce(F.col("state") == "CLOSED", F.lit(False))).drop("state")


def recovered_lines(accounts: DataFrame, cases: DataFrame, judged: DataFrame, ports: DataFrame, present: DataFrame) -> DataFrame:
    """Source lines whose both ends have a node now, at least one by an accepted candidate: case_id, line_id, a, b, n_dependencies.

    ``ports``: case_id, record, side, node of line ends that the accepted graph has; ``present``: case_id, line_id of its lines.  A line enters an accepted
    switch at ``<key>:in`` with its second end, and leaves at ``<key>:out`` with its first.  Lines that are not unique stay out, and so do all in a case with hard codes.
    """
    t = Tables(accounts.sparkSession)
    fine = cases.where("size(coalesce(hard, array())) = 0").select("case_id")
    taken, n_taken = t.count(judged.where("status = 'ACCEPTED'").select("case_id", "key"), F.lit(True))
    # Only lines at an accepted candidate can follow, so all that is asked of lines, and of what may share their names, is about those few.
    line = accounts.where("kind = 'LINE' and unique and coalesce(entity_id, '') <> ''").select("case_id", "record", F.col("entity_id").alias("line_id"), "end1", "end2")
    line = scans.possible(line, [["case_id", "end1"], ["case_id", "end2"]], taken, n_taken)
    line, n_lines = t.count(line.join(fine, "case_id", "left_semi"), F.lit(True))
    about = lambda df, c, key: scans.possible(df, [["case_id", c]], line.select("case_id", key), n_lines)
    alone = _holders(about(accounts, "entity_id", "line_id")).where("kind = 'LINE'").select("case_id", F.col("raw").alias("line_id"))
    line = line.join(alone, ["case_id", "line_id"], "left_semi").join(about(present.select("case_id", "line_id"), "line_id", "line_id"), ["case_id", "line_id"], "left_anti")
    ports = about(ports, "record", "record")
    for side, port in ((1, ":out"), (2, ":in")):
        given = ports.where(F.col("side") == side).groupBy("case_id", "record").agg(F.min("node").alias("node"))
        line = line.join(taken.select("case_id", F.col("key").alias(f"end{side}"), F.concat("key", F.lit(port)).alias(f"new{side}")), ["case_id", f"end{side}"], "left").join(given.withColumnRenamed("node", f"old{side}"), ["case_id", "record"], "left")
    a, b = (F.coalesce(f"new{s}", f"old{s}") for s in (1, 2))
    n = F.col("new1").isNotNull().cast("int") + F.col("new2").isNotNull().cast("int")
    return line.where(a.isNotNull() & b.isNotNull() & (n > 0)).select("case_id", "line_id", a.alias("a"), b.alias("b"), n.alias("n_dependencies"))
