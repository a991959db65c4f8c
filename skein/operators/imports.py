"""Import of source rows: typed projection with issues beside it, identity, publication, row categories, status of a case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import columns as C
from skein.operators import identity
from skein.sources import registry

# Codes that issues carry.
PARSE_FAILED, OUT_OF_RANGE, UNKNOWN_ENUM, SUSPICIOUS, INVALID_LITERAL = "SOURCE_VALUE_PARSE_FAILED", "SOURCE_VALUE_OUT_OF_RANGE", "SOURCE_ENUM_UNKNOWN", "SOURCE_IDENTIFIER_SUSPICIOUS_FORMAT", "SOURCE_REFERENCE_INVALID_LITERAL"
FACTS = ["archive", "case_key", "member", "data_row", "record_ref"]


def convert(kind: str, text: Column) -> tuple[Column, Column]:
    """The typed value and the code of what is wrong with it.  Absent text is null without an issue; values out of range are kept."""
    given = F.when(text != "", text)
    if kind in ("text", "phase"):
        return (F.lit(None).cast("string"), C.issue(given.isNotNull(), UNKNOWN_ENUM)) if kind == "phase" else (given, F.lit(None).cast("string"))
    if kind in ("identifier", "reference"):
        odd = C.issue(given.rlike(r"^([+-]?[0-9]+(\.[0-9]+)?[eE][+-]?[0-9]+|[0-9]+\.[0-9]+)$"), SUSPICIOUS)
        return given, F.coalesce(odd, C.issue(given == "0", INVALID_LITERAL)) if kind == "reference" else odd
    if kind == "boolean":
        value, wrong = C.to_boolean(text)
        return value, C.issue(wrong.isNotNull(), PARSE_FAILED)
    if kind == "state":
        value, wrong = C.to_state(text)
        return value, C.issue(wrong.isNotNull(), UNKNOWN_ENUM)
    value, wrong = C.to_decimal(text)
    range_ = {"positive": value <= 0, "integer": value <= 0, "nonnegative": value < 0, "factor": F.abs(value) > 1}.get(kind, F.lit(False))
    wrong = C.issue(wrong.isNotNull(), PARSE_FAILED)
    if kind == "integer":
        whole = value == F.floor(value)
        return F.when(whole, value.cast("long")), F.coalesce(wrong, C.issue(range_, OUT_OF_RANGE), C.issue(~whole, PARSE_FAILED))
    return value, F.coalesce(wrong, C.issue(range_, OUT_OF_RANGE))


def typed(rows: DataFrame, file: str) -> DataFrame:
    """Rows of a file that were read in full, as columns of the file's header, with issues (field, code, observed).  No join, no shuffle."""
    names = registry.header(file)
    good = rows.where((F.substring_index("member", "/", -1) == file) & F.col("diagnostic").isNull())
    texts = {n: F.get("fields", F.lit(i)) for i, n in enumerate(names)}
    made = {n: convert(registry.converter(n), t) for n, t in texts.items()}
    issues = F.array_compact(F.array(*(F.when(code.isNotNull(), F.struct(F.lit(n).alias("field"), code.alias("code"), texts[n].alias("observed"))) for n, (_, code) in made.items())))
    return good.select(*FACTS, *(v.alias(n) for n, (v, _) in made.items()), issues.alias("issues"), "fields")


def with_identity(df: DataFrame, key: str) -> DataFrame:
    """Rows with n_rows and identity_status of (case, key); rows without a key have none.  Equal fields make equal rows, whatever their place."""
    groups = identity.classify_groups(df.where(F.col(key).isNotNull()), ["case_key", key], ["fields"])
    return df.join(groups.select("case_key", key, "n_rows", "identity_status"), ["case_key", key], "left")


def published(df: DataFrame, key: str) -> DataFrame:
    """The row of the lowest place for each identity that is unique or repeated alike; conflicting ones publish nothing."""
    good = df.where(F.col("identity_status") != identity.CONFLICT)
    return identity.representatives(good, ["case_key", key], ["member", "data_row"], [c for c in df.columns if c not in ("case_key", key)])


def categories(df: DataFrame, key: str, resolved: Column) -> DataFrame:
    """Rows with their category: REJECTED, DUPLICATE, UNRESOLVED or MAPPED, the first that holds."""
    gates = (F.col(key).isNull(), "REJECTED"), (F.col("identity_status") != identity.UNIQUE, "DUPLICATE"), (~resolved, "UNRESOLVED")
    return df.withColumn("category", C.first_reason(*gates, default="MAPPED"))


def issues(df: DataFrame) -> DataFrame:
    """One row for each issue, with an id of its own content: the same issue of repeated rows keeps its own place."""
    flat = df.select(*FACTS, F.explode("issues").alias("i")).select(*FACTS, "i.field", "i.code", "i.observed")
    return flat.withColumn("issue_id", C.content_id("issue", *(F.col(c) for c in ("archive", "record_ref", "field", "code", "observed"))))


def case_status(rows: DataFrame, expected: list[str]) -> DataFrame:
    """case_key, n_rows, n_diagnostics, n_missing, status: INCOMPLETE if a file failed, a row has a diagnostic, or an expected file is not there."""
    seen = rows.groupBy("archive", "case_key").agg(
        F.count_if(F.col("diagnostic").isNull()).alias("n_rows"), F.count("diagnostic").alias("n_diagnostics"),
        F.size(F.array_except(F.array(*map(F.lit, sorted(expected))), F.collect_set(F.substring_index("member", "/", -1)))).alias("n_missing"))
    return seen.withColumn("status", F.when((F.col("n_diagnostics") > 0) | (F.col("n_missing") > 0), "INCOMPLETE").otherwise("COMPLETE"))


def settings(df: DataFrame, keys: list[str], key: str, value: str) -> DataFrame:
    """keys, name, value, conflicting: one row for each key of a case; keys with different values yield none."""
    return df.groupBy(*keys, F.col(key).alias("name")).agg(identity.single_or_null(value).alias("value"), (F.count_distinct(value) > 1).alias("conflicting"))


def measurements(df: DataFrame, keys: list[str], metrics: list[str], at: str) -> DataFrame:
    """Wide readings to one row each; absent ones give none; time_known tells whether the time of reading has an offset."""
    known = F.coalesce(F.col(at).rlike(r"([+-][0-9]{2}:?[0-9]{2}|Z)$") & F.col(at).try_cast("timestamp").isNotNull(), F.lit(False))
    return df.select(*keys, known.alias("time_known"), *metrics).unpivot([*keys, "time_known"], metrics, "metric", "value").where("value is not null")
