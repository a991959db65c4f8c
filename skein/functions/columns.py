"""Column functions: content identities and typed conversion that keeps an issue beside the value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(kind: str, *parts: Column) -> Column:
    """``kind:<sha256>`` of the compact JSON array of the parts, as text."""
    return F.concat(F.lit(f"{kind}:"), F.sha2(F.to_json(F.array(*(p.cast("string") for p in parts))), 256))


def issue(condition: Column, code: str) -> Column:
    return F.when(condition, F.lit(code))


def to_decimal(text: Column, scale: int = 18) -> tuple[Column, Column]:
    """The finite decimal that a text spells, or null; INVALID_NUMBER where it spells none.  Empty is absent, no issue."""
    value = F.expr("cast(null as decimal(38,18))") if text is None else F.when(F.trim(text) != "", text).try_cast(f"decimal(38,{scale})")
    return value, issue((F.trim(text) != "") & value.isNull(), "INVALID_NUMBER")


def to_boolean(text: Column) -> tuple[Column, Column]:
    """Only true and false, whatever their case."""
    value = F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)
    return value, issue((text != "") & value.isNull(), "INVALID_BOOLEAN")


def to_state(text: Column) -> tuple[Column, Column]:
    """Open and Closed exactly; empty is absent; anything else is UNKNOWN, with an issue."""
    value = F.when(text == "", None).when(text == "Open", "OPEN").when(text == "Closed", "CLOSED").otherwise("UNKNOWN")
    return value, issue(value == "UNKNOWN", "UNKNOWN_STATE")


def positive_integer(text: Column) -> tuple[Column, Column]:
    value, _ = to_decimal(text)
    good = F.when((value > 0) & (value == F.floor(value)), value.cast("long"))
    return good, issue((F.trim(text) != "") & good.isNull(), "NOT_A_POSITIVE_INTEGER")


def to_instant(text: Column) -> tuple[Column, Column]:
    """The instant that an ISO date and time with an offset spells; without an offset it names none.  Empty is absent, no issue."""
    whole = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:[0-9]{2})$")
    value = F.when(whole, text).try_cast("timestamp")
    return value, issue((text != "") & value.isNull(), "INVALID_TIMESTAMP")


def suspicious_identifier(text: Column) -> Column:
    """Identifiers that a spreadsheet has turned into scientific notation."""
    return text.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?[eE][+-]?[0-9]+$")


def voltage_compatible(a: Column, b: Column) -> Column:
    """Equal, or both of 10 and 10.5; symmetric."""
    near = [F.lit(10).cast("decimal(38,18)"), F.lit("10.5").cast("decimal(38,18)")]
    return (a == b) | (a.isin(*near) & b.isin(*near))


def voltage_accepted(value: Column, domain: Column) -> Column:
    """Equal, or 10 where the domain is 10.5; not symmetric."""
    return (value == domain) | ((value == F.lit(10)) & (domain == F.lit("10.5").cast("decimal(38,18)")))


def first_reason(*gates: tuple[Column, str], default: str) -> Column:
    """The reason of the first gate that holds."""
    out = None
    for condition, reason in gates:
        out = F.when(condition, F.lit(reason)) if out is None else out.when(condition, F.lit(reason))
    return out.otherwise(F.lit(default))


def all_reasons(*gates: tuple[Column, str]) -> Column:
    """Sorted distinct reasons of all gates that hold."""
    holds: dict[str, Column] = {}
    for condition, reason in gates:
        holds[reason] = holds[reason] | condition if reason in holds else condition
    return F.array_compact(F.array(*(F.when(holds[r], F.lit(r)) for r in sorted(holds))))
