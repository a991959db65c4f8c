"""Identity classification: unique, identical duplicates, conflicting duplicates; no row is ever dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIQUE, IDENTICAL, CONFLICT = "UNIQUE", "DUPLICATE_IDENTICAL", "DUPLICATE_CONFLICT"


def status(rows: Column, variants: Column) -> Column:
    return F.when(rows == 1, UNIQUE).when(variants == 1, IDENTICAL).otherwise(CONFLICT)


def classify_groups(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row for each key: n_rows, n_variants, identity_status.  Nulls are values of their own."""
    variant = F.struct(*fields)
    groups = df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count_distinct(variant).alias("n_variants"))
    return groups.withColumn("identity_status", status(F.col("n_rows"), F.col("n_variants")))


def stamp(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Every row with its group's status: the groups are aggregated first, so no key gathers its rows in a window."""
    return df.join(classify_groups(df, keys, fields), keys)


def representatives(df: DataFrame, keys: list[str], locator: list[str], columns: list[str]) -> DataFrame:
    """The row of the lowest locator for each key."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*locator)).alias("row")).select(*keys, "row.*")


def single_or_null(column: str) -> Column:
    """The only distinct value of a group, else null."""
    return F.when(F.count_distinct(column) == 1, F.min(column))


def conflicting_ids(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Ids that stand for different contents."""
    return classify_groups(df, [key], fields).where(F.col("n_variants") > 1)


def difference(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, as often as it lacks them."""
    one = expected.exceptAll(observed).withColumn("side", F.lit("MISSING"))
    return one.unionByName(observed.exceptAll(expected).withColumn("side", F.lit("EXTRA")))
