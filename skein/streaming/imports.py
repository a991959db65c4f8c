"""Identity classification over a stream of arriving rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators.identity import status


def classify_stream(rows: DataFrame, keys: list[str], fields: list[str], locator: str) -> DataFrame:
    """Running status of each key (complete mode); a row that arrives twice under one locator counts once."""
    once = rows.dropDuplicates([locator])
    variant = F.xxhash64(*fields)
    groups = once.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.min(variant).alias("low"), F.max(variant).alias("high"))
    same = F.when(F.col("low") == F.col("high"), 1).otherwise(2)
    return groups.select(*keys, "n_rows", status(F.col("n_rows"), same).alias("identity_status"))
