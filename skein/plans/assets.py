"""Queries of equipment over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import equipment as E
from skein.plans.catalogue import _t, query


def _rows(spark: SparkSession, d: str) -> DataFrame:
    """Orders in pairs are rows of transformers: two of three pairs share an id, the first third with rows that differ, the second with equal ones.  Customers are rows of loads."""
    u = F.expr("o_orderkey div 2")
    text = lambda c: c.cast("string")
    own = F.when(u % 50 == 0, "").when(u % 3 == 2, F.concat(F.lit("u"), text(F.col("o_orderkey")))).otherwise(F.concat(F.lit("t"), text(u)))
    values = [own, F.when(u % 7 == 0, "").otherwise(F.concat(F.lit("b"), text(u % 10))), F.when(u % 11 == 0, "0").otherwise(F.concat(F.lit("c"), text(u))), F.lit(""), text(u % 40 - 2), F.lit("10.5"), F.when(u % 13 == 0, "x").otherwise("0.4"), F.lit("1"), F.lit("2"), F.lit("D"), F.lit("yn"), text(u % 5), F.when(u % 3 == 0, text(F.col("o_orderkey"))).otherwise("r")]
    shape = lambda df, case, number, file, values: df.select(F.lit("a.zip").alias("archive"), case.alias("case_key"), F.concat(case, F.lit(f"/{file}")).alias("member"), number.cast("long").alias("data_row"), F.concat_ws("#", case, F.lit(file), number).alias("record_ref"), F.array(*values).alias("fields"), F.lit(None).cast("string").alias("diagnostic"))
    t = shape(_t(spark, d, "orders"), F.concat(F.lit("k"), text(u % 20)), F.col("o_orderkey"), E.FILES["TRANSFORMER"], values)
    key = F.col("c_custkey")
    load = [F.concat(F.lit("l"), text(key)), F.concat(F.lit("b"), text(key % 10)), F.when(key % 9 == 0, "ABC").otherwise(""), F.when(key % 17 == 0, "?").otherwise(text(key)), F.lit("0"), text(key % 3)]
    return t.unionByName(shape(_t(spark, d, "customer"), F.concat(F.lit("k"), text(key % 20)), key, E.FILES["LOAD"], load))


_EQUIPMENT = """o AS (SELECT o_orderkey AS key, o_orderkey // 2 AS u, 'k' || ((o_orderkey // 2) % 20) AS case_key FROM orders),
rowed AS (SELECT *, CASE WHEN u % 50 = 0 THEN NULL WHEN u % 3 = 2 THEN 'u' || key ELSE 't' || u END AS source_id, count(*) OVER (PARTITION BY u) AS n, min(key) OVER (PARTITION BY u) AS first FROM o),
t AS (SELECT *, CASE WHEN source_id IS NULL THEN NULL WHEN u % 3 = 2 OR n = 1 THEN 'UNIQUE' WHEN u % 3 = 1 THEN 'DUPLICATE_IDENTICAL' ELSE 'DUPLICATE_CONFLICT' END AS status FROM rowed)"""


@query(f"""WITH {_EQUIPMENT} SELECT case_key, source_id, w AS winding_no, CASE w WHEN 1 THEN 10.5 ELSE CASE WHEN u % 13 <> 0 THEN 0.4 END END::DOUBLE AS rated_voltage_kv, CASE w WHEN 1 THEN 'D' ELSE 'yn' END AS connection,
CASE w WHEN 1 THEN CASE WHEN u % 7 <> 0 THEN 'b' || (u % 10) END ELSE CASE WHEN u % 11 = 0 THEN '0' ELSE 'c' || u END END AS raw_ref, CASE WHEN w = 1 AND u % 7 = 0 THEN 'MISSING' ELSE 'UNRESOLVED' END AS ref_status, (u % 40 - 2)::DOUBLE AS rated_capacity_kva
FROM t, (SELECT unnest([1, 2]) AS w) WHERE status = 'UNIQUE' OR (status = 'DUPLICATE_IDENTICAL' AND key = first)""")
def q97_equipment_windings(spark, d):
    out = E.windings_at(E.assembled(E.mapped(_rows(spark, d))))
    rated = F.col("transformer.rated_capacity_kva").cast("double").alias("rated_capacity_kva")
    return out.select("case_key", "source_id", "winding_no", F.col("rated_voltage_kv").cast("double").alias("rated_voltage_kv"), "connection", "raw_ref", "ref_status", rated)


@query(f"""WITH {_EQUIPMENT}, found AS (
  SELECT 'TRANSFORMER' AS kind, case_key, status, unnest([CASE WHEN source_id IS NULL THEN 'Transformer_ID SOURCE_REQUIRED_VALUE_MISSING' END, CASE WHEN u % 11 = 0 THEN 'Transformer_ToBus SOURCE_REFERENCE_INVALID_LITERAL' END, CASE WHEN u % 40 <= 2 THEN 'Transformer_RatedCapacity_kVA SOURCE_VALUE_OUT_OF_RANGE' END,
    CASE WHEN u % 13 = 0 THEN 'Transformer_LowVoltage_kV SOURCE_VALUE_PARSE_FAILED' END, CASE WHEN u % 5 = 0 THEN 'Transformer_NumTaps SOURCE_VALUE_OUT_OF_RANGE' END, CASE WHEN status LIKE 'DUP%' THEN 'Transformer_ID SOURCE_ID_' || status END]) AS what FROM t
  UNION ALL SELECT 'LOAD', 'k' || (c_custkey % 20), 'UNIQUE', unnest([CASE WHEN c_custkey % 9 = 0 THEN 'Load_Phase SOURCE_ENUM_UNKNOWN' END, CASE WHEN c_custkey % 17 = 0 THEN 'Load_P_kW SOURCE_VALUE_PARSE_FAILED' END, CASE WHEN c_custkey % 3 = 2 THEN 'Load_PF SOURCE_VALUE_OUT_OF_RANGE' END]) FROM customer)
SELECT case_key, kind, split_part(what, ' ', 1) AS field, split_part(what, ' ', 2) AS code, count(*) AS n, count(*) FILTER (WHERE status IN ('UNIQUE', 'DUPLICATE_IDENTICAL')) AS n_about_published FROM found WHERE what IS NOT NULL GROUP BY ALL""")
def q98_equipment_issues(spark, d):
    found = E.issues(E.assembled(E.mapped(_rows(spark, d))))
    return found.groupBy("case_key", "kind", "field", "code").agg(F.count("*").alias("n"), F.count("equipment_id").alias("n_about_published"))


@query(f"""WITH {_EQUIPMENT}, c AS (SELECT 'TRANSFORMER' AS kind, case_key, CASE WHEN status IS NULL THEN 'REJECTED' WHEN status <> 'UNIQUE' THEN 'DUPLICATE' WHEN u % 11 = 0 OR u % 40 <= 2 OR u % 13 = 0 OR u % 5 = 0 THEN 'RECOVERABLE' ELSE 'MAPPED' END AS category FROM t
  UNION ALL SELECT 'LOAD', 'k' || (c_custkey % 20), CASE WHEN c_custkey % 9 = 0 OR c_custkey % 17 = 0 OR c_custkey % 3 = 2 THEN 'RECOVERABLE' ELSE 'MAPPED' END FROM customer)
SELECT case_key, kind, category, count(*) AS n_rows FROM c GROUP BY ALL""")
def q99_equipment_categories(spark, d):
    return E.row_categories(E.assembled(E.mapped(_rows(spark, d)))).groupBy("case_key", "kind", "category").agg(F.count("*").alias("n_rows"))
