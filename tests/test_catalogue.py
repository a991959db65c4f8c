from decimal import Decimal

import duckdb
import pytest

from skein.plans import assets, catalogue, decisions, experiments, networks, rulebook  # noqa: F401
from skein.sources.archives import read_member, split_records

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()
@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    df = catalogue.queries()[name](spark, DIR)
    rel = con.sql(catalogue.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    plain = lambda x: float(x) if isinstance(x, (int, float, Decimal)) else x
    lines = lambda rows: sorted(str([plain(x) for x in r]) for r in rows)
    want = lines(rel.select(*map(duckdb.ColumnExpression, columns)).fetchall())
    got = lines(df.select(columns).collect())
    assert got == want and got


def test_strict_csv_keeps_rows_before_a_failure():
    rows = list(read_member(b"\xef\xbb\xbfa,b\r\n1,2\r\n3\r\n", ["a", "b"]))
    assert [(r[0], r[3]) for r in rows] == [(1, None), (2, "WIDTH_MISMATCH")]
    assert next(read_member(b"x\n", ["a"]))[3] == "HEADER_MISMATCH"


def test_records_respect_quotes():
    raw = b'a,"x\ny"\r\nb,2\nc,3'
    assert split_records(raw) == [b'a,"x\ny"\r\n', b"b,2\n", b"c,3"]
