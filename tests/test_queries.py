"""Every engine query against its SQL in DuckDB."""

import os

import duckdb
import pytest

from goldweave.plans import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def compared(df):
    cols = sorted(df.columns)
    return cols, sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ours = queries.QUERIES[name](spark, SF).toPandas()
    assert name in queries.ORACLE_SQL
    assert compared(ours) == compared(con.execute(queries.ORACLE_SQL[name]).df())


def test_mean_confidence_is_rounded_once(spark):
    # 217.58 / 833 = 0.26120048: at seven digits 0.2612005, and that at six digits 0.261201
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert compared(queries.QUERIES["gauges"](spark, sf).toPandas()) == compared(con.execute(queries.ORACLE_SQL["gauges"]).df())
