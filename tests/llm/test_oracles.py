"""The subpackage's queries run at sf0.001, and equal their DuckDB form where
they have one."""

import duckdb
import pytest

from tools.check_oracle import TABLES, digest
from voxtab.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_a_row_for_each_input_row(spark, name):
    table = "pages" if name.startswith("op3") else "documents"
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
