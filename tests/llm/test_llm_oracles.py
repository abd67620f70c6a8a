"""The operators that SQL can express against DuckDB over the same files."""

import duckdb
import pytest

from roadlens.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_operator_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLES[name]).fetchdf()
    names = sorted(df.columns)
    assert names == sorted(want.columns)
    got = df.toPandas()[names].sort_values(names).reset_index(drop=True)
    assert got.astype(object).values.tolist() == want[names].sort_values(names).reset_index(drop=True).astype(object).values.tolist()
