"""Every registered query against DuckDB over the same files: names, types, rows and values."""

import math

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLES = {**__spark_entry__.catalogue.ORACLES}
#: What DuckDB types may come as in Spark.
SAME = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "HUGEINT": "bigint", "INTEGER": "bigint"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


def ordered(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, SF)
    want = duck.execute(ORACLES[name])
    kinds = {d[0]: str(d[1]) for d in want.description}
    rows = want.fetchall()
    assert sorted(df.columns) == sorted(kinds)
    assert {c: t for c, t in df.dtypes} == {c: SAME.get(t.split("(")[0], t) for c, t in kinds.items()}
    got = ordered(df.columns, df.collect())
    expected = ordered(list(kinds), rows)
    assert len(got) == len(expected) > 0
    for a, b in zip(got, expected):
        assert a == b
