import random

import pytest

from roadlens.operators import graphs
from roadlens.operators.components import connected_components
from roadlens.session import cut, join_often


def brute(pairs):
    root = {n: n for p in pairs for n in p}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in root}


@pytest.mark.parametrize("few, hub", [(500_000, 10_000), (0, 4), (0, 10_000)])
def test_components_of_chains_hubs_and_random_links(spark, few, hub):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(1000, 2000 + i) for i in range(60)] + [(3000 + i, 9000) for i in range(60)] + [(rng.randrange(5000, 5100), rng.randrange(5000, 5100)) for _ in range(70)]
    df = spark.createDataFrame([*links, *links[:9], (7, None), (None, None), (8, 8)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df, "a", "b", few, hub).collect()}
    assert got == brute([p for p in links if p[0] != p[1]])
    assert connected_components(df.limit(0), "a", "b", few, hub).collect() == []


def test_a_hub_is_no_hot_task(spark):
    star = spark.range(1, 5_001).selectExpr("0L a", "id b")
    out = connected_components(star, "a", "b", few=0, hub=100)
    assert out.filter("component = 0").count() == 5_001
    plan = out._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan


def test_loops_alone_are_components(spark):
    df = spark.createDataFrame([(1, 1), (2, 3)], "src long, dst long")
    assert {(r["node"], r["component"]) for r in graphs.components(df).collect()} == {(1, 1), (2, 2), (3, 2)}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_joins_with_keys_that_occur_often(spark, how):
    rows = spark.createDataFrame([(k, i) for k, n in ((1, 50), (2, 3), (3, 60), (9, 2)) for i in range(n)] + [(None, 0)], "k int, i int")
    names = cut(spark.createDataFrame([(1, "a", 50), (2, "b", 3), (3, "c", 60), (4, "d", 0)], "k int, name string, n int"))
    want = sorted(map(str, rows.join(names.drop("n"), ["k"], how).collect()))
    for often in (10, 1000):
        assert sorted(map(str, join_often(rows, names, ["k"], how, often).collect())) == want


def test_links_that_lie_together_become_stars_before_any_shuffle(spark, monkeypatch):
    """Chunks of one Arrow batch or of many; a star of each component of a chunk is what is left of its links."""
    import pyarrow as pa

    from roadlens.operators import components

    rng = random.Random(5)
    pairs = [(a, b) for a, b in ((rng.randrange(300), rng.randrange(300)) for _ in range(4000)) if a > b]
    batches = [pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs[i : i + 97]], pa.int64()) for k in (0, 1)], ["u", "v"]) for i in range(0, len(pairs), 97)]
    for chunk in (1, 500, 10**6):
        monkeypatch.setattr(components, "CHUNK", chunk)
        out = [(u, v) for b in components._telling(iter(batches)) for u, v in zip(b["u"].to_pylist(), b["v"].to_pylist())]
        assert all(u > v for u, v in out) and brute(out) == brute(pairs)
    assert len(out) == 299
    assert list(components._telling(iter([]))) == []


def test_repeated_edges_change_no_failure(spark):
    rows = [(1, 2), (2, 3), (2, 3), (3, 4), (5, 5), (2, 1)]
    df = spark.createDataFrame(rows, "src long, dst long")
    out = graphs.failure(df, spark.createDataFrame([(2,)], "node long")).first()
    assert tuple(out)[:3] == (5, 4, 2)
