import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadlens.llm import centroid_clusters as cc

SF = "/root/testdata/sf0.01"


def brute(rows, k=40, rounds=5, salt=2, dims=64, scale=256):
    """(vec_id, cluster, distance, cluster_inertia, inertia, hash) by plain integers over all pairs."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    drawn = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in drawn[:k]]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [min((distance(v, c), j) for j, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds if kept else 0):
        of = assign()
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, of) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    of = assign() if kept else []
    own = [sum(d for d, c in of if c == j) for j in range(len(centroids))]
    return sorted(((i, c, d, own[c], sum(own), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for (i, _), (d, c) in zip(kept, of)), key=repr)


def got(df, **how):
    return sorted((tuple(r) for r in cc.clusters(df, **how).collect()), key=repr)


def test_the_whole_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").limit(150)  # plain integers are slow
    assert got(df) == brute([(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_small_odd_tables(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 2]) for i in range(60)]  # many ties
    rows += [(3, rows[3][1]), (3, rows[9][1]), (None, rows[0][1]), (None, rows[1][1])]
    rows += [(90, None), (91, []), (92, [1.0] * 3), (93, [1.0] * 5), (94, [None, 1.0, 1.0, 1.0]), (95, [float("nan")] * 4), (96, [float("inf"), 0.0, 0.0, 0.0]), (97, [-0.0] * 4), (98, [-1e-9] * 4)]
    df = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "vec_id long, embedding array<double>, id int, v string, cluster double").repartition(5)
    for k in (1, 7, 100):
        assert got(df, k=k, dims=4, rounds=3) == brute(rows, k=k, dims=4, rounds=3)
    assert got(df.filter("vec_id between 90 and 96"), dims=4) == [] == got(df.limit(0), dims=4)
    assert cc.clusters(df.limit(0), dims=4).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_empty_clusters_stay(spark):
    rows = [(i, [0.0, 0.0]) for i in range(5)] + [(7, [1.0, 1.0])]
    assert got(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=4, dims=2) == brute(rows, k=4, dims=2)


def test_components_too_large_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e30] * 2)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="would not fit"):
        cc.clusters(df, dims=2)


def test_the_search_abandons_and_stays_exact():
    rng = np.random.default_rng(1)
    x, c = rng.integers(-300, 300, (5000, 64)), rng.integers(-300, 300, (40, 64))
    c[7] = c[3]  # a tie: the smaller number wins
    x[:40] = c
    full = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    for order in (np.arange(64), rng.permutation(64)):
        cluster, distance = cc.nearest(x, c, order)
        assert (cluster == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert cc.nearest(x[:0], c, np.arange(64))[0].shape == (0,)


def test_kept_rows_of_a_sliced_column():
    column = pa.array([None, [1.0, 2.0], [1.0], [None, 1.0], [0.5, -0.001]], pa.list_(pa.float32())).slice(1)
    kept, x = cc.matrix(column, 2)
    assert kept.tolist() == [True, False, False, True] and x.tolist() == [[256, 512], [128, -1]]


def test_a_round_shuffles_a_row_for_each_task_and_centroid(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    centroids, order = cc.train(df, rounds=1)
    assert len(centroids) == 40 and sorted(order) == list(range(64))
    plan = cc.assigned(df, centroids, order)._jdf.queryExecution().toString()
    assert "Join" not in plan and "label" not in plan.split("Physical Plan")[1]
    assert cc.assigned(df, centroids, order).agg(F.count("*")).first()[0] == df.count()
