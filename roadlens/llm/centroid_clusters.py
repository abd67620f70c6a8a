"""Clusters of integer vectors around centroids, by partial-distance search.

Components become integers, so distances, sums and centroids are exact and the same on every run and every cluster. A
round is one pass over the vectors: each batch finds the nearest centroids, and a task returns one row for each centroid it
met: count, componentwise sums, summed distance. Nothing of a vector is shuffled or written.

The search accumulates squared differences over the dimensions of the highest variance first, STEP at a time. What a
vector has to all centroids over the first of them names a candidate, whose whole distance is the best so far; a centroid is
abandoned once what it has gathered is strictly above that. Those that are left after all dimensions are compared in full,
equal distances by number. The order of dimensions decides how early a centroid goes, never which one wins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spread

DIMS, CENTROIDS, ROUNDS, SCALE = 64, 40, 5, 256
#: Dimensions between two looks at who is to be abandoned.
STEP = 8
#: Vectors that are compared together: bounds what a batch takes, BLOCK x centroids x 8 bytes and less.
BLOCK = 4096
#: Integer components lie below this, so that a squared distance of up to 256 dimensions fits into a long.
LIMIT = 1 << 26


def whole(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), x as double; raises if one of them is too large for exact distances."""
    out = np.floor(scale * values.astype(np.float64))
    if out.size and np.abs(out).max() >= LIMIT:
        raise ValueError(f"a component times {scale} reaches {LIMIT}: its distances would not fit into a long")
    return out.astype(np.int64)


def matrix(column: pa.Array, dims: int = DIMS, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of an array column are kept, and their components as integers: dims of them, none null or non-finite."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    kept = sizes == dims
    values = column.filter(pa.array(kept)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)  # a null becomes NaN
    sound = np.isfinite(values).all(axis=1)
    kept[kept] = sound
    return kept, whole(values[sound], scale)


def nearest(x: np.ndarray, centroids: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the number of the nearest centroid (of equal ones the smallest) and its squared distance."""
    cluster, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for k in range(0, len(x), BLOCK):
        cluster[k : k + BLOCK], distance[k : k + BLOCK] = _nearest(np.ascontiguousarray(x[k : k + BLOCK, order]), np.ascontiguousarray(centroids[:, order]))
    return cluster, distance


def _nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    part = np.zeros((len(x), len(c)), np.int64)
    for d in range(min(STEP, x.shape[1])):
        part += (x[:, d, None] - c[None, :, d]) ** 2
    first = part.argmin(axis=1)
    best = ((x - c[first]) ** 2).sum(axis=1)
    row, number = np.nonzero(part <= best[:, None])
    gathered = part[row, number]
    for d in range(STEP, x.shape[1], STEP):
        gathered += ((x[row, d : d + STEP] - c[number, d : d + STEP]) ** 2).sum(axis=1)
        left = gathered <= best[row]
        row, number, gathered = row[left], number[left], gathered[left]
    # every row has one left at least: its candidate
    nearest_first = np.lexsort((number, gathered, row))
    row, number, gathered = row[nearest_first], number[nearest_first], gathered[nearest_first]
    begin = np.r_[True, row[1:] != row[:-1]] if len(row) else np.zeros(0, bool)
    return number[begin], gathered[begin]


def _sound(dims: int) -> Column:
    """Whether a row's vector is kept, as matrix() has it."""
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size("v") == dims) & ~odd, F.lit(False))


def start(rows: DataFrame, k: int, salt: int, dims: int, scale: int) -> np.ndarray:
    """The kept vectors with the k smallest hashes of salt:id; rows of one id by their components, those without an id last."""
    drawn = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    first = rows.filter(_sound(dims)).orderBy(drawn.asc_nulls_last(), "v").limit(k).collect()
    return whole(np.array([r["v"] for r in first], np.float64).reshape(-1, dims), scale)


def spread_of(rows: DataFrame, dims: int, scale: int) -> np.ndarray:
    """The dimensions, those of the highest variance over all kept vectors first."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, squares = 0, np.zeros(dims), np.zeros(dims)
        for b in batches:
            x = matrix(b.column("v"), dims, scale)[1].astype(np.float64)
            n, total, squares = n + len(x), total + x.sum(axis=0), squares + (x * x).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"n": [n], "total": [total.tolist()], "squares": [squares.tolist()]})

    found = rows.select("v").mapInArrow(sums, "n long, total array<double>, squares array<double>")
    of = lambda name: F.array(*[F.sum(F.col(name)[d]) for d in range(dims)]).alias(name)
    r = found.agg(F.sum("n").alias("n"), of("total"), of("squares")).first()
    if not r["n"]:
        return np.arange(dims)
    mean = np.array(r["total"]) / r["n"]
    return np.argsort(-(np.array(r["squares"]) / r["n"] - mean * mean), kind="stable")


def fold(rows: DataFrame, centroids: np.ndarray, order: np.ndarray, scale: int) -> tuple[np.ndarray, list[list[int]], np.ndarray]:
    """Count, componentwise sum and summed distance of each centroid's vectors: one pass, one row per task and centroid."""
    k, dims = centroids.shape

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, inertia = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for b in batches:
            x = matrix(b.column("v"), dims, scale)[1]
            cluster, distance = nearest(x, centroids, order)
            n += np.bincount(cluster, minlength=k)
            by = np.argsort(cluster, kind="stable")
            met, begin = np.unique(cluster[by], return_index=True)
            if len(met):
                sums[met] += np.add.reduceat(x[by], begin, axis=0)
                inertia[met] += np.add.reduceat(distance[by], begin)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(met, pa.int32()), "n": pa.array(n[met], pa.int64()), "sums": pa.array(sums[met].tolist(), pa.list_(pa.int64())), "inertia": pa.array(inertia[met], pa.int64())})

    found = rows.select("v").mapInArrow(folded, "cluster int, n long, sums array<long>, inertia long")
    total = found.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[d]) for d in range(dims)]).alias("sums"), F.sum("inertia").alias("inertia"))
    n, sums, inertia = np.zeros(k, np.int64), [[0] * dims for _ in range(k)], np.zeros(k, np.int64)
    for r in total.collect():  # a row for each centroid
        n[r["cluster"]], sums[r["cluster"]], inertia[r["cluster"]] = r["n"], r["sums"], r["inertia"]
    return n, sums, inertia


def moved(centroids: np.ndarray, n: np.ndarray, sums: list[list[int]]) -> np.ndarray:
    """Each centroid at the floor of its vectors' mean; one without vectors stays."""
    return np.array([[s // int(m) for s in row] if m else old.tolist() for old, m, row in zip(centroids, n, sums)], np.int64).reshape(centroids.shape)


def train(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, salt: int = 2, dims: int = DIMS, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[np.ndarray, np.ndarray]:
    """The centroids after `rounds` rounds, numbered from 0 (as many as there are kept vectors if these are fewer than k), and the order of dimensions that suits their search."""
    rows = _rows(vectors, id_col, vec_col)
    centroids = start(rows, k, salt, dims, scale)
    order = spread_of(rows, dims, scale)
    for _ in range(rounds if len(centroids) else 0):
        n, sums, _ = fold(rows, centroids, order, scale)
        centroids = moved(centroids, n, sums)
    return centroids, order


def _rows(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return spread(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")))


def assigned(vectors: DataFrame, centroids: np.ndarray, order: np.ndarray, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding", facts: dict[str, tuple[pa.DataType, list]] | None = None) -> DataFrame:
    """vec_id, cluster, distance of every kept vector; without centroids no rows. facts: further columns, a value for each centroid."""
    dims = centroids.shape[1]
    known = {name: pa.array(values, kind) for name, (kind, values) in (facts or {}).items()}

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, x = matrix(b.column("v"), dims, scale)
            cluster, distance = nearest(x, centroids, order)
            number = pa.array(cluster, pa.int32())
            yield pa.RecordBatch.from_pydict({"vec_id": b.column("id").filter(pa.array(kept)), "cluster": number, "distance": pa.array(distance, pa.int64())} | {name: values.take(number) for name, values in known.items()})

    rows, more = _rows(vectors, id_col, vec_col), "".join(f", {name} {'string' if pa.types.is_string(v.type) else 'long'}" for name, v in known.items())
    return (rows if len(centroids) else rows.limit(0)).mapInArrow(of, f"vec_id long, cluster int, distance long{more}")


def clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, salt: int = 2, dims: int = DIMS, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row per kept vector.

    Kept are vectors of exactly dims components, none null or non-finite; all others (null, empty, of another length) have
    no row. A repeated row is a vector of its own; of equal ids that open the draw the smaller vector comes first, and rows
    without an id take part but are drawn last. An empty table, or one that keeps nothing, gives an empty one; other
    columns are not looked at. Fewer vectors than k give as many centroids. A component of 2**26 / scale or more in size is
    an error, as its distances would not fit. Work is a fixed number of passes; a task holds one batch and a row per centroid.
    """
    centroids, order = train(vectors, k, rounds, salt, dims, scale, id_col, vec_col)
    inertia = fold(_rows(vectors, id_col, vec_col), centroids, order, scale)[2].tolist() if len(centroids) else []
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = {"cluster_inertia": (pa.int64(), inertia), "inertia": (pa.int64(), [sum(inertia)] * len(inertia)), "centroid_sha256": (pa.string(), names)}
    return assigned(vectors, centroids, order, scale, id_col, vec_col, facts)
