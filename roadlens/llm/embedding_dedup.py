"""Near-duplicate vectors by int8 tile products with error bounds.

Exact copies are grouped first. The distinct vectors of a label are dealt at random into tiles of about TILE rows; a
tile is one packed row holding int8 codes, a scale and the exact length of the quantisation error of every vector.
Every pair of tiles of a label meets in one task, and takes a byte a component there. An integer product gives each
cosine up to a rigorous bound:

    |x.y - x'.y'| <= e_y + e_x (1 + e_y)        x' = scale * codes, e = |x - x'|, |x| = |y| = 1

so pairs are settled by the bound. Only those it leaves open are computed anew in double precision: for these the
vectors themselves are fetched, once for each block of OPEN pairs, which travels as one row of numbers. A task returns for
each linked vector one row: how many vectors it links to, and the root of its set in that task, so a group of near copies
costs rows in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.operators.components import connected_components
from roadlens.operators.unions import join_roots

from .common import cut, join_often, small

TILE = 2048
#: Open pairs that are computed anew together.
OPEN = 1 << 16
#: A sum of so many products of int8 codes is exact in float32, which lets BLAS multiply integers.
EXACT_DIMS = 2**24 // 127**2


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and error lengths of unit rows."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    return codes, scale, np.sqrt(((x - codes * scale[:, None]) ** 2).sum(axis=1)) + 1e-12


def integer_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], EXACT_DIMS):
        out += a[:, k : k + EXACT_DIMS].astype(np.float32) @ b[:, k : k + EXACT_DIMS].astype(np.float32).T
    return out


def settled(qa, sa, ea, qb, sb, eb, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Boolean matrices from codes, scales and errors: cosines surely at or above the threshold, and those the bounds leave open."""
    about = integer_product(qa, qb) * (sa[:, None] * sb[None, :])
    bound = eb[None, :] + ea[:, None] * (1 + eb[None, :]) + 1e-9
    linked = about - bound >= threshold
    return linked, (about + bound >= threshold) & ~linked


def _packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    codes, scale, error = quantise(unit_rows(np.array(rows["v"].tolist(), dtype=np.float64)))
    parts = {"row": rows["row"].to_numpy(np.int64), "node": rows["node"].to_numpy(np.int64), "copies": rows["n"].to_numpy(np.int64), "codes": codes, "scale": scale, "error": error}
    return pd.DataFrame({"label": [key[0]], "dim": [key[1]], "tile": [key[2]], "tiles": [rows["tiles"].iloc[0]]} | {k: [v.tobytes()] for k, v in parts.items()})


def _meet(threshold: float):
    def meet(key: tuple, tiles: pd.DataFrame) -> pd.DataFrame:
        dim = int(key[1])
        get = lambda row, k, kind, *shape: np.frombuffer(row[k], kind).reshape(-1, *shape)
        sides = []
        for _, t in tiles.sort_values("tile").iterrows():
            sides.append((get(t, "node", np.int64), get(t, "copies", np.int64), get(t, "row", np.int64), get(t, "codes", np.int8, dim), get(t, "scale", np.float64), get(t, "error", np.float64)))
        a, b, same = sides[0], sides[-1], len(sides) == 1
        na, nb = len(a[0]), len(b[0])
        node = a[0] if same else np.concatenate([a[0], b[0]])
        label, found = np.arange(len(node)), np.zeros(len(node), np.int64)
        left: list[dict] = []
        for k in range(0, na, 256):
            rows = slice(k, min(k + 256, na))
            linked, open_ = settled(*(x[rows] for x in a[3:]), *b[3:], threshold)
            if same:
                linked[np.arange(rows.stop - k), np.arange(k, rows.stop)] = False
                open_ &= np.arange(nb)[None, :] > np.arange(k, rows.stop)[:, None]  # each open pair once
            found[rows] += linked @ b[1]
            if not same:
                found[na : na + nb] += a[1][rows] @ linked
            i, j = np.nonzero(linked)
            label = join_roots(label, i + k, j if same else j + na)
            i, j = np.nonzero(open_)
            for at in range(0, len(i), OPEN):
                part = slice(at, at + OPEN)
                left.append({"meeting": f"{a[2][0]} {b[2][0]} {k} {at}", "a": a[2][i[part] + k].tobytes(), "b": b[2][j[part]].tobytes()})
        hit = found > 0
        out = pd.DataFrame({"node": node[hit], "links": found[hit], "root": node[label[hit]]})
        return pd.concat([out.assign(meeting=None, a=None, b=None), pd.DataFrame(left, columns=["meeting", "a", "b"]).assign(node=0, links=0, root=0)])[list(MET)]

    return meet


MET = {"node": "long", "links": "long", "root": "long", "meeting": "string", "a": "binary", "b": "binary"}


def _rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """meeting, row: the vectors that the open pairs of a meeting need, once each."""
    for batch in batches:
        for r in batch.itertuples():
            yield pd.DataFrame({"meeting": r.meeting, "row": np.unique(np.frombuffer(r.a + r.b, np.int64))})


def _settle(threshold: float):
    def settle(key: tuple, pairs: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        vectors = vectors.sort_values("row")
        row, node, copies, x = vectors["row"].to_numpy(np.int64), vectors["node"].to_numpy(np.int64), vectors["n"].to_numpy(np.int64), unit_rows(np.array(vectors["v"].tolist(), np.float64))
        label, found = np.arange(len(row)), np.zeros(len(row), np.int64)
        for r in pairs.itertuples():
            i, j = (np.searchsorted(row, np.frombuffer(side, np.int64)) for side in (r.a, r.b))
            linked = np.einsum("ij,ij->i", x[i], x[j]) >= threshold
            i, j = i[linked], j[linked]
            np.add.at(found, i, copies[j])
            np.add.at(found, j, copies[i])
            label = join_roots(label, i, j)
        hit = found > 0
        return pd.DataFrame({"node": node[hit], "links": found[hit], "root": node[label[hit]]})

    return settle


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of vectors; other columns are not looked at.

    Vectors link if their labels are equal and not null, their lengths agree and their cosine reaches the threshold.
    Vectors that are null, empty, zero or hold a null or non-finite component, and rows without an id, link with
    nothing and stay alone. A repeated row counts as a vector of its own. An empty table gives an empty one.
    """
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(~odd & F.exists("v", lambda x: x != 0), F.lit(False))
    # the checkpoint holds the numbers of the rows, so they stay as they are
    distinct = cut(src.filter(sound).groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count("*").alias("n")).withColumn("row", F.monotonically_increasing_id()))
    dims = distinct.withColumn("dim", F.size("v"))
    counts = cut(dims.groupBy("label", "dim").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles")))
    kind = dict(distinct.dtypes)["label"]
    packed = (
        dims.join(small(counts), ["label", "dim"])
        .withColumn("tile", F.expr("cast(pmod(xxhash64(v), tiles) as int)"))
        .groupBy("label", "dim", "tile")
        .applyInPandas(_packed, f"label {kind}, dim int, tile int, tiles int, row binary, node binary, copies binary, codes binary, scale binary, error binary")
    )
    met = (
        packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")})
        .groupBy("label", "dim", "i", "j")
        .applyInPandas(_meet(threshold), ", ".join(f"{k} {t}" for k, t in MET.items()))
    )
    met = cut(met)
    open_, met = met.filter("meeting is not null").select("meeting", "a", "b"), met.filter("meeting is null").select("node", "links", "root")
    if open_.limit(1).count():
        needed = open_.mapInPandas(_rows_of, "meeting string, row long").join(distinct.select("row", "node", "n", "v"), "row")
        met = met.union(cut(open_.groupBy("meeting").cogroup(needed.groupBy("meeting")).applyInPandas(_settle(threshold), "node long, links long, root long")))
    component = connected_components(met, "node", "root")
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    known = distinct.join(links, "node", "left").join(component, "node", "left")
    known = cut(known.select("label", "v", "node", "n", F.col("n").alias("copies"), "links", "component"))
    named = F.col("vec_id").isNotNull()
    return join_often(src, known, ["label", "v"], "left").select(
        "vec_id",
        F.coalesce(F.when(named, F.coalesce("links", F.lit(0)) + F.col("copies") - 1), F.lit(0)).cast("long").alias("n_links"),
        (c := F.when(named, F.coalesce("component", "node", "vec_id"))).alias("component_id"),
        F.col("vec_id").eqNullSafe(c).alias("kept"),
    )
