"""Near-duplicate documents by SimHash, found through a segment-popcount grid.

A fingerprint of 64 bits is mapped to the bit counts of its 32 two-bit segments. Flipping a bit moves one count by
one, so the Manhattan distance of two count vectors is a lower bound of the Hamming distance of the fingerprints.
Within distance 3, one of the two halves of 16 counts differs by at most 1. Each half is a grid of unit cells: a
fingerprint lives in its own cell of either half and looks into the cells one step up; a pair one step apart meets
where the lower one looks up. All pairs within the range meet, and each is verified on the full fingerprints.

Cells are read in sorted order, one after another. Only links of a spanning forest leave a task; a cell of more than
CELL residents is split into tiles of residents that all its visitors pass, so no cell is gathered whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.operators.components import connected_components
from roadlens.operators.unions import join_roots

from .common import cut, join_often, small, spread, unused

CELL = 2048
SEED = 42
EVERY_OTHER_BIT = 0x55555555


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash over word shingles of a whole text, as an unsigned number; 0 if there are no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > width:
        starts, ends = starts[: 1 - width], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones, total, of = np.zeros(64, np.int64), len(starts), xxhash.xxh64_intdigest
    for k in range(0, total, 1 << 15):
        h = np.array([of(joined[i:j], SEED) for i, j in zip(starts[k : k + (1 << 15)].tolist(), ends[k : k + (1 << 15)].tolist())], np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(text: Column) -> Column:
    """Fingerprints as signed numbers with the same bits."""

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(x) for x in batch], np.uint64).view(np.int64))

    return of(text)


def counts_of(fp: Column, half: int) -> Column:
    """The 16 segment counts of a half (0: high bits), two bits each."""
    down = 32 * (1 - half)
    return F.shiftrightunsigned(fp, down).bitwiseAND(F.lit(EVERY_OTHER_BIT)) + F.shiftrightunsigned(fp, down + 1).bitwiseAND(F.lit(EVERY_OTHER_BIT))


def _grid(prints: DataFrame) -> DataFrame:
    """fp, half, own cell: two rows for each fingerprint."""
    both = F.array(*[F.struct(F.lit(h).alias("half"), counts_of(F.col("fp"), h).alias("cell")) for h in (0, 1)])
    return prints.select("fp", F.inline(both))


def _visits(grid: DataFrame) -> DataFrame:
    """key, fp, guest: a fingerprint in its own cell (guest 0) and in the cells one step up (guest 1)."""
    key = F.shiftleft(F.col("half").cast("long"), 32)
    own = F.struct((key + F.col("cell")).alias("key"), F.lit(0).cast("byte").alias("guest"))
    up = [F.when(F.shiftright("cell", 2 * i).bitwiseAND(F.lit(3)) < 2, F.struct((key + F.col("cell") + F.lit(1 << 2 * i)).alias("key"), F.lit(1).cast("byte").alias("guest"))) for i in range(16)]
    return grid.select("fp", F.inline(F.array_compact(F.array(own, *up))))


def _tiled(visits: DataFrame, crowded: DataFrame) -> DataFrame:
    """Adds tile: in a crowded cell a resident stays in one tile and visits those before it; a guest visits all."""
    all_ = visits.join(small(crowded), "key", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    mine = F.expr("pmod(xxhash64(fp), tiles)")
    stays = all_.withColumn("mine", mine)
    spread = F.when(F.col("tiles") == 1, F.array(F.struct(F.lit(0).cast("long").alias("tile"), F.col("guest").alias("role")))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), F.when(F.col("guest") == 0, F.col("mine")).otherwise(F.col("tiles") - 1).cast("long")), lambda t: F.struct(t.alias("tile"), F.when((F.col("guest") == 0) & (t == F.col("mine")), F.lit(0)).otherwise(F.lit(1)).cast("byte").alias("role")))
    )
    return stays.select("key", "fp", F.inline(spread))


def _forest(most: int):
    def of_cell(home: np.ndarray, guests: np.ndarray, label: np.ndarray, out: list) -> np.ndarray:
        for k in range(0, len(guests), 1024):
            g = guests[k : k + 1024]
            near = np.bitwise_count((home[:, None] ^ g[None, :]).view(np.uint64)) <= most
            i, j = np.nonzero(near)
            if len(i):
                first = near.argmax(axis=0)
                label = join_roots(label, i, first[j])
                met = np.unique(j)
                out.append((g[met], home[first[met]]))
        return label

    def forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, home, label = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for rows in batches:
            out: list = []
            key, tile, role, fp = (rows[c].to_numpy() for c in ("key", "tile", "role", "fp"))
            new = np.r_[True, (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])]
            begin = np.flatnonzero(new)
            end = np.r_[begin[1:], len(key)]
            busy = (end - begin > 1) | (begin == 0) | (end == len(key))
            for b, e in zip(begin[busy], end[busy]):
                if (key[b], tile[b]) != at:
                    if len(home):
                        out.append((home, home[label]))
                    at, home, label = (key[b], tile[b]), np.zeros(0, np.int64), np.zeros(0, np.int64)
                come = fp[b:e][role[b:e] == 0]
                if len(come):
                    label = np.r_[label, np.arange(len(home), len(home) + len(come))]
                    home = np.r_[home, come]
                    label = of_cell(home, come, label, out)
                if len(home):
                    label = of_cell(home, fp[b:e][role[b:e] == 1], label, out)
            if out:
                a, b = (np.concatenate(x) for x in zip(*out))
                yield pd.DataFrame({"a": a[a != b], "b": b[a != b]}).drop_duplicates()
        if len(home):
            yield pd.DataFrame({"a": home, "b": home[label]}).query("a != b")

    return forest


def links(prints: DataFrame, most: int = 3, cell: int = CELL) -> DataFrame:
    """a, b: links between distinct fingerprints that hold together all those within Hamming distance most (<= 3)."""
    if not 0 <= most <= 3:
        raise ValueError("the grid covers Hamming distances up to 3")
    grid = _grid(prints)
    key = (F.shiftleft(F.col("half").cast("long"), 32) + F.col("cell")).alias("key")
    crowded = cut(grid.groupBy(key).count().filter(F.col("count") > cell).select("key", F.ceil(F.col("count") / cell).cast("int").alias("tiles")))
    met = _tiled(_visits(grid), crowded).repartition("key", "tile").sortWithinPartitions("key", "tile", "role")
    return met.mapInPandas(_forest(most), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, most: int = 3, id_col: str = "doc_id", text_col: str = "text", cell: int = CELL) -> DataFrame:
    """doc_id, fingerprint, component_id: one row per row of docs; other columns are not looked at.

    A null text counts as empty; texts without words have fingerprint zero and link like others. Ids are compared
    as numbers; a null id is never a component's name, unless all of a component have none, which leaves it null.
    Repeated rows and repeated ids are rows like others. An empty table gives an empty one.
    """
    found = _grouped(docs, most, id_col, text_col, cell)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _grouped(docs: DataFrame, most: int, id_col: str = "doc_id", text_col: str = "text", cell: int = CELL) -> DataFrame:
    """doc_id, fp, c, component_id: like near_duplicates, with the group itself, as groups of one repeated id share its name."""
    src = cut(spread(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).select("doc_id", fingerprints(F.col("text")).alias("fp")))
    prints = cut(src.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    component = connected_components(links(prints.select("fp"), most, cell), "a", "b")
    linked = cut(prints.join(component, prints["fp"] == component["node"]).select("fp", "least", F.col("component").alias("c")))
    # a component may hold a third of all rows: its name is broadcast, or joined by exchanges on both sides, which AQE may split
    names = small(cut(linked.groupBy("c").agg(F.min("least").alias("component_id"))), 500_000)
    of_print = prints.join(linked.join(names, "c").select("fp", "c", "component_id"), "fp", "left")
    of_print = of_print.select("fp", F.coalesce("c", "fp").alias("c"), F.when(F.col("c").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"), "n")
    return join_often(src, cut(of_print), ["fp"]).select("doc_id", "fp", "c", "component_id")


def one_of_each(docs: DataFrame, most: int = 3) -> DataFrame:
    """The rows of docs (all columns) that represent their group: of those whose id names it, one of the least fingerprint.

    An id with texts of several groups stays once for each group that it names, and only with such a text. Rows without an
    id stay only if no row of their group has one, one for each fingerprint. Null and empty texts are one text, so one row
    of them stays; repeated rows go; an empty table stays empty. Other columns may have any names and hold anything.
    """
    id_, fp = unused(docs, "id"), unused(docs, "fp")
    found = cut(_grouped(docs.select("doc_id", "text"), most))
    heads = cut(found.filter(F.col("doc_id") == F.col("component_id")).groupBy("c").agg(F.min("doc_id").alias(id_), F.min("fp").alias(fp)))
    often = cut(found.filter("doc_id is not null").groupBy(F.col("doc_id").alias(id_)).count().filter("count > 1").select(id_))
    if often.limit(1).count():
        # an id that repeats does not tell a row; its texts do
        named = docs.withColumn(id_, F.col("doc_id").cast("long"))
        once = named.join(heads.join(often, id_, "left_anti").select(id_), id_, "left_semi")
        again = named.join(heads.join(often, id_, "left_semi").select(id_), id_, "left_semi").withColumn(fp, fingerprints(F.col("text")))
        again = again.join(heads, [id_, fp], "left_semi").dropDuplicates([id_, fp])
        kept = once.select(*docs.columns).union(again.select(*docs.columns))
    else:
        kept = docs.join(heads.select(F.col(id_).alias("doc_id")), "doc_id", "left_semi").select(*docs.columns)
    if found.filter("component_id is null").limit(1).count():
        nameless = found.filter("component_id is null").select(F.col("fp").alias(fp)).distinct()
        alone = docs.filter("doc_id is null").withColumn(fp, fingerprints(F.col("text"))).join(nameless, fp, "left_semi").dropDuplicates([fp])
        kept = kept.union(alone.select(*docs.columns))
    return kept
