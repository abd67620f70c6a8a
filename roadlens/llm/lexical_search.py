"""Exact top-k of ranked word search by dual-sorted wavelet trees.

An index is a table of shards, each over a bounded block of documents and built where these are read: nothing is shuffled.
A shard puts the postings of all its terms one after another, each term's by falling impact, and keeps the sequence
of their documents as a wavelet tree (its levels as rows of bits, zeros first). So a term is an interval of the root,
and in every node below, which holds the documents of a range of ids, an interval that is still in order of
impact: its first entry bounds what the term can give to any document there. A search expands the nodes of the highest
sum of such bounds first, many of all items at a time; at a leaf the sum is a document's score. A node whose
bound does not beat the k-th score so far, or ties with it at a higher id, is never opened.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, drop_path, new_path, spread

#: Of UTF-8: capital letters of ASCII become small ones, its other characters but letters and digits blanks; all else is part of terms.
BYTES = bytes(c + 32 if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
#: A shard ends with the document that fills one of these.
SHARD_POSTINGS, SHARD_DOCS = 1 << 20, 1 << 14
#: Terms of the items that are searched in one pass over the index, and postings of the items that are searched together.
PASS_TERMS, TOGETHER = 1 << 18, 1 << 21
#: Nodes of an item that are expanded at once.
BEAM = 32
#: Groups in which the candidates of an item meet before all of them do.
GROUPS = 64
SHARD_SCHEMA = "n_docs long, nameless long, doc_ids binary, terms binary, starts binary, impacts binary, bits binary, all_docs long"


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(BYTES).split()


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def statistics(texts: DataFrame) -> tuple[int, int]:
    """Of one column of texts as bytes: how many have at least one term, and all their terms with repeats."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = terms = 0
        for b in batches:
            for t in b.column(0):
                if n := len(terms_of(t.as_py())):
                    docs, terms = docs + 1, terms + n
        yield pa.RecordBatch.from_pydict({"docs": [docs], "terms": [terms]})

    r = texts.mapInArrow(of, "docs long, terms long").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    return r["docs"] or 0, r["terms"] or 0


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_norm(n: int, docs: int, terms: int) -> int:
    return 100 - 90 + (90 * n * docs) // terms


class Gathered:
    """The postings of the documents of a shard to be."""

    def __init__(self, docs: int, terms: int):
        self.docs, self.terms, self.lexicon = docs, terms, {}
        self.ids, self.norms, self.sizes, self.term, self.tf, self.size = [], [], [], [], [], 0

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        found = terms_of(text)
        if found:
            counted, known = Counter(found), self.lexicon
            self.ids.append(doc_id)
            self.norms.append(length_norm(len(found), self.docs, self.terms))
            self.sizes.append(len(counted))
            self.term.append(np.fromiter((known.setdefault(t, len(known)) for t in counted), np.int64, len(counted)))
            self.tf.append(np.fromiter(counted.values(), np.int64, len(counted)))
            self.size += len(counted)

    def shard(self) -> dict:
        """The row of a shard: see Shard for how it is read."""
        null = np.array([i is None for i in self.ids])
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        by_id = np.lexsort((ids, null))
        place = np.empty(len(ids), np.int64)
        place[by_id] = np.arange(len(ids))
        names = sorted(self.lexicon)
        rank = np.empty(len(names), np.int64)
        rank[[self.lexicon[t] for t in names]] = np.arange(len(names))
        term, doc = rank[np.concatenate(self.term)], np.repeat(place, self.sizes)
        impact = impacts(np.concatenate(self.tf), np.repeat(np.array(self.norms, np.int64), self.sizes))
        order = np.lexsort((doc, -impact, term))
        doc = doc[order]
        levels = []
        for level in range(depth(len(ids)) - 1, -1, -1):
            bit = (doc >> level & 1).astype(bool)
            levels.append(packed(bit))
            doc = np.concatenate([doc[~bit], doc[bit]])
        return {
            "n_docs": len(ids), "nameless": int(null.sum()), "doc_ids": ids[by_id].tobytes(), "terms": b" ".join(names), "starts": np.r_[0, np.cumsum(np.bincount(term, minlength=len(names)))].astype(np.int64).tobytes(),
            "impacts": impact[order].astype(np.int32).tobytes(), "bits": b"".join(levels), "all_docs": self.docs,
        }


def depth(docs: int) -> int:
    return max(1, (docs - 1).bit_length())


def packed(bits: np.ndarray) -> bytes:
    """Bits as 64-bit words, with one empty word at least behind them."""
    out = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
    got = np.packbits(bits, bitorder="little")
    out[: len(got)] = got
    return out.tobytes()


class Shard:
    """A shard in memory: words and ranks of the levels' bits, zeros before each level's ones, impacts in the order of every level."""

    def __init__(self, row):
        self.ids, self.n_docs, self.named = np.frombuffer(row.doc_ids, np.int64), row.n_docs, row.n_docs - row.nameless
        self.terms, self.starts = row.terms.split(b" "), np.frombuffer(row.starts, np.int64)
        impact = np.frombuffer(row.impacts, np.int32)
        self.depth, n = depth(row.n_docs), len(impact)
        self.words = np.frombuffer(row.bits, "<u8").reshape(self.depth, -1)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.ranks = np.cumsum(ones, axis=1) - ones
        self.zeros = n - ones.sum(axis=1)
        self.impacts = np.empty((self.depth + 1, n), np.int32)
        self.impacts[0] = impact
        for level in range(self.depth):
            bit = np.unpackbits(self.words[level].view(np.uint8), bitorder="little")[:n].astype(bool)
            self.impacts[level + 1] = np.concatenate([self.impacts[level][~bit], self.impacts[level][bit]])

    def ones(self, level: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ones before a place of a level."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.ranks[level, word] + np.bitwise_count(self.words[level, word] & ((np.uint64(1) << bit) - np.uint64(1)))


class Items(NamedTuple):
    """What is searched for in one pass: distinct terms with their weights, and each item's terms as a slice of `of`."""

    item_ids: list
    terms: list[bytes]
    begins: np.ndarray
    of: np.ndarray
    weights: np.ndarray


class Best:
    """The best documents of each item so far, as flat columns sorted by item, falling score, id (those without one last)."""

    def __init__(self, items: int, k: int):
        self.k, self.rows = k, tuple(np.zeros(0, np.int64) for _ in range(4))
        # score, lack of an id and id of each item's k-th: 0 and the lowest id until there are so many, as a score has to be above 0
        self.last = np.zeros(items, np.int64), np.zeros(items, np.int64), np.full(items, np.iinfo(np.int64).min)

    def add(self, item: np.ndarray, score: np.ndarray, nameless: np.ndarray, ids: np.ndarray) -> None:
        rows = [np.concatenate(x) for x in zip(self.rows, (item, score, nameless, ids))]
        order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
        rows = [x[order] for x in rows]
        rank = np.arange(len(order)) - np.searchsorted(rows[0], rows[0])
        self.rows = tuple(x[rank < self.k] for x in rows)
        kth = rank == self.k - 1
        for mine, x in zip(self.last, rows[1:]):
            mine[rows[0][kth]] = x[kth]

    def open(self, item: np.ndarray, bound: np.ndarray, nameless: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Whether documents of at most such scores, from that id on, may still enter."""
        score, lack, last = (x[item] for x in self.last)
        return (bound > score) | (bound == score) & (score > 0) & ((nameless < lack) | (nameless == lack) & (ids < last))


def runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for each run of its size."""
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())


def search_shard(shard: Shard, items: Items, best: Best, beam: int = BEAM) -> None:
    """Adds the shard's documents that belong to the best of each item."""
    here = {t: k for k, t in enumerate(shard.terms)}
    found = np.array([here.get(t, -1) for t in items.terms], np.int64)
    item = np.repeat(np.arange(len(items.begins) - 1), np.diff(items.begins))
    known = (found[items.of] >= 0) & (items.weights[items.of] > 0)
    item, term = item[known], items.of[known]
    low, high, w = shard.starts[found[term]], shard.starts[found[term] + 1], items.weights[term]
    filled = np.cumsum(high - low)
    part = filled // TOGETHER
    # an item's terms stay together
    part = part[np.searchsorted(item, item)]
    for p in np.unique(part):
        mine = part == p
        _best_first(shard, item[mine], low[mine], high[mine], w[mine], best, beam)


def _best_first(shard: Shard, item: np.ndarray, low: np.ndarray, high: np.ndarray, w: np.ndarray, best: Best, beam: int) -> None:
    # nodes in columns (item, level, first document, bound) and, node after node, the intervals of their terms
    begin = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
    size = np.diff(np.r_[begin, len(item)])
    bound = np.add.reduceat(w * shard.impacts[0][low], begin)
    node_item, level, first = item[begin], np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
    while len(node_item):
        by = np.lexsort((first, -bound, node_item))
        rank = np.arange(len(by)) - np.searchsorted(node_item[by], node_item[by])
        taken = np.zeros(len(by), bool)
        taken[by[rank < beam]] = True
        at = np.cumsum(size) - size
        pairs = runs(at[taken], size[taken])
        node = np.repeat(np.flatnonzero(taken), size[taken])
        depth_of = level[node]
        one_low, one_high = shard.ones(depth_of, low[pairs]), shard.ones(depth_of, high[pairs])
        sides = []
        for side, (lo, hi) in enumerate(((low[pairs] - one_low, high[pairs] - one_high), (shard.zeros[depth_of] + one_low, shard.zeros[depth_of] + one_high))):
            left = hi > lo
            of, lo, hi, weights = node[left], lo[left], hi[left], w[pairs][left]
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
            parent = of[starts]
            sides.append((node_item[parent], level[parent] + 1, first[parent] + (side << (shard.depth - 1 - level[parent])), np.add.reduceat(weights * shard.impacts[level[of] + 1, lo], starts) if len(of) else np.zeros(0, np.int64), np.diff(np.r_[starts, len(of)]), lo, hi, weights))
        new = [np.concatenate(x) for x in zip(*sides)]
        leaf = new[1] == shard.depth
        if leaf.any():
            best.add(new[0][leaf], new[3][leaf], (new[2][leaf] >= shard.named).astype(np.int64), shard.ids[new[2][leaf]])
        rest = runs(at[~taken], size[~taken])
        node_item, level, first, bound, size, low, high, w = (np.concatenate([x, y]) for x, y in zip((node_item[~taken], level[~taken], first[~taken], bound[~taken], size[~taken], low[rest], high[rest], w[rest]), new))
        stay = (level < shard.depth) & best.open(node_item, bound, (first >= shard.named).astype(np.int64), shard.ids[first])
        pairs = runs((np.cumsum(size) - size)[stay], size[stay])
        node_item, level, first, bound, size, low, high, w = node_item[stay], level[stay], first[stay], bound[stay], size[stay], low[pairs], high[pairs], w[pairs]


def build(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shard_postings: int = SHARD_POSTINGS, shard_docs: int = SHARD_DOCS) -> None:
    """Writes the index of docs: every term of every document. Texts that are null or without terms are not in it."""
    rows = spread(docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("binary").alias("t")))
    all_docs, all_terms = statistics(rows.select("t"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = Gathered(all_docs, all_terms)
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                now.add(i, t.as_py())
                if now.size >= shard_postings or len(now.ids) >= shard_docs:
                    yield _row(now)
                    now = Gathered(all_docs, all_terms)
        if now.ids:
            yield _row(now)

    rows.mapInArrow(shards, SHARD_SCHEMA).write.mode("overwrite").option("compression", "zstd").parquet(path)


def _row(shard: Gathered) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for k, v in shard.shard().items()})


def passes(items: DataFrame, id_col: str, text_col: str, pass_terms: int) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and distinct terms of the items, in parts of about pass_terms terms: what a pass takes to the driver and the tasks."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [sorted(set(terms_of(t))) for t in b["t"]]
            yield pd.DataFrame({"item": b["i"].astype("Int64"), "n": [len(x) for x in found], "terms": [b" ".join(x) for x in found]})

    read = cut(items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("binary").alias("t")).mapInPandas(of, "item long, n long, terms binary").filter("n > 0").withColumn("row", F.monotonically_increasing_id()))
    n = -(-(read.agg(F.sum("n")).first()[0] or 0) // pass_terms)
    for k in range(n):
        part = (read if n == 1 else read.filter(F.pmod(F.xxhash64("row"), F.lit(n)) == k)).select("item", "terms").collect()
        yield [r["item"] for r in part], [bytes(r["terms"]).split(b" ") for r in part]


def _frequencies(index: DataFrame, terms: list[bytes]) -> np.ndarray:
    """In how many documents each of the terms is, from the shards' dictionaries alone."""
    number = {t: k for k, t in enumerate(terms)}

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(len(number), np.int64)
        for b in batches:
            for r in b.itertuples():
                sizes = np.diff(np.frombuffer(r.starts, np.int64))
                got = [(number[t], k) for k, t in enumerate(r.terms.split(b" ")) if t in number]
                if got:
                    mine, theirs = np.array(got).T
                    df[mine] += sizes[theirs]
        met = np.flatnonzero(df)
        yield pd.DataFrame({"term": met, "df": df[met]})

    out = np.zeros(len(terms), np.int64)
    for r in index.select("terms", "starts").mapInPandas(of, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


def search(index: DataFrame, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text", pass_terms: int = PASS_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents of an index that build() wrote, exactly.

    A pass over the index takes items of about pass_terms terms; each task carries its best documents from shard to shard.
    """
    spark = index.sparkSession
    schema = "row long, item_id long, doc_id long, score long"
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    all_docs = index.select("all_docs").first()
    for ids, of in passes(items, id_col, text_col, pass_terms) if all_docs else ():
        terms = sorted(set().union(*of))
        number = {t: j for j, t in enumerate(terms)}
        weights = np.array([weight(all_docs[0], df) for df in _frequencies(index, terms).tolist()], np.int64)
        shared = spark.sparkContext.broadcast(Items(ids, terms, np.r_[0, np.cumsum([len(x) for x in of])], np.array([number[t] for x in of for t in x], np.int64), weights))

        def found(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            items = shared.value
            best = Best(len(items.item_ids), k)
            for b in batches:
                for r in b.itertuples():
                    search_shard(Shard(r), items, best)
            row, score, nameless, docs = best.rows
            named = pd.array([items.item_ids[j] for j in row], "Int64")
            yield pd.DataFrame({"row": row, "item_id": named, "doc_id": pd.arrays.IntegerArray(docs, nameless.astype(bool)), "score": score})

        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        met = index.drop("all_docs").mapInPandas(found, schema).withColumn("group", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
        for key in (["row", "group"], ["row"]):
            met = met.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("rank") <= k)
        out = out.unionByName(met.select("item_id", "rank", "doc_id", "score"))
    return out


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of the highest scores for each row of items, equal scores by ascending doc_id.

    An index of all documents is written into the shared folder, searched, and deleted. Documents that are null, empty or
    without terms are not ranked, and such items give no rows; rows of items that repeat are ranked each for itself. A
    repeated document counts, and is ranked, as often as it stands there; one without an id comes after all others of its
    score. Documents of any length are one document of a shard. Empty tables give an empty one, and other columns are not looked at.
    """
    spark = docs.sparkSession
    path = new_path(spark, "search-index")
    build(docs, path)
    out = cut(search(spark.read.schema(SHARD_SCHEMA).parquet(path), items, k))
    drop_path(spark, path)
    return out
