import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from roadlens.llm import lexical_search as L
from roadlens.session import new_path, shared_folder

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """Sorted (item_id, rank, doc_id, score) with every document scored for every item."""
    counted = [(i, Counter(w), len(w)) for i, w in ((i, words(t)) for i, t in docs) if w]
    n, total = len(counted), sum(x for _, _, x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, size in counted:
            m = 100 - 90 + (90 * size * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(words(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, docs, items, k=10, **how):
    path = new_path(spark, "test-index")
    L.build(docs, path, **how)
    return sorted((tuple(r) for r in L.search(spark.read.schema(L.SHARD_SCHEMA).parquet(path), items, k).collect()), key=repr)


def random_texts(rng, n, vocabulary, longest):
    p = 1 / np.arange(1, len(vocabulary) + 1)
    return [" ".join(rng.choice(vocabulary, rng.integers(0, longest), p=p / p.sum())) for _ in range(n)]


@pytest.mark.parametrize("shard_docs", [1, 7, 1 << 14])
def test_random_texts(spark, shard_docs):
    rng = np.random.default_rng(shard_docs)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = random_texts(rng, 400, vocabulary, 60)
    docs = [(int(i), t) for i, t in zip(rng.permutation(1000)[:400] - 500, texts)]
    docs += [(3000 + k, texts[5]) for k in range(40)] + [(-3000 - k, texts[5]) for k in range(40)]  # many of one score
    docs += [(None, texts[5]), (None, texts[6]), (docs[0][0], docs[0][1]), (docs[0][0], texts[8])]
    items = [(k, t) for k, t in enumerate(random_texts(rng, 25, vocabulary, 20))] + [(50, texts[5]), (50, texts[5]), (51, texts[5] + " " + texts[9]), (52, "w0"), (53, "absent"), (54, None), (None, "w1 w2")]
    d, q = (spark.createDataFrame(x, f"{n} long, text string") for x, n in ((docs, "doc_id"), (items, "item_id")))
    assert searched(spark, d.repartition(3), q, shard_docs=shard_docs) == brute(docs, items)
    assert searched(spark, d.repartition(3), q, k=3, shard_docs=shard_docs, shard_postings=50) == brute(docs, items, 3)


def test_terms_are_those_of_the_expression(spark):
    texts = ["", " ", "A-b_C1 dÉé İ 中文　x \U0001f600y it's\n3.5%\x00z\x7fq`[]{|}~", "   ​", "ABC", "Àbc", "KK"]
    for t in texts:
        assert [x.decode() for x in L.terms_of(t.encode())] == words(t)
    docs = list(enumerate(texts))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = [(k, t) for k, t in enumerate(texts)]
    assert searched(spark, d, spark.createDataFrame(q, "item_id long, text string")) == brute(docs, q)


def test_odd_tables(spark):
    schema = "doc_id long, text string, score long, rank int, item_id string"
    docs = [(1, "a b", 1, 1, "x"), (2, None, 1, 1, "x"), (3, "", 1, 1, "x"), (4, "a", 1, 1, "x")]
    d, q = spark.createDataFrame(docs, schema), spark.createDataFrame([(1, "a B", 7)], "item_id long, text string, doc_id int")
    out = L.ranked(d, q)
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and [tuple(r) for r in out.collect()] == brute([x[:2] for x in docs], [(1, "a B")])
    for x, y in ((d.limit(0), q), (d, q.limit(0)), (d.filter("doc_id in (2, 3)"), q), (d, q.withColumn("text", q["text"].substr(0, 0)))):
        assert L.ranked(x, y).collect() == []


def test_a_very_long_document(spark):
    long = " ".join(f"t{k % 90_000} common" for k in range(700_000))
    docs = [(1, long), (2, "t5 t6 rare"), (3, "common"), (4, long[: 1 << 20])]
    items = [(1, "t5 common rare"), (2, " ".join(f"t{k}" for k in range(50_000)))]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert searched(spark, d, q) == brute(docs, items)


def test_items_in_several_passes_and_parts(spark, monkeypatch):
    rng = np.random.default_rng(9)
    vocabulary = [f"w{k}" for k in range(50)]
    docs, items = list(enumerate(random_texts(rng, 200, vocabulary, 30))), list(enumerate(random_texts(rng, 30, vocabulary, 12)))
    path = new_path(spark, "test-index")
    L.build(spark.createDataFrame(docs, "doc_id long, text string"), path)
    index = spark.read.schema(L.SHARD_SCHEMA).parquet(path)
    got = L.search(index, spark.createDataFrame(items, "item_id long, text string"), pass_terms=40).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, items)
    shard = L.Shard(next(index.toPandas().itertuples()))
    split = [sorted(set(L.terms_of(t.encode()))) for _, t in items]
    terms = sorted(set().union(*split))
    of = L.Items([i for i, _ in items], terms, np.r_[0, np.cumsum([len(x) for x in split])], np.array([terms.index(t) for x in split for t in x]), np.ones(len(terms), np.int64))
    want = None
    for together, beam in ((1, 1), (1 << 21, 2), (1 << 21, 1000)):
        monkeypatch.setattr(L, "TOGETHER", together)
        best = L.Best(len(items), 10)
        L.search_shard(shard, of, best, beam)
        got = [x.tolist() for x in best.rows]
        assert got == (want or got)
        want = got


def test_bounds_leave_most_documents_alone():
    """A few documents hold the rare terms: nodes without them are never opened."""
    rng = np.random.default_rng(4)
    gathered = L.Gathered(4096, 4096 * 20)
    for k in range(4096):
        gathered.add(k, " ".join([*(f"c{x}" for x in rng.integers(0, 30, 20)), *["rare thing"] * (k % 300 == 7)]).encode())
    row = next(pd.DataFrame([gathered.shard()]).itertuples())
    shard = L.Shard(row)
    opened, ones = [], L.Shard.ones
    L.Shard.ones = lambda self, level, at: (opened.append(len(at)), ones(self, level, at))[1]
    try:
        best = L.Best(1, 10)
        L.search_shard(shard, L.Items([1], [b"c1", b"c2", b"rare", b"thing"], np.array([0, 4]), np.arange(4), np.array([500, 500, 8000, 8000])), best)
    finally:
        L.Shard.ones = ones
    assert set(best.rows[3] % 300) == {7} and sum(opened) / 2 < 4096


def test_the_index_is_deleted(spark):
    import os

    folder = shared_folder(spark).removeprefix("file://")
    before = {x for x in os.listdir(folder) if x.startswith("search-index")}
    L.ranked(spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string"))
    assert {x for x in os.listdir(folder) if x.startswith("search-index")} == before
