import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from roadlens.llm import embedding_dedup, simhash_dedup
from roadlens.operators.components import connected_components

SF = "/root/testdata/sf0.01"


def components(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in linked:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return [find(i) for i in range(n)]


def brute_vectors(rows, threshold=0.93):
    """vec_id -> (n_links, component) for rows with distinct ids, sorted by id."""
    rows = sorted(rows, key=lambda r: r[0])
    ok = [l is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, l in rows]
    scaled = [np.array(v, float) / np.abs(v).max() if g else None for (_, v, _), g in zip(rows, ok)]  # squares of large numbers would overflow
    unit = [x / np.linalg.norm(x) if g else None for x, g in zip(scaled, ok)]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]
    root = components(len(rows), links)
    return {r[0]: (sum(k in x for x in links), rows[root[k]][0]) for k, r in enumerate(rows)}


def got_vectors(df, **how):
    out = embedding_dedup.near_duplicates(df, **how).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out}


def test_vectors_on_the_whole_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    want = brute_vectors(rows)
    assert got_vectors(df) == want


@pytest.mark.parametrize("tile", [3, 2048])
def test_vectors_near_the_threshold_and_odd_rows(spark, tile):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 16))
    rows = [(i, [float(x) for x in base[i % 6] + rng.normal(size=16) * rng.choice([0, 0.2, 0.3, 0.4])], int(i % 6 // 3)) for i in range(90)]
    rows += [(200, None, 1), (201, [0.0] * 16, 1), (202, [float("nan")] + [1.0] * 15, 1), (203, [float("inf")] * 16, 1), (204, [None] + [1.0] * 15, 1), (205, rows[0][1], None), (206, [1e200] * 16, 1), (207, [2e200] * 16, 1), (208, [], 1), (209, [1.0, 2.0], 1), (210, [2.0, 4.0], 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, node string, n int")
    assert got_vectors(df, tile=tile) == brute_vectors(rows)


def test_vectors_repeated_empty_and_nameless(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    out = embedding_dedup.near_duplicates(spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0)], schema)).collect()
    assert sorted(((r["vec_id"] or -1, r["n_links"], r["component_id"]) for r in out), key=str) == [(-1, 0, None), (1, 1, 1), (1, 1, 1)]


def test_quantisation_bound_is_rigorous():
    rng = np.random.default_rng(1)
    x = embedding_dedup.unit_rows(rng.normal(size=(200, 64)))
    q, s, e = embedding_dedup.quantise(x)
    about = embedding_dedup.integer_product(q, q) * (s[:, None] * s[None, :])
    assert (np.abs(about - x @ x.T) <= e[None, :] + e[:, None] * (1 + e[None, :]) + 1e-9).all()
    linked, open_ = embedding_dedup.settled(q, s, e, q, s, e, 0.2)
    assert (x @ x.T >= 0.2)[linked].all() and not (x @ x.T >= 0.2)[~linked & ~open_].any() and 0 < open_.sum() < linked.size / 10


def naive_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    for text in ["", " \t\n", "One", "one TWO", "A b c d e f g", "É b\x0bc\x0cd é", "x " * 100, None, "ab\x85cd ef gh"]:
        assert simhash_dedup.fingerprint(text) == naive_fingerprint(text)


def test_hash_is_the_engines_own(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b é"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("a b é".encode(), 42)


def test_documents_on_the_whole_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    rows = df.collect()
    fp = [naive_fingerprint(r["text"]) for r in rows]
    root = components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 3])
    want = {r["doc_id"]: (f"{fp[i]:016x}", rows[root[i]]["doc_id"]) for i, r in enumerate(rows)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash_dedup.near_duplicates(df).collect()}
    assert got == want
    assert sum(k != c for k, (_, c) in want.items()) > 20


@pytest.mark.parametrize("cell", [2, 7, 2048])
def test_links_keep_every_component(spark, cell):
    rng = np.random.default_rng(3)
    prints = set()
    for base in rng.integers(0, 2**63, 12):
        prints.add(int(base))
        for _ in range(25):
            x = int(base)
            for b in rng.integers(0, 64, rng.integers(0, 6)):
                x ^= 1 << int(b)
            prints.add(x)
    prints = sorted(p - 2**64 if p >= 2**63 else p for p in prints)
    n = len(prints)
    root = components(n, [(i, j) for i in range(n) for j in range(i) if ((prints[i] ^ prints[j]) % 2**64).bit_count() <= 3])
    found = simhash_dedup.links(spark.createDataFrame([(p,) for p in prints], "fp long"), cell=cell).collect()
    assert all(((r["a"] ^ r["b"]) % 2**64).bit_count() <= 9 for r in found)
    at = {p: i for i, p in enumerate(prints)}
    assert components(n, [(at[r["a"]], at[r["b"]]) for r in found]) == root


def test_documents_odd_rows(spark):
    schema = "doc_id long, text string, fp long, key string"
    assert simhash_dedup.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(5, "", 1, "a"), (3, None, 1, "a"), (7, "a b c", 1, "a"), (7, "a b c", 1, "a"), (None, "a b c", 1, "a"), (None, "q r s", 2, "b"), (9, "x y z " * 30_000, 1, "c")]
    out = simhash_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    got = sorted(((r["doc_id"], r["component_id"]) for r in out), key=str)
    assert got == sorted([(5, 3), (3, 3), (7, 7), (7, 7), (None, 7), (None, None), (9, 9)], key=str)
    kept = simhash_dedup.one_of_each(spark.createDataFrame(rows, schema))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)[:1] and kept.columns == ["doc_id", "text", "fp", "key"]
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == ["3", "7", "9", "None"]


def test_one_of_each_tells_texts_of_one_id(spark):
    a, b, c = ("the quick brown fox jumps over the lazy dog", "an entirely different text about roads and tiles", "some third thing that nobody has said before now")
    prints = [simhash_dedup.fingerprint(x) for x in (a, b, c)]
    assert all((x ^ y).bit_count() > 3 for i, x in enumerate(prints) for y in prints[:i])
    keep = lambda rows: sorted((r["doc_id"], r["text"]) for r in simhash_dedup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    # two groups named by one id: both stay, once each
    assert keep([(1, a), (1, b), (1, a), (2, b)]) == sorted([(1, a), (1, b)])
    # the id's other text belongs to the group of a lower one and goes
    assert keep([(1, a), (2, a), (2, b), (3, c)]) == sorted([(1, a), (2, b), (3, c)])


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, 2000 + i) for i in range(50)] + [(5000, None), (7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, 1000: 1000, **{2000 + i: 1000 for i in range(50)}}
