import random
import time

import numpy as np
import pytest

from roadlens.llm import decontaminate, queries

SF = "/root/testdata/sf0.01"


def index_of(items):
    return decontaminate.build([k for k, _ in items], [decontaminate.numbers(decontaminate.words(t)) for _, t in items])


def naive_best(item, text):
    """Least edit distance of item to any stretch of text, by dynamic programming."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_best_match_is_exact():
    rng = random.Random(4)
    for _ in range(400):
        item, text = [rng.randrange(4) for _ in range(rng.randrange(1, 9))], [rng.randrange(4) for _ in range(rng.randrange(0, 20))]
        got, want = decontaminate.best_match(item, text, len(item)), naive_best(item, text)
        assert got[0] == want and edit_distance(item, text[got[1] : got[2]]) == want
        assert (decontaminate.best_match(item, text, want - 1) is None) or want == 0


def test_leaks_of_the_whole_table(spark):
    items = {r["item_id"]: decontaminate.words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: decontaminate.words(r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in queries.QUERIES["op10_benchmark_decontamination"](spark, SF).collect()}
    want = {}
    for d, text in docs.items():
        own = set(text)
        for i, item in items.items():
            most = int(len(item) * 0.2 + 1e-9)
            if sum(w not in own for w in item) <= most and (b := decontaminate.best_match(item, text, most)):
                want[d, i] = b[0]
    assert got == want and len(want) > 20


def test_recall_of_damaged_passages():
    items = [(k, " ".join(f"w{random.Random(k * 100 + j).randrange(400)}" for j in range(20 + k % 40))) for k in range(60)]
    index, rng, found, tried = index_of(items), random.Random(9), 0, 0
    for k, text in items:
        for _ in range(5):
            w = text.split()
            for _ in range(int(len(w) * 0.2 + 1e-9)):
                j, how = rng.randrange(len(w)), rng.randrange(3)
                w[j : j + (how != 1)] = [] if how == 2 else [f"n{rng.randrange(99)}"]
            tried += 1
            found += any(m[0] == k for m in next(decontaminate.matches(index, ["a b c " + " ".join(w) + " d e f"])))
    assert found >= 0.97 * tried


def test_short_items_are_always_found():
    rng = random.Random(6)
    items = [(k, " ".join(f"w{rng.randrange(50)}" for _ in range(1 + k % 12))) for k in range(240)]
    index = index_of(items)
    for (k, text), got in zip(items, decontaminate.matches(index, [f"a {t} b" for _, t in items])):
        assert k in {m[0] for m in got}, text
    # with as many edits as they may have, too: here the words are rare enough to tell the items by
    items = [(k, " ".join(f"v{k}x{j}" for j in range(5 + k % 6))) for k in range(60)]
    index = index_of(items)
    for k, text in items:
        w = text.split()
        for j in rng.sample(range(len(w)), len(w) // 5):
            w[j] = "other"
        assert k in {m[0] for m in next(decontaminate.matches(index, ["a b " + " ".join(w) + " c"]))}


@pytest.mark.parametrize("even", [True, False])
@pytest.mark.parametrize("n", [11, 12, 13, 15, 16, 20, 25, 30, 60])
def test_no_damaged_item_is_missed_at_any_length(n, even):
    rng = random.Random(n)
    items = [(k, " ".join(f"v{k}x{j}" for j in range(n))) for k in range(150)]
    texts = []
    for _, text in items:
        w, most = text.split(), int(n * 0.2 + 1e-9)
        for j in [(i + 1) * (n + 1) // (most + 1) - 1 for i in range(most)] if even else rng.sample(range(n), most):
            w[j] = "other"
        texts.append("a b c " + " ".join(w) + " d e f")
    found = decontaminate.matches(index_of(items), texts)
    assert [k for (k, _), got in zip(items, found) if k not in {m[0] for m in got}] == []


def test_order_of_items_does_not_matter():
    items = [(k, f"alpha{k % 7} beta{k} gamma delta{k % 3} eps zeta{k} eta theta iota kappa{k}") for k in range(40)]
    texts = [f"x {t} y" for _, t in items[:10]]
    a, b = (list(decontaminate.matches(index_of(x), texts)) for x in (items, items[::-1]))
    assert [sorted(x) for x in a] == [sorted(x) for x in b]


def test_leaks_of_odd_rows(spark):
    docs = "doc_id long, text string, item_id int, begin string"
    item = "One two, three four five six seven eight nine ten."
    long = "pad " * 60_000 + item.upper() + " pad" * 5
    rows = [(1, None, 0, ""), (2, "", 0, ""), (3, f"x {item} y", 0, ""), (3, f"x {item} y", 0, ""), (4, long, 0, ""), (None, item, 0, ""), (5, "clean text here", 0, ""), (6, "what is it?", 0, "")]
    bench = [(1, item), (1, item), (2, None), (3, ""), (4, "What is it"), (5, item)]
    df, b = spark.createDataFrame(rows, docs), spark.createDataFrame(bench, "item_id long, text string")
    out = [(r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.contaminated(df, b).collect()]
    assert sorted(out, key=str) == sorted([(d, i, 0) for d in (3, 3, 4, None) for i in (1, 5)] + [(6, 4, 0)], key=str)
    assert sorted(str(r["doc_id"]) for r in decontaminate.clean(df, b).collect()) == ["1", "2", "5"]
    assert decontaminate.clean(df, b).columns == df.columns
    assert decontaminate.contaminated(df.limit(0), b).collect() == [] and decontaminate.contaminated(df, b.limit(0)).collect() == []


def test_a_benchmark_in_several_passes(spark):
    b = spark.createDataFrame([(i, f"alpha{i} beta{i} gamma{i} delta{i} eps{i} zeta{i}") for i in range(20)], "item_id long, text string")
    parts = list(decontaminate.indices(b, pass_words=40))
    assert len(parts) > 2 and sorted(i for part in parts for i in part.ids.tolist()) == list(range(20))
    docs = spark.createDataFrame([(i, f"x alpha{i} beta{i} gamma{i} delta{i} eps{i} zeta{i} y" if i % 2 else "y") for i in range(20)], "doc_id long, text string")
    before = decontaminate.PASS_WORDS
    try:
        decontaminate.indices.__defaults__ = (decontaminate.SIMILARITY, 40)
        assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, b).collect()) == [(i, i) for i in range(1, 20, 2)]
        assert sorted(r["doc_id"] for r in decontaminate.clean(docs, b).collect()) == list(range(0, 20, 2))
    finally:
        decontaminate.indices.__defaults__ = (decontaminate.SIMILARITY, before)


def damaged(rng, item, rate):
    """An item with floor(rate of its words) edits at random: substitutions, insertions and deletions."""
    w = list(item)
    for _ in range(int(rate * len(item) + 1e-9)):
        j, how = rng.randrange(len(w)), rng.randrange(3)
        w[j : j + (how != 1)] = [] if how == 2 else [f"n{rng.randrange(10**6)}"]
    return w


LENGTHS = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 15, 17, 20, 25, 30, 40, 60, 100, 200]


@pytest.mark.parametrize("rate", [0.0, 0.05, 0.1, 0.15, 0.2])
def test_recall_by_length_and_rate(rate):
    rng, each = random.Random(3), 120
    for n in LENGTHS:
        items = [(k, [f"v{k}x{j}" for j in range(n)]) for k in range(each)]
        index = index_of([(k, " ".join(w)) for k, w in items])
        found = decontaminate.matches(index, ["a b c " + " ".join(damaged(rng, w, rate)) + " d e f" for _, w in items])
        got = sum(k in {m[0] for m in m_} for (k, _), m_ in zip(items, found))
        assert got >= (0.99 if rate else 1.0) * each, (n, got)


def test_parts_of_windows_leave_none_out(monkeypatch):
    items = [(k, f"a{k} b{k} c{k} d{k} e{k} f{k} g{k} h{k}") for k in range(9)]
    texts = [f"x {t} y" for _, t in items]
    for part in (1, 2, 10, 20, 30, 90):
        monkeypatch.setattr(decontaminate, "PART", part)
        assert [[m[0] for m in got] for got in decontaminate.matches(index_of(items), texts)] == [[k] for k, _ in items]


def test_an_index_is_small_and_quick_to_build():
    rng = np.random.default_rng(1)
    items = [rng.integers(1, 1 << 62, 40).astype(np.uint64) for _ in range(1 << 13)]
    index = decontaminate.build(np.arange(len(items)), items)
    # a pass holds PASS_WORDS words, more than here
    assert index.nbytes() * decontaminate.PASS_WORDS / (40 << 13) < 200e6


def test_work_hardly_grows_with_the_benchmark():
    """Words as they are in prose, a few of them everywhere: 85 times the items, none of which is there, may not take much longer."""
    rng, vocabulary = np.random.default_rng(1), np.array([f"w{k}" for k in range(30_000)])
    p = 1 / np.arange(1, len(vocabulary) + 1)
    text = lambda n: " ".join(vocabulary[rng.choice(len(vocabulary), n, p=p / p.sum())])
    docs, took = [text(1000) for _ in range(300)], []
    for n in (200, 17_000):
        items = [text(30) for _ in range(n)]
        index = decontaminate.build(np.arange(n), [decontaminate.numbers(decontaminate.words(t)) for t in items])
        start = time.process_time()
        found = list(decontaminate.matches(index, docs))
        took.append(time.process_time() - start)
        assert not any(found)
    assert took[1] < 3 * took[0] + 0.5
    # and what is there is found, of such words too
    planted = [f"{docs[k]} {items[k]} {docs[k + 1]}" for k in range(200)]
    assert all(k in [m[0] for m in got] for k, got in enumerate(decontaminate.matches(index, planted)))


def test_edited_items_of_prose_are_found():
    """A fifth of the words edited at random, in items whose words are mostly frequent ones."""
    rng, vocabulary = np.random.default_rng(2), np.array([f"w{k}" for k in range(3_000)])
    p = 1 / np.arange(1, len(vocabulary) + 1)
    draw = lambda n: vocabulary[rng.choice(len(vocabulary), n, p=p / p.sum())].tolist()
    items = [draw(int(n)) for n in rng.integers(8, 61, 3_000)]
    index = decontaminate.build(np.arange(len(items)), [decontaminate.numbers(x) for x in items])
    planted = []
    for item in items[:600]:
        x = list(item)
        for at in rng.choice(len(x), int(0.2 * len(x)), replace=False):
            x[at] = f"new{rng.integers(1 << 30)}"
        planted.append(" ".join([*draw(50), *x, *draw(50)]))
    found = [k in [m[0] for m in got] for k, got in enumerate(decontaminate.matches(index, planted))]
    assert sum(found) >= 0.99 * len(found)


def test_an_item_of_frequent_words_alone():
    """Nothing in it is rare, and it still keeps as many places as its edits leave whole."""
    item = decontaminate.words("to be or not to be that is the question whether it is nobler in the mind to suffer the slings and arrows")
    index = decontaminate.build(np.array([7]), [decontaminate.numbers(item)] * 1)
    for at in range(2, len(item) - 2, 3):
        text = " ".join(["before", *item[:at], "x", *item[at + 1 :], "after"])
        assert [m[0] for m in next(iter(decontaminate.matches(index, [text])))] == [7]
