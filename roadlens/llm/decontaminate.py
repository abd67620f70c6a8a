"""Documents that hold benchmark items, by CGK embedding and bit-sampling LSH, verified by exact edit distance.

Texts are sequences of lower-case words. The CGK embedding (Chakraborty, Goldenberg, Koucky, 2016) walks through a
sequence: in each step it writes down the word it stands on and moves on if a random bit of (step, word) says so. Two
walks with the same bits fall into step again after an edit, so a small edit distance becomes a small Hamming distance.
Bit sampling keeps a few steps as the key of a bucket.

Each of REPEATS repeats has bits and sampled places of its own, drawn anew. A window is what is left of an item from one
of its words on; every such window of every item is embedded, and so is every place of the text. A walk that leaves the
item ends there, so windows of all lengths share one walk through the text. A key is kept if it sampled enough different
words to tell the item by; an item of which no repeat keeps one gets its best, so that exact copies are never missed.
With at most a fifth of its words edited, an item of six words or more has three whole ones in a row, from which each
repeat takes a key with a chance of about a quarter: repeats, not a plainer path, make up the recall, which
tests/llm/test_decontamination.py measures by length and rate of edits.

Three ordinary words in a row are no evidence, and a large benchmark holds most of them. So an item keeps windows from its
rarest places only, counted by how often their three words stand in all items: as many places as e edits can spoil (three
each) and SPARE more, which any e edits leave whole. An item that has these is looked at where two of its places hit in
the same line, give or take e words; one that is too short for them keeps all, and is looked at wherever one hits.

Keys are looked up as they grow: where no item's key begins like it, a walk ends. That gives the same buckets as whole
keys at a fraction of the cost. Every hit names an item and a place; the window around it is verified by exact edit
distance in words.

The index is flat arrays of numbers. A pass takes items of at most about PASS_WORDS words, whose index is below 200 MB;
a larger benchmark takes several passes, one index at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, spread

REPEATS = 24
#: Places of a walk that make up a key. The first is the first step, as a window begins at every word; so far the next are apart, at most.
SAMPLED, APART = 3, 2
#: Places of an item that any edits it may have leave whole, if it has so many.
SPARE = 3
SIMILARITY = 0.8
SEED = 11
#: Words of the items handled in one pass.
PASS_WORDS = 1 << 19
#: Characters of texts that are searched together.
STRETCH = 1 << 18
#: Words of windows that are looked at together.
PART = 1 << 19
WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def numbers(words_: list[str]) -> np.ndarray:
    """A number other than zero for each word, the same everywhere."""
    if not words_:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.array(words_, object), categorize=len(words_) > 64) | np.uint64(1)


def edits_of(n, similarity: float = SIMILARITY):
    """How many edits an item of n words may have."""
    return np.floor((1 - similarity) * np.asarray(n) + 1e-9).astype(np.int64)


@lru_cache(maxsize=None)
def places(repeat: int) -> tuple[int, ...]:
    """The sampled steps of a repeat."""
    return (0, *np.cumsum(np.random.default_rng([SEED, repeat]).integers(1, APART + 1, SAMPLED - 1)).tolist())


#: Steps of a walk at most, and repeats that take their random bits from one number.
STEPS = APART * (SAMPLED - 1)
SHARE = 64 // STEPS


def random_bits(seq: np.ndarray) -> list[np.ndarray]:
    """For each SHARE repeats a number for each word, of which each of them reads STEPS bits."""
    out = []
    for k in range(-(-REPEATS // SHARE)):
        h = (seq ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1 + SEED) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        out.append(h ^ (h >> np.uint64(32)))
    return out


def _grown(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    key = (key ^ word) * np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(31)
    key *= np.uint64(0xD6E8FEB86659FD93)
    return key


def _padded(seq: np.ndarray) -> np.ndarray:
    """With zeros behind it, so that walks need not look out for the end."""
    return np.r_[seq, np.zeros(STEPS + 1, np.uint64)]


@dataclass(frozen=True)
class Walk:
    """Walks from some starts, as far as they go on: one entry a level, which is a number of sampled places."""

    starts: list[np.ndarray]
    keys: list[np.ndarray]
    distinct: list[np.ndarray]


def walk(seq: np.ndarray, bits: list[np.ndarray], repeat: int, starts: np.ndarray, alive=None, ends: np.ndarray | None = None) -> Walk:
    """Walks of a repeat through a padded sequence. alive(level, keys) may end walks early; ends: where each start's window ends.

    Different words are counted where ends are given, as only keys of items have to be told apart.
    """
    out, own, shift, step = Walk([], [], []), bits[repeat // SHARE], STEPS * (repeat % SHARE), 0
    at, key = starts, np.uint64(0)
    before, distinct = np.full(len(starts), -1), np.zeros(len(starts), np.int64)
    for level, place in enumerate(places(repeat)):
        for step in range(step, place):
            at = at + ((own[at] >> np.uint64(shift + step)) & np.uint64(1)).astype(np.int64)
        step = place
        if ends is not None and not (inside := at < ends).all():
            starts, at, before, distinct, ends = starts[inside], at[inside], before[inside], distinct[inside], ends[inside]
            key = key[inside]
        key = _grown(key, seq[at])
        if ends is not None:
            distinct, before = distinct + (at != before), at
        elif alive is not None and len(go := np.flatnonzero(alive(level, key))) < len(starts):
            starts, at, key = starts[go], at[go], key[go]
        out.starts.append(starts)
        out.keys.append(key)
        out.distinct.append(distinct)
        if not len(starts):
            break
    return out


class Seen:
    """A set of numbers as a bitmap: what is in it is told for sure, what is not is told with a chance of about 1/8 at most."""

    def __init__(self, keys: np.ndarray):
        bits = max(6, int(len(keys) * 8).bit_length())
        self.shift, self.map = np.uint64(64 - bits), np.zeros(1 << bits, bool)
        self.map[keys >> self.shift] = True

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        return self.map[keys >> self.shift]


@dataclass(frozen=True)
class Index:
    """One pass's items and, for each repeat and level, their keys in order with the places they stand for.

    words holds all items' words one after another, begins where each item begins (and the last ends); a place is a place
    in words. asked is how many places of each item have to hit in a line. pairs are the numbers of all pairs of item and word, in order. prefixes tells for each repeat which keys of each
    level after the first some item's key begins with; first tells which words some item's key in any repeat begins with.
    """

    ids: np.ndarray
    words: np.ndarray
    begins: np.ndarray
    asked: np.ndarray
    pairs: np.ndarray
    keys: list[list[np.ndarray]]
    where: list[list[np.ndarray]]
    prefixes: list[list[Seen]]
    first: Seen

    def item_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, place, "right") - 1

    def nbytes(self) -> int:
        flat = [x.nbytes for part in (self.keys, self.where) for r in part for x in r] + [s.map.nbytes for r in self.prefixes for s in r]
        return sum(x.nbytes for x in (self.ids, self.words, self.begins, self.asked, self.pairs)) + sum(flat)


def enough(n: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """How many different words a key of an item of n words has to hold: as many as surely stand whole in a row, three at most."""
    edits = edits_of(n, similarity)
    return np.clip(-(-(n - edits) // (edits + 1)), 1, SAMPLED)


def rarest(seq: np.ndarray, begins: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Which places of the items' words keep their keys: of items with more than they need, those whose three words are rarest."""
    n = np.diff(begins)
    of = np.repeat(np.arange(len(n)), n)
    _, number, often = np.unique(seq, return_inverse=True, return_counts=True)
    common = np.log(often)[number]
    whole = np.arange(len(seq)) + SAMPLED <= begins[1:][of]
    score = np.where(whole, sum(np.r_[common[k:], np.zeros(min(k, len(common)))] for k in range(SAMPLED)), np.inf)
    order = np.lexsort((score, of))
    rank = np.empty(len(seq), np.int64)
    rank[order] = np.arange(len(seq)) - begins[of]
    return rank < (SAMPLED * edits_of(n, similarity) + SPARE)[of]


def build(ids: np.ndarray, items: list[np.ndarray], similarity: float = SIMILARITY) -> Index:
    """The index of items given as the numbers of their words."""
    some = [k for k, w in enumerate(items) if len(w)]
    ids, items = np.asarray(ids, np.int64)[some], [items[k] for k in some]
    n = np.array([len(w) for w in items], np.int64)
    begins, seq = np.r_[0, np.cumsum(n)], np.concatenate([np.zeros(0, np.uint64), *items])
    starts, of, padded = np.arange(len(seq)), np.repeat(np.arange(len(n)), n), _padded(seq)
    bits = random_bits(padded)
    asked, last = enough(n, similarity)[of], begins[1:][of]
    rare = rarest(seq, begins, similarity) if len(seq) else np.zeros(0, bool)
    rare |= asked < SAMPLED
    used = np.zeros(len(seq), bool)
    keys, where, prefixes = [], [], []
    best = np.zeros(len(n), np.int64)  # for each item the most words that a key of it holds
    found = np.zeros(len(n), bool)
    spare: list[tuple[int, int, int, np.uint64]] = [(0, 0, 0, np.uint64(0))] * len(n)  # and that key, from its first word
    for repeat in range(REPEATS) if len(seq) else ():
        w = walk(padded, bits, repeat, starts, ends=last)
        # a walk counts by the last place at which it stands inside the item
        final = [~np.isin(a, b) for a, b in zip(w.starts, [*w.starts[1:], np.zeros(0, np.int64)])]
        good = [f & (d >= asked[s]) & rare[s] for f, d, s in zip(final, w.distinct, w.starts)]
        for level, (g, f, s, k, d) in enumerate(zip(good, final, w.starts, w.keys, w.distinct)):
            found[of[s[g]]] = used[s[g]] = True
            first = np.flatnonzero(f & (s == begins[of[s]]))
            for j in first[d[first] > best[of[s[first]]]].tolist():
                best[of[s[j]]], spare[of[s[j]]] = d[j], (repeat, level, int(s[j]), k[j])
        order = [np.argsort(k[g], kind="stable") for k, g in zip(w.keys, good)]
        keys.append([k[g][o] for k, g, o in zip(w.keys, good, order)])
        where.append([s[g][o] for s, g, o in zip(w.starts, good, order)])
        # beginnings of the keys kept, level by level
        kept = np.concatenate([s[g] for s, g in zip(w.starts, good)])
        prefixes.append([k[np.isin(s, kept)] for s, k in zip(w.starts, w.keys)])
    for i in np.flatnonzero(~found).tolist():
        repeat, level, place, key = spare[i]
        at = int(np.searchsorted(keys[repeat][level], key))
        keys[repeat][level] = np.insert(keys[repeat][level], at, key)
        where[repeat][level] = np.insert(where[repeat][level], at, place)
        w = walk(padded, bits, repeat, np.array([place]), ends=begins[i + 1 : i + 2])
        for k, own in enumerate(w.keys[: level + 1]):
            prefixes[repeat][k] = np.r_[prefixes[repeat][k], own]
    pairs = np.unique(_grown(of.astype(np.uint64), seq))
    first = np.unique(np.concatenate([np.zeros(0, np.uint64), *(p[0] for p in prefixes)]))
    in_line = 1 + (np.bincount(of[used], minlength=len(n)) >= SAMPLED * edits_of(n, similarity) + SPARE - 1) * (enough(n, similarity) == SAMPLED)
    return Index(ids, seq, begins, in_line, pairs, keys, where, [[Seen(np.unique(k)) for k in p[1:]] for p in prefixes], Seen(first))


def candidates(index: Index, seq: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For one repeat after another: places of a sequence and the places in the items' words that they have a key in common with."""
    if not index.prefixes:
        return
    padded = _padded(seq)
    bits, starts = random_bits(padded), np.flatnonzero(seq)
    # every walk begins with the word it starts on, in all repeats
    starts = starts[index.first(_grown(np.uint64(0), seq[starts]))]
    for repeat, (keys, where, prefixes) in enumerate(zip(index.keys, index.where, index.prefixes)):
        w = walk(padded, bits, repeat, starts, lambda level, k, p=prefixes: p[level - 1](k) if 0 < level <= len(p) else np.full(len(k), level == 0))
        for s, k, own, place in zip(w.starts, w.keys, keys, where):
            lo = np.searchsorted(own, k, "left")
            many = np.searchsorted(own, k, "right") - lo
            yield np.repeat(s, many), place[np.repeat(lo - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())]


def _windows(index: Index, seq: np.ndarray, begins: np.ndarray, similarity: float) -> pd.DataFrame:
    """doc, item, lo, hi: the windows around candidates that hold all words of their item but as many as may be edited.

    seq holds texts one after another, with a zero behind each; begins tells where each begins, and the end. Hits are
    kept as one number each: which item, which text, and how the two are lined up; and a bit for each of the item's places
    that hit there, modulo 64. Hits of many keys in one are one.
    """
    sizes, docs = np.diff(index.begins), len(begins) - 1
    longest = int(sizes.max(initial=0))
    shift = int(len(seq) + longest + 1).bit_length()
    hits, bits = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for at, theirs in candidates(index, seq):
        if len(at):
            item, doc = index.item_of(theirs), np.searchsorted(begins, at, "right") - 1
            place = theirs - index.begins[item]
            hits = np.r_[hits, (item * docs + doc) << shift | at - begins[doc] - place + longest]
            bits = np.r_[bits, np.uint64(1) << (place & 63).astype(np.uint64)]
            order = np.argsort(hits, kind="stable")
            hits, bits = hits[order], bits[order]
            first = np.flatnonzero(np.r_[True, hits[1:] != hits[:-1]])
            hits, bits = hits[first], np.bitwise_or.reduceat(bits, first)
    hits = hits[_in_line(index, hits, bits, docs, shift, similarity)]
    item, doc = np.divmod(hits >> shift, max(docs, 1))
    at = (hits & ((1 << shift) - 1)) - longest + begins[doc]
    n = sizes[item]
    most = edits_of(n, similarity)
    lo, hi = np.maximum(begins[doc], at - most), np.minimum(begins[doc + 1] - 1, at + n + most)
    there, size = np.zeros(len(at), np.int64), hi - lo
    parts = np.searchsorted(np.cumsum(size), np.arange(0, int(size.sum()) + PART, PART), "right")
    for part in map(slice, parts, parts[1:]):
        of = np.repeat(np.arange(len(size[part])), size[part])
        place = np.repeat(lo[part] - np.r_[0, np.cumsum(size[part])[:-1]][: len(size[part])], size[part]) + np.arange(len(of))
        met = _among(index.pairs, _grown(item[part][of].astype(np.uint64), seq[place]))
        there[part] = np.bincount(of[met], minlength=len(size[part]))
    return pd.DataFrame({"doc": doc, "item": item, "lo": lo, "hi": hi})[there >= n - most]


def _in_line(index: Index, hits: np.ndarray, bits: np.ndarray, docs: int, shift: int, similarity: float) -> np.ndarray:
    """Which hits have as many places of their item as it asks for on lines as near as its edits may move them."""
    item, low = (hits >> shift) // max(docs, 1), (hits >> shift) << shift
    apart = edits_of(np.diff(index.begins), similarity)[item]
    places_ = np.r_[0, np.cumsum(np.bitwise_count(bits).astype(np.int64))]
    lo = np.searchsorted(hits, np.maximum(hits - apart, low), "left")
    hi = np.searchsorted(hits, np.minimum(hits + apart, low | ((1 << shift) - 1)), "right")
    return places_[hi] - places_[lo] >= index.asked[item]


def _among(sorted_: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(x), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x


def best_match(item: list, text: list, most: int) -> tuple[int, int, int] | None:
    """Least edit distance of item to any stretch of text, with its begin and end; None if above most.

    Myers' bit-parallel algorithm (1999), on words; the begin is found by the same scan backwards.
    """

    def scan(pattern: list, over: list, anchored: bool) -> tuple[int, int]:
        peq: dict = {}
        for i, w in enumerate(pattern):
            peq[w] = peq.get(w, 0) | 1 << i
        m, full = len(pattern), (1 << len(pattern)) - 1
        top, pv, mv, score = 1 << (m - 1), full, 0, m
        best, end = m, 0
        for j, w in enumerate(over):
            eq = peq.get(w, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = mv | ~(xh | pv) & full, pv & xh
            score += bool(ph & top) - bool(mh & top)
            ph = (ph << 1 | anchored) & full
            pv, mv = (mh << 1 & full) | ~(xv | ph) & full, ph & xv
            if score < best:
                best, end = score, j + 1
        return best, end

    distance, end = scan(item, text, False)
    if distance > most:
        return None
    back = list(reversed(text[:end]))
    _, length = scan(list(reversed(item)), back, True)
    return distance, end - length, end


def matches(index: Index, texts: list[str | None], similarity: float = SIMILARITY) -> Iterator[list[tuple[int, int, int, int, int]]]:
    """For each whole text: item_id, n_words, distance, begin, end (in words) of the best match of each item found.

    Texts are searched in stretches of about STRETCH characters.
    """
    own, size = [], 0
    for t in texts:
        own.append(t)
        size += len(t or "")
        if size >= STRETCH:
            yield from _stretch(index, own, similarity)
            own, size = [], 0
    yield from _stretch(index, own, similarity)


def _stretch(index: Index, texts: list[str | None], similarity: float) -> list[list[tuple[int, int, int, int, int]]]:
    split = [words(t) for t in texts]
    begins = np.r_[0, np.cumsum([len(x) + 1 for x in split])].astype(np.int64)
    seq = np.zeros(begins[-1], np.uint64)
    is_word = np.ones(len(seq), bool)
    is_word[begins[1:] - 1] = False
    seq[is_word] = numbers([w for x in split for w in x])
    found: list[list] = [[] for _ in texts]
    for (doc, item), own in _windows(index, seq, begins, similarity).groupby(["doc", "item"]):
        if (best := _best_of(index, int(item), seq, own.sort_values("lo")[["lo", "hi"]].to_numpy(), similarity)) is not None:
            distance, lo, hi = best
            found[doc].append((int(index.ids[item]), int(index.begins[item + 1] - index.begins[item]), distance, lo - int(begins[doc]), hi - int(begins[doc])))
    return found


def _best_of(index: Index, item: int, seq: np.ndarray, windows: np.ndarray, similarity: float) -> tuple[int, int, int] | None:
    """The best match of an item by exact edit distance in windows given in order; of equal ones the first."""
    ids = index.words[index.begins[item] : index.begins[item + 1]].tolist()
    most, joined, best = int(edits_of(len(ids), similarity)), [], None
    for lo, hi in windows.tolist():
        if joined and lo <= joined[-1][1]:
            joined[-1][1] = max(hi, joined[-1][1])
        else:
            joined.append([lo, hi])
    for lo, hi in joined:
        got = best_match(ids, seq[lo:hi].tolist(), most)
        if got and (best is None or got[0] < best[0]):
            best = (got[0], lo + got[1], lo + got[2])
            if not got[0]:
                break
    return best


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        w = [numbers(words(t)) for t in b["text"]]
        yield pd.DataFrame({"item_id": b["item_id"], "n": [len(x) for x in w], "words": [x.tobytes() for x in w]})


def indices(benchmark: DataFrame, similarity: float = SIMILARITY, pass_words: int = PASS_WORDS) -> Iterator[Index]:
    """The indices of the items, one after another, each of about pass_words words at most."""
    rows = benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text").distinct()
    items = cut(rows.mapInPandas(_numbered, "item_id long, n long, words binary").filter("n > 0"))
    n = -(-(items.agg(F.sum("n")).first()[0] or 0) // pass_words)
    for k in range(n):
        part = (items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(n)) == k)).select("item_id", "words").toPandas()
        yield build(part["item_id"].to_numpy(np.int64), [np.frombuffer(x, np.uint64) for x in part["words"]], similarity)


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, n_words, distance, begin, end: the best match of each benchmark item in each document.

    A match is a stretch of the document's words whose edit distance to the item, in words, is at most 1 - similarity of
    the item's length. begin and end count words. Null texts and texts or items
    without words match nothing; rows of docs that repeat give rows that repeat, and items that repeat give rows each.
    Other columns are not looked at. Empty tables give an empty one.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, n_words int, distance int, begin int, end int"
    out, rows = spark.createDataFrame([], schema), spread(docs.select(F.col("doc_id").cast("long"), "text"))
    for index in indices(benchmark, similarity):
        shared = spark.sparkContext.broadcast(index)

        def found(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame([(i, *m) for i, got in zip(b["doc_id"], matches(shared.value, list(b["text"]), similarity)) for m in got], columns=["doc_id", "item_id", "n_words", "distance", "begin", "end"]).astype({"doc_id": "Int64"})

        out = out.union(rows.mapInPandas(found, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs (all columns) whose own text has no match; their order and number of repeats stay.

    Null and empty texts match nothing and stay, as do all rows if the benchmark is empty. If the benchmark takes several
    passes, what each leaves is written down before the next, so that a worker holds one index at a time.
    """
    kept, first = spread(docs), True
    for index in indices(benchmark, similarity):
        kept = (kept if first else cut(kept)).filter(~_leaks(docs.sparkSession.sparkContext.broadcast(index), similarity)("text"))
        first = False
    return kept


def _leaks(shared: Broadcast, similarity: float):
    @F.pandas_udf("boolean")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([bool(m) for m in matches(shared.value, list(b), similarity)], dtype=bool)

    return of
