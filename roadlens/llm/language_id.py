"""Language identification by bit-sliced Bloom filters of letter n-grams.

A filter holds a bit mask of languages in each slot; the AND of an n-gram's slots is the set of languages whose
filter may contain it, all at once. For each language the share of its n-grams that a text hits is counted from the
bits, corrected for the filter's false positives, and the largest decides.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, held_out, spread

SIZES = (3, 4)
SLOTS = 1 << 20
HASHES = 3
#: The filters are filled from at most about this many documents of each language, chosen by a hash of their ids.
FIT_DOCS = 3_000
#: An n-gram is a language's own if its frequency there is at least this part of its highest in any language.
TYPICAL = 0.34
#: ... and if it makes up at least this part of the language's n-grams.
LEAST = 2e-6
WORD = 62  # languages in a mask word
UNKNOWN = "und"
#: There are some 7,000 languages; a column with more values is refused, as every one takes a bit in each slot.
MOST = 8_000


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(text: str | None) -> np.ndarray:
    """Hashes of the letter n-grams of a whole text, repeats included; words are framed by a space."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.uint64)
    keep = letter | np.r_[letter[1:], False] | np.r_[False, letter[:-1]]
    c = np.where(letter, codes, 32)[keep].astype(np.uint64)
    c = np.r_[np.uint64(32), c, np.uint64(32)]
    space = c == 32
    out = []
    for n in SIZES:
        if len(c) < n:
            break
        h, inner, blank = np.full(len(c) - n + 1, n, np.uint64), np.zeros(len(c) - n + 1, bool), np.ones(len(c) - n + 1, bool)
        for k in range(n):
            part = slice(k, len(c) - n + 1 + k)
            h = h * np.uint64(0x100000001B3) + c[part]
            blank &= space[part]
            if 0 < k < n - 1:
                inner |= space[part]
        out.append(_mixed(h[~inner & ~blank]))
    return np.concatenate(out)


def slots(h: np.ndarray, size: int) -> np.ndarray:
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([((h + np.uint64(k) * step) % np.uint64(size)).astype(np.int64) for k in range(HASHES)])


@dataclass(frozen=True)
class Filters:
    """masks: slots x words of languages; its size is fixed by SLOTS and the number of languages."""

    languages: tuple[str, ...]
    masks: np.ndarray

    def false_rates(self) -> np.ndarray:
        fill = [((self.masks[:, k // WORD] >> np.int64(k % WORD)) & 1).mean() for k in range(len(self.languages))]
        return np.array(fill) ** HASHES

    def counts(self, h: np.ndarray) -> np.ndarray:
        hit = np.bitwise_and.reduce(self.masks[slots(h, len(self.masks))], axis=0)
        return np.array([((hit[:, k // WORD] >> np.int64(k % WORD)) & 1).sum() for k in range(len(self.languages))], float)

    def predict(self, text: str | None, false_rates: np.ndarray) -> tuple[str, float]:
        h = grams(text)
        if not len(h) or not self.languages:
            return UNKNOWN, 0.0
        n = len(h)
        true = np.clip((self.counts(h) - n * false_rates) / np.maximum(1 - false_rates, 1e-9) / n, 0, 1)
        best = int(true.argmax())
        return self.languages[best], float(true[best] / max(true.sum(), 1e-12))


def _gram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """lang, h, n: counted over each batch before the shuffle."""
    for b in batches:
        for lang, part in b.groupby("lang"):
            all_ = [grams(t) for t in part["text"]]
            h, n = np.unique(np.concatenate(all_), return_counts=True)
            yield pd.DataFrame({"lang": lang, "h": h.view(np.int64), "n": n})


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, size: int = SLOTS) -> Filters:
    """Filters of the non-null languages of docs, filled from a bounded hash sample of each."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    per = {r["lang"]: r["count"] for r in known.groupBy("lang").count().limit(MOST + 1).collect()}
    if len(per) > MOST:
        raise ValueError(f"the column of languages holds more than {MOST} values: these are no languages")
    languages = tuple(sorted(per))
    if not languages:
        return Filters((), np.zeros((size, 1), np.int64))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000))
    limit = F.create_map(*[F.lit(x) for k in languages for x in (k, int(min(1.0, fit_docs / per[k]) * 1_000_000))])[F.col("lang")]
    counted = known.filter(draw < limit).select("lang", "text").mapInPandas(_gram_counts, "lang string, h long, n long").groupBy("lang", "h").agg(F.sum("n").alias("n"))
    counted = cut(counted)
    totals = {r["lang"]: float(r["n"]) for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    total = F.create_map(*[F.lit(x) for k, v in totals.items() for x in (k, v)])[F.col("lang")]
    index = F.create_map(*[F.lit(x) for i, k in enumerate(languages) for x in (k, i)])[F.col("lang")]
    rated = counted.select("h", index.alias("k"), (F.col("n") / total).alias("f"), "n")
    top = rated.groupBy("h").agg(F.max("f").alias("top"), F.collect_list(F.struct("k", "f", "n")).alias("by"))  # one entry per language
    words = (len(languages) - 1) // WORD + 1
    own = F.expr(f"filter(by, x -> x.f >= {TYPICAL} * top and x.f >= {LEAST}D and x.n > 1)")
    bits = [F.aggregate("own", F.lit(0).cast("long"), lambda a, x: F.when(F.floor(x["k"] / WORD) == w, a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), (x["k"] % WORD).cast("int")))).otherwise(a)).alias(f"w{w}") for w in range(words)]
    masked = top.withColumn("own", own).filter("size(own) > 0").select("h", *bits)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = slots(b["h"].to_numpy(np.int64).view(np.uint64), size)
            yield pd.DataFrame({"slot": s.ravel()} | {f"w{w}": np.tile(b[f"w{w}"].to_numpy(np.int64), HASHES) for w in range(words)})

    filled = masked.mapInPandas(placed, "slot long, " + ", ".join(f"w{w} long" for w in range(words))).groupBy("slot").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(words)])
    masks = np.zeros((size, words), np.int64)
    rows = filled.toArrow()  # at most one row per slot
    for w in range(words):
        masks[rows["slot"].to_numpy(), w] = rows[f"w{w}"].to_numpy()
    return Filters(languages, masks)


def predictions(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per row of docs, learnt from text and lang of rows not held out.

    Texts that are null or have no letter are 'und' with score 0; so is every text if no language is known. Ties go to
    the language first in order. Repeated rows are rows like others; an empty table gives an empty one. Other columns
    are not looked at.
    """
    spark, docs = docs.sparkSession, spread(docs.select("doc_id", "lang", "text"))
    model = fit(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "lang", "text"), fit_docs)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rates = shared.value.false_rates()
        for batch in texts:
            yield pd.DataFrame([shared.value.predict(t, rates) for t in batch], columns=["lang", "score"])

    told = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p"))
    return told.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
