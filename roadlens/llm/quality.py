"""Quality scores: ridge regression on random Fourier features of document statistics, calibrated by isotonic regression.

Every whole text becomes a short vector of statistics, computed once and kept. Random Fourier features approximate a
Gaussian kernel on them (Rahimi & Recht, 2007). Each partition of the labelled rows sums its own normal equations;
the sums are added up by row of the matrix, so what reaches the driver is one matrix of fixed size. A part of the
labelled rows is left out of the fit and calibrates its scores: they are counted in a histogram of fixed size, on
which pool-adjacent-violators runs. Between block centres the map is linear, so ranks are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, held_out, small, spread

FEATURES = 256
RIDGE = 1.0
SEED = 7
BINS = 4096
#: The fit takes at most about this many labelled rows, chosen by a hash of their ids; more would not change 257 weights.
FIT_ROWS = 400_000
#: Partitions that sum normal equations, at most.
SUMS = 64
STATISTICS = (
    "log_chars log_words word_len word_len_sd long_words upper digit space mark pipe symbol marks_per_word "
    "distinct_words log_distinct repeated_pairs top_word log_lines line_len repeated_lines sentence_ends capital_words non_ascii vowels entropy"
).split()


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode())] = True
    return t


_UPPER, _DIGIT, _SPACE = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("0123456789"), _table(" \t\r\n")
_LETTER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_VOWEL, _SYMBOL, _END = _table("aeiouyAEIOUY"), _table("#$%&*+<=>@\\^_`{}~[]/"), _table(".!?")


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text; null and empty texts give those of an empty one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    n = max(1.0, counts.sum())
    words = raw.split()
    w = max(1, len(words))
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    distinct: dict[bytes, int] = {}
    for x in words:
        distinct[x] = distinct.get(x, 0) + 1
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = max(1.0, counts[_LETTER].sum())
    punctuation = counts[33:127].sum() - counts[_LETTER].sum() - counts[_DIGIT].sum()
    share = counts[counts > 0] / n
    return [
        np.log1p(n), np.log1p(w), lengths.mean(), lengths.std(), (lengths > 20).mean(), counts[_UPPER].sum() / letters, counts[_DIGIT].sum() / n, counts[_SPACE].sum() / n,
        punctuation / n, counts[124] / w, counts[_SYMBOL].sum() / n, punctuation / w, len(distinct) / w, np.log1p(len(distinct)), 1 - pairs / max(1, len(words) - 1), max(distinct.values(), default=0) / w,
        np.log1p(len(lines)), np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)), counts[_END].sum() / w, sum(x[:1].isupper() for x in words) / w, counts[128:].sum() / n,
        counts[_VOWEL].sum() / letters, float(-(share * np.log2(share)).sum()),
    ]


def statistics_of(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([statistics(x) for x in batch])

    return of(text)


@dataclass(frozen=True)
class Scorer:
    """A fitted model of fixed size; calls map rows of statistics to calibrated scores."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: tuple[np.ndarray, np.ndarray] | None = None
    width: float = 4.0

    def features(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        w, b = rng.normal(size=(x.shape[1], FEATURES)) / self.width, rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.ones((len(x), 1)), np.sqrt(2 / FEATURES) * np.cos(z @ w + b)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights, -0.5, 1.5)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        # products of rows differ in their last digits with the rows beside them; equal texts are to score alike
        return np.round(np.clip(raw if self.knots is None else np.interp(raw, *self.knots), 0.0, 1.0), 9)


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over rows sorted by x with means y and counts n: centres and values of the blocks."""
    blocks: list[list[float]] = []
    for xi, yi, ni in zip(x, y, n):
        blocks.append([xi * ni, yi * ni, ni])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            a = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], a)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.array(rows.tolist(), float).reshape(len(rows), len(STATISTICS))


def fit(rows: DataFrame, calibration: str = "calibrate") -> Scorer:
    """Fits a scorer on rows (x: statistics, y: 0 or 1, calibrate: boolean). Without rows of both labels the scores are a constant."""
    rows = cut(rows)
    spread = rows.select("y", F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).orderBy("k").collect()
    mean, scale = np.array([r["m"] for r in spread] or [0.0] * len(STATISTICS)), np.array([r["s"] for r in spread] or [1.0] * len(STATISTICS))
    scale = np.where(scale > 1e-9, scale, 1.0)
    base = Scorer(mean, scale, np.zeros(FEATURES + 1))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = np.zeros((FEATURES + 1, FEATURES + 2)), 0
        for b in batches:
            f = base.features(_matrix(b["x"]))
            total += f.T @ np.hstack([f, b["y"].to_numpy(float)[:, None]])
            seen += len(b)
        if seen:
            yield pd.DataFrame({"k": np.arange(len(total)), "row": list(total)})

    def added(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": [key[0]], "row": [np.sum(part["row"].tolist(), axis=0)]})

    # the labelled rows are bounded in number, so a fixed number of tasks sums them, and as many matrices are shuffled at most
    system = rows.filter(~F.col(calibration)).select("x", "y").coalesce(SUMS).mapInPandas(sums, "k int, row array<double>").groupBy("k").applyInPandas(added, "k int, row array<double>")
    a = np.array([r["row"] for r in system.orderBy("k").collect()])
    penalty = RIDGE * np.eye(FEATURES + 1)
    penalty[0, 0] = 1e-6
    fitted = Scorer(mean, scale, np.linalg.solve(a[:, :-1] + penalty, a[:, -1])) if len(a) and a[0, 0] else base

    @F.pandas_udf("int")
    def bin_of(x: pd.Series) -> pd.Series:
        return pd.Series(((fitted.raw(_matrix(x)) + 0.5) / 2 * (BINS - 1)).round().astype(int))

    seen = rows.filter(F.col(calibration)).groupBy(bin_of("x").alias("bin")).agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("bin").toPandas()
    if not len(seen):
        return fitted
    x, n = seen["bin"].to_numpy() / (BINS - 1) * 2 - 0.5, seen["n"].to_numpy(float)
    return Scorer(mean, scale, fitted.weights, isotonic(x, seen["y"].to_numpy(), n))


def scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of docs, learnt from labels.quality of the rows not held out.

    Texts alone make a score. Labels that are null or belong to no document are not used; if an id is labelled twice
    or repeated in docs, each pair counts. Null and empty texts are scored as empty ones. With no labels at all every
    score is 0. An empty table gives an empty one. Other columns are not looked at.
    """
    rows = cut(spread(docs.select("doc_id", "text")).select(F.col("doc_id"), statistics_of(F.col("text")).alias("x")))
    model = fit(labelled(rows, labels, fit_rows).select("x", "y", "calibrate"))
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_of(model, F.col("x")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def labelled(rows: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """rows that may be learnt from, with y and calibrate; at most about fit_rows of them, by a hash of their ids."""
    known = labels.filter(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").cast("double").alias("y"))
    share = fit_rows / max(fit_rows, known.count())
    taken = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000)) < int(share * 1_000_000))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 4
    # so many narrow rows are broadcast, which leaves the texts where they are; more (ids labelled again and again) are not
    return rows.join(small(taken.withColumn("calibrate", fold), fit_rows + fit_rows // 10), "doc_id")


def score_of(model: Scorer, statistics_: Column) -> Column:
    @F.pandas_udf("double")
    def of(x: pd.Series) -> pd.Series:
        return pd.Series(model(_matrix(x)))

    return of(statistics_)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of docs (all columns) whose own text's score reaches the threshold; learnt from those that are labelled.

    Null and empty texts are scored like any other, as empty. Rows with equal texts stay or go together; with no labels at
    all every score is 0 and all rows go. An empty table stays empty. Other columns may have any names and hold anything.
    """
    docs = spread(docs)
    seen = labelled(docs.select("doc_id", "text"), labels).select(statistics_of(F.col("text")).alias("x"), "y", "calibrate")
    model = fit(seen)
    return docs.filter(score_of(model, statistics_of(F.col("text"))) >= threshold)
