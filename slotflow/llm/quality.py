"""A quality score: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from slotflow.llm.common import key_filter, store, summed

#: Kinds of UTF-8 bytes, one column each: lower, upper, digit, space, line end, byte of a longer character, and marks.
KINDS = np.zeros((256, 9))
for _b in range(256):
    _c = chr(_b)
    _kind = (
        0 if "a" <= _c <= "z" else 1 if "A" <= _c <= "Z" else 2 if "0" <= _c <= "9" else 3 if _c == " " else 4 if _c in "\n\r"
        else 5 if _b >= 128 else 6 if _c in ".,;:'\"" else 7 if _c in "!?" else 8
    )
    KINDS[_b, _kind] = 1
STATISTICS = KINDS.shape[1] + 13
BLANK = np.isin(np.arange(256), [32, *range(9, 14)])


def statistics(text: str | None) -> np.ndarray:
    """Sizes, kinds of bytes, word shapes and repetition of a whole text. Null counts as empty; all numbers are finite."""
    raw = (text or "").encode()
    if not raw:
        return np.zeros(STATISTICS)
    letters = np.frombuffer(raw, np.uint8)
    share = np.bincount(letters, minlength=256) / len(raw)
    used = share[share > 0]
    edges = np.flatnonzero(np.diff(BLANK[letters], prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    n = max(1, len(starts))
    lengths = ends - starts if len(starts) else np.zeros(1)
    first, last = letters[starts], letters[ends - 1]
    counts = Counter(raw.split())
    line_counts = Counter([x for x in raw.split(b"\n") if x.strip()])
    many = max(1, line_counts.total())
    shapes = [
        np.log1p(len(raw)),
        np.log1p(len(starts)),
        -(used * np.log(used)).sum(),
        lengths.mean(),
        lengths.std(),
        np.log1p(lengths.max()),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        np.log1p(line_counts.total()),
        len(line_counts) / many,
        max(line_counts.values(), default=0) / many,
        ((first >= 65) & (first <= 90)).sum() / n,
        ((last == 46) | (last == 33) | (last == 63)).sum() / n,
    ]
    return np.concatenate([np.sqrt(share @ KINDS), shapes])


def with_statistics(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` as text and its statistics, written once to the shared folder: texts are read once."""

    def run(batches) -> Iterator:
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "x": [statistics(t) for t in batch["text"]]})

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return store(rows.mapInPandas(run, "key string, x array<double>"))


@dataclass
class Model:
    """Scaling, waves, weights and the calibration's steps: a few thousand numbers, whatever was learned from."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    chances: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        scaled = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(scaled @ self.waves + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([waves, scaled, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.chances), 0.0, 1.0)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence closest to ``values``: neighbours out of order are pooled."""
    pools: list[list[float]] = []
    for v, w in zip(values, weights):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in pools]) if pools else np.zeros(0)


def fit(examples: DataFrame, waves: int = 256, width: float = 0.25, penalty: float = 1.0, bins: int = 1000, seed: int = 5) -> Model | None:
    """The model from all rows ``x``, ``y`` (0 to 1). None without examples.

    Two passes of sums and one of counts: means and squares, normal equations (a matrix per task, added up in groups), and
    labels by bin of the raw score, over which the calibration runs. ``width`` scales the Gaussian kernel's
    exponent by the number of statistics. What the driver holds does not depend on the number of rows.
    """
    def total(function, size: int) -> np.ndarray:
        def run(batches) -> Iterator:
            from pyspark import TaskContext

            sums = np.zeros(size)
            for batch in batches:
                if len(batch):
                    sums += function(np.stack(batch["x"].to_numpy()), batch["y"].to_numpy())
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "sums": [sums]})

        rows = summed(examples.select("x", "y").mapInPandas(run, "part int, sums array<double>"), "part", "sums").collect()
        return np.sum([np.asarray(r["sums"]) for r in rows], axis=0) if rows else np.zeros(size)

    sums = total(lambda x, y: np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)]), 1 + 2 * STATISTICS)
    n = sums[0]
    if not n:
        return None
    mean = sums[1 : 1 + STATISTICS] / n
    scale = np.sqrt(np.maximum(sums[1 + STATISTICS :] / n - mean * mean, 0))
    scale[scale < 1e-9] = 1.0
    rng = np.random.default_rng(seed)
    size = waves + STATISTICS + 1
    model = Model(
        mean, scale, rng.normal(0, np.sqrt(2 * width / STATISTICS), (STATISTICS, waves)), rng.uniform(0, 2 * np.pi, waves),
        np.zeros(size), np.zeros(1), np.zeros(1),
    )

    def normal(x, y):
        z = model.features(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    both = total(normal, size * size + size)
    gram, right = both[: size * size].reshape(size, size), both[size * size :]
    ridge = np.full(size, penalty)
    ridge[-1] = 1e-9
    model.weights = np.linalg.solve(gram + np.diag(ridge), right)

    def by_bin(x, y):
        # raw scores lie around 0 to 1; the outer bins take what lies beyond
        at = np.clip(((model.raw(x) + 0.5) / 2 * bins).astype(int), 0, bins - 1)
        return np.concatenate([np.bincount(at, minlength=bins), np.bincount(at, weights=y, minlength=bins)])

    counted = total(by_bin, 2 * bins)
    seen, marked = counted[:bins], counted[bins:]
    used = np.flatnonzero(seen)
    model.knots = (used + 0.5) / bins * 2 - 0.5
    model.chances = isotonic(marked[used] / seen[used], seen[used])
    return model


def learn(
    docs: DataFrame, labels: DataFrame, admit, key: str = "doc_id", text: str = "text", label: str = "quality", stats: DataFrame | None = None, **settings
) -> Model | None:
    """The model from the documents that ``admit``, a condition on the key, lets in and that have a label.

    Several labels of a key count as their mean; null labels and keys are left out. ``stats`` are the documents' statistics, if
    they are there already.
    """
    kind = docs.schema[key].dataType
    marks = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).cast("string").alias("key"))
    marks = marks.agg(F.avg(F.col(label).cast("double")).alias("y"))
    if stats is None:
        # statistics of documents that may have a label; the others need none
        marks = store(marks)
        wanted = key_filter(marks.select(F.xxhash64("key").alias("hash")), "hash")
        rows = docs.select(F.col(key), F.col(text), F.xxhash64(F.col(key).cast("string")).alias("_hash")).where(F.lit(False) if wanted is None else wanted)
        stats = with_statistics(rows.drop("_hash"), key, text)
    chosen = stats.withColumn(key, F.col("key").cast(kind)).where(admit).select("key", "x")
    return fit(store(chosen.join(marks, "key").select("x", "y")), **settings)


def scores(model: Model | None, x: list[np.ndarray]) -> np.ndarray:
    """The score of each row of statistics; 0.5 where there was nothing to learn from."""
    return model.score(np.stack(x)) if model and len(x) else np.full(len(x), 0.5)


def score_column(model: Model | None, text: str = "text"):
    """The score of a text as a column, for frames whose other columns should not pass through Python."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(scores(model, [statistics(t) for t in texts]))

    return score(F.col(text))


def quality_scores(
    docs: DataFrame, labels: DataFrame, admit, key: str = "doc_id", text: str = "text", label: str = "quality", **settings
) -> DataFrame:
    """``key``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on), a row per row of ``docs``.

    Null, empty and very long texts are scored like others, from their statistics, and repeated rows each.
    Without any example every score is 0.5. Only key and text of ``docs`` are read, once.
    """
    stats = with_statistics(docs, key, text)
    model = learn(docs, labels, admit, key, text, label, stats, **settings)

    def run(batches) -> Iterator:
        for batch in batches:
            yield batch[["key"]].assign(score=scores(model, list(batch["x"])))

    scored = stats.mapInPandas(run, "key string, score double")
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "score", predicted)
