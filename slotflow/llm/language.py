"""Languages of a document as a mixture, by expectation-maximisation over n-gram likelihoods."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

NOT_LETTERS = re.compile(r"[\W\d_]+")
UNDETERMINED = "und"
#: Code points are mixed with odd constants; the top bits name the bucket.
MIX = [np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)]


def ngrams(text: str | None, bits: int, at_once: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the 1- to 3-grams of a text's letters, and how often each occurs.

    Text is lower-cased; what is not a letter counts as one blank. Nothing if there is no letter.
    """
    letters = NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not letters:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer(f" {letters} ".encode("utf-32-le"), np.uint32)
    shift, total = np.uint32(32 - bits), 0
    for start in range(0, len(points), at_once):
        part = points[start : start + at_once + 2]
        own = min(at_once, len(points) - start)
        one = (part + np.uint32(1)) * MIX[0]
        two = (one[:-1] ^ (part[1:] * MIX[1])) * MIX[2]
        three = (two[:-1] ^ (part[2:] * MIX[0])) * MIX[1]
        grams = np.concatenate([one[:own], two[:own], three[:own]]) >> shift
        total = total + np.bincount(grams.view(np.int32), minlength=1 << bits)
    used = np.flatnonzero(total != 0)
    return used, total[used]


@dataclass
class Model:
    """For each language the probability of every n-gram bucket; the size depends on languages and ``bits`` only."""

    languages: list[str]
    chances: np.ndarray
    bits: int

    def __post_init__(self):
        self.by_bucket = np.ascontiguousarray(self.chances.T)

    def mixture(self, likely: np.ndarray, times: np.ndarray, rounds: int = 30, close: float = 1e-3) -> tuple[np.ndarray, float]:
        """Proportions of languages that make the n-grams likeliest, and the log likelihood.

        ``likely`` has a row per n-gram of the document and a column per language.
        """
        n = likely.shape[1]
        share = np.full(n, 1 / n)
        if n > 1:
            total = times.sum()
            for _ in range(rounds):
                new = share * ((times / (likely @ share)) @ likely) / total
                done = np.abs(new - share).max() < close
                share = new
                if done:
                    break
        return share, float(times @ np.log(likely @ share))

    def predict(self, text: str | None) -> tuple[str, float, list[tuple[str, float]]]:
        """The main language, its proportion, and the proportions of the languages selected.

        Languages are tried one after the other, by their share in a rough mixture of all, and taken where the log likelihood gains more
        than the penalty: half the log of the number of n-grams for each proportion more. The log likelihood is concave, so its
        slope towards a language bounds what that one can gain; where the bound is below the penalty the trial is settled.
        """
        buckets, times = ngrams(text, self.bits)
        if not len(buckets) or not self.languages:
            return UNDETERMINED, 0.0, []
        times = times.astype(np.float64)
        likely = self.by_bucket[buckets]
        everything, _ = self.mixture(likely, times, rounds=12, close=5e-3)
        order = np.argsort(-everything, kind="stable").tolist()
        penalty = 0.5 * np.log(times.sum())
        chosen = order[:1]
        share, best = self.mixture(likely[:, chosen], times)
        mix = likely[:, chosen] @ share
        for nxt in order[1:]:
            if times @ (likely[:, nxt] / mix) - times.sum() <= penalty:
                continue
            more, fit = self.mixture(likely[:, [*chosen, nxt]], times)
            if fit - penalty > best:
                chosen, share, best = [*chosen, nxt], more, fit - penalty
                mix = likely[:, chosen] @ share
        top = int(np.argmax(share))
        found = [(self.languages[c], float(s)) for c, s in zip(chosen, share)]
        return found[top][0], min(1.0, found[top][1]), found


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", bits: int = 16, smooth: float = 0.5) -> Model:
    """The model from all rows with text and language. Tasks count their rows; a shuffle adds up the counts.

    Every language needs one array of 2**bits counts on the driver; rows without language or letters add nothing.
    """

    def count(batches) -> Iterator:
        import pandas as pd

        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, t in zip(batch["lang"], batch["text"]):
                used, times = ngrams(t, bits)
                if len(used):
                    sums.setdefault(language, np.zeros(1 << bits, np.int64))[used] += times
        for language, total in sums.items():
            used = np.flatnonzero(total)
            yield pd.DataFrame({"lang": language, "bucket": used, "times": total[used]})

    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = rows.mapInPandas(count, "lang string, bucket int, times bigint").groupBy("lang", "bucket").agg(F.sum("times").alias("times")).toPandas()
    languages = sorted(counts["lang"].unique().tolist())
    table = np.full((len(languages), 1 << bits), smooth)
    for i, language in enumerate(languages):
        own = counts[counts["lang"] == language]
        table[i, own["bucket"].to_numpy()] += own["times"].to_numpy()
    return Model(languages, (table / table.sum(axis=1, keepdims=True)) if languages else table, bits)


def detect(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred``, ``score`` (0 to 1: the language's proportion) and ``mixture``, a row per row of ``docs``.

    ``und`` with score 0 if the text is null or has no letter, or if the model knows no language. Equal texts get equal
    results; only key and text are looked at. One scan, no shuffle.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.languages, model.chances.astype(np.float64), model.bits))

    def run(batches) -> Iterator:
        import pandas as pd

        known = Model(*shared.value)
        for batch in batches:
            found = [known.predict(t) for t in batch["text"]]
            mixtures = [[{"lang": a, "share": b} for a, b in m] for _, _, m in found]
            yield pd.DataFrame({"key": batch["key"], "lang_pred": [x[0] for x in found], "score": [x[1] for x in found], "mixture": mixtures})

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    out = rows.mapInPandas(run, "key string, lang_pred string, score double, mixture array<struct<lang: string, share: double>>")
    return out.withColumn("key", F.col("key").cast(docs.schema[key].dataType)).withColumnRenamed("key", key)


def fold(key: str, folds: int) -> Column:
    """The checksum of the key, as text, by ``folds``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds
