from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import ODD_ROWS, empty_docs, odd_docs
from slotflow.llm import language, quality

FOLDER = "/root/testdata/sf0.01"
SYLLABLES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ung", "ein", "der"], "cc": ["lló", "ción", "que", "as"]}


def prose(lang, words, rng):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def languages(text_spark):
    rng = random.Random(1)
    rows = [(i, lang, prose(lang, 40, rng)) for i, lang in enumerate(list(SYLLABLES) * 20)]
    docs = text_spark.createDataFrame([*rows, (900, None, "ka to"), (901, "dd", None), (902, "ee", "1 2 3")], "doc_id bigint, lang string, text string")
    return language.learn(docs.repartition(4), bits=12)


def test_learned_languages(languages):
    assert languages.languages == list(SYLLABLES)
    assert np.allclose(languages.chances.sum(axis=1), 1)


def test_counts_are_those_of_the_texts():
    used, times = language.ngrams("Ab é1  ab", 16)
    # " ab é ab " has nine 1-grams, eight 2-grams, seven 3-grams
    assert times.sum() == 9 + 8 + 7
    assert np.array_equal(language.ngrams("x" * 50 + " abc " * 40, 16, at_once=17)[1], language.ngrams("x" * 50 + " abc " * 40, 16)[1])


def test_mixture_proportions(languages):
    rng = random.Random(2)
    only = languages.predict(prose("bb", 60, rng))
    assert only[0] == "bb" and only[1] == 1.0 and len(only[2]) == 1
    mixed = languages.predict(prose("aa", 150, rng) + " " + prose("cc", 60, rng))
    shares = dict(mixed[2])
    assert mixed[0] == "aa" and set(shares) == {"aa", "cc"} and abs(sum(shares.values()) - 1) < 1e-6 and 0.15 < shares["cc"] < 0.6


def test_expectation_maximisation_never_lowers_the_likelihood(languages):
    buckets, times = language.ngrams(prose("aa", 30, random.Random(3)) + " " + prose("bb", 30, random.Random(4)), 12)
    fits = [languages.mixture(languages.by_bucket[buckets], times.astype(float), rounds=n)[1] for n in range(6)]
    assert all(b >= a - 1e-9 for a, b in zip(fits, fits[1:]))


def test_odd_rows(text_spark, languages):
    found = language.detect(odd_docs(text_spark), languages).collect()
    assert len(found) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 for r in found)
    lettered = {(k, t is not None and any(c.isalpha() for c in t)) for k, t in ODD_ROWS}
    assert {(r["doc_id"], r["lang_pred"] != "und") for r in found} == lettered
    nothing = language.learn(empty_docs(text_spark))
    assert {r["lang_pred"] for r in language.detect(odd_docs(text_spark), nothing).collect()} == {"und"}
    assert language.detect(empty_docs(text_spark), languages).collect() == []


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_languages(text_spark):
    from slotflow.llm.queries import op3_language

    docs = text_spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = op3_language(text_spark, FOLDER).join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null").toPandas()
    assert (found["held_out"] == [zlib.crc32(str(k).encode()) % 5 == 0 for k in found["doc_id"]]).all()
    held = found[found["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.98


def test_isotonic():
    rng = np.random.default_rng(0)
    for _ in range(50):
        values, weights = rng.random(30), rng.integers(1, 9, 30).astype(float)
        fitted = quality.isotonic(values, weights)
        assert (np.diff(fitted) >= 0).all() and np.isclose((fitted * weights).sum(), (values * weights).sum())
        # the closest non-decreasing sequence, by the largest mean to the left of the smallest to the right
        best = [max(min(np.average(values[a : b + 1], weights=weights[a : b + 1]) for b in range(i, 30)) for a in range(i + 1)) for i in range(30)]
        assert np.allclose(fitted, best)


def test_waves_approximate_the_kernel():
    rng = np.random.default_rng(3)
    x, width, waves = rng.normal(size=(40, quality.STATISTICS)), 0.25, 20000
    model = quality.Model(
        np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS), rng.normal(0, np.sqrt(2 * width / quality.STATISTICS), (quality.STATISTICS, waves)),
        rng.uniform(0, 2 * np.pi, waves), np.zeros(0), np.zeros(0), np.zeros(0),
    )
    z = model.features(x)[:, :waves]
    square = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-width / quality.STATISTICS * square)).max() < 0.05


def test_sums_of_tasks_are_the_sums_of_all(text_spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(300, quality.STATISTICS)), rng.integers(0, 2, 300).astype(float)
    rows = text_spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, y double")
    one, many = quality.fit(rows.repartition(1), waves=20), quality.fit(rows.repartition(9), waves=20)
    z = one.features(x)
    ridge = np.full(z.shape[1], 1.0)
    ridge[-1] = 1e-9
    assert np.allclose(one.weights, many.weights, atol=1e-6)
    assert np.allclose(one.weights, np.linalg.solve(z.T @ z + np.diag(ridge), z.T @ y), atol=1e-6)


def test_quality_odd_rows(text_spark):
    docs = odd_docs(text_spark)
    labels = text_spark.createDataFrame([(1, 1), (2, 0), (2, 1), (4, 0), (None, 1), (6, None)], "doc_id bigint, quality int")
    found = quality.quality_scores(docs, labels, F.col("doc_id") > 0).collect()
    assert len(found) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    none = quality.quality_scores(docs, labels.where("false"), F.col("doc_id") > 0).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.quality_scores(empty_docs(text_spark), labels, F.col("doc_id") > 0).collect() == []
    same = docs.withColumn("_s", quality.score_column(quality.learn(docs, labels, F.col("doc_id") > 0)))
    assert sorted(r["_s"] for r in same.collect()) == pytest.approx(sorted(r["score"] for r in found))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_quality(text_spark):
    from slotflow.llm.queries import op5_quality

    labels = text_spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = op5_quality(text_spark, FOLDER).join(labels, "doc_id").toPandas()
    assert (found["held_out"] == [zlib.crc32(str(k).encode()) % 3 == 1 for k in found["doc_id"]]).all()
    held = found[found["held_out"]]
    assert (held["quality"] == held["predicted"]).mean() > 0.95


def test_small_passages_are_found_and_no_trial_is_missed(languages):
    """The set is that of trying every language with full rounds, also for a passage of a third of a percent."""
    rng = random.Random(3)
    long = prose("aa", 20_000, rng) + " " + prose("bb", 70, rng)
    assert {name for name, _ in languages.predict(long)[2]} == {"aa", "bb"}
    mixed = [" ".join(prose(lang, rng.randint(0, 60), rng) for lang in SYLLABLES) for _ in range(60)]
    for text in (long, *mixed):
        buckets, times = language.ngrams(text, languages.bits)
        if not len(buckets):
            continue
        times, likely = times.astype(float), languages.by_bucket[buckets]
        everything, _ = languages.mixture(likely, times, rounds=12, close=5e-3)
        order = np.argsort(-everything, kind="stable").tolist()
        chosen, penalty = order[:1], 0.5 * np.log(times.sum())
        best = languages.mixture(likely[:, chosen], times)[1]
        for nxt in order[1:]:
            fit = languages.mixture(likely[:, [*chosen, nxt]], times)[1]
            if fit - penalty > best:
                chosen, best = [*chosen, nxt], fit - penalty
        assert [name for name, _ in languages.predict(text)[2]] == [languages.languages[c] for c in chosen]
