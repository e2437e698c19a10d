"""Vector codes against a plain version of the rounds."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotflow.llm import codes

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """{row: (code, error)}, label errors and the codebooks' digest, with Python's whole numbers."""
    kept = [(k, v, l) for k, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(256 * x) for x in v] for _, v, _ in kept]
    width = len(whole[0]) // parts
    piece = lambda v, p: v[p * width : (p + 1) * width]
    books = [[piece(v, p) for v in whole[:entries]] for p in range(parts)]

    def nearest(v, p):
        own = piece(v, p)
        return min((sum((a - b) ** 2 for a, b in zip(own, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        members = [defaultdict(list) for _ in range(parts)]
        for v in whole:
            for p in range(parts):
                members[p][nearest(v, p)[1]].append(piece(v, p))
        books = [[[sum(c) // len(c) for c in zip(*members[p][i])] if members[p][i] else e for i, e in enumerate(books[p])] for p in range(parts)]
    found, labels = [], defaultdict(int)
    for (key, _, label), v in zip(kept, whole):
        near = [nearest(v, p) for p in range(parts)]
        error = sum(far for far, _ in near)
        labels[label] += error
        found.append((key, label, "".join(f"{i:02x}" for _, i in near), error))
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((k, c, e, labels[l]) for k, l, c, e in found), key=str), digest


def run(df, **options):
    coded, books = codes.compressed(df, **options)
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in codes.with_label_errors(coded).collect()), key=str), codes.book_digest(books)


def odd_vectors(n, width, seed, scale=1.0):
    random = np.random.default_rng(seed)
    rows = [(i, (random.normal(0, 0.3, width) * scale).tolist(), int(random.integers(3)) if i % 5 else None) for i in range(n)]
    rows += [rows[3], rows[3], (7, rows[9][1], 1), (None, rows[10][1], None), (n + 1, None, 1), (n + 2, [float("nan")] * width, 1)]
    rows += [(n + 3, [float("inf")] * width, 2), (n + 4, [None] + [0.0] * (width - 1), 2)]
    # ties: equal pieces, and corners halfway between others
    rows += [(n + 5 + i, [0.25] * width, 1) for i in range(40)] + [(-1, [0.5] * width, 2), (-2, [0.0] * width, 2)]
    return rows


@pytest.mark.parametrize("width, parts", [(64, 16), (16, 16), (12, 2), (128, 1)])
def test_codes_are_those_of_the_plain_rounds(text_spark, monkeypatch, width, parts):
    monkeypatch.setattr(codes, "CHUNK_CELLS", 100 * width)
    rows = odd_vectors(300, width, seed=width)
    df = text_spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert run(df, parts=parts) == plain(rows, parts)


def test_few_rows_large_numbers_and_extra_columns(text_spark):
    rows = odd_vectors(20, 32, seed=1, scale=2.0**20)
    df = text_spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "vector", "key", "code", "error", "_label", "label_error"):
        df = df.withColumn(name, F.lit("clash"))
    assert run(df) == plain(rows)
    small = [(i, [0.1 * i] * 16, 1) for i in range(5)] + [(9, [2.0**30] * 16, 1)]
    assert run(text_spark.createDataFrame(small, SCHEMA)) == plain(small)


def test_empty_tables_and_wrong_lengths(text_spark):
    df = text_spark.createDataFrame([(1, None, 1), (2, [float("nan")], 2)], SCHEMA)
    coded, books = codes.compressed(df)
    assert codes.with_label_errors(coded).collect() == [] and books.shape[1] == 0
    assert codes.book_digest(books) == hashlib.sha256(b"").hexdigest()
    with pytest.raises(ValueError, match="one length"):
        codes.compressed(text_spark.createDataFrame([(1, [1.0] * 15, 1)], SCHEMA))
    # many rows of one length, one of another
    mixed = [(i, [1.0 * i] * 16, 1) for i in range(80)] + [(99, [1.0] * 32, 1)]
    with pytest.raises(Exception, match="differ in length"):
        codes.compressed(text_spark.createDataFrame(mixed, SCHEMA))


def test_short_lists_hold_every_nearest_entry_and_are_short():
    random = np.random.default_rng(5)
    vectors = np.floor(random.normal(0, 40, (32768, 4))).astype(np.int64)
    chunk = codes.Chunk(codes.chunk_row(["x"] * 32768, ["x"] * 32768, vectors, 1), 1)
    entries = vectors[:64]
    lists, sizes = chunk.short_lists(0, entries)
    far = ((vectors[:, None] - entries) ** 2).sum(axis=2).argmin(axis=1)
    for block, (listed, size) in enumerate(zip(lists, sizes)):
        rows = chunk.places[0][block * codes.BLOCK : (block + 1) * codes.BLOCK]
        assert set(far[rows]) <= set(listed[:size])
    assert sizes.mean() < 16


def test_the_curve_keeps_neighbours_together():
    points = np.stack(np.meshgrid(np.arange(16), np.arange(16)), axis=-1).reshape(-1, 2)
    steps = np.abs(np.diff(points[np.argsort(codes.curve_index(points))], axis=0)).sum(axis=1)
    # 10 bits a dimension over 16 places: each step goes to a place nearby
    assert steps.max() <= 2 and steps.mean() < 1.2


def test_codes_stand_for_vectors(text_spark):
    rows = odd_vectors(200, 64, seed=3)
    coded, books = codes.compressed(text_spark.createDataFrame(rows, SCHEMA))
    own = {k: [math.floor(256 * x) for x in v] for k, v, _ in rows[:200]}
    for row in coded.where("vec_id between 20 and 60").collect():
        assert ((np.array(own[row.vec_id], dtype=object) - codes.restored(row.code, books)) ** 2).sum() == row.error
