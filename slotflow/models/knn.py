"""Exact k-nearest-neighbour regression.

Training rows are cut into blocks that lie together, each with the box of its rows. A query is first compared with its own block; the
distance of its k-th nearest there rules out every block whose box is farther away, and the query travels to the others alone. Within
a task the same bound is applied to cells of some hundred rows. Bounds only rule out, all others are measured: the result is that of all
distances. How much they save depends on the rows; where all are about as far from each other, nothing is ruled out and the
work is that of all distances, in groups of bounded size.

The folds of a cross-validation differ only in scale and in the rows left out. All of them are searched at once, on a scale of which no
fold's distance falls short; the rows within reach are then measured on the scale of each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from slotflow.functions.columns import hash_number, key_hash
from slotflow.models.boxes import ROOM, Cuts, fit_cuts, least_distances, leaves, search_problems
from slotflow.models.design import KEY, LABEL, encoded, fit_design, moments, prepare_rows
from slotflow.models.fitted import Regressor
from slotflow.session import materialize

KS = (5, 7, 9)  # fixed values: the candidates for k
DIGITS = 9  # distances are compared rounded, so that equal rows tie
BLOCK_ROWS, MOST_BLOCK_ROWS = 4096, 32_768  # rows of a block: more where there are many, as fewer blocks are in reach then
BLOCKS = 32  # so many at least, if they have ``BLOCK_ROWS``
CHUNK_ROWS = 8192  # queries that meet a block at a time, or twice its rows
LEAF_ROWS = 256  # rows of a block that share a box within a task
SAMPLE_ROWS = 65_536  # training rows that say where blocks are cut
CELLS_AT_ONCE = 2**22  # distances one task holds at a time
SENT_AT_ONCE = 2**16  # rows of a batch that a task hands on

_ASKED, _LISTED = "id string, x array<double>, problems array<int>", "problem array<int>, near array<string>, label array<double>, distance array<double>"
HOME = f"{_ASKED}, block int, limits array<double>, {_LISTED}"
SENT = f"{_ASKED}, limits array<double>, block int"
FOUND = f"query string, {_LISTED}"

Scales = dict[int, tuple[np.ndarray, np.ndarray]]


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack(pdf["x"].to_numpy()).astype(float)


def _arrays(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    values = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), len(values) // max(1, len(column)))


def _lists(values: pa.Array | np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Lists of ``lengths``, one after the other; NaN is missing."""
    values = values if isinstance(values, pa.Array) else pa.array(values, from_pandas=True)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), values)


def nearest_rows(asked: np.ndarray, rows: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Query, row and distance of the k nearest ``rows`` of each query; earlier rows win ties."""
    lengths, last = (rows**2).sum(axis=1), min(k, len(rows)) - 1
    step = max(1, CELLS_AT_ONCE // max(1, len(rows)))
    for start in range(0, len(asked), step):
        part = asked[start : start + step]
        # One matrix product finds the candidates, with room for its rounding; only they are measured.
        own = (part**2).sum(axis=1)
        squares = own[:, None] + lengths - 2 * part @ rows.T
        room = 1e-8 * (1 + own + lengths.max())
        limit = np.partition(squares, last, axis=1)[:, last] + room
        q, t = np.nonzero(squares <= limit[:, None])
        far = np.round(np.sqrt(((part[q] - rows[t]) ** 2).sum(axis=1)), DIGITS)
        order = np.lexsort((t, far, q))
        q, t, far = q[order], t[order], far[order]
        kept = np.arange(len(q)) - np.searchsorted(q, q) < k
        yield start + q[kept], t[kept], far[kept]


def _scaled(x: np.ndarray, means: np.ndarray, spreads: np.ndarray) -> np.ndarray:
    """Constant columns count for nothing."""
    return np.divide(x - means, spreads, out=np.zeros_like(x), where=spreads > 0)


def _whole(rows: DataFrame, cuts: Cuts) -> DataFrame:
    """``rows``, stored, with the cell they fall into. Rows without an id are nobody's neighbours."""

    @F.pandas_udf("int")
    def cell(x: pd.Series) -> pd.Series:
        return pd.Series(cuts.cells(np.stack(x.to_numpy()).astype(float)) if len(x) else [], dtype="int32")

    return materialize(rows.filter(F.col("id").isNotNull()).withColumn("cell", cell("x")))


def _share(parts: str) -> Column:
    return (F.crc32(F.col("id").cast("binary")) % F.col(parts)).cast("int")


def _meeting(asked: DataFrame, rows: DataFrame, search: Callable, schema: str) -> DataFrame:
    """``search`` of each block's rows and the queries sent there, at most about ``CHUNK_ROWS`` in a task or twice the rows; ``asked`` is stored."""
    size = F.greatest(F.lit(CHUNK_ROWS), 2 * F.coalesce("rows", F.lit(0)))
    asks, held = asked.groupBy("block").agg(F.count(F.lit(1)).alias("asks")), rows.groupBy("block").agg(F.count(F.lit(1)).alias("rows"))
    parts = materialize(asks.join(held, "block", "left").select("block", F.ceil(F.col("asks") / size).cast("int").alias("parts")))
    left = asked.join(F.broadcast(parts), "block").withColumn("part", _share("parts")).drop("parts")
    right = rows.join(F.broadcast(parts), "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    where = ["block", "part"]
    return left.groupBy(*where).cogroup(right.groupBy(*where)).applyInArrow(search, schema)


def neighbours(train: DataFrame, queries: DataFrame, k: int, scales: Scales) -> DataFrame:
    """[problem, query, id, label, distance, rank]: the k nearest training rows of each query.

    ``train`` is [id, label, x, held] and ``queries`` [id, x, problems]. A query is asked once for each of its
    problems, as many for every query, which have a scale each; a training row takes part in a problem unless it is in ``held``.
    Ties go to the smaller id. The driver holds the sample that the cuts are fitted on, and two corners per block.
    """
    total = train.count()
    if not total:
        raise ValueError("no training rows")
    # the cuts; columns weigh as in the first problem
    share = hash_number(F.md5(F.concat_ws("|", F.lit("cuts"), "id")), 8) < int(min(1.0, SAMPLE_ROWS / total) * 16**8)
    sample = train.filter(share).select("x").toPandas()
    means, spreads = scales[min(scales)] if scales else (np.zeros(1), np.ones(1))
    size = max(BLOCK_ROWS, min(total // BLOCKS, MOST_BLOCK_ROWS))
    depth = max(0, math.ceil(math.log2(total / size))) if len(sample) and scales else 0
    cuts = fit_cuts(_scaled(_matrix(sample), means, spreads), depth) if depth else Cuts(0, np.zeros(1, int), np.full(1, np.inf))
    raw_limits = cuts.limits * np.where(spreads > 0, spreads, np.inf)[cuts.columns] + means[cuts.columns]
    cuts = Cuts(depth, cuts.columns, np.where(np.isfinite(cuts.limits), raw_limits, np.inf))
    # the scale of bounds: on that of no problem are two rows nearer
    numbered, (centres, widths) = np.array(sorted(scales), int), (np.array([scales[p][i] for p in sorted(scales)]).reshape(len(scales), -1) for i in (0, 1))
    least = (means, np.where((widths > 0).all(axis=0), widths.max(axis=0), 0)) if scales else (means, spreads)
    # what stands still in a problem counts for nothing there
    widths = np.where(widths > 0, widths, np.inf)

    # blocks: a cell, or hashed shares of a large one
    rows, asked = _whole(train.select("id", "label", "x", "held"), cuts), _whole(queries.select("id", "x", "problems"), cuts)
    sizes = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("shares"))
    first = F.sum("shares").over(Window.orderBy("cell")) - F.col("shares")
    sizes = materialize(sizes.withColumn("first", first.cast("int")))
    block = F.col("first") + _share("shares")
    rows = rows.join(F.broadcast(sizes), "cell").select("id", "label", "x", "held", block.alias("block"))
    asks, sends, finds = (to_arrow_schema(StructType.fromDDL(s)) for s in (HOME, SENT, FOUND))
    width = len(means)
    corners = [F.array(*[f(F.col("x")[i]) for i in range(width)]).alias(n) for n, f in (("low", F.min), ("high", F.max))]
    boxes = rows.groupBy("block").agg(*corners).orderBy("block").collect()
    numbers = np.array([b.block for b in boxes])
    low, high = (_scaled(np.array([b[n] for b in boxes], float), *least) for n in ("low", "high"))

    def search(asked: pa.Table, rows: pa.Table, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[pa.Array]]:
        """Of each query and problem the distance of the k-th nearest; how many each query has, and the lists of all."""
        rows = rows.take(pc.sort_indices(rows["id"]))
        x, held, q, problems = (_arrays(c) for c in (rows["x"], rows["held"], asked["x"], asked["problems"]))
        scale = np.searchsorted(numbered, problems)
        if not (np.append(numbered, -1)[scale] == problems).all():
            raise KeyError("a problem has no scale")
        slices = max(1, CELLS_AT_ONCE // q.shape[1])

        def measure(a: np.ndarray, column: np.ndarray, t: np.ndarray) -> np.ndarray:
            fit = np.flatnonzero(~(held[t] == problems[a, column][:, None]).any(axis=1))
            far = np.full(len(a), np.inf)
            for start in range(0, len(fit), slices):
                some = fit[start : start + slices]
                own = scale[a[some], column[some]]
                centre, wide = centres[own], widths[own]
                apart = (q[a[some]] - centre) / wide - (x[t[some]] - centre) / wide
                far[some] = np.round(np.sqrt((apart**2).sum(axis=1)), DIGITS)
            return far

        flat = _scaled(x, *least)
        found = list(search_problems(_scaled(q, *least), flat, leaves(flat, LEAF_ROWS), k, limits, measure, CELLS_AT_ONCE))
        far, place = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        a, column, slot = np.nonzero(place >= 0)
        t, counts = place[a, column, slot], (place >= 0).sum(axis=(1, 2))
        ids, labels = (rows[c].combine_chunks().take(pa.array(t)) for c in ("id", "label"))
        flat_lists = pa.array(problems[a, column], pa.int32()), ids, labels, far[a, column, slot]
        return far[:, :, -1], counts, [_lists(v, counts) for v in flat_lists]

    def at_home(asked: pa.Table, rows: pa.Table) -> pa.Table:
        """The queries with the nearest of their own block: per problem the distance of the k-th, and lists of all."""
        if not asked.num_rows or not rows.num_rows:
            return asks.empty_table()
        limits, _, listed = search(asked, rows, np.full(_arrays(asked["problems"]).shape, np.inf))
        kept = [asked[c].combine_chunks() for c in ("id", "x", "problems", "block")]
        return pa.table([*kept, _lists(limits.ravel(), np.full(*limits.shape)), *listed], asks.names).cast(asks)

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query once for each other block whose box is within reach in one of its problems."""
        step = max(1, CELLS_AT_ONCE // len(numbers))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                reach = _arrays(part["limits"]).max(axis=1)
                reached = ~(least_distances(_scaled(_arrays(part["x"]), *least), low, high) > reach[:, None] + ROOM)
                reached &= part["block"].to_numpy()[:, None] != numbers
                a, b = np.nonzero(reached)
                for at in range(0, len(a), SENT_AT_ONCE):
                    some = pa.array(a[at : at + SENT_AT_ONCE])
                    columns = [part[c].take(some) for c in ("id", "x", "problems", "limits")]
                    yield pa.record_batch([*columns, pa.array(numbers[b[at : at + SENT_AT_ONCE]], pa.int32())], sends.names).cast(sends)

    def abroad(asked: pa.Table, rows: pa.Table) -> pa.Table:
        if not asked.num_rows or not rows.num_rows:
            return finds.empty_table()
        _, counts, listed = search(asked, rows, _arrays(asked["limits"]))
        return pa.table([asked["id"].combine_chunks(), *listed], finds.names).filter(pa.array(counts > 0)).cast(finds)

    # a query whose cell holds no training row has no block of its own: nothing is ruled out for it
    placed = materialize(asked.join(F.broadcast(sizes), "cell", "left").select("id", "x", "problems", F.coalesce(block, F.lit(-1)).alias("block")))
    home = materialize(_meeting(placed.filter("block >= 0"), rows, at_home, HOME))
    lost = placed.filter("block < 0").withColumn("limits", F.transform("problems", lambda _: F.lit(float("inf"))))
    far = home.select("id", "x", "problems", "block", "limits").unionByName(lost)
    sent = materialize(far.mapInArrow(elsewhere, SENT))
    near = home.select(F.col("id").alias("query"), "problem", "near", "label", "distance")
    lists = near.unionByName(_meeting(sent, rows, abroad, FOUND))
    # lists travel whole, all of a query to one place, and are taken apart there
    nested = F.explode(F.arrays_zip("problem", "near", "label", "distance")).alias("n")
    found = lists.repartition("query").select("query", nested)
    found = found.select("n.problem", "query", F.col("n.near").alias("id"), "n.label", "n.distance")
    nearest = Window.partitionBy("problem", "query").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)


def _means(found: DataFrame, ks: Sequence[int]) -> DataFrame:
    """[problem, query, one mean per k]: all from the same neighbours."""
    means = [F.avg(F.when(F.col("rank") <= k, F.col("label"))).alias(f"k{k}") for k in ks]
    return found.groupBy("problem", "query").agg(*means)


def fold_numbers(folds: int, repeats: int, seed: int) -> Column:
    """The fold of a row in each repeat; folds of all repeats are numbered through."""
    fold = [(hash_number(key_hash(f"{seed}-{r}", ["id"]), 8) % folds + r * folds).cast("int") for r in range(repeats)]
    return F.array(*fold)


def fold_scales(raw: DataFrame, width: int, folds: int) -> Scales:
    """Means and sample deviations of the rows outside each fold, from those within the other folds."""
    within = F.expr(f"array({', '.join(f'var_pop(x[{i}])' for i in range(width))})").alias("variances")
    sums = raw.select(F.explode("held").alias("fold"), "x").groupBy("fold").agg(F.count(F.lit(1)).alias("n"), moments(width)[0], within)
    found = {r.fold: (r.n, np.array(r.means), np.array(r.variances)) for r in sums.collect()}
    scales = {}
    for fold in found:
        others = [v for f, v in found.items() if f != fold and f // folds == fold // folds]
        n = sum(m for m, _, _ in others)
        mean = sum((m * a for m, a, _ in others), np.zeros(width)) / max(n, 1)
        squares = sum((m * (v + (a - mean) ** 2) for m, a, v in others), np.zeros(width))
        scales[fold] = (mean, np.sqrt(squares / max(n - 1, 1)))
    return scales


def knn_tuning(train: DataFrame, ks: Sequence[int] = KS, folds: int = 10, repeats: int = 3, seed: int = 101) -> DataFrame:
    """[k, rmse] by repeated cross-validation, scaled anew within each fold."""
    train = materialize(train)
    design = fit_design(train)
    raw = train.select(F.col(KEY).alias("id"), F.col(LABEL).cast("double").alias("label"), design.row().alias("x"))
    raw = materialize(raw.withColumn("held", fold_numbers(folds, repeats, seed)))
    found = neighbours(raw, raw.withColumnRenamed("held", "problems"), max(ks), fold_scales(raw, design.width, folds))
    scored = _means(found, ks).join(raw.select(F.col("id").alias("query"), "label"), "query")
    errors = [F.sqrt(F.avg((F.col(f"k{k}") - F.col("label")) ** 2)).alias(f"k{k}") for k in ks]
    mean = scored.groupBy("problem").agg(*errors).agg(*[F.avg(f"k{k}").alias(f"k{k}") for k in ks])
    pairs = F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.col(f"k{k}").alias("rmse")) for k in ks]))
    return mean.select(pairs.alias("p")).select("p.*")


def best_k(tuning: DataFrame) -> int:
    """The k with the smallest error, the smaller one on a tie."""
    return tuning.orderBy("rmse", "k").first().k


def knn_forecast(
    train: DataFrame, features: DataFrame, k: int | None = None, seed: int = 101, repeats: int = 3, method: str = "exact", tables: int = 8
) -> DataFrame:
    """[prod_id, prediction]: the mean label of the k nearest. Without ``k`` it is tuned first, by ``repeats`` cross-validations.

    ``method`` is "exact", all distances, or "candidates", those within the cells of ``tables`` trees (``slotflow.models.index``): some
    neighbours may then be others than the nearest, and ``k`` must be given, as tuning compares all.
    """
    if method not in ("exact", "candidates") or (method == "candidates" and k is None):
        raise ValueError('method is "exact", or "candidates" with k given')
    model = knn_fit(train, k, seed, repeats)
    if method == "exact":
        return model.predict(features)
    from slotflow.models.index import candidates, fit_index

    asked = materialize(encoded(features, model.design, model.scale))
    found = candidates(model.rows, asked, model.values["k"], fit_index(model.rows, tables, seed=seed))
    return found.groupBy(F.col("query").alias(KEY)).agg(F.avg("label").alias("prediction"))


def knn_fit(train: DataFrame, k: int | None = None, seed: int = 101, repeats: int = 3) -> Regressor:
    """The scaled training rows and ``k``, tuned by ``repeats`` cross-validations unless given."""
    train = materialize(train)
    if k is None:
        k = best_k(knn_tuning(train, seed=seed, repeats=repeats))
    problem = prepare_rows(train)
    return Regressor("knn", problem.design, problem.scale, {"k": int(k)}, materialize(problem.train))


def predicted(model: Regressor, asked: DataFrame) -> DataFrame:
    k, width = model.values["k"], model.design.width
    none, one = F.array().cast("array<int>").alias("held"), F.array(F.lit(0)).alias("problems")
    same = {0: (np.zeros(width), np.ones(width))}
    found = neighbours(model.rows.select("id", "label", "x", none), asked.select("id", "x", one), k, same)
    return _means(found, [k]).select(F.col("query").alias(KEY), F.col(f"k{k}").alias("prediction"))
