"""Accuracy of forests by repeated cross-validation, all resamples in one job.

All columns are binned once. Each resample, a repeat's fold held out, is a group of rows, and all groups are worked on side by side.
Within a group the trees of a forest grow together, level by level: one histogram of bins and classes per column serves all nodes
of all trees, and gives every possible split. Held-out rows go down with the others, at weight zero, and are voted on where
they end, so no tree is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from slotflow.operators.sampling import hash_folds
from slotflow.session import materialize

BINS = 32
#: The rows that a resample may have: the reference's samples have at most 20,000, and a task holds one resample.
MOST_ROWS = 50_000
TREES_AT_ONCE = 4  # or a twenty-fifth of all, if that is more
FEW_NODES = 4  # rows are picked out first where one node in so many is asked for


def columns_to_try(text: str, columns: int) -> int:
    """Columns per split: a number, or with a point a share of them."""
    return max(1, min(columns, int(np.ceil(float(text) * columns)) if "." in text else int(text)))


def binned(df: DataFrame, numbers: Sequence[str], factors: Sequence[str], label: str, positive, bins: int = BINS) -> tuple[DataFrame, list[int]]:
    """``df`` with ``codes``, the bin of each number and the level of each factor, and ``y``, and how many each column has (negative: a factor).

    Numbers are cut at evenly spread values of the rows; levels are numbered in order of their texts, a missing one is its own.
    """
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    cuts = [F.percentile_approx(c, shares, 10_000).alias(c) for c in numbers]
    # levels beyond what codes can number would be a column of names, not a factor
    levels = [F.sort_array(F.collect_set(F.coalesce(F.col(c).cast("string"), F.lit("\0")))).alias(c) for c in factors]
    if not cuts and not levels:
        raise ValueError("no columns")
    found = df.agg(*cuts, *levels).first()
    codes: list[Column] = []
    sizes: list[int] = []
    for c in numbers:
        places = sorted(set(found[c] or ()))
        above = [F.when(F.col(c).cast("double") > float(p), 1).otherwise(0) for p in places]
        codes.append(sum(above[1:], above[0]) if above else F.lit(0))
        sizes.append(len(places) + 1)
    for c in factors:
        names = F.array(*[F.lit(v) for v in found[c]]) if found[c] else F.array(F.lit("\0"))
        codes.append(F.array_position(names, F.coalesce(F.col(c).cast("string"), F.lit("\0"))).cast("int") - 1)
        sizes.append(-max(1, len(found[c])))
    y = (F.col(label) == F.lit(positive)).cast("int")
    return df.withColumn("codes", F.array(*[c.cast("int") for c in codes])).withColumn("y", y), sizes


def split_columns(sizes: Sequence[int]) -> int:
    """Columns of the model matrix: a number is one, a factor one per level."""
    return sum(1 if s > 0 else -s for s in sizes)


def best_splits(
    hist: Sequence[np.ndarray] | Callable[[int, np.ndarray], np.ndarray], sizes: Sequence[int], tried: int, random: np.random.Generator,
    total: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column, bin and gain of each node's best split among ``tried`` random columns; ``hist`` has nodes x bins x 2 per column.

    A number is split after a bin, a factor at one level; the gain is the fall of the Gini impurity, times the rows. ``hist`` may be a function
    of a column and some nodes, beside ``total``, nodes x 2: it is asked for nodes of both classes only, where the column is tried.
    """
    if total is None:
        total = hist[0].sum(axis=1)
    nodes, columns = len(total), split_columns(sizes)
    picked = np.ones((nodes, columns), bool)
    if tried < columns:
        lots = random.random((nodes, columns))
        picked = lots <= np.partition(lots, tried - 1, axis=1)[:, [tried - 1]]
    # a node of one class gains by no split
    picked[~(total > 0).all(axis=1)] = False
    column, place, gain = np.zeros(nodes, int), np.zeros(nodes, int), np.zeros(nodes)

    def purity(counts: np.ndarray) -> np.ndarray:
        no, yes = counts[..., 0], counts[..., 1]
        return (no * no + yes * yes) / np.maximum(no + yes, 1)

    own, at = purity(total), 0
    for c, size in enumerate(sizes):
        open_ones = picked[:, [at]] if size > 0 else picked[:, at : at - size]
        at += 1 if size > 0 else -size
        some = np.flatnonzero(open_ones.any(axis=1))
        if not len(some):
            continue
        part = hist(c, some) if callable(hist) else hist[c][some]
        part = part.cumsum(axis=1) if size > 0 else part
        gains = purity(part) + purity(total[some, None] - part) - own[some, None]
        gains = np.where(open_ones[some], gains, 0)
        best = gains.argmax(axis=1)
        value = gains[np.arange(len(some)), best]
        better = value > gain[some] + 1e-9
        column[some[better]], place[some[better]], gain[some[better]] = c, best[better], value[better]
    return column, place, gain


def votes(codes: np.ndarray, y: np.ndarray, held: np.ndarray, sizes: Sequence[int], tried: int, trees: int, random: np.random.Generator, depth: int) -> np.ndarray:
    """For each held-out row, how many of ``trees`` trees grown on bootstraps of the others say yes."""
    fit, out = np.flatnonzero(~held), np.flatnonzero(held)
    if not len(fit) or not len(out):
        return np.zeros(len(out))
    yes = np.zeros(len(out))
    # a column's codes lie together; the class is their lowest bit
    cells = np.ascontiguousarray((codes * 2 + y[:, None]).T.astype(np.int32))
    is_number = np.array([s > 0 for s in sizes])
    at_once = max(TREES_AT_ONCE, trees // 25)
    for start in range(0, trees, at_once):
        some = min(at_once, trees - start)
        weights = [np.bincount(random.integers(len(fit), size=len(fit)), minlength=len(fit)) for _ in range(some)]
        # rows of all trees, one after the other: those drawn, then the held-out ones at weight zero
        parts = [np.concatenate([fit[w > 0], out]) for w in weights]
        row = np.concatenate(parts)
        weight = np.concatenate([np.concatenate([w[w > 0], np.zeros(len(out), int)]) for w in weights]).astype(float)
        asked = np.concatenate([np.concatenate([np.full(len(p) - len(out), -1), np.arange(len(out))]) for p in parts])
        node = np.repeat(np.arange(some), [len(p) for p in parts])
        nodes = some
        for level in range(depth + 1):
            drawn = np.flatnonzero(weight)
            lies, points, counts = node[drawn], row[drawn], weight[drawn]
            total = np.bincount(lies * 2 + y[points], counts, nodes * 2).reshape(nodes, 2)
            mixed = (total > 0).all(axis=1)
            if not mixed.all():
                inside = mixed[lies]
                lies, points, counts = lies[inside], points[inside], counts[inside]
            lies, place_of, many = (np.cumsum(mixed) - 1)[lies], np.cumsum(mixed) - 1, int(mixed.sum())

            def hist(c: int, some: np.ndarray, lies=lies, points=points, counts=counts, place_of=place_of, many=many) -> np.ndarray:
                """Bins and classes of column ``c`` in ``some`` nodes, which hold both classes."""
                bins, some, nodes = abs(sizes[c]), place_of[some], many
                if FEW_NODES * len(some) < many:
                    new = np.full(many, -1)
                    new[some] = np.arange(len(some))
                    at = new[lies]
                    inside = at >= 0
                    lies, points, counts, some, nodes = at[inside], points[inside], counts[inside], None, len(some)
                found = np.bincount(lies * (2 * bins) + cells[c][points], counts, nodes * bins * 2).reshape(nodes, bins, 2)
                return found if some is None or len(some) == many else found[some]

            column, place, gain = best_splits(hist, sizes, tried, random, total)
            ends = (gain <= 1e-9) | (level == depth)
            done = ends[node]
            said = total[:, 1] > total[:, 0]
            ended = done & (asked >= 0)
            yes += np.bincount(asked[ended], said[node[ended]], len(out))
            row, weight, asked, node = row[~done], weight[~done], asked[~done], node[~done]
            if not len(row):
                break
            new = np.cumsum(~ends) - 1
            own = cells[column[node], row] >> 1
            right = np.where(is_number[column][node], own > place[node], own != place[node])
            node, nodes = 2 * new[node] + right, 2 * int((~ends).sum())
    return yes


def resampled_accuracy(
    df: DataFrame, numbers: Sequence[str], factors: Sequence[str], label: str, positive, key: Sequence[str], tries: Sequence[str],
    folds: int = 10, repeats: int = 10, trees: int = 500, seed: int = 102, depth: int = 30, most_rows: int = MOST_ROWS,
) -> DataFrame:
    """[place, columns, accuracy, spread, resamples]: the mean and deviation of the held-out accuracy for each of ``tries``, over all resamples.

    ``tries`` are columns per split, as a number or a share. Folds come from hashes of ``key``, a new set per repeat. ``df`` is a sample of
    at most ``most_rows`` rows, more stop the job: a resample is one task's work, and there are ``folds`` times ``repeats`` of them.
    """
    rows, sizes = binned(materialize(df), numbers, factors, label, positive)
    for r in range(repeats):
        rows = hash_folds(rows, key, folds, f"{seed}-{r}", f"_fold{r}")
    held = F.array(*[F.col(f"_fold{r}") for r in range(repeats)])
    rows = materialize(rows.select(F.concat_ws("|", *[F.col(k).cast("string") for k in key]).alias("id"), "codes", "y", held.alias("held")))
    n = rows.count()
    if n > most_rows:
        raise ValueError(f"{n} rows are more than {most_rows}: draw a sample first")
    # a group per resample: every row is in each, held out in one of a repeat's
    groups = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(folds * repeats - 1))))
    groups = groups.select("part", "id", "codes", "y", (F.col("held")[F.floor(F.col("part") / folds).cast("int")] == F.col("part") % folds).alias("out"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        part = int(group["part"].iloc[0])
        codes, y, out = np.stack(group["codes"].to_numpy()), group["y"].to_numpy(int), group["out"].to_numpy(bool)
        found = []
        for i, text in enumerate(tries):
            random = np.random.default_rng([seed, part, i])
            yes = votes(codes, y, out, sizes, columns_to_try(text, split_columns(sizes)), trees, random, depth)
            right = ((2 * yes > trees) == (y[out] == 1)).mean() if out.any() and not out.all() else np.nan
            found.append((i, text, part, float(right)))
        return pd.DataFrame(found, columns=["place", "columns", "part", "accuracy"])

    # as many partitions as resamples: hashes fill them unevenly, and no task should get many of them
    scored = groups.repartition(folds * repeats, "part").groupBy("part").applyInPandas(run, "place int, columns string, part int, accuracy double")
    scored = scored.where(~F.isnan("accuracy"))
    return scored.groupBy("place", "columns").agg(
        F.avg("accuracy").alias("accuracy"), F.stddev_samp("accuracy").alias("spread"), F.count(F.lit(1)).alias("resamples")
    ).select("place", "columns", "accuracy", "spread", "resamples")
